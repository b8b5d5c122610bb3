import shutil
from decimal import Decimal

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from conftest import D1, parquet_files, rows_for
from partwright.operators.export import export_partitioned
from partwright.plans.reconcile import layout_report, partition_distribution, reconcile, verify_export

KEYS = [(f"T{i % 3}", f"S{i}") for i in range(6)]


def _export(spark, small_frame, tmp_path):
    src = small_frame(rows_for(KEYS, D1, n_per_key=4))
    out = str(tmp_path / "out")
    export_partitioned(src, out, overwrite="all")
    return src, out


def test_clean_export_passes_everything(spark, small_frame, tmp_path):
    src, out = _export(spark, small_frame, tmp_path)
    lay = layout_report(spark, out).first()
    assert lay["layout_ok"] and lay["parquet_files"] == 6 and lay["valid_files"] == 6
    assert lay["distinct_territories"] == 3 and lay["distinct_stores"] == 6
    assert lay["sample_partitions"].split(",")[0] == "terr_cd=T0/store_id=S0/extract_date=2026-03-01"
    assert len(lay["sample_partitions"].split(",")) == 3
    rec = reconcile(spark, src, out, D1).first()
    assert rec["all_ok"] and rec["row_diff"] == 0
    assert rec["sum_total_amt"] == rec["exported_total_amt"]
    dist = partition_distribution(spark, out, src).first()
    assert dist["ok"] and dist["partitions"] == 6 and dist["max_files_per_partition"] == 1


def test_missing_and_empty_paths_fail_layout_without_crash(spark, tmp_path):
    row = layout_report(spark, str(tmp_path / "absent")).first()
    assert row["layout_ok"] is False and row["parquet_files"] == 0
    (tmp_path / "empty").mkdir()
    row = layout_report(spark, str(tmp_path / "empty")).first()
    assert row["layout_ok"] is False


def test_deleted_file_is_detected(spark, small_frame, tmp_path):
    src, out = _export(spark, small_frame, tmp_path)
    parquet_files(out)[0].unlink()
    rec = reconcile(spark, src, out, D1).first()
    assert not rec["rows_match"] and not rec["all_ok"]
    dist = partition_distribution(spark, out, src).first()
    assert dist["missing_partitions"] == 1 and not dist["ok"]


def test_duplicated_file_is_detected(spark, small_frame, tmp_path):
    src, out = _export(spark, small_frame, tmp_path)
    f = parquet_files(out)[0]
    shutil.copy(f, f.with_name("part-copy-" + f.name))
    rec = reconcile(spark, src, out, D1).first()
    assert rec["row_diff"] == -4 and not rec["all_ok"]
    dist = partition_distribution(spark, out, src).first()
    assert dist["max_files_per_partition"] == 2 and not dist["files_ok"]


def test_changed_amount_is_detected(spark, small_frame, tmp_path):
    src, out = _export(spark, small_frame, tmp_path)
    f = parquet_files(out)[0]
    t = pq.read_table(f)
    amounts = t.column("total_amt").to_pylist()
    amounts[0] = amounts[0] + Decimal("0.01")
    import pyarrow as pa
    t = t.set_column(t.schema.get_field_index("total_amt"), "total_amt", pa.array(amounts, t.schema.field("total_amt").type))
    pq.write_table(t, f)
    f.with_name("." + f.name + ".crc").unlink(missing_ok=True)
    rec = reconcile(spark, src, out, D1).first()
    assert rec["rows_match"] and not rec["sum_match"] and not rec["all_ok"]


def test_off_pattern_file_fails_layout(spark, small_frame, tmp_path):
    src, out = _export(spark, small_frame, tmp_path)
    f = parquet_files(out)[0]
    shutil.copy(f, tmp_path / "out" / "stray.parquet")
    row = layout_report(spark, out).first()
    assert row["parquet_files"] == 7 and row["valid_files"] == 6 and not row["layout_ok"]


def test_cancelling_changes_pass_the_aggregate_check(spark, small_frame, tmp_path):
    """Known limit of aggregate reconciliation (as in the reference)."""
    src, out = _export(spark, small_frame, tmp_path)
    moved = src.withColumn(
        "total_amt",
        F.when(F.col("order_id") == "o0", F.col("total_amt") + 1)
        .when(F.col("order_id") == "o1", F.col("total_amt") - 1)
        .otherwise(F.col("total_amt"))
        .cast("decimal(18,2)"),
    )
    out2 = str(tmp_path / "out2")
    export_partitioned(moved, out2, overwrite="all")
    assert reconcile(spark, src, out2, D1).first()["all_ok"]


def test_checks_work_with_other_keys(spark, tmp_path):
    from partwright.sources.views import table

    li = table(spark, "/root/testdata/sf0.001", "lineitem").withColumn(
        "amount", F.col("l_extendedprice").cast("decimal(18,2)")
    ).withColumn("day", F.col("l_shipdate").cast("date"))
    one_day = li.select("day").orderBy("day").first()[0]
    keys = ("day", "l_returnflag")
    out = str(tmp_path / "li")
    export_partitioned(li, out, overwrite="all", keys=keys)
    rec = reconcile(spark, li, out, one_day, keys=keys, date_column="day", amount="amount").first()
    assert rec["all_ok"] and rec["total_rows"] > 0
    lay = layout_report(spark, out, keys).first()
    assert lay["layout_ok"]
    assert partition_distribution(spark, out, li, keys).first()["ok"]


def test_each_date_of_a_tree_verifies_alone(spark, small_frame, tmp_path):
    from conftest import D1, D2, rows_for

    path = str(tmp_path / "two")
    one, two = small_frame(rows_for([("A", "1"), ("B", "2")], D1)), small_frame(rows_for([("A", "1")], D2))
    export_partitioned(one, path, overwrite="all")
    export_partitioned(two, path, overwrite="partitions")
    both = one.unionByName(two)
    assert verify_export(spark, both, path, D1).first()["verified"]
    assert verify_export(spark, both, path, D2).first()["verified"]
    # a directory that the source doesn't have, of the same date only
    export_partitioned(small_frame(rows_for([("Z", "9")], D2)), path, overwrite="partitions")
    assert verify_export(spark, both, path, D1).first()["verified"]
    assert not verify_export(spark, both, path, D2).first()["verified"]


def test_split_tuples_verify_with_their_bound_only(spark, small_frame, tmp_path):
    from conftest import D1, rows_for

    path = str(tmp_path / "split")
    df = small_frame(rows_for([("A", "1")], D1, n_per_key=50) + rows_for([("B", "2")], D1, start=900))
    export_partitioned(df, path, overwrite="all", max_rows_per_file=10)
    assert verify_export(spark, df, path, D1, max_rows_per_file=10).first()["verified"]
    assert not verify_export(spark, df, path, D1).first()["verified"]


def test_doubles_reconcile_exactly(spark, tmp_path):
    from pyspark.sql import functions as F

    df = spark.range(20_000).select(
        F.concat(F.lit("T"), F.col("id") % 3).alias("terr_cd"),
        F.lit("S").alias("store_id"),
        F.lit("2026-03-01").cast("date").alias("extract_date"),
        (F.rand(3) * 1e9).alias("total_amt"),
    )
    path = str(tmp_path / "doubles")
    export_partitioned(df, path, overwrite="all")
    assert reconcile(spark, df, path).first()["all_ok"]
