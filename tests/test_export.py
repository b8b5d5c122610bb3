import shutil

import pytest
from pyspark.sql import functions as F

from conftest import D1, D2, parquet_files, rows_for, sorted_rows
from partwright.operators.export import export_partitioned, export_single_partition
from partwright.sources.hive import read_partitioned

KEYS2 = [("T1", "S1"), ("T1", "S2"), ("T2", "S1")]
COLS = ["terr_cd", "store_id", "extract_date", "order_id", "total_amt"]


def test_roundtrip_keys_dropped_and_typed(spark, small_frame, tmp_path):
    df = small_frame(rows_for(KEYS2 + [("T3", "0001")], D1))
    out = str(tmp_path / "out")
    res = export_partitioned(df, out, overwrite="all")
    assert res.rows == 12 and res.tuples == 4 and res.hot_tuples == 0
    back = read_partitioned(spark, out, columns=COLS)
    assert sorted_rows(back) == sorted_rows(df)
    # leading zeros survive because key types are declared
    assert back.filter(F.col("store_id") == "0001").count() == 3
    # keys are not in the file bodies
    body = spark.read.parquet(str(parquet_files(out)[0]))
    assert set(body.columns) == {"order_id", "total_amt"}


def test_one_file_per_partition_despite_many_inputs(spark, small_frame, tmp_path):
    keys = [(f"T{i % 4}", f"S{i}") for i in range(20)]
    df = small_frame(rows_for(keys, D1, n_per_key=8), num_partitions=8)
    assert df.rdd.getNumPartitions() == 8
    for strategy in ("split", "hash", "rebalance"):
        out = str(tmp_path / strategy)
        export_partitioned(df, out, overwrite="all", strategy=strategy)
        files = parquet_files(out)
        dirs = {f.parent for f in files}
        assert len(dirs) == 20
        assert len(files) == 20, strategy
    # without the key shuffle every input task writes its own file per key
    naive = str(tmp_path / "naive")
    df.write.partitionBy("terr_cd", "store_id", "extract_date").parquet(naive)
    assert len(parquet_files(naive)) > 20


def test_static_overwrite_replaces_whole_target(spark, small_frame, tmp_path):
    out = str(tmp_path / "out")
    export_partitioned(small_frame(rows_for(KEYS2, D1)), out, overwrite="all")
    export_partitioned(small_frame(rows_for(KEYS2, D2)), out, overwrite="all")
    dates = {r[0] for r in read_partitioned(spark, out).select("extract_date").distinct().collect()}
    assert dates == {D2}


def test_dynamic_overwrite_keeps_other_partitions(spark, small_frame, tmp_path):
    out = str(tmp_path / "out")
    export_partitioned(small_frame(rows_for(KEYS2, D1)), out, overwrite="all")
    export_partitioned(small_frame(rows_for(KEYS2, D2)), out, overwrite="partitions")
    # replacing D1 again with fewer rows changes only D1's directories
    export_partitioned(small_frame(rows_for(KEYS2[:1], D1, n_per_key=1, start=100)), out, overwrite="partitions")
    back = read_partitioned(spark, out)
    assert back.filter(F.col("extract_date") == D2).count() == 9
    d1 = back.filter(F.col("extract_date") == D1)
    # T1/S1 replaced (1 row); the other two D1 tuples were not in the frame and stay
    assert d1.filter((F.col("terr_cd") == "T1") & (F.col("store_id") == "S1")).count() == 1
    assert d1.count() == 1 + 6


def test_overwrite_has_no_silent_default(small_frame, tmp_path):
    with pytest.raises(TypeError):
        export_partitioned(small_frame(rows_for(KEYS2, D1)), str(tmp_path / "x"))
    with pytest.raises(ValueError):
        export_partitioned(small_frame(rows_for(KEYS2, D1)), str(tmp_path / "x"), overwrite="bogus")


@pytest.mark.parametrize("strategy", ["split", "hash"])
@pytest.mark.parametrize("bad", [None, ""])
def test_null_or_empty_key_refused_before_writing(small_frame, tmp_path, strategy, bad):
    out = tmp_path / "out"
    export_partitioned(small_frame(rows_for(KEYS2, D1)), str(out), overwrite="all")
    before = parquet_files(out)
    df = small_frame(rows_for(KEYS2 + [("T9", bad)], D1))
    with pytest.raises(ValueError, match="NULL or empty"):
        export_partitioned(df, str(out), overwrite="all", strategy=strategy)
    assert parquet_files(out) == before


def test_same_path_static_overwrite_refused(spark, small_frame, tmp_path):
    out = str(tmp_path / "out")
    export_partitioned(small_frame(rows_for(KEYS2, D1)), out, overwrite="all")
    src = read_partitioned(spark, out)
    with pytest.raises(ValueError, match="reads from it"):
        export_partitioned(src, out, overwrite="all")
    # the same target given relative to the working directory is caught too
    import os

    rel = os.path.relpath(out)
    with pytest.raises(ValueError, match="reads from it"):
        export_partitioned(src, rel, overwrite="all")
    assert read_partitioned(spark, out).count() == 9


ESCAPED = ["a/b", "c=d e", "g%h", "a+b", "k:l", "m#n?"]


def test_escaped_keys_roundtrip(spark, small_frame, tmp_path):
    from partwright.plans.reconcile import file_inventory

    keys = [(v, "S1") for v in ESCAPED]
    df = small_frame(rows_for(keys, D1, n_per_key=2))
    out = str(tmp_path / "out")
    export_partitioned(df, out, overwrite="all")
    back = read_partitioned(spark, out, columns=COLS)
    assert sorted_rows(back) == sorted_rows(df)
    inv, exists = file_inventory(spark, out)
    assert exists
    assert sorted(r[0] for r in inv.select("terr_cd").distinct().collect()) == sorted(ESCAPED)
    assert inv.filter(~F.col("valid")).count() == 0


def test_hot_key_is_split_into_bounded_files(spark, small_frame, tmp_path):
    rows = rows_for([("HOT", "S1")], D1, n_per_key=990) + rows_for(
        [("T1", f"S{i}") for i in range(10)], D1, n_per_key=1, start=5000
    )
    df = small_frame(rows, num_partitions=6)
    out = str(tmp_path / "split")
    res = export_partitioned(df, out, overwrite="all", max_rows_per_file=200)
    assert res.hot_tuples == 1
    files = parquet_files(out)
    hot = [f for f in files if "terr_cd=HOT" in str(f)]
    cold = [f for f in files if "terr_cd=HOT" not in str(f)]
    assert len(cold) == 10
    assert len(hot) >= 2
    sizes = [spark.read.parquet(str(f)).count() for f in hot]
    assert sum(sizes) == 990
    assert max(sizes) < 990
    back = read_partitioned(spark, out, columns=COLS)
    assert sorted_rows(back) == sorted_rows(df)
    # the reference plan keeps the hot tuple in one file (and one task)
    out2 = str(tmp_path / "hash")
    export_partitioned(df, out2, overwrite="all", strategy="hash")
    assert len([f for f in parquet_files(out2) if "terr_cd=HOT" in str(f)]) == 1


def test_hot_group_of_exact_copies_is_split(spark, small_frame, tmp_path):
    copy = ("HOT", "S1", D1, "same", rows_for([("x", "y")], D1, 1)[0][4])
    df = small_frame([copy] * 800, num_partitions=8)
    out = str(tmp_path / "copies")
    export_partitioned(df, out, overwrite="all", max_rows_per_file=100)
    files = parquet_files(out)
    assert len(files) >= 2
    assert read_partitioned(spark, out).count() == 800


def test_max_records_per_file_bounds_files(spark, small_frame, tmp_path):
    df = small_frame(rows_for([("T1", "S1")], D1, n_per_key=90))
    out = str(tmp_path / "out")
    export_partitioned(df, out, overwrite="all", max_records_per_file=30)
    assert len(parquet_files(out)) == 3


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_split_plan_has_one_key_exchange(spark, small_frame):
    from partwright.operators.export import prepare_export

    df = small_frame(rows_for(KEYS2, D1))
    prep = prepare_export(df, num_partitions=8)
    plan = _plan(prep.frame)
    assert plan.count("hashpartitioning(terr_cd") == 1
    assert "BroadcastHashJoin" not in plan  # no hot tuple, no join
    prep.release()


def test_split_plan_with_hot_tuple_broadcasts_bounded_side(spark, small_frame):
    from partwright.operators.export import prepare_export

    df = small_frame(rows_for([("HOT", "S1")], D1, n_per_key=50) + rows_for(KEYS2, D1))
    prep = prepare_export(df, max_rows_per_file=10)
    assert prep.result.hot_tuples == 1
    plan = _plan(prep.frame)
    assert "BroadcastHashJoin" in plan
    assert "SortMergeJoin" not in plan
    # the big side reaches exactly one exchange, by the number of its task
    big_side = plan.split("BroadcastExchange")[0]
    assert big_side.count("Exchange ") == 1
    assert "hashpartitioning(" not in big_side
    assert "__pw_task" in big_side
    prep.release()


def test_single_partition_export(spark, small_frame, tmp_path):
    df = small_frame(rows_for(KEYS2 + [("a/b", "S 1")], D1))
    root = str(tmp_path / "legacy")
    target = export_single_partition(df, root, {"terr_cd": "a/b", "store_id": "S 1", "extract_date": D1})
    assert "terr_cd=a%2Fb/store_id=S 1/extract_date=2026-03-01" in target
    assert spark.read.parquet(target).count() == 3
    assert set(spark.read.parquet(target).columns) == {"order_id", "total_amt"}
    back = read_partitioned(spark, root)
    assert back.select("terr_cd").distinct().collect()[0][0] == "a/b"


def test_observed_metrics_during_write(small_frame, tmp_path):
    df = small_frame(rows_for(KEYS2, D1))
    res = export_partitioned(df, str(tmp_path / "o"), overwrite="all", observe_sum="total_amt")
    assert res.observed["rows"] == 9
    assert res.observed["sum"] == sum(r[4] for r in rows_for(KEYS2, D1))


def test_empty_frame_static_overwrite_empties_target(spark, small_frame, tmp_path):
    out = str(tmp_path / "out")
    export_partitioned(small_frame(rows_for(KEYS2, D1)), out, overwrite="all")
    export_partitioned(small_frame(rows_for(KEYS2, D1)).filter(F.lit(False)), out, overwrite="all")
    assert parquet_files(out) == []
    shutil.rmtree(out)


def test_rebalance_strategy_splits_hot_bucket_with_aqe(spark, small_frame, tmp_path):
    rows = rows_for([("HOT", "S1")], D1, n_per_key=4000) + rows_for(
        [("T1", f"S{i}") for i in range(5)], D1, n_per_key=2, start=10000
    )
    df = small_frame(rows, num_partitions=8)
    old = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "8k")
    try:
        out = str(tmp_path / "rb")
        export_partitioned(df, out, overwrite="all", strategy="rebalance")
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", old)
    hot = [f for f in parquet_files(out) if "terr_cd=HOT" in str(f)]
    assert len(hot) >= 2
    assert read_partitioned(spark, out).count() == 4010


def test_escape_rule_matches_spark_directory_names(spark, small_frame, tmp_path):
    from partwright.functions.keys import escape_value

    specials = ['q"q', "h#h", "p%p", "a'a", "s*s", "sl/sl", "c:c", "e=e", "w?w", "b\\b", "o{o", "l[l", "r]r", "x^x",
                "sp ace", "pl+us", "t\tt", "uéu"]
    df = small_frame(rows_for([(v, "S1") for v in specials], D1, n_per_key=1))
    out = tmp_path / "esc"
    export_partitioned(df, str(out), overwrite="all")
    written = sorted(p.name[len("terr_cd="):] for p in out.iterdir() if p.name.startswith("terr_cd="))
    assert written == sorted(escape_value(v) for v in specials)
    back = read_partitioned(spark, str(out), columns=COLS)
    assert sorted(r[0] for r in back.select("terr_cd").collect()) == sorted(specials)


def test_sort_within_clusters_each_file(spark, small_frame, tmp_path):
    import pyarrow.parquet as pq

    rows = rows_for([("T1", "S1")], D1, n_per_key=50)
    rows = rows[::-1]  # arrive in descending order
    df = small_frame(rows, num_partitions=4)
    out = str(tmp_path / "sorted")
    export_partitioned(df, out, overwrite="all", sort_within=("order_id",))
    files = parquet_files(out)
    assert len(files) == 1
    ids = pq.read_table(files[0]).column("order_id").to_pylist()
    assert ids == sorted(ids)


def _skewed(spark, hot=2000, copies=800):
    """Two hot tuples, one of them exact copies, and cold ones; a map column is carried along."""
    import datetime as dt

    rows = [("H", i, dt.date(2026, 3, 1), {"k": i}) for i in range(hot)]
    rows += [("C", 7, dt.date(2026, 3, 1), {"k": 7})] * copies
    rows += [(f"t{i}", i, dt.date(2026, 3, 1), None) for i in range(30)]
    return spark.createDataFrame(rows, "terr string, v long, extract_date date, m map<string,long>").repartition(6)


@pytest.mark.parametrize("broadcast_bytes", [1 << 20, 0])
def test_hot_slots_are_bounded_per_task_and_file(spark, tmp_path, broadcast_bytes):
    from pyspark.sql import functions as F

    from partwright.operators.export import prepare_export, write_prepared

    df, bound = _skewed(spark), 100
    prep = prepare_export(
        df, keys=("terr", "extract_date"), max_rows_per_file=bound, hot_broadcast_bytes=broadcast_bytes
    )
    tasks = prep.frame.groupBy(F.spark_partition_id().alias("p")).agg(
        F.count("*").alias("n"), F.count_distinct("terr").alias("keys")
    )
    hot_tasks = tasks.join(
        prep.frame.filter("terr in ('H', 'C')").select(F.spark_partition_id().alias("p")).distinct(), "p"
    )
    worst = hot_tasks.agg(F.max("n"), F.max("keys")).first()
    assert worst[0] <= bound and worst[1] == 1
    path = str(tmp_path / "out")
    write_prepared(prep, path, overwrite="all")
    back = spark.read.parquet(path)
    files = back.groupBy("terr", F.col("_metadata.file_path").alias("f")).count()
    assert files.agg(F.max("count")).first()[0] <= bound
    assert files.filter("terr like 't%'").groupBy("terr").count().filter("count > 1").isEmpty()
    assert back.groupBy("terr").count().filter("terr = 'C'").first()["count"] == 800
    assert back.agg(F.sum("v")).first()[0] == df.agg(F.sum("v")).first()[0]


def test_single_partition_directory_text_is_sparks(spark, tmp_path):
    import datetime as dt

    from partwright.operators.export import export_single_partition

    df = spark.createDataFrame(
        [(True, dt.datetime(2024, 1, 15, 10), 1e7, 1)], "b boolean, t timestamp, f double, v int"
    )
    keys = ("b", "t", "f")
    export_partitioned(df, str(tmp_path / "a"), overwrite="all", keys=keys)
    target = export_single_partition(
        df, str(tmp_path / "b"), {"b": True, "t": dt.datetime(2024, 1, 15, 10), "f": 1e7}, keys=keys
    )
    whole = {str(p.parent.relative_to(tmp_path / "a")) for p in (tmp_path / "a").rglob("*.parquet")}
    assert whole == {target.removeprefix(str(tmp_path / "b") + "/")}
