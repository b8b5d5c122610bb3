import datetime as dt

from pyspark.sql import functions as F

from conftest import SF, D1, D2, rows_for
from partwright.operators.export import export_partitioned
from partwright.sources.hive import read_partitioned
from partwright.sources.inventory import list_files, list_files_or_empty
from partwright.sources.views import sales_like_table
from partwright.sources.warehouse import date_equals, read_source


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_source_date_filter_is_pushed_and_columns_pruned(spark):
    day = read_source(spark, sales_like_table(spark, SF), extract_date="2024-01-15")
    plan = _plan(day.select("terr_cd", "total_amt"))
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts,2024-01-15T00:00), LessThan(ts,2024-01-16T00:00)]" in plan
    assert "event_id" not in plan.split("ReadSchema:")[1].split("\n")[0]
    assert day.filter(F.to_date("created_at") != F.lit(dt.date(2024, 1, 15))).count() == 0


def test_readback_date_filter_prunes_partitions(spark, small_frame, tmp_path):
    out = str(tmp_path / "out")
    export_partitioned(small_frame(rows_for([("T1", "S1")], D1) + rows_for([("T1", "S1")], D2)), out, overwrite="all")
    back = read_partitioned(spark, out).filter(date_equals("extract_date", D1))
    plan = _plan(back.select("total_amt"))
    assert "PartitionFilters: [isnotnull(extract_date" in plan and "= 2026-03-01" in plan
    assert back.count() == 3


def test_read_source_formats(spark, small_frame, tmp_path):
    src = str(tmp_path / "orc")
    small_frame(rows_for([("T1", "S1")], D1) + rows_for([("T2", "S2")], D2)).write.orc(src)
    df = read_source(spark, src, fmt="orc", extract_date="2026-03-02")
    assert df.count() == 3
    small_frame(rows_for([("T1", "S1")], D1)).createOrReplaceTempView("pw_src_view")
    assert read_source(spark, "pw_src_view", fmt="table", extract_date=D1).count() == 3


def test_inventory_lists_without_reading(spark, small_frame, tmp_path):
    out = str(tmp_path / "out")
    export_partitioned(small_frame(rows_for([("T1", "S1"), ("T2", "S2")], D1)), out, overwrite="all")
    inv = list_files(spark, out)
    assert inv.count() == 2
    assert "content" not in _plan(inv).split("ReadSchema:")[1].split("\n")[0]
    empty, exists = list_files_or_empty(spark, str(tmp_path / "absent"))
    assert not exists and empty.count() == 0


def test_run_report(spark, small_frame, tmp_path):
    from partwright.plans.report import run_export

    src = small_frame(rows_for([("T1", "S1"), ("T2", "S2")], D1) + rows_for([("T1", "S1")], D2, start=50))
    row = run_export(spark, src, str(tmp_path / "out"), D1, sla_seconds=600).first()
    assert row["rows_exported"] == 6 and row["partitions"] == 2
    assert row["sum_total_amt"] == sum(r[4] for r in rows_for([("T1", "S1"), ("T2", "S2")], D1))
    assert row["sla_met"] is True and row["elapsed_seconds"] > 0
    row = run_export(spark, src, str(tmp_path / "out2"), D1, sla_seconds=0).first()
    assert row["sla_met"] is False
