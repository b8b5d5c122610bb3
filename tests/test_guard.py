"""Constraints checked inside the write: how often the source is read, and what a violation leaves."""

import datetime as dt

import pytest
from conftest import D1, D2, parquet_files, rows_for, sorted_rows
from pyspark.sql import functions as F

from partwright.operators.export import export_partitioned
from partwright.operators.guard import guarded, violations_raise
from partwright.operators.replace import replace_date
from partwright.operators.table import create_table, insert_clustered, replace_table_date
from partwright.sources.hive import read_partitioned

KEYS2 = [("T1", "S1"), ("T2", "S2")]


def counted(spark, df):
    """``df`` and an accumulator of the rows that are read from it."""
    seen = spark.sparkContext.accumulator(0)

    def see(amount):
        seen.add(1)
        return amount

    return df.withColumn("total_amt", F.udf(see, "decimal(18,2)")("total_amt")), seen


@pytest.mark.parametrize("strategy", ["direct", "hash", "rebalance"])
def test_checked_export_reads_its_source_once(spark, small_frame, tmp_path, strategy):
    rows, seen = counted(spark, small_frame(rows_for(KEYS2, D1, n_per_key=20)))
    res = export_partitioned(rows, str(tmp_path / "o"), overwrite="all", strategy=strategy)
    assert seen.value == 40 == res.rows
    bad = small_frame(rows_for([*KEYS2, ("T9", None)], D1, n_per_key=20))
    before = parquet_files(tmp_path / "o")
    with pytest.raises(ValueError, match="NULL or empty partition key 'store_id'"):
        export_partitioned(bad, str(tmp_path / "o"), overwrite="partitions", strategy=strategy)
    assert parquet_files(tmp_path / "o") == before and [p.name for p in tmp_path.iterdir()] == ["o"]


def test_replacement_of_a_date_reads_its_rows_once(spark, small_frame, tmp_path):
    path = str(tmp_path / "t")
    old = small_frame(rows_for(KEYS2, D1) + rows_for(KEYS2, D2))
    export_partitioned(old, path, overwrite="all", keys=("extract_date",))
    rows, seen = counted(spark, small_frame(rows_for(KEYS2, D1, n_per_key=9, start=50)))
    assert replace_date(rows, path, D1)["rows"] == 18 == seen.value
    back = read_partitioned(spark, path, keys=("extract_date",), columns=old.columns)
    assert sorted_rows(back) == sorted_rows(rows.unionByName(old.filter(F.col("extract_date") == D2)))
    out = replace_date(rows.limit(0), path, D1)
    assert out == {"rows": 0, "removed_partition": True}
    assert replace_date(rows.limit(0), path, D1)["removed_partition"] is False
    assert {r[0] for r in read_partitioned(spark, path, keys=("extract_date",)).select("extract_date").collect()} == {D2}


def test_insert_reads_its_rows_twice_and_a_violation_leaves_the_table(spark, small_frame):
    """Once to sample the ranges, once to write."""
    spark.sql("DROP TABLE IF EXISTS pw_guard")
    shape = small_frame([]).select("terr_cd", "store_id", "order_id", "total_amt", "extract_date").schema
    create_table(spark, "pw_guard", schema=shape)
    rows, seen = counted(spark, small_frame(rows_for(KEYS2, D1, n_per_key=10)))
    insert_clustered(rows, "pw_guard")
    assert seen.value <= 40
    before = sorted_rows(spark.table("pw_guard"))
    assert len(before) == 20
    bad = small_frame(rows_for([*KEYS2, ("", "S")], D1))
    for overwrite in (False, True):
        with pytest.raises(ValueError, match="NOT NULL contract violated: key 'terr_cd'"):
            insert_clustered(bad, "pw_guard", overwrite_partitions=overwrite)
    with pytest.raises(ValueError, match="not all dated"):
        replace_table_date(small_frame(rows_for(KEYS2, D1) + rows_for(KEYS2, D2)), "pw_guard", D1)
    with pytest.raises(ValueError, match="NOT NULL"):
        replace_table_date(bad, "pw_guard", D1)
    spark.catalog.refreshTable("pw_guard")
    assert sorted_rows(spark.table("pw_guard")) == before
    replace_table_date(bad.limit(0), "pw_guard", D1)
    assert spark.table("pw_guard").count() == 0
    spark.sql("DROP TABLE pw_guard")


def test_guard_names_the_first_broken_constraint(spark):
    df = spark.range(5).withColumn("d", F.lit(dt.date(2026, 3, 1)))
    checks = [(F.col("id") > 10, "too large"), (F.col("id") == 3, "three, of all"), (F.col("id").isNull(), "null")]
    assert guarded(df, checks[:1]).count() == 5 and guarded(df, []).count() == 5
    with pytest.raises(ValueError, match="^three, of all$"), violations_raise():
        guarded(df, checks).write.format("noop").mode("overwrite").save()
    with pytest.raises(ZeroDivisionError), violations_raise():
        1 / 0
