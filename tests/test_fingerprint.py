"""Fingerprints of key tuples: independent of order and layout, and they see what totals miss."""

import pytest
from conftest import D1, D2, rows_for, sorted_rows
from pyspark.sql import functions as F

from partwright.operators.export import export_partitioned
from partwright.plans.fingerprint import fingerprint_diff, tuple_fingerprints
from partwright.plans.reconcile import reconcile

KEYS2 = [("T1", "S1"), ("T1", "S2"), ("T2", "S1")]


def test_fingerprints_depend_on_the_rows_only(spark, small_frame):
    rows = rows_for(KEYS2, D1, n_per_key=30)
    a, b = small_frame(rows, num_partitions=1), small_frame(rows[::-1], num_partitions=7)
    assert sorted_rows(tuple_fingerprints(a)) == sorted_rows(tuple_fingerprints(b.select(*b.columns[::-1])))
    twice = small_frame([*rows, rows[0]])
    assert sorted_rows(tuple_fingerprints(a)) != sorted_rows(tuple_fingerprints(twice))
    # NULL is a value in its place
    df = spark.createDataFrame([("k", "x", None), ("l", None, "x")], "key string, a string, b string")
    one, two = tuple_fingerprints(df, ["key"]).select("hash_sum", "hash_xor").collect()
    assert one.hash_sum != two.hash_sum and one.hash_xor != two.hash_xor
    with pytest.raises(ValueError, match="maps"):
        tuple_fingerprints(df.withColumn("m", F.create_map("a", "b")), ["key"])


def test_diff_names_tuples_whose_changes_cancel(spark, small_frame, tmp_path):
    out = str(tmp_path / "o")
    source = small_frame(rows_for(KEYS2, D1, n_per_key=5) + rows_for([("T8", "S8")], D1, start=500) + rows_for(KEYS2, D2, start=900))
    delta = F.when(F.col("order_id") == "o0", 1).when(F.col("order_id") == "o1", -1).otherwise(0)
    changed = source.withColumn("total_amt", (F.col("total_amt") + delta).cast("decimal(18,2)"))
    changed = changed.withColumn("store_id", F.when(F.col("terr_cd") == "T8", "S9").otherwise(F.col("store_id")))
    changed = changed.filter("order_id <> 'o10'")
    export_partitioned(changed, out, overwrite="all")
    got = {(r.terr_cd, r.store_id): (r.source_rows, r.exported_rows, r.difference) for r in fingerprint_diff(spark, source, out, D1).collect()}
    assert got == {
        ("T1", "S1"): (5, 5, "content"), ("T2", "S1"): (5, 4, "rows"), ("T8", "S8"): (3, 0, "missing"), ("T8", "S9"): (0, 3, "extra")
    }
    assert fingerprint_diff(spark, source, out, D2).collect() == []
    # the totals of the whole date see none of the cancelling change alone
    only = source.withColumn("total_amt", (F.col("total_amt") + delta).cast("decimal(18,2)"))
    export_partitioned(only, out, overwrite="all")
    assert reconcile(spark, source, out, D1).first()["all_ok"]
    assert [r.difference for r in fingerprint_diff(spark, source, out, D1).collect()] == ["content"]


def test_diff_of_an_absent_export(spark, small_frame, tmp_path):
    source = small_frame(rows_for(KEYS2, D1))
    export_partitioned(source.limit(0), str(tmp_path / "o"), overwrite="all")
    assert {r.difference for r in fingerprint_diff(spark, source, str(tmp_path / "o")).collect()} == {"missing"}
