"""Two-phase replacement: a run stopped after any step leaves the old tree or the new one; tasks are packed evenly."""

import random
import subprocess
import sys
from pathlib import Path

import pytest
from conftest import D1, D2, parquet_files, rows_for, sorted_rows
from pyspark.sql import functions as F

from partwright import paths
from partwright.operators.commit import Replacement, committed, recover
from partwright.operators.export import export_partitioned, keeps_row_order, placement, prepare_export
from partwright.operators.replace import replace_date
from partwright.sources.hive import read_partitioned

KEYS2 = [("T1", "S1"), ("T1", "S2"), ("T2", "S1")]


class Killed(BaseException):
    pass


def killed_after(step):
    def on_step(done):
        if done.startswith(step):
            raise Killed(done)

    return on_step


STEPS = [("staged", False), ("prepared", False), ("committed", True), ("moved aside", True), ("exchanged", True), ("finished", True)]


@pytest.mark.parametrize("step, new", STEPS)
@pytest.mark.parametrize("mode", ["all", "partitions"])
def test_export_killed_after_a_step(spark, small_frame, tmp_path, mode, step, new):
    out = str(tmp_path / "out")
    old = small_frame(rows_for([*KEYS2, ("T9", "S9")], D1))
    export_partitioned(old, out, overwrite="all")
    rows = small_frame(rows_for(KEYS2, D1, n_per_key=2, start=100))
    with pytest.raises(Killed):
        export_partitioned(rows, out, overwrite=mode, on_step=killed_after(step))
    assert committed(spark, out) == (new and step != "finished")
    recover(spark, out)
    assert recover(spark, out) is None  # nothing is left to settle
    assert [p.name for p in tmp_path.iterdir()] == ["out"]
    got = sorted_rows(read_partitioned(spark, out, columns=old.columns))
    kept = old.filter("terr_cd = 'T9'") if mode == "partitions" else old.limit(0)
    assert got == (sorted_rows(rows.unionByName(kept)) if new else sorted_rows(old))


def test_next_writer_settles_first(spark, small_frame, tmp_path):
    out = str(tmp_path / "out")
    first, second, third = (small_frame(rows_for(KEYS2, d, start=s)) for d, s in ((D1, 0), (D2, 50), (D1, 90)))
    export_partitioned(first, out, overwrite="all")
    with pytest.raises(Killed):
        export_partitioned(second, out, overwrite="all", on_step=killed_after("moved aside"))
    assert not Path(out).exists()  # between the two renames
    export_partitioned(third, out, overwrite="partitions")
    both = sorted_rows(second.unionByName(third))
    assert sorted_rows(read_partitioned(spark, out, columns=first.columns)) == both


def test_failed_write_discards_the_stage(spark, small_frame, tmp_path):
    out = str(tmp_path / "out")
    old = small_frame(rows_for(KEYS2, D1))
    export_partitioned(old, out, overwrite="all")
    before = parquet_files(out)
    bad = old.withColumn("order_id", F.when(F.col("order_id") == "o5", F.raise_error(F.lit("broken"))).otherwise(F.col("order_id")))
    with pytest.raises(Exception, match="broken"):
        export_partitioned(bad, out, overwrite="all")
    assert parquet_files(out) == before and [p.name for p in tmp_path.iterdir()] == ["out"]


@pytest.mark.parametrize("step, gone", [("staged", False), ("committed", True), ("moved aside", True)])
def test_date_removed_by_a_killed_run(spark, small_frame, tmp_path, step, gone):
    out = str(tmp_path / "out")
    rows = small_frame(rows_for(KEYS2, D1) + rows_for(KEYS2, D2))
    export_partitioned(rows, out, overwrite="all", keys=("extract_date",))
    with pytest.raises(Killed):
        replace_date(rows.limit(0), out, D1, on_step=killed_after(step))
    recover(spark, out)
    dates = {r[0] for r in read_partitioned(spark, out, keys=("extract_date",)).select("extract_date").collect()}
    assert dates == ({D2} if gone else {D1, D2})
    assert replace_date(rows.limit(0), out, D1)["removed_partition"] is not gone


def test_in_place_write_needs_no_sibling(spark, small_frame, tmp_path):
    out = str(tmp_path / "out")
    rows = small_frame(rows_for(KEYS2, D1))
    export_partitioned(rows, out, overwrite="all", atomic=False, on_step=killed_after(""))
    assert sorted_rows(read_partitioned(spark, out, columns=rows.columns)) == sorted_rows(rows)
    with pytest.raises(ValueError, match="atomic=False"):
        Replacement(spark, "file:///")


def test_many_directories_are_exchanged_at_once(spark, small_frame, tmp_path):
    out = str(tmp_path / "out")
    keys = [(f"T{i % 5}", f"S {i}%") for i in range(60)]
    old, new = small_frame(rows_for(keys, D1)), small_frame(rows_for(keys[:50], D1, start=500))
    export_partitioned(old, out, overwrite="all")
    export_partitioned(new, out, overwrite="partitions")
    last = old.filter(F.col("store_id").isin([k[1] for k in keys[50:]]))
    assert sorted_rows(read_partitioned(spark, out, columns=old.columns)) == sorted_rows(new.unionByName(last))


def test_process_that_dies_in_the_exchange(spark, small_frame, tmp_path):
    """The writer ends without any Python clean-up (os._exit) between the renames of one directory."""
    out = str(tmp_path / "out")
    export_partitioned(small_frame(rows_for(KEYS2, D1)), out, overwrite="all")
    script = f"""
import os, sys
sys.path[:0] = {[str(Path(__file__).parents[1]), str(Path(__file__).parent)]!r}
from partwright.session import build_session
from partwright.operators.export import export_partitioned
spark = build_session("local[2]", shuffle_partitions=2)
rows = spark.createDataFrame([("T7", "S7", "2026-03-02", "n")], "terr_cd string, store_id string, d string, order_id string")
rows = rows.selectExpr("terr_cd", "store_id", "cast(d as date) extract_date", "order_id")
export_partitioned(rows, {out!r}, overwrite="all", on_step=lambda s: os._exit(9) if s.startswith("moved aside") else None)
"""
    assert subprocess.run([sys.executable, "-c", script], capture_output=True, timeout=180).returncode == 9
    assert not paths.exists(spark, out)
    assert recover(spark, out) == "rolled forward"
    assert [p.parent.parent.parent.name for p in parquet_files(out)] == ["terr_cd=T7"]


# ---------------------------------------------------------------- placement


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_tuples_are_packed_within_one_and_a_half_shares(spark, seed):
    rng = random.Random(seed)
    weights = {f"k{i}": int(1000 / (i + 1) ** rng.choice([0.5, 1, 1.5])) + 1 for i in range(rng.choice([5, 60, 400]))}
    counts = spark.createDataFrame(list(weights.items()), "key string, n long").repartition(3)
    for tasks in (1, 4, 16):
        placed, n = placement(counts, ["key"], F.col("n"), tasks)
        rows = placed.collect()
        assert sorted(r[0] for r in rows) == sorted(weights)
        load = {}
        for key, task in rows:
            load[task] = load.get(task, 0) + weights[key]
        share = sum(weights.values()) / tasks
        assert set(load) <= set(range(n)) and n <= 3 * tasks
        assert max(load.values()) <= max(1.5 * share, max(weights.values())) + 1e-6


def test_export_uses_the_packing(spark, small_frame):
    rows = [r for i in range(40) for r in rows_for([(f"T{i}", "S")], D1, n_per_key=400 // (i + 1), start=1000 * i)]
    prep = prepare_export(small_frame(rows, num_partitions=4), file_cost_rows=0)
    tasks = prep.frame.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n"), F.count_distinct("terr_cd").alias("k"))
    got = [tuple(r)[1:] for r in tasks.collect()]
    assert sum(n for n, _ in got) == len(rows) and sum(k for _, k in got) == 40  # no tuple in two tasks
    share = len(rows) / 8
    assert max(n for n, _ in got) <= max(1.5 * share, 400)
    assert "hashpartitioning(terr_cd" not in prep.frame._jdf.queryExecution().executedPlan().toString().split("BroadcastExchange")[0]
    prep.release()
    # beyond the broadcast bound tuples go by a hash of their keys
    plain = prepare_export(small_frame(rows), placement_broadcast_bytes=0)
    assert "hashpartitioning(terr_cd" in plain.frame._jdf.queryExecution().executedPlan().toString()


def test_rows_of_a_scan_are_not_sorted(spark, small_frame, tmp_path):
    path = str(tmp_path / "src")
    small_frame(rows_for([("HOT", "S1")], D1, n_per_key=900) + rows_for(KEYS2, D1), num_partitions=3).write.parquet(path)
    scan = spark.read.parquet(path).filter("total_amt > 0")
    assert keeps_row_order(scan) and not keeps_row_order(scan.repartition(2))
    prep = prepare_export(scan, max_rows_per_file=100)
    assert "Sort [" not in prep.frame._jdf.queryExecution().executedPlan().toString().split("BroadcastExchange")[0]
    hot = prep.frame.filter("terr_cd = 'HOT'").groupBy(F.spark_partition_id()).count().collect()
    assert sum(r[1] for r in hot) == 900 and max(r[1] for r in hot) <= 100 and len(hot) >= 9
    prep.release()
