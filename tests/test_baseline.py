from conftest import D1, rows_for, sorted_rows
from partwright.operators.baseline import loop_projection, sequential_export
from partwright.operators.export import export_partitioned
from partwright.sources.hive import read_partitioned


def test_loop_projection_arithmetic(spark):
    row = loop_projection(spark, 10, 1_000_000, 1_016_576, 5000).first()
    assert row["iterations_completed"] == 10
    assert row["elapsed_seconds"] == 16
    assert row["avg_seconds_per_partition"] == 1.66
    assert row["projected_minutes"] == 138.13


def test_loop_projection_zero_iterations(spark):
    row = loop_projection(spark, 0, 0, 500).first()
    assert row["avg_seconds_per_partition"] is None and row["projected_minutes"] is None


def test_whole_seconds_truncate(spark):
    assert loop_projection(spark, 1, 900, 2100).first()["elapsed_seconds"] == 1


def test_sequential_export_equals_flagship(spark, small_frame, tmp_path):
    keys = [("T1", "S1"), ("T1", "S2"), ("T2", "S1")]
    df = small_frame(rows_for(keys, D1))
    report = sequential_export(df, str(tmp_path / "loop")).first()
    assert report["iterations_completed"] == 3
    export_partitioned(df, str(tmp_path / "flag"), overwrite="all")
    a = read_partitioned(spark, str(tmp_path / "loop"))
    b = read_partitioned(spark, str(tmp_path / "flag"))
    assert sorted_rows(a) == sorted_rows(b)
    first2 = sequential_export(df, str(tmp_path / "loop2"), max_partitions=2).first()
    assert first2["iterations_completed"] == 2
