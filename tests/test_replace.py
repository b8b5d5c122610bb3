import pytest
from pyspark.sql import functions as F

from conftest import D1, D2, parquet_files, rows_for, sorted_rows
from partwright.operators.export import export_partitioned
from partwright.operators.replace import replace_date
from partwright.sources.hive import read_partitioned

KEYS2 = [("T1", "S1"), ("T2", "S2")]


def _table(spark, small_frame, path):
    df = small_frame(rows_for(KEYS2, D1) + rows_for(KEYS2, D2, start=100))
    export_partitioned(df, path, overwrite="all", keys=("extract_date",))
    return df


def test_replace_date_rows(spark, small_frame, tmp_path):
    path = str(tmp_path / "t")
    _table(spark, small_frame, path)
    new = small_frame(rows_for([("T9", "S9")], D1, n_per_key=2, start=500))
    out = replace_date(new, path, D1)
    assert out["rows"] == 2
    back = read_partitioned(spark, path, keys=("extract_date",))
    assert back.filter(F.col("extract_date") == D1).count() == 2
    assert back.filter(F.col("extract_date") == D2).count() == 6
    # idempotent: same replacement again, same table
    first = sorted_rows(back)
    replace_date(new, path, D1)
    assert sorted_rows(read_partitioned(spark, path, keys=("extract_date",))) == first


def test_replace_date_with_nothing_empties_that_date(spark, small_frame, tmp_path):
    path = str(tmp_path / "t")
    df = _table(spark, small_frame, path)
    out = replace_date(df.filter(F.lit(False)), path, D1)
    assert out["removed_partition"] is True
    back = read_partitioned(spark, path, keys=("extract_date",))
    assert back.filter(F.col("extract_date") == D1).count() == 0
    assert back.filter(F.col("extract_date") == D2).count() == 6
    # a dynamic overwrite by an empty frame alone would have kept D1
    path2 = str(tmp_path / "t2")
    _table(spark, small_frame, path2)
    export_partitioned(df.filter(F.lit(False)), path2, overwrite="partitions", keys=("extract_date",))
    assert read_partitioned(spark, path2, keys=("extract_date",)).filter(F.col("extract_date") == D1).count() == 6


def test_replace_refuses_rows_of_other_dates(spark, small_frame, tmp_path):
    path = str(tmp_path / "t")
    _table(spark, small_frame, path)
    before = parquet_files(path)
    mixed = small_frame(rows_for(KEYS2, D1) + rows_for(KEYS2, D2))
    with pytest.raises(ValueError, match="not all dated"):
        replace_date(mixed, path, D1)
    assert parquet_files(path) == before


def test_replace_date_multi_level_drops_stale_tuples(spark, small_frame, tmp_path):
    path = str(tmp_path / "t")
    keys = ("extract_date", "terr_cd")
    df = small_frame(rows_for(KEYS2, D1) + rows_for(KEYS2, D2, start=100))
    export_partitioned(df, path, overwrite="all", keys=keys)
    new = small_frame(rows_for([("T1", "S1")], D1, n_per_key=1, start=900))
    replace_date(new, path, D1, keys=keys)
    back = read_partitioned(spark, path, keys=keys)
    d1 = back.filter(F.col("extract_date") == D1)
    assert d1.count() == 1  # T2 under D1 is gone, as after DELETE + INSERT
    assert back.filter(F.col("extract_date") == D2).count() == 6


def test_replace_refuses_rows_read_from_the_target(spark, small_frame, tmp_path):
    path = str(tmp_path / "t")
    _table(spark, small_frame, path)
    before = parquet_files(path)
    own = read_partitioned(spark, path, keys=("extract_date",)).filter(F.col("extract_date") == D1)
    with pytest.raises(ValueError, match="read from it"):
        replace_date(own, path, D1)
    assert parquet_files(path) == before


def test_replace_with_several_keys_writes_one_file_per_tuple(spark, small_frame, tmp_path):
    path, keys = str(tmp_path / "t"), ("extract_date", "terr_cd", "store_id")
    many = [(f"T{i}", f"S{k}") for i in range(5) for k in range(3)]
    export_partitioned(small_frame(rows_for(many, D1) + rows_for(many, D2)), path, overwrite="all", keys=keys)
    replace_date(small_frame(rows_for(many[:7], D1, n_per_key=9)).repartition(8), path, D1, keys=keys)
    files = [str(f) for f in parquet_files(path)]
    assert sum(str(D1) in f for f in files) == 7 and sum(str(D2) in f for f in files) == 15
    back = read_partitioned(spark, path, keys=keys)
    assert back.filter(F.col("extract_date") == D1).count() == 63


def test_malformed_dates_are_refused_without_ansi(spark):
    from partwright.functions.dates import date_literal

    with pytest.raises(ValueError):
        date_literal("2024-13-45")
