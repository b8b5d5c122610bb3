"""Clustering along a Z-order curve: the curve itself, the files filters have to read, and rows kept whole."""

import pytest
from conftest import D1, rows_for, sorted_rows
from pyspark.sql import functions as F

from partwright.operators.table import Z_BITS, create_table, insert_clustered, skipping_report, z_value


def test_z_value_interleaves_bits(spark):
    rows = [(a, b) for a in (0, 1, 2, 5, 65535) for b in (0, 1, 3, 40000)]
    df = spark.createDataFrame(rows, "a long, b long")
    for a, b, z in df.select("a", "b", z_value([F.col("a"), F.col("b")])).collect():
        want = sum((a >> i & 1) << (2 * i + 1) | (b >> i & 1) << (2 * i) for i in range(Z_BITS))
        assert z == want


def test_filters_on_either_column_skip_files(spark, small_frame, tmp_path):
    keys = [(f"T{i:02d}", f"S{k:03d}") for i in range(16) for k in range(16)]
    df = small_frame(rows_for(keys, D1, n_per_key=4), num_partitions=4).select("order_id", "total_amt", "terr_cd", "store_id", "extract_date")
    reads = {}
    for curve in (None, "z"):
        name = f"pw_cluster_{curve}".lower()
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        create_table(spark, name, schema=df.schema, location=str(tmp_path / name))
        insert_clustered(df, name, curve=curve, ranges=16)
        assert sorted_rows(spark.table(name).select(*df.columns)) == sorted_rows(df)
        reads[curve] = {r.column: (r.reads / r["values"], r.files) for r in skipping_report(spark, name).collect()}
        spark.sql(f"DROP TABLE {name}")
    (linear, files), (both, more) = reads[None]["store_id"], reads["z"]["store_id"]
    assert files > 10 and more > 10
    assert linear > 0.6 * files  # one after the other: a store is in nearly all files
    assert both < 0.5 * more and reads["z"]["terr_cd"][0] < 0.5 * more


def test_copies_span_ranges_of_a_scan(spark, tmp_path):
    path = str(tmp_path / "src")
    one = "SELECT 'o' AS order_id, CAST(1 AS DECIMAL(18,2)) AS total_amt, 'T' AS terr_cd, 'S' AS store_id, DATE '2026-03-01' AS extract_date"
    spark.sql(one).crossJoin(spark.range(4000).select()).repartition(4).write.parquet(path)
    rows = spark.read.parquet(path)
    for curve in (None, "z"):
        spark.sql("DROP TABLE IF EXISTS pw_copies")
        create_table(spark, "pw_copies", schema=rows.schema, location=str(tmp_path / f"t{curve}"))
        insert_clustered(rows, "pw_copies", curve=curve, ranges=8)
        sizes = [r[1] for r in spark.table("pw_copies").groupBy(F.col("_metadata.file_path")).count().collect()]
        assert sum(sizes) == 4000 and len(sizes) >= 6 and max(sizes) < 1200
    with pytest.raises(ValueError, match="curve"):
        insert_clustered(rows, "pw_copies", curve="hilbert")
    spark.sql("DROP TABLE pw_copies")
