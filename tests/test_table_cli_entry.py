import json

import pytest
from pyspark.sql import types as T
from pyspark.sql import functions as F

import __spark_entry__ as E
from conftest import D1, rows_for
from partwright.cli import main as cli_main
from partwright.operators.table import create_table, insert_clustered


def test_create_table_idempotent_and_insert(spark, small_frame):
    df = small_frame(rows_for([("T1", "S1"), ("T2", "S2")], D1))
    schema = df.select("terr_cd", "store_id", "order_id", "total_amt", "extract_date").schema
    create_table(spark, "pw_t1", schema=schema)
    create_table(spark, "pw_t1", schema=schema)
    insert_clustered(df, "pw_t1")
    assert spark.table("pw_t1").count() == 6
    insert_clustered(df.filter(F.col("terr_cd") == "T1"), "pw_t1", overwrite_partitions=True)
    assert spark.table("pw_t1").count() == 3


def test_insert_refuses_nulls(spark, small_frame):
    rows = rows_for([("T1", "S1")], D1)
    rows.append(("T1", "S1", D1, None, None))
    df = small_frame(rows)
    strict = T.StructType([T.StructField(f.name, f.dataType, False) for f in df.schema.fields])
    create_table(spark, "pw_t2", schema=strict)
    with pytest.raises(ValueError, match="NOT NULL"):
        insert_clustered(df, "pw_t2")
    # columns that the table lets be null may be null, keys may not
    create_table(spark, "pw_t3", schema=df.schema)
    insert_clustered(df, "pw_t3")
    assert spark.table("pw_t3").filter("order_id is null").count() == 1
    with pytest.raises(ValueError, match="NOT NULL"):
        insert_clustered(small_frame(rows_for([("T1", "")], D1)), "pw_t3")


def test_cli_export_and_verify(spark, small_frame, tmp_path, capsys):
    src = str(tmp_path / "src")
    small_frame(rows_for([("T1", "S1"), ("T2", "S2")], D1)).write.parquet(src)
    out = str(tmp_path / "out")
    code = cli_main(
        ["--source_table", src, "--extract_date", "2026-03-01", "--output_path", out, "--verify",
         "--sort_within", "order_id"]
    )
    lines = [json.loads(x) for x in capsys.readouterr().out.strip().splitlines()]
    assert code == 0
    assert lines[0]["rows_exported"] == 6 and lines[0]["partitions"] == 2
    assert lines[1]["check"] == "verify" and lines[1]["verified"] is True
    assert lines[1]["parquet_files"] == 2 and lines[1]["all_ok"] is True


def test_entry_and_registry(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["terr_cd", "store_id", "extract_date", "order_id", "customer_id", "total_amt", "created_at"]
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert set(E._QUERIES) == set(E._ORACLE)  # queries of the subpackage may be beyond SQL


def test_cli_verify_fails_on_tampered_export(spark, small_frame, tmp_path, capsys):
    from conftest import parquet_files

    src = str(tmp_path / "src")
    small_frame(rows_for([("T1", "S1"), ("T2", "S2")], D1)).write.parquet(src)
    out = str(tmp_path / "out")
    assert cli_main(["--source_table", src, "--extract_date", "2026-03-01", "--output_path", out]) == 0
    parquet_files(out)[0].unlink()
    capsys.readouterr()
    # re-verify only: export again into another path, then check the tampered one
    from partwright.plans.reconcile import verify_export
    from partwright.sources.warehouse import read_source

    row = verify_export(spark, read_source(spark, src), out, "2026-03-01").first()
    assert row["verified"] is False and row["missing_partitions"] == 1
    row = verify_export(spark, read_source(spark, src), str(tmp_path / "nothing"), "2026-03-01").first()
    assert row["verified"] is False and row["layout_ok"] is False and row["all_ok"] is None


def _dated_table(spark, small_frame, name):
    from conftest import D1, D2, rows_for
    from partwright.operators.table import create_table, insert_clustered

    spark.sql(f"DROP TABLE IF EXISTS {name}")
    both = small_frame(rows_for([("T1", "S1")], D1) + rows_for([("T1", "S1")], D2, start=50))
    schema = both.select(*[c for c in both.columns if c != "extract_date"], "extract_date").schema
    create_table(spark, name, schema=schema, comment="it's a table")
    insert_clustered(both, name)
    return D1, D2


def test_overwrite_of_partitions_keeps_other_dates(spark, small_frame):
    from conftest import rows_for
    from partwright.operators.table import insert_clustered

    d1, d2 = _dated_table(spark, small_frame, "pw_overwrite")
    insert_clustered(small_frame(rows_for([("T9", "S9")], d1, n_per_key=1)), "pw_overwrite", overwrite_partitions=True)
    counts = {r["extract_date"]: r["count"] for r in spark.table("pw_overwrite").groupBy("extract_date").count().collect()}
    assert counts == {d1: 1, d2: 3}
    insert_clustered(small_frame([]), "pw_overwrite", overwrite_partitions=True)
    assert spark.table("pw_overwrite").count() == 4


def test_replace_date_of_a_table(spark, small_frame):
    import datetime as dt

    import pytest
    from conftest import rows_for
    from partwright.operators.table import replace_table_date

    d1, d2 = _dated_table(spark, small_frame, "pw_replace")
    d3 = dt.date(2026, 3, 9)
    for day, n in ((d1, 2), (d1, 2), (d3, 1)):
        replace_table_date(small_frame(rows_for([("T9", "S9")], day, n_per_key=n)), "pw_replace", day)
    counts = {r["extract_date"]: r["count"] for r in spark.table("pw_replace").groupBy("extract_date").count().collect()}
    assert counts == {d1: 2, d2: 3, d3: 1}
    replace_table_date(small_frame([]), "pw_replace", d2)
    assert spark.table("pw_replace").filter(f"extract_date = '{d2}'").isEmpty()
    assert spark.table("pw_replace").count() == 3
    with pytest.raises(ValueError, match="not all dated"):
        replace_table_date(small_frame(rows_for([("T", "S")], d1)), "pw_replace", d2)
    with pytest.raises(ValueError, match="NOT NULL"):
        replace_table_date(small_frame(rows_for([("", "S")], d1)), "pw_replace", d1)
    assert spark.table("pw_replace").count() == 3


def test_cli_verify_only(spark, small_frame, tmp_path, capsys):
    from conftest import D1, D2, rows_for

    from partwright.cli import main

    source, out = str(tmp_path / "src"), str(tmp_path / "out")
    small_frame(rows_for([("A", "1"), ("B", "2")], D1) + rows_for([("A", "1")], D2)).write.parquet(source)
    base = ["--source_table", source, "--output_path", out]
    assert main([*base, "--extract_date", str(D1), "--verify"]) == 0
    assert main([*base, "--extract_date", str(D2), "--overwrite", "partitions", "--verify"]) == 0
    for day in (D1, D2):
        assert main([*base, "--extract_date", str(day), "--verify_only"]) == 0
    assert main([*base, "--extract_date", "2026-03-07", "--verify_only"]) == 1


def test_scratch_needs_a_shared_folder_on_a_cluster():
    import pytest
    from partwright.session import scratch_root

    class Nothing:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return self

        def get(self, key, default=None):
            return default

        sparkContext = property(lambda self: self)
        conf = property(lambda self: self)

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_root(Nothing())
