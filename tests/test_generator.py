import datetime as dt
from decimal import Decimal

import duckdb
from pyspark.sql import functions as F

import __spark_entry__ as E
from partwright.schema import SALES_SCHEMA
from partwright.sources.synthetic import generate_sales


def test_schema_determinism_and_ranges(spark):
    a = generate_sales(spark, 20000, "2026-03-01", num_partitions=4)
    assert [f.name for f in a.schema.fields] == SALES_SCHEMA.names
    assert a.schema["unit_price"].dataType.simpleString() == "decimal(38,9)"
    b = generate_sales(spark, 20000, "2026-03-01", num_partitions=7)
    assert a.exceptAll(b).count() == 0
    r = a.agg(
        F.min("unit_price"), F.max("unit_price"), F.min("discount_pct"), F.max("discount_pct"),
        F.min("quantity"), F.max("quantity"), F.countDistinct("terr_cd"), F.countDistinct("store_id"),
        F.countDistinct("category"), F.countDistinct("payment_method"), F.countDistinct("order_status"),
        F.min("created_at"), F.max("created_at"), F.countDistinct("order_id"),
    ).first()
    assert Decimal("5.00") <= r[0] and r[1] <= Decimal("499.99")
    assert r[2] == Decimal("0") and r[3] == Decimal("0.29")
    assert (r[4], r[5]) == (1, 10)
    assert (r[6], r[7], r[8], r[9], r[10]) == (20, 250, 8, 6, 4)
    assert r[11] >= dt.datetime(2026, 3, 1) and r[12] < dt.datetime(2026, 3, 2)
    assert r[13] == 20000
    # total = qty*price*(1-disc) + tax, within rounding
    bad = a.filter(
        F.abs(F.col("total_amt") - (F.col("quantity") * F.col("unit_price") * (1 - F.col("discount_pct")) + F.col("tax_amt")))
        > Decimal("0.02")
    ).count()
    assert bad == 0


def test_generator_matches_sql_formulation(spark):
    sf = "/root/testdata/sf0.001"
    got = sorted(tuple(r) for r in E.q_generate_sales(spark, sf).collect())
    con = duckdb.connect()
    con.execute(f"CREATE VIEW orders AS SELECT * FROM read_parquet('{sf}/orders.parquet')")
    res = con.execute(E.oracle_sql()["generate_sales"])
    cols = [d[0] for d in res.description]
    assert cols == SALES_SCHEMA.names
    want = sorted(tuple(r) for r in res.fetchall())
    assert got == want
