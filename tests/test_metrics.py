from decimal import Decimal

from pyspark.sql import functions as F

from conftest import D1, rows_for
from partwright.operators.metrics import generation_metrics, not_null_contract, partition_list, source_metrics


def test_source_and_generation_metrics(small_frame):
    df = small_frame(rows_for([("T1", "S1"), ("T1", "S2"), ("T2", "S1")], D1, n_per_key=2))
    m = source_metrics(df).first()
    assert (m["total_rows"], m["terr_count"], m["store_count"]) == (6, 2, 2)
    assert m["sum_total_amt"] == sum(r[4] for r in rows_for([("a", "b")] * 3, D1, n_per_key=2))
    g = generation_metrics(df).first()
    assert g["distinct_partition_combinations"] == 3
    assert source_metrics(df).schema["sum_total_amt"].dataType.simpleString() == "decimal(38,2)"


def test_metrics_of_nothing(small_frame):
    df = small_frame(rows_for([("T1", "S1")], D1)).filter(F.lit(False))
    m = source_metrics(df).first()
    assert m["total_rows"] == 0 and m["terr_count"] == 0 and m["sum_total_amt"] is None


def test_not_null_contract(small_frame):
    rows = rows_for([("T1", "S1")], D1, n_per_key=3)
    rows.append(("T1", "", D1, "x", None))
    rows.append(("T1", "S1", D1, None, Decimal("1.00")))
    row = not_null_contract(small_frame(rows), keys=("terr_cd", "store_id", "extract_date")).first()
    assert row["null_total_amt"] == 1 and row["null_store_id"] == 1 and row["null_order_id"] == 1
    assert row["violations"] == 3 and row["ok"] is False
    clean = not_null_contract(small_frame(rows[:3])).first()
    assert clean["ok"] and clean["total_rows"] == 3


def test_partition_list_ordered_and_limited(small_frame):
    keys = [("T2", "S1"), ("T1", "S2"), ("T1", "S1"), ("T3", "S0")]
    df = small_frame(rows_for(keys, D1))
    assert [tuple(r) for r in partition_list(df).collect()] == sorted(keys)
    assert [tuple(r) for r in partition_list(df, limit=2).collect()] == sorted(keys)[:2]
