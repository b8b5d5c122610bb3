"""S4 — deterministic synthetic sales rows.

Every column is a pure function of an integer row index ``idx`` and the
extract date, so a generated partition can be rebuilt bit for bit, on any
executor, after any retry.  The rows are computed by Spark column
expressions over a distributed index (``spark.range`` or an index column of
an existing table); nothing is built on the driver.

The per-column hash is a 60-bit fingerprint of ``idx || suffix``: the first
15 hex digits of MD5, read as a non-negative BIGINT (no ABS needed, so no
overflow on the minimum value).  It is reproducible in plain SQL
(``('0x' || substr(md5(s), 1, 15))::BIGINT`` in DuckDB), which is what the
correctness oracle uses.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import add_seconds, date_literal, midnight
from ..schema import MONEY, SALES_SCHEMA

# The reference's lookup lists, in index order.
CATEGORIES = [
    "Electronics", "Apparel", "Home & Kitchen", "Health & Beauty",
    "Sports & Outdoors", "Groceries", "Toys & Games", "Automotive",
]
PAYMENT_METHODS = ["CREDIT_CARD", "DEBIT_CARD", "PAYPAL", "APPLE_PAY", "GOOGLE_PAY", "GIFT_CARD"]
ORDER_STATUSES = ["COMPLETED", "SHIPPED", "DELIVERED", "PROCESSING"]

# Cardinalities and ranges of the generated columns.
N_TERRITORIES = 20
N_STORES = 250
N_CUSTOMERS = 500_000
N_SKUS = 5_000
MAX_QUANTITY = 10
PRICE_STEPS = 49_500       # 5.00 + (h mod 49500) / 100  ->  5.00 .. 499.99
DISCOUNT_STEPS = 30        # (h mod 30) / 100            ->  0.00 .. 0.29
TAX_RATE = 0.07
SECONDS_PER_DAY = 86_400


def fingerprint(idx: Column, suffix: str) -> Column:
    """Non-negative 60-bit hash of ``concat(idx, suffix)``."""
    digest = F.md5(F.concat(idx.cast("string"), F.lit(suffix)))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")


def _label(prefix: str, idx: Column, suffix: str, modulus: int, width: int) -> Column:
    number = (F.lit(1) + fingerprint(idx, suffix) % modulus).cast("string")
    return F.concat(F.lit(prefix), F.lpad(number, width, "0"))


def _pick(values: list[str], idx: Column, suffix: str) -> Column:
    """``[v0, v1, ...][OFFSET(h mod len)]`` (0-based lookup)."""
    return F.array(*[F.lit(v) for v in values])[(fingerprint(idx, suffix) % len(values)).cast("int")]


def sales_rows(indices: DataFrame, extract_date, idx_col: str = "idx") -> DataFrame:
    """Turn a frame with an integer ``idx_col`` into sales rows of one date."""
    idx = F.col(idx_col)
    day = date_literal(extract_date)
    qty = F.lit(1) + fingerprint(idx, "_qty") % MAX_QUANTITY
    price = F.lit(5.0) + (fingerprint(idx, "_price") % PRICE_STEPS).cast("double") / F.lit(100.0)
    disc = (fingerprint(idx, "_disc") % DISCOUNT_STEPS).cast("double") / F.lit(100.0)
    gross = qty.cast("double") * price

    def money(x: Column) -> Column:
        return F.round(x.cast(MONEY), 2).cast(MONEY)

    out = indices.select(
        _label("TERR_", idx, "_terr", N_TERRITORIES, 2).alias("terr_cd"),
        _label("STORE_", idx, "_store", N_STORES, 4).alias("store_id"),
        day.alias("extract_date"),
        F.md5(F.concat_ws("/", day.cast("string"), idx.cast("string"))).alias("order_id"),
        _label("CUST_", idx, "_cust", N_CUSTOMERS, 8).alias("customer_id"),
        _label("SKU_", idx, "_sku", N_SKUS, 6).alias("product_sku"),
        _pick(CATEGORIES, idx, "_cat").alias("category"),
        qty.cast("long").alias("quantity"),
        money(price).alias("unit_price"),
        money(disc).alias("discount_pct"),
        money(gross * F.lit(TAX_RATE)).alias("tax_amt"),
        money(gross * (F.lit(1.0) - disc) + gross * F.lit(TAX_RATE)).alias("total_amt"),
        _pick(PAYMENT_METHODS, idx, "_pay").alias("payment_method"),
        _pick(ORDER_STATUSES, idx, "_status").alias("order_status"),
        add_seconds(midnight(day), fingerprint(idx, "_time") % SECONDS_PER_DAY).alias("created_at"),
    )
    return out.select([F.col(f.name).cast(f.dataType).alias(f.name) for f in SALES_SCHEMA.fields])


def generate_sales(spark: SparkSession, n_rows: int, extract_date, num_partitions: int | None = None) -> DataFrame:
    """``n_rows`` sales rows with idx = 1..n_rows (no upper cap)."""
    ids = spark.range(1, int(n_rows) + 1, numPartitions=num_partitions).withColumnRenamed("id", "idx")
    return sales_rows(ids, extract_date)
