"""The sales fact table: schema, partition keys, DDL.

Fixed values that must equal the reference's table definition: the column
list and order, their types, NOT NULL on every column, the partition column
``extract_date`` and the clustering columns ``terr_cd, store_id``.
"""

from __future__ import annotations

from pyspark.sql import types as T

# Default export keys (Hive directory levels, in this order).
KEYS: tuple[str, ...] = ("terr_cd", "store_id", "extract_date")
DATE_COLUMN = "extract_date"
CLUSTER_COLUMNS: tuple[str, ...] = ("terr_cd", "store_id")
AMOUNT_COLUMN = "total_amt"

MONEY = T.DecimalType(38, 9)

# The reference's 15 columns, in order, all NOT NULL.
SALES_SCHEMA = T.StructType(
    [
        T.StructField("terr_cd", T.StringType(), False),
        T.StructField("store_id", T.StringType(), False),
        T.StructField("extract_date", T.DateType(), False),
        T.StructField("order_id", T.StringType(), False),
        T.StructField("customer_id", T.StringType(), False),
        T.StructField("product_sku", T.StringType(), False),
        T.StructField("category", T.StringType(), False),
        T.StructField("quantity", T.LongType(), False),
        T.StructField("unit_price", MONEY, False),
        T.StructField("discount_pct", MONEY, False),
        T.StructField("tax_amt", MONEY, False),
        T.StructField("total_amt", MONEY, False),
        T.StructField("payment_method", T.StringType(), False),
        T.StructField("order_status", T.StringType(), False),
        T.StructField("created_at", T.TimestampType(), False),
    ]
)

TABLE_COMMENT = "Sales rows by extract date, clustered by territory and store"


def ddl_columns(schema: T.StructType) -> str:
    """Column list for ``CREATE TABLE``; NOT NULL kept as declared."""
    parts = []
    for field in schema.fields:
        null = "" if field.nullable else " NOT NULL"
        parts.append(f"`{field.name}` {field.dataType.simpleString()}{null}")
    return ",\n  ".join(parts)
