"""Sales-shaped views over the shared test tables.

The test data has no sales table, so the registered queries map ``events``
onto the sales shape (every row kept, nothing filtered):

* ``terr_cd``      = ``event_type``                       (5 values)
* ``store_id``     = ``'STORE_' || lpad(user_id mod 10, 4, '0')`` (10 values)
* ``extract_date`` = date of ``ts``                        (one per day)
* ``order_id``     = ``event_id`` as text
* ``customer_id``  = ``'CUST_' || lpad(user_id, 8, '0')``
* ``total_amt``    = ``value`` as ``decimal(18,2)``
* ``created_at``   = ``ts``

``user_id mod 10`` folds users onto ten store labels so one date has at most
50 directories; with raw user ids almost every row would be its own file.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SALES_LIKE_COLUMNS = (
    "terr_cd", "store_id", "extract_date", "order_id", "customer_id", "total_amt", "created_at",
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def sales_like(events: DataFrame) -> DataFrame:
    return events.select(
        F.col("event_type").alias("terr_cd"),
        F.concat(F.lit("STORE_"), F.lpad(F.pmod(F.col("user_id"), F.lit(10)).cast("string"), 4, "0")).alias(
            "store_id"
        ),
        F.col("ts").cast("date").alias("extract_date"),
        F.col("event_id").cast("string").alias("order_id"),
        F.concat(F.lit("CUST_"), F.lpad(F.col("user_id").cast("string"), 8, "0")).alias("customer_id"),
        F.col("value").cast("decimal(18,2)").alias("total_amt"),
        F.col("ts").alias("created_at"),
    )


def sales_like_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sales_like(table(spark, sf_dir, "events"))


# Same view in DuckDB SQL, for the correctness oracle.
SALES_LIKE_SQL = """
SELECT event_type AS terr_cd,
       'STORE_' || lpad(CAST(user_id % 10 AS VARCHAR), 4, '0') AS store_id,
       CAST(ts AS DATE) AS extract_date,
       CAST(event_id AS VARCHAR) AS order_id,
       'CUST_' || lpad(CAST(user_id AS VARCHAR), 8, '0') AS customer_id,
       CAST(value AS DECIMAL(18,2)) AS total_amt,
       ts AS created_at
FROM events
"""
