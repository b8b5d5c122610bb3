"""K7, F15–F17 — the sequential per-partition export, kept only as a baseline.

This is the slow plan the flagship export replaces: one Spark job per key
tuple, run one after another from the driver.  It exists to measure that
cost against :func:`~partwright.operators.export.export_partitioned`; nothing
else in the engine loops over partitions on the driver.
"""

from __future__ import annotations

import time
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .export import export_single_partition
from .metrics import partition_list

LOOP_REPORT_SCHEMA = T.StructType(
    [
        T.StructField("iterations_completed", T.LongType(), False),
        T.StructField("elapsed_seconds", T.LongType(), True),
        T.StructField("avg_seconds_per_partition", T.DoubleType(), True),
        T.StructField("projected_partitions", T.LongType(), False),
        T.StructField("projected_minutes", T.DoubleType(), True),
    ]
)


def loop_projection(
    spark: SparkSession,
    iterations: int,
    start_ms: int,
    end_ms: int,
    projected_partitions: int = 5000,
) -> DataFrame:
    """F15–F17 — the loop report from two driver clock readings (epoch ms).

    ``elapsed_seconds`` is whole seconds elapsed (truncating, like
    ``TIMESTAMP_DIFF(..., SECOND)``); the average and the projection are
    rounded to 2 places.  Zero iterations give NULL averages instead of a
    division by zero.
    """
    row = spark.createDataFrame(
        [(int(iterations), int(start_ms), int(end_ms), int(projected_partitions))],
        "iterations long, start_ms long, end_ms long, projected long",
    )
    start = F.timestamp_millis("start_ms")
    end = F.timestamp_millis("end_ms")
    ms = F.timestamp_diff("MILLISECOND", start, end).cast("double")
    avg = F.when(F.col("iterations") > 0, ms / F.col("iterations") / F.lit(1000.0))
    return row.select(
        F.col("iterations").alias("iterations_completed"),
        F.timestamp_diff("SECOND", start, end).alias("elapsed_seconds"),
        F.round(avg, 2).alias("avg_seconds_per_partition"),
        F.col("projected").alias("projected_partitions"),
        F.round(avg * F.col("projected") / F.lit(60.0), 2).alias("projected_minutes"),
    )


def sequential_export(
    df: DataFrame,
    root: str,
    *,
    keys: Sequence[str] = ("terr_cd", "store_id", "extract_date"),
    loop_keys: Sequence[str] = ("terr_cd", "store_id"),
    max_partitions: int | None = None,
    projected_partitions: int = 5000,
) -> DataFrame:
    """K7 — export each key tuple with its own job, in key order.

    ``df`` is the already date-filtered source.  ``max_partitions`` bounds
    the loop the way the reference's safety cap does (all tuples when None).
    Returns the loop report (:func:`loop_projection`).
    """
    spark = df.sparkSession
    # Full key tuples in loop-key order, listed once; for a date-filtered
    # frame this is the reference's DISTINCT (terr, store) list.  Bounded by
    # the directory count of the frame.
    order = list(loop_keys) + [k for k in keys if k not in loop_keys]
    combos = partition_list(df, order, limit=max_partitions)
    start = int(time.time() * 1000)
    n = 0
    for combo in combos.toLocalIterator():
        export_single_partition(df, root, {k: combo[k] for k in keys}, keys=keys)
        n += 1
    end = int(time.time() * 1000)
    return loop_projection(spark, n, start, end, projected_partitions)
