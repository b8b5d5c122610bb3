"""V4 — the export run: read, check, export, report.

The report is one row: rows and amount written (recorded by an Observation
while the write runs, no second scan), key tuples, hot tuples split, writer
tasks, elapsed wall time from the driver clock, the SLA target and whether
it was met.
"""

from __future__ import annotations

import time
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..operators.export import export_partitioned
from ..schema import AMOUNT_COLUMN, KEYS
from ..sources.warehouse import read_source

DEFAULT_SLA_SECONDS = 180

RUN_REPORT_SCHEMA = T.StructType(
    [
        T.StructField("output_path", T.StringType(), False),
        T.StructField("rows_exported", T.LongType(), True),
        T.StructField("sum_total_amt", T.DecimalType(38, 2), True),
        T.StructField("partitions", T.LongType(), True),
        T.StructField("hot_partitions", T.LongType(), True),
        T.StructField("writer_tasks", T.LongType(), True),
        T.StructField("elapsed_seconds", T.DoubleType(), False),
        T.StructField("sla_seconds", T.LongType(), False),
        T.StructField("sla_met", T.BooleanType(), False),
    ]
)


def run_export(
    spark: SparkSession,
    source,
    output_path: str,
    extract_date,
    *,
    fmt: str = "parquet",
    options=None,
    filter_option: str | None = None,
    keys: Sequence[str] = KEYS,
    date_column: str = "extract_date",
    overwrite: str = "all",
    amount: str = AMOUNT_COLUMN,
    strategy: str = "split",
    max_rows_per_file: int | None = None,
    sort_within: Sequence[str] = (),
    sla_seconds: int = DEFAULT_SLA_SECONDS,
) -> DataFrame:
    """S1 → K1 → V4 for one date; returns the one-row run report."""
    start = time.monotonic()
    df = read_source(
        spark,
        source,
        fmt=fmt,
        options=options,
        extract_date=extract_date,
        date_column=date_column,
        filter_option=filter_option,
    )
    res = export_partitioned(
        df,
        output_path,
        overwrite=overwrite,
        keys=keys,
        strategy=strategy,
        max_rows_per_file=max_rows_per_file,
        sort_within=sort_within,
        # Rounded by Spark; a type that has no exact sum raises before anything is written.
        observe_sum=amount if amount in df.columns else None,
    )
    elapsed = time.monotonic() - start
    total = res.observed.get("sum")
    row = (
        output_path,
        res.observed.get("rows", res.rows),
        total,
        res.tuples,
        res.hot_tuples,
        res.num_tasks,
        float(elapsed),
        int(sla_seconds),
        elapsed <= sla_seconds,
    )
    return spark.createDataFrame([row], RUN_REPORT_SCHEMA)
