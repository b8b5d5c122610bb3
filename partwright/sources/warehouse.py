"""S1 — read a source table for one extract date with the filter pushed down.

The source is a table name known to the catalog, a path, or an already built
DataFrame.  The date predicate is a plain Column comparison against a DATE
literal, so Catalyst pushes it into the scan: ``PushedFilters`` for Parquet
body columns, ``PartitionFilters`` (directory pruning) when the table is
partitioned by the date column.  No column is read that the caller's later
projection does not need: column pruning is left to the optimizer.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.dates import date_literal, parse_date


def date_equals(column: str | Column, extract_date) -> Column:
    """``column = DATE 'd'``; a malformed date raises."""
    col = F.col(column) if isinstance(column, str) else column
    return col == date_literal(extract_date)


def read_source(
    spark: SparkSession,
    source: str | DataFrame,
    *,
    fmt: str = "parquet",
    options: Mapping[str, str] | None = None,
    schema: T.StructType | None = None,
    extract_date=None,
    date_column: str = "extract_date",
    filter_option: str | None = None,
) -> DataFrame:
    """Load ``source`` and keep the rows of ``extract_date`` (all when None).

    ``fmt`` is any Spark data source (``parquet``, ``orc``, a connector
    name).  ``filter_option`` names a reader option through which a
    connector accepts a server-side row filter as text; the date predicate
    is then passed there as well as a Column filter.  A string source that names a catalog table is read with
    ``spark.table``; otherwise it is a path/table id passed to ``load``.
    """
    if isinstance(source, DataFrame):
        df = source
    elif fmt == "table" or (fmt == "catalog"):
        df = spark.table(source)
    else:
        reader = spark.read.format(fmt)
        if schema is not None:
            reader = reader.schema(schema)
        opts = dict(options or {})
        if extract_date is not None and filter_option and filter_option not in opts:
            # The date is parsed first, so nothing but an ISO date is spliced.
            day = parse_date(extract_date).isoformat()
            opts[filter_option] = f"{date_column} = '{day}'"
        for key, value in opts.items():
            reader = reader.option(key, value)
        df = reader.load(source)
    if extract_date is not None:
        df = df.filter(date_equals(date_column, extract_date))
    return df
