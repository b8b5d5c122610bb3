"""K5, K8, K9, T4 — the partitioned, clustered fact table.

``CREATE TABLE IF NOT EXISTS ... USING parquet PARTITIONED BY (extract_date)``
with the fixed schema and a table comment.  Spark file tables do not
enforce NOT NULL, so rows are held against it while an insert reads them.  Clustering by
``terr_cd, store_id`` deals rows out by ranges of (date, territory, store) and sorts
each range: a file covers few territories, its row groups carry tight min/max
statistics and point filters on those columns skip files and row groups.  That order
serves filters that name the territory; along a Z-order curve (``curve="z"``) files are small
boxes in both columns, so a filter on the store alone skips files as well.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.dates import date_literal, parse_date
from ..schema import CLUSTER_COLUMNS, DATE_COLUMN, SALES_SCHEMA, TABLE_COMMENT, ddl_columns
from .export import keeps_row_order
from .guard import guarded, null_or_empty, violations_raise

# Table property that lists the NOT NULL columns; the catalog itself does not keep them for file tables.
NOT_NULL_PROPERTY = "partwright.not_null"
# Bits of each column's rank on the curve, and the most distinct values that are ranked (their table is broadcast).
Z_BITS = 16
Z_VALUES = 1_000_000
DYNAMIC = ("spark.sql.sources.partitionOverwriteMode", "dynamic")


def _quoted(name: str) -> str:
    """A table name with each part quoted; parts hold no dots."""
    return ".".join("`" + part.strip("`").replace("`", "``") + "`" for part in name.split("."))


def _text(value: str) -> str:
    """A SQL string literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


@contextmanager
def _setting(spark: SparkSession, key: str, value: str):
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def create_table(
    spark: SparkSession,
    name: str,
    *,
    schema: T.StructType = SALES_SCHEMA,
    partition_by: Sequence[str] = (DATE_COLUMN,),
    location: str | None = None,
    comment: str = TABLE_COMMENT,
) -> None:
    """K8 — create the table if it does not exist (idempotent)."""
    loc = f"\nLOCATION {_text(location)}" if location else ""
    required = [f.name for f in schema.fields if not f.nullable]
    parts = ", ".join("`" + c.replace("`", "``") + "`" for c in partition_by)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {_quoted(name)} (\n  {ddl_columns(schema)}\n)\n"
        f"USING parquet\nPARTITIONED BY ({parts}){loc}\nCOMMENT {_text(comment)}\n"
        f"TBLPROPERTIES ({_text(NOT_NULL_PROPERTY)} = {_text(json.dumps(required))})"
    )


def z_value(ranks: Sequence[Column], bits: int = Z_BITS) -> Column:
    """The bits of the ranks in turn, highest first: near places on the curve are near in every rank."""
    out = F.lit(0).cast("long")
    for i in range(bits):
        for j, rank in enumerate(ranks):
            bit = F.shiftright(rank.cast("long"), i).bitwiseAND(F.lit(1).cast("long"))
            out = out.bitwiseOR(F.shiftleft(bit, i * len(ranks) + len(ranks) - 1 - j))
    return out


def _ranked(df: DataFrame, column: str, name: str, bits: int) -> DataFrame:
    """``df`` with the place of ``column``'s value among its distinct values, scaled to ``bits`` bits, as ``name``.

    The table of distinct values is broadcast; their number is checked first.
    """
    values = df.select(F.col(column).alias("_value")).distinct()
    n = values.count()
    if n > Z_VALUES:
        raise ValueError(f"{column!r} has {n} distinct values, more than {Z_VALUES}: cluster by ranges instead")
    place = F.row_number().over(Window.orderBy("_value")) - 1
    ranks = values.withColumn(name, F.floor(place * F.lit((1 << bits) / max(n, 1))).cast("long"))
    return df.join(F.broadcast(ranks), F.col(column).eqNullSafe(F.col("_value")), "left").drop("_value")


def _clustered(
    df: DataFrame, columns: Sequence[str], by: Sequence[str], along: Sequence[str] = (), ranges: int | None = None
) -> DataFrame:
    """Rows dealt by ranges of ``by``, then of the curve through the columns ``along``, sorted in each.

    The range key ends in a hash of the row and, for exact copies, of the row's number in its scan
    task, so one hot (date, store) spans several ranges whatever its rows.  Without a scan whose
    rows keep their order copies stay together.
    """
    rows = df.select(*columns)
    stable = keeps_row_order(rows)
    plain = [F.col(f.name) for f in rows.schema.fields if "map<" not in f.dataType.simpleString()]
    spread = [F.monotonically_increasing_id()] if stable else []
    rows = rows.withColumn("_spread", F.xxhash64(*plain, *spread))
    for k, column in enumerate(along):
        rows = _ranked(rows, column, f"_rank{k}", Z_BITS)
    curve = []
    if along:
        rows = rows.withColumn("_curve", z_value([F.col(f"_rank{k}") for k in range(len(along))]))
        curve = ["_curve"]
    key = [*by, *curve]
    dealt = rows.repartitionByRange(ranges, *key, "_spread") if ranges else rows.repartitionByRange(*key, "_spread")
    return dealt.sortWithinPartitions(*key).select(*columns)


def _partition_columns(spark: SparkSession, name: str) -> list[str]:
    return [c.name for c in spark.catalog.listColumns(name) if c.isPartition]


def _checked(df: DataFrame, name: str, keys: Sequence[str]) -> DataFrame:
    """``df``; a job that reads a row that breaks the table's NOT NULL columns or has no key fails."""
    known = {r["key"]: r["value"] for r in df.sparkSession.sql(f"SHOW TBLPROPERTIES {_quoted(name)}").collect()}
    required = json.loads(known.get(NOT_NULL_PROPERTY, "[]"))
    checks = [(null_or_empty(df, k), f"NOT NULL contract violated: key {k!r} is NULL or empty") for k in keys]
    checks += [(F.col(c).isNull(), f"NOT NULL contract violated: {c!r}") for c in required if c not in keys and c in df.columns]
    return guarded(df, checks)


def insert_clustered(
    df: DataFrame,
    name: str,
    *,
    cluster_by: Sequence[str] = CLUSTER_COLUMNS,
    overwrite_partitions: bool = False,
    enforce_not_null: bool = True,
    curve: str | None = None,
    ranges: int | None = None,
) -> None:
    """K9 + T4 — insert rows into the table, clustered over and within files.

    ``curve="z"`` deals the rows out along a Z-order curve through the cluster columns, else by one
    after the other.  ``ranges`` sets the number of ranges (by default Spark's shuffle partitions).

    ``overwrite_partitions=True`` replaces only the partitions the rows
    touch (dynamic overwrite; no rows replace nothing); otherwise rows are appended.  Columns
    are matched by name to the table's order.  Columns that the table declares NOT NULL must
    hold no nulls, partition and cluster columns neither nulls nor empty texts; this is checked
    while the rows are sampled for their ranges and written, without a pass of its own, and a
    violation leaves the table as it was: either kind of insert shows its files at the end of the job.
    """
    if curve not in (None, "z"):
        raise ValueError(f"curve must be 'z' or None, got {curve!r}")
    spark = df.sparkSession
    parts = _partition_columns(spark, name)
    keys = [*parts, *cluster_by]
    rows = _checked(df, name, keys) if enforce_not_null else df
    by, along = (parts, cluster_by) if curve else (keys, ())
    ordered = _clustered(rows, spark.table(name).columns, by, along, ranges)
    with _setting(spark, *DYNAMIC), violations_raise():
        ordered.write.insertInto(name, overwrite=overwrite_partitions)


def replace_table_date(
    rows: DataFrame,
    name: str,
    extract_date,
    *,
    date_column: str = "extract_date",
    cluster_by: Sequence[str] = CLUSTER_COLUMNS,
    enforce_not_null: bool = True,
) -> None:
    """K5 on the catalog table: delete one date and insert its new rows; other dates stay.

    ``rows`` must all carry the date, else nothing is changed; no rows leave the date empty.
    Spark refuses rows that are read from the table itself.  Idempotent.  The date's old files
    go when the new ones are all there (dynamic overwrite), so a failed job leaves them.
    """
    spark = rows.sparkSession
    day = parse_date(extract_date)
    other = ~F.col(date_column).eqNullSafe(date_literal(day))
    checked = guarded(rows, [(other, f"replacement rows are not all dated {day}")])
    if enforce_not_null:
        checked = _checked(checked, name, [*_partition_columns(spark, name), *cluster_by])
    if rows.isEmpty():
        # A dynamic overwrite by no rows replaces nothing; one of the named date empties it.
        columns = [c for c in spark.table(name).columns if c != date_column]
        spark.sql(
            f"INSERT OVERWRITE TABLE {_quoted(name)} PARTITION (`{date_column}` = DATE '{day.isoformat()}') "
            "SELECT * FROM {rows}",
            rows=rows.select(*columns),
        )
        return
    ordered = _clustered(checked, spark.table(name).columns, cluster_by)
    with _setting(spark, *DYNAMIC), violations_raise():
        ordered.write.insertInto(name, overwrite=True)


def clustering_report(spark: SparkSession, name: str, date_column: str = "extract_date", by: str = "terr_cd") -> DataFrame:
    """T4 — per date: files, values of ``by``, and (file, value) pairs.

    Files of a clustered table overlap in the values at their borders only, so there are
    at most ``values + files - 1`` pairs (``clustered``).
    """
    rows = spark.table(name).select(date_column, by, F.col("_metadata.file_path").alias("file"))
    pairs = rows.distinct().groupBy(date_column)
    return pairs.agg(
        F.count_distinct("file").alias("files"), F.count_distinct(by).alias("values"), F.count(F.lit(1)).alias("pairs")
    ).withColumn("clustered", F.col("pairs") <= F.col("values") + F.col("files") - 1)


def skipping_report(spark: SparkSession, name: str, by: Sequence[str] = CLUSTER_COLUMNS, date_column: str = "extract_date") -> DataFrame:
    """T4 — per date and column: files, values, and files that a filter on one value has to read, added up over all values.

    A file has to be read if its least and greatest value, which its footer holds, admit the filter's.
    """
    rows = spark.table(name).select(date_column, *by, F.col("_metadata.file_path").alias("file"))
    out = None
    for column in by:
        spans = rows.groupBy(date_column, "file").agg(F.min(column).alias("low"), F.max(column).alias("high"))
        values = rows.select(date_column, F.col(column).alias("value")).distinct()
        met = values.join(spans, date_column).filter(F.col("value").between(F.col("low"), F.col("high")))
        one = met.groupBy(date_column).agg(
            F.count_distinct("file").alias("files"), F.count_distinct("value").alias("values"), F.count(F.lit(1)).alias("reads")
        ).select(date_column, F.lit(column).alias("column"), "files", "values", "reads")
        out = one if out is None else out.unionByName(one)
    return out
