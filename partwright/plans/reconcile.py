"""V1–V3 — prove an export is right.

* :func:`file_inventory`       S3 + P7: one row per Parquet file with decoded keys.
* :func:`layout_report`        V1/A7: files, valid files, territories, stores,
  three sample partitions, ``layout_ok``.
* :func:`reconcile`            V2: source metrics vs export metrics (exact
  decimal sum), four flags and ``all_ok``.
* :func:`partition_distribution` V3: files per partition and the directory set
  against the source's key tuples.

All of them are DataFrames computed by Spark; only the final one-row result is
ever brought back by a caller.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.dates import parse_date
from ..functions.keys import extract_keys, unescape
from ..operators.export import default_max_rows_per_file, slots_of
from ..operators.metrics import EXPORT_METRIC_NAMES, source_metrics
from ..schema import KEYS
from ..sources.hive import read_partitioned
from ..sources.inventory import list_files_or_empty
from ..sources.warehouse import date_equals


def _levels(keys: Sequence[str], terr: str | None, store: str | None) -> tuple[str, str]:
    """The two key levels the reports count (territory and store by default).

    Defaults to the first two keys (the first one twice for a single key).
    """
    keys = list(keys)
    return terr or keys[0], store or (keys[1] if len(keys) > 1 else keys[0])


def file_inventory(spark: SparkSession, path: str, keys: Sequence[str] = KEYS) -> tuple[DataFrame, bool]:
    """Every ``*.parquet`` file below ``path`` with its decoded key values.

    Columns: ``path, length, valid, partition, <keys...>``.  ``valid`` is
    true when the path matches ``k1=../k2=../...parquet``; ``partition`` is
    the ``k1=v1/k2=v2`` part as written.  Returns ``(frame, path_exists)``.
    """
    files, exists = list_files_or_empty(spark, path)
    raw = extract_keys(F.col("path"), keys)
    valid = raw[0] != F.lit("")
    partition = F.when(
        valid, F.concat_ws("/", *[F.concat(F.lit(f"{k}="), r) for k, r in zip(keys, raw)])
    )
    out = files.select(
        "path",
        "length",
        valid.alias("valid"),
        partition.alias("partition"),
        *[F.when(valid, unescape(r)).alias(k) for k, r in zip(keys, raw)],
    )
    return out, exists


def layout_report(
    spark: SparkSession,
    path: str,
    keys: Sequence[str] = KEYS,
    terr: str | None = None,
    store: str | None = None,
    n_samples: int = 3,
    inventory: tuple[DataFrame, bool] | None = None,
) -> DataFrame:
    """V1 — one row: ``parquet_files, valid_files, distinct_territories,
    distinct_stores, sample_partitions, layout_ok``.

    An empty or absent path gives ``layout_ok = false`` rather than an error.
    Samples are the first ``n_samples`` partition paths in order (a bounded
    top-N, not a collection of all partitions).
    """
    terr, store = _levels(keys, terr, store)
    inv, exists = inventory or file_inventory(spark, path, keys)
    counts = inv.agg(
        F.count(F.lit(1)).alias("parquet_files"),
        F.count_if("valid").alias("valid_files"),
        F.count_distinct(terr).alias("distinct_territories"),
        F.count_distinct(store).alias("distinct_stores"),
    )
    samples = (
        inv.filter("valid").select("partition").distinct().orderBy("partition").limit(n_samples)
        .agg(F.array_join(F.array_sort(F.collect_list("partition")), ",").alias("sample_partitions"))
    )
    ok = (
        F.lit(exists)
        & (F.col("parquet_files") > 0)
        & (F.col("valid_files") == F.col("parquet_files"))
    )
    return counts.crossJoin(samples).withColumn("layout_ok", ok)


def export_metrics(
    spark: SparkSession,
    path: str,
    extract_date=None,
    *,
    keys: Sequence[str] = KEYS,
    date_column: str = "extract_date",
    terr: str | None = None,
    store: str | None = None,
    amount: str = "total_amt",
    amount_type: T.DataType | None = None,
) -> DataFrame:
    """A5 over the export, read back with declared key types (partition-pruned).

    ``amount_type`` declares the amount column so only it is read from the
    file bodies and the footers need not be sampled for a schema first (one
    listing of the tree instead of two).
    """
    terr, store = _levels(keys, terr, store)
    body = None
    if amount_type is not None:
        if isinstance(amount_type, T.DecimalType):
            # widest precision at the same scale: files written with any
            # narrower precision still read (decimal widening), none fail.
            amount_type = T.DecimalType(38, amount_type.scale)
        body = T.StructType([T.StructField(amount, amount_type, True)])
    df = read_partitioned(spark, path, keys=keys, body_schema=body)
    if extract_date is not None:
        df = df.filter(date_equals(date_column, extract_date))
    return source_metrics(df, terr=terr, store=store, amount=amount, names=EXPORT_METRIC_NAMES)


def reconcile(
    spark: SparkSession,
    source: DataFrame,
    path: str,
    extract_date=None,
    *,
    keys: Sequence[str] = KEYS,
    date_column: str = "extract_date",
    terr: str | None = None,
    store: str | None = None,
    amount: str = "total_amt",
) -> DataFrame:
    """V2 — one row with both metric records and the verdict.

    ``source`` is the source table; the date filter is applied to both sides.
    Sums are compared exactly (decimal), not with a float tolerance.
    """
    terr, store = _levels(keys, terr, store)
    src = source if extract_date is None else source.filter(date_equals(date_column, extract_date))
    left = source_metrics(src, terr=terr, store=store, amount=amount)
    right = export_metrics(
        spark,
        path,
        extract_date,
        keys=keys,
        date_column=date_column,
        terr=terr,
        store=store,
        amount=amount,
        amount_type=source.schema[amount].dataType,
    )
    both = left.crossJoin(right)
    rows_match = F.col("total_rows") == F.col("exported_rows")
    terr_match = F.col("terr_count") == F.col("exported_terr")
    stores_match = F.col("store_count") == F.col("exported_stores")
    sum_match = F.col("sum_total_amt").eqNullSafe(F.col("exported_total_amt"))
    return both.select(
        "*",
        (F.col("total_rows") - F.col("exported_rows")).alias("row_diff"),
        rows_match.alias("rows_match"),
        terr_match.alias("territories_match"),
        stores_match.alias("stores_match"),
        sum_match.alias("sum_match"),
        (rows_match & terr_match & stores_match & sum_match).alias("all_ok"),
    )


def partition_files(
    spark: SparkSession,
    path: str,
    keys: Sequence[str] = KEYS,
    inventory: tuple[DataFrame, bool] | None = None,
) -> DataFrame:
    """Per partition directory: decoded keys, ``n_files``, ``bytes``."""
    inv, _ = inventory or file_inventory(spark, path, keys)
    return inv.filter("valid").groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_files"), F.sum("length").alias("bytes")
    )


def partition_distribution(
    spark: SparkSession,
    path: str,
    source: DataFrame,
    keys: Sequence[str] = KEYS,
    max_rows_per_file: int | None = None,
    inventory: tuple[DataFrame, bool] | None = None,
) -> DataFrame:
    """V3 — one row: ``partitions, files, max_files_per_partition,
    missing_partitions, extra_partitions, files_ok, dirs_match, ok``.

    ``source`` holds the rows that were exported.  Its key tuples
    (pre-aggregated) are matched to the directories by a full outer join of
    two tuple-level sets; key values are compared in their directory text
    form.  ``files_ok`` holds when no partition has more files than the export
    makes of its rows: one up to ``max_rows_per_file`` (the export's default if None).
    """
    bound = max_rows_per_file or default_max_rows_per_file(source)
    per_dir = partition_files(spark, path, keys, inventory).select(*keys, "n_files")
    src_keys = source.groupBy(*[F.col(k).cast("string").alias(k) for k in keys]).agg(
        slots_of(F.count(F.lit(1)), bound, by_number=True).alias("_src")  # either way of dealing keeps within it
    )
    joined = src_keys.join(per_dir.withColumn("_dir", F.lit(True)), on=list(keys), how="full_outer")
    out = joined.agg(
        F.count_if(F.col("_dir")).alias("partitions"),
        F.coalesce(F.sum("n_files"), F.lit(0)).cast("long").alias("files"),
        F.coalesce(F.max("n_files"), F.lit(0)).cast("long").alias("max_files_per_partition"),
        F.count_if(F.col("_dir").isNull()).alias("missing_partitions"),
        F.count_if(F.col("_src").isNull()).alias("extra_partitions"),
        F.count_if(F.col("n_files") > F.coalesce("_src", F.lit(1))).alias("_over"),
    )
    files_ok = (F.col("_over") == 0) & (F.col("partitions") > 0)
    dirs_ok = (F.col("missing_partitions") == 0) & (F.col("extra_partitions") == 0)
    return out.select(*out.columns[:-1], files_ok.alias("files_ok"), dirs_ok.alias("dirs_match"), (files_ok & dirs_ok).alias("ok"))


def verify_export(
    spark: SparkSession,
    source: DataFrame,
    path: str,
    extract_date=None,
    *,
    keys: Sequence[str] = KEYS,
    date_column: str = "extract_date",
    amount: str = "total_amt",
    max_rows_per_file: int | None = None,
) -> DataFrame:
    """V1 + V2 + V3 in one row, listing the export tree once.

    With ``extract_date`` only the files of that date are looked at, as only its rows
    are: other dates may have been exported to the same tree.

    The inventory (one row per file) is cached for the two checks that use
    it and released afterwards.  Reconciliation runs only when the layout is
    valid (its fields are NULL otherwise).  ``verified`` = layout ok,
    reconciliation ok, directory set matches, files per partition within what
    ``max_rows_per_file`` makes of its rows.
    """
    inv, exists = file_inventory(spark, path, keys)
    if extract_date is not None and date_column in keys:
        # Files off the pattern have no date and stay, to be reported.
        day = str(parse_date(extract_date))
        inv = inv.filter(F.col(date_column).isNull() | (F.col(date_column) == day))
    inv = inv.persist()
    try:
        layout = layout_report(spark, path, keys, inventory=(inv, exists))
        dated = source if extract_date is None else source.filter(date_equals(date_column, extract_date))
        dist = partition_distribution(spark, path, dated, keys, max_rows_per_file, inventory=(inv, exists))
        lay_row, dist_row = layout.first(), dist.first()
    finally:
        inv.unpersist()
    head = list(layout.schema.fields) + [T.StructField(f.name, f.dataType, True) for f in dist.schema.fields]
    values = list(lay_row) + list(dist_row)
    if lay_row["layout_ok"]:
        rec = reconcile(spark, source, path, extract_date, keys=keys, date_column=date_column, amount=amount)
        rec_row = rec.first()
        tail = [T.StructField(f.name, f.dataType, True) for f in rec.schema.fields]
        values += list(rec_row)
        verified = bool(rec_row["all_ok"] and dist_row["ok"])
    else:
        tail = list(_RECONCILE_FIELDS)
        values += [None] * len(tail)
        verified = False
    schema = T.StructType(head + tail + [T.StructField("verified", T.BooleanType(), False)])
    return spark.createDataFrame([tuple(values) + (verified,)], schema)


_RECONCILE_FIELDS = [
    T.StructField(name, dt, True)
    for name, dt in [
        ("total_rows", T.LongType()),
        ("terr_count", T.LongType()),
        ("store_count", T.LongType()),
        ("sum_total_amt", T.DecimalType(38, 2)),
        ("exported_rows", T.LongType()),
        ("exported_terr", T.LongType()),
        ("exported_stores", T.LongType()),
        ("exported_total_amt", T.DecimalType(38, 2)),
        ("row_diff", T.LongType()),
        ("rows_match", T.BooleanType()),
        ("territories_match", T.BooleanType()),
        ("stores_match", T.BooleanType()),
        ("sum_match", T.BooleanType()),
        ("all_ok", T.BooleanType()),
    ]
]
