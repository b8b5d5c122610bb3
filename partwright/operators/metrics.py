"""A5, A6, A8, T2 — metric records and the ordered partition list.

Every metric is one global aggregate.  The distinct counts are computed from
a per-(territory, store) pre-aggregate: each task first folds its rows into
one partial row per tuple (map-side combine), so the shuffle carries tuples,
not rows, and no single key can concentrate raw rows on one reducer.
Decimal sums stay decimal, so the result does not depend on row order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Metric records have fixed types whatever the amount column's precision.
SUM_TYPE = "decimal(38,2)"


def exact_amount(df: DataFrame, amount: str) -> Column:
    """The amount column as a decimal, so that its sum does not depend on the order of rows.

    Floating-point amounts are rounded to nine decimals row by row; other types are refused.
    """
    kind = df.schema[amount].dataType
    if isinstance(kind, T.DecimalType):
        return F.col(amount)
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return F.col(amount).cast(T.DecimalType(38, 9))
    if isinstance(kind, T.IntegralType):
        return F.col(amount).cast(T.DecimalType(38, 0))
    raise TypeError(f"{amount} is {kind.simpleString()}; an amount is a decimal, an integer or a double")


def exact_total(df: DataFrame, amount: str) -> Column:
    """``ROUND(SUM(amount), 2)``, half up."""
    return F.round(F.sum(exact_amount(df, amount)), 2).cast(SUM_TYPE)


def _tuple_partials(df: DataFrame, terr: str, store: str, amount: str) -> DataFrame:
    return df.groupBy(terr, store).agg(
        F.count(F.lit(1)).alias("_rows"),
        F.sum(exact_amount(df, amount)).alias("_amt"),
    )


def source_metrics(
    df: DataFrame,
    *,
    terr: str = "terr_cd",
    store: str = "store_id",
    amount: str = "total_amt",
    names: Sequence[str] = ("total_rows", "terr_count", "store_count", "sum_total_amt"),
) -> DataFrame:
    """A5 — rows, distinct territories, distinct stores, ``ROUND(SUM(amount), 2)``.

    The caller applies the date filter.  With zero rows the sum is NULL (as in
    SQL) and the counts are 0.
    """
    rows, terrs, stores, total = names
    part = _tuple_partials(df, terr, store, amount)
    return part.agg(
        F.coalesce(F.sum("_rows"), F.lit(0)).cast("long").alias(rows),
        F.count_distinct(terr).alias(terrs),
        F.count_distinct(store).alias(stores),
        F.round(F.sum("_amt"), 2).cast(SUM_TYPE).alias(total),
    )


EXPORT_METRIC_NAMES = ("exported_rows", "exported_terr", "exported_stores", "exported_total_amt")


def generation_metrics(
    df: DataFrame,
    *,
    terr: str = "terr_cd",
    store: str = "store_id",
    amount: str = "total_amt",
) -> DataFrame:
    """A6 — A5 plus the number of distinct (territory, store) combinations.

    Combinations are counted as ``COUNT(DISTINCT CONCAT(terr, '-', store))``,
    the reference's form.
    """
    part = _tuple_partials(df, terr, store, amount)
    return part.agg(
        F.coalesce(F.sum("_rows"), F.lit(0)).cast("long").alias("total_rows"),
        F.count_distinct(terr).alias("distinct_territories"),
        F.count_distinct(store).alias("distinct_stores"),
        F.count_distinct(F.concat(F.col(terr), F.lit("-"), F.col(store))).alias(
            "distinct_partition_combinations"
        ),
        F.round(F.sum("_amt"), 2).cast(SUM_TYPE).alias("total_revenue"),
    )


def not_null_contract(df: DataFrame, *, keys: Sequence[str] = (), columns: Sequence[str] | None = None) -> DataFrame:
    """A8 — the table's NOT NULL contract as one row, for ``columns`` (all by default) and the keys.

    ``null_<col>`` counts NULLs per column; for key columns an empty string
    counts too (it would be written to the same default directory as NULL).
    ``violations`` is the total, ``ok`` is true when it is zero.  One scan.
    """
    string_cols = {f.name for f in df.schema.fields if f.dataType.typeName() == "string"}
    aggs = []
    checked = [c for c in df.columns if columns is None or c in columns or c in keys]
    for c in checked:
        cond = F.col(c).isNull()
        if c in keys and c in string_cols:
            cond = cond | (F.col(c) == F.lit(""))
        aggs.append(F.count_if(cond).alias(f"null_{c}"))
    agg = df.agg(F.count(F.lit(1)).alias("total_rows"), *aggs)
    total = sum((F.col(f"null_{c}") for c in checked), F.lit(0))
    return agg.select("*", total.cast("long").alias("violations")).withColumn("ok", F.col("violations") == 0)


def partition_list(df: DataFrame, keys: Sequence[str] = ("terr_cd", "store_id"), limit: int | None = None) -> DataFrame:
    """T2/A9 — distinct key tuples in key order; optionally only the first ``limit``.

    ``distinct`` is a pre-aggregated shuffle of tuples; with a limit the
    ordered top-N is a ``TakeOrderedAndProject`` (bounded per task).
    """
    out = df.select(*keys).distinct().orderBy(*keys)
    return out.limit(limit) if limit is not None else out
