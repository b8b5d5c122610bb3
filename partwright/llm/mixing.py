"""Mixing sources to target weights along a time-varying curriculum.

Every source has a weight and a schedule, the density of its weight over the
training time 0..1.  Its target of words comes from the weight; integrating the
schedule gives the share of the target demanded up to any time, and inverting
that integral at a document's cumulative word offset gives the document's
training position.  A final range sort deals the documents out by position.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from partwright.llm.common import WORD_PATTERN, quoted, set_aside

WEIGHTS = (5, 2, 1)
MAX_REPEATS = 3
# Density of each weight's schedule at equidistant times from 0 to 1, linear between.
SCHEDULES = {5: (1.5, 1.0, 0.5), 2: (1.0, 1.0, 1.0), 1: (0.5, 1.0, 1.5)}
# Prefix sums are taken in two levels: sums of a source's bins (leading hex digits of the order), then rows
# within a bin.  The number of digits follows the table, so that a bin of the largest source has about so many rows.
BIN_ROWS = 2_000


def source_targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """One row per source: source, source_size, weight, target.

    ``sizes`` has source and size.  Sources in code-point order, null last, take
    the weights in turn.  The targets share the sum of all sizes by weight; a
    target stops at ``max_repeats`` times its source's size and the rest is
    shared again.  The last round's unit share ``x`` makes every target
    ``min(max_repeats * size, x * weight)``, so sorting by cap per unit of weight finds it.
    """
    per_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    ordered = Window.orderBy(F.col("source").asc_nulls_last())
    turn = (F.row_number().over(ordered) - 1) % len(weights)
    weighted = per_source.withColumn(
        "weight", F.element_at(F.array(*[F.lit(int(w)) for w in weights]), turn + 1).cast("long")
    ).withColumn("cap", F.col("source_size") * max_repeats)
    by_cap = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = by_cap.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    share = (F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0))) / (
        F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    )
    shares = weighted.withColumn("share", share)
    fits = F.when(F.col("share") <= F.col("cap") / F.col("weight"), F.struct(F.col("cap") / F.col("weight"), "share"))
    return shares.withColumn("unit", F.min(fits).over(everything)["share"]).select(
        "source",
        "source_size",
        "weight",
        F.least(F.col("cap").cast("double"), F.col("unit") * F.col("weight")).alias("target"),
    )


def invert_schedule(share: Column, values: Sequence[float]) -> Column:
    """Time at which the integral of the piecewise linear density reaches ``share`` of its total."""
    if len(values) < 2 or min(values) <= 0:
        raise ValueError("a schedule needs two or more positive values")
    step = 1.0 / (len(values) - 1)
    areas = [(a + b) / 2 * step for a, b in zip(values, values[1:], strict=False)]
    area = share * F.lit(float(sum(areas)))
    time, below = None, float(sum(areas))
    for k in reversed(range(len(areas))):
        below = float(sum(areas[:k]))
        rest = area - F.lit(below)
        slope = (values[k + 1] - values[k]) / step
        here = F.lit(k * step) + F.lit(2.0) * rest / (
            F.lit(float(values[k])) + F.sqrt(F.lit(float(values[k]) ** 2) + F.lit(2.0 * slope) * rest)
        )
        time = here if time is None else F.when(area >= F.lit(float(sum(areas[: k + 1]))), time).otherwise(here)
    return time


def plan_mix(
    df: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    schedules: dict[int, Sequence[float]] = SCHEDULES,
    max_repeats: int = MAX_REPEATS,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> DataFrame:
    """``df`` with size, source_size, target, taken and copies (array of take, position).

    A source's documents are laid end to end in the order of a hash of their ids,
    pass after pass; the mix takes the words up to the target, so the last
    document taken of a source may be cut.  Null text: size 0.  A null source is a
    source of its own, after all others.  Rows of one id go by size, then by a hash of the
    text; a null id takes the text's hash in its place, so such rows are spread as others are.
    Hence the same rows get the same places on every run, whatever their partitioning; only rows equal in id,
    source and text are interchangeable.  Input columns named like the new ones are replaced, all others
    pass through whatever their names.  An empty table gives an empty result.
    """
    new = ("size", "source_size", "target", "taken", "copies")
    _, inner, back = set_aside(df, new)
    text = quoted(text_col)
    size = F.coalesce(F.regexp_count(text, F.lit(WORD_PATTERN)), F.lit(0)).cast("long")
    tie = F.xxhash64(F.coalesce(text, F.lit("")))
    named = F.coalesce(quoted(id_col).cast("string"), F.concat(F.lit("null "), F.hex(tie)))
    rows = df.select(
        *inner, size.alias("size"), quoted(source_col).alias("source"), F.md5(named.cast("binary")).alias("order"), tie.alias("tie")
    )
    digits = max(1, math.ceil(math.log(max(1, df.count() / BIN_ROWS), 16)))
    rows = rows.withColumn("bin", F.substring("order", 1, digits))

    bins = rows.groupBy("source", "bin").agg(F.sum("size").alias("size"))
    targets = source_targets(bins, weights, max_repeats)
    ahead = Window.partitionBy("source").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    offsets = bins.select("source", "bin", F.coalesce(F.sum("size").over(ahead), F.lit(0)).alias("offset"))
    t, o = targets.alias("t"), offsets.alias("o")
    known = o.join(t, F.col("o.source").eqNullSafe(F.col("t.source"))).select(
        F.col("o.source").alias("k_source"), F.col("o.bin").alias("k_bin"), "offset", "source_size", "weight", "target"
    )
    within = (
        Window.partitionBy("source", "bin")
        .orderBy("order", "size", "tie")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    placed = (
        rows.join(known, F.col("source").eqNullSafe(F.col("k_source")) & (F.col("bin") == F.col("k_bin")))
        .withColumn("at", F.col("offset") + F.coalesce(F.sum("size").over(within), F.lit(0)))
    )
    demand = F.floor("target").cast("long")

    def take(k: int) -> Column:
        left = demand - F.lit(k) * F.col("source_size") - F.col("at")
        return F.greatest(F.lit(0).cast("long"), F.least(F.col("size"), left))

    def position(k: int) -> Column:
        ahead = F.col("at") + F.lit(k) * F.col("source_size")
        share = F.when(demand > 0, F.least(ahead / demand, F.lit(1.0))).otherwise(F.lit(0.0))
        chain = None
        for weight, values in schedules.items():
            time = invert_schedule(share, values)
            chain = F.when(F.col("weight") == weight, time) if chain is None else chain.when(F.col("weight") == weight, time)
        return share if chain is None else chain.otherwise(share)

    copies = F.filter(
        F.array(*[F.struct(take(k).alias("take"), position(k).alias("position")) for k in range(max_repeats)]),
        lambda x: x["take"] > 0,
    )
    placed = placed.select(*[f"in_{k}" for k in range(len(back))], "size", "source_size", "target", copies.alias("copies"))
    taken = F.aggregate("copies", F.lit(0).cast("long"), lambda total, x: total + x["take"])
    return placed.select(*back, "size", "source_size", "target", taken.alias("taken"), "copies")


def in_training_order(plan: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The rows of :func:`plan_mix`, range-sorted by the position of their first copy, which is added as ``position``.

    Documents of which nothing is taken have none; they are spread by their hash, first of all.
    """
    _, inner, back = set_aside(plan, ("position",))
    first = F.get("copies", F.lit(0))["position"]
    spread = F.when(first.isNull(), F.xxhash64(quoted(id_col), "size")).otherwise(F.lit(0))
    rows = plan.select(*inner, first.alias("position"), spread.alias("spread"))
    ordered = rows.repartitionByRange("position", "spread").sortWithinPartitions("position")
    return ordered.select(*back, "position")


def mix_sources(df: DataFrame, **options) -> DataFrame:
    """The training order: one row per copy taken, range-sorted by position.

    Adds copy (from 0), take (words of that copy) and position (0..1) to the columns of
    :func:`plan_mix`; documents of which nothing is taken are absent.  Input columns of these names are replaced.
    """
    plan = plan_mix(df, **options)
    _, inner, back = set_aside(plan, ("copies", "copy", "take", "position"))
    rows = plan.select(*inner, F.posexplode("copies").alias("copy", "taken_copy"))
    rows = rows.select(
        *[f"in_{k}" for k in range(len(back))], "copy", F.col("taken_copy.take").alias("take"), F.col("taken_copy.position").alias("position")
    )
    return rows.repartitionByRange("position").sortWithinPartitions("position").select(*back, "copy", "take", "position")
