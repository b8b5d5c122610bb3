"""Exact dedup by sorting contents; DataFrame functions only.

Sampled splitters range-partition the normalised bytes (a bounded prefix, then a
digest, so that the sample on the driver never holds whole texts), the sort of
each range places equal contents side by side, and each row is compared in full
with its neighbour.  A content of many rows is dealt into runs of a bounded number of
rows, which are merged by a second, tiny aggregation.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from partwright.llm.common import ascii_lower, quoted, written

PREFIX_BYTES = 32


def exact_dedup(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    keep: str = "smallest",
    hot_share: float = 0.000005,
    hot_rows: int = 20_000,
    hot_runs: int = 64,
) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256.

    Contents are equal when identical after lower-casing A-Z; a null text is
    empty.  The row with the smallest (or ``keep="largest"``) id of a group stays.
    A null id ranks behind every other id.  Of repeated rows with the same id and
    content exactly one is kept.  Other columns of ``df`` are ignored, whatever
    their names; an empty table gives an empty result.

    A content is hot from ``hot_rows`` rows and ``hot_share`` of all rows; it is dealt into runs of
    about that many, ``hot_runs`` at least.  So the tables of hot contents, which are broadcast, have at
    most 1 / ``hot_share`` rows (some 20 MB), and a task's run grows by ``hot_share`` of the table only.
    """
    if keep not in ("smallest", "largest"):
        raise ValueError(f"keep must be smallest or largest, not {keep!r}")
    base = df.select(
        quoted(id_col).alias("doc_id"),
        ascii_lower(F.coalesce(quoted(text_col), F.lit(""))).alias("content"),
    ).withColumn("digest", F.xxhash64("content"))

    counts = base.groupBy("digest").agg(F.count(F.lit(1)).alias("n"))
    least = max(hot_rows, int(df.count() * hot_share))
    runs = F.greatest(F.lit(hot_runs), F.ceil(F.col("n") / F.lit(least)))
    listed = written(counts.filter(F.col("n") >= least).select("digest", runs.cast("int").alias("runs")), "hot_contents")
    hot = not listed.isEmpty()
    keyed = base.withColumn("prefix", F.expr(f"substring(cast(content as binary), 1, {PREFIX_BYTES})"))
    block = ["prefix", "digest"]
    if hot:
        # Rows without an id are alike but for their place.
        place = F.when(F.col("doc_id").isNull(), F.xxhash64(F.monotonically_increasing_id())).otherwise(F.xxhash64("doc_id"))
        keyed = keyed.withColumn("place", place).join(F.broadcast(listed), "digest", "left")
        keyed = keyed.withColumn("salt", F.coalesce(F.pmod("place", F.col("runs")).cast("int"), F.lit(-1))).drop("runs", "place")
        block.append("salt")
    # The windows below are over exactly the ranged columns, so they need no other exchange.
    ranged = keyed.repartitionByRange(*block)

    largest = keep == "largest"
    order = F.col("doc_id").desc_nulls_last() if largest else F.col("doc_id").asc_nulls_last()
    best = F.max if largest else F.min
    neighbours = Window.partitionBy(*block).orderBy("content", order)
    compared = ranged.select(
        "doc_id",
        *block,
        F.sha2("content", 256).alias("text_sha256"),
        F.coalesce(F.lag("content").over(neighbours) != F.col("content"), F.lit(True)).alias("first"),
        F.row_number().over(neighbours).alias("pos"),
    )
    in_order = Window.partitionBy(*block).orderBy("pos")
    numbered = compared.withColumn("run", F.sum(F.col("first").cast("int")).over(in_order))
    whole = Window.partitionBy(*block, "run")
    rows = numbered.select(
        "doc_id",
        *block[2:],
        "text_sha256",
        "first",
        best("doc_id").over(whole).alias("run_keep"),
        F.count(F.lit(1)).over(whole).alias("run_size"),
    )
    if hot:
        # One row for each hot content: as few as the digests counted above.
        merged = (
            rows.filter((F.col("salt") >= 0) & F.col("first"))
            .groupBy("text_sha256")
            .agg(best("run_keep").alias("all_keep"), F.sum("run_size").alias("all_size"), F.min("salt").alias("all_salt"))
        )
        rows = rows.join(F.broadcast(merged), "text_sha256", "left")
        # Rows of one id are in one run; without any id the first run's row stays.
        one = F.col("run_keep").eqNullSafe(F.col("all_keep")) & (
            F.col("all_keep").isNotNull() | (F.col("salt") == F.col("all_salt"))
        )
        first = F.col("first") & (F.col("all_size").isNull() | one)
        keep_id = F.when(F.col("all_size").isNull(), F.col("run_keep")).otherwise(F.col("all_keep"))
        size = F.coalesce("all_size", "run_size")
    else:
        first, keep_id, size = F.col("first"), F.col("run_keep"), F.col("run_size")
    return rows.select(
        "doc_id",
        keep_id.alias("keep_id"),
        size.alias("group_size"),
        first.alias("kept"),
        "text_sha256",
    )
