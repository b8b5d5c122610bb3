"""K1–K4, K6 — partitioned Parquet export.

``export_partitioned`` is the flagship: route every row of one key tuple to
one writer task, write a Hive tree ``k1=v1/k2=v2/.../part-*.parquet`` with the
keys dropped from the file body, and replace either the whole target
(``overwrite="all"``, the reference's behaviour) or only the key directories
present in the data (``overwrite="partitions"``).

Layout strategies (``strategy=``):

``"split"`` (default)
    One pre-aggregated pass over the key columns counts rows per key tuple
    (partial aggregation on the map side; the shuffle carries one row per
    tuple per task).  Tuples above ``max_rows_per_file`` are *hot*: they get
    numbered slots, one task and file each, and their rows are dealt over the
    slots in turn, so a key holding a third of the table, exact copies
    included, becomes many bounded tasks and files.  All other tuples keep
    exactly one file.  A retried task deals its rows alike: over a plain file scan
    by their number in the task, else in the order of a hash of their content.  The
    writer cuts files at the bound.  The other tuples are packed onto tasks by their
    counted rows (:func:`placement`), so that no task gets much more than its share.
``"hash"``
    The reference's plan, ``repartition(n, *keys)``: strictly one file per
    tuple, no pre-pass, but a hot tuple is one task.
``"rebalance"``
    ``REBALANCE(keys)``: adaptive execution coalesces small buckets and splits
    any bucket above the advisory partition size by map ranges.
``"direct"``
    No exchange: every input task writes its own rows into the directories
    they belong to.  For writes into one directory, where the number of files
    is not part of the contract: it is the number of input tasks at most.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from urllib.parse import unquote
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.keys import partition_subpath
from ..schema import KEYS
from ..session import to_local
from ..paths import exists
from .commit import Replacement
from .guard import guarded, null_or_empty, violations_raise
from .metrics import exact_total

OVERWRITE_MODES = {"all": "static", "partitions": "dynamic"}
STRATEGIES = ("split", "hash", "rebalance", "direct")

DEFAULT_TARGET_FILE_BYTES = 512 * 1024 * 1024
# The table of hot tuples is broadcast up to this many bytes of key text; beyond, each hot tuple
# is joined in ``HOT_JOIN_COPIES`` copies, so that its rows don't meet in one task.
HOT_BROADCAST_BYTES = 64 * 1024 * 1024
HOT_JOIN_COPIES = 64
# Slots of a hot tuple are filled to about this share, so that uneven dealing stays below the bound.
SLOT_FILL = 0.95
# Rows dealt by a hash of their number vary by the square root of a slot's rows: room for so many deviations.
SLOT_DEVIATIONS = 5
# Opening and closing a file weighs as much as writing about so many rows.
FILE_COST_ROWS = 1000
# The table of all tuples and their tasks is broadcast up to this many bytes of key text; beyond, tuples
# that are not hot go by a hash of their keys.
PLACEMENT_BROADCAST_BYTES = 64 * 1024 * 1024
# Tuples of one weight class are added up in so many bins before the bins are added up.
PLACEMENT_BINS = 256

_SLOTS = "__pw_slots"
_BASE = "__pw_base"
_COPY = "__pw_copy"
_ORDER = "__pw_order"
_TASK = "__pw_task"
_N = "__pw_n"
_ROW = "__pw_row"


@dataclass
class ExportResult:
    path: str
    keys: tuple[str, ...]
    overwrite: str
    strategy: str
    num_tasks: int | None = None
    rows: int | None = None
    tuples: int | None = None
    hot_tuples: int = 0
    max_rows_per_file: int | None = None
    removed: bool = False
    observed: dict = field(default_factory=dict)


def default_max_rows_per_file(df: DataFrame, target_file_bytes: int = DEFAULT_TARGET_FILE_BYTES) -> int:
    """Rows of the schema's default size that make a file of the target size."""
    return max(1, target_file_bytes // max(1, df._jdf.schema().defaultSize()))


def slots_of(rows: Column, max_rows: int, by_number: bool = False) -> Column:
    """Files that a tuple of ``rows`` rows is split into: one up to the bound.

    ``by_number``: rows are dealt by a hash of their number, which takes more room than dealing in turn.
    """
    filled = max_rows * SLOT_FILL
    if by_number:
        filled = max(1.0, max_rows / 2, min(filled, max_rows - SLOT_DEVIATIONS * math.sqrt(max_rows)))
    return F.when(rows <= max_rows, F.lit(1)).otherwise(F.ceil(rows / F.lit(filled))).cast("long")


def keeps_row_order(df: DataFrame) -> bool:
    """Whether a task of ``df``, run again, gets its rows in the same order: a file scan with filters and projections."""
    plan = df._jdf.queryExecution().sparkPlan()
    while True:
        name = plan.getClass().getSimpleName()
        if name == "FileSourceScanExec":
            return True
        if name not in ("ProjectExec", "FilterExec", "CollectMetricsExec") or plan.children().size() != 1:
            return False
        plan = plan.children().apply(0)


def placement(counts: DataFrame, keys: Sequence[str], weight: Column, tasks: int) -> tuple[DataFrame, int]:
    """``keys`` and a task number for every tuple of ``counts``, and the number of tasks.

    A task's share is the total weight over ``tasks``.  A tuple of more than half a share
    gets a task of its own, so there are at most twice ``tasks`` of those.  The others are laid end
    to end, heavy ones first, and cut into shares by their midpoints: a task gets at
    most a share and half a tuple on either side, hence 1.5 shares.  Offsets are sums
    of bins (weight class, hash), then of the tuples within a bin; no task sorts all tuples.
    """
    weighed = counts.select(*keys, weight.cast("double").alias("w"))
    total = weighed.agg(F.sum("w")).first()[0]
    if not total:
        return weighed.select(*keys, F.lit(0).cast("long").alias(_TASK)), 1
    share = total / tasks
    light = weighed.filter(F.col("w") <= share / 2)
    row = weighed.agg(
        F.count_if(F.col("w") > share / 2).alias("own"), F.coalesce(F.sum(F.when(F.col("w") <= share / 2, F.col("w"))), F.lit(0.0)).alias("light")
    ).first()
    shared = math.ceil(row["light"] / share) if row["light"] else 0
    heavy = weighed.filter(F.col("w") > share / 2).withColumn(
        _TASK, shared + F.row_number().over(Window.orderBy(F.col("w").desc(), *keys)) - 1
    )
    named = light.withColumns(
        {"class": -F.floor(F.log2("w")), "bin": F.pmod(F.xxhash64(*keys), F.lit(PLACEMENT_BINS))}
    )
    before = Window.rowsBetween(Window.unboundedPreceding, -1)
    bins = named.groupBy("class", "bin").agg(F.sum("w").alias("bin_w"))
    offsets = bins.select(
        "class", "bin", F.coalesce(F.sum("bin_w").over(before.orderBy("class", "bin")), F.lit(0.0)).alias("offset")
    )
    within = Window.partitionBy("class", "bin").orderBy(*keys).rowsBetween(Window.unboundedPreceding, -1)
    at = F.col("offset") + F.coalesce(F.sum("w").over(within), F.lit(0.0)) + F.col("w") / 2
    cut = F.floor(at * shared / F.lit(row["light"] or 1.0))
    packed = named.join(F.broadcast(offsets), ["class", "bin"]).withColumn(_TASK, F.least(cut, F.lit(shared - 1)))
    placed = packed.select(*keys, F.col(_TASK).cast("long")).unionByName(heavy.select(*keys, F.col(_TASK).cast("long")))
    return placed, shared + row["own"]


def _normalise(path: str) -> str:
    return unquote(to_local(path)).rstrip("/")


def source_roots(df: DataFrame) -> list[str]:
    """Root paths of the file sources below ``df``: as many as paths were read, not files."""
    roots = []
    leaves = df._jdf.queryExecution().analyzed().collectLeaves()
    for i in range(leaves.size()):
        leaf = leaves.apply(i)
        if leaf.getClass().getSimpleName().startswith("LogicalRelation"):
            relation = leaf.relation()
            if relation.getClass().getSimpleName() == "HadoopFsRelation":
                paths = relation.location().rootPaths()
                roots += [paths.apply(k).toString() for k in range(paths.size())]
    return roots


def reads_from(df: DataFrame, path: str) -> bool:
    """Whether ``df`` reads from ``path``, from below it or from a tree that holds it."""
    from .. import paths

    target = _normalise(paths.qualify(df.sparkSession, path)) + "/"
    for root in source_roots(df):
        source = _normalise(root) + "/"
        if source.startswith(target) or target.startswith(source):
            return True
    return False


def assert_not_reading_target(df: DataFrame, path: str) -> None:
    """Refuse to overwrite a path that the frame reads from.

    The write deletes files before the scan has read them; Spark does not refuse it for
    all path writes, and the data would be lost.
    """
    from .. import paths

    if paths.exists(df.sparkSession, path) and reads_from(df, path):
        raise ValueError(f"refusing to overwrite {path!r}: the frame reads from it")


def _hashable(df: DataFrame) -> list[Column]:
    """The columns as far as they can be hashed: maps as their entries, deeper maps left out."""
    out = []
    for f in df.schema.fields:
        if isinstance(f.dataType, T.MapType):
            if "map<" not in f.dataType.keyType.simpleString() + f.dataType.valueType.simpleString():
                out.append(F.map_entries(f.name))
        elif "map<" not in f.dataType.simpleString() and "variant" not in f.dataType.simpleString():
            out.append(F.col(f.name))
    return out


def _null_or_empty(df: DataFrame, keys: Sequence[str]) -> Column:
    out = null_or_empty(df, keys[0])
    for k in keys[1:]:
        out = out | null_or_empty(df, k)
    return out


def _write(df: DataFrame, path: str, keys, overwrite: str, max_records_per_file, compression) -> None:
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", OVERWRITE_MODES[overwrite])
    if keys:
        writer = writer.partitionBy(*keys)
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", int(max_records_per_file))
    if compression:
        writer = writer.option("compression", compression)
    writer.parquet(path)


@dataclass
class PreparedExport:
    """The frame to hand to the writer, plus what the planning pass learnt."""

    frame: DataFrame
    result: ExportResult
    observation: Observation | None = None
    _cached: DataFrame | None = None

    def release(self) -> None:
        if self._cached is not None:
            self._cached.unpersist()
            self._cached = None


def prepare_export(
    df: DataFrame,
    *,
    keys: Sequence[str] = KEYS,
    strategy: str = "split",
    max_rows_per_file: int | None = None,
    num_partitions: int | None = None,
    sort_within: Sequence[str] = (),
    validate_keys: bool = True,
    observe_sum: str | None = None,
    require: Column | None = None,
    hot_broadcast_bytes: int = HOT_BROADCAST_BYTES,
    placement_broadcast_bytes: int = PLACEMENT_BROADCAST_BYTES,
    file_cost_rows: int = FILE_COST_ROWS,
    check_inside: bool = False,
) -> PreparedExport:
    """Plan the export: the returned ``frame`` is what the writer consumes.

    With ``num_partitions`` the tuples go to that many tasks by a hash of their keys, else
    they are packed onto tasks by their rows and ``file_cost_rows`` a file.

    For ``strategy="split"`` this runs the one planning job (per-tuple row
    counts over the key columns only) and keeps that small result cached
    until :meth:`PreparedExport.release`.  ``frame.explain()`` shows the
    exchange the write will use.

    ``require`` is a predicate over key columns only that every row must
    satisfy (e.g. "the date is D"); it is checked on the per-tuple counts, so
    it costs no extra scan, and a violation raises before anything is written.

    The other strategies have no such counts: they check in a pass before the write, or with
    ``check_inside`` in the write itself, which then has to be one that shows nothing if it fails.
    """
    if strategy not in STRATEGIES:
        raise ValueError(f"strategy must be one of {STRATEGIES}, got {strategy!r}")
    keys = tuple(keys)
    missing = [k for k in keys if k not in df.columns]
    if missing:
        raise ValueError(f"key columns not in frame: {missing}")
    spark = df.sparkSession
    result = ExportResult(path="", keys=keys, overwrite="", strategy=strategy)
    body = df
    inside = check_inside and strategy != "split"
    if inside:
        checks = [(null_or_empty(df, k), f"rows have a NULL or empty partition key {k!r}") for k in keys if validate_keys]
        if require is not None:
            checks.append((~F.coalesce(require, F.lit(False)), "rows fail the required condition"))
        body = guarded(body, checks)
    observation = None
    if observe_sum is not None or inside:
        observation = Observation("export")
        total = [exact_total(df, observe_sum).alias("sum")] if observe_sum is not None else []
        body = body.observe(observation, F.count(F.lit(1)).alias("rows"), *total)
    parallelism = spark.sparkContext.defaultParallelism

    if strategy != "split":
        if not inside and (validate_keys or require is not None):
            # One pass over the key columns for both checks and the row count.
            check = df.agg(
                F.count(F.lit(1)).alias("rows"),
                F.count_if(_null_or_empty(df, keys)).alias("bad") if validate_keys else F.lit(0).alias("bad"),
                F.count_if(~F.coalesce(require, F.lit(False))).alias("failing")
                if require is not None
                else F.lit(0).alias("failing"),
            ).first()
            if check["bad"]:
                raise ValueError(f"{check['bad']} rows have a NULL or empty partition key {keys}")
            if check["failing"]:
                raise ValueError(f"{check['failing']} rows fail the required condition")
            result.rows = check["rows"]
        if strategy == "hash":
            n = num_partitions or 2 * parallelism
            out = body.repartition(n, *keys)
            result.num_tasks = n
        elif strategy == "rebalance":
            out = body.hint("rebalance", *keys)
        else:
            out = body
        if sort_within:
            out = out.sortWithinPartitions(*keys, *sort_within)
        return PreparedExport(out, result, observation)

    thr = max_rows_per_file or default_max_rows_per_file(df)
    stable = keeps_row_order(df)
    # One row per key tuple; partial aggregation runs before the shuffle.
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias(_N)).persist()
    is_hot = F.col(_N) > thr
    slots = slots_of(F.col(_N), thr, by_number=stable)
    text = F.octet_length(F.concat_ws("/", *[F.col(k).cast("string") for k in keys])) + 64
    try:
        stats = counts.agg(
            F.coalesce(F.sum(_N), F.lit(0)).alias("rows"),
            F.count(F.lit(1)).alias("tuples"),
            F.count_if(is_hot).alias("hot"),
            F.coalesce(F.sum(F.when(is_hot, F.col(_N))), F.lit(0)).alias("hot_rows"),
            F.coalesce(F.sum(F.when(is_hot, slots)), F.lit(0)).alias("slots"),
            F.coalesce(F.sum(F.when(is_hot, text)), F.lit(0)).alias("hot_bytes"),
            F.coalesce(F.sum(text), F.lit(0)).alias("bytes"),
            F.coalesce(F.sum(F.when(_null_or_empty(counts, keys), F.col(_N))), F.lit(0)).alias("bad"),
            F.coalesce(
                F.sum(F.when(~F.coalesce(require, F.lit(False)), F.col(_N))) if require is not None else F.lit(0),
                F.lit(0),
            ).alias("failing"),
        ).first()
        if validate_keys and stats["bad"]:
            raise ValueError(f"{stats['bad']} rows have a NULL or empty partition key {keys}")
        if stats["failing"]:
            raise ValueError(f"{stats['failing']} rows fail the required condition")
        # Enough tasks to keep every core busy on a file-count-bound write, and
        # about one task per max_rows_per_file rows on a large one.
        cold, cold_rows = stats["tuples"] - stats["hot"], stats["rows"] - stats["hot_rows"]
        n = num_partitions or max(1, min(cold, max(2 * parallelism, math.ceil(cold_rows / thr))))
        packed = None
        if num_partitions is None and cold > 1 and n > 1 and stats["bytes"] <= placement_broadcast_bytes:
            packed, n = placement(counts.filter(~is_hot), keys, F.col(_N) + file_cost_rows, n)
    except Exception:
        counts.unpersist()
        raise
    result.max_rows_per_file = thr
    result.rows, result.tuples, result.hot_tuples = stats["rows"], stats["tuples"], stats["hot"]
    result.num_tasks = n + stats["slots"]
    cached = None
    if not stats["hot"] and packed is None:
        counts.unpersist()
        out = body.repartition(n, *keys)
    else:
        cached = counts
        # Hot tuples hold more than max_rows_per_file rows each, so they are few against the rows.
        before = Window.orderBy(*keys).rowsBetween(Window.unboundedPreceding, -1)
        hot = (
            counts.filter(is_hot)
            .withColumn(_SLOTS, slots)
            .select(*keys, _SLOTS, F.coalesce(F.sum(_SLOTS).over(before), F.lit(0)).alias(_BASE))
        )
        known = hot if packed is None else hot.unionByName(packed, allowMissingColumns=True)
        if stable:
            # The number of a row in its scan task, taken before any join.
            body = body.withColumn(_ROW, F.monotonically_increasing_id())
        if packed is not None or stats["hot_bytes"] <= hot_broadcast_bytes:
            joined = body.join(F.broadcast(known), on=list(keys), how="left")
        else:
            copies = known.withColumn(_COPY, F.explode(F.sequence(F.lit(0), F.lit(HOT_JOIN_COPIES - 1))))
            copy = F.pmod(F.xxhash64(*_hashable(df), F.spark_partition_id()), F.lit(HOT_JOIN_COPIES)).cast("int")
            joined = body.withColumn(_COPY, copy).join(copies.hint("shuffle_hash"), on=[*keys, _COPY], how="left")
        if stable:
            turn = F.pmod(F.xxhash64(_ROW), F.col(_SLOTS))
        else:
            # Rows of a hot tuple stand together in each input task and are dealt over its slots in turn.
            turn = F.pmod(F.monotonically_increasing_id(), F.col(_SLOTS))
            if stats["hot"]:
                content = F.when(F.col(_BASE).isNotNull(), F.xxhash64(*_hashable(df)))
                joined = joined.withColumn(_ORDER, content).sortWithinPartitions(_BASE, _ORDER)
        by_hash = F.pmod(F.xxhash64(*keys), F.lit(n))
        cold_task = by_hash if packed is None else F.coalesce(F.col(_TASK), by_hash)
        task = F.when(F.col(_BASE).isNotNull(), F.lit(n) + F.col(_BASE) + turn).otherwise(cold_task)
        out = (
            joined.withColumn(_TASK, task.cast("int"))
            .repartitionById(result.num_tasks, F.col(_TASK))
            .select(*df.columns)
        )
    if sort_within:
        out = out.sortWithinPartitions(*keys, *sort_within)
    return PreparedExport(out, result, observation, cached)


def _observed(observation: Observation) -> dict:
    """What was recorded during the write; a plan that the optimiser finds empty is dropped with its observation."""
    try:
        return dict(observation.get)
    except (Py4JJavaError, AssertionError):
        return {"rows": 0}


def write_prepared(
    prep: PreparedExport,
    path: str,
    *,
    overwrite: str,
    max_records_per_file: int | None = None,
    compression: str | None = None,
    below: str | None = None,
    atomic: bool = True,
    on_step: Callable[[str], None] | None = None,
) -> ExportResult:
    """Write a :class:`PreparedExport` and release its cached planning data.

    ``below`` is the directory of one value of the first key: the rest of the tree is written
    into it, and the whole of it is replaced.  With ``atomic`` the files are written beside the
    target and exchanged for the old ones when all are there (:mod:`.commit`), else in place.
    """
    if overwrite not in OVERWRITE_MODES:
        raise ValueError(f"overwrite must be one of {sorted(OVERWRITE_MODES)}, got {overwrite!r}")
    result = prep.result
    limit = max_records_per_file or result.max_rows_per_file
    frame, keys = (prep.frame, result.keys) if below is None else (prep.frame.drop(result.keys[0]), result.keys[1:])
    try:
        if not atomic:
            _write(frame, path if below is None else below, keys, overwrite if below is None else "all", limit, compression)
        else:
            change = Replacement(frame.sparkSession, path, on_step)
            inside = "" if below is None else below.removeprefix(path.rstrip("/")).strip("/")
            leaving: list[str] = []
            try:
                with violations_raise():
                    _write(frame, f"{change.stage}/{inside}".rstrip("/"), keys, "all", limit, compression)
                if result.rows is None and prep.observation is not None:
                    result.rows = _observed(prep.observation)["rows"]
                if below is None:
                    arriving = [""] if overwrite == "all" else change.staged_directories(len(keys))
                elif result.rows == 0:
                    arriving, leaving = [], [inside] if exists(frame.sparkSession, below) else []
                else:
                    arriving = [inside]
            except Exception:
                change.discard()
                raise
            change.commit(arriving, leaving)
            result.removed = bool(leaving)
    finally:
        prep.release()
    result.path, result.overwrite = path, overwrite
    if prep.observation is not None:
        result.observed = _observed(prep.observation)
        if result.rows is None:
            result.rows = result.observed.get("rows")
    return result


def export_partitioned(
    df: DataFrame,
    path: str,
    *,
    overwrite: str,
    keys: Sequence[str] = KEYS,
    strategy: str = "split",
    max_rows_per_file: int | None = None,
    num_partitions: int | None = None,
    sort_within: Sequence[str] = (),
    max_records_per_file: int | None = None,
    compression: str | None = None,
    validate_keys: bool = True,
    observe_sum: str | None = None,
    atomic: bool = True,
    on_step: Callable[[str], None] | None = None,
) -> ExportResult:
    """Write ``df`` as Hive-partitioned Parquet below ``path``.

    ``overwrite`` has no default on purpose: ``"all"`` replaces the whole
    target (static), ``"partitions"`` replaces only the key directories that
    receive rows (dynamic).  NULL or empty key values are refused before
    anything is written (they would be conflated in
    ``__HIVE_DEFAULT_PARTITION__``).  ``observe_sum`` names a column whose sum
    (and the row count) is recorded while writing, without another scan.

    A run that fails or is killed leaves the old files or the new ones, never a mixture: the
    new tree is written beside the target and exchanged by renames (:mod:`.commit`).
    ``atomic=False`` writes in place, for filesystems without a rename of directories.
    """
    if overwrite not in OVERWRITE_MODES:
        raise ValueError(f"overwrite must be one of {sorted(OVERWRITE_MODES)}, got {overwrite!r}")
    if overwrite == "all":
        assert_not_reading_target(df, path)
    prep = prepare_export(
        df,
        keys=keys,
        strategy=strategy,
        max_rows_per_file=max_rows_per_file,
        num_partitions=num_partitions,
        sort_within=sort_within,
        validate_keys=validate_keys,
        observe_sum=observe_sum,
        check_inside=atomic,
    )
    return write_prepared(
        prep,
        path,
        overwrite=overwrite,
        max_records_per_file=max_records_per_file,
        compression=compression,
        atomic=atomic,
        on_step=on_step,
    )


def export_single_partition(
    df: DataFrame,
    root: str,
    key_values: dict,
    *,
    keys: Sequence[str] = KEYS,
    compression: str | None = None,
) -> str:
    """K6 — export one key tuple into its hand-built Hive directory.

    Equivalent of the legacy per-partition export: filter on every key (a
    conjunction of equalities, pushed to the scan), drop the key columns and
    replace only that directory.  Values are Column literals, never spliced
    into SQL text.  Returns the directory written.
    """
    keys = tuple(keys)
    typed = {k: F.lit(key_values[k]).cast(df.schema[k].dataType) for k in keys}
    cond = None
    for k in keys:
        c = F.col(k) == typed[k]
        cond = c if cond is None else cond & c
    # The directory's text is Spark's own: booleans, times and numbers as a partitioned write has them.
    texts = df.sparkSession.range(1).select(*[typed[k].cast("string").alias(k) for k in keys]).first()
    target = f"{root.rstrip('/')}/{partition_subpath(keys, list(texts))}"
    writer = df.filter(cond).drop(*keys).write.mode("overwrite")
    if compression:
        writer = writer.option("compression", compression)
    writer.parquet(target)
    return target
