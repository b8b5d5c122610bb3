"""Line dedup through a sharded minimal perfect hash.

Lines are known by 96 bits of a hash.  The hashes of lines found in enough
documents are dealt into shards; each shard gets a minimal perfect hash whose
slots index compact arrays: a fingerprint, the number of documents and the
document that keeps the line.  Documents send only their line hashes, packed by
shard, past those arrays; no line text is joined.
"""

from __future__ import annotations

import struct

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from partwright.llm.common import SPACE, byte_slices, lower_az, mix64, quoted, set_aside, shuffle_partitions, written

MIN_CHARS = 20
MIN_DOCS = 3
# Lines in one shard's arrays, about; bounds the memory of a probing task.
SHARD_KEYS = 400_000
# Each shard's arrays go to so many tasks at least, which share its probes, and to one for every so many documents
# that hold the shard's commonest line.
SHARD_COPIES = 4
COPY_DOCS = 1_000_000
SLICE_BYTES = 16 << 20

_DIGEST = np.dtype([("h", "<i8"), ("f", "<i4"), ("rest", "<i4")])


def line_key(line: str) -> str:
    return lower_az(line.strip(SPACE))


def _digest(key: str) -> bytes:
    return xxhash.xxh3_128_digest(key.encode("utf-8", "surrogatepass"))


def _distinct_lines(texts: list, min_chars: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the distinct long keys of each text, and the text's position for each."""
    digests, rows = [], []
    for i, text in enumerate(texts):
        keys = {line_key(x) for x in text.split("\n") if len(x) >= min_chars} if text else ()
        found = [_digest(k) for k in keys if len(k) >= min_chars]
        digests += found
        rows += [i] * len(found)
    return np.frombuffer(b"".join(digests), _DIGEST), np.array(rows, np.int64)


class PerfectHash:
    """Minimal perfect hash of distinct 64-bit keys: a cascade of collision-free bit arrays.

    A key's slot is the number of set bits before its own.
    """

    ROOM = 1.8

    def __init__(self, sizes: np.ndarray, bits: np.ndarray):
        self.sizes, self.bits = sizes, bits
        self.rank = np.cumsum(bits, dtype=np.int64) - 1

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        left, sizes, parts = keys.astype(np.uint64), [], []
        while len(left):
            size = max(8, int(cls.ROOM * len(left)))
            at = cls._place(left, len(sizes), size)
            alone = np.bincount(at, minlength=size) == 1
            sizes.append(size)
            parts.append(alone)
            left = left[~alone[at]]
        return cls(np.array(sizes, np.int64), np.concatenate(parts) if parts else np.zeros(0, bool))

    @staticmethod
    def _place(keys: np.ndarray, level: int, size: int) -> np.ndarray:
        return (mix64(keys + np.uint64((level + 1) * 0x9E3779B97F4A7C15 % 2**64)) % np.uint64(size)).astype(np.int64)

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """Slot of each key; -1 for some keys that are not in it, any slot for the others."""
        keys, found, left, start = keys.astype(np.uint64), np.full(len(keys), -1, np.int64), np.arange(len(keys)), 0
        for level, size in enumerate(self.sizes):
            at = start + self._place(keys[left], level, int(size))
            hit = self.bits[at]
            found[left[hit]] = self.rank[at[hit]]
            left, start = left[~hit], start + int(size)
        return found


def _index_shards(batches, names):
    """One row of arrays for each shard; a shard's rows are consecutive."""
    shard, parts = None, []

    def finish():
        rows = pa.Table.from_batches(parts)
        h, f = (rows.column(c).to_numpy() for c in ("h", "f"))
        unique, first = np.unique(h, return_index=True)
        rest = np.setdiff1d(np.arange(len(h)), first)  # of two lines with equal 64 bits, the second
        table = PerfectHash.build(unique)
        order = np.empty(len(unique), np.int64)
        order[table.slots(unique)] = first
        order = np.concatenate([order, rest])
        return pa.record_batch(
            [
                pa.array([shard], pa.int32()),
                pa.array([table.sizes.tolist()], pa.list_(pa.int64())),
                pa.array([np.packbits(table.bits).tobytes()], pa.binary()),
                pa.array([h[rest].tobytes()], pa.binary()),
                pa.array([h[order].tobytes()], pa.binary()),
                pa.array([f[order].tobytes()], pa.binary()),
                pa.array([rows.column("docs").to_numpy()[order].astype("<i4").tobytes()], pa.binary()),
                pa.ListArray.from_arrays(
                    pa.array([0, len(order)], pa.int32()), rows.column("owner").combine_chunks().take(pa.array(order))
                ),
            ],
            names=names,
        )

    for batch in batches:
        shards = batch.column("shard").to_numpy()
        cuts = [0, *(np.flatnonzero(np.diff(shards)) + 1).tolist(), len(shards)]
        for a, b in zip(cuts, cuts[1:], strict=False):
            if b > a:
                if shard is not None and shards[a] != shard:
                    yield finish()
                    parts = []
                shard = int(shards[a])
                parts.append(batch.slice(a, b - a).select(["h", "f", "docs", "owner"]))
    if parts:
        yield finish()


class _Shard:
    """A shard's arrays, ready to be probed."""

    def __init__(self, row):
        sizes = np.array(row["sizes"].as_py(), np.int64)
        bits = np.unpackbits(np.frombuffer(row["bits"].as_py(), np.uint8))[: int(sizes.sum())].astype(bool)
        self.table = PerfectHash(sizes, bits)
        self.more = np.frombuffer(row["more"].as_py(), "<i8")
        self.keys = np.frombuffer(row["keys"].as_py(), "<i8")
        self.prints = np.frombuffer(row["prints"].as_py(), "<i4")
        self.counts = np.frombuffer(row["counts"].as_py(), "<i4")
        self.owners = row["owners"].values

    def probe(self, h: np.ndarray, f: np.ndarray, ids: pa.Array, min_docs: int) -> np.ndarray:
        """Positions of probes whose line is frequent and kept by another document."""
        slots = self.table.slots(h)
        slots[(slots >= 0) & ((self.keys[slots] != h) | (self.prints[slots] != f))] = -1
        base = len(self.prints) - len(self.more)
        for k, other in enumerate(self.more):
            slots[(h == other) & (self.prints[base + k] == f)] = base + k
        at = np.flatnonzero(slots >= 0)
        at = at[self.counts[slots[at]] >= min_docs]
        if not len(at):
            return at
        own, keeper = ids.take(pa.array(at)), self.owners.take(pa.array(slots[at]))
        same = pa.compute.fill_null(pa.compute.equal(own, keeper), False)
        return at[~same.to_numpy(zero_copy_only=False)]


def line_dedup(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_chars: int = MIN_CHARS,
    min_docs: int = MIN_DOCS,
) -> DataFrame:
    """``df`` with the text less repeated lines, and n_lines, n_dropped.

    A line's key is the line stripped of ASCII white space, A-Z lower-cased.  Keys of
    at least ``min_chars`` code points found in at least ``min_docs`` documents lose
    all their lines but those of the document with the largest id.  Documents are
    told apart by id, so repeated rows count once and are treated alike; null ids are
    one document, which ranks last.  Null and empty texts hold one empty line and stay
    as they are.  Columns named like the new ones are replaced, others pass through;
    an empty table gives an empty result.
    """
    import pyarrow.compute  # noqa: F401  (pa.compute in the tasks)

    spark = df.sparkSession
    id_type = df.schema[id_col].dataType
    slim = df.select(quoted(id_col).alias("id"), quoted(text_col).alias("text"))

    def lines(batches):
        for batch in batches:
            for part in byte_slices(batch, "text", SLICE_BYTES):
                found, rows = _distinct_lines(part.column("text").to_pylist(), min_chars)
                ids = part.column("id").take(pa.array(rows))
                yield pa.record_batch([pa.array(found["h"]), pa.array(found["f"]), ids], names=["h", "f", "id"])

    line_schema = T.StructType(
        [T.StructField("h", T.LongType()), T.StructField("f", T.IntegerType()), T.StructField("id", id_type)]
    )
    frequent = written(
        slim.mapInArrow(lines, line_schema)
        .groupBy("h", "f", "id")
        .agg(F.lit(1).alias("one"))
        .groupBy("h", "f")
        .agg(F.count(F.lit(1)).cast("int").alias("docs"), F.max("id").alias("owner"))
        .filter(F.col("docs") >= min_docs),
        "frequent_lines",
    )
    shards = max(shuffle_partitions(spark), -(-frequent.count() // SHARD_KEYS))
    # A shard is met in as many tasks as the documents of its commonest line ask for; one number a shard.
    copies = np.full(shards, SHARD_COPIES, np.int32)
    commonest = frequent.groupBy(F.pmod("h", F.lit(shards)).cast("int").alias("shard")).agg(F.max("docs").alias("docs"))
    for row in commonest.filter(F.col("docs") > SHARD_COPIES * COPY_DOCS).collect():
        copies[row.shard] = -(-row.docs // COPY_DOCS)

    names = ["shard", "sizes", "bits", "more", "keys", "prints", "counts", "owners"]
    index_schema = T.StructType(
        [
            T.StructField("shard", T.IntegerType()),
            T.StructField("sizes", T.ArrayType(T.LongType())),
            *[T.StructField(c, T.BinaryType()) for c in names[2:7]],
            T.StructField("owners", T.ArrayType(id_type)),
        ]
    )
    index = (
        frequent.withColumn("shard", F.pmod("h", F.lit(shards)).cast("int"))
        .repartition("shard")
        .sortWithinPartitions("shard")
        .mapInArrow(lambda batches: _index_shards(batches, names), index_schema)
    )

    def probes(batches):
        for n, batch in enumerate(batches):
            for part in byte_slices(batch, "text", SLICE_BYTES):
                found, rows = _distinct_lines(part.column("text").to_pylist(), min_chars)
                shard = found["h"] % shards
                order = np.argsort(shard, kind="stable")
                shard, found, rows = shard[order], found[order], rows[order]
                cuts = np.concatenate([[0], np.flatnonzero(np.diff(shard)) + 1, [len(shard)]]) if len(shard) else [0]
                if len(cuts) < 2:
                    continue
                yield pa.record_batch(
                    [
                        pa.array(shard[cuts[:-1]].astype(np.int32)),
                        pa.array(((rows[cuts[:-1]] + n) % copies[shard[cuts[:-1]]]).astype(np.int32)),
                        pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), part.column("id").take(pa.array(rows))),
                        pa.array([found["h"][a:b].tobytes() for a, b in zip(cuts, cuts[1:], strict=False)], pa.binary()),
                        pa.array([found["f"][a:b].tobytes() for a, b in zip(cuts, cuts[1:], strict=False)], pa.binary()),
                    ],
                    names=["shard", "copy", "ids", "h", "f"],
                )

    probe_schema = T.StructType(
        [
            T.StructField("shard", T.IntegerType()),
            T.StructField("copy", T.IntegerType()),
            T.StructField("ids", T.ArrayType(id_type)),
            T.StructField("h", T.BinaryType()),
            T.StructField("f", T.BinaryType()),
        ]
    )
    number = F.broadcast(spark.createDataFrame([(s, int(n)) for s, n in enumerate(copies)], "shard int, copies int"))
    met = (
        index.join(number, "shard")
        .select("*", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)).alias("copy"), F.lit(0).alias("kind"))
        .drop("copies")
        .unionByName(slim.mapInArrow(probes, probe_schema).withColumn("kind", F.lit(1)), allowMissingColumns=True)
        .repartition("shard", "copy")
        .sortWithinPartitions("shard", "copy", "kind")
    )

    def probe(batches):
        known, key = None, None
        for batch in batches:
            out_ids, out_h, out_f = [], [], []
            for i in range(batch.num_rows):
                row = {c: batch.column(c)[i] for c in batch.schema.names}
                here = (row["shard"].as_py(), row["copy"].as_py())
                if row["kind"].as_py() == 0:
                    known, key = _Shard(row), here
                elif key == here:
                    h, f = np.frombuffer(row["h"].as_py(), "<i8"), np.frombuffer(row["f"].as_py(), "<i4")
                    at = known.probe(h, f, row["ids"].values, min_docs)
                    if len(at):
                        out_ids.append(row["ids"].values.take(pa.array(at)))
                        out_h.append(h[at])
                        out_f.append(f[at])
            if out_ids:
                yield pa.record_batch(
                    [pa.array(np.concatenate(out_h)), pa.array(np.concatenate(out_f)), pa.concat_arrays(out_ids)],
                    names=["h", "f", "id"],
                )

    # At most the distinct lines of one document each.
    dropped = (
        met.mapInArrow(probe, line_schema)
        .groupBy("id")
        .agg(F.collect_set(F.struct("h", "f")).alias("lines"))
        .withColumnRenamed("id", "of")
    )
    kept, inner, back = set_aside(df, ("n_lines", "n_dropped"))
    passed, text_at = [f"in_{k}" for k in range(len(kept))], f"in_{kept.index(text_col)}"
    own = df.select(*inner, quoted(id_col).alias("own"))
    joined = own.join(dropped, F.col("own").eqNullSafe(F.col("of")), "left").drop("own", "of")

    def rewrite(batches):
        for batch in batches:
            for part in byte_slices(batch, text_at, SLICE_BYTES):
                texts, n_lines, n_dropped = [], [], []
                drops = part.column("lines")
                for i, text in enumerate(part.column(text_at).to_pylist()):
                    parts = (text or "").split("\n")
                    n_lines.append(len(parts))
                    if drops[i].is_valid:
                        gone = {(x["h"], x["f"]) for x in drops[i].as_py()}
                        left = [
                            x
                            for x in parts
                            if len(k := line_key(x)) < min_chars or struct.unpack_from("<qi", _digest(k)) not in gone
                        ]
                        n_dropped.append(len(parts) - len(left))
                        texts.append("\n".join(left))
                    else:
                        n_dropped.append(0)
                        texts.append(text)
                out = {c: part.column(c) for c in passed}
                out[text_at] = pa.array(texts, pa.string())
                out["n_lines"], out["n_dropped"] = pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64())
                yield pa.record_batch(list(out.values()), names=list(out))

    out_schema = T.StructType(
        [
            *[T.StructField(p, df.schema[c].dataType) for p, c in zip(passed, kept, strict=True)],
            T.StructField("n_lines", T.LongType()),
            T.StructField("n_dropped", T.LongType()),
        ]
    )
    return joined.mapInArrow(rewrite, out_schema).select(*back, "n_lines", "n_dropped")
