"""Substring dedup by content-defined chunks.

A gear hash rolls over the bytes of a text; a chunk ends where the hash of the last
sixteen bytes is small, so chunks after an insertion are the chunks before it.  Chunks
with equal digests are copies.  Copies count only in runs of adjacent copied chunks of
at least ``min_bytes`` bytes; of each chunk one copy stays.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from partwright.llm.common import byte_slices, mix64, utf8_parts, written

MEAN_BYTES = 24
MOST_BYTES = 128
# Shorter than any passage of 50 words, longer than a repeated short line.
MIN_BYTES = 100
SLICE_BYTES = 4 << 20
# A digest in so many texts, and in more than one of ``HOT_DIGESTS`` of all copies, is joined by broadcast, so its copies
# meet in no task; there are at most ``HOT_DIGESTS`` of them.
HOT_COPIES = 10_000
HOT_DIGESTS = 100_000

# A fixed random value for each byte; the same on every machine.
GEAR = np.random.Generator(np.random.PCG64(20240131)).integers(0, 1 << 16, 256, dtype=np.uint16)
_BASE = np.uint64(0xD1342543DE82EF95)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))


def chunk_ends(flat: np.ndarray, offsets: np.ndarray, mean: int, most: int) -> np.ndarray:
    """Ends of the chunks of texts laid end to end; the end of each text is among them."""
    n = len(flat)
    if not n:
        return np.zeros(0, np.int64)
    lengths = np.diff(offsets)
    place = np.arange(n) - np.repeat(offsets[:-1], lengths)
    gear = GEAR[flat]
    for k in (1, 2, 4, 8):  # the hash of 2k bytes from those of k bytes; bytes before a text count 0
        if n > k:
            gear[k:] = gear[k:] + np.where(place[k:] >= k, gear[:-k] << np.uint16(k), np.uint16(0))
    cut = gear < np.uint16((1 << 16) // mean)
    cut[offsets[1:][lengths > 0] - 1] = True
    ends = np.flatnonzero(cut) + 1
    gaps = np.diff(ends, prepend=0)
    pieces = -(-gaps // most)
    if len(pieces) and pieces.max() > 1:  # long chunks are cut every ``most`` bytes from their start
        which = np.repeat(np.arange(len(ends)), pieces)
        number = np.arange(len(which)) - np.repeat(np.cumsum(pieces) - pieces, pieces) + 1
        ends = np.minimum((ends - gaps)[which] + number * most, ends[which])
    return ends


def chunk_digests(flat: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit digest of each chunk."""
    n = len(flat)
    powers = np.full(n + 1, _BASE)
    powers[0] = 1
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum((flat.astype(np.uint64) + np.uint64(1)) * np.cumprod(powers, dtype=np.uint64)[:n], out=sums[1:])
    powers[1:] = _INVERSE
    back = np.cumprod(powers, dtype=np.uint64)
    return mix64((sums[ends] - sums[starts]) * back[starts] + (ends - starts).astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))


def _chunks(texts: pa.Array, mean: int, most: int):
    """Start, end and text of every chunk, with the bytes."""
    flat, offsets = utf8_parts(texts)
    ends = chunk_ends(flat, offsets, mean, most)
    starts = np.concatenate([[0], ends[:-1]]) if len(ends) else ends
    text = np.searchsorted(offsets, starts, side="right") - 1
    return flat, offsets, starts, ends, text


def _emit(batches, mean, most):
    """The distinct digests of each text, and whether the text holds them more than once."""
    for batch in batches:
        for part in byte_slices(batch, "text", SLICE_BYTES):
            flat, _, starts, ends, text = _chunks(part.column("text"), mean, most)
            digest = chunk_digests(flat, starts, ends)
            keys = part.column("key").to_numpy()
            order = np.lexsort((digest, text))
            digest, text = digest[order], text[order]
            first = np.ones(len(digest), bool)
            first[1:] = (digest[1:] != digest[:-1]) | (text[1:] != text[:-1])
            again = np.diff(np.append(np.flatnonzero(first), len(digest))) > 1
            yield pa.record_batch(
                [pa.array(digest[first].view(np.int64)), pa.array(keys[text[first]]), pa.array(again)],
                names=["digest", "key", "again"],
            )


def copied_digests(chunks: DataFrame) -> DataFrame:
    """(digest, key, stays) of the (text, digest) pairs ``chunks`` whose digest has copies; it stays in the text of the least key."""
    found = chunks.groupBy("digest").agg(
        F.min("key").alias("least"),
        F.max("key").alias("greatest"),
        F.max(F.col("again").cast("int")).alias("again"),
        F.count(F.lit(1)).alias("texts"),
    )
    found = written(found.filter("least < greatest or again = 1").select("digest", "least", "texts"), "copied_digests")
    total = found.agg(F.sum("texts")).first()[0] or 0
    hot = F.col("texts") >= max(HOT_COPIES, -(-total // HOT_DIGESTS))
    common = found.filter(hot).select("digest", "least")
    rare = found.filter(~hot).select("digest", "least")
    pairs, common = chunks.select("digest", "key"), F.broadcast(common)
    met = pairs.join(common, "digest").unionByName(
        pairs.join(common, "digest", "left_anti").hint("merge").join(rare, "digest")
    )
    return met.select("digest", "key", (F.col("key") == F.col("least")).alias("stays"))


def _long_runs(marked: np.ndarray, text: np.ndarray, lengths: np.ndarray, least: int) -> np.ndarray:
    """``marked`` less the runs of adjacent marked chunks of one text of fewer than ``least`` bytes."""
    if not len(marked):
        return marked
    new = np.ones(len(marked), bool)
    new[1:] = (marked[1:] != marked[:-1]) | (text[1:] != text[:-1])
    run = np.cumsum(new) - 1
    return marked & (np.bincount(run, lengths) >= least)[run]


def _rewrite(batches, mean, most, min_bytes):
    for batch in batches:
        for part in byte_slices(batch, "text", SLICE_BYTES):
            flat, offsets, starts, ends, text = _chunks(part.column("text"), mean, most)
            copied, stays = np.zeros(len(starts), bool), np.zeros(len(starts), bool)
            first = np.searchsorted(text, np.arange(part.num_rows + 1))
            digest = chunk_digests(flat, starts, ends).view(np.int64)
            found = part.column("copies")
            for i in np.flatnonzero(found.is_valid().to_numpy(zero_copy_only=False)):
                own = slice(first[i], first[i + 1])
                known = found[int(i)].values
                names, here = known.field("digest").to_numpy(), known.field("stays").to_numpy(zero_copy_only=False)
                order = np.argsort(names)
                names, here = names[order], here[order]
                at = np.minimum(np.searchsorted(names, digest[own]), len(names) - 1)
                copied[own] = names[at] == digest[own]
                earliest = np.zeros(own.stop - own.start, bool)
                earliest[np.unique(digest[own], return_index=True)[1]] = True
                stays[own] = copied[own] & here[at] & earliest
            lengths = ends - starts
            repeated = _long_runs(copied, text, lengths, min_bytes)
            # A few chunks whose copy that stays lies elsewhere are no passage: they are left in place.
            gone = _long_runs(repeated & ~stays, text, lengths, min_bytes)
            data = flat.tobytes()
            kept, spans, n_repeated, n_removed = [], [], [], []
            for i in range(part.num_rows):
                a, b = first[i], first[i + 1]
                n_repeated.append(int(lengths[a:b][repeated[a:b]].sum()))
                n_removed.append(int(lengths[a:b][gone[a:b]].sum()))
                lost = np.flatnonzero(gone[a:b]) + a
                base = int(offsets[i])
                if not len(lost):
                    spans.append([])
                    kept.append(data[base : int(offsets[i + 1])])
                    continue
                brk = np.flatnonzero(np.diff(lost) > 1)
                s, e = starts[lost[np.append(0, brk + 1)]], ends[lost[np.append(brk, len(lost) - 1)]]
                spans.append([{"start": int(x) - base, "end": int(y) - base} for x, y in zip(s, e, strict=True)])
                edges = [base, *np.stack([s, e], axis=1).ravel().tolist(), int(offsets[i + 1])]
                kept.append(b"".join(data[x:y] for x, y in zip(edges[::2], edges[1::2], strict=True)))
            yield pa.record_batch(
                [
                    part.column("id"),
                    pa.array(np.diff(offsets)),
                    pa.array(n_removed, pa.int64()),
                    pa.array(n_repeated, pa.int64()),
                    pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                    pa.array(kept, pa.binary()),
                ],
                names=["doc_id", "n_bytes", "n_removed", "n_repeated", "spans", "kept"],
            )


def _struct(**fields) -> T.StructType:
    return T.StructType([T.StructField(k, v) for k, v in fields.items()])


def chunk_dedup(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    mean: int = MEAN_BYTES,
    most: int = MOST_BYTES,
    min_bytes: int = MIN_BYTES,
) -> DataFrame:
    """One row per input row: doc_id, n_bytes, n_removed, n_repeated, spans, kept.

    n_repeated counts the bytes in runs of copied chunks of ``min_bytes`` or more, n_removed those
    of them of which another copy stays; spans are the removed runs (start, end), kept the
    other bytes, which need not be valid UTF-8.  The copy that stays is that of the row with the
    least hash of id and text, the first within that row.  Chunk digests have 64 bits.
    Null and empty texts have no chunks.  Rows that agree in id and text are one document, and
    are treated alike; null ids are an id.  Other columns are ignored; an empty table gives an
    empty result.
    """
    raw, long = T.BinaryType(), T.LongType()
    docs = df.select(
        F.col(id_col).alias("id"),
        F.xxhash64(F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.col(text_col)).alias("key"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    )
    chunks = docs.mapInArrow(
        lambda batches: _emit(batches, mean, most), _struct(digest=long, key=long, again=T.BooleanType())
    )
    # Rows alike in id and text show the same digests of the same key again.
    listed = copied_digests(chunks).groupBy("key").agg(F.collect_set(F.struct("digest", "stays")).alias("copies"))
    span = T.ArrayType(_struct(start=long, end=long))
    return docs.join(listed, "key", "left").mapInArrow(
        lambda batches: _rewrite(batches, mean, most, min_bytes),
        _struct(doc_id=df.schema[id_col].dataType, n_bytes=long, n_removed=long, n_repeated=long, spans=span, kept=raw),
    )
