"""Removal of repeated long substrings by refining buckets of byte positions.

Positions start in buckets of equal q-grams and are refined by the buckets of later
offsets: the identifier of a string twice as long is made of the identifiers of its
halves, down to whole windows of ``length`` bytes.  Only sampled positions are
shuffled: of the q-grams of each window the least one is its pointer, so equal windows
share a pointer and its offset, and neighbouring windows with one pointer travel as
one run.  Runs with equal identifiers repeat as a whole; other runs of a bucket are
refined window by window.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from partwright.llm.common import mix64, pair64, utf8_parts, written

LENGTH = 400
# Bytes handled at a time; a longer text is cut into overlapping pieces.
STEP_BYTES = 1 << 20
# A bucket with more distinct runs is refined by a shuffle of its windows instead of in one task.
BUCKET_RUNS = 20_000
# A key of so many rows, and of more than one in ``HOT_KEYS`` of all, is joined by broadcast, so its rows meet in no task;
# there are at most ``HOT_KEYS`` of them.
HOT_ROWS = 10_000
HOT_KEYS = 100_000

_PLACE_BITS = 24  # of a position within a step


def _widths(length: int) -> tuple[int, int]:
    """Bytes of a q-gram (a third of a window at most) and of the largest power of two in a window."""
    if length < 32:
        raise ValueError("windows have 32 bytes or more")
    return 1 << ((length // 3).bit_length() - 1), 1 << (length.bit_length() - 1)


def window_ids(data: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Identifiers of the q-gram and of the window that start at each position, where they fit."""
    gram, most = _widths(length)
    ids = data.astype(np.uint64)
    for k in (1, 2, 4):
        ids = ids[:-k] | (ids[k:] << np.uint64(8 * k)) if len(ids) > k else ids[:0]
    ids, width = mix64(ids), 8
    grams = ids
    while width < most:
        if width == gram:
            grams = ids
        ids = pair64(ids[:-width], ids[width:]) if len(ids) > width else ids[:0]
        width *= 2
    if length > most:
        more = length - most
        ids = pair64(ids[:-more], ids[more:]) if len(ids) > more else ids[:0]
    return grams, ids


def _least_gram(grams: np.ndarray, length: int) -> np.ndarray:
    """Position of the least q-gram of the window at each position, the leftmost of equal ones."""
    place = np.uint64((1 << _PLACE_BITS) - 1)
    keys = (grams & ~place) | np.arange(len(grams), dtype=np.uint64)
    span, k = length - _widths(length)[0] + 1, 1
    while 2 * k <= span:
        keys = np.minimum(keys[:-k], keys[k:])
        k *= 2
    if span > k:
        keys = np.minimum(keys[: k - span], keys[span - k :])
    return (keys & place).astype(np.int64)


def _steps(flat: np.ndarray, offsets: np.ndarray, length: int, step: int):
    """Texts packed into arrays of about ``step`` bytes: (bytes, piece starts, text of each piece, place of each piece).

    Pieces of one text overlap, so that every window lies in exactly one of them.
    """
    pieces, total = [], 0

    def pack():
        data = np.concatenate([flat[a:b] for _, _, a, b in pieces])
        starts = np.concatenate([[0], np.cumsum([b - a for _, _, a, b in pieces])])
        return data, starts, np.array([p[0] for p in pieces]), np.array([p[1] for p in pieces])

    for i in range(len(offsets) - 1):
        a, b = int(offsets[i]), int(offsets[i + 1])
        for at in range(a, b - length + 1, step):
            end = min(at + step + length - 1, b)
            if pieces and total + end - at > 2 * step:
                yield pack()
                pieces, total = [], 0
            pieces.append((i, at - a, at, end))
            total += end - at
            if total >= step:
                yield pack()
                pieces, total = [], 0
    if pieces:
        yield pack()


def _runs(flat, offsets, length, step):
    """Runs of windows with one pointer: text, first window's place, windows, pointer's offset, bucket, run identifier."""
    for data, starts, text, place in _steps(flat, offsets, length, step):
        grams, windows = window_ids(data, length)
        pointer = _least_gram(grams, length)
        piece = np.repeat(np.arange(len(text)), np.diff(starts))[: len(windows)]
        at = np.arange(len(windows))
        valid = at + length <= starts[piece + 1]
        at, piece = at[valid], piece[valid]
        to = pointer[at]
        new = np.ones(len(at), bool)
        new[1:] = (to[1:] != to[:-1]) | (piece[1:] != piece[:-1])
        first = np.flatnonzero(new)
        last = np.concatenate([first[1:], [len(at)]]) - 1
        a, b, to, piece = at[first], at[last], to[first], piece[first]
        shape = ((to - a).astype(np.uint64) << np.uint64(32)) | (b - a).astype(np.uint64)
        run = pair64(pair64(windows[a], windows[b]), shape)
        yield text[piece], place[piece] + a - starts[piece], b - a + 1, to - a, grams[to], run


def _struct(**fields) -> T.StructType:
    return T.StructType([T.StructField(k, v) for k, v in fields.items()])


_LONG, _INT = T.LongType(), T.IntegerType()
_RUN = {"bucket": _LONG, "run": _LONG, "id": _LONG, "hash": _LONG, "at": _LONG, "windows": _INT, "offset": _INT}
_SPAN = {"id": _LONG, "hash": _LONG, "start": _LONG, "end": _LONG}


def _emit_runs(batches, length, step):
    for batch in batches:
        flat, offsets = utf8_parts(batch.column("text"))
        ids, hashes = batch.column("id").to_numpy(), batch.column("hash").to_numpy()
        for text, at, windows, offset, bucket, run in _runs(flat, offsets, length, step):
            yield pa.record_batch(
                [
                    pa.array(bucket.view(np.int64)),
                    pa.array(run.view(np.int64)),
                    pa.array(ids[text]),
                    pa.array(hashes[text]),
                    pa.array(at),
                    pa.array(windows.astype(np.int32)),
                    pa.array(offset.astype(np.int32)),
                ],
                names=list(_RUN),
            )


def _cut_runs(batches, length):
    """Bytes of the runs listed with each text."""
    for batch in batches:
        for i in range(batch.num_rows):
            text = batch.column("text")[i].as_buffer()
            text = np.frombuffer(text, np.uint8) if text is not None and text.size else np.zeros(0, np.uint8)
            runs = batch.column("runs")[i].values
            at = runs.field("at").to_numpy()
            windows = runs.field("windows").to_numpy()
            n = len(at)
            for a in range(0, n, 5000):
                b = min(a + 5000, n)
                yield pa.record_batch(
                    [
                        runs.field("bucket").slice(a, b - a),
                        pa.array(np.full(b - a, batch.column("id")[i].as_py(), np.int64)),
                        pa.array(np.full(b - a, batch.column("hash")[i].as_py(), np.int64)),
                        pa.array(at[a:b]),
                        pa.array(windows[a:b]),
                        runs.field("offset").slice(a, b - a),
                        runs.field("hot").slice(a, b - a),
                        pa.array([text[p : p + w + length - 1].tobytes() for p, w in zip(at[a:b], windows[a:b], strict=True)], pa.binary()),
                    ],
                    names=["bucket", "id", "hash", "at", "windows", "offset", "hot", "bytes"],
                )


def _all_windows(rows: dict, length: int):
    """(row, window's number in its run, identifier) of every window of rows of bytes."""
    data = np.frombuffer(b"".join(rows["bytes"]), np.uint8)
    sizes = rows["windows"] + length - 1
    starts = np.concatenate([[0], np.cumsum(sizes)])[:-1]
    ids = window_ids(data, length)[1]
    row = np.repeat(np.arange(len(sizes)), rows["windows"])
    number = np.arange(len(row)) - np.repeat(np.cumsum(rows["windows"]) - rows["windows"], rows["windows"])
    return row, number, ids[starts[row] + number]


_FIELDS = ("bucket", "id", "hash", "at", "windows", "offset")


def _refine(batches, length, step):
    """Spans of the windows found in two runs of a bucket; a bucket's rows are consecutive."""

    def spans(rows):
        row, number, ids = _all_windows(rows, length)
        bucket, back = rows["bucket"][row], rows["offset"][row] - number
        order = np.lexsort((ids, back, bucket))
        same = (
            (bucket[order][1:] == bucket[order][:-1])
            & (back[order][1:] == back[order][:-1])
            & (ids[order][1:] == ids[order][:-1])
        )
        twice = np.zeros(len(row), bool)
        twice[order[1:][same]] = True
        twice[order[:-1][same]] = True
        row, number = row[twice], number[twice]
        new = np.ones(len(row), bool)
        new[1:] = (row[1:] != row[:-1]) | (number[1:] != number[:-1] + 1)
        first = np.flatnonzero(new)
        last = np.concatenate([first[1:], [len(row)]]) - 1 if len(first) else first
        row, a, b = row[first], number[first], number[last]
        at = rows["at"][row]
        return pa.record_batch(
            [pa.array(rows["id"][row]), pa.array(rows["hash"][row]), pa.array(at + a), pa.array(at + b + length)],
            names=list(_SPAN),
        )

    def joined(parts):
        return {c: np.concatenate([p[c] for p in parts]) for c in _FIELDS} | {"bytes": [x for p in parts for x in p["bytes"]]}

    parts, size, last = [], 0, None
    for batch in batches:
        values = {c: batch.column(c).to_numpy() for c in _FIELDS}
        data = batch.column("bytes").to_pylist()
        cuts = np.flatnonzero(np.diff(values["bucket"])) + 1
        for a, b in zip([0, *cuts], [*cuts, len(data)], strict=True):
            if b > a:
                if size >= step and values["bucket"][a] != last:
                    yield spans(joined(parts))
                    parts, size = [], 0
                last = values["bucket"][a]
                parts.append({c: values[c][a:b] for c in _FIELDS} | {"bytes": data[a:b]})
                size += sum(map(len, data[a:b]))
    if parts:
        yield spans(joined(parts))


def _emit_windows(batches, length):
    for batch in batches:
        for a in range(0, batch.num_rows, 5000):
            part = batch.slice(a, 5000)
            rows = {c: part.column(c).to_numpy() for c in _FIELDS} | {"bytes": part.column("bytes").to_pylist()}
            row, number, ids = _all_windows(rows, length)
            yield pa.record_batch(
                [
                    pa.array(rows["bucket"][row]),
                    pa.array((rows["offset"][row] - number).astype(np.int32)),
                    pa.array(ids.view(np.int64)),
                    pa.array(rows["id"][row]),
                    pa.array(rows["hash"][row]),
                    pa.array(rows["at"][row] + number),
                ],
                names=["bucket", "back", "window", "id", "hash", "start"],
            )


def _remove(batches):
    for batch in batches:
        kept, spans, removed = [], [], []
        for i in range(batch.num_rows):
            text = batch.column("text")[i].as_buffer()
            text = memoryview(text) if text is not None else memoryview(b"")
            found = batch.column("spans")[i]
            merged = []
            if found.is_valid and len(found.values):
                start, end = (found.values.field(c).to_numpy() for c in ("start", "end"))
                order = np.argsort(start, kind="stable")
                start, end = start[order], np.maximum.accumulate(end[order])
                first = np.concatenate([[True], start[1:] > end[:-1]])
                merged = list(zip(start[first].tolist(), end[np.concatenate([first[1:], [True]])].tolist(), strict=True))
            edges = [0, *[x for span in merged for x in span], len(text)]
            kept.append(b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)))
            spans.append([{"start": a, "end": b} for a, b in merged])
            removed.append(sum(b - a for a, b in merged))
        yield pa.record_batch(
            [
                batch.column("id"),
                pa.array([len(k) + r for k, r in zip(kept, removed, strict=True)], pa.int64()),
                pa.array(removed, pa.int64()),
                pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                pa.array(kept, pa.binary()),
            ],
            names=["doc_id", "n_bytes", "n_removed", "spans", "kept"],
        )


def counted(rows: DataFrame, counts: DataFrame, keys: list[str]) -> DataFrame:
    """``rows`` whose ``keys`` are in ``counts``, with the number ``n`` of rows that it has for them."""
    total = counts.agg(F.sum("n")).first()[0] or 0
    hot = F.col("n") >= max(HOT_ROWS, -(-total // HOT_KEYS))
    common, rare = counts.filter(hot), counts.filter(~hot)
    others = rows.join(F.broadcast(common.select(*keys)), keys, "left_anti")
    return rows.join(F.broadcast(common), keys).unionByName(others.join(rare, keys))


# Stands for a null id among the keys; such rows are told apart by their texts.
_NO_ID = -(1 << 63)


def suffix_dedup(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, bucket_runs: int = BUCKET_RUNS
) -> DataFrame:
    """One row per input row: doc_id, n_bytes, n_removed, spans, kept.

    A byte goes if a string of ``length`` bytes that covers it starts at another place,
    in any text, as well.  Texts are UTF-8 bytes, a null text has none; spans are the maximal
    removed runs (start, end) and kept holds the other bytes, which need not be
    valid UTF-8.  Ids are whole numbers or null.  Repeated rows count as two places each.
    Other columns are ignored; an empty table gives an empty result.
    """
    step = STEP_BYTES
    docs = df.select(
        F.coalesce(F.col(id_col).cast("long"), F.lit(_NO_ID)).alias("id"),
        F.xxhash64(text_col).alias("hash"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    )
    runs = written(
        docs.filter(F.octet_length("text") >= length).mapInArrow(
            lambda batches: _emit_runs(batches, length, step), _struct(**_RUN)
        ),
        "window_runs",
    )
    # Most buckets hold one run; only the others are looked at again.
    shared = written(runs.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "shared_buckets")
    runs = written(counted(runs, shared, ["bucket"]).drop("n"), "shared_runs")
    kinds = runs.groupBy("bucket", "run").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct("id", "hash", "at", "windows", "offset")).alias("one")
    )
    kinds = written(kinds, "kinds_of_runs")
    whole = counted(runs, kinds.filter("n > 1").select("bucket", "run", "n"), ["bucket", "run"]).select(
        "id", "hash", F.col("at").alias("start"), (F.col("at") + F.col("windows") + (length - 1)).alias("end")
    )

    several = written(kinds.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "mixed_buckets")
    listed = (
        counted(kinds.select("bucket", "one"), several, ["bucket"])
        .select("bucket", "one.*", (F.col("n") > bucket_runs).alias("hot"))
        .groupBy("id", "hash")
        .agg(F.collect_list(F.struct("bucket", "at", "windows", "offset", "hot")).alias("runs"))
    )
    one_text = docs.join(listed, ["id", "hash"]).dropDuplicates(["id", "hash"])
    cut = {"bucket": _LONG, "id": _LONG, "hash": _LONG, "at": _LONG, "windows": _INT, "offset": _INT}
    bytes_of = written(
        one_text.mapInArrow(
            lambda batches: _cut_runs(batches, length), _struct(**cut, hot=T.BooleanType(), bytes=T.BinaryType())
        ),
        "bytes_of_runs",
    )
    near = (
        bytes_of.filter("not hot")
        .repartition("bucket")
        .sortWithinPartitions("bucket")
        .mapInArrow(lambda batches: _refine(batches, length, step), _struct(**_SPAN))
    )
    spans = whole.unionByName(near)
    crowded = bytes_of.filter("hot")
    if not crowded.isEmpty():
        window = {"bucket": _LONG, "back": _INT, "window": _LONG, "id": _LONG, "hash": _LONG, "start": _LONG}
        windows = written(crowded.mapInArrow(lambda batches: _emit_windows(batches, length), _struct(**window)), "windows")
        key = ["bucket", "back", "window"]
        twice = written(windows.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "windows_twice")
        spans = spans.unionByName(
            counted(windows, twice, key).select("id", "hash", "start", (F.col("start") + length).alias("end"))
        )
    gathered = spans.groupBy("id", "hash").agg(F.collect_list(F.struct("start", "end")).alias("spans"))
    span = T.ArrayType(T.StructType([T.StructField("start", _LONG), T.StructField("end", _LONG)]))
    out = docs.join(gathered, ["id", "hash"], "left").mapInArrow(
        _remove, _struct(doc_id=_LONG, n_bytes=_LONG, n_removed=_LONG, spans=span, kept=T.BinaryType())
    )
    return out.withColumn("doc_id", F.when(F.col("doc_id") != _NO_ID, F.col("doc_id")))
