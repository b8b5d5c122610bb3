"""Periodic run detection: recursive frequency splitting, then a lag scan of what survives.

A run of period q holds at least max(6, 4 q) words, so each of its words stands in it
four times or more.  A word that occurs less often within its segment is in no run and
splits the segment; the pieces are judged anew until nothing changes.  The surviving
segments are scanned lag by lag: a run of period q has 3 q words that equal the word q
later, hence three neighbouring multiples of q that do, so only every q-th word is
compared.  Scanning lag q costs a q-th of the segments that are long enough for it.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from partwright.llm.common import byte_slices, utf8_parts, without

# Fixed by the contract: a run has max(MIN_LENGTH, MIN_REPEATS * period) words or more.
MIN_LENGTH = 6
MIN_REPEATS = 4
# Bytes of text that are scanned together.
SLICE_BYTES = 4 << 20

FIELDS = T.StructType(
    [
        T.StructField("n_runs", T.LongType()),
        T.StructField("start", T.LongType()),
        T.StructField("length", T.LongType()),
        T.StructField("period", T.LongType()),
        T.StructField("exponent_milli", T.LongType()),
        T.StructField("runs_sha256", T.StringType()),
        T.StructField("collapsed", T.StringType()),
    ]
)


def surviving_segments(words: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the stretches of ``words`` that frequency splitting leaves.

    ``bounds`` are the n + 1 offsets of the texts; equal words of different texts may share
    their number.  Only segments that the last round split are counted again.
    """
    starts, ends = bounds[:-1], bounds[1:]
    done: list[tuple[np.ndarray, np.ndarray]] = []
    while True:
        long = ends - starts >= MIN_LENGTH
        starts, ends = starts[long], ends[long]
        if not len(starts):
            break
        lengths = ends - starts
        segment = np.repeat(np.arange(len(starts)), lengths)
        at = np.arange(lengths.sum()) + np.repeat(starts - np.concatenate([[0], np.cumsum(lengths)[:-1]]), lengths)
        key = segment * (int(words.max()) + 1) + words[at]
        _, slot, count = np.unique(key, return_inverse=True, return_counts=True)
        rare = count[slot] < MIN_REPEATS
        split = np.zeros(len(starts), bool)
        split[segment[rare]] = True
        done.append((starts[~split], ends[~split]))
        # The pieces are the stretches of words that are not rare, within one segment.
        live = ~rare & split[segment]
        first = live & ~np.concatenate([[False], live[:-1] & (segment[1:] == segment[:-1])])
        last = live & ~np.concatenate([live[1:] & (segment[1:] == segment[:-1]), [False]])
        starts, ends = at[first], at[last] + 1
    if not done:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    starts, ends = np.concatenate([s for s, _ in done]), np.concatenate([e for _, e in done])
    order = np.argsort(starts, kind="stable")
    return starts[order], ends[order]


def _equal_ahead(w: np.ndarray, i: int, j: int) -> int:
    """Number of words from ``i`` on that equal those from ``j`` > ``i`` on."""
    n, step, top = 0, 32, len(w) - j
    while n < top:
        m = min(step, top - n)
        differ = w[i + n : i + n + m] != w[j + n : j + n + m]
        if differ.any():
            return n + int(differ.argmax())
        n, step = n + m, step * 2
    return n


def _equal_behind(w: np.ndarray, i: int, j: int) -> int:
    """Number of words before ``i`` that equal those before ``j`` > ``i``."""
    n, step = 0, 32
    while n < i:
        m = min(step, i - n)
        differ = w[i - n - m : i - n][::-1] != w[j - n - m : j - n][::-1]
        if differ.any():
            return n + int(differ.argmax())
        n, step = n + m, step * 2
    return n


def scan_lags(words: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> list[tuple[int, int, int]]:
    """All runs (start, length, period) within the segments, periods ascending.

    The segments are laid end to end, longest first, with a number of its own between two of
    them; those long enough for a lag are then a prefix.  An anchor whose 3 q words lie in
    a known run of a period that divides q belongs to that run, as its smallest period is
    the smaller one; by the theorem of Fine and Wilf no other smaller period is possible.
    """
    order = np.argsort(starts - ends, kind="stable")
    starts, ends = starts[order], ends[order]
    lengths = ends - starts
    if not len(lengths):
        return []
    offsets = np.concatenate([[0], np.cumsum(lengths + 1)])
    laid = np.empty(offsets[-1], np.int64)
    inside = np.ones(len(laid), bool)
    inside[offsets[1:] - 1] = False
    laid[inside] = words[np.arange(lengths.sum()) + np.repeat(starts - np.concatenate([[0], np.cumsum(lengths)[:-1]]), lengths)]
    laid[~inside] = -1 - np.arange(len(lengths))
    runs: list[tuple[int, int, int]] = []
    known: dict[int, tuple[list[int], list[int]]] = {}
    for q in range(1, int(lengths[0]) // MIN_REPEATS + 1):
        least = max(MIN_LENGTH, MIN_REPEATS * q)
        many = int(np.searchsorted(-lengths, -least, side="right"))
        if not many:
            break
        w = laid[: offsets[many]]
        anchors = w[::q]
        same = anchors[:-1] == anchors[1:]
        hits = np.flatnonzero(same[:-2] & same[1:-1] & same[2:]) * q
        for probe in {q // 2, q // 3, 2 * q // 3, q - 1}:
            if len(hits) > 8:
                hits = hits[(w[hits + probe] == w[hits + probe + q]) & (w[hits + q + probe] == w[hits + 2 * q + probe])]
        if not len(hits):
            continue
        for p in _divisors(q):
            if p in known and len(hits):
                lows, highs = known[p]
                k = np.searchsorted(lows, hits, side="right") - 1
                hits = hits[(k < 0) | (hits + 3 * q >= np.asarray(highs)[k])]
        until = -1
        for x in hits.tolist():
            if x < until:
                continue
            ahead = _equal_ahead(w, x, x + q)
            if ahead <= 2 * q:
                continue
            low = x - _equal_behind(w, x, x + q)
            high = x + q + ahead
            until = x + ahead
            if high - low >= least:
                runs.append((low, high - low, q))
                own = known.setdefault(q, ([], []))
                own[0].append(low)
                own[1].append(high)
    place = np.searchsorted(offsets, [r[0] for r in runs], side="right") - 1
    return [(int(low - offsets[k] + starts[k]), n, q) for (low, n, q), k in zip(runs, place, strict=True)]


def _divisors(q: int) -> list[int]:
    """The divisors of ``q`` below ``q``."""
    small = [d for d in range(1, int(q**0.5) + 1) if q % d == 0]
    return [d for d in {*small, *(q // d for d in small)} if d < q]


def periodic_runs(texts: list[list[bytes]]) -> list[list[tuple[int, int, int]]]:
    """Per text (its words) the runs (start, length, period), by start, then period."""
    bounds = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
    numbers: dict[bytes, int] = {}
    words = np.fromiter((numbers.setdefault(w, len(numbers)) for t in texts for w in t), np.int64, bounds[-1])
    found: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    if len(words):
        runs = scan_lags(words, *surviving_segments(words, bounds))
        place = np.searchsorted(bounds, [r[0] for r in runs], side="right") - 1
        for (start, length, period), k in zip(runs, place, strict=True):
            found[k].append((start - int(bounds[k]), length, period))
    return [sorted(f, key=lambda r: (r[0], r[2])) for f in found]


def with_planted_run(words: list[bytes], doc_id: int | None) -> list[bytes]:
    """The words with the contract's repetition: one id in ten repeats a stretch up to its end."""
    if doc_id is None or not words:
        return words
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return words
    n, g = len(words), h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    stretch = words[a : a + p]
    return words[:a] + (stretch * ((n - a) // p + 1))[: n - a]


def _summary(words: list[bytes], runs: list[tuple[int, int, int]]) -> dict:
    best = None
    for start, length, period in runs:
        # length / period compared crosswise: exact
        if best is None or length * best[2] > best[1] * period:
            best = (start, length, period)
    keep = words
    if runs:
        edge = np.zeros(len(words) + 1, np.int64)
        for start, length, period in runs:
            edge[start + period] += 1
            edge[start + length] -= 1
        dropped = np.cumsum(edge[:-1]) > 0
        keep = [w for w, gone in zip(words, dropped.tolist(), strict=True) if not gone]
    listed = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
    return {
        "n_runs": len(runs),
        "start": best and best[0],
        "length": best and best[1],
        "period": best and best[2],
        "exponent_milli": best and 1000 * best[1] // best[2],
        "runs_sha256": hashlib.sha256(listed.encode()).hexdigest(),
        "collapsed": b" ".join(keep),
    }


def _column(values: list, field: T.StructField) -> pa.Array:
    if field.name == "collapsed":  # the bytes of the text, whatever they are
        return pa.array(values, pa.binary()).view(pa.string())
    return pa.array(values, pa.string() if field.dataType == T.StringType() else pa.int64())


def detect_periodic_runs(
    df: DataFrame, text_col: str = "text", plant_by: str | None = None, slice_bytes: int = SLICE_BYTES
) -> DataFrame:
    """``df`` with the runs of every whole text: n_runs, the run of greatest exponent, a digest of all, the text without repeats.

    A run is a stretch of words with smallest period q that holds at least max(6, 4 q) words and
    that no neighbouring word extends.  start, length, period and exponent_milli are those of
    the run with the greatest length / period (ties: smallest start, then period), null
    without runs.  ``collapsed`` holds the words, one space between two, without those that a
    run repeats, i.e. that stand in a run after its first q words.  With ``plant_by`` the column of that name
    decides which texts are repeated first (:func:`with_planted_run`); a null there changes nothing.

    Null and empty texts have no words and no runs.  Every row is judged by itself: repeated
    rows come out alike, one task holds one slice of texts and never more than a text besides.
    Input columns named like the new ones are replaced, others pass through; an empty table gives
    an empty result.  Runs overlap, so a word may be in several.
    """
    new = [f.name for f in FIELDS]
    kept = without(df, new)
    # The batch gets numbered columns, so that names of the input cannot clash with each other or with the new ones.
    inner = [F.col(f"`{c}`").alias(f"c{k}") for k, c in enumerate(kept)]
    plant = F.col(f"`{plant_by}`").cast("long") if plant_by else F.lit(None).cast("long")
    slim = df.select(*inner, F.col(f"`{text_col}`").cast("string").alias("text"), plant.alias("plant"))
    schema = T.StructType([T.StructField(f"c{k}", df.schema[c].dataType) for k, c in enumerate(kept)] + FIELDS.fields)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in byte_slices(whole, "text", slice_bytes):
                data, at = utf8_parts(batch.column("text"))
                ids = batch.column("plant").to_pylist()
                raw = data.tobytes()
                # bytes.split() parts at exactly the contract's white space
                texts = [with_planted_run(raw[at[i] : at[i + 1]].split(), ids[i]) for i in range(batch.num_rows)]
                rows = [_summary(t, r) for t, r in zip(texts, periodic_runs(texts), strict=True)]
                made = [_column([r[f.name] for r in rows], f) for f in FIELDS]
                columns = [batch.column(k) for k in range(len(kept))]
                yield pa.RecordBatch.from_arrays([*columns, *made], names=[*(f"c{k}" for k in range(len(kept))), *new])

    out = slim.mapInArrow(scan, schema)
    return out.select(*[F.col(f"c{k}").alias(c) for k, c in enumerate(kept)], *new)
