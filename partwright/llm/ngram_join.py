"""Jaccard self-join of word shingle sets by partitioned signatures.

Two sets within the threshold differ in at most H shingles, H known from their size
band.  A band's universe of shingles is hashed into more than H segments, so two such
sets agree on a whole segment (pigeonhole).  Some segments may also match with one
shingle deleted; those count twice.  How many of each kind a band uses is chosen by a
cost model.  Signatures of segments travel packed in byte arrays and meet in buckets;
bucket members are tried against the bucket's first set, and what that leaves apart within a
bucket against each other.  Buckets too crowded for that, such as those of a common template, are split by
rare shingles (:func:`_crowded_links`).  Pairs that an exact bound from sizes and parity sketches
allows are verified on the whole sets.  Equal sets are one node throughout.
"""

from __future__ import annotations

import functools
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from partwright.llm.common import byte_slices, mix64, pair64, quoted, set_aside, shuffle_partitions, utf8_parts, written
from partwright.llm.components import connected_components
from partwright.llm.shingles import WORDS, shingle_sets

PERCENT = 80
SLICE_BYTES = 4 << 20
# Signatures met in one task, about.
TASK_SIGNATURES = 3_000_000
# Of a signature's 64 bits so many bytes travel, besides the task they choose; a false match is only one more pair to verify.
SIGNATURE_BYTES = 5
# Sets that a task remembers in order to send equal ones once.
RECALLED_SETS = 1_000_000
# Buckets of more sets are compared one by one; rows of smaller ones compared together.
SMALL_BUCKET = 64
# Buckets of more sets, in different components, are split by their members' rare shingles.
CROWDED_BUCKET = 2048
# Shingles are ranked by counters of so many cells; any ranking that is the same for all sets gives the same links.
CELLS = 1 << 16
CELL_ROWS = 16
# Groups of more sets that share a rare shingle are tried against their first set before all against all.
LEAD_GROUP = 64
HELD_ROWS = 16_000
# A parity sketch has at least twice as many bits as its set has shingles, within these limits.
SKETCH_BITS = (64, 8192)

_SEED = np.uint64(0x8CB92BA72F3D8DD7)
_TOKEN = np.uint64(0x27D4EB2F165667C5)


def most_differences(total: int, percent: int) -> int:
    """Largest symmetric difference of two sets within the threshold whose sizes sum to ``total``."""
    return (100 - percent) * total // (100 + percent)


@functools.lru_cache(maxsize=8)
def band_bounds(percent: int) -> np.ndarray:
    """Least size of each band; a set links only within its band and the next ones on either side."""
    out = [1]
    while out[-1] < 1 << 40:
        out.append(100 * out[-1] // percent + 1)
    return np.array(out, np.int64)


@functools.lru_cache(maxsize=1024)
def allocation(band: int, percent: int) -> tuple[int, int, int]:
    """(H, exact segments, segments with one deletion) for sets of ``band`` and the next one up.

    The cost of a choice is the signatures it makes per set, plus a penalty for the
    chance that too many of a set's segments are empty to rely on.
    """
    size = int(band_bounds(percent)[band + 1]) - 1
    differences = most_differences(size + 100 * size // percent, percent)
    need, best = differences + 1, None
    for doubled in sorted({0, need // 8, need // 4, need // 2}):
        for spare in sorted({1, 2, 3, 4, 6, 8, *(int(need * s) for s in (0.05, 0.1, 0.15, 0.2, 0.3, 0.5))}):
            exact = need + spare - 2 * doubled
            if exact < 0:
                continue
            mean = size / (exact + doubled)
            none, few = math.exp(-mean), math.exp(-mean) * (1 + mean)
            lost = exact * none + 2 * doubled * few
            spread = math.sqrt(exact * none + 4 * doubled * few) + 1e-9
            risk = 0.5 * math.erfc((spare + 0.5 - lost) / (spread * math.sqrt(2)))
            cost = exact * (1 - none) + doubled * (1 + mean) + 100 * need * risk
            if best is None or cost < best[0]:
                best = (cost, exact, doubled)
    return differences, best[1], best[2]


def signatures(grams, owner, sizes, role: int, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Signatures of sets and the set's position for each.

    ``role`` 0 places a set in its own band's structure, 1 in that of the band below.
    A pair within the threshold shares a signature of one structure, with role 0 on one side.
    """
    n = len(sizes)
    bounds = band_bounds(percent)
    band = np.searchsorted(bounds, sizes, side="right") - 1 - role
    used = (sizes > 0) & (band >= 0)
    plans = {int(b): allocation(int(b), percent) for b in np.unique(band[used])}
    limit, exact, doubled = np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n, np.int64)
    for b, (h, e, d) in plans.items():
        at = used & (band == b)
        limit[at], exact[at], doubled[at] = h, e, d
    # With no difference allowed only equal sets link, and those are one node already.
    used &= limit > 0
    parts = np.where(used, exact + doubled, 0)
    mine = used[owner]
    grams, owner = grams[mine], owner[mine]
    if not len(grams):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    seed = mix64((band + 1).astype(np.uint64) * _SEED)
    base = np.concatenate([[0], np.cumsum(parts)])
    cell = base[owner] + (mix64(grams ^ seed[owner]) % parts[owner].astype(np.uint64)).astype(np.int64)
    value = mix64(grams + _TOKEN)
    sums = np.zeros(int(base[-1]), np.uint64)
    np.add.at(sums, cell, value)
    count = np.bincount(cell, minlength=len(sums))
    cell_owner = np.repeat(np.arange(n), parts)
    segment = np.arange(len(sums)) - base[cell_owner]
    tag = mix64(seed[cell_owner] + segment.astype(np.uint64) * _TOKEN)
    twice = segment < doubled[cell_owner]

    filled = count > 0
    out, owners = [pair64(sums[filled], tag[filled])], [cell_owner[filled]]
    less = twice[cell] & (count[cell] >= 2)
    out.append(pair64(sums[cell[less]] - value[less], tag[cell[less]]))
    owners.append(owner[less])
    # Segments too empty to show a match; a set that has too many of them shows the empty ones as well.
    blank = np.where(twice, count <= 1, count == 0)
    lost = np.bincount(cell_owner, np.where(twice, 2, 1) * blank, minlength=n)
    short = exact + 2 * doubled - lost < limit + 1
    shown = blank & short[cell_owner]
    out.append(pair64(np.zeros(int(shown.sum()), np.uint64), tag[shown]))
    owners.append(cell_owner[shown])
    return np.concatenate(out), np.concatenate(owners)


def sketches(grams, owner, sizes) -> list[bytes]:
    """Parity of the shingles that hash to each bit; sketches differ in no more bits than their sets in shingles."""
    least, most = SKETCH_BITS
    bits = np.clip(2 ** np.ceil(np.log2(2 * np.maximum(sizes, 1))).astype(np.int64), least, most)
    base = np.concatenate([[0], np.cumsum(bits)])
    at = base[owner] + (mix64(grams ^ _TOKEN) & (bits[owner] - 1).astype(np.uint64)).astype(np.int64)
    packed = np.packbits((np.bincount(at, minlength=int(base[-1])) & 1).astype(np.uint8), bitorder="little").tobytes()
    return [packed[a // 8 : b // 8] for a, b in zip(base, base[1:], strict=False)]


def folded(sketch: bytes, size: int) -> np.ndarray:
    """A sketch as of ``size`` bytes: bits of equal position modulo the size are added."""
    words = np.frombuffer(sketch, np.uint8).reshape(-1, size)
    return np.bitwise_xor.reduce(words, axis=0)


def _runs(sorted_values: np.ndarray) -> np.ndarray:
    """Borders of runs of equal values, both ends included."""
    if not len(sorted_values):
        return np.zeros(1, np.int64)
    return np.concatenate([[0], np.flatnonzero(sorted_values[1:] != sorted_values[:-1]) + 1, [len(sorted_values)]])


def _describe(batches, words):
    for batch in batches:
        for part in byte_slices(batch, "text", SLICE_BYTES):
            grams, owner = shingle_sets(*utf8_parts(part.column("text")), words)
            n = part.num_rows
            sizes = np.bincount(owner, minlength=n)
            one, two = _digests(grams, owner, n)
            yield pa.record_batch(
                [
                    part.column("id"),
                    pa.array(sizes.astype(np.int64)),
                    pa.array(one),
                    pa.array(two),
                    pa.array(sketches(grams, owner, sizes), pa.binary()),
                ],
                names=["id", "n", "one", "two", "sketch"],
            )


def _digests(grams, owner, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit digests of each set."""
    one, two = np.zeros(n, np.uint64), np.zeros(n, np.uint64)
    np.add.at(one, owner, mix64(grams ^ _SEED))
    np.add.at(two, owner, mix64(grams + _SEED))
    return one.view(np.int64), two.view(np.int64)


def _emit(batches, tasks, words, percent):
    """Signatures of the sets, packed by task; of equal sets that a task meets, the first only, as far as it recalls."""
    narrow = np.uint16 if tasks <= 1 << 16 else np.uint32
    met: set[int] = set()
    for batch in batches:
        for part in byte_slices(batch, "text", SLICE_BYTES):
            grams, owner = shingle_sets(*utf8_parts(part.column("text")), words)
            n = part.num_rows
            names, _ = _digests(grams, owner, n)
            fresh = np.zeros(n, bool)
            for i, name in enumerate(names.tolist()):
                if name not in met:
                    met.add(name)
                    fresh[i] = True
            if len(met) > RECALLED_SETS:
                met.clear()
            grams, owner = grams[fresh[owner]], owner[fresh[owner]]
            sizes = np.bincount(owner, minlength=n)
            for role in (0, 1):
                sig, doc = signatures(grams, owner, sizes, role, percent)
                task = (sig % np.uint64(tasks)).astype(narrow)
                order = np.argsort(task, kind="stable")
                sig, doc, task = sig[order], doc[order], task[order]
                short = sig.view(np.uint8).reshape(-1, 8)[:, 8 - SIGNATURE_BYTES :]
                cuts = _runs(task)
                rows = {"task": [], "names": [], "sig": [], "who": []}
                for a, b in zip(cuts, cuts[1:], strict=False):
                    present, who = np.unique(doc[a:b], return_inverse=True)
                    rows["task"].append(int(task[a]))
                    rows["names"].append(names[present].tobytes())
                    rows["sig"].append(np.ascontiguousarray(short[a:b]).tobytes())
                    rows["who"].append(who.astype("<u2" if len(present) <= 1 << 16 else "<u4").tobytes())
                if rows["task"]:
                    yield pa.record_batch(
                        [
                            pa.array(rows["task"], pa.int32()),
                            pa.array([role] * len(rows["task"]), pa.int32()),
                            *[pa.array(rows[c], pa.binary()) for c in ("names", "sig", "who")],
                        ],
                        names=["task", "role", "names", "sig", "who"],
                    )


def _meet(batches):
    """Members of the buckets with two or more sets, and each bucket's first set."""
    sig, name, role, task = [], [], [], 0
    for batch in batches:
        for i in range(batch.num_rows):
            packed = np.frombuffer(batch.column("sig")[i].as_py(), np.uint8).reshape(-1, SIGNATURE_BYTES)
            who = batch.column("who")[i].as_py()
            who = np.frombuffer(who, "<u2" if len(who) == 2 * len(packed) else "<u4")
            wide = np.zeros((len(packed), 8), np.uint8)
            wide[:, 8 - SIGNATURE_BYTES :] = packed
            sig.append(wide.view(np.uint64).ravel())
            name.append(np.frombuffer(batch.column("names")[i].as_py(), np.int64)[who])
            role.append(np.full(len(packed), batch.column("role")[i].as_py(), np.int8))
            task = batch.column("task")[i].as_py()
    if not sig:
        return
    sig, name, role = np.concatenate(sig), np.concatenate(name), np.concatenate(role)
    order = np.argsort(sig, kind="stable")
    sig, name, role = sig[order], name[order], role[order]
    cuts = _runs(sig)
    many = np.repeat(np.diff(cuts) > 1, np.diff(cuts))
    sig, name, role = sig[many], name[many], role[many]
    order = np.lexsort((role, name, sig))
    sig, name, role = sig[order], name[order], role[order]
    fresh = np.ones(len(sig), bool)
    fresh[1:] = (sig[1:] != sig[:-1]) | (name[1:] != name[:-1])
    sig, name, role = sig[fresh], name[fresh], role[fresh]
    cuts = _runs(sig)
    if len(cuts) < 2:
        return
    last = np.iinfo(np.int64).max
    leader = np.minimum.reduceat(np.where(role == 0, name, last), cuts[:-1])
    good = (np.diff(cuts) > 1) & (leader != last)
    keep = np.repeat(good, np.diff(cuts))
    leader = np.repeat(leader, np.diff(cuts))[keep]
    bucket = pair64(sig[keep], np.full(len(leader), task, np.uint64)).view(np.int64)
    name, role = name[keep], role[keep].astype(np.int32)
    for a in range(0, len(bucket), 100_000):
        b = a + 100_000
        yield pa.record_batch(
            [pa.array(bucket[a:b]), pa.array(name[a:b]), pa.array(role[a:b]), pa.array(leader[a:b])],
            names=["bucket", "one", "role", "leader"],
        )


def _differing(bits_a: np.ndarray, bits_b: np.ndarray) -> np.ndarray:
    """Bits in which sketches differ, at most as many as their sets have differing shingles."""
    return np.bitwise_count(bits_a ^ bits_b).sum(axis=-1, dtype=np.int64)


def _stacked(found: list[bytes]) -> np.ndarray:
    """Sketches folded to the shortest one's size, as rows of 64-bit words."""
    least = min(map(len, found))
    return np.ascontiguousarray(np.stack([folded(x, least) for x in found])).view(np.uint64)


def _large_pairs(rows: dict, percent: int) -> np.ndarray:
    """(row, row, differing bits) of pairs of one large bucket that may be links between its components.

    Only members outside the commonest component are compared with the others.
    """
    n, component, role, leads = (rows[c] for c in ("n", "component", "role", "leads"))
    bits = _stacked(rows["sketch"])
    names, which, count = np.unique(component, return_inverse=True, return_counts=True)
    inner = which == np.argmax(count)
    place = np.arange(len(n))
    out = [np.zeros((3, 0), np.int64)]
    for i in np.flatnonzero(~inner & ~leads):
        j = np.flatnonzero(
            (component != component[i])
            & (inner | (place > i))
            & ~leads
            & ((role == 0) | (role[i] == 0))
            & (np.maximum(n, n[i]) * percent <= 100 * np.minimum(n, n[i]))
        )
        apart = _differing(bits[j], bits[i])
        near = apart * (100 + percent) <= (100 - percent) * (n[j] + n[i])
        out.append(np.stack([np.full(int(near.sum()), i), j[near], apart[near]]))
    return np.concatenate(out, axis=1)


def _small_pairs(rows: dict, starts: np.ndarray, sizes: np.ndarray, percent: int) -> np.ndarray:
    """The same of many small buckets, whose rows begin at ``starts``; a pair of sets counts once."""
    left, right = [], []
    for k in np.unique(sizes):
        i, j = np.triu_indices(int(k), 1)
        first = starts[sizes == k][:, None]
        left.append((first + i).ravel())
        right.append((first + j).ravel())
    left, right = np.concatenate(left), np.concatenate(right)
    n, component, role, ids, leads = (rows[c] for c in ("n", "component", "role", "id", "leads"))
    small, large = np.minimum(n[left], n[right]), np.maximum(n[left], n[right])
    ok = (
        (component[left] != component[right])
        & ((role[left] == 0) | (role[right] == 0))
        & (large * percent <= 100 * small)
        & ~(leads[left] | leads[right])
    )
    left, right = left[ok], right[ok]
    swap = ids[left] > ids[right]
    left, right = np.where(swap, right, left), np.where(swap, left, right)
    order = np.lexsort((ids[right], ids[left]))
    left, right = left[order], right[order]
    fresh = np.ones(len(left), bool)
    fresh[1:] = (ids[left][1:] != ids[left][:-1]) | (ids[right][1:] != ids[right][:-1])
    left, right = left[fresh], right[fresh]
    apart = [
        int(_differing(*_stacked([rows["sketch"][a], rows["sketch"][b]])))
        for a, b in zip(left.tolist(), right.tolist(), strict=True)
    ]
    apart = np.array(apart, np.int64)
    near = apart * (100 + percent) <= (100 - percent) * (n[left] + n[right])
    return np.stack([left[near], right[near], apart[near]])


def _apart(batches, percent, best):
    """Pairs left to verify; a bucket's rows are consecutive.

    Pairs with a bucket's first set have been tried.  ``best`` gives, for two components, the
    most similar pair of those met together only.
    """
    names = ("bucket", "id", "n", "component", "role", "leads")
    parts, held = [], 0

    def finish(parts):
        rows = {c: np.concatenate([p[c] for p in parts]) for c in names}
        rows["sketch"] = [x for p in parts for x in p["sketch"]]
        cuts = _runs(rows["bucket"])
        sizes = np.diff(cuts)
        small = sizes <= SMALL_BUCKET
        out = [_small_pairs(rows, cuts[:-1][small], sizes[small], percent)] if small.any() else []
        for k in np.flatnonzero(~small):
            a, b = cuts[k], cuts[k + 1]
            found = _large_pairs({c: v[a:b] for c, v in rows.items()}, percent)
            out.append(found + np.array([[a], [a], [0]]))
        left, right, apart = np.concatenate(out, axis=1)
        if best:
            one, two = rows["component"][left], rows["component"][right]
            one, two = np.minimum(one, two), np.maximum(one, two)
            order = np.lexsort((apart, two, one))
            one, two = one[order], two[order]
            first = np.ones(len(order), bool)
            first[1:] = (one[1:] != one[:-1]) | (two[1:] != two[:-1])
            left, right = left[order[first]], right[order[first]]
        one, two = rows["id"][left], rows["id"][right]
        pairs = np.unique(np.stack([np.minimum(one, two), np.maximum(one, two)]), axis=1)
        return pa.record_batch([pa.array(pairs[0]), pa.array(pairs[1])], names=["a", "b"])

    for batch in batches:
        rows = {c: batch.column(c).to_numpy(zero_copy_only=False) for c in names} | {"sketch": batch.column("sketch").to_pylist()}
        # Hold back the last bucket, which may go on in the next batch.
        last = int(_runs(rows["bucket"])[-2]) if batch.num_rows else 0
        if last and held + last >= HELD_ROWS:
            parts.append({c: v[:last] for c, v in rows.items()})
            yield finish(parts)
            parts, held = [{c: v[last:] for c, v in rows.items()}], batch.num_rows - last
        elif batch.num_rows:
            parts.append(rows)
            held += batch.num_rows
    if parts:
        yield finish(parts)


def _possible(batches, percent):
    """The pairs that sizes and sketches allow to be within the threshold."""
    for batch in batches:
        n_a, n_b = (batch.column(c).to_numpy() for c in ("n_a", "n_b"))
        ok = np.maximum(n_a, n_b) * percent <= 100 * np.minimum(n_a, n_b)
        sketch_a, sketch_b = (batch.column(c).to_pylist() for c in ("sketch_a", "sketch_b"))
        for i in np.flatnonzero(ok):
            apart = int(_differing(*_stacked([sketch_a[i], sketch_b[i]])))
            ok[i] = apart * (100 + percent) <= (100 - percent) * (n_a[i] + n_b[i])
        keep = pa.array(ok)
        yield pa.record_batch([batch.column(c).filter(keep) for c in ("a", "b")], names=["a", "b"])


def _verify(batches, words, percent):
    """The pairs of texts within the threshold."""
    for batch in batches:
        for part in byte_slices(batch, "text_b", SLICE_BYTES // 2):
            n = part.num_rows
            # A text that stands in several rows running is taken apart once.
            leaders = part.column("a").to_numpy()
            new = np.ones(n, bool)
            new[1:] = leaders[1:] != leaders[:-1]
            ones, which = part.column("text_a").filter(pa.array(new)), np.cumsum(new) - 1
            sides = []
            for texts in (ones, part.column("text_b")):
                grams, owner = shingle_sets(*utf8_parts(texts), words)
                sides.append((grams, np.searchsorted(owner, np.arange(len(texts) + 1))))
            (grams_a, cut_a), (grams_b, cut_b) = sides
            good = []
            for i, k in enumerate(which.tolist()):
                one, two = grams_a[cut_a[k] : cut_a[k + 1]], grams_b[cut_b[i] : cut_b[i + 1]]
                common = len(np.intersect1d(one, two, assume_unique=True))
                good.append(100 * common >= percent * (len(one) + len(two) - common))
            keep = pa.array(good, pa.bool_())
            yield pa.record_batch([part.column(c).filter(keep) for c in ("a", "b")], names=["a", "b"])


def _cell_counts(batches, words):
    """How many sets of this task hold a shingle of each cell, in CELL_ROWS rows."""
    total = np.zeros(CELLS, np.int64)
    for batch in batches:
        for part in byte_slices(batch, "text", SLICE_BYTES):
            grams, _ = shingle_sets(*utf8_parts(part.column("text")), words)
            total += np.bincount((grams % np.uint64(CELLS)).astype(np.int64), minlength=CELLS)
    pieces = np.split(total, CELL_ROWS)
    yield pa.record_batch([pa.array(range(CELL_ROWS), pa.int32()), pa.array([x.tobytes() for x in pieces], pa.binary())], names=["piece", "counts"])


def _added_cells(batches):
    """Sums of the rows of each piece; one row per piece is held."""
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for piece, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            sums[piece] = sums.get(piece, 0) + np.frombuffer(counts, np.int64)
    if sums:
        yield pa.record_batch([pa.array(list(sums), pa.int32()), pa.array([x.tobytes() for x in sums.values()], pa.binary())], names=["piece", "counts"])


def shingle_ranks(sets: DataFrame, words: int) -> np.ndarray:
    """For each cell the logarithm of the number of sets in it: 64 KB, whatever the number of sets."""
    rows = _struct(piece=T.IntegerType(), counts=T.BinaryType())
    counted = sets.select("text").mapInArrow(lambda batches: _cell_counts(batches, words), rows)
    added = counted.repartition(CELL_ROWS, "piece").mapInArrow(_added_cells, rows).collect()
    total = np.zeros(CELLS, np.int64)
    for row in added:
        total[row.piece * (CELLS // CELL_ROWS) : (row.piece + 1) * (CELLS // CELL_ROWS)] = np.frombuffer(row.counts, np.int64)
    return np.log2(total + 1).astype(np.uint8)


def prefix_sizes(sizes: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """How many of its rarest shingles a set shows as the smaller and as the larger one of a pair.

    Two linked sets have at least p (|A| + |B|) / (100 + p) shingles in common, so 2 p |A| / (100 + p)
    for the smaller one and p |B| / 100 for the larger.  The first of them in any common
    order stands in both prefixes.
    """
    short = sizes - -(-2 * percent * sizes // (100 + percent)) + 1
    long = sizes - -(-percent * sizes // 100) + 1
    return np.where(sizes > 0, short, 0), np.where(sizes > 0, long, 0)


def _rare_shingles(batches, ranks, words, percent):
    """(shingle, id, n, short) of the rarest shingles of each set; short: shown as the smaller set, too."""
    for batch in batches:
        for part in byte_slices(batch, "text", SLICE_BYTES // 4):
            grams, owner = shingle_sets(*utf8_parts(part.column("text")), words)
            sizes = np.bincount(owner, minlength=part.num_rows).astype(np.int64)
            order = np.lexsort((mix64(grams ^ _SEED), ranks[(grams % np.uint64(CELLS)).astype(np.int64)], owner))
            grams, owner = grams[order], owner[order]
            place = np.arange(len(owner)) - (np.cumsum(sizes) - sizes)[owner]
            short, long = prefix_sizes(sizes, percent)
            shown = place < np.maximum(long, short)[owner]
            grams, owner, place = grams[shown], owner[shown], place[shown]
            ids = part.column("id").to_numpy(zero_copy_only=False)[owner]
            for a in range(0, len(grams), HELD_ROWS):
                b = a + HELD_ROWS
                yield pa.record_batch(
                    [
                        pa.array(grams[a:b].view(np.int64)),
                        pa.array(ids[a:b]),
                        pa.array(sizes[owner[a:b]]),
                        pa.array(place[a:b] < short[owner[a:b]]),
                    ],
                    names=["gram", "id", "n", "short"],
                )


def _crowded_links(crowd: DataFrame, texts: DataFrame, labels: DataFrame, verified, words: int, percent: int) -> tuple[DataFrame | None, DataFrame]:
    """All links between the sets ``crowd`` (id) that ``labels`` leave in different components, and the labels then.

    Sets that share a segment of a template fill a bucket though few of them are linked.  They
    meet again by their rarest shingles: two linked sets share one of the rarest ninth of the
    smaller and the rarest fifth of the larger (:func:`prefix_sizes`), while a template that a third of
    all sets hold is not among the rare ones, unless sets have hardly anything else and so are linked.
    Groups are counted before any of them is gathered; only those of several components go
    on, as pairs of a smaller and a larger set, never as all pairs of a group.
    """
    sets = written(texts.join(crowd, "id", "left_semi"), "crowded_sets")
    ranks = shingle_ranks(sets, words)
    rare = written(
        sets.mapInArrow(
            lambda batches: _rare_shingles(batches, ranks, words, percent),
            _struct(gram=T.LongType(), id=T.LongType(), n=T.LongType(), short=T.BooleanType()),
        ),
        "rare_shingles",
    )
    links = None
    for lead in (True, False):
        named = rare.join(labels, "id", "left").withColumn("component", F.coalesce("component", "id"))
        groups = (
            named.groupBy("gram")
            .agg(
                F.min("component").alias("low"),
                F.max("component").alias("high"),
                F.count(F.lit(1)).alias("sets"),
                F.min(F.when(F.col("short"), F.struct("id", "n", "component"))).alias("lead"),
            )
            .filter("low <> high and lead is not null")
        )
        if lead:
            ones = groups.filter(F.col("sets") > LEAD_GROUP).select(
                "gram", F.col("lead.id").alias("one"), F.col("lead.n").alias("n_one"), F.col("lead.component").alias("of_one")
            )
            met = named.join(ones, "gram").filter((F.col("n") >= F.col("n_one")) | F.col("short"))
        else:
            alive = named.join(groups.select("gram"), "gram", "left_semi")
            ones = alive.filter("short").select(
                "gram", F.col("id").alias("one"), F.col("n").alias("n_one"), F.col("component").alias("of_one")
            )
            met = alive.join(ones, "gram").filter(F.col("n") >= F.col("n_one"))
        apart = (F.col("component") != F.col("of_one")) & (
            F.greatest("n", "n_one") * percent <= 100 * F.least("n", "n_one")
        )
        pairs = met.filter(apart).select(F.least("id", "one").alias("a"), F.greatest("id", "one").alias("b")).distinct()
        found = written(verified(pairs), "crowded_links")
        if not found.isEmpty():
            links = found if links is None else links.union(found)
            # Components of before are joined by the new links.
            edges = labels.select(F.col("id").alias("a"), F.col("component").alias("b")).filter("a <> b").union(links)
            labels = connected_components(edges)
    return links, labels


def _struct(**fields) -> T.StructType:
    return T.StructType([T.StructField(k, v) for k, v in fields.items()])


def ngram_join(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    words: int = WORDS,
    percent: int = PERCENT,
    crowded: int = CROWDED_BUCKET,
) -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id.

    Two documents link when ``100 * intersection >= percent * union`` of their sets of
    distinct shingles of ``words`` words, A-Z lower-cased; a text with fewer words is one
    shingle.  component_id is the smallest id reachable by links.  Null, empty and blank
    texts have no shingles and link with nothing: their component is their own id.  Ids
    are whole numbers.  Rows with a null id share the component of rows with an equal
    set, or else have a null component.  Rows that share an id are one node if their sets
    differ, too.  Other columns are ignored; an empty table gives an empty result.
    """
    spark = df.sparkSession
    texts = df.select(quoted(id_col).cast("long").alias("id"), quoted(text_col).alias("text"))
    long, whole, raw = T.LongType(), T.IntegerType(), T.BinaryType()
    described = written(
        texts.mapInArrow(
            lambda batches: _describe(batches, words), _struct(id=long, n=long, one=long, two=long, sketch=raw)
        ),
        "shingle_sets",
    )
    key = ["n", "one", "two"]
    nodes = written(
        described.filter("n > 0").groupBy(*key).agg(F.min("id").alias("node")).filter("node is not null"), "set_nodes"
    )
    total = nodes.agg(F.sum("n")).first()[0] or 0
    tasks = max(shuffle_partitions(spark), -(-total // (2 * TASK_SIGNATURES)))

    # Sets without an id would lead buckets in which they are tried with nobody.
    packed = texts.filter("id is not null").mapInArrow(
        lambda batches: _emit(batches, tasks, words, percent),
        _struct(task=whole, role=whole, names=raw, sig=raw, who=raw),
    )
    members = written(
        packed.repartitionById(tasks, F.col("task")).mapInArrow(
            _meet, _struct(bucket=long, one=long, role=whole, leader=long)
        ),
        "buckets",
    )
    # Buckets know sets by a digest, from here on nodes stand for them.
    facts = written(
        nodes.join(described.filter("n > 0"), key)
        .filter("id = node")
        .groupBy("one", "node")
        .agg(F.first("n").alias("n"), F.first("sketch").alias("sketch"))
        .withColumnRenamed("node", "id"),
        "node_facts",
    )
    one_side = facts.select("one", F.col("id").alias("b"), F.col("n").alias("n_b"), F.col("sketch").alias("sketch_b"))
    leader_side = facts.select(
        F.col("one").alias("leader"), F.col("id").alias("a"), F.col("n").alias("n_a"), F.col("sketch").alias("sketch_a")
    )
    first = (
        members.filter("one <> leader").select("one", "leader").distinct().join(one_side, "one").join(leader_side, "leader")
    )

    def possible(pairs: DataFrame) -> DataFrame:
        return pairs.mapInArrow(lambda batches: _possible(batches, percent), _struct(a=long, b=long))

    first = written(possible(first.filter("a <> b")), "first_pairs")

    def verified(pairs: DataFrame) -> DataFrame:
        # Texts are shuffled, whatever the number of pairs: that number grows with the input.
        one = texts.select(F.col("id").alias("a"), F.col("text").alias("text_a"))
        two = texts.select(F.col("id").alias("b"), F.col("text").alias("text_b"))
        both = pairs.hint("merge").join(two, "b").hint("merge").join(one, "a")
        return both.mapInArrow(lambda batches: _verify(batches, words, percent), _struct(a=long, b=long))

    edges = written(verified(first), "links")
    labels = connected_components(edges)
    tried = first.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))

    def components() -> DataFrame:
        return facts.join(labels, "id", "left").withColumn("component", F.coalesce("component", "id"))

    def mixed_buckets() -> DataFrame:
        """Buckets whose members are still in different components, and their numbers of sets."""
        stand = members.join(components().select("one", "component"), "one").groupBy("bucket")
        counts = stand.agg(F.min("component").alias("low"), F.max("component").alias("high"), F.count(F.lit(1)).alias("sets"))
        return counts.filter("low <> high and sets > 2").select("bucket", "sets")

    # What the first sets of the buckets left apart.  Crowded buckets are done with by rare shingles.
    full = written(mixed_buckets().filter(F.col("sets") > crowded).select("bucket"), "crowded_buckets")
    if not full.isEmpty():
        inside = members.join(full, "bucket", "left_semi").select("one").distinct().join(facts.select("one", "id"), "one")

        def checked(pairs: DataFrame) -> DataFrame:
            two = pairs.join(one_side.drop("one"), "b").join(leader_side.drop("leader"), "a")
            return verified(possible(two).distinct())

        more, labels = _crowded_links(inside.select("id").distinct(), texts, labels, checked, words, percent)
        if more is not None:
            edges = edges.union(more)
        members = members.join(full, "bucket", "left_anti")

    # In the others first the best pair of any two components, then all pairs.
    for best in (True, False):
        state = components()
        mixed = mixed_buckets().select("bucket")
        rest = (
            members.join(mixed, "bucket", "left_semi")
            .withColumn("leads", F.col("one") == F.col("leader"))
            .join(state, "one")
            .select("bucket", "id", "n", "component", "role", "leads", "sketch")
            .repartition("bucket")
            .sortWithinPartitions("bucket")
            .mapInArrow(lambda batches, best=best: _apart(batches, percent, best), _struct(a=long, b=long))
            .distinct()
            .join(tried, ["a", "b"], "left_anti")
        )
        rest = written(rest, "other_pairs")
        if rest.isEmpty():
            continue
        more = written(verified(rest), "links")
        tried = tried.union(rest)
        if not more.isEmpty():
            edges = edges.union(more)
            labels = connected_components(edges)
    named = nodes.join(labels.withColumnRenamed("id", "node"), "node", "left").select(
        *key, F.coalesce("component", "node").alias("component")
    )
    return described.join(named, key, "left").select(
        F.col("id").alias("doc_id"),
        F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("id")).alias("component_id"),
    )


def near_distinct(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``df`` with one document of each component: the one whose id names it.

    Documents without words and rows with a null id stay.  Of rows that share the id which
    stays, one stays.
    """
    found = ngram_join(df, id_col, text_col, **options)
    gone = (
        found.filter("doc_id is not null")
        .groupBy("doc_id")
        .agg(F.max(F.col("n_shingles") > 0).alias("worded"), F.min("component_id").alias("component"))
        .filter("worded and component <> doc_id")
        .select(F.col("doc_id").alias("gone"))
    )
    _, inner, back = set_aside(df, ())
    # Two scans: rows with a null id all stay, so they are neither joined nor gathered.
    rows = df.select(*inner, quoted(id_col).alias("own"), quoted(text_col).alias("text"))
    left = rows.filter("own is not null").join(gone, F.col("own") == F.col("gone"), "left_anti")
    again = F.row_number().over(Window.partitionBy("own").orderBy(F.length("text").desc_nulls_last(), "text"))
    one = left.withColumn("again", again).filter("again = 1").drop("again")
    return one.unionByName(rows.filter("own is null")).select(*back)
