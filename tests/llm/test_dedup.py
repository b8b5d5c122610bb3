"""Exact, substring, line and chunk dedup against brute force on small tables."""

import collections
import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from partwright.llm.chunk_dedup import chunk_dedup, chunk_ends
from partwright.llm.common import written
from partwright.llm.exact_dedup import exact_dedup
from partwright.llm.line_dedup import PerfectHash, line_dedup, line_key
from partwright.llm.suffix_dedup import suffix_dedup

WORDS = "alpha bravo charlie delta echo foxtrot golf hotel india juliett kilo lima mike ümlaut élan über".split()


def text(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n))


def corpus(seed=5, n=60):
    rng = random.Random(seed)
    passage, line = text(rng, 90), "A line that many documents repeat."
    rows = []
    for i in range(n):
        parts = [text(rng, rng.randint(1, 120)) for _ in range(rng.randint(1, 4))]
        if i % 4 == 0:
            parts.insert(rng.randint(0, len(parts)), passage)
        if i % 3 == 0:
            parts.append("  " + (line.upper() if i % 2 else line) + "\t")
        rows.append((i, "\n".join(parts)))
    rows += [(n + k, rows[k][1].upper() if k % 2 else rows[k][1]) for k in range(12)]
    rows += [(200, None), (201, ""), (202, None), (203, "é" * 700), (204, "x" * 2000), (205, " \n\n"), (206, "short")]
    rows += [(300, "same row, twice " * 40)] * 2 + [(None, "no id"), (None, text(rng, 100))]
    return rows


def frame(spark, rows):
    """With extra columns that clash with the names operators make."""
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    return df.withColumns({c: F.lit(c) for c in ("content", "digest", "kept", "hash", "n_lines", "key", "spans", "size")})


def az(s):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in s)


@pytest.mark.parametrize("keep", ["smallest", "largest"])
@pytest.mark.parametrize("hot_rows", [1000, 3])
def test_exact_dedup(spark, keep, hot_rows):
    rows = corpus() + [(1000 + i, "Hot") for i in range(40)]
    groups = collections.defaultdict(list)
    for i, t in rows:
        groups[az(t or "")].append(i)
    best = min if keep == "smallest" else max
    want = collections.Counter()
    for key, ids in groups.items():
        known = [i for i in ids if i is not None]
        stays = best(known) if known else None
        for k, i in enumerate(sorted(ids, key=lambda i: (i != stays, i is None, i or 0))):
            want[(i, stays, len(ids), k == 0, hashlib.sha256(key.encode()).hexdigest())] += 1
    got = exact_dedup(frame(spark, rows), keep=keep, hot_rows=hot_rows, hot_share=0.0, hot_runs=7).collect()
    assert collections.Counter(tuple(r) for r in got) == want


def covered(texts, length):
    seen = collections.Counter(b[i : i + length] for b in texts for i in range(len(b) - length + 1))
    out = []
    for b in texts:
        spans = []
        for i in range(len(b) - length + 1):
            if seen[b[i : i + length]] > 1:
                if spans and i <= spans[-1][1]:
                    spans[-1][1] = i + length
                else:
                    spans.append([i, i + length])
        out.append([tuple(s) for s in spans])
    return out


@pytest.mark.parametrize("bucket_runs,length", [(20_000, 400), (2, 400), (20_000, 100)])
def test_suffix_dedup(spark, bucket_runs, length):
    rows = corpus()
    texts = [(t or "").encode() for _, t in rows]
    want = collections.Counter()
    for (i, _), b, spans in zip(rows, texts, covered(texts, length), strict=True):
        kept = b"".join(b[a:z] for a, z in zip([0] + [e for _, e in spans], [s for s, _ in spans] + [len(b)], strict=True))
        want[(i, len(b), len(b) - len(kept), tuple(spans), kept)] += 1
    got = suffix_dedup(frame(spark, rows), length=length, bucket_runs=bucket_runs).collect()
    assert (
        collections.Counter(
            (r.doc_id, r.n_bytes, r.n_removed, tuple((s.start, s.end) for s in r.spans), bytes(r.kept)) for r in got
        )
        == want
    )


def test_long_texts_are_cut_into_pieces(spark, monkeypatch):
    import partwright.llm.suffix_dedup as module

    monkeypatch.setattr(module, "STEP_BYTES", 1000)
    rng = random.Random(3)
    long = text(rng, 2000)
    rows = [(1, long), (2, text(rng, 50) + long[3000:9000] + text(rng, 50)), (3, text(rng, 500))]
    texts = [t.encode() for _, t in rows]
    got = {r.doc_id: [(s.start, s.end) for s in r.spans] for r in suffix_dedup(frame(spark, rows)).collect()}
    assert got == {i: s for (i, _), s in zip(rows, covered(texts, 400), strict=True)}
    assert got[2]


def test_rows_of_a_hot_bucket_meet_in_no_task(spark, monkeypatch):
    import partwright.llm.suffix_dedup as module

    seen = {}

    def keep(df, name):
        seen[name] = written(df, name)
        return seen[name]

    monkeypatch.setattr(module, "written", keep)
    monkeypatch.setattr(module, "HOT_ROWS", 3, raising=False)
    rng = random.Random(4)
    passage = text(rng, 150)
    # A passage of one repeated word has one least q-gram, and so one bucket, in each of its periods.
    rows = [(i, f"{text(rng, 40)} {passage} {text(rng, 40)} {'very ' * 200}{text(rng, 40)}") for i in range(40)]
    texts = [t.encode() for _, t in rows]
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for bucket_runs in (20_000, 2):
            got = suffix_dedup(frame(spark, rows), bucket_runs=bucket_runs).collect()
            assert {r.doc_id: [(s.start, s.end) for s in r.spans] for r in got} == {
                i: s for (i, _), s in zip(rows, covered(texts, 400), strict=True)
            }
            # Rows of a bucket that is shuffled are written by one task.
            runs = seen["shared_runs"].withColumn("file", F.input_file_name())
            buckets = runs.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("file").alias("files"))
            n, files = buckets.orderBy(F.desc("n")).select("n", "files").first()
            assert n > 1000 and files > 1
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_counted_joins_hot_keys_where_their_rows_are(spark, monkeypatch):
    import partwright.llm.suffix_dedup as module

    monkeypatch.setattr(module, "HOT_ROWS", 5)
    rows = [(k, i) for k, n in ((1, 40), (2, 4), (3, 1), (4, 5)) for i in range(n)]
    df = spark.createDataFrame(rows, "key long, place long").repartition(4, "place")
    counts = df.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    got = module.counted(df, counts, ["key"]).withColumn("task", F.spark_partition_id()).collect()
    assert collections.Counter((r.key, r.place, r.n) for r in got) == collections.Counter(
        (k, i, n) for k, n in ((1, 40), (2, 4), (4, 5)) for i in range(n)
    )
    assert len({r.task for r in got if r.key == 1}) > 1


def test_line_dedup(spark):
    rows = corpus()
    holders = collections.defaultdict(set)
    for i, t in rows:
        for x in (t or "").split("\n"):
            if len(line_key(x)) >= 20:
                holders[line_key(x)].add(i)
    owner = {k: max((i for i in v if i is not None), default=None) for k, v in holders.items() if len(v) >= 3}
    want = collections.Counter()
    for i, t in rows:
        parts = (t or "").split("\n")
        left = [x for x in parts if line_key(x) not in owner or owner[line_key(x)] == i]
        want[(i, t if len(left) == len(parts) else "\n".join(left), len(parts), len(parts) - len(left))] += 1
    got = line_dedup(frame(spark, rows)).select("doc_id", "text", "n_lines", "n_dropped").collect()
    assert collections.Counter(tuple(r) for r in got) == want
    assert sum(n for (_, _, _, d), n in want.items() if d) > 5


def test_perfect_hash_is_minimal_and_perfect():
    keys = np.random.default_rng(1).integers(-(1 << 62), 1 << 62, 20_000)
    keys = np.unique(keys)
    table = PerfectHash.build(keys)
    assert sorted(table.slots(keys).tolist()) == list(range(len(keys)))
    assert len(table.bits) < 5 * len(keys)


def test_probes_compare_the_whole_line_hash():
    from partwright.llm.line_dedup import _index_shards, _Shard
    import pyarrow as pa
    import pyarrow.compute  # noqa: F401

    rng = np.random.default_rng(3)
    h = np.unique(rng.integers(0, 1 << 62, 5000))
    f = np.full(len(h), 5, np.int32)
    columns = [pa.array(np.zeros(len(h), np.int32)), pa.array(h), pa.array(f), pa.array(np.full(len(h), 9, np.int32)), pa.array(h * 0 + 1)]
    names = ["shard", "sizes", "bits", "more", "keys", "prints", "counts", "owners"]
    (out,) = _index_shards([pa.record_batch(columns, names=["shard", "h", "f", "docs", "owner"])], names)
    shard = _Shard({c: out.column(c)[0] for c in out.schema.names})
    ids = pa.array(np.zeros(len(h), np.int64))
    assert len(shard.probe(h, f, ids, 3)) == len(h)
    # other lines with the same fingerprint
    assert len(shard.probe(np.setdiff1d(rng.integers(0, 1 << 62, 5000), h)[:4000], f[:4000], ids[:4000], 3)) == 0


def test_chunk_dedup_finds_passages_and_spares_the_rest(spark):
    rng = random.Random(11)
    alphabet = "abcdefghijklmnopqrstuvwxyz"
    word = lambda: "".join(rng.choice(alphabet) for _ in range(rng.randint(2, 9)))
    prose = lambda n: " ".join(word() for _ in range(n))
    passages = [prose(55) for _ in range(8)]
    line = "one short line that is common"
    rows = [(i, prose(200) + "\n" + line + "\n" + prose(50)) for i in range(40)]
    planted = [(100 + 5 * k + j, prose(40 + j) + " " + p + " " + prose(60)) for k, p in enumerate(passages) for j in range(3)]
    edge = [(500, None), (501, ""), (502, "x"), (503, rows[0][1]), (503, rows[0][1]), (None, rows[1][1])]
    got = chunk_dedup(frame(spark, rows + planted + edge)).collect()
    by = collections.defaultdict(list)
    for r in got:
        by[r.doc_id].append(r)
        assert r.n_bytes == len(bytes(r.kept)) + r.n_removed
        assert sum(s.end - s.start for s in r.spans) == r.n_removed
    assert len(got) == len(rows + planted + edge)
    assert all(by[i][0].n_repeated == 0 for i, _ in rows if i not in (0, 1))
    for k in range(8):
        three = [by[100 + 5 * k + j][0] for j in range(3)]
        assert all(r.n_repeated > 150 for r in three)
        assert sorted(r.n_removed > 0 for r in three) == [False, True, True]
    # of two equal documents under different ids one stays whole; rows alike in id and text are one document
    assert [r.n_removed > 0 for r in by[503]] in ([True, True], [False, False])
    assert (by[0][0].n_removed > 0) != (by[503][0].n_removed > 0)
    assert (by[1][0].n_removed > 0) != (by[None][0].n_removed > 0)


def test_copies_of_a_common_chunk_meet_in_no_task(spark, monkeypatch):
    import partwright.llm.chunk_dedup as module
    from pyspark.sql import functions as F

    monkeypatch.setattr(module, "HOT_COPIES", 100)
    chunks = spark.range(0, 6000, 1, 6).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id").cast("int") % 3000 + 100).cast("long").alias("digest"),
        F.col("id").alias("key"),
        (F.col("id") == 5999).alias("again"),
    )
    found = module.copied_digests(chunks).withColumn("task", F.spark_partition_id()).collect()
    held = collections.Counter(r.task for r in found if r.digest == 7)
    assert sum(held.values()) == 2000 and max(held.values()) < 500
    assert sorted((r.digest, r.key) for r in found) == sorted((r.digest, r.key) for r in chunks.collect())
    assert [r.key for r in found if r.digest == 7 and r.stays] == [0]
    assert sum(r.stays for r in found) == 2001
    # the copies found are those of a comparison of all chunks, by broadcast or not
    rng = random.Random(4)
    notice = text(rng, 60)
    rows = [(i, text(rng, 40) + notice * (1 + i % 2) + text(rng, 10)) for i in range(60)] + [(None, notice), (None, notice)]
    rows += [rows[3], rows[3], (90, rows[4][1])]
    some = [sorted(map(str, chunk_dedup(frame(spark, rows)).collect()))]
    monkeypatch.setattr(module, "HOT_COPIES", 1 << 40)
    some.append(sorted(map(str, chunk_dedup(frame(spark, rows)).collect())))
    assert some[0] == some[1] and sum("n_removed=0" not in r for r in some[0]) > 50


def test_chunks_resist_insertions():
    rng = np.random.default_rng(2)
    a = rng.integers(97, 123, 5000).astype(np.uint8)
    b = np.concatenate([a[:100], np.frombuffer(b"inserted", np.uint8), a[100:]])
    ends = lambda x: chunk_ends(x, np.array([0, len(x)]), 24, 128)
    pieces = lambda x: [x[s:e].tobytes() for s, e in zip([0, *ends(x)[:-1]], ends(x), strict=True)]
    shared = set(pieces(a)) & set(pieces(b))
    assert sum(len(p) for p in pieces(b) if p in shared) > 0.9 * len(b)
    assert max(map(len, pieces(np.zeros(1000, np.uint8)))) <= 128


@pytest.mark.parametrize("operator", [exact_dedup, suffix_dedup, line_dedup, chunk_dedup])
def test_empty_tables(spark, operator):
    assert operator(frame(spark, [])).collect() == []
