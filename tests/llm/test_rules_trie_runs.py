"""Quality rules, the conversation trie and periodic runs against brute force."""

import collections
import hashlib
import math
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from partwright.llm import conversation_trie as trie
from partwright.llm.conversation_trie import conversation_trie
from partwright.llm.periodic_runs import detect_periodic_runs, periodic_runs, surviving_segments, with_planted_run
from partwright.llm.quality_rules import COUNTS, STOP_WORDS, Threshold, quality_rules

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def counts(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = collections.Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    covered = {i + k for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for k in range(3)}
    stops = {v for w in STOP_WORDS for v in (w, w.capitalize())}
    return {
        "n_words": len(words),
        "word_chars": sum(map(len, words)),
        "n_symbols": sum(text.count(c) for c in "#*$%&|<>"),
        "n_lines": len(lines),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": len(covered),
        "n_stop_words": sum(w in stops for w in words),
        "n_shouts": len(re.findall("!+", text)),
    }


def odd_texts():
    rng = random.Random(7)
    vocabulary = "the of a und la Élan b c 𝔘nicode x y # $$ <b> wow!!".split(" ")
    texts = [None, "", " \n\t", "one", "a b", "a b c", "a b c a b c", "a a a a", "x y x y", "line\n line\nline\n\n\nline", "\x0b\x0c\r"]
    texts += [" ".join(rng.choice(vocabulary) for _ in range(rng.randint(3, 200))) for _ in range(40)]
    texts += ["\n".join(rng.choice(["the same line", "another", ""]) for _ in range(30)) for _ in range(5)]
    texts += ["of the and " * 5000, " ".join(f"w{i}" for i in range(20000)), "the " + "y" * 100000]
    return texts + texts[:8]


def test_quality_rules_equal_brute_force(spark):
    texts = odd_texts()
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    # names that the operator makes, and one with a dot
    for name in ("n_words", "kept", "row", "made", "words", "__lines", "a.b"):
        df = df.withColumn(name, F.lit("input"))
    out = quality_rules(df)
    assert out.columns == ["doc_id", "text", "row", "made", "words", "__lines", "a.b", *COUNTS, "base_failed", "failed", "kept"]
    rows = out.collect()
    assert len(rows) == len(texts)
    for r in rows:
        want = counts(texts[r.doc_id])
        assert {n: r[n] for n in COUNTS} == want, texts[r.doc_id]
        assert r.base_failed == (want["n_words"] < 50 or 100 * want["n_repeat_words"] > 50 * want["n_words"])
        assert r.kept == (not r.base_failed and not r.failed) and r["a.b"] == r.row == "input"


def test_quality_rules_are_one_projection(spark):
    df = spark.read.parquet(f"{SF}/documents.parquet")
    plan = quality_rules(df)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan and "Arrow" not in plan
    assert quality_rules(df.limit(0)).collect() == []
    with pytest.raises(ValueError):
        quality_rules(df, [Threshold("bad", "n_words", "no_such_count")])


def test_quality_rules_keep_prose_and_drop_junk(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    rows = quality_rules(docs).join(labels, "doc_id").filter("not base_failed").select("quality", "kept").collect()
    good = [r.kept for r in rows if r.quality == 1]
    bad = [r.kept for r in rows if r.quality == 0]
    assert len(good) > 20 and all(good) and len(bad) > 3 and sum(bad) <= 0.1 * len(bad)


def brute_trie(rows, rebuild=True):
    by = collections.defaultdict(list)
    for c, t, r, x in rows:
        if c is not None:
            key = hashlib.sha256(f"{len((r or '').encode())}:{r or ''}{x or ''}".encode()).digest()
            by[c].append((t is not None, t or 0, key, (r or "", x or "")))
    by = {c: [v[-1] for v in sorted(turns)] for c, turns in by.items()}
    built = {}
    for c, turns in by.items():
        h = zlib.crc32(str(c).encode()) % 4
        built[c] = by.get(c - int(math.fmod(c, 20)), [])[:h] + turns[h:] if rebuild else turns
    members, ends = collections.defaultdict(list), collections.defaultdict(list)
    for c, v in built.items():
        for d in range(len(v) + 1):
            members[tuple(v[:d])].append(c)
        ends[tuple(v)].append(c)
    children = collections.Counter(k[:-1] for k in members if k)
    leaves, saved = collections.Counter(), collections.Counter()
    for k, m in members.items():
        words = len(WORD.findall(k[-1][1])) if k else 0
        for d in range(len(k) + 1):
            leaves[k[:d]] += children[k] == 0
            saved[k[:d]] += (len(m) - 1) * words
    return collections.Counter(
        (min(m), len(k), min(members[k[:-1]]) if k else None, len(m), children[k], leaves[k], saved[k],
         hashlib.sha256(",".join(map(str, sorted(ends[k]))).encode()).hexdigest())
        for k, m in members.items()
    )


def turn_rows():
    rng = random.Random(3)
    rows = []
    for c in [*range(-45, 70), 10**15]:
        n = rng.choice([1, 1, 2, 3, 5, 9])
        for t in range(n):
            rows.append((c, None if rng.random() < 0.1 else t, rng.choice(["user", "bot", None]), rng.choice(["Hi you", "", None, "a b  c", "é"])))
    rows += [(200 + i, 0, "system", "the same start") for i in range(60)]  # one turn, many conversations
    rows += [(c, t, "user", f"turn {t}") for c in (340, 341) for t in range(37)]  # long ones
    rows += [(7, 0, "user", "x")] * 3 + [(None, 0, "user", "no id"), (500, 0, "ab", "c"), (501, 0, "a", "bc")]
    return rows


@pytest.mark.parametrize("rebuild, bits, ids, hot", [(True, 1, 3, 2), (False, 12, 256, 256)])
def test_conversation_trie_equals_brute_force(spark, monkeypatch, rebuild, bits, ids, hot):
    monkeypatch.setattr(trie, "CHUNK_BITS", bits)
    monkeypatch.setattr(trie, "PIECE_IDS", ids)
    monkeypatch.setattr(trie, "HOT_CHILDREN", hot)
    df = spark.createDataFrame(turn_rows(), "conv_id long, turn long, role string, text string").repartition(4)
    for name in ("conv", "name", "depth", "token", "place", "i"):
        df = df.withColumn(name, F.lit("input"))
    got = collections.Counter(tuple(r) for r in conversation_trie(df, rebuild=rebuild).collect())
    assert got == brute_trie(turn_rows(), rebuild)


def test_conversation_trie_of_nothing(spark):
    df = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert conversation_trie(df).collect() == []


def test_conversation_without_turns_is_at_the_root(spark):
    # find an id that borrows from an absent head and drops all its own turns
    c = next(c for c in range(1001, 1019) if zlib.crc32(str(c).encode()) % 4 >= 1)
    df = spark.createDataFrame([(c, 0, "user", "x")], "conv_id long, turn long, role string, text string")
    only = conversation_trie(df).collect()
    assert [tuple(r) for r in only] == [(c, 0, None, 1, 0, 1, 0, hashlib.sha256(str(c).encode()).hexdigest())]


def brute_runs(words):
    n, out = len(words), []
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j + q - i
            if j > i and length >= max(6, 4 * q):
                run = words[i : i + length]
                if not any(all(run[k] == run[k + d] for k in range(length - d)) for d in range(1, q)):
                    out.append((i, length, q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def run_texts():
    rng, texts = random.Random(11), []
    for _ in range(400):
        letters, words = "abcdefghijklmnopqrst"[: rng.choice([1, 2, 2, 3, 5, 20])], []
        for _ in range(rng.randint(0, 6)):
            if rng.random() < 0.5:
                words += [rng.choice(letters) for _ in range(rng.randint(0, 12))]
            else:
                period = [rng.choice(letters) for _ in range(rng.randint(1, 7))]
                words += (period * rng.randint(2, 9))[: rng.randint(1, 60)]
        texts.append(words)
    return texts


def test_periodic_runs_equal_brute_force():
    texts = run_texts()
    for size in (1, 7, 400):
        got = [r for k in range(0, len(texts), size) for r in periodic_runs([[w.encode() for w in t] for t in texts[k : k + size]])]
        assert got == [brute_runs(t) for t in texts]


def test_frequency_splitting_keeps_every_run_and_ends_stable():
    import numpy as np

    for words in run_texts()[:120]:
        numbers = np.array([ord(w) for w in words], np.int64)
        if not len(numbers):
            continue
        starts, ends = surviving_segments(numbers, np.array([0, len(numbers)]))
        pieces = list(zip(starts.tolist(), ends.tolist(), strict=True))
        for s, e in pieces:
            assert e - s >= 6 and min(collections.Counter(words[s:e]).values()) >= 4
        assert all(any(s <= a and a + n <= e for s, e in pieces) for a, n, _ in brute_runs(words))


def test_long_repeats_take_few_comparisons():
    words = [b"%d" % (i * i % 97) for i in range(97 * 2000)]
    assert periodic_runs([words, [b"a"] * 100000, [b"a", b"b"] * 60000]) == [
        [(0, 97 * 2000, 97)], [(0, 100000, 1)], [(0, 120000, 2)]
    ]


def planted(words, i):
    """The contract's wording, word by word."""
    h, n = zlib.crc32(str(i).encode()), len(words)
    if i is None or h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w if k < a else words[a + (k - a) % p] for k, w in enumerate(words)]


def test_detect_periodic_runs(spark):
    texts = [(i, " ".join(t)) for i, t in enumerate(run_texts())]
    texts += [(1000, None), (1001, ""), (1002, " \n "), (1003, "a a a a " * 5), (1004, "é\n" * 6), (None, "a b " * 9)]
    texts += [(5, "x y z " * 4)] * 3 + [(1005, "long " * 30000)]
    df = spark.createDataFrame(texts, "doc_id long, text string").repartition(4)
    for name in ("n_runs", "plant", "c0", "c1", "collapsed", "a.b"):
        df = df.withColumn(name, F.lit("input"))
    want = collections.Counter()
    for i, text in texts:
        words = planted(WORD.findall(text or ""), i)
        assert with_planted_run([w.encode() for w in words[:0]], i) == []
        runs = brute_runs(words) if len(words) < 5000 else [(0, len(words), 1)]
        best = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2])) if runs else (None, None, None)
        gone = {k for s, n, q in runs for k in range(s + q, s + n)}
        kept = " ".join(w for k, w in enumerate(words) if k not in gone)
        listed = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
        want[(i, len(runs), *best, 1000 * best[1] // best[2] if runs else None, hashlib.sha256(listed.encode()).hexdigest(), kept, "input")] += 1
    out = detect_periodic_runs(df, plant_by="doc_id", slice_bytes=4000)
    got = out.select("doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed", "`a.b`").collect()
    assert collections.Counter(tuple(r) for r in got) == want
    assert detect_periodic_runs(df.limit(0), plant_by="doc_id").collect() == []
