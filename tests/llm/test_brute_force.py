"""Operators beyond SQL against plain Python: url rules, rule scores, chunk copies."""

import re

import numpy as np
from pyspark.sql import functions as F

from partwright.llm import chunk_dedup as C
from partwright.llm import quality as Q
from partwright.llm.url_filter import RULES, labelled_urls, score, train, url_filter

SF = "/root/testdata/sf0.001"


def test_url_filter_equals_plain_python(spark):
    weights = train(labelled_urls())
    pages = spark.read.parquet(SF.replace("0.001", "0.01") + "/pages.parquet").select("page_id", "url")
    odd = [(-1, None), (-2, ""), (-3, "x://" + "h" * 50_000 + ".net/es/"), (-4, "a://NET/es/"), (-4, "a://NET/es/"), (-5, "http://É.com?x")]
    rows = [tuple(r) for r in pages.collect()] + odd
    got = url_filter(spark.createDataFrame(rows, "page_id long, url string")).collect()
    want = []
    for i, url in rows:
        host, path = "", ""
        if url is not None and "://" in url:
            after = url.split("://", 1)[1]
            host = re.match(r"[^/?#]*", after)[0]
            path = re.match(r"[^?#]*", after[len(host) :])[0]
            host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
        fits = [(len(h + p), h + p, kind) for kind, h, p in RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
        rule = max(fits)[1] if fits else None
        own = None if fits else score(weights, host, path)
        verdict = max(fits)[2] if fits else "block" if own >= 0.5 else "allow"
        want.append((i, url, host, path, rule, verdict, own))
    assert len(got) == len(want)
    by_row = lambda r: (r[0], r[1] or "")
    for g, w in zip(sorted(got, key=by_row), sorted(want, key=by_row), strict=True):
        assert tuple(g)[:6] == w[:6]
        assert (g.score is None) == (w[6] is None) and (w[6] is None or abs(g.score - w[6]) < 1e-12)


def test_rule_model_and_its_columns_agree(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    model = Q.fit_quality(docs, labels)
    extra = [(-1, None), (-2, ""), (-3, "word " * 100_000), (-4, "\n\n"), (-5, "same row"), (-5, "same row")]
    rows = docs.select("doc_id", "text").unionByName(spark.createDataFrame(extra, "doc_id long, text string"))
    names = [Q._PREFIX + s for s in Q.STATISTICS]
    table = Q.with_statistics(rows).select("doc_id", *names, model.column().alias("score")).toPandas()
    want = model.score(table[names].to_numpy(float))
    assert np.allclose(table["score"], want, atol=1e-12)
    scored = Q.score_quality(rows, model).select("doc_id", "score").toPandas()
    assert np.allclose(np.sort(scored["score"]), np.sort(want), atol=1e-12)


def plain_chunks(data: bytes, mean=C.MEAN_BYTES, most=C.MOST_BYTES):
    """Chunks byte by byte: a rolling gear hash of 16 bits, whose window is therefore 16 bytes."""
    out, start, gear = [], 0, 0
    for i, byte in enumerate(data):
        gear = ((gear << 1) + int(C.GEAR[byte])) & 0xFFFF
        if gear < (1 << 16) // mean or i == len(data) - 1:
            while start < i + 1:
                end = min(start + most, i + 1)
                out.append((start, end))
                start = end
    return out


def test_chunk_dedup_equals_a_dictionary_of_chunks(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").filter("doc_id < 120")
    extra = [(900, None), (901, ""), (902, "ab" * 3000), (903, "ab" * 3000)]
    rows = docs.unionByName(spark.createDataFrame(extra, "doc_id long, text string"))
    keyed = rows.select("doc_id", "text", F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "text").alias("key")).collect()
    least, places = {}, {}
    chunks = {r.doc_id: [(a, b, (r.text or "").encode()[a:b]) for a, b in plain_chunks((r.text or "").encode())] for r in keyed}
    for r in keyed:
        for k, (_, _, c) in enumerate(chunks[r.doc_id]):
            places.setdefault(c, []).append((r.key, k))
            least[c] = min(least.get(c, r.key), r.key)

    def long_runs(flags, own):
        out, k = [False] * len(flags), 0
        while k < len(flags):
            end = k
            while end < len(flags) and flags[end]:
                end += 1
            if end > k and sum(b - a for a, b, _ in own[k:end]) >= C.MIN_BYTES:
                out[k:end] = [True] * (end - k)
            k = max(end, k + 1)
        return out

    want = {}
    for r in keyed:
        own = chunks[r.doc_id]
        copied = [len(places[c]) > 1 for _, _, c in own]
        stays = [least[c] == r.key and min(k for key, k in places[c] if key == r.key) == n for n, (_, _, c) in enumerate(own)]
        repeated = long_runs(copied, own)
        gone = long_runs([x and not y for x, y in zip(repeated, stays, strict=True)], own)
        want[r.doc_id] = (
            sum(b - a for (a, b, _), x in zip(own, repeated, strict=True) if x),
            b"".join(c for (_, _, c), x in zip(own, gone, strict=True) if not x),
        )
    got = {r.doc_id: (r.n_repeated, bytes(r.kept)) for r in C.chunk_dedup(rows).collect()}
    assert got == want
    assert any(n for n, _ in want.values())


def test_hot_contents_follow_their_rows(spark):
    """A hot content without ids, one with ids and cold ones: runs merge to one group each."""
    from partwright.llm.exact_dedup import exact_dedup

    rows = [(None, "Hot")] * 900 + [(i, "warm") for i in range(500)] + [(1000 + i, f"cold {i % 40}") for i in range(80)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    for hot_rows in (10, 100, 10_000):
        out = exact_dedup(df, hot_rows=hot_rows, hot_runs=2, hot_share=0.0).collect()
        assert len(out) == len(rows)
        sizes = {r.text_sha256: r.group_size for r in out}
        assert sorted(sizes.values()) == [2] * 40 + [500, 900]
        assert sum(r.kept for r in out) == 42
        assert all((r.keep_id is None) == (r.group_size == 900) for r in out)
        assert {r.keep_id for r in out if r.group_size == 500} == {0}
