"""Similarity join, decontamination, url filter, quality, mixing and extraction on small tables."""

import collections
import random

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from partwright.llm import html_extract as H
from partwright.llm.decontaminate import contaminated, drop_contaminated, words_of
from partwright.llm.mixing import invert_schedule, mix_sources, plan_mix
from partwright.llm.ngram_join import allocation, band_bounds, most_differences, near_distinct, ngram_join, signatures
from partwright.llm.quality import fit_quality, fit_rules, held_out, score_quality
from partwright.llm.url_filter import labelled_urls, score, train, url_filter

SF = "/root/testdata/sf0.001"


def prose(rng, n, vocabulary=3000):
    return [f"w{rng.randrange(vocabulary)}" for _ in range(n)]


def near_copies(seed=1):
    """Groups of near copies around the threshold, small sets, copies, nulls."""
    rng = random.Random(seed)
    rows = []
    for _ in range(25):
        base = prose(rng, rng.choice([8, 9, 12, 20, 60, 200]))
        for _ in range(rng.randint(1, 6)):
            words = list(base)
            for _ in range(rng.randint(0, 1 + len(base) // 40)):
                words[rng.randrange(len(words))] = f"x{rng.randrange(99)}"
            if rng.random() < 0.3:
                words = words[: max(1, int(len(words) * rng.uniform(0.7, 1)))]
            rows.append((len(rows), "  ".join(w.upper() if rng.random() < 0.1 else w for w in words) + "\n"))
    passage = prose(rng, 80)
    rows += [(len(rows) + k, " ".join(prose(rng, 30) + passage + prose(rng, 30))) for k in range(10)]
    rows += [(1000, None), (1001, ""), (1002, " \t"), (1003, "one two"), (1004, "ONE two"), (1005, "é É")]
    rows += [rows[3], (None, rows[5][1]), (None, "nobody else has this text at all")]
    return rows


def linked(rows, percent):
    sets = []
    for _, t in rows:
        words = "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "").split()
        sets.append(frozenset(tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))) if words else frozenset())
    return sets


@pytest.mark.parametrize("percent", [80, 60])
def test_ngram_join_equals_brute_force(spark, percent):
    rows = near_copies()
    sets = linked(rows, percent)
    known = [k for k, (i, _) in enumerate(rows) if i is not None and sets[k]]
    root = {k: k for k in range(len(rows))}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for x in known:
        for y in known:
            if x < y and 100 * len(sets[x] & sets[y]) >= percent * len(sets[x] | sets[y]):
                a, b = sorted((find(x), find(y)))
                root[b] = a
    least = {}
    for k in known:
        least[find(k)] = min(least.get(find(k), 1 << 60), rows[k][0])
    want = collections.Counter()
    for k, (i, _) in enumerate(rows):
        component = i
        if sets[k]:
            equal = [j for j in known if sets[j] == sets[k]]
            component = least[find(equal[0])] if equal else None
        want[(i, len(sets[k]), component)] += 1
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit(1) for c in ("n", "one", "component")})
    got = ngram_join(df.repartition(3), percent=percent).collect()
    assert collections.Counter(tuple(r) for r in got) == want
    assert ngram_join(df.limit(0)).collect() == []


def test_near_distinct_keeps_one_of_each_group(spark):
    rows = near_copies()
    df = spark.createDataFrame(rows, "doc_id long, text string")
    components = {r.doc_id: r for r in ngram_join(df).collect()}
    kept = [r.doc_id for r in near_distinct(df).collect()]
    want = {i for i, r in components.items() if i is not None and (r.n_shingles == 0 or r.component_id == i)}
    assert sorted(k for k in kept if k is not None) == sorted(want)
    assert kept.count(None) == 2


def test_near_copies_without_an_id_hide_no_links(spark):
    from partwright.llm.common import utf8_parts
    from partwright.llm.ngram_join import _digests
    from partwright.llm.shingles import shingle_sets
    import pyarrow as pa

    # Where two copies agree, the base agrees with both: it is in all buckets that they share.
    rng = random.Random(12)
    rows, led = [], 0
    for k in range(24):
        base = prose(rng, 150)
        three = [" ".join(w) for w in (base, ["x", *base[1:]], [*base[:-1], "y"])]
        grams, owner = shingle_sets(*utf8_parts(pa.array(three)), 5)
        led += int(np.argmin(_digests(grams, owner, 3)[0])) == 0
        rows += [(None, three[0]), (2 * k, three[1]), (2 * k + 1, three[2])]
    assert led > 2
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in ngram_join(df.repartition(3)).collect() if r.doc_id is not None}
    assert got == {i: i - i % 2 for i in range(48)}
    assert sorted(r.doc_id for r in near_distinct(df).collect() if r.doc_id is not None) == list(range(0, 48, 2))


def test_pairs_within_the_threshold_share_a_signature():
    rng = np.random.default_rng(4)
    bounds = band_bounds(80)
    for size in [4, 5, 6, 8, 11, 15, 30, 100, 400, 1500]:
        for _ in range(25):
            a = rng.integers(0, 1 << 63, size).astype(np.uint64)
            other = int(rng.integers(-(-size * 80 // 100), size * 100 // 80 + 1))
            spare = (most_differences(size + other, 80) - abs(size - other)) // 2
            swaps = int(rng.integers(0, max(0, spare) + 1)) if spare >= 0 else 0
            common = min(size, other) - swaps
            b = np.concatenate([a[:common], rng.integers(0, 1 << 63, other - common).astype(np.uint64)])
            if 100 * common < 80 * (size + other - common):
                continue
            found = []
            for x in (a, b):
                owner = np.zeros(len(x), np.int64)
                found.append([set(signatures(np.sort(x), owner, np.array([len(x)]), role, 80)[0].tolist()) for role in (0, 1)])
            (a0, a1), (b0, b1) = found
            assert (a0 & b0) or (a0 & b1) or (a1 & b0) or swaps == 0 == abs(size - other), (size, other, swaps)
    for band in range(1, 30):
        limit, exact, doubled = allocation(band, 80)
        assert exact + 2 * doubled > limit and bounds[band] >= 1


def test_contaminated_documents(spark):
    rng = random.Random(9)
    vocabulary = [f"term{k}" for k in range(1500)]
    say = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    items = [(k, say(rng.choice([12, 25, 60])) + ". " + say(rng.choice([4, 12])) + ".") for k in range(30)]
    items += [(90, None), (91, "")]
    docs, want = [], set()
    for i in range(60):
        body = [say(rng.randint(5, 400))]
        if i % 3 == 0:
            k = rng.randrange(30)
            leak = items[k][1].upper().replace(".", " ,") if i % 2 else items[k][1]
            body.insert(rng.randrange(2), leak)
            want.add((i, k))
        if i % 7 == 1:  # the question alone is no leak
            body.append(items[i % 30][1].split(".")[0])
        docs.append((i, "\n".join(body)))
    docs += [(100, None), (101, ""), (102, "."), (None, items[3][1])]
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("item_id", F.lit("clash"))
    bench = spark.createDataFrame(items, "item_id long, text string")
    for index_bytes in (1 << 20, 2000):
        got = {(r.doc_id, r.item_id) for r in contaminated(df, bench, index_bytes=index_bytes).collect()}
        assert got == want | {(None, 3)}
    kept = {r.doc_id for r in drop_contaminated(df, bench).collect()}
    assert kept == {i for i, _ in docs} - {i for i, _ in want}
    assert contaminated(df.limit(0), bench).collect() == []
    assert contaminated(df, bench.limit(0)).collect() == []


def test_passages_are_found_wherever_they_stand():
    from partwright.llm.decontaminate import BlockMaxIndex, _search
    import pyarrow as pa

    rng = random.Random(2)
    say = lambda n: " ".join(f"t{rng.randrange(4000)}" for _ in range(n))
    items = [(k, say(rng.randint(15, 150)) + ". " + say(8)) for k in range(20)]
    counts = collections.Counter(w for _, t in items for w in set(words_of(t)))
    index = BlockMaxIndex(items, counts, len(items), 30.0, 0.5)
    docs = [say(shift) + " " + t + " " + say(70) for shift in range(0, 70, 3) for _, t in items]
    batch = pa.record_batch([pa.array(range(len(docs))), pa.array(docs)], names=["id", "text"])
    names = ["doc_id", "item_id", "score", "question", "answer", "passage"]
    found = {(r["doc_id"], r["item_id"]) for b in _search([batch], index, 0.8, 0.5, names) for r in b.to_pylist()}
    assert found == {(d, d % 20) for d in range(len(docs))}


def test_items_are_found_with_other_words_inside(spark):
    rng = random.Random(5)
    say = lambda n: " ".join(f"t{rng.randrange(4000)}" for _ in range(n))
    parts = [(say(n), say(m)) for n, m in [(12, 4), (20, 10), (20, 4), (90, 12), (150, 20)] for _ in range(4)]
    bench = spark.createDataFrame([(k, f"{q}. {a}.") for k, (q, a) in enumerate(parts)], "item_id long, text string")

    def cut(words, pieces):
        words = words.split()
        return [" ".join(words[k * len(words) // pieces : (k + 1) * len(words) // pieces]) for k in range(pieces)]

    docs, want = [], set()
    for k, (q, a) in enumerate(parts):
        for gap in (0, 5, 10, 25, 40):
            want.add((len(docs), k))
            docs.append((len(docs), f"{say(50)} {q} {say(gap)} {a} {say(60)}"))
        if len(q.split()) > 32:
            for pieces in (3, 5):
                want.add((len(docs), k))
                docs.append((len(docs), f"{say(40)} {f' {say(8)} '.join(cut(q, pieces))} {say(8)} {a} {say(40)}"))
        # no leaks: the question alone, the answer too far behind or before it
        for text in (q, f"{q} {say(400)} {a}", f"{a} {say(400)} {q}"):
            docs.append((len(docs), f"{say(50)} {text} {say(50)}"))
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert {(r.doc_id, r.item_id) for r in contaminated(df, bench).collect()} == want


def test_url_rules_and_model(spark):
    rows = [
        (1, "http://Example.COM/en/1"), (2, "https://www.example.com/en/2?x=/es/"), (3, "http://a.www.example.com/en/"),
        (4, "http://x.example.com/fr/1"), (5, "http://foo.net/es/9#a"), (6, "http://foo.net/de/9"), (7, "http://net"),
        (8, None), (9, "no scheme"), (10, "ftp://h.org?q=://b"), (11, ""), (12, "http://badexample.com/en/1"),
        (13, "http://cheap-pills.example.org/en/7"), (14, "://.com/x"), (15, "http://com"), (16, "a://b://c.net/fr/x"),
    ]
    want = {
        1: ("example.com", "/en/1", "example.com/en/", "block"),
        2: ("www.example.com", "/en/2", "www.example.com/en/", "allow"),
        3: ("a.www.example.com", "/en/", "www.example.com/en/", "allow"),
        4: ("x.example.com", "/fr/1", "com/", "allow"),
        5: ("foo.net", "/es/9", "net/es/", "block"),
        6: ("foo.net", "/de/9", None, "allow"),
        7: ("net", "", None, None),
        8: ("", "", None, None),
        9: ("", "", None, None),
        10: ("h.org", "", None, None),
        11: ("", "", None, None),
        12: ("badexample.com", "/en/1", "com/", "allow"),
        13: ("cheap-pills.example.org", "/en/7", None, "block"),
        14: (".com", "/x", "com/", "allow"),
        15: ("com", "", None, None),
        16: ("b:", "//c.net/fr/x", None, None),
    }
    df = spark.createDataFrame(rows, "page_id long, url string").withColumn("host", F.lit("clash"))
    for r in url_filter(df).collect():
        host, path, rule, verdict = want[r.page_id]
        assert (r.host, r.path, r.rule) == (host, path, rule), r
        assert r.verdict in ("allow", "block") and (verdict is None or r.verdict == verdict), r
    assert url_filter(df.limit(0)).collect() == []


def test_url_model_on_hosts_it_has_not_seen():
    rows = labelled_urls()
    wrong = 0
    hosts = sorted({h for h, _, _ in rows})
    for fold in range(5):
        out = set(hosts[fold::5])
        weights = train([r for r in rows if r[0] not in out])
        wrong += sum((score(weights, h, p) >= 0.5) != bool(y) for h, p, y in rows if h in out)
    assert wrong / len(rows) < 0.1
    weights = train(rows)
    assert sum((score(weights, h, p) >= 0.5) != bool(y) for h, p, y in rows) == 0


def test_quality_rules_equal_their_columns_and_predict(spark):
    sf = SF.replace("0.001", "0.1")
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    model = fit_quality(docs, labels)
    assert 0 < len(model.rules) < 120
    extra = spark.createDataFrame([(-1, None), (-2, ""), (None, "text")], "doc_id long, text string")
    scored = score_quality(docs.select("doc_id", "text").unionByName(extra).withColumn("score", F.lit("clash")), model)
    rows = scored.join(labels, "doc_id", "left").select("doc_id", "held_out", "score", "predicted", "quality").collect()
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows)
    out = [r for r in rows if r.held_out and r.quality is not None]
    assert np.mean([r.predicted == r.quality for r in out]) > 0.97
    # clean documents stay
    assert np.mean([r.predicted for r in out if r.quality == 1]) > 0.99
    assert score_quality(docs.limit(0), model).collect() == []


def test_quality_learns_nothing_from_held_out_rows(spark):
    ids = spark.range(200).withColumnRenamed("id", "doc_id")
    docs = ids.withColumn("text", F.when(F.col("doc_id") % 2 == 0, F.lit("Good words here.")).otherwise(F.lit("$$$ ### !!!")))
    honest = ids.withColumn("quality", (F.col("doc_id") % 2 == 0).cast("int"))
    lying = honest.withColumn("quality", F.when(held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    assert fit_quality(docs, honest) == fit_quality(docs, lying)
    one = fit_quality(docs, honest.withColumn("quality", F.lit(1)))
    assert not one.rules and fit_rules(np.zeros((0, 11)), np.zeros(0)).rules == ()


def mixed_rows():
    rng = random.Random(8)
    rows = []
    for s, n in (("big", 60), ("a", 5), ("é", 12), ("Z", 20), (None, 9), ("tiny", 1)):
        rows += [(len(rows) + k, " ".join(["w"] * rng.randint(0, 60)), s) for k in range(n)]
    return rows + [(900, None, "big"), (901, "", "void"), (None, "x y", "a"), (902, "r", "Z"), (902, "r", "Z")]


def test_mix_takes_what_the_targets_say(spark):
    rows = mixed_rows()
    sizes = collections.Counter()
    for _, t, s in rows:
        sizes[s] += len((t or "").split())
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None]
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}
    targets, free, left = {}, list(order), float(sum(sizes.values()))
    while free:
        unit = left / sum(weight[s] for s in free)
        over = [s for s in free if unit * weight[s] > 3 * sizes[s]]
        for s in over or free:
            targets[s] = 3.0 * sizes[s] if over else unit * weight[s]
            left -= targets[s]
        free = [s for s in free if s not in targets]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("copies", F.lit("clash"))
    plan = plan_mix(df.repartition(4)).collect()
    assert len(plan) == len(rows)
    taken = collections.Counter()
    for r in plan:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(targets[r.source])
        assert 0 <= r.taken <= 3 * r.size and r.taken == sum(c.take for c in r.copies)
        taken[r.source] += r.taken
    assert all(abs(taken[s] - targets[s]) <= 1 for s in targets)
    key = lambda r: (r.doc_id is None, r.doc_id or 0, r.taken)
    again = plan_mix(df.repartition(7)).collect()
    assert sorted([tuple(r) for r in plan], key=str) == sorted([tuple(r) for r in again], key=str) and key
    mixed = mix_sources(df).collect()
    assert [r.position for r in mixed] == sorted(r.position for r in mixed)
    assert sum(r["take"] for r in mixed) == sum(taken.values())
    assert plan_mix(df.limit(0)).collect() == []


def test_schedules_invert_their_integral(spark):
    values = (1.5, 0.2, 2.0, 1.0)
    grid = spark.range(0, 1001).select((F.col("id") / 1000).alias("u"))
    rows = grid.select("u", invert_schedule(F.col("u"), values).alias("t")).collect()
    knots = np.linspace(0, 1, len(values))
    for u, t in rows:
        x = np.linspace(0, t, 4001)
        y = np.interp(x, knots, values)
        area = float(np.sum((y[1:] + y[:-1]) / 2 * np.diff(x)))
        whole = float(np.sum((np.array(values[1:]) + values[:-1]) / 2 / (len(values) - 1)))
        assert area / whole == pytest.approx(u, abs=2e-5)
    assert rows[-1].t == pytest.approx(1.0)


def test_leaf_blocks():
    page = (
        "<!DOCTYPE html><html><head><title>T &amp; t</title><style>p{}</style></head><body><!-- <p>no</p> -->"
        "<script>if (a<b) '</p>'</script><nav><ul><li><a href='/x'>Home</a><li>Two</ul></nav>"
        "<article class=\"Post-Body\"><h1>A&nbsp;&lt;b&gt;\n c</h1><p>One <b>two</b>thr<i>ee</i><p>x<br>y<p hidden>z 1 < 2</article>tail"
    )
    blocks = H.leaf_blocks(page)
    assert [b[0] for b in blocks] == ["Home", "Two", "A <b> c", "One twothree", "x y", "z 1 < 2", "tail"]
    assert "c:post" in blocks[2][1] and "c:hidden" in blocks[5][1] and "t:nav" in blocks[0][1]
    assert blocks[0][2] == 4
    assert H.leaf_blocks("") == [] and H.leaf_blocks("<p>") == []
    assert [b[0] for b in H.leaf_blocks("a <b")] == ["a"]


def test_unclosed_elements_lose_no_blocks():
    def texts(page):
        return [b[0] for b in H.leaf_blocks(page)]

    for tag in ("select><option", "svg><path", "iframe src='x'", "object", "textarea", "noscript", "template", "title"):
        page = f"<article><p>A one.</p><{tag}>x<p>B two.</p><p>C three.</p></article><p>D</p>"
        assert texts(page) == ["A one.", "B two.", "C three.", "D"], tag
        name = tag.split(">")[0].split()[0]
        assert texts(page.replace("<p>B", f"</{name}><p>B")) == ["A one.", "B two.", "C three.", "D"]
        # an unclosed one before a closed one
        later = page.replace("<p>D", f"<{name}>hidden</{name}><p>D")
        assert texts(later)[-2:] == ["C three.", "D"] and "B two." in texts(later)
    assert texts("<svg><svg></svg><text>no</text></svg>yes") == ["yes"]
    assert texts("<svg><text>x y") == ["x y"]
    formula = "<p>Given <math><mi>x</mi><mo>=</mo><mn>2</mn><annotation>TeX</annotation></math> then.</p>"
    assert texts(formula) == ["Given x=2 then."]
    assert texts("<svg>" * 50_000 + "<p>end") == ["end"] and texts("<svg>" * 50_000 + "end") == ["end"]


def test_long_pages_are_labelled_in_pieces_alike():
    weights = H.default_network()
    blocks = [b for _ in range(40) for b in H.leaf_blocks(H._PageMaker(5).page())]
    whole = H.label_blocks([H.block_vectors(blocks)], weights)[0]
    for piece in (1, 37, 10_000):
        assert np.allclose(H.label_long_page(blocks, weights, piece), whole, atol=1e-4)


def test_labelled_in_groups_equals_one_by_one(monkeypatch):
    weights = H.default_network()
    pages = [H.leaf_blocks(H._PageMaker(k).page()) for k in range(30)] + [[]]
    one = [H.label_blocks([H.block_vectors(p)], weights)[0] for p in pages]
    monkeypatch.setattr(H, "BATCH_BLOCKS", 20)
    for a, b in zip(one, H.labelled(pages, weights), strict=True):
        assert np.allclose(a, b, atol=1e-4)


def test_network_labels_unseen_layouts_and_its_gradients_hold():
    maker = H._PageMaker(4321)
    weights = H.default_network()
    pages = [H.training_page(maker) for _ in range(150)]
    labels = H.label_blocks([v for v, _ in pages], weights)
    right = np.concatenate([(p >= 0.5) == (y > 0.5) for p, (_, y) in zip(labels, pages, strict=True)])
    assert right.mean() > 0.985
    # gradients against differences
    rng = np.random.default_rng(0)
    x, mask = rng.normal(size=(4, 2, 5)), np.array([[1, 1], [1, 1], [1, 0], [1, 0]], float)
    wx, wh, b = rng.normal(size=(5, 12)), rng.normal(size=(3, 12)), rng.normal(size=12)
    d = rng.normal(size=(4, 2, 3))
    _, kept = H._direction(x, mask, wx, wh, b, True)
    grads = H._direction_back(x, d, kept, wx, wh)
    loss = lambda: float((H._direction(x, mask, wx, wh, b, False)[0] * d).sum())
    for array, grad in zip((wx, wh, b), grads, strict=True):
        for at in [tuple(rng.integers(0, n) for n in array.shape) for _ in range(6)]:
            array[at] += 1e-6
            up = loss()
            array[at] -= 2e-6
            down = loss()
            array[at] += 1e-6
            assert (up - down) / 2e-6 == pytest.approx(grad[at], rel=1e-4, abs=1e-6)


def test_block_vectors_read_whole_blocks():
    start = " ".join(f"word{k}" for k in range(400))
    one, two = start + " more" * 9000, start + " share" * 9000
    a, b = H.block_vectors([(one, ("t:p",), 0), (two, ("t:p",), 0)])
    words = slice(H.PATH_DIMS, H.PATH_DIMS + H.WORD_DIMS)
    assert not np.array_equal(a[words], b[words])
    for text, v in ((one, a), (two, b)):
        buckets = np.bincount([H._word_bucket(w) for w in text.split()], minlength=H.WORD_DIMS)
        assert np.allclose(v[words] ** 2, buckets / 9400, atol=1e-6)
        assert v[words.stop + 1] == pytest.approx(np.log1p(9400) / 6)


def test_main_text_of_pages(spark):
    import html
    import re

    pages = duckdb.sql(f"select page_id, html from '{SF}/pages.parquet'").fetchall()
    want = {}
    for i, page in pages:
        inside = re.search(r"<article>(.*?)</article>", page, re.DOTALL)[1]
        want[i] = " ".join(html.unescape(re.sub(r"</?b>", "", re.sub(r"</?(?!b>)[a-z][^>]*>", " ", inside))).split())
    rows = pages + [(-1, None), (-2, ""), (-3, "<html><body></body></html>"), (-4, "<p>" + "word. " * 50_000)]
    df = spark.createDataFrame(rows, "page_id long, html string").withColumn("text", F.lit("clash"))
    got = {r.page_id: r for r in H.main_text(df).collect()}
    assert len(got) == len(rows)
    assert all(r.n_chars == len(r.text) for r in got.values())
    assert [got[i].text for i in (-1, -2, -3)] == ["", "", ""]
    assert np.mean([got[i].text == t for i, t in want.items()]) >= 0.98
    assert H.main_text(df.limit(0)).collect() == []


def test_large_and_small_buckets_give_the_same_pairs():
    from partwright.llm.ngram_join import _apart, _large_pairs, _small_pairs, sketches
    import pyarrow as pa

    rng = np.random.default_rng(6)
    base = rng.integers(0, 1 << 63, 120).astype(np.uint64)
    sets = [np.unique(np.concatenate([base[rng.random(120) < p], rng.integers(0, 1 << 63, k).astype(np.uint64)]))
            for p, k in [(rng.uniform(0.6, 1), int(rng.integers(0, 25))) for _ in range(80)]]
    n = np.array([len(s) for s in sets])
    rows = {
        "bucket": np.zeros(80, np.int64),
        "id": rng.permutation(80),
        "n": n,
        "component": rng.choice(5, 80, p=[0.6, 0.1, 0.1, 0.1, 0.1]),
        "role": rng.integers(0, 2, 80),
        "leads": np.arange(80) == 7,
        "sketch": sketches(np.concatenate(sets), np.repeat(np.arange(80), n), n),
    }
    as_set = lambda found: {(*sorted((int(a), int(b))), int(d)) for a, b, d in found.T}
    large = as_set(_large_pairs(rows, 80))
    small = as_set(_small_pairs(rows, np.array([0]), np.array([80]), 80))
    # sketches are folded to the bucket's or to the pair's size, and a pair of links is in both
    links = set()
    for a in range(80):
        for b in range(a + 1, 80):
            common = len(np.intersect1d(sets[a], sets[b]))
            open_ = rows["component"][a] != rows["component"][b] and not (rows["role"][a] and rows["role"][b]) and 7 not in (a, b)
            if open_ and 100 * common >= 80 * (n[a] + n[b] - common):
                links.add((a, b))
    assert links and links <= {p[:2] for p in large} and links <= {p[:2] for p in small}
    table = pa.table({k: pa.array(v) if k != "sketch" else pa.array(v, pa.binary()) for k, v in rows.items()})
    halves = [b for b in table.to_batches(max_chunksize=33)]
    ids = rows["id"]
    found = {(r["a"], r["b"]) for b in _apart(iter(halves), 80, False) for r in b.to_pylist()}
    assert {tuple(sorted((int(ids[a]), int(ids[b])))) for a, b in links} <= found
    best = [r for b in _apart(iter(halves), 80, True) for r in b.to_pylist()]
    assert 0 < len(best) <= 10
