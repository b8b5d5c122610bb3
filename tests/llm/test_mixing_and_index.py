"""Mixing through its schedule whatever the column names, and the index of benchmark items against unpruned BM25."""

import collections
import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from partwright.llm import mixing, queries
from partwright.llm.decontaminate import BLOCK_UNITS, BlockMaxIndex, drop_contaminated, words_of
from partwright.llm.html_extract import main_text
from partwright.llm.mixing import in_training_order, mix_sources, plan_mix

SF = "/root/testdata/sf0.001"
CLASHES = (
    "source_size bin order tie offset weight cap share unit at k_source k_bin demand target __c __source __order __bin"
    " position copy take taken_copy in_0 in_1 html text_as own hit a.b __html __hit"
).split()


def with_clashes(df):
    return df.withColumns({c: F.lit(f"input {c}") for c in CLASHES if c not in df.columns})


def rows_of(n=300):
    rng = random.Random(2)
    rows = [(i, "w " * rng.randint(0, 40), rng.choice(["a", "b", "c", None])) for i in range(n)]
    rows += [(None, "null id " * (k % 50), "a") for k in range(200)] + [(7, "tie one two", "a"), (7, "tie two one", "a")]
    return rows + [(8, "same row", "b")] * 5


def test_mixing_passes_columns_through_whatever_their_names(spark):
    df = with_clashes(spark.createDataFrame(rows_of(), "doc_id long, text string, source string"))
    plan = plan_mix(df)
    replaced = {"source_size", "target"}
    for r in plan.collect():
        assert all(r[c] == f"input {c}" for c in CLASHES if c not in replaced)
    mixed = mix_sources(df).collect()
    assert all(r[c] == f"input {c}" for r in mixed for c in CLASHES if c not in replaced | {"position", "copy", "take"})
    ordered = in_training_order(plan).collect()
    assert len(ordered) == len(rows_of()) and all((r.position is None) == (r.taken == 0) for r in ordered)


def test_mixing_is_repeatable_for_ties_and_null_ids(spark, monkeypatch):
    df = spark.createDataFrame(rows_of(), "doc_id long, text string, source string")
    first = collections.Counter(str(r) for r in mix_sources(df.repartition(3)).collect())
    monkeypatch.setattr(mixing, "BIN_ROWS", 2)  # many bins, same places
    assert collections.Counter(str(r) for r in mix_sources(df.repartition(8)).collect()) == first


def test_null_ids_are_spread_over_bins(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(mixing, "source_targets", lambda bins, *a, f=mixing.source_targets: seen.append(bins) or f(bins, *a))
    monkeypatch.setattr(mixing, "BIN_ROWS", 10)
    rows = [(None, f"text {k}", "a") for k in range(2000)]
    plan_mix(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    assert seen[0].select("bin").distinct().count() > 100


def test_op8_runs_its_schedule_and_range_sort(spark):
    plan = queries.op8_mix_sources(spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert "SQRT" in plan.upper() and "RepartitionByExpression" in plan and "position" in plan
    got = queries.op8_mix_sources(spark, SF).collect()
    known = [r.position for r in got if r.position is not None]
    assert known == sorted(known) and all(0 <= p <= 1 for p in known)


@pytest.mark.parametrize("seed", [1, 2])
def test_block_max_retrieval_equals_unpruned_bm25(seed):
    rng = random.Random(seed)
    vocabulary = [f"w{int(rng.expovariate(0.02))}" for _ in range(600)]
    items = [(k, " ".join(rng.choice(vocabulary) for _ in range(rng.randint(3, 70))) + ". " + rng.choice(vocabulary)) for k in range(300)]
    words = [words_of(t) for _, t in items]
    counts = collections.Counter(w for ws in words for w in set(ws))
    index = BlockMaxIndex(items, counts, len(items), float(np.mean([min(32, len(w)) for w in words])), 0.4)
    passages = []
    for k in range(200):
        own = [rng.choice(vocabulary) for _ in range(20)]
        if k % 2:
            own += rng.choice(words)[: rng.randint(1, 64)]
        passages.append(sorted({index.vocabulary[w] for w in own if w in index.vocabulary}))
    # unpruned: the sum of the impacts of a passage's distinct words, for every unit
    terms = index.entry // (index.blocks * BLOCK_UNITS)
    table = np.zeros((len(index.vocabulary), index.blocks * BLOCK_UNITS))
    table[terms, index.units] = index.impacts
    want = {(p, u): s for p, ts in enumerate(passages) for u, s in enumerate(table[ts].sum(axis=0)) if s >= 0.4 - 1e-9}
    tokens = np.array([t for ts in passages for t in ts], np.int64)
    place = np.repeat(np.arange(len(passages)), [len(ts) for ts in passages])
    found, blocks = index.candidates(tokens, place)
    query = np.concatenate([np.full(len(passages[p]), q) for q, p in enumerate(found)]).astype(np.int64)
    scores = index.scores(query, np.concatenate([passages[p] for p in found]).astype(np.int64), blocks)
    got = {
        (int(found[q]), int(blocks[q] * BLOCK_UNITS + u)): scores[q, u] for q, u in np.argwhere(scores >= 0.4 - 1e-9).tolist()
    }
    assert got.keys() == want.keys() and len(want) > 50
    assert all(got[k] == pytest.approx(want[k]) for k in want)


def test_index_build_is_linear():
    rng = random.Random(3)
    vocabulary = [f"w{k}" for k in range(5000)]

    def seconds(n):
        items = [(k, " ".join(rng.choice(vocabulary) for _ in range(50))) for k in range(n)]
        counts = collections.Counter(w for _, t in items for w in set(t.split()))
        began = time.process_time()
        BlockMaxIndex(items, counts, n, 25.0, 0.4)
        return time.process_time() - began

    seconds(500)
    assert seconds(8000) < 8 * seconds(2000)  # four times the items; the square would be sixteen


def test_filters_pass_columns_through_whatever_their_names(spark):
    docs = with_clashes(spark.read.parquet(f"{SF}/documents.parquet"))
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    left = drop_contaminated(docs, bench)
    assert left.columns == docs.columns and 0 < left.count() < docs.count()
    pages = with_clashes(spark.read.parquet(f"{SF}/pages.parquet").limit(5))
    out = main_text(pages)
    assert set(pages.columns) - {"html"} <= set(out.columns)
    assert all(r[c] == f"input {c}" for r in out.collect() for c in CLASHES if c != "html")


def test_other_operators_pass_columns_through_whatever_their_names(spark, monkeypatch):
    from partwright.llm import line_dedup as L
    from partwright.llm.ngram_join import near_distinct
    from partwright.llm.quality import fit_quality, keep_quality, score_quality
    from partwright.llm.url_filter import url_filter

    names = "__gone __again gone again one __id __lines of lines own __w __n __once once id in_2 __hit score host a.b".split()
    docs = spark.read.parquet(f"{SF}/documents.parquet").withColumns({c: F.lit(f"input {c}") for c in names})
    model = fit_quality(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    monkeypatch.setattr(L, "COPY_DOCS", 1)  # as many copies of a shard as documents hold its commonest line
    made = {
        "near_distinct": (near_distinct(docs), set()),
        "line_dedup": (L.line_dedup(docs), set()),
        "keep_quality": (keep_quality(docs, model), set()),
        "score_quality": (score_quality(docs, model), {"score"}),
        "url_filter": (url_filter(docs.withColumnRenamed("source", "url")), {"score", "host"}),
    }
    for name, (out, replaced) in made.items():
        rows = out.collect()
        assert rows and set(names) <= set(out.columns), name
        assert all(r[c] == f"input {c}" for r in rows for c in names if c not in replaced), name
    plain = L.line_dedup(docs.select("doc_id", "text"))
    assert collections.Counter(map(tuple, plain.collect())) == collections.Counter(
        map(tuple, made["line_dedup"][0].select(*plain.columns).collect())
    )
