"""The pipeline stage by stage, and the registered queries against their SQL."""

import collections

import duckdb
import pytest

import corpus_pipeline
from partwright.llm import queries

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "pages", "benchmark", "labels", "conversations"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    got = queries.QUERIES[name](spark, SF)
    result = con.execute(queries.ORACLE[name])
    columns = [c[0] for c in result.description]
    assert sorted(columns) == sorted(got.columns)
    assert collections.Counter(tuple(r) for r in got.select(columns).collect()) == collections.Counter(result.fetchall())


def test_queries_return_a_row_for_each_document(spark):
    n = spark.read.parquet(f"{SF}/documents.parquet").count()
    for name in ("op1_exact_dedup", "op2_suffix_dedup", "op5_quality_classifier", "op10_chunk_dedup"):
        assert queries.QUERIES[name](spark, SF).count() == n


def test_stages_keep_columns_and_take_effect(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    counts = [docs.count()]
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality_classifier", "line_dedup", "ngram_join", "decontaminate", "mix_sources"
    ]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = corpus_pipeline.written(stage(spark, docs, SF), f"test_{name}")
        assert after.columns == list(corpus_pipeline.COLUMNS)
        before = {r.doc_id: r.text for r in docs.collect()}
        now = {r.doc_id: r.text for r in after.collect()}
        assert set(now) <= set(before)
        if name != "line_dedup":
            assert all(now[i] == before[i] for i in now)
        docs = after
        counts.append(docs.count())
    assert counts[0] > counts[1] == counts[2] > counts[3] >= counts[4] > 0
    mixed = corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
    assert {r.doc_id for r in mixed} <= {r.doc_id for r in docs.collect()}
    assert [r.position for r in mixed] == sorted(r.position for r in mixed)


def test_pipeline_on_empty_documents(spark, tmp_path):
    for table in ("documents", "labels", "benchmark"):
        rows = spark.read.parquet(f"{SF}/{table}.parquet")
        (rows.limit(0) if table == "documents" else rows).write.parquet(f"{tmp_path}/{table}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def _az(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def _words(text):
    return [w for w in "".join(" " if c in " \t\n\x0b\x0c\r" else c for c in text or "").split(" ") if w]


def _line_twin(docs):
    held = collections.defaultdict(set)
    key = lambda line: _az(line.strip(" \t\n\x0b\x0c\r"))
    for i, text in docs.items():
        for line in (text or "").split("\n"):
            if len(key(line)) >= 20:
                held[key(line)].add(i)
    gone = {k: max(ids) for k, ids in held.items() if len(ids) >= 3}
    return {i: "\n".join(x for x in (t or "").split("\n") if gone.get(key(x), i) == i) for i, t in docs.items()}


def _near_twin(docs):
    sets, root = {}, {i: i for i in docs}
    for i, text in docs.items():
        w = _words(_az(text or ""))
        sets[i] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} - {()}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in docs:
        for b in docs:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {i: t for i, t in docs.items() if not sets[i] or find(i) == i}


def test_stages_equal_plain_python(spark):
    """Quality by the model in numpy, lines and near copies by brute force, leaks by whole items, the mix by its sums."""
    from partwright.llm import quality as Q

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    model = Q.fit_quality(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    names = [Q._PREFIX + s for s in Q.STATISTICS]
    table = Q.with_statistics(docs.select("doc_id", "text")).select("doc_id", "text", *names).toPandas()
    good = model.score(table[names].to_numpy(float)) >= 0.3
    want = {int(i): t for i, t, ok in zip(table["doc_id"], table["text"], good, strict=True) if ok}
    for name, twin in (("quality_classifier", None), ("line_dedup", _line_twin), ("ngram_join", _near_twin)):
        docs = corpus_pipeline.written(stages[name](spark, docs, SF), f"twin_{name}")
        want = twin(want) if twin else want
        assert {r.doc_id: r.text for r in docs.collect()} == want, name
    items = [" ".join(_words(_az(r.text))) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    whole = {i for i, t in want.items() if any(x in " ".join(_words(_az(t or ""))) for x in items if len(x.split()) > 8)}
    left = corpus_pipeline.written(stages["decontaminate"](spark, docs, SF), "twin_leaks")
    kept = {r.doc_id for r in left.collect()}
    assert not kept & whole and kept <= set(want) and len(kept) >= 0.9 * (len(want) - len(whole))
    sizes, taken = collections.Counter(), collections.Counter()
    for r in left.collect():
        sizes[r.source] += len(_words(r.text))
    mixed = stages["mix_sources"](spark, left, SF).collect()
    for r in mixed:
        taken[r.source] += r["take"]
        assert r.copy < 3 and 0 < r["take"] <= r.size
    assert all(abs(taken[r.source] - r.target) <= 1 for r in mixed) and sum(sizes.values()) - len(sizes) <= sum(taken.values()) <= sum(sizes.values())
