"""Templates and clusters that crowd the buckets of the similarity join, against brute force."""

import random

import numpy as np
import pytest

from partwright.llm import ngram_join as J
from partwright.llm.ngram_join import ngram_join, prefix_sizes

CODES = [f"{a}{b}" for a in "bcdfghjklm" for b in "aeiou"]


def word(rng):
    return "".join(rng.choice(CODES) for _ in range(3))


def templated(rows, words=120, own=22, seed=4):
    """Texts of one template, each with a stretch of its own words, and copies of some with small changes.

    With 22 own words of 120 two texts have a similarity of about 0.64; changes of a few words make links.
    """
    rng = random.Random(seed)
    template = [word(rng) for _ in range(words)]
    texts = []
    while len(texts) < rows:
        text = list(template)
        at = rng.randrange(words - own)
        text[at : at + own] = [word(rng) for _ in range(own)]
        texts.append(text)
        for _ in range(rng.choice([0] * 12 + [1, 2, 5])):
            near = list(text)
            for _ in range(rng.choice([0, 1, 1, 2, 3])):
                near[rng.randrange(words)] = word(rng)
            texts.append(near[: rng.choice([words, words, words - 9])])
    return [(i, " ".join(t)) for i, t in enumerate(rng.sample(texts[:rows], rows))]


def brute_components(rows, percent=80):
    sets = []
    for _, t in rows:
        w = t.split()
        sets.append({" ".join(w[k : k + 5]) for k in range(len(w) - 4)})
    names = {g: k for k, g in enumerate(sorted(set().union(*sets)))}
    root = list(range(len(sets)))

    def find(k):
        while root[k] != k:
            root[k] = root[root[k]]
            k = root[k]
        return k

    held = [np.array(sorted(names[g] for g in s)) for s in sets]
    size = np.array([len(s) for s in sets])
    by = {}
    for k, s in enumerate(held):
        for g in s:
            by.setdefault(int(g), []).append(k)
    by = {g: np.array(v) for g, v in by.items()}
    for k, s in enumerate(held):
        common = np.zeros(len(sets), np.int64)
        for g in s:
            common[by[int(g)]] += 1
        for j in np.flatnonzero(100 * common >= percent * (size + size[k] - common)):
            a, b = find(k), find(int(j))
            root[max(a, b)] = min(a, b)
    return [find(k) for k in range(len(rows))]


def smallest(rows, roots):
    least = {}
    for (i, _), r in zip(rows, roots, strict=True):
        least[r] = min(least.get(r, i), i)
    return {i: least[r] for (i, _), r in zip(rows, roots, strict=True)}


@pytest.mark.parametrize("crowded, own", [(20, 22), (20, 11), (2, 40)])
def test_templates_crowd_buckets(spark, monkeypatch, crowded, own):
    rows = templated(700 if own != 22 else 2000, own=own, seed=own)
    want = smallest(rows, brute_components(rows))
    used = []
    monkeypatch.setattr(J, "_crowded_links", lambda *a, f=J._crowded_links: used.append(1) or f(*a))
    monkeypatch.setattr(J, "LEAD_GROUP", 8)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    got = {r.doc_id: r.component_id for r in ngram_join(df, crowded=crowded).collect()}
    assert got == want and used
    groups = len(set(want.values()))
    assert groups < len(rows) and (own != 22 or groups > 200)


def test_two_crowds_of_near_copies_stay_apart(spark):
    """Two clusters whose originals have a similarity just below the threshold share a template."""
    rng = random.Random(9)
    template = [word(rng) for _ in range(200)]
    rows = []
    for c in range(2):
        origin = list(template)
        origin[60 + 60 * c : 76 + 60 * c] = [word(rng) for _ in range(16)]
        for _ in range(120):
            near = list(origin)
            near[rng.randrange(200)] = word(rng)
            rows.append((len(rows), " ".join(near)))
    rng.shuffle(rows)
    want = smallest(rows, brute_components(rows))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for crowded in (10, 2048):
        assert {r.doc_id: r.component_id for r in ngram_join(df, crowded=crowded).collect()} == want
    assert len(set(want.values())) == 2


def test_linked_sets_share_a_shingle_of_their_prefixes():
    rng = np.random.default_rng(1)
    for percent in (50, 80, 95):
        for _ in range(400):
            n = int(rng.integers(1, 60))
            a = set(range(n))
            b = set(rng.choice(n, int(rng.integers(1, n + 1)), replace=False).tolist()) | set(range(1000, 1000 + int(rng.integers(0, 8))))
            if 100 * len(a & b) < percent * len(a | b):
                continue
            rank = dict(zip(sorted(a | b), rng.permutation(len(a | b)).tolist(), strict=True))
            small, large = sorted((a, b), key=len)
            short, long = prefix_sizes(np.array([len(small), len(large)]), percent)
            first = set(sorted(small, key=rank.get)[: short[0]])
            assert first & set(sorted(large, key=rank.get)[: long[1]])
