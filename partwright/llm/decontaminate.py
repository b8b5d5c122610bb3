"""Benchmark decontamination by BM25 retrieval with block-max pruning.

Benchmark items are cut into units of a few dozen words, which an inverted index
holds in blocks; scores are BM25 as shares of a unit's score against itself.  Every
passage of every document is a query.  In each block the terms of small impact that
stay far below the threshold together are set aside; the others bound the score of a
passage from the block's maximal impacts, and only blocks whose bound reaches the
threshold are scored.  Retrieved items are verified by the overlap of question and answer
where the item aligns, or where each of them does.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from partwright.llm.common import byte_slices, set_aside

UNIT_WORDS = 32
PASSAGE_WORDS = 2 * UNIT_WORDS  # with a step of half, every unit lies whole in a passage
BLOCK_UNITS = 2
MIN_SCORE = 0.5
# Share of the threshold that the terms set aside may reach together.
ASIDE = 0.2
MIN_QUESTION = 0.8
MIN_ANSWER = 0.5
K1, B = 1.2, 0.75
SLICE_BYTES = 4 << 20
# Text of items in one index, which goes to every task; more items take several passes.
INDEX_BYTES = 16 << 20

_WORD = re.compile(r"[^\W_]+")
_STOP = re.compile(r"[.!?\n]")


def words_of(text: str | None) -> list[str]:
    return _WORD.findall(text.lower()) if text else []


def question_and_answer(text: str) -> int:
    """Number of words before the answer: the last sentence, or the last third of a single one."""
    stops = [m.end() for m in _STOP.finditer(text.rstrip(".!?\n \t"))]
    words = words_of(text)
    before = len(words_of(text[: stops[-1]])) if stops else 0
    if not 0 < before < len(words):
        before = max(1, len(words) - max(1, len(words) // 3))
    return min(before, len(words))


class BlockMaxIndex:
    """Units of items with their BM25 impacts, by term and by block."""

    def __init__(self, items: list[tuple], df: dict[str, int], n_items: int, mean_words: float, min_score: float):
        self.items, self.min_score = [], min_score
        units = []
        for item_id, text in items:
            words = words_of(text)
            if not words:
                continue
            self.items.append((item_id, words, question_and_answer(text)))
            pieces = -(-len(words) // UNIT_WORDS)
            for k in range(pieces):
                a, b = k * len(words) // pieces, (k + 1) * len(words) // pieces
                units.append((len(self.items) - 1, Counter(words[a:b]), b - a))
        self.unit_item = np.array([u[0] for u in units], np.int64)
        self.vocabulary = {w: t for t, w in enumerate(sorted({w for u in units for w in u[1]}))}
        entries = []
        for unit, (_, counts, size) in enumerate(units):
            own = {}
            for word, tf in counts.items():
                idf = np.log(1 + (n_items - df[word] + 0.5) / (df[word] + 0.5))
                own[word] = idf * tf * (K1 + 1) / (tf + K1 * (1 - B + B * size / mean_words))
            whole = sum(own.values())
            entries += [(self.vocabulary[w], unit, v / whole) for w, v in own.items()]
        entries.sort()
        terms = np.array([e[0] for e in entries], np.int64)
        self.units = np.array([e[1] for e in entries], np.int64)
        self.impacts = np.array([e[2] for e in entries], float)
        self._pivot(terms)
        self.entry = terms * (self.blocks * BLOCK_UNITS) + self.units

    def _pivot(self, terms: np.ndarray) -> None:
        """Per block, which terms can be set aside, and what they add at most."""
        self.blocks = -(-len(self.unit_item) // BLOCK_UNITS)
        self.rest = np.zeros(self.blocks)
        kept = []
        # The entries of one block stand together; each is looked at once.
        by_block = np.argsort(self.units // BLOCK_UNITS, kind="stable")
        cuts = np.searchsorted(self.units[by_block] // BLOCK_UNITS, np.arange(self.blocks + 1))
        for block in range(self.blocks):
            inside = by_block[cuts[block] : cuts[block + 1]]
            table = np.zeros((len(np.unique(terms[inside])), BLOCK_UNITS))
            names, row = np.unique(terms[inside], return_inverse=True)
            table[row, self.units[inside] % BLOCK_UNITS] = self.impacts[inside]
            order = np.argsort(table.max(axis=1), kind="stable")
            sums = np.cumsum(table[order], axis=0).max(axis=1)
            aside = int(np.searchsorted(sums, ASIDE * self.min_score, side="left"))
            self.rest[block] = sums[aside - 1] if aside else 0.0
            kept += [(int(names[k]), block, float(table[k].max())) for k in order[aside:]]
        kept.sort()
        self.key_start = np.searchsorted([k[0] for k in kept], np.arange(len(self.vocabulary) + 1))
        self.key_block = np.array([k[1] for k in kept], np.int64)
        self.key_bound = np.array([k[2] for k in kept], float)

    def candidates(self, tokens: np.ndarray, passage: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(passage, block) pairs whose bound reaches the threshold."""
        has = self.key_start[tokens + 1] > self.key_start[tokens]
        terms = len(self.vocabulary)
        distinct = np.unique(passage[has] * terms + tokens[has])
        tokens, passage = distinct % terms, distinct // terms
        at, count = _spread(self.key_start[tokens], self.key_start[tokens + 1])
        keys = np.repeat(passage, count) * self.blocks + self.key_block[at]
        unique, place = np.unique(keys, return_inverse=True)
        bound = np.bincount(place, self.key_bound[at], minlength=len(unique))
        block = unique % self.blocks
        good = bound + self.rest[block] >= self.min_score - 1e-9
        return unique[good] // self.blocks, block[good]

    def scores(self, query: np.ndarray, tokens: np.ndarray, blocks: np.ndarray) -> np.ndarray:
        """Scores of the units of ``blocks[q]`` for each query q; (query, token) pairs are distinct."""
        units = self.blocks * BLOCK_UNITS
        low = tokens * units + blocks[query] * BLOCK_UNITS
        at, count = _spread(np.searchsorted(self.entry, low), np.searchsorted(self.entry, low + BLOCK_UNITS))
        cell = np.repeat(query, count) * BLOCK_UNITS + self.units[at] % BLOCK_UNITS
        return np.bincount(cell, self.impacts[at], minlength=len(blocks) * BLOCK_UNITS).reshape(-1, BLOCK_UNITS)


def _spread(start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The members of ranges, one after another, and the ranges' sizes."""
    count = end - start
    return np.repeat(start - (np.cumsum(count) - count), count) + np.arange(count.sum()), count


def reach(size: int) -> int:
    """Words that may stand between question and answer of an item of ``size`` words."""
    return 32 + size


def _stretches(size: int) -> list[int]:
    """Numbers of words over which ``size`` words in order may be spread."""
    return sorted({size + 6, max(size + 6, 3 * size // 2), max(size + 6, 2 * size)})


def _in_order(part: list[str], region: list[str], stretch: int) -> list[tuple[int, int, int]]:
    """(start, end, words) of the most words of ``part`` in order in each ``stretch`` of ``region`` that starts with one."""
    masks: dict[str, int] = {}
    for i, word in enumerate(part):
        masks[word] = masks.get(word, 0) | 1 << i
    there = [masks.get(word, 0) for word in region]
    full, out = (1 << len(part)) - 1, []
    for start in np.flatnonzero([bool(m) for m in there]).tolist():
        left, most, end = full, 0, start  # longest common subsequence, one bit for each word
        for at in range(start, min(start + stretch, len(region))):
            if there[at]:
                same = left & there[at]
                left = ((left + same) | (left - same)) & full
                words = len(part) - left.bit_count()
                if words > most:
                    most, end = words, at + 1
        out.append((start, end, most))
    return out


def _spread_overlap(item: list[str], before: int, region: list[str], rank) -> tuple[float, float]:
    """The shares of question and answer where each aligns best by itself, the answer within reach after the question."""
    question, answer = item[:before], item[before:]
    best = (0.0, 0.0)
    answers = [a for stretch in _stretches(len(answer)) for a in _in_order(answer, region, stretch)] if answer else []
    for stretch in _stretches(len(question)):
        for _, end, words in _in_order(question, region, stretch):
            share = words / max(1, len(question))
            after = max((n for at, _, n in answers if end <= at <= end + reach(len(item))), default=0)
            best = max(best, (share, after / max(1, len(answer))), key=rank)
    return best


def overlap(
    item: list[str], before: int, region: list[str], min_question: float = MIN_QUESTION, min_answer: float = MIN_ANSWER
) -> tuple[float, float]:
    """Shares of the question's and of the answer's words found where the item aligns in ``region``.

    Either the whole item aligns at one shift, up to 3 words, or question and answer each stand in order by
    themselves, with other words in between (see ``_stretches`` and ``reach``).
    """

    def rank(found):
        return min(found[0] / max(min_question, 1e-9), found[1] / max(min_answer, 1e-9)), sum(found)

    size = min(3, len(item))
    places: dict[tuple, list[int]] = {}
    for i in range(len(region) - size + 1):
        places.setdefault(tuple(region[i : i + size]), []).append(i)
    shifts = Counter(
        at - i for i in range(len(item) - size + 1) for at in places.get(tuple(item[i : i + size]), ())
    )
    best, slack = (0.0, 0.0), 3
    for shift in sorted(shifts):
        found = []
        for a, b in ((0, before), (before, len(item))):
            there = Counter(region[max(0, shift + a - slack) : max(0, shift + b + slack)])
            part = Counter(item[a:b])
            found.append(sum((part & there).values()) / max(1, b - a))
        best = max(best, tuple(found), key=rank)
    if best[0] >= min_question and best[1] >= min_answer:
        return best
    present = Counter(region)
    for part, least in ((item[:before], min_question), (item[before:], min_answer)):
        if sum((Counter(part) & present).values()) < least * len(part):
            return best
    return max(best, _spread_overlap(item, before, region, rank), key=rank)


def _search(batches, index: BlockMaxIndex, min_question: float, min_answer: float, names: list[str]):
    get, step, terms = index.vocabulary.get, PASSAGE_WORDS // 2, max(1, len(index.vocabulary))
    for batch in batches:
        for part in byte_slices(batch, "text", SLICE_BYTES):
            texts = [words_of(t) for t in part.column("text").to_pylist()]
            tokens = np.array([get(w, -1) for ws in texts for w in ws], np.int64)
            lengths = np.array([len(ws) for ws in texts], np.int64)
            first = np.cumsum(lengths) - lengths
            passages = -(-lengths // step)
            base = np.cumsum(passages) - passages
            doc = np.repeat(np.arange(len(texts)), lengths)
            place = np.arange(len(tokens)) - first[doc]
            own = base[doc] + place // step
            known = tokens >= 0
            earlier = known & (place >= step)
            found, blocks = index.candidates(
                np.concatenate([tokens[known], tokens[earlier]]), np.concatenate([own[known], own[earlier] - 1])
            )
            # The distinct known words of every candidate passage, and the candidates' scores.
            d = np.searchsorted(base, found, side="right") - 1
            start = (found - base[d]) * step
            at, count = _spread(first[d] + start, first[d] + np.minimum(start + PASSAGE_WORDS, lengths[d]))
            query, inside = np.repeat(np.arange(len(found)), count), tokens[at]
            pairs = np.unique((query * terms + inside)[inside >= 0]) if len(at) else at
            scores = index.scores(pairs // terms, pairs % terms, blocks)
            hits: dict[tuple[int, int], tuple] = {}
            for q, unit in np.argwhere(scores >= index.min_score - 1e-9).tolist():
                row, a = int(d[q]), int(start[q])
                item = int(index.unit_item[blocks[q] * BLOCK_UNITS + unit])
                _, words, before = index.items[item]
                around = 2 * len(words) + 6 + reach(len(words))
                region = texts[row][max(0, a - around) : a + PASSAGE_WORDS + around]
                question, answer = overlap(words, before, region, min_question, min_answer)
                if question >= min_question and answer >= min_answer:
                    hit = (float(scores[q, unit]), question, answer, a)
                    if (row, item) not in hits or hit > hits[row, item]:
                        hits[row, item] = hit
            if hits:
                order = sorted(hits)
                yield pa.record_batch(
                    [
                        part.column("id").take(pa.array([d for d, _ in order])),
                        pa.array([index.items[i][0] for _, i in order]),
                        *[pa.array([hits[k][f] for k in order], pa.float64()) for f in range(3)],
                        pa.array([hits[k][3] for k in order], pa.int64()),
                    ],
                    names=names,
                )


def _item_words(batches):
    for batch in batches:
        words = [sorted(set(words_of(t))) for t in batch.column("text").to_pylist()]
        sizes = [len(words_of(t)) for t in batch.column("text").to_pylist()]
        yield pa.record_batch(
            [batch.column("item"), pa.array(words, pa.list_(pa.string())), pa.array(sizes, pa.int64())],
            names=["item", "words", "size"],
        )


def contaminated(
    df: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    min_score: float = MIN_SCORE,
    min_question: float = MIN_QUESTION,
    min_answer: float = MIN_ANSWER,
    index_bytes: int = INDEX_BYTES,
) -> DataFrame:
    """One row per document and benchmark item found in it: doc_id, item_id, score, question, answer, passage.

    Words are runs of letters and digits, lower-cased.  A document's passages are windows of
    ``PASSAGE_WORDS`` words at every half window, over its whole text.  An item is retrieved if one of its units
    scores ``min_score`` of its own score against itself, and reported if ``min_question`` and
    ``min_answer`` of the words of its question and answer stand where it aligns.  Question and
    answer may also stand apart, the answer up to 32 words and the item's length behind the question,
    and each of them in order with other words in between, over twice its length (and 6 words
    more than its length at least).  Score and passage (first word's number) are of its best passage.  The answer is the item's
    last sentence.  Null and empty texts and items match nothing.  Repeated rows are
    reported each; items with one text are reported each.  Other columns are ignored; an empty
    table of documents or items gives an empty result.

    The items are the query set: their index, of at most about ``index_bytes`` of text,
    goes to every task, and larger benchmarks take one pass for each such part.
    """
    items = benchmark.select(F.col(item_col).alias("item"), F.col("text").alias("text")).filter("text is not null")
    item_type, id_type = benchmark.schema[item_col].dataType, df.schema[id_col].dataType
    schema = T.StructType(
        [
            T.StructField("doc_id", id_type),
            T.StructField("item_id", item_type),
            *[T.StructField(c, T.DoubleType()) for c in ("score", "question", "answer")],
            T.StructField("passage", T.LongType()),
        ]
    )
    listed = items.mapInArrow(
        _item_words,
        T.StructType(
            [
                T.StructField("item", item_type),
                T.StructField("words", T.ArrayType(T.StringType())),
                T.StructField("size", T.LongType()),
            ]
        ),
    )
    about = listed.agg(F.count(F.lit(1)), F.avg(F.least("size", F.lit(UNIT_WORDS)))).first()
    n_items, mean_words = about[0], about[1] or 1.0
    frequency = listed.select(F.explode("words").alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(1, -(-size // index_bytes))
    of_part = F.pmod(F.xxhash64("text"), F.lit(parts))
    texts = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).filter("text is not null")
    found = None
    for k in range(parts):
        mine = items.filter(of_part == k)
        rows = sorted(((r.item, r.text) for r in mine.collect()), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
        used = mine.mapInArrow(_item_words, listed.schema).select(F.explode("words").alias("word")).distinct()
        counts = {r.word: r.n for r in frequency.join(used, "word").collect()}
        index = BlockMaxIndex(rows, counts, n_items, float(mean_words), min_score)
        hits = texts.mapInArrow(
            lambda batches, index=index: _search(batches, index, min_question, min_answer, schema.names), schema
        )
        found = hits if found is None else found.unionByName(hits)
    return found


def drop_contaminated(df: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """The documents of ``df`` in which :func:`contaminated` finds no item; rows with a null id stay."""
    found = contaminated(df, benchmark, id_col=id_col, **options).select(F.col("doc_id").alias("hit")).distinct()
    _, inner, back = set_aside(df, ())
    own = inner[df.columns.index(id_col)]
    return df.select(*inner, own.alias("own")).join(found, F.col("own") == F.col("hit"), "left_anti").select(*back)
