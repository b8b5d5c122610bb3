"""Quality rules: a table of thresholds compiled into one projection, without user functions.

A rule bounds the ratio of two counts of the text (characters a word, symbols a word,
stop words a word, repeated lines a line).  Counts and bounds are whole numbers and
ratios are compared crosswise, so no verdict hangs on rounding.  Everything is a
Column expression: Spark reads each text once, no row leaves its task, nothing is shuffled.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from partwright.llm.common import WORD_PATTERN, without

# Fixed by the contract.
SYMBOLS = "[#*$%&|<>]"
WINDOW = 3
MIN_WORDS = 50
MAX_REPEATED_PERCENT = 50

# The commonest function words of the four languages of the corpus, as they stand between spaces.
STOP_WORDS = (
    "the of and to a in is that it for was on with as be by are this at from or an have not you he which but had they "
    "de la le et les des en un du une que est pour dans qui par sur au il pas plus ne se ce avec son sa "
    "der die und den von zu das mit sich auf für ist im nicht ein eine als auch es dem an er hat aus bei "
    "el los del las por con no su para al lo como más pero sus y o"
).split()


@dataclass(frozen=True)
class Threshold:
    """``part`` per thousand of ``whole`` must lie between ``least`` and ``most``; no bound where None.

    A whole of 0 breaks no rule.
    """

    name: str
    part: str
    whole: str
    least: int | None = None
    most: int | None = None

    def broken(self, counts: dict[str, Column]) -> Column:
        part, whole = counts[self.part] * 1000, counts[self.whole]
        low = part < whole * self.least if self.least is not None else F.lit(False)
        high = part > whole * self.most if self.most is not None else F.lit(False)
        return (whole > 0) & (low | high)


# Bounds of ordinary prose, wide enough for compounds of any of the languages.
THRESHOLDS = (
    Threshold("mean_word_length", "word_chars", "n_words", least=2000, most=14000),
    Threshold("symbols", "n_symbols", "n_words", most=100),
    Threshold("stop_words", "n_stop_words", "n_words", least=60),
    Threshold("duplicate_lines", "n_dup_lines", "n_lines", most=400),
    Threshold("exclamations", "n_shouts", "n_words", most=100),
)

# Columns that thresholds may name.
COUNTS = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_stop_words", "n_shouts")


def bound_once(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once a row, also where lambdas inside ``body`` use it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def repeated_window_words(words: Column, width: int = WINDOW) -> Column:
    """Number of words covered by a window of ``width`` words that stands in ``words`` twice or more.

    Windows are hashed; where all hashes differ the count is 0.  Else those whose hash
    stands twice are sorted by their words, which puts equal ones side by side, and
    compared in full.  Sorted starts then cover ``width`` words each, or as many as
    there are up to the next start.
    """
    fields = [f"w{k}" for k in range(width)]

    def hashes(ws: Column) -> Column:
        return F.transform(
            F.sequence(F.lit(0), F.size(ws) - width), lambda i: F.xxhash64(*[F.get(ws, i + k) for k in range(width)])
        )

    def beside(array: Column, names: list[str]) -> Column:
        """The elements of a sorted array that equal a neighbour in the fields ``names``."""

        def same(a: Column, b: Column) -> Column:
            equal = a[names[0]] == b[names[0]]
            for f in names[1:]:
                equal = equal & (a[f] == b[f])
            return F.coalesce(equal, F.lit(False))

        return bound_once(
            array, lambda xs: F.filter(xs, lambda x, k: same(x, F.get(xs, k - 1)) | same(x, F.get(xs, k + 1)))
        )

    def starts(ws: Column, hashed: Column) -> Column:
        pairs = F.transform(hashed, lambda h, i: F.struct(h.alias("hash"), i.alias("start")))
        maybe = beside(F.sort_array(pairs), ["hash"])
        full = F.transform(
            maybe, lambda x: F.struct(*[F.get(ws, x["start"] + k).alias(f) for k, f in enumerate(fields)], x["start"].alias("start"))
        )
        return F.sort_array(F.transform(beside(F.sort_array(full), fields), lambda x: x["start"]))

    def covered(at: Column) -> Column:
        each = F.transform(at, lambda x, k: F.least(F.lit(width), F.coalesce(F.get(at, k + 1) - x, F.lit(width))))
        return F.aggregate(each, F.lit(0).cast("long"), lambda total, x: total + x)

    none = F.lit(0).cast("long")

    def count(ws: Column) -> Column:
        def of_hashes(hashed: Column) -> Column:
            twice = F.size(F.array_distinct(hashed)) < F.size(hashed)
            return F.when(twice, bound_once(starts(ws, hashed), covered)).otherwise(none)

        return F.when(F.size(ws) > width, bound_once(hashes(ws), of_hashes)).otherwise(none)

    return bound_once(words, count)


def text_counts(text: Column) -> dict[str, Column]:
    """The counts of :data:`COUNTS` but ``n_words`` and those that derive from the words of ``text``."""
    has_word = WORD_PATTERN.removesuffix("+")

    def repeats(lines: Column) -> Column:
        return F.struct(
            F.size(lines).cast("long").alias("n_lines"),
            (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
        )

    return {
        "n_symbols": F.regexp_count(text, F.lit(SYMBOLS)).cast("long"),
        "n_shouts": F.regexp_count(text, F.lit("!+")).cast("long"),
        "__lines": bound_once(F.filter(F.split(text, "\n"), lambda line: line.rlike(has_word)), repeats),
    }


def word_counts(words: Column) -> dict[str, Column]:
    spellings = [w for stop in STOP_WORDS for w in (stop, stop.capitalize())]

    return {
        "n_words": F.size(words).cast("long"),
        "word_chars": F.aggregate(words, F.lit(0).cast("long"), lambda total, w: total + F.length(w)),
        "n_stop_words": F.size(F.filter(words, lambda w: w.isin(*spellings))).cast("long"),
        "n_repeat_words": repeated_window_words(words),
    }


def quality_rules(df: DataFrame, thresholds: Sequence[Threshold] = THRESHOLDS, text_col: str = "text") -> DataFrame:
    """``df`` with the counts of :data:`COUNTS`, base_failed, failed (names of broken rules) and kept.

    ``base_failed``: fewer than 50 words, or more than half of them in repeated three-word
    windows.  ``kept``: not base_failed and no threshold broken.  A null or empty text has
    all counts 0 and fails the base.  Every row is judged by itself, so ties and repeated
    rows are judged alike; whole texts are read, whatever their length (the words of one
    text are held in its task).  Input columns named like the new ones are replaced, all
    others pass through; an empty table gives an empty result.
    """
    unknown = {t.part for t in thresholds} | {t.whole for t in thresholds}
    if unknown - set(COUNTS):
        raise ValueError(f"thresholds name unknown counts: {sorted(unknown - set(COUNTS))}")
    kept = without(df, (*COUNTS, "base_failed", "failed", "kept"))
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))

    def words_struct(words: Column) -> Column:
        return F.struct(*[c.alias(n) for n, c in word_counts(words).items()])

    flat = text_counts(text)
    of_words = bound_once(F.regexp_extract_all(text, F.lit(WORD_PATTERN), F.lit(0)), words_struct)
    # One struct holds all counts, so that no input column can clash with a name made here.
    counted = df.select(
        F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row") if kept else F.struct(F.lit(0).alias("none")).alias("row"),
        F.struct(
            of_words.alias("words"), flat["__lines"].alias("lines"), flat["n_symbols"].alias("n_symbols"), flat["n_shouts"].alias("n_shouts")
        ).alias("made"),
    )
    counts = {n: F.col(f"made.words.{n}") for n in ("n_words", "word_chars", "n_stop_words", "n_repeat_words")}
    counts |= {n: F.col(f"made.lines.{n}") for n in ("n_lines", "n_dup_lines")}
    counts |= {n: F.col(f"made.{n}") for n in ("n_symbols", "n_shouts")}
    base = (counts["n_words"] < MIN_WORDS) | (counts["n_repeat_words"] * 100 > counts["n_words"] * MAX_REPEATED_PERCENT)
    verdicts = [F.when(t.broken(counts), F.lit(t.name)) for t in thresholds]
    failed = F.array_compact(F.array(*verdicts)) if verdicts else F.array().cast("array<string>")
    return counted.select(
        *[F.col(f"row.`{c}`").alias(c) for c in kept],
        *[counts[n].alias(n) for n in COUNTS],
        base.alias("base_failed"),
        failed.alias("failed"),
        (~base & (F.size(failed) == 0)).alias("kept"),
    )
