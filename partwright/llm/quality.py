"""Quality classifier: a sparse ensemble of rules over text statistics.

Small boosted trees are grown on a bounded sample of labelled rows.  Every path
from a root to a node is a rule, a conjunction of thresholds; a logistic
regression with a lasso penalty keeps few of them.  Statistics, rules and score
are Spark column expressions, so scoring runs inside the scan's stage.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from partwright.llm.common import WORD_PATTERN, quoted, set_aside

SAMPLE_ROWS = 6000
STATISTICS = (
    "words", "mean_word", "upper_share", "symbol_share", "digit_share",
    "distinct_words", "distinct_lines", "words_a_line", "stops_a_word", "letterless_words",
    "variety",
)
_PREFIX = "__q_"


@dataclass(frozen=True)
class Rule:
    """A conjunction of ``statistic <= cut`` (below) or ``statistic > cut`` (above)."""

    conditions: tuple[tuple[str, str, float], ...]
    weight: float = 0.0

    def holds(self, stats: np.ndarray) -> np.ndarray:
        out = np.ones(len(stats), bool)
        for name, side, cut in self.conditions:
            value = stats[:, STATISTICS.index(name)]
            out &= value <= cut if side == "below" else value > cut
        return out

    def column(self) -> Column:
        out = None
        for name, side, cut in self.conditions:
            value = F.col(_PREFIX + name)
            one = value <= F.lit(float(cut)) if side == "below" else value > F.lit(float(cut))
            out = one if out is None else out & one
        return out


@dataclass(frozen=True)
class RuleModel:
    intercept: float
    rules: tuple[Rule, ...]

    def score(self, stats: np.ndarray) -> np.ndarray:
        margin = np.full(len(stats), self.intercept)
        for rule in self.rules:
            margin = margin + rule.weight * rule.holds(stats)
        return 1 / (1 + np.exp(-margin))

    def column(self) -> Column:
        margin = F.lit(float(self.intercept))
        for rule in self.rules:
            margin = margin + F.when(rule.column(), F.lit(float(rule.weight))).otherwise(F.lit(0.0))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-margin))


def with_statistics(df: DataFrame, text_col: str = "text") -> DataFrame:
    """``df`` and the statistics of its whole texts; all of an empty text are 0."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    raw = df.withColumns(
        {
            "__w": F.regexp_extract_all(text, F.lit(WORD_PATTERN), F.lit(0)),
            "__l": F.split(text, "\n"),
            "__n": F.length(text).cast("double"),
            "__upper": F.regexp_count(text, F.lit(r"\p{Lu}")),
            "__symbol": F.regexp_count(text, F.lit(r"[^\p{L}\p{N}\s]")),
            "__digit": F.regexp_count(text, F.lit("[0-9]")),
            "__stop": F.regexp_count(text, F.lit("[.!?]")),
            "__bare": F.regexp_count(text, F.lit(r"(?<![^\x20\x09-\x0D])[^\p{L}\p{N}\x20\x09-\x0D]+(?![^\x20\x09-\x0D])")),
        }
    )
    sizes = raw.withColumns(
        {
            "__nw": F.size("__w").cast("double"),
            "__dw": F.size(F.array_distinct("__w")),
            "__nl": F.size("__l").cast("double"),
            "__dl": F.size(F.array_distinct("__l")),
        }
    ).drop("__w", "__l")

    def share(part: str, whole: str) -> Column:
        return F.when(F.col(whole) > 0, F.col(part) / F.col(whole)).otherwise(F.lit(0.0))

    stats = {
        "words": F.col("__nw"),
        "mean_word": share("__n", "__nw"),
        "upper_share": share("__upper", "__n"),
        "symbol_share": share("__symbol", "__n"),
        "digit_share": share("__digit", "__n"),
        "distinct_words": share("__dw", "__nw"),
        "distinct_lines": share("__dl", "__nl"),
        "words_a_line": share("__nw", "__nl"),
        "stops_a_word": share("__stop", "__nw"),
        "letterless_words": share("__bare", "__nw"),
        "variety": F.when(F.col("__nw") > 0, F.col("__dw") / F.sqrt("__nw")).otherwise(F.lit(0.0)),
    }
    made = ("__n", "__upper", "__symbol", "__digit", "__stop", "__bare", "__nw", "__dw", "__nl", "__dl")
    return sizes.withColumns({_PREFIX + k: v for k, v in stats.items()}).drop(*made)


def _grow(x: np.ndarray, target: np.ndarray, depth: int, least: int, cuts: list[np.ndarray], path=()):
    """(path, leaf mask, mean) of the nodes of a regression tree below the root."""
    best = None
    if depth and len(target) >= 2 * least:
        total, n = target.sum(), len(target)
        for j, at in enumerate(cuts):
            if not len(at):
                continue
            bins = np.searchsorted(at, x[:, j], side="left")
            count = np.cumsum(np.bincount(bins, minlength=len(at) + 1))[:-1]
            below = np.cumsum(np.bincount(bins, target, minlength=len(at) + 1))[:-1]
            ok = (count >= least) & (n - count >= least)
            if not ok.any():
                continue
            gain = np.where(ok, below**2 / np.maximum(count, 1) + (total - below) ** 2 / np.maximum(n - count, 1), -1)
            k = int(np.argmax(gain))
            if gain[k] > total**2 / n + 1e-9 and (best is None or gain[k] > best[0]):
                best = (gain[k], j, float(at[k]))
    if best is None:
        return [(path, float(target.mean()), True)]
    _, j, cut = best
    nodes = [] if not path else [(path, float(target.mean()), False)]
    for side, mask in (("below", x[:, j] <= cut), ("above", x[:, j] > cut)):
        nodes += _grow(x[mask], target[mask], depth - 1, least, cuts, (*path, (STATISTICS[j], side, cut)))
    return nodes


def fit_rules(
    stats: np.ndarray, labels: np.ndarray, trees: int = 24, depth: int = 3, penalty: float = 0.002, steps: int = 600
) -> RuleModel:
    """Rules of boosted trees with lasso logistic weights; the same rows give the same model.

    Without rows of both classes the score is the smoothed share of label 1.
    """
    n, ones = len(labels), float(np.sum(labels))
    if ones in (0.0, float(n)):
        return RuleModel(float(np.log((ones + 1) / (n - ones + 1))), ())
    cuts = [np.unique(np.quantile(stats[:, j], np.linspace(0.01, 0.99, 99))) for j in range(stats.shape[1])]
    least, margin = max(5, n // 400), np.full(n, np.log(ones / (n - ones)))
    found: dict[tuple, None] = {}
    for _ in range(trees):
        rest = labels - 1 / (1 + np.exp(-margin))
        for path, mean, leaf in _grow(stats, rest, depth, least, cuts):
            if path:
                found[path] = None
            if leaf:
                margin = margin + np.clip(4 * mean, -2, 2) * Rule(path).holds(stats)
    rules = [Rule(p) for p in found]
    x = np.column_stack([r.holds(stats) for r in rules]).astype(float) if rules else np.zeros((n, 0))
    # Proximal gradient with momentum on the mean logistic loss; the intercept is free.
    full = np.column_stack([np.ones(n), x])
    step = 4.0 * n / np.linalg.norm(full, 2) ** 2
    w = np.zeros(full.shape[1])
    w[0] = np.log(ones / (n - ones))
    ahead, t = w.copy(), 1.0
    for _ in range(steps):
        slope = full.T @ (1 / (1 + np.exp(-full @ ahead)) - labels) / n
        new = ahead - step * slope
        new[1:] = np.sign(new[1:]) * np.maximum(np.abs(new[1:]) - step * penalty, 0)
        t_new = (1 + np.sqrt(1 + 4 * t * t)) / 2
        ahead, w, t = new + (t - 1) / t_new * (new - w), new, t_new
    return RuleModel(
        float(w[0]), tuple(Rule(r.conditions, float(v)) for r, v in zip(rules, w[1:], strict=True) if abs(v) > 1e-4)
    )


def held_out(id_col: Column) -> Column:
    """Rows whose label is never learnt from."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def fit_quality(
    df: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    sample_rows: int = SAMPLE_ROWS,
) -> RuleModel:
    """Model of a sample of ``sample_rows`` labelled rows at most, the first by a hash of their ids.

    The sample is what reaches the driver: its statistics and label for each row.  Rows
    that :func:`held_out` marks and rows with a null id or label are not used.
    """
    chosen = (
        labels.select(F.col(id_col).alias("__id"), F.col(label_col).cast("int").alias("__label"))
        .filter(F.col("__id").isNotNull() & F.col("__label").isin(0, 1) & ~held_out(F.col("__id")))
        .orderBy(F.xxhash64("__id"), "__id", "__label")
        .limit(sample_rows)
    )
    texts = df.select(F.col(id_col).alias("__id"), F.col(text_col).alias("text"))
    rows = with_statistics(texts.join(F.broadcast(chosen), "__id")).select(
        "__id", "__label", *[_PREFIX + s for s in STATISTICS]
    )
    table = rows.toPandas().sort_values(list(rows.columns), kind="stable")
    stats = table[[_PREFIX + s for s in STATISTICS]].to_numpy(float)
    return fit_rules(stats, table["__label"].to_numpy(float))


def score_quality(
    df: DataFrame, model: RuleModel, id_col: str = "doc_id", text_col: str = "text", keep_at: float = 0.3
) -> DataFrame:
    """``df`` with held_out, score (0 to 1, higher: label 1 likelier) and predicted.

    Null and empty texts have all statistics 0 and are scored like any other text.
    Only the text enters the score.  Columns named like the new ones are replaced, others
    pass through; an empty table gives an empty result; repeated rows score alike.
    """
    _, inner, back = set_aside(df, ("held_out", "score", "predicted"))
    slim = df.select(*inner, quoted(text_col).alias("text"), held_out(quoted(id_col)).alias("held_out"))
    passed = [f"in_{k}" for k in range(len(inner))]
    scored = with_statistics(slim).select(*passed, "held_out", model.column().alias("score"))
    return scored.select(*back, "held_out", "score", (F.col("score") >= keep_at).cast("int").alias("predicted"))


def keep_quality(
    df: DataFrame, model: RuleModel, id_col: str = "doc_id", text_col: str = "text", keep_at: float = 0.3
) -> DataFrame:
    """The rows of ``df`` that :func:`score_quality` predicts to be of label 1, with the columns it passes through.

    A plain filter would be moved below the statistics, with all of them repeated for every rule
    that names them; a generator of one or no row stays where it is.
    """
    _, inner, back = set_aside(df, ())
    own = {c: F.col(f"in_{k}") for k, c in enumerate(df.columns)}
    slim = df.select(*inner).withColumns({"id": own[id_col], "text": own[text_col]})
    scored = score_quality(slim, model, "id", "text", keep_at)
    once = F.when(F.col("predicted") == 1, F.array(F.lit(1)))
    return scored.select("*", F.explode(once).alias("once")).select(*back)
