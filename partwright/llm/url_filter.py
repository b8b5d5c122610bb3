"""URL filter: host and path rules, and a linear model for the urls they leave open.

The model is a logistic regression on hashed character n-grams of host and path,
trained in a second from a small labelled table of urls; it is one weight vector
of fixed size, which goes to the tasks with the function that uses it.
"""

from __future__ import annotations

import zlib
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from partwright.llm.common import ascii_lower, quoted, set_aside

BUCKETS = 1 << 14
GRAMS = (3, 4, 5)
# Share of urls that are to be blocked, before their text is known.
PRIOR = 0.2

# (verdict, host, path prefix)
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)

# The labelled table is spelled out of words chosen for this module: a host of either class is one or two words of the
# class under a domain that both classes share, and is paired with paths of its class.  None is taken from data.
DOMAINS = ("example.com", "example.org", "example.net", "com", "org", "net")
PREFIXES = ("", "www.", "m.", "blog.", "", "en.", "")
BLOCKED_WORDS = (
    "casino poker slots bet bets betting jackpot lottery pills viagra meds pharma loan loans payday credit porn xxx sex adult"
    " cams dating escort ads adserver adtrack banner popunder click tracker spam offers warez crack keygen torrent replica prize winner"
).split()
BLOCKED_PARTNERS = "free best cheap online win bonus hot quick club hub x track farm now cash".split()
ALLOWED_WORDS = (
    "garden library history recipes travel science school museum weather music books maps photos journal forum news wiki docs"
    " health city sports art code radio theatre kitchen bakery railway village harbour orchard physics poetry letters gazette"
    " lumora kestavi bruneto alderic mirandel osvaltin quenby farrow tindale werwick shanleth hathern erithon innster anderith"
).split()
ALLOWED_PARTNERS = "old north river open daily little my our national green local modern hill stone west".split()


def _hosts(words: Sequence[str], partners: Sequence[str]) -> list[str]:
    """Hosts of one class: each word alone and with two partners, before and behind it."""
    hosts = []
    for i, word in enumerate(words):
        first, second = partners[i % len(partners)], partners[(3 * i + 7) % len(partners)]
        for k, name in enumerate((word, f"{word}-{first}", f"{second}{word}", f"{second}-{word}")):
            hosts.append(f"{PREFIXES[(i + 2 * k) % len(PREFIXES)]}{name}.{DOMAINS[(i + k) % len(DOMAINS)]}")
    return hosts


BLOCKED_PATHS = (
    "/buy-cheap-pills", "/casino/bonus", "/click?id=1", "/track/pixel.gif", "/ads/banner", "/xxx/free", "/win/prize",
    "/viagra/order", "/loan/apply-now", "/download/crack", "/en/101", "/de/57.html", "/fr/9/", "/es/733",
)
ALLOWED_PATHS = (
    "/", "/about", "/en/101", "/de/57.html", "/fr/9/", "/es/733", "/article/2021/05/title", "/wiki/History",
    "/docs/guide.html", "/news/local", "/blog/post-12", "/research/paper", "/contact", "/index.html",
)


def labelled_urls() -> list[tuple[str, str, int]]:
    """(host, path, 1 to block): the small table the default model is trained from."""
    rows = []
    blocked, allowed = _hosts(BLOCKED_WORDS, BLOCKED_PARTNERS), _hosts(ALLOWED_WORDS, ALLOWED_PARTNERS)
    for hosts, paths, label in ((blocked, BLOCKED_PATHS, 1), (allowed, ALLOWED_PATHS, 0)):
        rows += [(h, paths[(i * 5 + 3 * k) % len(paths)], label) for i, h in enumerate(hosts) for k in range(2)]
    return rows


def features(host: str, path: str) -> np.ndarray:
    """Buckets of the distinct n-grams of host and path; the field is part of the n-gram."""
    found = {0}
    for field, text in (("h", f"^{host}$"), ("p", f"^{path}$")):
        for n in GRAMS:
            found |= {
                1 + zlib.crc32((field + text[i : i + n]).encode("utf-8", "surrogatepass")) % (BUCKETS - 1)
                for i in range(len(text) - n + 1)
            }
    return np.fromiter(found, np.int64, len(found))


def train(rows: Sequence[tuple[str, str, int]], steps: int = 2000, rate: float = 0.5, decay: float = 1e-4) -> np.ndarray:
    """Weights by full-batch gradient steps; the same rows give the same weights.

    The classes count as PRIOR says, whatever the number of their rows: a url that resembles no labelled one is allowed.
    """
    feats = [features(h, p) for h, p, _ in rows]
    label = np.array([y for _, _, y in rows], float)
    row = np.repeat(np.arange(len(rows)), [len(f) for f in feats])
    bucket = np.concatenate(feats)
    scale = 1.0 / np.sqrt(np.bincount(row, minlength=len(rows)))
    weights = np.zeros(BUCKETS)
    share = np.where(label == 1, PRIOR / label.sum(), (1 - PRIOR) / (len(label) - label.sum()))
    for _ in range(steps):
        margin = np.bincount(row, weights[bucket], minlength=len(rows)) * scale
        error = (1 / (1 + np.exp(-margin)) - label) * share * scale
        weights -= rate * (np.bincount(bucket, error[row], minlength=BUCKETS) * 10 + decay * weights)
    return weights


def score(weights: np.ndarray, host: str, path: str) -> float:
    """Probability that the url is to be blocked."""
    at = features(host, path)
    return float(1 / (1 + np.exp(-weights[at].sum() / np.sqrt(len(at)))))


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty for a null url or one without ``://``."""
    rest = F.coalesce(F.when(F.instr(url, "://") > 0, F.substring_index(url, "://", 1)), F.lit(""))
    after = F.when(F.instr(url, "://") > 0, F.substring(url, F.length(rest) + 4, F.length(url)))
    after = F.coalesce(after, F.lit(""))
    host = F.regexp_extract(after, r"^([^/?#]*)", 1)
    return ascii_lower(host), F.regexp_extract(after, r"^[^/?#]*([^?#]*)", 1)


def url_filter(
    df: DataFrame,
    rules: Sequence[tuple[str, str, str]] = RULES,
    weights: np.ndarray | None = None,
    url_col: str = "url",
    block_at: float = 0.5,
) -> DataFrame:
    """``df`` with host, path, rule, verdict and score.

    A rule fits its host and all subdomains of it if the url's path starts with the
    rule's; the longest rule wins and its verdict holds.  Urls that no rule fits are
    judged by the model.  Null urls and urls without ``://`` have an empty host and
    path and go to the model.  Urls that a rule settles are not judged: their score is null.
    Columns named like the new ones are replaced, others pass through; an empty
    table gives an empty result, and repeated rows are judged alike.
    """
    if weights is None:
        weights = train(labelled_urls())
    _, inner, back = set_aside(df, ("host", "path", "rule", "verdict", "score"))
    host, path = host_and_path(quoted(url_col))
    parsed = df.select(*inner, host.alias("host"), path.alias("path"))
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, rule_host, rule_path in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((F.col("host") == rule_host) | F.endswith("host", F.lit("." + rule_host))) & F.startswith(
            "path", F.lit(rule_path)
        )
        rule = F.when(fits, F.lit(rule_host + rule_path)).otherwise(rule)
        verdict = F.when(fits, F.lit(kind)).otherwise(verdict)

    @F.pandas_udf("double")
    def judged(hosts: pd.Series, paths: pd.Series) -> pd.Series:
        """Scores of a batch; each distinct url is scored once, a null host not at all."""
        known = {(h, p): score(weights, h, p) for h, p in set(zip(hosts, paths, strict=True)) if h is not None}
        return pd.Series([known.get(x) for x in zip(hosts, paths, strict=True)], dtype="float64")

    ruled = parsed.withColumns({"rule": rule, "verdict": verdict})
    open_host = F.when(F.col("verdict").isNull(), F.col("host"))
    model = F.when(F.col("score") >= block_at, F.lit("block")).otherwise(F.lit("allow"))
    return ruled.withColumn("score", judged(open_host, F.col("path"))).select(
        *back, "host", "path", "rule", F.coalesce("verdict", model).alias("verdict"), "score"
    )
