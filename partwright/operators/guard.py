"""A8 — constraints that hold while rows are read, inside the job that writes them.

A check before the write reads the source once more.  Here a row that breaks a
constraint fails the task that reads it, and so the job; with files that become
visible at the end only (:mod:`.commit`, or Spark's own commit of an insert)
nothing is seen of a job that failed.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MARK = "broken constraint: "


def null_or_empty(df: DataFrame, column: str) -> Column:
    """Whether a key is NULL or an empty text, which Spark writes to the same directory as NULL."""
    out = F.col(column).isNull()
    if isinstance(df.schema[column].dataType, T.StringType):
        out = out | (F.col(column) == F.lit(""))
    return out


def guarded(df: DataFrame, checks: Sequence[tuple[Column, str]]) -> DataFrame:
    """``df``; a job that reads a row for which one of the conditions is true fails with its text."""
    broken = None
    for condition, text in checks:
        error = F.raise_error(F.lit(MARK + text))
        bad = F.coalesce(condition, F.lit(False))
        broken = F.when(bad, error) if broken is None else broken.when(bad, error)
    return df if broken is None else df.filter(broken.otherwise(F.lit(True)))


@contextmanager
def violations_raise() -> Iterator[None]:
    """Turn the failure of a guarded job into a ``ValueError`` with the constraint's text."""
    try:
        yield
    except Exception as exc:
        found = re.search(re.escape(MARK) + r"(.*?)(?: SQLSTATE|\n|$)", str(exc))
        if not found:
            raise
        raise ValueError(found[1]) from None
