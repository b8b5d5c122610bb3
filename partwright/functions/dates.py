"""F12–F17 — dates, timestamps and elapsed time."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def date_literal(value) -> Column:
    """``DATE('YYYY-MM-DD')``: a DATE literal; a malformed text raises whatever the session's settings."""
    if isinstance(value, Column):
        return value.cast("date")
    return F.lit(parse_date(value))


def midnight(date_col: Column) -> Column:
    """``TIMESTAMP(date)``: the instant of UTC midnight of the date.

    Built from epoch seconds, so it does not depend on the session zone.
    """
    return F.timestamp_seconds(F.unix_date(date_col).cast("long") * F.lit(86400))


def add_seconds(ts: Column, seconds: Column) -> Column:
    """``TIMESTAMP_ADD(ts, INTERVAL n SECOND)``."""
    return F.timestamp_add("SECOND", seconds, ts)


def parse_date(value) -> _dt.date:
    if isinstance(value, _dt.datetime):
        return value.date()
    if isinstance(value, _dt.date):
        return value
    return _dt.date.fromisoformat(str(value))
