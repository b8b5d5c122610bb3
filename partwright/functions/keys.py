"""Partition keys in Hive directory names (P7, F19, K6 path building).

Spark escapes partition values when it builds directory names; the same
rule is needed to build a single partition's path by hand (K6) and its
inverse to read keys back out of a file listing (P7).
"""

from __future__ import annotations

import datetime as _dt
import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters Spark percent-escapes in a partition directory
# name (besides the control characters U+0001..U+001F and U+007F), matching
# the Hive path-name rule.  Space and '+' are *not* escaped.
ESCAPED_CHARS = '"#%\'*/:=?\\{[]^'

HIVE_DEFAULT_PARTITION = "__HIVE_DEFAULT_PARTITION__"


def _needs_escape(ch: str) -> bool:
    code = ord(ch)
    return ch in ESCAPED_CHARS or 0x01 <= code <= 0x1F or code == 0x7F


def escape_value(value) -> str:
    """Directory-name form of one partition value (as Spark writes it)."""
    if value is None:
        return HIVE_DEFAULT_PARTITION
    if isinstance(value, (_dt.date, _dt.datetime)):
        value = value.isoformat()
    text = str(value)
    if text == "":
        return HIVE_DEFAULT_PARTITION
    return "".join(f"%{ord(c):02X}" if _needs_escape(c) else c for c in text)


def partition_subpath(keys, values) -> str:
    """``k1=v1/k2=v2/...`` with escaped values."""
    return "/".join(f"{k}={escape_value(v)}" for k, v in zip(keys, values))


def layout_pattern(keys, suffix: str = ".parquet") -> str:
    """Regex with one capture group per key: ``k1=([^/]+)/k2=([^/]+)/.*\\.parquet$``.

    Not anchored at the start (a search), so any root prefix is accepted;
    files may sit in deeper folders below the last key level.
    """
    levels = "/".join(f"{re.escape(k)}=([^/]+)" for k in keys)
    return levels + "/.*" + re.escape(suffix) + "$"


def unescape(raw: Column) -> Column:
    """Inverse of :func:`escape_value` on a Column.

    ``url_decode`` alone would turn a literal '+' into a space, and Spark does
    not escape '+', so protect it first.  Malformed escapes give NULL.
    """
    return F.try_url_decode(F.replace(raw, F.lit("+"), F.lit("%2B")))


def extract_keys(path: Column, keys, suffix: str = ".parquet") -> list[Column]:
    """One raw (still escaped) Column per key; '' when the path is off-pattern."""
    pattern = layout_pattern(keys, suffix)
    return [F.regexp_extract(path, pattern, i + 1) for i in range(len(keys))]
