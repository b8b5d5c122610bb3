"""Helpers shared by the training-data operators."""

from __future__ import annotations

import string

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from partwright.session import scratch_path

# Fixed by the contracts: ASCII white space and the words between it.
SPACE = " \t\n\x0b\x0c\r"
WORD_PATTERN = r"[^\x20\x09-\x0D]+"

_LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only; pure ASCII strings take the fast ``lower`` path."""
    plain = F.length(text) == F.octet_length(text)
    return F.when(plain, F.lower(text)).otherwise(
        F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    )


def lower_az(text: str) -> str:
    """Python twin of :func:`ascii_lower`."""
    return text.lower() if text.isascii() else text.translate(_LOWER)


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written below the shared scratch folder and read again.

    Cuts the lineage with files that outlive any executor.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    schema = df.schema
    df.write.parquet(path)
    return spark.read.schema(schema).parquet(path)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def without(df: DataFrame, names) -> list[str]:
    """The columns of ``df`` that do not clash with ``names`` (any letter case)."""
    taken = {n.lower() for n in names}
    return [c for c in df.columns if c.lower() not in taken]


def quoted(name: str) -> Column:
    """The column of that very name, whatever characters it has."""
    return F.col("`" + name.replace("`", "``") + "`")


def set_aside(df: DataFrame, replaced) -> tuple[list[str], list[Column], list[Column]]:
    """Columns of ``df`` that an operator passes through, under numbered names, and the way back.

    Returns their names, the columns to select first (``in_0`` ...) and those to select last.  An
    operator whose own names don't begin with ``in_`` clashes with no column of its input.
    """
    kept = without(df, replaced)
    return (
        kept,
        [quoted(c).alias(f"in_{k}") for k, c in enumerate(kept)],
        [F.col(f"in_{k}").alias(c) for k, c in enumerate(kept)],
    )


def utf8_parts(values: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string or binary array as one uint8 array, and its n + 1 offsets.

    Nulls count as empty.  The arrays are views of the Arrow buffers.
    """
    if isinstance(values, pa.ChunkedArray):
        values = values.combine_chunks()
    if pa.types.is_string(values.type):
        values = values.cast(pa.binary())
    values = values.cast(pa.large_binary()).fill_null(b"")
    n = len(values)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = values.buffers()
    at = np.frombuffer(offsets, np.int64)[values.offset : values.offset + n + 1]
    flat = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return flat[at[0] : at[-1]], at - at[0]


def byte_slices(batch: pa.RecordBatch, column: str, most: int):
    """Cut a batch into pieces of about ``most`` bytes of ``column`` (one row at least)."""
    _, at = utf8_parts(batch.column(column))
    start = 0
    while start < batch.num_rows:
        end = int(np.searchsorted(at, at[start] + most, side="right")) - 1
        end = min(max(end, start + 1), batch.num_rows)
        yield batch.slice(start, end - start)
        start = end


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser of 64-bit hashes (murmur's two multiply-shift rounds)."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


def pair64(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Identifier of the ordered pair of two 64-bit identifiers."""
    return mix64(a * np.uint64(0x9E3779B97F4A7C15) + (b ^ (b >> np.uint64(29))) * np.uint64(0xD6E8FEB86659FD93) + np.uint64(0x632BE59BD9B4E019))
