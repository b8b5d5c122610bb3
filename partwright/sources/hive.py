"""S2 — read a Hive-partitioned Parquet export back with declared key types.

Partition values live only in directory names.  Letting Spark infer their
types loses information (``store_id=0001`` would become the integer 1), so
the key columns are declared, as the reference's external table does.  Body
columns come from the Parquet footers.  A date filter on the key column is a
``PartitionFilters`` entry: directories of other dates are never listed into
the scan.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..schema import KEYS


def _body_schema(spark: SparkSession, path: str, keys: Sequence[str]) -> T.StructType:
    inferred = spark.read.option("basePath", path).parquet(path).schema
    return T.StructType([f for f in inferred.fields if f.name not in set(keys)])


def read_partitioned(
    spark: SparkSession,
    path: str,
    *,
    keys: Sequence[str] = KEYS,
    key_types: Mapping[str, T.DataType] | None = None,
    body_schema: T.StructType | None = None,
    columns: Sequence[str] | None = None,
    schema: T.StructType | None = None,
) -> DataFrame:
    """Read ``path`` (a Hive tree ``k1=../k2=../..``) with typed key columns.

    ``key_types`` defaults to STRING for every key except ``extract_date``
    (DATE).  ``columns`` reorders/selects the result (e.g. the source's
    column order; keys come last on read-back otherwise).  With ``schema``, the
    exported frame's, nothing is inferred: the tree is listed once, and an export
    without files reads as an empty frame.
    """
    if schema is not None:
        wanted = {k: schema[k].dataType for k in keys if k in schema.names}
        key_types = {**wanted, **(key_types or {})}
        body_schema = body_schema or schema
    types = {k: (T.DateType() if k == "extract_date" else T.StringType()) for k in keys}
    types.update(key_types or {})
    body = body_schema if body_schema is not None else _body_schema(spark, path, keys)
    full = T.StructType(
        [f for f in body.fields if f.name not in set(keys)]
        + [T.StructField(k, types[k], True) for k in keys]
    )
    df = spark.read.schema(full).option("basePath", path).parquet(path)
    if columns is not None:
        df = df.select(*columns)
    return df
