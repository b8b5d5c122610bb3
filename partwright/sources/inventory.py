"""S3 — the file inventory of an export, as a DataFrame.

``binaryFile`` with only ``path``/``length``/``modificationTime`` selected lists
files without opening them (the content column is pruned).  Listing runs as a
Spark job once the directory count passes the parallel-discovery threshold,
so a tree of millions of files never has to be walked by one Python loop.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

INVENTORY_SCHEMA = T.StructType(
    [
        T.StructField("path", T.StringType(), True),
        T.StructField("length", T.LongType(), True),
        T.StructField("modificationTime", T.TimestampType(), True),
    ]
)


def list_files(spark: SparkSession, path: str, glob: str = "*.parquet") -> DataFrame:
    """All files below ``path`` whose name matches ``glob`` (recursive).

    Raises ``AnalysisException`` (PATH_NOT_FOUND) when ``path`` is absent.
    """
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", glob)
        .load(path)
        .select("path", "length", "modificationTime")
    )


def list_files_or_empty(spark: SparkSession, path: str, glob: str = "*.parquet") -> tuple[DataFrame, bool]:
    """Like :func:`list_files`, but an absent path gives an empty frame.

    Returns ``(files, path_exists)``.
    """
    try:
        return list_files(spark, path, glob), True
    except AnalysisException as exc:
        if "PATH_NOT_FOUND" not in str(exc) and "Path does not exist" not in str(exc):
            raise
        return spark.createDataFrame([], INVENTORY_SCHEMA), False
