"""Small Hadoop FileSystem helpers (through the session's JVM gateway).

Used where no DataFrame operation can express the step: removing one
partition directory when a date is replaced by nothing, and the renames of a
two-phase replacement.  Works for any Hadoop-supported scheme (local, HDFS,
object stores).
"""

from __future__ import annotations

from pyspark.sql import SparkSession


def _fs_path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs, hpath


def exists(spark: SparkSession, path: str) -> bool:
    fs, hpath = _fs_path(spark, path)
    return bool(fs.exists(hpath))


def delete_tree(spark: SparkSession, path: str) -> bool:
    """Recursively delete ``path``; an absent path is not an error."""
    fs, hpath = _fs_path(spark, path)
    if not fs.exists(hpath):
        return False
    return bool(fs.delete(hpath, True))


def qualify(spark: SparkSession, path: str) -> str:
    """Fully qualified form of ``path`` (scheme, authority, absolute)."""
    fs, hpath = _fs_path(spark, path)
    return str(fs.makeQualified(hpath).toString())


def rename(spark: SparkSession, source: str, target: str) -> None:
    """Rename a file or directory; the target must not exist (a directory would take the source in)."""
    fs, hsource = _fs_path(spark, source)
    _, htarget = _fs_path(spark, target)
    if fs.exists(htarget):
        raise FileExistsError(f"{target!r} exists")
    if not fs.rename(hsource, htarget):
        raise OSError(f"could not rename {source!r} to {target!r}")


def make_directory(spark: SparkSession, path: str) -> None:
    fs, hpath = _fs_path(spark, path)
    if not fs.exists(hpath):
        fs.mkdirs(hpath)


def list_directories(spark: SparkSession, path: str) -> list[str]:
    """Names of the directories right below ``path``; none where it does not exist."""
    fs, hpath = _fs_path(spark, path)
    if not fs.exists(hpath):
        return []
    return [str(s.getPath().getName()) for s in fs.listStatus(hpath) if s.isDirectory()]


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file, replacing one of that name."""
    fs, hpath = _fs_path(spark, path)
    out = fs.create(hpath, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def read_text(spark: SparkSession, path: str) -> str:
    fs, hpath = _fs_path(spark, path)
    stream = fs.open(hpath)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()
