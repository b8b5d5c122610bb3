"""Session construction and the shared scratch folder.

The library never picks a machine-local folder on its own when running on a
cluster: anything it writes as an intermediate (round-trip exports in the
registered queries, tests) goes below ``spark.checkpoint.dir``, which a cluster
points at shared storage.  Only when that setting is absent (local runs and
tests) does :func:`scratch_root` create one.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Session settings the engine relies on.  UTC makes DATE/TIMESTAMP handling
# match the reference (TIMESTAMP is a UTC instant there).  The two discovery
# knobs make reading thousands of Hive directories back cheap: listing is
# parallelised through a Spark job only above the threshold.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.parallelPartitionDiscovery.threshold": "32",
    "spark.sql.sources.parallelPartitionDiscovery.parallelism": "64",
    "spark.sql.parquet.compression.codec": "snappy",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(
    master: str | None = None,
    app_name: str = "partwright",
    shuffle_partitions: int | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or fetch) a session with the engine's defaults.

    ``master`` is left to ``spark-submit`` when ``None``.  Extra ``conf``
    entries override the defaults.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = dict(DEFAULT_CONF)
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def scratch_root(spark: SparkSession) -> str:
    """The shared folder for intermediate tables: ``spark.checkpoint.dir``.

    Read from the session; where it is unset a local session gets a folder of its
    own, any other master raises: executors would not see a folder of the driver.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current.rstrip("/")
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None
    )
    if not configured:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="partwright-ckpt-")
    sc.setCheckpointDir(configured)
    return (sc.getCheckpointDir() or configured).rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique location below the shared scratch folder."""
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def to_local(path: str) -> str:
    """Strip a ``file:`` scheme so a path can be compared with local paths."""
    if path.startswith("file://"):
        return path[len("file://"):]
    if path.startswith("file:"):
        return path[len("file:"):]
    return path

