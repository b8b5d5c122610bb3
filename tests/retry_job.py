"""Run by test_retry.py in its own process: local mode with task retries.

The first attempt of map task 0 fails after producing part of its output;
the export must still write every row exactly once.
"""

import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from pyspark import TaskContext  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402
from pyspark.sql import types as T  # noqa: E402

from partwright.operators.export import export_partitioned  # noqa: E402
from partwright.session import build_session  # noqa: E402
from partwright.sources.hive import read_partitioned  # noqa: E402


def make_flaky(marker: str):
    @F.udf(T.StringType())
    def flaky(v):
        ctx = TaskContext.get()
        if ctx.partitionId() == 0 and ctx.attemptNumber() == 0:
            Path(marker).write_text("failed once")
            raise RuntimeError("injected task failure")
        return v

    return flaky


def main(out: str) -> None:
    spark = build_session("local[4,4]", shuffle_partitions=8)
    spark.sparkContext.setLogLevel("OFF")
    rows = spark.range(0, 20000, numPartitions=6).select(
        F.when(F.col("id") % 3 == 0, F.lit("HOT")).otherwise(F.concat(F.lit("T"), (F.col("id") % 7).cast("string"))).alias("terr_cd"),
        F.lit("S1").alias("store_id"),
        F.lit("2026-03-01").cast("date").alias("extract_date"),
        # exact copies inside the hot tuple, to exercise the copy-splitting salt
        F.when(F.col("id") % 3 == 0, F.lit("copy")).otherwise(F.col("id").cast("string")).alias("order_id"),
    )
    marker = out.rstrip("/") + ".failed"
    src = rows.withColumn("order_id", make_flaky(marker)("order_id"))
    res = export_partitioned(src, out, overwrite="all", max_rows_per_file=1000)
    back = read_partitioned(spark, out)
    n = back.count()
    hot = back.filter(F.col("terr_cd") == "HOT").count()
    files = len(back.inputFiles())
    failed = Path(marker).exists()
    print(f"RESULT rows={n} hot={hot} hot_tuples={res.hot_tuples} files={files} failed_once={failed}")


if __name__ == "__main__":
    main(sys.argv[1])
