"""Connected components of an edge table by label propagation with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from partwright.llm.common import written


def connected_components(edges: DataFrame) -> DataFrame:
    """(id, component) of every id in ``edges`` (a, b); component is the smallest id reachable.

    Each round takes the least label among a node's neighbours, then the label of that
    label, until a round changes nothing.  Labels are written between rounds.
    """
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    links = written(both.distinct(), "links")
    labels = written(
        links.groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("id"), F.least("a", "b").alias("component")),
        "labels",
    )
    while True:
        seen = links.join(labels.withColumnRenamed("id", "b"), "b").groupBy("a").agg(F.min("component").alias("near"))
        lower = labels.join(seen.withColumnRenamed("a", "id"), "id").select(
            "id", F.col("component").alias("old"), F.least("component", "near").alias("component")
        )
        root = labels.select(F.col("id").alias("component"), F.col("component").alias("root"))
        labels = written(
            lower.join(root, "component").select(
                "id", F.least("component", "root").alias("component"), (F.least("component", "root") < F.col("old")).alias("moved")
            ),
            "labels",
        )
        if labels.filter("moved").isEmpty():
            return labels.select("id", "component")
        labels = labels.select("id", "component")
