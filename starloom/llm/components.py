"""Connected components of a link table by least labels and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, stored


def connected_components(links: DataFrame) -> DataFrame:
    """The nodes of ``links`` (a, b) with ``component``, the least node that links lead to.

    Every round a node takes the least label among its neighbours' and its own, then the label of
    that label, until no label changes; the labels of a round are written to shared scratch. The
    rounds follow the logarithm of a component's diameter, as jumps double what a label spans.
    Nodes without links are not listed.
    """
    spark = links.sparkSession
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    edges = stored(both.filter("a != b").distinct(), "links")
    labels = stored(
        edges.groupBy("a").agg(F.least("a", F.min("b")).alias("component")).withColumnRenamed("a", "node"), "labels"
    )
    while True:
        seen = edges.join(labels, edges["b"] == labels["node"]).groupBy("a").agg(F.min("component").alias("near"))
        least = labels.join(seen, labels["node"] == seen["a"], "left").select(
            "node", "component", F.least("component", "near").alias("best")
        )
        jump = labels.select(F.col("node").alias("best"), F.col("component").alias("far"))
        after = stored(
            least.join(jump, "best", "left").select(
                "node", F.col("component").alias("old"), F.least("best", F.coalesce("far", "best")).alias("component")
            ),
            "labels",
        )
        changed = not after.filter("old != component").isEmpty()
        discard(spark, labels)
        labels = after.select("node", "component")
        if not changed:
            discard(spark, edges)
            return labels
