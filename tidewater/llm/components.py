"""Connected components of a graph given as edges, by the smallest node id."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.frames import staged


def connected_components(edges: DataFrame) -> DataFrame:
    """``node``, ``label`` for every node of ``edges`` (``a``, ``b``, both long); label = smallest node.

    Each round gives a node the smallest label among its neighbours and then the label of its label,
    so chains shrink by more than half. Minima are taken per task before the shuffle; rounds are
    staged, nothing is gathered but the number of changed nodes.
    """
    both = staged(edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
                  .filter("a <> b").distinct(), "edges")
    labels = staged(both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("label")).select(
        F.col("a").alias("node"), "label"), "labels")
    while True:
        near = both.join(labels.select(F.col("node").alias("b"), F.col("label").alias("next")), "b").groupBy("a").agg(
            F.min("next").alias("near"))
        lower = labels.join(near.withColumnRenamed("a", "node"), "node", "left").select(
            "node", F.col("label").alias("before"), F.least("label", "near").alias("label"))
        jump = labels.select(F.col("node").alias("label"), F.col("label").alias("further"))
        after = staged(lower.join(jump, "label", "left").select(
            "node", "before", F.least("label", "further").alias("label")), "labels")
        if after.filter("label <> before").isEmpty():
            return after.select("node", "label")
        labels = after.select("node", "label")
