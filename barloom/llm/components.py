"""Connected components of an edge table by minimum labels with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.llm.common import cut


def components(edges: DataFrame) -> DataFrame:
    """node, component (the smallest node that it reaches) for every node of the edges (a, b); ids are bigints.

    Each round gives a node the least label around it and then that label's own
    label, so distances shrink geometrically; every round is checkpointed.
    """
    both = cut(edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).where("a <> b").distinct())
    labels = cut(both.groupBy(F.col("a").alias("node")).agg(F.least(F.first("a"), F.min("b")).alias("label")))
    while True:
        near = both.join(labels.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near"))
        low = labels.join(near, "node").select("node", "label", F.least("label", "near").alias("low"))
        low = cut(low)
        jump = low.select(F.col("node").alias("low"), F.col("low").alias("further"))
        fresh = cut(low.join(jump, "low", "left").select("node", "label", F.least("low", F.coalesce("further", "low")).alias("fresh")))
        if fresh.where("fresh <> label").isEmpty():
            return fresh.select("node", F.col("fresh").alias("component"))
        labels = fresh.select("node", F.col("fresh").alias("label"))
