"""Connected components of a graph given as links, by minimum labels that jump along labels."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airsift.llm.store import stored


def components(links: DataFrame) -> DataFrame:
    """``links`` (a, b) to one row (node, label) per linked node; label is the smallest node reachable.

    Each round gives a node, and the node its label names, the smallest label next to it, and then replaces labels
    by their labels. The rounds needed grow with the logarithm of the longest path in practice. Every round ends in a
    stored table. Loops and repeated links do no harm; without links the result is empty.
    """
    edges = stored(
        links.select(F.col("a").cast("long"), F.col("b").cast("long")).where("a <> b").distinct(),
        "links",
    )
    both = edges.union(edges.select("b", "a")).toDF("a", "b")
    labels = stored(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("a")).alias("label")), "labels")
    while True:
        near = both.join(labels, F.col("b") == F.col("node")).select(F.col("a").alias("node"), "label")
        own = labels.select("node", F.col("label").alias("old"))
        lowest = near.groupBy("node").agg(F.min("label").alias("near"))
        offers = own.join(lowest, "node").where("near < old")
        hooked = offers.select("node", "near").union(offers.select(F.col("old").alias("node"), "near"))
        better = hooked.groupBy("node").agg(F.min("near").alias("near"))
        raised = own.join(better, "node", "left").select("node", "old", F.least("old", "near").alias("label"))
        over = raised.select(F.col("node").alias("via"), F.col("label").alias("far"))
        jumped = raised.join(over, F.col("label") == F.col("via")).select("node", "old", F.least("label", "far").alias("label"))
        after = stored(jumped, "labels")
        if after.where("label <> old").isEmpty():
            return after.select("node", "label")
        labels = after.select("node", "label")
