"""Places in a global order without one task for all rows: range partitions, counts of each, offsets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from airsift.llm.store import stored


def numbered(frame: DataFrame, order: list[Column], group: str | None = None, purpose: str = "order") -> DataFrame:
    """``frame`` with ``position`` (long, from 0) in the order of ``order`` within each value of column ``group``, and ``total``.

    Rows are dealt by ranges of (group, order), so a group with a third of all rows lies on many tasks. What is summed to
    offsets is one count per task and group. Rows equal in every key are numbered in any order, but once for all: the
    numbered rows are stored.
    """
    keys = ([F.col(group).asc_nulls_first()] if group else []) + order
    inside = frame.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("_at", F.monotonically_increasing_id())
    inside = stored(inside, purpose)
    task = F.shiftright("_at", 33).alias("_task")
    tree = F.col(group).alias("_group") if group else F.lit(0).alias("_group")
    counts = inside.groupBy(task, tree).agg(F.min("_at").alias("_first"), F.count("*").alias("_rows"))
    tasks = Window.partitionBy("_group")
    before = F.coalesce(F.sum("_rows").over(tasks.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = counts.select(F.col("_task").alias("_of"), "_group", "_first", before.alias("_before"), F.sum("_rows").over(tasks).alias("total"))
    offsets = stored(offsets, f"{purpose}-offsets")
    same = F.shiftright(inside["_at"], 33) == offsets["_of"]
    if group:
        same = same & inside[group].eqNullSafe(offsets["_group"])
    joined = inside.join(offsets, same)
    return joined.select(*(inside[name] for name in frame.columns), (F.col("_at") - F.col("_first") + F.col("_before")).alias("position"), "total")
