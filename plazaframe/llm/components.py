"""Connected components of a graph of links, by alternating large and small stars.

Every step is a grouped minimum and a join, and its links are written, so that neither the driver
nor one task ever holds a component, and a lost executor costs one step.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plazaframe.operators.durable import materialise


def _star(links: DataFrame, large: bool) -> DataFrame:
    """Links each node's larger (or not larger) neighbours to the smallest node of its neighbourhood."""
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))) if large else links
    least = both.groupBy("a").agg(F.min("b").alias("least")).select("a", F.least("a", "least").alias("least"))
    moved = both.join(least, "a").where(F.col("b") > F.col("a") if large else F.lit(True))
    moved = moved.select(F.col("b").alias("a"), F.col("least").alias("b"))
    if not large:
        moved = moved.union(least.select("a", F.col("least").alias("b")))
    return moved.where("a <> b").distinct()


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``root``, the smallest node of its component, for all nodes of ``links`` (a, b); ends when nothing changes."""
    now = materialise(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    mark = None
    while True:
        large = _star(now, True).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
        now = materialise(_star(large, False))
        seen = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if seen == mark:
            break
        mark = seen
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(now.select(F.col("b"), F.col("b")).distinct())
