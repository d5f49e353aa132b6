"""Connected components of a table of links, by large-star and small-star rounds.

Every round is two groupings; links shrink to stars whose centre is the smallest node. Each
round is a written table, so lost executors cost a task, not the rounds before.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardflow import scratch


def _star(links: DataFrame, large: bool) -> DataFrame:
    """One half round over links (u, v): every node's neighbours are tied to the smallest of
    them and it; ``large``: those greater than the node, else those smaller."""
    both = links.select("u", "v").unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    near = both if large else both.where(F.col("v") < F.col("u"))
    least = near.groupBy("u").agg(F.min("v").alias("w")).withColumn("w", F.least("u", "w"))
    ties = near.join(least, "u")
    if large:
        return ties.where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("w").alias("v")).distinct()
    own = least.select("u", F.col("w").alias("v"))
    return ties.select(F.col("v").alias("u"), F.col("w").alias("v")).where("u <> v").unionByName(own).distinct()


def connected(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root): the smallest node of its component, for every node that has a link to
    another. Null ends, loops and repeated links are ignored; no links give no rows."""
    now = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where(
        F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b))).distinct()
    now, before = scratch.materialise(now, "components"), None
    while True:
        now = scratch.materialise(_star(_star(now, True), False), "components")
        state = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    nodes = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    centres = now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return nodes.unionByName(centres)
