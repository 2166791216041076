"""Connected components of a link table by alternating large and small stars.

Each round is two aggregates (with a map-side part) and two joins on a node; the links are
written to the shared folder every round, so nothing is collected and a lost executor costs
a reread. A star of any size is settled in one round; a chain of n links takes O(log n).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from delaylake.llm.base import Scratch


def _star(links: DataFrame, large: bool) -> DataFrame:
    """Links every larger (or smaller, and own) neighbour of a node to the least one."""
    both = links.select("u", "v").union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    seen = both if large else both.where("v < u")
    least = seen.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    near = seen.join(least, "u")
    if large:
        moved = near.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        moved = (near.select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .union(least.select("u", F.col("m").alias("v"))))
    return moved.where("u <> v").distinct()


def components(links: DataFrame) -> DataFrame:
    """``node, root``: the least node reachable from each linked node. ``links`` has the
    columns ``u`` and ``v``; loops, repeats and both directions are allowed."""
    scratch = Scratch(links.sparkSession)
    links = scratch.write("links0", links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                          .where("u <> v").distinct())
    before, turn = None, 0
    while True:
        now = links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before, turn = now, turn + 1
        links = scratch.write(f"links{turn}", _star(_star(links, True), False))
        scratch.drop(f"links{turn - 1}")
    nodes = links.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return nodes.union(links.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
