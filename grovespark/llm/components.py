"""Connected components of a link table by alternating large and small stars.

Each round is two grouped minima and two joins over the links that are left;
nothing is collected. A hub's links are joined, not gathered, so adaptive
execution can split them. Rounds grow with the logarithm of a component's
diameter.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import cut, shuffled


def _star(links: DataFrame, large: bool) -> DataFrame:
    """links: distinct (u, v), u > v. Each node's neighbours (large: greater ones; small: its lesser ones and itself) are linked to its least neighbour."""
    if large:
        both = links.select("u", "v").union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
        out = both.where("v > u").join(shuffled(least), "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        least = links.groupBy("u").agg(F.min("v").alias("m"))
        out = links.join(shuffled(least), "u").select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v")))
    return out.where("u > v").distinct()


def components(links: DataFrame, most_rounds: int = 60) -> DataFrame:
    """Rows (node, least) of every node with a link: the least node that it reaches. links: (a, b), any order, repeats allowed."""
    now = cut(links.where("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    seen = None
    for _ in range(most_rounds):
        now = cut(_star(_star(now, True), False))
        # the links are stars when no node is both a centre and a leaf, and no leaf has two centres
        mark = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(mark) == seen:
            break
        seen = tuple(mark)
    else:
        raise RuntimeError("components did not settle")
    return now.select(F.col("u").alias("node"), F.col("v").alias("least")).union(now.select(F.col("v").alias("node"), F.col("v").alias("least")).distinct())
