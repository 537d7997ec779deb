"""The forest: ancestors, descendants, cycles, leaves, paths.

Each unit has at most one parent. Closures take one join a level, so as many as
the forest is deep. Cycles are found by dropping leaves and trees first, then by
pointer doubling over what is left, which ends once a round changes nothing: in
the logarithm of the longest way left, not of the number of units. Nothing is
collected.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.text import slugify
from ..sources.tables import cut, small

MOST_HOPS = 32


def ancestors(edges: DataFrame, most: int | None = MOST_HOPS) -> DataFrame:
    """Rows (id, ancestor, hop), nearest first; a walk ends at a missing parent, at its start or after `most` hops. edges: (id, parent).

    most = None: walks to the root; where the edges hold rings, each ancestor once.
    """
    known = cut(edges.where("parent IS NOT NULL").dropDuplicates(["id"]))
    present = edges.select(F.col("id").alias("ancestor")).distinct()
    # the parents that exist, and their own: as few as there are inner units
    inner = cut(known.select(F.col("parent").alias("ancestor")).distinct().join(present, "ancestor", "left_semi"))
    up = small(cut(inner.join(known.select(F.col("id").alias("ancestor"), F.col("parent").alias("_next")), "ancestor").join(inner.select(F.col("ancestor").alias("_next")), "_next", "left_semi").select("ancestor", "_next")))
    front = cut(known.select("id", F.col("parent").alias("ancestor"), F.lit(1).alias("hop")).join(small(inner), "ancestor", "left_semi").where("ancestor != id"))
    ringed = most is None and not cycles(edges).isEmpty()
    out, hop = front, 1
    while most is None or hop < most:
        hop += 1
        ahead = front.join(up, "ancestor").select("id", F.col("_next").alias("ancestor"), F.lit(hop).alias("hop")).where("ancestor != id")
        if ringed:
            ahead = ahead.join(out, ["id", "ancestor"], "left_anti")
        front = cut(ahead)
        if front.isEmpty():
            break
        out = out.unionByName(front)
    return out.select("id", "ancestor", "hop")


def descendants(edges: DataFrame) -> DataFrame:
    """Rows (ancestor, id, hop): every unit below another, each once."""
    return ancestors(edges, None).select("ancestor", "id", "hop")


def subtree(edges: DataFrame, roots: DataFrame) -> DataFrame:
    """Rows (ancestor, id, hop): every unit below the asked ones, each once; a walk down, level by level. roots: (id)."""
    below = edges.where("parent IS NOT NULL").dropDuplicates(["id"])
    front = cut(roots.select(F.col("id").alias("ancestor"), "id", F.lit(0).alias("hop")).distinct())
    out, hop = front, 0
    while not front.isEmpty():
        hop += 1
        met = below.select(F.col("id").alias("_child"), F.col("parent").alias("id")).join(small(front), "id").select("ancestor", F.col("_child").alias("id"), F.lit(hop).alias("hop"))
        front = cut(met.join(out, ["ancestor", "id"], "left_anti"))
        out = out.unionByName(front)
    return out.where("hop > 0")


def _trimmed(step: DataFrame) -> DataFrame:
    """Edges without those that cannot be on a ring: of units without a child, and to units without a parent. Stops when little changes."""
    n = step.count()
    while n:
        inner = step.join(small(cut(step.select(F.col("to").alias("id")).distinct())), "id", "left_semi")
        inner = cut(inner)
        step = cut(inner.join(small(inner.select(F.col("id").alias("to"))), "to", "left_semi"))
        left = step.count()
        if n - left <= n // 10:
            break
        n = left
    return step


def cycles(edges: DataFrame) -> DataFrame:
    """Rows (id, cycle, position): the units on a cycle, the least id on it, and how many steps to parents lead from that to the unit."""
    step = _trimmed(cut(edges.where("parent IS NOT NULL").dropDuplicates(["id"]).select("id", F.col("parent").alias("to"))))
    # where so many steps end; once twice as many end at as many units, these are the units on cycles
    jump, ends, before = step, step.select("to").distinct().count(), -1
    while ends != before:
        ahead = jump.select(F.col("id").alias("to"), F.col("to").alias("_to"))
        jump = cut(jump.join(ahead, "to").select("id", F.col("_to").alias("to")))
        before, ends = ends, jump.select("to").distinct().count()
    on = jump.select(F.col("to").alias("id")).distinct()
    ring = cut(step.join(on, "id", "left_semi"))
    # the least id of so many steps, until no unit finds a lesser one
    least, lower = ring.select("id", "to", F.col("id").alias("least")), not ring.isEmpty()
    while lower:
        ahead = least.select(F.col("id").alias("to"), F.col("to").alias("_to"), F.col("least").alias("_least"))
        found = cut(least.join(ahead, "to").select("id", F.col("_to").alias("to"), F.least("least", "_least").alias("least"), (F.col("_least") < F.col("least")).alias("_lower")))
        lower = not found.where("_lower").isEmpty()
        least = found.drop("_lower")
    # steps from each unit on to the least one, where the walk stays
    walk = cut(ring.join(least.select("id", "least"), "id").select("id", "least", F.when(F.col("id") == F.col("least"), F.col("id")).otherwise(F.col("to")).alias("to"), F.when(F.col("id") == F.col("least"), 0).otherwise(1).cast("long").alias("steps")))
    while not walk.where("to != least").isEmpty():
        ahead = walk.select(F.col("id").alias("to"), F.col("to").alias("_to"), F.col("steps").alias("_steps"))
        walk = cut(walk.join(ahead, "to").select("id", "least", F.col("_to").alias("to"), (F.col("steps") + F.col("_steps")).alias("steps")))
    size = walk.groupBy("least").agg(F.count("*").alias("size"))
    return walk.join(size, "least").select("id", F.col("least").alias("cycle"), ((F.col("size") - F.col("steps")) % F.col("size")).alias("position"))


def unresolved_parents(edges: DataFrame) -> DataFrame:
    return edges.where("parent IS NOT NULL").join(edges.select(F.col("id").alias("parent")), "parent", "left_anti").select("id", "parent")


def leaves(units: DataFrame, types: tuple[str, ...]) -> DataFrame:
    """Units of the types without a child of the types."""
    some = units.where(F.col("territory_type").isin(*types))
    return some.join(some.select(F.col("parent_id").alias("territory_id")), "territory_id", "left_anti")


def slugs(units: DataFrame) -> DataFrame:
    """Adds slug: of siblings with one slug the first by id keeps it, others add their code, or their id if they have none."""
    base = units.withColumn("slug", slugify(F.coalesce("short_name", "official_name") if "short_name" in units.columns else F.col("official_name")))
    nth = F.row_number().over(W.partitionBy("parent_id", "slug").orderBy("territory_id"))
    return base.withColumn("_nth", nth).withColumn("slug", F.when(F.col("_nth") == 1, F.col("slug")).otherwise(F.concat_ws("-", "slug", F.coalesce("code", F.col("territory_id").cast("string"))))).drop("_nth")


def paths(units: DataFrame) -> DataFrame:
    """Rows (territory_id, path, depth): slugs from the root down, joined by '/'."""
    own = cut(slugs(units).select("territory_id", "parent_id", "slug"))
    up = ancestors(own.select(F.col("territory_id").alias("id"), F.col("parent_id").alias("parent")), None)
    named = up.join(own.select(F.col("territory_id").alias("ancestor"), F.col("slug").alias("_slug")), "ancestor")
    above = named.groupBy("id").agg(F.array_sort(F.collect_list(F.struct((-F.col("hop")).alias("order"), "_slug"))).alias("above"))  # as long as the path is deep
    above = above.select(F.col("id").alias("territory_id"), F.transform("above", lambda x: x["_slug"]).alias("above"))
    joined = own.join(above, "territory_id", "left")
    parts = F.concat(F.coalesce("above", F.array().cast("array<string>")), F.array("slug"))
    return joined.select("territory_id", F.array_join(parts, "/").alias("path"), F.size(parts).alias("depth"))


def redirects(paths_: DataFrame, old: str) -> DataFrame:
    """Rows (old, location): the addresses of before, which are `old` and an id, and the path that each leads to now."""
    return paths_.select(F.concat(F.lit(old), "territory_id").alias("old"), F.concat(F.lit("/"), "path").alias("location"))


def resolve(paths_: DataFrame, path: str) -> DataFrame:
    return paths_.where(F.col("path") == path)


def partition_faults(units: DataFrame) -> DataFrame:
    """Units that are in no root's subtree, in several, or whose county is not their root."""
    edges = units.select(F.col("territory_id").alias("id"), F.col("parent_id").alias("parent"))
    roots = edges.where("parent IS NULL").select(F.col("id").alias("ancestor"))
    top = ancestors(edges, None).join(roots, "ancestor", "left_semi").select("id", F.col("ancestor").alias("root")).union(roots.select("ancestor", F.col("ancestor").alias("root")))
    by_unit = top.groupBy("id").agg(F.count("*").alias("n_roots"), F.min("root").alias("root"))
    joined = units.select(F.col("territory_id").alias("id"), "county_id").join(by_unit, "id", "left")
    return joined.where((F.coalesce("n_roots", F.lit(0)) != 1) | ~F.col("root").eqNullSafe(F.col("county_id")))
