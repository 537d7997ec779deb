"""A hash tree over a table of lines: one root for the same lines in any order and any files, and the ranges where two tables differ.

Lines are dealt to ranges by the first digits of their SHA-256, so a changed,
added or lost line touches the ranges of its old and its new hash alone, and no
sort of all lines is needed. A range's hash is that of its lines' sorted hashes
with their numbers; a node's that of its children, sixteen at most. Equal lines
are counted first, so that a line that a third of all rows share is one entry.

Defined cases: null lines count as lines of their own, other than empty ones;
a table without lines has no nodes, and the root is the hash of nothing.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.tables import cut

#: Distinct lines in a range: so many on average at most, and more than a sixteenth of that where there are several ranges.
RANGE_LINES = 1024


def tree(lines: DataFrame, range_lines: int = RANGE_LINES, deepest: int | None = None) -> DataFrame:
    """Rows (level, prefix, lines, sha256), the root at level 0 with an empty prefix. lines: (line).

    deepest: the level at which ranges end, even if they hold more than range_lines; every line is in one all the same.
    """
    own = F.coalesce(F.sha2("line", 256), F.lit("null"))
    distinct = cut(lines.groupBy(own.alias("hash")).agg(F.count("*").alias("n")))
    held, depth = distinct.count(), 0
    while held > range_lines * 16**depth and depth != deepest:
        depth += 1
    entry = F.concat_ws(":", "hash", "n")
    level = distinct.groupBy(F.substring("hash", 1, depth).alias("prefix")).agg(F.sum("n").alias("lines"), F.array_sort(F.collect_list(entry)).alias("entries"))
    levels = [cut(level.select("prefix", "lines", F.sha2(F.array_join("entries", "\n"), 256).alias("sha256")))]
    for above in range(depth - 1, -1, -1):
        child = F.concat_ws(":", "prefix", "sha256")
        up = levels[-1].groupBy(F.substring("prefix", 1, above).alias("above")).agg(F.sum("lines").alias("lines"), F.array_sort(F.collect_list(child)).alias("entries"))
        levels.append(up.select(F.col("above").alias("prefix"), "lines", F.sha2(F.array_join("entries", "\n"), 256).alias("sha256")))
    return reduce(DataFrame.unionByName, (df.select(F.lit(depth - i).alias("level"), "prefix", "lines", "sha256") for i, df in enumerate(levels)))


def root(lines: DataFrame) -> DataFrame:
    """One row (lines, sha256)."""
    top = tree(lines).where("level = 0").agg(F.max("lines").alias("lines"), F.max("sha256").alias("sha256"))
    return top.select(F.coalesce("lines", F.lit(0)).alias("lines"), F.coalesce("sha256", F.sha2(F.lit(""), 256)).alias("sha256"))


def differing(old: DataFrame, new: DataFrame) -> DataFrame:
    """Rows (prefix) of the ranges whose lines differ between two trees. Where one is deeper, its ranges are compared by the nodes at the other's depth, which differ as their ranges are made otherwise."""
    both = [df.select("level", "prefix", F.col("sha256").alias(name)) for df, name in ((old, "_old"), (new, "_new"))]
    depth = F.least(*(F.coalesce(F.col(x), F.lit(0)) for x in ("_a", "_b")))
    least = old.agg(F.max("level").alias("_a")).crossJoin(new.agg(F.max("level").alias("_b"))).select(depth.alias("level"))  # one row each
    at = [df.join(F.broadcast(least), "level", "left_semi") for df in both]
    return at[0].join(at[1], ["level", "prefix"], "full").where(~F.col("_old").eqNullSafe(F.col("_new"))).select("prefix")
