"""Differences between two snapshots of units, and gates on mass changes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The reviewed thresholds.
TOTAL, REMOVED, CHANGED = 0.02, 0.01, 0.25


def changes(previous: DataFrame, current: DataFrame, fields: tuple[str, ...], key: str = "code", record_hash: str | None = "record_hash") -> DataFrame:
    """Rows (key, kind, fields, source_changed) of all units. kind: added, removed, changed or unchanged; fields: the names of those that differ, in order."""
    p = previous.select(F.col(key), *(F.col(f).alias(f"_p_{f}") for f in fields), (F.col(record_hash) if record_hash else F.lit(None).cast("string")).alias("_p_hash"), F.lit(True).alias("_p"))
    c = current.select(F.col(key), *(F.col(f).alias(f"_c_{f}") for f in fields), (F.col(record_hash) if record_hash else F.lit(None).cast("string")).alias("_c_hash"), F.lit(True).alias("_c"))
    j = p.join(c, key, "full_outer")
    both = F.col("_p").isNotNull() & F.col("_c").isNotNull()
    differ = F.array_compact(F.array(*(F.when(~F.col(f"_p_{f}").eqNullSafe(F.col(f"_c_{f}")), F.lit(f)) for f in sorted(fields))))
    kind = F.when(F.col("_p").isNull(), "added").when(F.col("_c").isNull(), "removed").when(F.size(differ) > 0, "changed").otherwise("unchanged")
    return j.select(key, kind.alias("kind"), F.when(both, differ).otherwise(F.array().cast("array<string>")).alias("fields"), (both & ~F.col("_p_hash").eqNullSafe(F.col("_c_hash"))).alias("source_changed"))


def ratios(diff: DataFrame) -> DataFrame:
    """One row of counts, and their shares of the previous total (0 counts as 1)."""
    n = lambda k: F.count_if(F.col("kind") == k)
    out = diff.agg(n("added").alias("added"), n("removed").alias("removed"), n("changed").alias("changed"), n("unchanged").alias("unchanged"), F.count_if("source_changed").alias("source_changed"))
    before = F.greatest(F.col("removed") + F.col("changed") + F.col("unchanged"), F.lit(1))
    return out.withColumns({"total_ratio": F.abs(F.col("added") - F.col("removed")) / before, "removed_ratio": F.col("removed") / before, "changed_ratio": F.col("changed") / before})


def gates(ratio: DataFrame, total: float = TOTAL, removed: float = REMOVED, changed: float = CHANGED) -> DataFrame:
    """Rows (rule, ratio) of the thresholds that are exceeded."""
    if not all(0 <= x <= 1 for x in (total, removed, changed)):
        raise ValueError("thresholds must be from 0 to 1")
    rows = F.array(*(F.struct(F.lit(f"SIRUTA_DIFF_{name}_MASS_CHANGE").alias("rule"), F.col(column).alias("ratio"), F.lit(most).alias("most")) for name, column, most in (("TOTAL", "total_ratio", total), ("REMOVALS", "removed_ratio", removed), ("RECORDS", "changed_ratio", changed))))
    return ratio.select(F.inline(rows)).where("ratio > most").select("rule", "ratio")


def first_changes(current: DataFrame, key: str = "code") -> DataFrame:
    """Changes where nothing was released before: every unit is added."""
    return current.select(key, F.lit("added").alias("kind"), F.array().cast("array<string>").alias("fields"), F.lit(False).alias("source_changed"))


def changelog(diff: DataFrame, previous_release: str | None) -> DataFrame:
    """One row of a release's changes: counts, and shares of the previous total where there was one.

    diff: of changes() or first_changes(). baseline: whether there was a release to compare with.
    """
    out = ratios(diff).withColumns({"previous_release_id": F.lit(previous_release).cast("string"), "baseline": F.lit(previous_release is not None), "skipped": F.lit(False), "reason": F.lit(None).cast("string")})
    if previous_release is None:
        out = out.withColumns({c: F.lit(None).cast("double") for c in ("total_ratio", "removed_ratio", "changed_ratio")})
    return out


def skipped(spark, reason: str) -> DataFrame:
    """The row of a comparison that was left out."""
    none = F.lit(None)
    return spark.range(1).select(*(F.lit(0).cast("long").alias(c) for c in ("added", "removed", "changed", "unchanged", "source_changed")), *(none.cast("double").alias(c) for c in ("total_ratio", "removed_ratio", "changed_ratio")), none.cast("string").alias("previous_release_id"), none.cast("boolean").alias("baseline"), F.lit(True).alias("skipped"), F.lit(reason).alias("reason"))


def listed(diff: DataFrame, key: str = "code") -> DataFrame:
    """Rows (kind, position, code) of added, removed and changed units and of those whose source record changed, in the numeric order of their codes."""
    kinds = F.array_compact(F.array(F.when(F.col("kind") != "unchanged", F.col("kind")), F.when(F.col("source_changed"), "source_record_changed")))
    return diff.select(F.explode(kinds).alias("kind"), F.col(key).cast("long").alias("position"), key).orderBy("kind", "position")
