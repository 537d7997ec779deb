"""Bitemporal history: latest rows, revisions closed and opened, channels replayed from events."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.tables import cut, small

#: Conflicts: rows of an identifier in a block, about; pairs and rows that a task has on average at most.
BLOCK_ROWS, TASK_PAIRS, TASK_ROWS = 1_000, 8_000_000, 500_000


def latest(rows: DataFrame, keys: tuple[str, ...], by: tuple[str, ...]) -> DataFrame:
    """The last row of each key; ties by the further columns of `by`. Partial maxima, no sort of a key's rows."""
    return rows.groupBy(*keys).agg(F.max_by(F.struct("*"), F.struct(*by)).alias("_r")).select("_r.*")


def current(revisions: DataFrame) -> DataFrame:
    return revisions.where("recorded_to IS NULL")


def revise(revisions: DataFrame, units: DataFrame, fields: tuple[str, ...], at) -> DataFrame:
    """All revisions after a release: those of units that changed or went are closed at `at`, new ones are opened; the rest stay.

    revisions: (key, fields..., recorded_from, recorded_to); units: (key, fields...). Applying it again changes nothing.
    """
    new = units.select("key", *(F.col(f).alias(f"_{f}") for f in fields), F.lit(True).alias("_new"))
    open_ = current(revisions).join(new, "key", "full_outer")
    differs = F.lit(False)
    for f in fields:
        differs = differs | ~F.col(f).eqNullSafe(F.col(f"_{f}"))
    had = F.col("recorded_from").isNotNull()
    stays = had & F.col("_new").isNotNull() & ~differs
    kept = open_.where(had).select("key", *fields, "recorded_from", F.when(~stays, F.lit(at)).cast("timestamp").alias("recorded_to"))
    opened = open_.where(F.col("_new").isNotNull() & ~stays).select("key", *(F.col(f"_{f}").alias(f) for f in fields), F.lit(at).cast("timestamp").alias("recorded_from"), F.lit(None).cast("timestamp").alias("recorded_to"))
    return revisions.where("recorded_to IS NOT NULL").unionByName(kept).unionByName(opened)


def missing_identifiers(wanted: DataFrame, known: DataFrame) -> DataFrame:
    """Wanted (scheme, value, valid_from, ...) without a known one; null dates are equal."""
    w, k = wanted.alias("w"), known.select("scheme", "value", "valid_from").alias("k")
    return w.join(k, (F.col("w.scheme") == F.col("k.scheme")) & (F.col("w.value") == F.col("k.value")) & F.col("w.valid_from").eqNullSafe(F.col("k.valid_from")), "left_anti")


def identifier_conflicts(wanted: DataFrame, known: DataFrame) -> DataFrame:
    """Identifiers that another unit has: rows (scheme, value, territory_id, other_id).

    The pairs of an identifier grow with the square of its units. They are counted first; its rows are dealt to blocks by
    their unit's hash, each block of wanted rows meets each of known ones, and there are as many tasks as the pairs ask for.
    """
    keys = ["scheme", "value"]
    w, k = cut(wanted.select(*keys, "territory_id")), cut(known.select(*keys, F.col("territory_id").alias("other_id")))
    blocks = lambda n: F.ceil(F.col(n) / BLOCK_ROWS)
    sizes = w.groupBy(*keys).agg(F.count("*").alias("_w")).join(k.groupBy(*keys).agg(F.count("*").alias("_k")), keys)
    sizes = cut(sizes.withColumns({"_ws": blocks("_w"), "_ks": blocks("_k")}))
    rows = F.col("_w") * F.col("_ks") + F.col("_k") * F.col("_ws")
    tasks = sizes.agg(F.sum(F.col("_w") / TASK_PAIRS * F.col("_k") + rows / TASK_ROWS)).first()[0] or 0
    sizes = small(sizes)

    def dealt(df, unit, own, others, at, every):
        block = F.pmod(F.xxhash64(unit), F.col(own)).alias(at)
        out = df.join(sizes, keys).select(*keys, unit, block, F.explode(F.sequence(F.lit(0).cast("long"), F.col(others) - 1)).alias(every))
        return out.repartition(math.ceil(tasks) or 1, *keys, "_i", "_j")  # by number, as the rows that make the pairs are too few to be spread otherwise

    pairs = dealt(w, "territory_id", "_ws", "_ks", "_i", "_j").join(dealt(k, "other_id", "_ks", "_ws", "_j", "_i").hint("shuffle_hash"), [*keys, "_i", "_j"])
    return pairs.where("territory_id != other_id").select(*keys, "territory_id", "other_id")


def channel_state(events: DataFrame) -> DataFrame:
    """Rows (channel, release, at): where each channel points after all events (channel, release, at, seq)."""
    return latest(events, ("channel",), ("at", "seq")).select("channel", "release", "at")


def move_kind(target_published, present_published):
    """A channel that moves to an older release rolls back."""
    return F.when(target_published < present_published, "rollback").otherwise("promote")
