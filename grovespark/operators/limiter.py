"""A fixed-window limiter whose window starts at a client's first hit.

A hit at or after the window's end starts a new window; a limited hit counts
too. Which hits start a window depends on all hits before, but the hit that
would start the next one after a given hit does not: it is the first at or
after that time + window. So these jumps are made for all distinct times at
once and composed by doubling, in as many rounds as the logarithm of a client's
number of windows. A hit's count is its place in the order of all hits, less
that of its window's first hit. One client may have all hits: they are split by
ranges of time, and no task orders more than the distinct times of one window.

Hits without time are left out; those without client are of the client UNKNOWN, or
left out where clients are no texts; equal hits count each; hits of one
client and time are in the order of their ids, null first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.tables import cut, small
from .paging import numbered

# The window, the hits that it allows, and the client of hits that name none.
WINDOW_MS, MOST, UNKNOWN = 60_000, 120, "unknown"


def fold(at: list[int], state: tuple[int, int] | None, window_ms: int) -> tuple[list[int], list[int], tuple[int, int] | None]:
    """Counts and window ends of one client's hits in order, and the state (count, end) after them: for a few hits of a stream, and as a plain version for tests."""
    counts, ends = [], []
    for t in at:
        state = (1, t + window_ms) if state is None or t >= state[1] else (state[0] + 1, state[1])
        counts.append(state[0])
        ends.append(state[1])
    return counts, ends, state


def _slot(at: Column, window_ms: int) -> Column:
    """The multiple of the window at or before a time. A slot holds one start of a window at most."""
    return at - F.pmod(at, F.lit(window_ms))


def jumps(times: DataFrame, window_ms: int) -> DataFrame:
    """Rows (client, at, to): the first time of the client at or after at + window, where there is one. times: distinct (client, at).

    That time is in the next slot, or else the first of the next slot that has any.
    """
    slotted = times.select("client", "at", _slot(F.col("at"), window_ms).alias("slot"))
    along = W.partitionBy("client").orderBy("slot")  # one row a slot, however many hits
    ahead = lambda k: F.struct(F.lead("slot", k).over(along).alias("slot"), F.lead("first", k).over(along).alias("first"))
    slots = slotted.groupBy("client", "slot").agg(F.min("at").alias("first")).withColumns({"one": ahead(1), "two": ahead(2)})
    later = F.when(F.col("one.slot") == F.col("slot") + window_ms, F.col("two.first")).otherwise(F.col("one.first"))
    asking = slotted.join(slots.select("client", "slot", later.alias("later")), ["client", "slot"])
    both = slotted.select("client", "slot", F.col("at").alias("key"), F.col("at").alias("value"), F.lit(None).cast("long").alias("at"), F.lit(None).cast("long").alias("later")).unionByName(
        asking.select("client", (F.col("slot") + window_ms).alias("slot"), (F.col("at") + window_ms).alias("key"), F.lit(None).cast("long").alias("value"), "at", "later")
    )
    back = W.partitionBy("client", "slot").orderBy(F.desc("key"), F.desc_nulls_last("value")).rowsBetween(W.unboundedPreceding, W.currentRow)
    found = both.withColumn("next", F.last("value", ignorenulls=True).over(back)).where("at IS NOT NULL")
    return found.select("client", "at", F.coalesce("next", "later").alias("to")).where("to IS NOT NULL")


def starts(times: DataFrame, window_ms: int) -> DataFrame:
    """Rows (client, start): the times at which windows start. times: distinct (client, at).

    Jumps are made one, two, four and more windows long until none is left;
    then each length doubles the starts that are known, from a client's first on.
    """
    jump = cut(jumps(times, window_ms))
    known = times.groupBy("client").agg(F.min("at").alias("start"))
    lengths = []
    while not jump.isEmpty():
        lengths.append(small(jump))
        onward = jump.select("client", F.col("at").alias("to"), F.col("to").alias("_to"))
        jump = cut(jump.join(onward, ["client", "to"]).select("client", "at", F.col("_to").alias("to")))
    for jump in lengths:
        reached = known.withColumnRenamed("start", "at").join(jump, ["client", "at"], "left")
        known = reached.select("client", F.explode(F.array_compact(F.array("at", "to"))).alias("start"))
    return known


def limited(hits: DataFrame, window_ms: int = WINDOW_MS, most: int = MOST) -> DataFrame:
    """Rows (client, id, at, n, resets_at, limited, remaining). hits: (client, id, at in milliseconds)."""
    client = F.coalesce("client", F.lit(UNKNOWN)) if isinstance(hits.schema["client"].dataType, T.StringType) else F.col("client")
    whole = hits.select(client.alias("client"), "id", F.col("at").cast("long")).where("client IS NOT NULL AND at IS NOT NULL")
    placed = cut(numbered(whole, "client", "at", "id"))
    times = cut(placed.groupBy("client", "at").agg(F.min("position").alias("position")))
    begun = starts(times.select("client", "at"), window_ms).join(times.withColumnRenamed("at", "start"), ["client", "start"])
    # a hit's window starts in the hit's slot or in the one before
    start = F.struct("start", "position").alias("own")
    slot = _slot(F.col("start"), window_ms)
    seen = begun.select("client", F.explode(F.array(slot, slot + window_ms)).alias("slot"), start, F.col("start").alias("_s"))
    by_slot = cut(seen.groupBy("client", "slot").agg(F.max(F.when(_slot(F.col("_s"), window_ms) == F.col("slot"), F.col("own"))).alias("here"), F.max(F.when(_slot(F.col("_s"), window_ms) < F.col("slot"), F.col("own"))).alias("before")))
    joined = placed.withColumn("slot", _slot(F.col("at"), window_ms)).join(small(by_slot), ["client", "slot"])
    own = F.when(F.col("here.start") <= F.col("at"), F.col("here")).otherwise(F.col("before"))
    counted = joined.withColumn("_own", own).select("client", "id", "at", (F.col("position") - F.col("_own.position") + 1).alias("n"), (F.col("_own.start") + window_ms).alias("resets_at"))
    return counted.withColumns({"limited": F.col("n") > most, "remaining": F.greatest(most - F.col("n"), F.lit(0))})
