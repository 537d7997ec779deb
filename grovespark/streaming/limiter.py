"""The limiter over a stream, with the counts of the batch query however the hits are split into micro-batches.

Hits wait in slots of time until the watermark has passed the slot's end; then
the slot's timer counts them in the order of time and id. A client's task holds
the hits of one slot at a time, and its state is the open window and the slots
that still wait: both go once the watermark is beyond them.

Hits without time are left out; those without client are of the client UNKNOWN.
A hit that comes after its slot was counted is not dropped: it counts as if it
had come at the watermark, and is marked `late`.

The session's state store must be RocksDB's (spark.sql.streaming.stateStore.providerClass),
as for any transformWithState.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..operators.limiter import MOST, UNKNOWN, WINDOW_MS, fold

SLOT_MS = 1_000
COUNTED = "client string, id long, at long, n long, resets_at long, limited boolean, remaining long, late boolean"


class Windows(StatefulProcessor):
    """Counts the hits of one client: waiting ones by slot, and the window (count, end) that is open."""

    def __init__(self, window_ms: int, most: int, slot_ms: int):
        self.window_ms, self.most, self.slot_ms = window_ms, most, slot_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.window = handle.getValueState("window", "n long, resets_at long")
        self.waiting = handle.getMapState("waiting", "slot long", "time array<long>, id array<long>, at array<long>")

    def _slots(self, times):
        return times - times % self.slot_ms

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        counted = self._slots(max(timerValues.getCurrentWatermarkInMs(), 0))  # slots before this one are done
        for hits in rows:
            hits = hits.assign(time=hits["at"].clip(lower=counted) if counted else hits["at"])
            for slot, own in hits.groupby(self._slots(hits["time"])):
                self._wait(int(slot), own)
        return iter(())

    def _wait(self, slot: int, own: pd.DataFrame) -> None:
        added = [own["time"].tolist(), [None if pd.isna(x) else int(x) for x in own["id"]], own["at"].tolist()]
        if self.waiting.containsKey((slot,)):
            added = [list(old) + new for old, new in zip(self.waiting.getValue((slot,)), added)]
        else:
            self.handle.registerTimer(slot + self.slot_ms)
        self.waiting.updateValue((slot,), tuple(added))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        done = self._slots(timerValues.getCurrentWatermarkInMs())
        for slot in sorted(s for (s,) in self.waiting.keys()):
            if slot < done:
                yield self._count(key[0], slot)
        if self.window.exists() and self.window.get()[1] <= done:
            self.window.clear()

    def _count(self, client: str, slot: int) -> pd.DataFrame:
        hits = sorted(zip(*self.waiting.getValue((slot,))), key=lambda x: (x[0], x[1] is not None, x[1]))
        self.waiting.removeKey((slot,))
        counts, ends, last = fold([time for time, _, _ in hits], tuple(self.window.get()) if self.window.exists() else None, self.window_ms)
        self.window.update(last)
        self.handle.registerTimer(self._slots(last[1] + self.slot_ms - 1))  # by then the window is over
        out = pd.DataFrame({"id": pd.array([i for _, i, _ in hits], "Int64"), "at": [at for _, _, at in hits], "n": counts, "resets_at": ends})
        out["limited"], out["remaining"] = out["n"] > self.most, (self.most - out["n"]).clip(lower=0)
        out["late"] = [at < time for time, _, at in hits]
        out.insert(0, "client", client)
        return out


def limited_stream(hits: DataFrame, window_ms: int = WINDOW_MS, most: int = MOST, lateness: str = "1 minute", slot_ms: int = SLOT_MS) -> DataFrame:
    """Rows (client, id, at, n, resets_at, limited, remaining, late). hits: a stream of (client string, id long, at long in milliseconds).

    Counts come once the watermark, which is `lateness` behind the latest hit of all clients, has passed a hit's slot.
    """
    timed = hits.where("at IS NOT NULL").withColumn("time", F.timestamp_millis("at")).withWatermark("time", lateness)
    # without the column of the watermark, so that late hits are handed on as well
    named = timed.select(F.coalesce("client", F.lit(UNKNOWN)).alias("client"), F.col("id").cast("long").alias("id"), F.col("at").cast("long").alias("at"))
    return named.groupBy("client").transformWithStateInPandas(Windows(window_ms, most, slot_ms), COUNTED, "append", "eventTime")
