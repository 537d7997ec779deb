"""Substring dedup: every word of a window that also starts elsewhere is removed.

1. Each window of WINDOW words has an anchor: the leftmost of its GRAM-word
   sequences with the least hash. Equal windows at different places have equal
   anchors at different places, so the count of an anchor is never below that
   of a window. Partitions sketch the anchors' counts (count-min); the sketches
   are merged and broadcast.
2. A second pass takes only windows whose anchor is estimated repeated. Windows
   in a row with one anchor make a run; runs are grouped exactly by a 128-bit
   hash of all their words, with partial counts before the shuffle. A run that
   occurs twice settles all its windows.
3. What is left, mostly at the edges of repeated passages, is grouped exactly
   by window, against the windows of one example of each settled run.

A document is known by its id and a hash of id and text, so null and repeated
ids do no harm: rows that agree in both have the same text and the same spans.
Hashes that very many rows share are joined by broadcast (a bounded number of
them), so no task gets all rows of one.

Defined cases: a null text has no words; a null id stays null; repeated rows
are copies of each other, and so lose whole windows; texts shorter than a
window keep all words; an empty table gives an empty result; other columns are
ignored; a text of any length is read whole; of equal least sequences in a
window the leftmost is its anchor.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import sketch
from . import textbatch as tb
from .shared import cut, join_counted

GRAM = 16
SKETCH_BITS, SKETCH_DEPTH = 26, 2
PLACE_BITS = 27
_OTHER = np.uint64(0xA24BAED4963EE407)


def anchors(h: np.ndarray, gram: int, span: int) -> tuple[np.ndarray, np.ndarray]:
    """The hash of every `gram` words, and for every `span` of these in a row where the leftmost least one is."""
    g = tb.ngram_hashes(h, gram)

    def lesser(a, b):
        n = min(len(a[0]), len(b[0]))
        first = a[0][:n] <= b[0][:n]
        return np.where(first, a[0][:n], b[0][:n]), np.where(first, a[1][:n], b[1][:n])

    whole = {1: (g, np.arange(len(g)))}
    size = 1
    while size * 2 <= span:
        v, p = whole[size]
        whole[size * 2] = lesser((v, p), (v[size:], p[size:]))
        size *= 2
    best = whole[size]
    while size < span:
        more = max(x for x in whole if x <= span - size)
        v, p = whole[more]
        best = lesser(best, (v[size:], p[size:]))
        size += more
    return g, best[1]


class Runs:
    """The runs of a chunk: first window, count of windows, anchor hash, document."""

    def __init__(self, c: tb.Chunk, window: int):
        self.words = tb.words(c)
        self.h = tb.word_hashes(c, self.words)
        n = max(len(self.h) - window + 1, 0)
        gram = min(GRAM, window)
        g, at = anchors(self.h, gram, window - gram + 1)
        i = np.flatnonzero(tb.whole_windows(self.words.offsets, window, n))
        a = at[i]
        first = np.flatnonzero(np.append(True, (a[1:] != a[:-1]) | (i[1:] != i[:-1] + 1))) if len(i) else np.zeros(0, np.int64)
        self.start = i[first]
        self.size = np.diff(np.append(first, len(i)))
        self.anchor = g[a[first]]
        self.doc = np.searchsorted(self.words.offsets, self.start, "right") - 1
        self.window = window

    def take(self, keep: np.ndarray) -> Runs:
        for x in ("start", "size", "anchor", "doc"):
            setattr(self, x, getattr(self, x)[keep])
        return self

    def window_hashes(self) -> list[np.ndarray]:
        return [tb.ngram_hashes(h, self.window) for h in (self.h, tb.mixed(self.h ^ _OTHER))]

    def run_hashes(self) -> list[np.ndarray]:
        """Of all words of a run: its first and last window cover them, as a run is no longer than a window."""
        size = self.size.astype(np.uint64)
        return [tb.joined(tb.joined(w[self.start], w[self.start + self.size - 1]), size) for w in self.window_hashes()]

    def inner(self) -> np.ndarray:
        """First windows, counted from the document's first word."""
        return self.start - self.words.offsets[self.doc]


def place_hash(key: np.ndarray, start: np.ndarray) -> np.ndarray:
    return tb.joined(key.view(np.uint64), start.astype(np.uint64))


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Rows (_id, _key, _text): the key is a hash of id and text."""
    return docs.select(F.col(id_col).alias("_id"), F.xxhash64(F.col(id_col), F.col(text_col)).alias("_key"), F.col(text_col).alias("_text"))


def repeated_spans(docs: DataFrame, window: int) -> DataFrame:
    """Rows (_id, _key, start, size): the `size` windows from word `start` on each start in two places or more. docs: as keyed()."""
    spark = docs.sparkSession
    id_type = docs.schema["_id"].dataType.simpleString()

    counts = sketch.sketched(docs.select("_text"), lambda b: (Runs(c, window).anchor for c in tb.chunks(b.column(0))), SKETCH_BITS, SKETCH_DEPTH, 2)
    estimate = spark.sparkContext.broadcast(counts)  # SKETCH_DEPTH * 2 ** SKETCH_BITS / 8 bytes

    def estimated(c: tb.Chunk) -> Runs:
        r = Runs(c, window)
        return r.take(sketch.present(estimate.value, r.anchor, SKETCH_BITS))

    def runs(batches):
        for b in batches:
            for c in tb.chunks(b.column(2)):
                r = estimated(c)
                if len(r.start):
                    one, two = r.run_hashes()
                    row = pa.array(r.doc + c.rows.start)
                    yield pa.RecordBatch.from_arrays(
                        [b.column(0).take(row), b.column(1).take(row), pa.array(r.inner().astype(np.int32)), pa.array(r.size.astype(np.int32)), pa.array(one.view(np.int64)), pa.array(two.view(np.int64))],
                        names=["_id", "_key", "start", "size", "one", "two"],
                    )

    found = cut(docs.mapInArrow(runs, f"_id {id_type}, _key long, start int, size int, one long, two long"))
    place = F.struct("_key", "start")
    same = cut(found.groupBy("one", "two").agg(F.count("*").alias("n"), F.min(place).alias("example")).withColumn("rows", F.col("n")))
    marked = cut(join_counted(found, same, ["one", "two"], "rows").select("_id", "_key", "start", "size", (F.col("n") > 1).alias("settled"), (place == F.col("example")).alias("example")))
    settled = marked.where("settled").select("_id", "_key", "start", "size")

    wanted = sketch.sketched(
        marked.where("NOT settled OR example").select("_key", "start"),
        lambda b: iter([place_hash(np.array(b.column(0)), np.array(b.column(1)))]), PLACE_BITS, 1, 1,
    )
    places = spark.sparkContext.broadcast(wanted)  # 2 ** PLACE_BITS / 8 bytes

    def windows(batches):
        for b in batches:
            key = np.array(b.column(1))
            for c in tb.chunks(b.column(2)):
                r = estimated(c)
                own = key[r.doc + c.rows.start]
                r.take(sketch.present(places.value, place_hash(own, r.inner().astype(np.int32)), PLACE_BITS))
                if not len(r.start):
                    continue
                shift = np.arange(int(r.size.sum())) - np.repeat(np.cumsum(r.size) - r.size, r.size)
                one, two = r.window_hashes()
                at = np.repeat(r.start, r.size) + shift
                row = pa.array(np.repeat(r.doc, r.size) + c.rows.start)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).take(row), b.column(1).take(row), pa.array((np.repeat(r.inner(), r.size) + shift).astype(np.int32)), pa.array(one[at].view(np.int64)), pa.array(two[at].view(np.int64))],
                    names=["_id", "_key", "start", "one", "two"],
                )

    loose = cut(docs.mapInArrow(windows, f"_id {id_type}, _key long, start int, one long, two long"))
    twice = cut(loose.groupBy("one", "two").agg(F.count("*").alias("n")).where("n > 1"))
    edges = join_counted(loose, twice, ["one", "two"], "n").select("_id", "_key", "start", F.lit(1).alias("size"))
    return settled.unionByName(edges)


def removed(docs: DataFrame, spans: DataFrame, window: int, id_col: str) -> DataFrame:
    """Rows (id, n_words, n_removed, removed, kept): the spans of removed words as (start, end), and the kept words joined by one space.

    spans: (_id, _key, start, size) of windows; docs: as keyed().
    """
    by_doc = spans.groupBy("_id", "_key").agg(F.collect_set(F.struct("start", "size")).alias("_spans"))  # equal rows have equal spans: once each, so a document's length bounds it
    d, s = docs.alias("d"), by_doc.alias("s")
    both = d.join(s, F.col("d._id").eqNullSafe(F.col("s._id")) & (F.col("d._key") == F.col("s._key")), "left").select("d._id", "d._text", "s._spans")
    id_type = docs.schema["_id"].dataType.simpleString()
    span_type = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))

    def run(batches):
        for b in batches:
            for c in tb.chunks(b.column(1)):
                totals, gone, lists, kept = [], [], [], []
                for i, spans in enumerate(b.column(2)[c.rows].to_pylist()):
                    w = c.bytes_of(i).split()
                    totals.append(len(w))
                    if not spans:
                        gone.append(0)
                        lists.append([])
                        kept.append(b" ".join(w))
                        continue
                    start = np.array([x["start"] for x in spans])
                    out = tb.covered(start, np.minimum(start + [x["size"] + window - 1 for x in spans], len(w)), len(w))
                    edge = np.flatnonzero(np.diff(np.concatenate([[0], out.astype(np.int8), [0]])))
                    gone.append(int(out.sum()))
                    lists.append([{"start": a, "end": z} for a, z in zip(edge[::2].tolist(), edge[1::2].tolist())])
                    kept.append(b" ".join([x for x, o in zip(w, out.tolist()) if not o]))
                yield pa.RecordBatch.from_arrays([b.column(0)[c.rows], pa.array(totals, pa.int64()), pa.array(gone, pa.int64()), pa.array(lists, span_type), pa.array(kept, pa.binary()).cast(pa.string())], names=["_id", "n_words", "n_removed", "removed", "kept"])

    out = both.mapInArrow(run, f"_id {id_type}, n_words long, n_removed long, removed array<struct<start:int,end:int>>, kept string")
    return out.withColumnRenamed("_id", id_col)


def dedup(docs: DataFrame, window: int = 35, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (id, n_words, n_removed, removed, kept) of all documents."""
    rows = keyed(docs, id_col, text_col)
    return removed(rows, repeated_spans(rows, window), window, id_col)
