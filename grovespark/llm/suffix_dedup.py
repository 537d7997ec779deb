"""Sparse suffix-array dedup: passages of MATCH words or more that occur twice.

Suffixes start only at minimisers: in every MATCH words the leftmost GRAM-word
sequence with the least hash. Any repeated passage of MATCH words has one, at
the same place in each of its copies. Each kept suffix carries hashes of the
MATCH words from it on and of the words before it that a match can need.

1. Minimisers that occur once can have no match. Partition sketches of their
   counts, merged and broadcast, drop most of them.
2. Suffixes with equal words on both sides are counted by a 128-bit hash, with
   partial counts before the shuffle; if they are two or more, all they carry
   matches. One example of each goes on, so no group of copies is ever sorted.
3. The examples are range-partitioned and sorted by the words from the suffix
   on, then by those before it, nearest first. Each is compared with its NEAR
   neighbours on either side, and the common stretch is extended to the right
   and to the left. If it has MATCH words, it is a match.
4. Suffixes that begin with the same GRAM words are partners. Where they are
   more than the neighbours compared, or reach a partition's border, their
   windows of MATCH words are grouped exactly by a 128-bit hash and their place
   around the suffix. No suffix shares more words to the right with any other
   than with one next to it in the order, so only windows that need no more
   words to the right than that are hashed, and only those whose minimiser the
   suffix is. A suffix asks for those that would reach further than its
   neighbours did; a bitmap of what is asked for drops most of the others
   before they are grouped.

A long passage has many minimisers, whose matches together cover it. All copies
of a passage are marked, wherever the partitions' borders fall.

Defined cases: as in `substrings`: null texts have no words, repeated rows are
copies of each other, rows are known by id and a hash of id and text, texts of
any length are read whole, and of equal least sequences the leftmost counts.
"""

from __future__ import annotations

from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import sketch
from . import textbatch as tb
from .shared import cut, join_counted
from .substrings import GRAM, PLACE_BITS, SKETCH_BITS, SKETCH_DEPTH, anchors, keyed, place_hash, removed

MATCH = 50
NEAR = 4


class Suffixes:
    """The minimisers of a chunk, and the words around them as 32-bit hashes (0: beyond the document)."""

    def __init__(self, c: tb.Chunk, match: int):
        self.match = match
        self.words = tb.words(c)
        h = tb.word_hashes(c, self.words)
        self.h = h
        gram = min(GRAM, match)
        self.before = match - gram
        g, at = anchors(h, gram, self.before + 1)
        n = max(len(h) - match + 1, 0)
        ok = np.flatnonzero(tb.whole_windows(self.words.offsets, match, n))
        self.at, first, size = np.unique(at[ok], return_index=True, return_counts=True)
        self.most = (self.at - ok[first]).astype(np.int32)  # words before the minimiser in the first and the last window that has it
        self.least = self.most - size.astype(np.int32) + 1
        self.anchor = g[self.at]
        self.doc = np.searchsorted(self.words.offsets, self.at, "right") - 1

    def take(self, keep: np.ndarray) -> None:
        for x in ("at", "anchor", "doc", "least", "most"):
            setattr(self, x, getattr(self, x)[keep])

    def inner(self) -> np.ndarray:
        """The minimisers' words, counted from their document's first."""
        return (self.at - self.words.offsets[self.doc]).astype(np.int32)

    @staticmethod
    def hashes(right: np.ndarray, left: np.ndarray) -> list[np.ndarray]:
        """Two 64-bit hashes of all words around each suffix."""
        out = []
        for seed in (1, 2):
            h = np.full(len(right), seed, np.uint64)
            for column in (*right.T, *left.T):
                h = tb.joined(h, column.astype(np.uint64))
            out.append(h)
        return out

    def around(self) -> tuple[np.ndarray, np.ndarray]:
        """The words from each suffix on, and the words before it, nearest first; big-endian, so that bytes sort as numbers."""
        short = (self.h >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
        first, last = self.words.offsets[self.doc][:, None], self.words.offsets[self.doc + 1][:, None]

        def words(at: np.ndarray) -> np.ndarray:
            return np.where((at >= first) & (at < last), short[np.clip(at, 0, max(len(short) - 1, 0))], 0).astype(">u4")

        right = words(self.at[:, None] + np.arange(self.match))
        left = words(self.at[:, None] - 1 - np.arange(self.before)) if self.before else np.zeros((len(self.at), 0), ">u4")
        return right, left


def _fixed(rows: np.ndarray) -> pa.Array:
    flat = np.ascontiguousarray(rows)
    return pa.array([x.tobytes() for x in flat], pa.binary())


def _shared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many words the rows of a and b share from their start; zeros match nothing."""
    if not a.shape[1]:
        return np.zeros(len(a), np.int32)
    differ = (a != b) | (a == 0)
    return np.where(differ.any(1), differ.argmax(1), a.shape[1]).astype(np.int32)


def extents(right: list[bytes], left: list[bytes], match: int) -> tuple[np.ndarray, np.ndarray]:
    """For each of some sorted suffixes, how far its matches with its neighbours reach to the left and to the right (0, 0: none)."""
    n = len(right)
    lefts, rights = np.zeros(n, np.int32), np.zeros(n, np.int32)
    if n > 1:
        r, le = (np.frombuffer(b"".join(x), ">u4").reshape(n, -1) for x in (right, left))
        for away in range(1, min(NEAR, n - 1) + 1):
            common_r, common_l = _shared(r[away:], r[:-away]), _shared(le[away:], le[:-away])
            good = common_r + common_l >= match
            for side in (slice(away, None), slice(None, -away)):
                rights[side] = np.maximum(rights[side], np.where(good, common_r, 0))
                lefts[side] = np.maximum(lefts[side], np.where(good, common_l, 0))
    return lefts, rights


def left_open(right: list[bytes], left: list[bytes], match: int, own: slice, first: bool, final: bool, lefts: np.ndarray, rights: np.ndarray, least: np.ndarray, most: np.ndarray) -> tuple[np.ndarray, ...]:
    """Windows of `match` words that neighbours do not settle: the suffix each is around, its words before the suffix, two hashes, whether it would reach further.

    The suffixes are sorted; only those in `own` are asked for, and NEAR + 1 more stand on either side but at the
    partition's borders. first, final: whether the first and the last one are next to a border. lefts, rights: what
    neighbours reached. least, most: the words before the suffix in the windows whose minimiser it is.
    """
    r, le = (np.frombuffer(b"".join(x), ">u4").reshape(len(right), -1) for x in (right, left))
    gram, before = min(GRAM, match), le.shape[1]
    shared = _shared(r[1:], r[:-1])
    common = np.maximum(np.append(match if first else 0, shared), np.append(shared, match if final else 0))
    common = np.minimum(common, (r != 0).sum(1))
    group = np.cumsum(np.append(0, shared < gram))
    many = np.bincount(group) > NEAR + 1
    many[group[0]] |= first
    many[group[-1]] |= final
    at = np.arange(len(r))[own]
    at = at[many[group[at]]]
    low = np.maximum(match - common[at], least[at])
    n = np.maximum(np.minimum((le[at] != 0).sum(1), most[at]) - low + 1, 0)
    at, low, n = at[n > 0], low[n > 0], n[n > 0]
    k = np.repeat(low, n) + np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
    words = np.concatenate([le[at][:, ::-1], r[at]], 1).astype(np.uint64)
    start = np.repeat(np.arange(len(at)) * words.shape[1] + before, n) - k
    one, two = (tb.ngram_hashes(tb.mixed(words.ravel() + np.uint64(seed)), match)[start] if len(at) else np.zeros(0, np.uint64) for seed in (1 << 32, 1 << 33))
    row = np.repeat(at, n)
    return row, k.astype(np.int32), tb.joined(one, k.astype(np.uint64)), tb.joined(two, k.astype(np.uint64)), (k > lefts[row]) | (match - k > rights[row])


def matches(docs: DataFrame, match: int) -> DataFrame:
    """Rows (_id, _key, start, size): `size` windows of `match` words from word `start` on occur twice or more. docs: as keyed()."""
    spark = docs.sparkSession
    id_type = docs.schema["_id"].dataType.simpleString()
    counts = sketch.sketched(docs.select("_text"), lambda b: (Suffixes(c, match).anchor for c in tb.chunks(b.column(0))), SKETCH_BITS, SKETCH_DEPTH, 2)
    estimate = spark.sparkContext.broadcast(counts)  # SKETCH_DEPTH * 2 ** SKETCH_BITS / 8 bytes

    def estimated(c: tb.Chunk) -> Suffixes:
        s = Suffixes(c, match)
        s.take(sketch.present(estimate.value, s.anchor, SKETCH_BITS))
        return s

    def found_in(batches):
        for b in batches:
            for c in tb.chunks(b.column(2)):
                s = estimated(c)
                if len(s.at):
                    right, left = s.around()
                    row = pa.array(s.doc + c.rows.start)
                    h = [x.view(np.int64) for x in s.hashes(right, left)]
                    yield pa.RecordBatch.from_arrays(
                        [b.column(0).take(row), b.column(1).take(row), *map(pa.array, (s.inner(), (left != 0).sum(1).astype(np.int32), (right != 0).sum(1).astype(np.int32), *h))],
                        names=["_id", "_key", "at", "lefts", "rights", "one", "two"],
                    )

    found = cut(docs.mapInArrow(found_in, f"_id {id_type}, _key long, at int, lefts int, rights int, one long, two long"))
    place = F.struct("_key", "at")
    same = cut(found.groupBy("one", "two").agg(F.count("*").alias("n"), F.min(place).alias("example")).withColumn("rows", F.col("n")))
    marked = cut(join_counted(found, same, ["one", "two"], "rows").withColumns({"settled": F.col("n") > 1, "example": place == F.col("example")}))
    examples = sketch.sketched(
        marked.where("example").select("_key", "at"), lambda b: iter([place_hash(np.array(b.column(0)), np.array(b.column(1)))]), PLACE_BITS, 1, 1
    )
    places = spark.sparkContext.broadcast(examples)  # 2 ** PLACE_BITS / 8 bytes

    def suffixes(batches):
        for b in batches:
            key = np.array(b.column(1))
            for c in tb.chunks(b.column(2)):
                s = estimated(c)
                s.take(sketch.present(places.value, place_hash(key[s.doc + c.rows.start], s.inner()), PLACE_BITS))
                if len(s.at):
                    right, left = s.around()
                    h = [x.view(np.int64) for x in s.hashes(right, left)]
                    yield pa.RecordBatch.from_arrays([pa.array(h[0]), pa.array(h[1]), _fixed(right), _fixed(left), pa.array(s.least), pa.array(s.most)], names=["one", "two", "right", "left", "least", "most"])

    def compare(batches):
        rows, done, first = [], 0, True  # done: of the rows held, those that are only there for the ones after them
        for b in chain(batches, [None]):
            final = b is None
            if not final:
                rows += zip(*(b.column(i).to_pylist() for i in range(6)))
            upto = len(rows) if final else len(rows) - NEAR - 1
            if upto <= done:
                continue
            right, left = [x[2] for x in rows], [x[3] for x in rows]
            lefts, rights = extents(right, left, match)
            hit = np.flatnonzero(lefts + rights >= match)
            yield _reached([rows[i] for i in hit], lefts[hit], rights[hit])
            least, most = (np.array([x[i] for x in rows]) for i in (4, 5))
            at, k, *window = left_open(right, left, match, slice(done, upto), first, final, lefts, rights, least, most)
            yield _reached([rows[i] for i in at], k, match - k, *window)
            gone = max(0, upto - NEAR - 1)
            rows, done, first = rows[gone:], upto - gone, first and not gone

    ordered = docs.mapInArrow(suffixes, "one long, two long, right binary, left binary, least int, most int").repartitionByRange("right", "left").sortWithinPartitions("right", "left", "one", "two")
    reached = cut(ordered.mapInArrow(compare, "one long, two long, lefts int, rights int, window long, window_too long, asked boolean"))
    by_neighbour = reached.where("window IS NULL").select("one", "two", "lefts", "rights")
    asked = reached.where("asked")
    hashes = lambda b: iter([np.array(b.column(0)).view(np.uint64)])
    sought = spark.sparkContext.broadcast(sketch.sketched(asked.select("window"), hashes, PLACE_BITS, 1, 1))  # 2 ** PLACE_BITS / 8 bytes

    def met(batches):
        for b in batches:
            yield b.filter(pa.array(sketch.present(sought.value, np.array(b.column(0)).view(np.uint64), PLACE_BITS)))

    window = ["window", "window_too"]
    loose = reached.where("window IS NOT NULL").select(*window).mapInArrow(met, "window long, window_too long")
    twice = cut(loose.groupBy(*window).agg(F.count("*").alias("n")).where("n > 1"))
    by_window = join_counted(asked.select(*window, "one", "two", "lefts", "rights"), twice, window, "n").select("one", "two", "lefts", "rights")
    reach = by_neighbour.union(by_window).groupBy("one", "two").agg(F.max("lefts").alias("lefts"), F.max("rights").alias("rights"))
    reach = cut(reach.join(same.select("one", "two", "rows"), ["one", "two"]))
    own = marked.where(F.col("settled") & (F.col("lefts") + F.col("rights") >= match)).select("_id", "_key", "at", "lefts", "rights")
    other = join_counted(marked.select("_id", "_key", "at", "one", "two"), reach, ["one", "two"], "rows").select("_id", "_key", "at", "lefts", "rights")
    return own.union(other).select("_id", "_key", (F.col("at") - F.col("lefts")).alias("start"), (F.col("lefts") + F.col("rights") - match + 1).alias("size"))


def _reached(rows: list[tuple], lefts: np.ndarray, rights: np.ndarray, *window: np.ndarray) -> pa.RecordBatch:
    hashes = [pa.array(x.view(np.int64)) for x in window[:2]] or [pa.nulls(len(rows), pa.int64())] * 2
    asked = pa.array(window[2]) if window else pa.nulls(len(rows), pa.bool_())
    return pa.RecordBatch.from_arrays(
        [pa.array([x[0] for x in rows], pa.int64()), pa.array([x[1] for x in rows], pa.int64()), pa.array(lefts, pa.int32()), pa.array(rights, pa.int32()), *hashes, asked],
        names=["one", "two", "lefts", "rights", "window", "window_too", "asked"],
    )


def dedup(docs: DataFrame, match: int = MATCH, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (id, n_words, n_removed, removed, kept) of all documents: as in `substrings`, for the matches found here."""
    rows = keyed(docs, id_col, text_col)
    return removed(rows, matches(rows, match), match, id_col)
