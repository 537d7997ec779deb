"""Exact ranked search over an index of dual-sorted wavelet trees, one for each shard of documents.

A shard's postings stand term after term, each term's in descending order of
impact. A wavelet matrix over their document numbers splits the sequence level
by level by the numbers' bits, keeping the order: a node of the tree is a range
of document numbers, and each term has a stretch in it whose first posting has
the greatest impact of that term there. So the same structure is read by impact
and by document.

A query walks down from the root with all its terms at once. A node's bound is
the sum of its terms' weights times their first impacts; at a leaf, one
document, it is the score. Nodes with the greatest bounds are opened first;
those that cannot beat the k-th best so far are dropped, and that best carries
over to a task's further shards. Every shard's best k meet in a window per
query, which Spark limits before the shuffle.

Score of a document: the sum over the query's terms of w * impact, as
`weights` and `impacts` state; all in 64-bit integers.

Defined cases: null texts and texts without terms are in no list and count in
no statistic; a query without terms, or a null one, has no rows; repeated
documents are documents of their own and so are repeated queries; equal scores
go by id, null ids last; an empty table gives an empty result; other columns
are ignored; a text of any length is one unit. Terms are known by 64-bit hashes.
"""

from __future__ import annotations

import math
import uuid
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from . import textbatch as tb
from .shared import shared_folder

#: Bytes of text in a shard, but for a longer single text.
SHARD_BYTES = 8 << 20
#: Queries that are answered in one pass over the index.
BLOCK = 2_000
#: Nodes opened at once: few at first, so that a good k-th best is found early.
FIRST_NODES, MOST_NODES = 16, 1024
NO_ID = np.iinfo(np.int64).max

_BETWEEN = np.zeros(256, bool)
_BETWEEN[[*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]] = True


def impacts(tf: np.ndarray, n: np.ndarray, docs: int, total: int) -> np.ndarray:
    """A term that occurs tf times in a document of n terms, of `docs` documents with `total` terms."""
    m = 10 + (90 * n * docs) // total
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


def weights(df: np.ndarray, docs: int) -> np.ndarray:
    return np.array([math.floor(1000 * math.log((2 * docs + 2) / (2 * x + 1))) if x else 0 for x in df.tolist()], np.int64)


def terms_of(c: tb.Chunk) -> tuple[np.ndarray, tb.Words]:
    """The hash of every term of a chunk."""
    w = tb.words(c, _BETWEEN)
    return tb.word_hashes(c, w, lower=True, space=_BETWEEN), w


def statistics(docs: DataFrame, text_col: str) -> tuple[int, int]:
    """How many documents have a term, and how many terms they have."""

    def run(batches):
        for batch in batches:
            for c in tb.chunks(batch.column(0)):
                n = tb.words(c, _BETWEEN).counts()
                yield pa.RecordBatch.from_pydict({"docs": pa.array([int((n > 0).sum())], pa.int64()), "total": pa.array([int(n.sum())], pa.int64())})

    found = docs.select(text_col).mapInArrow(run, "docs long, total long").agg(F.sum("docs"), F.sum("total")).first()
    return found[0] or 0, found[1] or 0


@dataclass
class Index:
    """Shards in a table, and the statistics that they were made with."""

    spark: SparkSession
    path: str
    docs: int
    total: int

    def shards(self) -> DataFrame:
        return self.spark.read.schema(_SHARD).parquet(self.path)


_SHARD = "ids array<long>, terms binary, starts binary, impact binary, bits binary"


def shard(ids: np.ndarray, hashes: np.ndarray, doc: np.ndarray, docs: int, total: int) -> tuple:
    """The postings of some documents, numbered in the order of their ids: terms, where each one's begin, impacts by descending impact, and the tree's bits level by level."""
    order = np.argsort(ids, kind="stable")
    number = np.empty(len(ids), np.int64)
    number[order] = np.arange(len(ids))
    n = np.bincount(doc, minlength=len(ids))
    kinds, code = np.unique(hashes, return_inverse=True)
    pairs, tf = np.unique(code * len(ids) + number[doc], return_counts=True)
    term, at = np.divmod(pairs, len(ids))
    impact = impacts(tf.astype(np.int64), n[order][at], docs, total)
    by_impact = np.lexsort((at, -impact, term))
    at, impact = at[by_impact], impact[by_impact].astype(np.int32)
    starts = np.searchsorted(term, np.arange(len(kinds) + 1))
    levels = []
    for level in range(height(len(ids)) - 1, -1, -1):
        one = (at >> level) & 1 > 0
        levels.append(np.packbits(one))
        at = np.concatenate([at[~one], at[one]])
    return order, kinds, starts, impact, np.concatenate(levels) if levels else np.zeros(0, np.uint8)


def height(docs: int) -> int:
    return max(docs - 1, 0).bit_length()


def build(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None) -> Index:
    """The index of all documents, written to a new folder of the shared one unless a path is given."""
    spark = docs.sparkSession
    path = path or f"{shared_folder(spark)}/index-{uuid.uuid4().hex}"
    held, total = statistics(docs, text_col)

    def run(batches):
        for batch in batches:
            all_ids = np.asarray(batch.column(0).fill_null(NO_ID))
            for some in tb.slices(batch.column(1), SHARD_BYTES):
                found = [terms_of(c) for c in some]
                first = some[0].rows.start
                doc = np.concatenate([w.doc() + c.rows.start - first for c, (_, w) in zip(some, found)])
                ids = all_ids[first : some[-1].rows.stop]
                if len(doc):
                    order, *rest = shard(ids, np.concatenate([h for h, _ in found]), doc, held, total)
                    yield pa.RecordBatch.from_pydict({"ids": pa.array([ids[order]], pa.list_(pa.int64()))} | {k: pa.array([v.tobytes()], pa.binary()) for k, v in zip(("terms", "starts", "impact", "bits"), rest)})

    docs.select(F.col(id_col).cast("long"), text_col).mapInArrow(run, _SHARD).write.parquet(path)
    return Index(spark, path, held, total)


class Tree:
    """A shard in memory: for each level the ones before each place, and the impacts in its order."""

    def __init__(self, ids, terms, starts, impact, bits):
        self.ids = np.asarray(ids)
        self.terms, self.starts = np.frombuffer(terms, np.uint64), np.frombuffer(starts, np.int64)
        impact, n = np.frombuffer(impact, np.int32), len(impact) // 4
        h, width = height(len(self.ids)), (n + 7) // 8
        self.height = h
        self.ones, self.impact, self.zeros = np.zeros((max(h, 1), n + 1), np.int32), np.empty((h + 1, n + 1), np.int32), np.zeros(max(h, 1), np.int32)
        self.impact[:, n] = 0
        self.impact[0, :n] = impact
        raw = np.frombuffer(bits, np.uint8)
        for k in range(h):
            one = np.unpackbits(raw[k * width : (k + 1) * width], count=n).astype(bool)
            np.cumsum(one, out=self.ones[k, 1:])
            self.zeros[k] = n - self.ones[k, n]
            self.impact[k + 1, : self.zeros[k]] = self.impact[k, :n][~one]
            self.impact[k + 1, self.zeros[k] : n] = self.impact[k, :n][one]

    def stretches(self, asked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where the postings of the asked terms begin and end."""
        at = np.minimum(np.searchsorted(self.terms, asked), len(self.terms) - 1)
        here = self.terms[at] == asked
        return np.where(here, self.starts[at], 0).astype(np.int32), np.where(here, self.starts[at + 1], 0).astype(np.int32)


@dataclass
class Best:
    """The k best documents of a query so far, best first."""

    k: int
    score: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    id: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))

    def add(self, score: np.ndarray, ids: np.ndarray) -> None:
        score, ids = np.append(self.score, score), np.append(self.id, ids)
        order = np.lexsort((ids, -score))[: self.k]
        self.score, self.id = score[order], ids[order]

    def may_enter(self, bound: np.ndarray, least_id: np.ndarray) -> np.ndarray:
        if len(self.score) < self.k:
            return bound > 0
        return (bound > self.score[-1]) | ((bound == self.score[-1]) & (least_id <= self.id[-1]))


def best_first(tree: Tree, lo: np.ndarray, hi: np.ndarray, w: np.ndarray, best: Best) -> None:
    """Put what the tree has for one query into best. lo, hi, w: the stretches and weights of its terms."""
    some = (hi > lo) & (w > 0)
    lo, hi, w = lo[some], hi[some], w[some]
    if not len(w):
        return
    lo, hi, level, prefix = lo[None], hi[None], np.zeros(1, np.int64), np.zeros(1, np.int64)
    bound, most = tree.impact[0, lo].astype(np.int64) @ w, FIRST_NODES
    while len(bound):
        if len(bound) > most:
            chosen = np.zeros(len(bound), bool)
            chosen[np.argpartition(-bound, most)[:most]] = True
        else:
            chosen = np.ones(len(bound), bool)
        rest = ~chosen
        l, r, d, p = lo[chosen], hi[chosen], level[chosen], prefix[chosen]
        leaf = d == tree.height
        if leaf.any():
            best.add(bound[chosen][leaf], tree.ids[p[leaf]])
            l, r, d, p = l[~leaf], r[~leaf], d[~leaf], p[~leaf]
        before, until = tree.ones[d[:, None], l], tree.ones[d[:, None], r]
        zeros = tree.zeros[d][:, None]
        l, r = np.concatenate([l - before, zeros + before]), np.concatenate([r - until, zeros + until])
        d, p = np.tile(d + 1, 2), np.concatenate([2 * p, 2 * p + 1])
        new = np.where(r > l, tree.impact[d[:, None], l], 0).astype(np.int64) @ w
        lo, hi, level, prefix, bound = np.concatenate([lo[rest], l]), np.concatenate([hi[rest], r]), np.concatenate([level[rest], d]), np.concatenate([prefix[rest], p]), np.concatenate([bound[rest], new])
        first = np.minimum(prefix << (tree.height - level), len(tree.ids) - 1)
        keep = (bound > 0) & best.may_enter(bound, tree.ids[first])
        lo, hi, level, prefix, bound = lo[keep], hi[keep], level[keep], prefix[keep], bound[keep]
        most = min(2 * most, MOST_NODES)


def _blocks(items: DataFrame, id_col: str, text_col: str):
    """Lists of (id, distinct term hashes) of up to BLOCK queries that have terms."""
    held = []
    for item, text in items.select(id_col, text_col).toLocalIterator():
        (c,) = tb.chunks(pa.array([text], pa.string()))
        found = np.unique(terms_of(c)[0])
        if len(found):
            held.append((item, found))
        if len(held) == BLOCK:
            yield held
            held = []
    if held:
        yield held


def frequencies(index: Index, terms: np.ndarray) -> np.ndarray:
    """How many documents hold each of the terms (sorted, distinct)."""

    def run(batches):
        for batch in batches:
            total = np.zeros(len(terms), np.int64)
            for own, starts in zip(batch.column(0), batch.column(1)):
                own, n = np.frombuffer(own.as_buffer(), np.uint64), np.diff(np.frombuffer(starts.as_buffer(), np.int64))
                at = np.minimum(np.searchsorted(own, terms), len(own) - 1)
                total += np.where(own[at] == terms, n[at], 0)
            some = np.flatnonzero(total)
            yield pa.RecordBatch.from_pydict({"at": pa.array(some), "df": pa.array(total[some])})

    out = np.zeros(len(terms), np.int64)
    for at, df in index.shards().select("terms", "starts").mapInArrow(run, "at long, df long").groupBy("at").agg(F.sum("df")).collect():
        out[at] = df
    return out


def search(index: Index, items: DataFrame, k: int, id_col: str = "item_id", text_col: str = "text", doc_col: str = "doc_id") -> DataFrame:
    """Rows (item id, rank, doc id, score): the k documents with the greatest scores above 0 for each query, from 1. Queries are answered in blocks of BLOCK."""
    spark = index.spark
    names = f"{id_col} {items.schema[id_col].dataType.simpleString()}"
    out = spark.createDataFrame([], f"{names}, rank int, {doc_col} long, score long")
    for held in _blocks(items, id_col, text_col):
        terms = np.unique(np.concatenate([x for _, x in held]))
        w = weights(frequencies(index, terms), index.docs)
        asked = [np.searchsorted(terms, x) for _, x in held]

        def run(batches):
            found = [Best(k) for _ in asked]
            for batch in batches:
                for row in batch.to_pylist() if batch.num_rows == 1 else (r for i in range(batch.num_rows) for r in batch.slice(i, 1).to_pylist()):
                    tree = Tree(**row)
                    lo, hi = tree.stretches(terms)
                    for own, best in zip(asked, found):
                        best_first(tree, lo[own], hi[own], w[own], best)
            n = [len(b.score) for b in found]
            ids = np.concatenate([b.id for b in found])
            yield pa.RecordBatch.from_pydict({"item": pa.array(np.repeat(np.arange(len(found)), n)), "doc": pa.array(ids, pa.int64(), mask=ids == NO_ID), "score": pa.array(np.concatenate([b.score for b in found]))})

        order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc"))
        best = index.shards().mapInArrow(run, "item long, doc long, score long").withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        numbered = spark.createDataFrame([(i, item) for i, (item, _) in enumerate(held)], f"item long, {names}")
        out = out.union(best.join(F.broadcast(numbered), "item").select(id_col, "rank", F.col("doc").alias(doc_col), "score"))
    return out
