"""Language-model scores from a log-frequency Bloom filter, beside exact add-one unigram scores.

Learning. Each partition counts the hashes of its training n-grams (one to
ORDERS words) and sends them on sorted, as differences; Spark groups them by
bucket and adds the counts up. There is a bucket for every BUCKET_BYTES of
text, so buckets do not grow with the corpus. A count is quantised to the
number of THRESHOLDS that it reaches; the filter holds the pairs (n-gram, 1) ..
(n-gram, level) of every n-gram of the training texts, BITS_EACH bits for each
pair, and so grows with the corpus. All pairs of an n-gram lie in one block of
512 bits of its bucket's slice, each pair in one 64-bit word.

Scoring. An n-gram's level is found by probing (n-gram, 1), (n-gram, 2), ...
until one is absent. With q the least and C the greatest count of a level,

    P1(w)     = (q(w) + 1) / (sum of q over the vocabulary + V + 1)
    P(w|u)    = WEIGHTS[2] * (q(u w) - DISCOUNT) / C(u) + (1 - WEIGHTS[2]) * P1(w)
    P(w|t,u)  = WEIGHTS[3] * (q(t u w) - DISCOUNT) / C(t u) + (1 - WEIGHTS[3]) * P(w|u)

where a context that was never seen leaves all weight to the shorter one.

The filter is broadcast if it has at most BROADCAST_BYTES. A larger one stays a
table of slices, PART_BUCKETS of an order to a part: every chunk of SENT_BYTES
of text sends its distinct n-grams to the parts, sorted and as differences, and
gets back a byte for each, so the scores are the same.

The exact unigram counts for the base score: words whose count lies above a
limit, FREQUENT of them at most, come from a broadcast table; all others by a
join.

Tokens are words in lower case (A-Z only), then one end token per text.

Defined cases: a null text is only an end token; a null id counts as the empty
string for the fold and stays null; repeated rows count as often as they occur;
an empty table gives an empty result; with no training text N and V are 0;
other columns are ignored; a text of any length is one unit; there are no ties.
"""

from __future__ import annotations

import os
from math import ceil, log2

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import textbatch as tb
from .shared import cut, shuffled

FOLDS, HELD_OUT = 7, 2
ORDERS = 3
LOG_BASE = 1.4
WEIGHTS = {2: 0.5, 3: 0.6}
DISCOUNT = 0.75
BITS_EACH = 10
BLOCK_BITS, PROBES = 512, 4
BUCKET_BYTES = 8 << 20
#: Of the filter's parts and the chunks of text that are sent to them: neither grows with the input.
PART_BUCKETS, SENT_BYTES, ASKED_AT_ONCE = 8, 8 << 20, 2_000_000
BROADCAST_BYTES = 256 << 20
FREQUENT = 500_000
END, START = np.uint64(0x5851F42D4C957F2D), np.uint64(0x14057B7EF767814F)
#: Bits of an n-gram's hash; a word's hash keeps all 64, as the exact counts go by it.
KEPT = 48
#: The least count of each level: whole numbers that grow by LOG_BASE.
THRESHOLDS = np.unique(np.ceil(LOG_BASE ** np.arange(125) - 1e-9)).astype(np.int64)


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % FOLDS == HELD_OUT


class Tokens:
    """Token hashes of a chunk, an end after each text, and where each text's begin."""

    def __init__(self, c: tb.Chunk):
        w = tb.words(c)
        self.h = np.insert(tb.word_hashes(c, w, lower=True), w.offsets[1:], END)
        self.offsets = w.offsets + np.arange(len(w.offsets))

    def grams(self) -> list[np.ndarray]:
        """For each order the hash of the n-gram that ends at each token."""
        begin = self.offsets[:-1]
        out, longer = [tb.mixed(self.h + np.uint64(1))], self.h
        for order in range(2, ORDERS + 1):  # START stands before a text as often as it takes
            before = np.append(START, longer[:-1])
            before[begin] = START
            longer = tb.joined(before, self.h)
            out.append(tb.mixed(longer + np.uint64(order)) >> np.uint64(64 - KEPT) << np.uint64(64 - KEPT))
        return out


def level_of(count: np.ndarray) -> np.ndarray:
    return np.searchsorted(THRESHOLDS, count, "right")


def least_count(level: np.ndarray) -> np.ndarray:
    """0 for level 0."""
    return np.append(0, THRESHOLDS)[level]


def greatest_count(level: np.ndarray) -> np.ndarray:
    """0 for level 0."""
    return np.append(0, THRESHOLDS[1:] - 1)[level]


def _counted(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    values = np.sort(values)
    first = np.flatnonzero(np.append(True, values[1:] != values[:-1])) if len(values) else np.zeros(0, np.int64)
    return values[first], np.diff(np.append(first, len(values)))


def _added(values: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(values)
    values, counts = values[order], counts[order]
    first = np.flatnonzero(np.append(True, values[1:] != values[:-1])) if len(values) else np.zeros(0, np.int64)
    return values[first], np.add.reduceat(counts, first) if len(first) else counts


def _pressed(raw) -> bytes:
    """Compressed bytes; their size before leads."""
    return memoryview(raw).nbytes.to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def _unpressed(packed: bytes) -> bytes:
    n = int.from_bytes(packed[:8], "little")
    return pa.decompress(packed[8:], decompressed_size=n, codec="zstd", asbytes=True) if n else b""


def _planes(x: np.ndarray) -> bytes:
    """Whole numbers in planes of bytes, compressed."""
    return _pressed(np.ascontiguousarray(x.astype("<u8").view(np.uint8).reshape(-1, 8).T))


def _packed(values: np.ndarray, counts: np.ndarray) -> tuple[bytes, bytes]:
    """Sorted values as differences, and counts."""
    return _planes(np.diff(values, prepend=np.uint64(0))), _planes(counts)


def _wide(packed: bytes) -> np.ndarray:
    raw = _unpressed(packed)
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(8, -1).T).view("<u8").ravel()


def _unpacked(values: bytes, counts: bytes) -> tuple[np.ndarray, np.ndarray]:
    return np.cumsum(_wide(values), dtype=np.uint64), _wide(counts).astype(np.int64)


def gram_counts(train: DataFrame) -> DataFrame:
    """Rows (order, bucket, grams, counts, pairs, q): exact counts of the hashes of n-grams, packed, and the sums of their levels and of those levels' least counts. train: (text)."""
    size = train.agg(F.sum(F.octet_length(train.columns[0]))).first()[0] or 0
    bits = max(6, ceil(log2(max(size, 1) / BUCKET_BYTES)))

    def run(batches):
        held, n = [[] for _ in range(ORDERS)], 0
        for b in batches:
            for c in tb.chunks(b.column(0)):
                for own, g in zip(held, Tokens(c).grams()):
                    own.append(g)
                    n += len(g)
                if n > 5_000_000:
                    yield from flushed(held)
                    held, n = [[] for _ in range(ORDERS)], 0
        yield from flushed(held)

    def flushed(held):
        for order, own in enumerate(held, 1):
            if own:
                g, n = _counted(np.concatenate(own))
                own.clear()
                bucket = (g >> np.uint64(64 - bits)).astype(np.int64)
                at = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1]))
                rows = [_packed(x, y) for x, y in zip(np.split(g, at[1:]), np.split(n, at[1:]))]
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), order)), pa.array(bucket[at]), pa.array([x for x, _ in rows], pa.binary()), pa.array([y for _, y in rows], pa.binary())], names=["order", "bucket", "grams", "counts"])

    def merge(group: pd.DataFrame) -> pd.DataFrame:
        g, n = map(np.concatenate, zip(*map(_unpacked, group["grams"], group["counts"])))
        g, n = _added(g, n)
        level = level_of(n)
        values, counts = _packed(g, n)
        return pd.DataFrame({"order": group["order"].iloc[:1], "bucket": group["bucket"].iloc[:1], "grams": [values], "counts": [counts], "pairs": [int(level.sum())], "q": [int(least_count(level).sum())]})

    schema = "order long, bucket long, grams binary, counts binary"
    return train.mapInArrow(run, schema).groupBy("order", "bucket").applyInPandas(merge, schema + ", pairs long, q long").withColumn("bits", F.lit(bits))


class Shape:
    """How the filter is laid out: buckets of each order, blocks of a slice by order, the highest level of any n-gram."""

    def __init__(self, bits: int, pairs: list[int], top: int):
        self.bits, self.top = bits, top
        self.blocks = [max(1, ceil(p * BITS_EACH / BLOCK_BITS / 2**bits)) for p in pairs]
        self.words = [n * (BLOCK_BITS // 64) for n in self.blocks]
        self.begin = np.append(0, np.cumsum([n << bits for n in self.words]))  # in words, by order

    def bytes(self) -> int:
        return int(self.begin[-1]) * 8

    def bucket(self, grams: np.ndarray) -> np.ndarray:
        return (grams >> np.uint64(64 - self.bits)).astype(np.int64)

    def by_part(self, grams: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
        """The parts that sorted n-grams fall in, and those of each."""
        part = self.bucket(grams) // PART_BUCKETS
        at = np.flatnonzero(np.append(True, part[1:] != part[:-1]))
        return part[at], np.split(grams, at[1:])

    def block(self, grams: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
        """A hash of each n-gram, and the first word of its block in its slice."""
        h = tb.mixed(grams + np.uint64(0x2545F4914F6CDD1D * order % 2**64))
        return h, ((h >> np.uint64(32)) * np.uint64(self.blocks[order - 1]) >> np.uint64(32)).astype(np.int64) * (BLOCK_BITS // 64)

    @staticmethod
    def places(h: np.ndarray, level: int) -> tuple[np.ndarray, list[np.ndarray]]:
        """The word of the block, and the PROBES bits in it, for (n-gram, level)."""
        m = tb.mixed(h + np.uint64(level * 0x9E3779B97F4A7C15 % 2**64))
        return (m & np.uint64(7)).astype(np.int64), [(m >> np.uint64(8 + 6 * i)) & np.uint64(63) for i in range(PROBES)]

    def levels(self, words: np.ndarray, slice_begin: np.ndarray | int, grams: np.ndarray, order: int) -> np.ndarray:
        """The highest level that is present with all below it. slice_begin: where each n-gram's slice starts in words."""
        out = np.zeros(len(grams), np.int64)
        h, at = self.block(grams, order)
        at += slice_begin
        live = np.arange(len(grams))
        for level in range(1, self.top + 1):
            word, bits = self.places(h, level)
            mask = np.uint64(1) << bits[0]
            for b in bits[1:]:
                mask |= np.uint64(1) << b
            there = np.flatnonzero(words[at + word] & mask == mask)
            live, h, at = live[there], h[there], at[there]
            if not len(live):
                break
            out[live] = level
        return out

    def filled(self, grams: np.ndarray, counts: np.ndarray, order: int) -> bytes:
        """The slice of one bucket."""
        flags = np.zeros(self.words[order - 1] * 64, bool)
        level = level_of(counts)
        h, at = self.block(grams, order)
        for k in range(1, int(level.max(initial=0)) + 1):
            live = level >= k
            h, at, level = h[live], at[live], level[live]
            word, bits = self.places(h, k)
            for b in bits:
                flags[(at + word) * 64 + b.astype(np.int64)] = True
        return np.packbits(flags, bitorder="little").tobytes()


class Filter:
    """The whole filter in memory."""

    def __init__(self, shape: Shape, words: np.ndarray):
        self.shape, self.words = shape, words

    def levels(self, grams: np.ndarray, order: int) -> np.ndarray:
        s = self.shape
        return s.levels(self.words, s.begin[order - 1] + s.bucket(grams) * s.words[order - 1], grams, order)


def filter_slices(counts: DataFrame) -> tuple[Shape, DataFrame, float]:
    """The filter's shape, its slices as rows (order, bucket, words), and the sum of q over the vocabulary. counts: as gram_counts, cut."""

    def tops(batches):
        for b in batches:
            for n in b.column(0).to_pylist():
                yield pa.RecordBatch.from_pydict({"top": [int(_wide(n).max(initial=0))]})

    by_order = {r["order"]: r for r in counts.groupBy("order").agg(F.sum("pairs").alias("pairs"), F.sum(F.col("q").cast("decimal(38,0)")).alias("q"), F.max("bits").alias("bits")).collect()}  # ORDERS rows
    top = counts.where("order = 1").select("counts").mapInArrow(tops, "top long").agg(F.max("top")).first()[0] or 1  # no n-gram is more frequent than its words
    shape = Shape(max((r.bits for r in by_order.values()), default=6), [by_order[k].pairs if k in by_order else 0 for k in range(1, ORDERS + 1)], int(level_of(top)))

    def slices(batches):
        for b in batches:
            for order, bucket, g, n in zip(*(b.column(i).to_pylist() for i in range(4))):
                yield pa.RecordBatch.from_pydict({"order": [order], "bucket": [bucket], "words": pa.array([shape.filled(*_unpacked(g, n), order)], pa.binary())})

    return shape, counts.select("order", "bucket", "grams", "counts").mapInArrow(slices, "order long, bucket long, words binary"), float(by_order[1].q if 1 in by_order else 0)


def collected(shape: Shape, slices: DataFrame) -> Filter:
    """The filter in the driver's memory; only for one of at most BROADCAST_BYTES."""
    words = np.zeros(int(shape.begin[-1]), np.uint64)
    for order, bucket, raw in slices.toLocalIterator():
        own = np.frombuffer(raw, np.uint64)
        at = int(shape.begin[order - 1]) + bucket * shape.words[order - 1]
        words[at : at + len(own)] = own
    return Filter(shape, words)


class Scorer:
    """What every task needs besides the filter: the frequent words' exact counts and the model's totals."""

    def __init__(self, often_h: np.ndarray, often_c: np.ndarray, below: float, texts: int):
        order = np.argsort(often_h)
        self.often_h, self.often_c = np.append(often_h[order], np.uint64(2**64 - 1)), np.append(often_c[order], 0)
        self.below, self.texts = below, texts

    def log_p(self, grams: list[np.ndarray], begin: np.ndarray, levels) -> np.ndarray:
        """log10 of each token's probability. levels(n-grams, order): their levels."""
        code, words = pd.factorize(grams[0])
        level = levels(words, 1)[code]
        p = (least_count(level) + 1) / self.below
        for order in range(2, ORDERS + 1):
            context = np.append(0, greatest_count(level)[:-1])
            context[begin] = self.texts
            level = levels(grams[order - 1], order)
            share = np.minimum(np.maximum(least_count(level) - DISCOUNT, 0) / np.maximum(context, 1), 1)
            p = np.where(context > 0, WEIGHTS[order] * share + (1 - WEIGHTS[order]) * p, p)
        return np.log10(p)

    def scored(self, t: Tokens, grams: list[np.ndarray], levels) -> list[pa.Array]:
        """Columns n_tokens, n_often, whole, part, score, rare, times of the texts of t, whose n-grams are `grams`."""
        begin = t.offsets[:-1]
        code, h = pd.factorize(grams[0])
        at = np.searchsorted(self.often_h, h)
        known = np.where(self.often_h[at] == h, self.often_c[at], 0)

        def summed(x):
            return np.add.reduceat(x, begin)

        logs = np.round(np.log10(known + 1.0) * 1e15).astype(np.int64)[code]  # exact sums, in any order
        rare = np.flatnonzero((known == 0)[code])
        doc = np.searchsorted(t.offsets, rare, "right") - 1
        pair, times = np.unique(doc * np.int64(len(h)) + code[rare], return_counts=True)
        lists = pa.array(np.searchsorted(pair, np.arange(len(t.offsets)) * np.int64(len(h))).astype(np.int32))
        return [
            pa.array(np.diff(t.offsets)), pa.array(summed((known > 0)[code].astype(np.int64))), pa.array(summed(logs // 10**9)), pa.array(summed(logs % 10**9)),
            pa.array(summed(self.log_p(grams, begin, levels))), pa.ListArray.from_arrays(lists, pa.array(h[pair % max(len(h), 1)].view(np.int64))), pa.ListArray.from_arrays(lists, pa.array(times)),
        ]


_SCORED = ["n_tokens", "n_often", "whole", "part", "score", "rare", "times"]
_SCORED_DDL = "n_tokens long, n_often long, whole long, part long, score double, rare array<bigint>, times array<bigint>"


def _by_broadcast(rows: DataFrame, found: Filter, scorer: Scorer, schema: T.StructType) -> DataFrame:
    model = rows.sparkSession.sparkContext.broadcast((found, scorer))

    def run(batches):
        lm, own = model.value
        for b in batches:
            for c in tb.chunks(b.column(3)):
                t = Tokens(c)
                yield pa.RecordBatch.from_arrays([*(b.column(i)[c.rows] for i in range(3)), *own.scored(t, t.grams(), lm.levels)], names=["_id", "_key", "held_out", *_SCORED])

    return rows.mapInArrow(run, schema)


def distinct(some: list[tuple[Tokens, list[np.ndarray]]], order: int) -> np.ndarray:
    """Sorted, so by buckets, and the same however a chunk's texts are ordered."""
    return _counted(np.concatenate([g[order - 1] for _, g in some]))[0]


def _by_slices(rows: DataFrame, shape: Shape, slices: DataFrame, scorer: Scorer, schema: T.StructType) -> DataFrame:
    """The same, with the distinct n-grams of every chunk sent to the parts of the filter. Chunks and parts have a size of their own, whatever the input's: only their numbers grow with it."""
    shared = rows.sparkSession.sparkContext.broadcast(scorer)

    def named(batches):  # every chunk gets a name; written down once, so that it stays
        for b in batches:
            for c in tb.chunks(b.column(3), SENT_BYTES):
                yield pa.RecordBatch.from_arrays([*(b.column(i)[c.rows] for i in range(4)), pa.array(np.full(len(c), int.from_bytes(os.urandom(8), "little", signed=True)))], names=["_id", "_key", "held_out", "_text", "chunk"])

    chunks = cut(rows.mapInArrow(named, T.StructType([*rows.schema, T.StructField("chunk", T.LongType())]))).groupBy("chunk")

    def tokens(own: pa.Table) -> list[tuple[Tokens, list[np.ndarray]]]:
        return [(t, t.grams()) for t in map(Tokens, tb.chunks(own["_text"].combine_chunks()))]

    def asked(own: pa.Table) -> pa.Table:
        some, out = tokens(own), []
        for order in range(1, ORDERS + 1):
            part, grams = shape.by_part(distinct(some, order))
            out.append(pa.table({"chunk": np.full(len(part), own["chunk"][0].as_py()), "order": np.full(len(part), order), "part": part, "grams": pa.array([_planes(np.diff(x, prepend=np.uint64(0))) for x in grams], pa.binary())}))
        return pa.concat_tables(out)

    def answer(mine: pa.Table, own: pa.Table) -> pa.Table:
        levels, held, n = [], [], 0
        if len(mine):
            order, part = mine["order"][0].as_py(), mine["part"][0].as_py()
            size = shape.words[order - 1]
            words = np.zeros(PART_BUCKETS * size, np.uint64)  # a bucket without n-grams has no slice
            for bucket, raw in zip(own["bucket"].to_pylist(), own["words"]):
                words[(bucket % PART_BUCKETS) * size :][:size] = np.frombuffer(raw.as_buffer(), np.uint64)

            def told():
                g = np.concatenate(held)
                found = shape.levels(words, shape.bucket(g) % PART_BUCKETS * size, g, order).astype(np.uint8)
                levels.extend(_pressed(x.tobytes()) for x in np.split(found, np.cumsum([len(x) for x in held])[:-1]))

            for raw in mine["grams"]:
                held.append(np.cumsum(_wide(raw.as_py()), dtype=np.uint64))
                n += len(held[-1])
                if n > ASKED_AT_ONCE:
                    told()
                    held, n = [], 0
            if held:
                told()
        return pa.table({"chunk": mine["chunk"], "order": mine["order"], "part": mine["part"], "levels": pa.array(levels, pa.binary())})

    probes = chunks.applyInArrow(asked, "chunk long, order long, part long, grams binary")
    parts = slices.withColumn("part", F.floor(F.col("bucket") / PART_BUCKETS))
    answers = probes.groupBy("order", "part").cogroup(parts.groupBy("order", "part")).applyInArrow(answer, "chunk long, order long, part long, levels binary")

    def finish(mine: pa.Table, own: pa.Table) -> pa.Table:
        some, known = tokens(mine), {}
        own = own.sort_by([("order", "ascending"), ("part", "ascending")])
        for order in range(1, ORDERS + 1):
            g = distinct(some, order)
            n = np.frombuffer(b"".join(_unpressed(x) for x, k in zip(own["levels"].to_pylist(), own["order"].to_pylist()) if k == order), np.uint8)
            if len(g) != len(n):
                raise RuntimeError(f"{len(n)} answers for {len(g)} n-grams")
            known[order] = g, n

        def levels(grams, order):
            g, n = known[order]
            by = np.argsort(grams)
            out = np.empty(len(grams), np.int64)
            out[by] = n[np.searchsorted(g, grams[by])]
            return out

        scored = [pa.table(shared.value.scored(t, g, levels), names=_SCORED) for t, g in some]
        return pa.table([*(mine[k] for k in ("_id", "_key", "held_out")), *pa.concat_tables(scored).columns], names=["_id", "_key", "held_out", *_SCORED])

    return chunks.cogroup(answers.groupBy("chunk")).applyInArrow(finish, schema)


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Rows (id, held_out, n_tokens, n_known, train_tokens, base_score, score) of all documents."""
    rows = docs.select(F.col(id_col).alias("_id"), F.xxhash64(F.col(id_col), F.col(text_col)).alias("_key"), held_out(F.col(id_col)).alias("held_out"), F.col(text_col).alias("_text"))
    train = rows.where("NOT held_out").select("_text")
    counts = cut(gram_counts(train))
    shape, slices, q_total = filter_slices(counts)
    vocabulary = cut(_vocabulary(counts))
    n_train = train.count()
    n, v = vocabulary.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    least, held = 0.0, 0  # counts are told apart by a hundredth of their logarithm; words above the last step that fits are frequent
    step = F.floor(F.log("c") * 100).cast("long")
    for k, words in sorted(map(tuple, vocabulary.groupBy(step).count().collect()), reverse=True):  # some thousand rows at most
        held += words
        if held > FREQUENT:
            least = k + 1
            break
    often = vocabulary.where(step >= least).toPandas()  # FREQUENT rows at most
    scorer = Scorer(often["h"].to_numpy(np.int64).view(np.uint64), often["c"].to_numpy(np.int64), q_total + v + 1, n_train)
    schema = T.StructType([T.StructField("_id", docs.schema[id_col].dataType), *T.StructType.fromDDL("_key long, held_out boolean, " + _SCORED_DDL)])
    if shape.bytes() <= broadcast_bytes:
        scored = cut(_by_broadcast(rows, collected(shape, slices), scorer, schema))
    else:
        scored = cut(_by_slices(rows, shape, slices, scorer, schema))

    listed = scored.where(F.size("rare") > 0).select("_id", "_key", "rare", "times").dropDuplicates(["_id", "_key"])  # repeated rows have the same words
    rare = listed.select("_id", "_key", F.inline(F.arrays_zip("rare", "times"))).select("_id", "_key", F.col("rare").alias("h"), "times")
    met = rare.join(shuffled(vocabulary.where(step < least)), "h").groupBy("_id", "_key").agg(F.sum("times").alias("n_rare"), F.sum(F.round(F.log10(F.col("c") + 1), 15).cast("decimal(38,15)") * F.col("times")).alias("rare_sum"))
    s, m = scored.alias("s"), met.alias("m")
    both = s.join(m, (F.col("s._key") == F.col("m._key")) & F.col("s._id").eqNullSafe(F.col("m._id")), "left")
    base = (F.col("whole").cast("decimal(38,15)") / F.lit(10**6) + F.col("part").cast("decimal(38,15)") / F.lit(10**15)).cast("double") + F.coalesce(F.col("rare_sum").cast("double"), F.lit(0.0)) - F.col("n_tokens") * F.log10(F.lit(float(n + v + 1)))
    return both.select(
        F.col("s._id").alias(id_col), "held_out", "n_tokens", (F.col("n_often") + F.coalesce("n_rare", F.lit(0))).cast("long").alias("n_known"), F.lit(n).cast("long").alias("train_tokens"), base.alias("base_score"), "score"
    )


def _vocabulary(counts: DataFrame) -> DataFrame:
    """Rows (h, c): the exact counts of the training tokens by their 64-bit hash."""

    def run(batches):
        for b in batches:
            for g, n in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                h, c = _unpacked(g, n)
                yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(c)], names=["h", "c"])

    return counts.where("order = 1").select("grams", "counts").mapInArrow(run, "h long, c long")
