"""SimHash near-duplicates by generalised pigeonhole search.

A text's fingerprint has a bit set where over half of its shingles' hashes have
it. Documents are gathered by fingerprint first, so copies meet no further
work. The bits are then dealt into partitions that keep correlated bits
together, and each partition i gets its own threshold t_i with
sum(t_i + 1) = distance + 1: if every partition of a pair differed in more than
t_i bits, the pair would differ in more than `distance`. The thresholds come
from dynamic programming over estimated candidate counts. A partition is probed
with every value within t_i bits; the pairs that meet are verified on all bits.

A fingerprint sends MOST_PROBES probes at most; no pair is lost by that, as the
programme may choose more partitions with lower thresholds.

Defined cases: null or wordless texts have fingerprint 0 and link like any
other; a text of fewer words than a shingle is one shingle; repeated rows give
repeated rows; a row without id links like any other, but a component's id is
the least of those that are not null (null if there is none); ids may be of any
type that has an order; an empty table gives an empty result; other columns are
ignored; a text of any length is one unit; a bit that half the hashes have is 0.
"""

from __future__ import annotations

from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import textbatch as tb
from .components import components
from .shared import cut, join_counted, shuffled

BITS = 64
#: What it costs to send a probe to its bucket, in comparisons.
PROBE_COST = 3.0
#: Fewer fingerprints are planned for as if they were so many, so that work grows in proportion up to there.
PLANNED_FOR = 10_000_000
MOST_PROBES = 200
#: Bits count as if this many further fingerprints had each of them half the time: a few fingerprints say little of the others.
PRIOR = 1_000


def _bits(values: np.ndarray) -> np.ndarray:
    return np.unpackbits(values.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def fingerprints_of(c: tb.Chunk, size: int, seed: int) -> np.ndarray:
    """A fingerprint for each text: words joined by one space, A-Z in lower case, XXH64 of every `size` of them."""
    from xxhash import xxh64_intdigest

    hashes, counts = [], np.zeros(len(c), np.int64)
    for i in range(len(c)):
        w = c.bytes_of(i).lower().split()
        if not w:
            continue
        text = b" ".join(w)
        if len(w) <= size:
            hashes.append(xxh64_intdigest(text, seed))
            counts[i] = 1
            continue
        ends = np.cumsum(np.fromiter(map(len, w), np.int64, len(w)) + 1) - 1
        starts = [0, *(ends[: len(w) - size] + 1).tolist()]
        hashes += [xxh64_intdigest(text[a:b], seed) for a, b in zip(starts, ends[size - 1 :].tolist())]
        counts[i] = len(starts)
    out = np.zeros(len(c), np.uint64)
    some = np.flatnonzero(counts)
    if len(some):
        begin = np.cumsum(counts[some]) - counts[some]
        ones = np.add.reduceat(_bits(np.array(hashes, np.uint64)), begin, axis=0, dtype=np.int32)
        out[some] = np.packbits(ones * 2 > counts[some, None], axis=1, bitorder="little").view("<u8").ravel()
    return out


def fingerprints(docs: DataFrame, size: int, seed: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (id, key, fp) of all documents; fp is the fingerprint as a signed long, key a hash of id and text."""

    def run(batches):
        for batch in batches:
            for c in tb.chunks(batch.column(2)):
                yield pa.RecordBatch.from_arrays([batch.column(0)[c.rows], batch.column(1)[c.rows], pa.array(fingerprints_of(c, size, seed).view(np.int64))], names=["id", "key", "fp"])

    schema = T.StructType([T.StructField("id", docs.schema[id_col].dataType), T.StructField("key", T.LongType()), T.StructField("fp", T.LongType())])
    return docs.select(F.col(id_col), F.xxhash64(F.col(id_col), F.col(text_col)), F.col(text_col)).mapInArrow(run, schema)


def _moments(fps: DataFrame) -> tuple[int, np.ndarray]:
    """How many fingerprints, and how many have both bit i and bit j: a table of 64 x 64."""

    def run(batches):
        n, both = 0, np.zeros((BITS, BITS), np.int64)
        for batch in batches:
            values = np.array(batch.column(0)).view(np.uint64)
            for k in range(0, len(values), 1 << 16):
                b = _bits(values[k : k + (1 << 16)]).astype(np.float32)
                both += (b.T @ b).astype(np.int64)
            n += len(values)
        yield pa.RecordBatch.from_pydict({"at": np.arange(BITS * BITS + 1), "n": np.append(both.ravel(), n)})

    rows = np.zeros(BITS * BITS + 1, np.int64)
    for at, n in fps.select("fp").mapInArrow(run, "at long, n long").groupBy("at").agg(F.sum("n")).collect():
        rows[at] = n
    return int(rows[-1]), rows[:-1].reshape(BITS, BITS)


def _dealt(correlation: np.ndarray, parts: int) -> list[list[int]]:
    """Bits in partitions of equal size; each takes in turn the free bit most correlated with those it has."""
    free, out = set(range(BITS)), []
    for k in range(parts):
        size = BITS // parts + (k < BITS % parts)
        first = max(sorted(free), key=lambda i: sum(correlation[i][j] for j in free))
        own = [first]
        free.remove(first)
        while len(own) < size:
            best = max(sorted(free), key=lambda i: sum(correlation[i][j] for j in own))
            own.append(best)
            free.remove(best)
        out.append(own)
    return out


def plan(n: int, both: np.ndarray, distance: int) -> list[tuple[list[int], int]]:
    """Partitions and their thresholds (-1: not probed) with the least estimated cost.

    The bits of two fingerprints are taken to differ independently, each as
    often as its share says; that estimates how many pairs meet in a partition.
    """
    both = (both + PRIOR * (0.25 + 0.25 * np.eye(BITS))) / (n + PRIOR)
    share = np.diag(both)
    planned = float(max(n, PLANNED_FOR))
    spread = np.sqrt(np.maximum(share * (1 - share), 1e-9))
    correlation = np.abs((both - np.outer(share, share)) / np.outer(spread, spread))
    best = None
    for parts in range(2, distance + 2):
        dealt = _dealt(correlation, parts)
        cost = []
        for own in dealt:
            differ = np.array([1.0])
            for i in own:
                d = 2 * share[i] * (1 - share[i])
                differ = np.append(differ, 0) * (1 - d) + np.append(0, differ) * d
            flips = [sum(comb(len(own), k) for k in range(t + 1)) for t in range(distance + 1)]
            met = [planned * planned * differ[: t + 1].sum() for t in range(distance + 1)]
            cost.append([(0.0, 0)] + [(m + PROBE_COST * planned * (1 + f), f) for m, f in zip(met, flips)])
        table = {(0, 0): (0.0, [])}  # least cost by sum(t_i + 1) and probes so far
        for row in cost:
            new = {}
            for (have, probes), (c, chosen) in table.items():
                for t, (own, f) in enumerate(row, -1):
                    at = have + t + 1, probes + f
                    if at[0] <= distance + 1 and at[1] <= MOST_PROBES and (at not in new or c + own < new[at][0]):
                        new[at] = c + own, [*chosen, t]
            table = new
        for (have, _), (c, chosen) in table.items():
            if have == distance + 1 and (best is None or c < best[0]):
                best = c, list(zip(dealt, chosen))
    return best[1]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def links(fps: DataFrame, distance: int) -> DataFrame:
    """Rows (a, b): the pairs of different fingerprints that differ in at most `distance` bits. fps: distinct, column fp."""
    n, both = _moments(fps)
    held, asked = [], []  # (part, mask), and (part, mask, bits to flip)
    for k, (own, t) in enumerate(plan(n, both, distance)):
        if t >= 0:
            mask = _signed(sum(1 << i for i in own))
            held.append((k, mask, 0))
            asked += [(k, mask, _signed(sum(1 << i for i in x))) for size in range(t + 1) for x in combinations(own, size)]

    def keyed(rows: list[tuple[int, int, int]], name: str) -> DataFrame:
        """A row for each of `rows` and fingerprint; MOST_PROBES of a fingerprint at most."""
        listed = F.array(*(F.struct(F.lit(p).alias("part"), F.lit(m).cast("long").alias("mask"), F.lit(x).cast("long").alias("flip")) for p, m, x in rows))
        return fps.select(F.col("fp").alias(name), F.inline(listed)).select(name, "part", F.col(name).bitwiseAND(F.col("mask")).bitwiseXOR(F.col("flip")).alias("key"))

    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= distance
    return keyed(held, "a").join(shuffled(keyed(asked, "b")), ["part", "key"]).where((F.col("a") < F.col("b")) & near).select("a", "b").distinct()


def assigned(docs: DataFrame, size: int = 4, distance: int = 4, seed: int = 42, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (id, key, fp, root, component_id, total) of all documents: the least fingerprint and the least id that links reach, and how many documents the component has."""
    rows = cut(fingerprints(docs, size, seed, id_col, text_col))
    groups = cut(rows.groupBy("fp").agg(F.min("id").alias("least_id"), F.count("*").alias("n")))
    found = components(links(groups.select("fp"), distance)).select(F.col("node").alias("fp"), F.col("least").alias("root"))
    own = cut(groups.join(found, "fp", "left").select("fp", "least_id", "n", F.coalesce("root", "fp").alias("root")))
    least = own.groupBy("root").agg(F.min("least_id").alias("component_id"), F.sum("n").alias("total"), F.count("*").alias("fps"))
    by_fp = join_counted(own, least, ["root"], "fps").select("fp", "root", "component_id", "total", "n")
    return join_counted(rows, by_fp, ["fp"], "n")


def near_duplicates(docs: DataFrame, size: int = 4, distance: int = 4, seed: int = 42, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (id, fp, component_id) of all documents: component_id is the least id that links reach."""
    return assigned(docs, size, distance, seed, id_col, text_col).select(F.col("id").alias(id_col), "fp", "component_id")


def losers(docs: DataFrame, size: int = 4, distance: int = 4, seed: int = 42, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """What to drop so that each component keeps one document, as two tables of rows (id, key), key being a hash of id and text.

    A component keeps the document with the least id (one without id only if none has one), of equal ids the one with the
    least key. The first table has all other documents; the second those to keep of which there are several equal rows.
    """
    several = cut(assigned(docs, size, distance, seed, id_col, text_col).where("total > 1").select("id", "key", "root", "component_id", "total"))
    first = several.where("id <=> component_id").groupBy("root").agg(F.min("key").alias("kept"), F.first("total").alias("n"))
    marked = join_counted(several, first, ["root"], "n").select("id", "key", ((F.col("key") == F.col("kept")) & F.col("id").eqNullSafe(F.col("component_id"))).alias("keep"))
    counted = cut(marked.groupBy("id", "key", "keep").count())
    return counted.where("NOT keep").select("id", "key"), counted.where("keep AND count > 1").select("id", "key")
