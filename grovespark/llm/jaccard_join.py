"""Documents whose sets of word shingles are alike, joined by parity sketches.

A document's set is sketched as P words of 64 bits: every shingle flips one bit
that its hash names. A bit that differs needs a shingle that only one set has,
so the Hamming distance of two sketches is at most the sets' symmetric
difference. Sets of a size band that reach the similarity differ in at most D
shingles, and P > D: at least P - D words of the two sketches are equal
(pigeonhole). Words are the join keys; pairs that meet are tested on the Hamming
distance of further sketches, then on the sets themselves.

Sizes are dealt into bands that grow by a third; a set is sketched for its own
band, and for the next if a set there may be like it. Words with few bits
say little: a document that has no more than P - D - 1 of them leaves them out,
as one of its equal words then has more bits.

Documents with one set are one class; only classes are joined. A key's classes
are first compared with one of them, its pivot, so that a group of copies needs
links in proportion to its size. Classes that are connected by then need no
further comparison: what is left are pairs of a key's classes in different
components. Under keys with many classes, sets that have too many elements of
their own go; then all pairs are compared. None is left out. Rows that many pairs ask for are salted by
the key's count.

Defined cases: null or wordless texts have an empty set, link with nothing and
are their own component; a text of fewer words than a shingle is one shingle;
repeated rows give repeated rows; a row without id links like any other, but a
component's id is the least that is not null (null if there is none); an empty
table gives an empty result; other columns are ignored; a text of any length is
one unit. Shingles are known by 64-bit hashes, sets by 128 bits.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import textbatch as tb
from .components import components
from .shared import cut, join_counted, shuffled, small

#: Words of a sketch with fewer bits than this are left out where that loses nothing.
FEW_BITS = 3
#: Words of the sketch on which pairs are tested before their sets are.
FOLD = 16
#: Rows of a class that one task joins with its pairs.
SALT = 2_000
#: Keys with more rows have those classes left out first that cannot be like another.
FEW_ROWS = 32
#: How often sets with many elements of their own are looked for.
LONE_PASSES = 2


def most_apart(total: int, percent: int) -> int:
    """The greatest symmetric difference of two sets of `total` elements together whose Jaccard similarity is at least percent / 100."""
    return total * (100 - percent) // (100 + percent)


def bands(size: int) -> list[int]:
    """The least sizes of the bands up to the one that holds `size`, and the first beyond."""
    edges = [1]
    while edges[-1] <= size:
        edges.append(max(edges[-1] + 1, edges[-1] * 4 // 3))
    return edges


def words_of(largest: int, percent: int) -> tuple[int, int]:
    """D and P of a band whose largest size is given."""
    d = most_apart(2 * largest, percent)
    return d, d + 2 + d // 16 if d else 0


def shingle_sets(c: tb.Chunk, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingles' hashes, document after document, and where each document's begin."""
    w = tb.words(c)
    h = tb.word_hashes(c, w, lower=True)
    grams = tb.ngram_hashes(h, size)
    whole = tb.whole_windows(w.offsets, size, len(grams))
    doc = w.doc()
    values, owner = grams[whole], doc[: len(grams)][whole]
    n = w.counts()
    for i in np.flatnonzero((n > 0) & (n < size)):  # the sequence as one shingle
        own = h[w.offsets[i] : w.offsets[i + 1]]
        values = np.append(values, tb.ngram_hashes(own, len(own)) + np.uint64(len(own)))
        owner = np.append(owner, i)
    order = np.lexsort((values, owner))
    values, owner = values[order], owner[order]
    if len(values):
        first = np.append(True, (values[1:] != values[:-1]) | (owner[1:] != owner[:-1]))
        values, owner = values[first], owner[first]
    return values, np.searchsorted(owner, np.arange(len(c) + 1))


def signatures(values: np.ndarray, offsets: np.ndarray) -> list[bytes]:
    """128 bits of each set, whatever the order of its elements."""
    halves = []
    for salt in (0x2545F491, 0x9E6C63D1):
        total = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(tb.mixed(values + np.uint64(salt)), out=total[1:])
        halves.append(total[offsets[1:]] - total[offsets[:-1]])
    return [row.tobytes() for row in np.stack(halves, axis=1)]


def sketch(values: np.ndarray, offsets: np.ndarray, docs: np.ndarray, band: int, parts: int) -> np.ndarray:
    """The sketches (a row each) of some documents for one band."""
    n = offsets[docs + 1] - offsets[docs]
    taken, _ = tb.gathered(values, offsets[docs], n, np.arange(len(docs)))
    h = tb.mixed(taken + np.uint64(band * 0x10001 + 7))
    at = np.repeat(np.arange(len(docs)), n) * parts + (((h >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)).astype(np.int64)
    out = np.zeros(len(docs) * parts, np.uint64)
    np.bitwise_xor.at(out, at, np.uint64(1) << (h & np.uint64(63)))
    return out.reshape(len(docs), parts)


def keys_of(values: np.ndarray, offsets: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """The words of each document's sketches, hashed with their bands and places, without those that may be left out; and where each document's begin."""
    n = np.diff(offsets)
    most = n * 100 // percent  # the largest size that a set may be like
    edges = np.array(bands(int(most.max(initial=1)) + 1))
    own, last = np.searchsorted(edges, n, "right") - 1, np.searchsorted(edges, most, "right") - 1
    found, owners = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    for band in range(int(last.max(initial=0)) + 1):
        d, parts = words_of(int(edges[band + 1]) - 1, percent)
        docs = np.flatnonzero((n > 0) & (own <= band) & (band <= last))
        if not parts or not len(docs):
            continue
        words = sketch(values, offsets, docs, band, parts)
        few = np.bitwise_count(words) < FEW_BITS
        keep = ~few | (few.sum(axis=1) >= parts - d)[:, None]
        places = tb.mixed(np.arange(parts, dtype=np.uint64) + np.uint64(band << 32))
        found.append(tb.mixed(words ^ places)[keep])
        owners.append(np.repeat(docs, keep.sum(axis=1)))
    owner = np.concatenate(owners)
    order = np.argsort(owner, kind="stable")
    return np.concatenate(found)[order], np.searchsorted(owner[order], np.arange(len(n) + 1))


def _lists(values: np.ndarray, offsets: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values.view(np.int64)))


def sketched(docs: DataFrame, size: int, percent: int, id_col: str, text_col: str) -> DataFrame:
    """Rows (id, sig, n, th, keys, fold) of all documents: signature and size of the set, hash of the text, keys of the sketches, and a sketch of FOLD words."""

    def run(batches):
        for batch in batches:
            for c in tb.chunks(batch.column(2)):
                values, offsets = shingle_sets(c, size)
                folds = sketch(values, offsets, np.arange(len(c)), 0, FOLD).ravel()
                columns = [batch.column(0)[c.rows], pa.array(signatures(values, offsets), pa.binary()), pa.array(np.diff(offsets)), batch.column(1)[c.rows], _lists(*keys_of(values, offsets, percent)), _lists(folds, np.arange(len(c) + 1) * FOLD)]
                yield pa.RecordBatch.from_arrays(columns, names=["id", "sig", "n", "th", "keys", "fold"])

    schema = T.StructType([T.StructField("id", docs.schema[id_col].dataType), *T._parse_datatype_string("sig binary, n long, th long, keys array<bigint>, fold array<bigint>").fields])
    return docs.select(F.col(id_col), F.xxhash64(F.col(text_col)), F.col(text_col)).mapInArrow(run, schema)


def _apart(total: Column, percent: int) -> Column:
    """most_apart as a column."""
    return F.floor(total * (100 - percent) / F.lit(100 + percent))


def _joined(pairs: DataFrame, table: DataFrame, payload: str) -> DataFrame:
    """pairs (a, b, c) with the column `payload` of both, as `of_a` and `of_b`. c is a bound of how often a class occurs; table has a row (gid, payload) a class."""
    need = pairs.select(F.explode(F.array("a", "b")).alias("gid"), "c").groupBy("gid").agg(F.max("c").alias("c"))
    copies = table.join(need, "gid").select("gid", payload, F.explode(F.sequence(F.lit(0), F.floor(F.col("c") / SALT).cast("int"))).alias("salt"))
    for own, other in (("a", "b"), ("b", "a")):
        salt = F.pmod(F.xxhash64(other), F.floor(F.col("c") / SALT) + 1).cast("int")
        side = copies.select(F.col("gid").alias(own), F.col("salt"), F.col(payload).alias(f"of_{own}"))
        pairs = pairs.withColumn("salt", salt).join(shuffled(side), [own, "salt"]).drop("salt")
    return pairs


def sets_of(asked: DataFrame, docs: DataFrame, size: int, text_col: str) -> DataFrame:
    """Rows (gid, held) of the asked classes (gid, sig, th): the sets, from texts with that hash."""

    def run(batches):
        for batch in batches:
            for c in tb.chunks(batch.column(2)):
                values, offsets = shingle_sets(c, size)
                own = np.array(signatures(values, offsets), object)
                keep = np.flatnonzero(own == np.array(batch.column(1)[c.rows].to_pylist(), object))  # another text may have the same 64 bits
                flat, begin = tb.gathered(values, offsets[:-1], np.diff(offsets), keep)
                yield pa.RecordBatch.from_arrays([batch.column(0)[c.rows].take(pa.array(keep)), _lists(flat, begin)], names=["gid", "held"])

    texts = docs.select(F.xxhash64(F.col(text_col)).alias("th"), F.col(text_col).alias("text")).join(small(asked, size=F.lit(40)), "th").select("gid", "sig", "text")
    return texts.mapInArrow(run, "gid long, held array<bigint>").groupBy("gid").agg(F.first("held").alias("held"))


def lone_counts(sets: DataFrame) -> DataFrame:
    """Rows (gid, lone): how many of a set's elements no other of the sets has."""
    once = sets.select("gid", F.explode("held").alias("x")).groupBy("x").agg(F.count("*").alias("k"), F.first("gid").alias("gid")).where("k = 1")
    return once.groupBy("gid").agg(F.count("*").alias("lone"))


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets reach the similarity."""
    shared = F.size(F.array_intersect("of_a", "of_b"))
    return _joined(pairs, sets, "held").where(100 * shared >= percent * (F.size("of_a") + F.size("of_b") - shared)).select("a", "b")


def _may_link(percent: int) -> Column:
    """Whether rows x and y may link: they are of different components and near enough in size, and neither the elements that only one of them has nor their sketches set them too far apart."""
    x, y = F.col("x"), F.col("y")
    n, m = x["n"], y["n"]
    # x lacks as many elements of y as y lacks of x, but for the difference of their sizes
    apart = F.greatest(x["lone"] + y["lone"], 2 * x["lone"] - n + m, 2 * y["lone"] - m + n)
    differ = F.aggregate(F.zip_with(x["fold"], y["fold"], lambda p, q: F.bit_count(p.bitwiseXOR(q))), F.lit(0), lambda s, t: s + t)
    most = _apart(n + m, percent)
    return (x["gid"] != y["gid"]) & (x["label"] != y["label"]) & (100 * F.least(n, m) >= percent * F.greatest(n, m)) & (apart <= most) & (differ <= most)


def _row() -> Column:
    return F.struct("gid", "n", "lone", "label", "fold", "met")


def _with_pivot(rows: DataFrame, percent: int) -> DataFrame:
    """Each class with one of its keys' pivots: those whose keys most others have, which are likest to be what the others are copies of."""

    def order(at: str) -> Column:
        return F.struct(-F.col(at + "met"), F.xxhash64(F.col(at + "gid")))

    pivots = rows.groupBy("key").agg(F.min_by(_row(), order("")).alias("y"), F.count("*").alias("held"))
    met = join_counted(rows.select("key", "c", _row().alias("x")), pivots, ["key"], "held").where(_may_link(percent))
    one = F.min_by(F.struct(F.col("y.gid").alias("y"), "c"), order("y."))
    return met.groupBy(F.col("x.gid").alias("x")).agg(one.alias("p")).select("x", "p.y", "p.c")


def _cross(rows: DataFrame, percent: int) -> DataFrame:
    """All pairs of a key's rows that may link; a key of c rows is dealt into 1 + c div SALT parts, and each part meets all rows."""
    parts = F.floor(F.col("c") / SALT).cast("int")
    one = rows.select("key", _row().alias("x"), "c", F.pmod(F.xxhash64("gid"), parts + 1).cast("int").alias("part"))
    other = rows.select("key", _row().alias("y"), F.explode(F.sequence(F.lit(0), parts)).alias("part"))
    return one.join(shuffled(other), ["key", "part"]).where((F.col("x.gid") < F.col("y.gid")) & _may_link(percent)).select(F.col("x.gid").alias("x"), F.col("y.gid").alias("y"), "c")


def _distinct(met: DataFrame) -> DataFrame:
    return met.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"), "c").groupBy("a", "b").agg(F.max("c").alias("c"))


def class_components(classes: DataFrame, docs: DataFrame, size: int, percent: int, text_col: str) -> DataFrame:
    """Rows (gid, label) of the classes that link to another; label is the least gid that links reach."""
    def sets(gids: DataFrame) -> DataFrame:
        return cut(sets_of(cut(gids.join(classes.select("gid", "sig", "th"), "gid")), docs, size, text_col))

    keys = classes.select("gid", F.explode("keys").alias("key"))
    several = keys.groupBy("key").agg(F.count("*").alias("c")).where("c > 1")
    members = cut(join_counted(keys, cut(several.withColumn("held", F.col("c"))), ["key"], "held"))
    some = members.groupBy("gid").agg(F.sum("c").alias("met")).join(classes.select("gid", "n", "fold"), "gid")
    some = cut(some.withColumn("lone", F.lit(0).cast("long")))
    first = cut(_distinct(_with_pivot(cut(members.withColumn("label", F.col("gid")).join(some, "gid")), percent)))
    links = cut(verified(first, sets(_ends(first)), percent))
    labels = cut(components(links).select(F.col("node").alias("gid"), F.col("least").alias("label")))
    rows = members.drop("c").join(labels, "gid", "left").withColumn("label", F.coalesce("label", "gid"))
    by_label = rows.groupBy("key", "label").agg(F.count("*").alias("k"))
    left = cut(by_label.groupBy("key").agg(F.sum("k").alias("c"), F.count("*").alias("labels")).where("labels > 1").select("key", "c", F.col("c").alias("held")))
    rows = cut(join_counted(rows, left, ["key"], "held"))
    few = rows.where(F.col("c") <= FEW_ROWS).join(some, "gid")
    # of the classes under keys with many, those with more elements of their own than the similarity allows are like no other; without such sets others may be found out
    many = rows.where(F.col("c") > FEW_ROWS)
    own = some.join(many.select("gid").distinct(), "gid")
    held = sets(own.select("gid"))
    for _ in range(LONE_PASSES):
        lone = lone_counts(held.join(own.select("gid"), "gid"))
        own = cut(own.drop("lone").join(lone, "gid", "left").withColumn("lone", F.coalesce("lone", F.lit(0))).where(100 * F.col("lone") <= (100 - percent) * F.col("n")))
    met = _cross(few, percent).union(_cross(many.join(own, "gid"), percent))
    new = cut(_distinct(met).join(first.select("a", "b"), ["a", "b"], "left_anti"))
    links = links.union(cut(verified(new, sets(_ends(new)), percent)))
    return components(links).select(F.col("node").alias("gid"), F.col("least").alias("label"))


def _ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.explode(F.array("a", "b")).alias("gid")).distinct()


def similar(docs: DataFrame, size: int = 3, percent: int = 90, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (id, n_shingles, component_id) of all documents: component_id is the least id that links of at least percent / 100 reach."""
    rows = cut(sketched(docs, size, percent, id_col, text_col))
    some = rows.where("n > 0").groupBy("sig").agg(F.min("id").alias("least_id"), F.count("*").alias("copies"), F.first("n").alias("n"), F.first("keys").alias("keys"), F.first("fold").alias("fold"), F.min("th").alias("th"))
    classes = cut(some.withColumn("gid", F.monotonically_increasing_id()))
    found = class_components(classes, docs, size, percent, text_col)
    own = classes.select("gid", "sig", "least_id", "copies")
    if found is None:
        own = own.withColumn("component_id", F.col("least_id"))
    else:
        own = cut(own.join(found, "gid", "left").withColumn("root", F.coalesce("label", "gid")).drop("label"))
        least = own.groupBy("root").agg(F.min("least_id").alias("component_id"), F.count("*").alias("classes"))
        own = join_counted(own, least, ["root"], "classes")
    by_set = cut(own.select("sig", "component_id", "copies"))
    filled = join_counted(rows.where("n > 0").select("id", "n", "sig"), by_set, ["sig"], "copies").select("id", "n", "component_id")
    bare = rows.where("n = 0").select("id", "n", F.col("id").alias("component_id"))
    return filled.union(bare).select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), "component_id")
