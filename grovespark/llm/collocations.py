"""Phrases whose words stand together more often than apart, for each language.

Texts are cut at punctuation into pieces and those into words. The n-grams of
each length are first counted by cells: a hash gives each n-gram one of as many
cells as there are words or more, unless most words are very short, and a
cell's count is never less than that of an n-gram in it. The cells that are
frequent enough make a Bloom filter; the next length counts only n-grams whose
two shorter parts are both in it, which loses none. A last pass over the texts
sends the n-grams in the filters with their text; they are counted exactly, so
what shares a cell or is in a filter by mistake goes again. A task counts what
it sends in chunks of texts, so that a frequent n-gram leaves a chunk once.

Inside a chunk, two words of a language are the same if their 64-bit hashes are.

A candidate asks for the counts of its parts by rows that are shuffled to where
those counts are. Parts that many candidates share (frequent words) are
answered by broadcast of at most ten thousand of them.

Score of a cut into l and r: floor(a * a * 1000000 / (l * r)), in decimals of
38 digits, exact for counts below 10 ** 14.

Defined cases: a null text is empty; a null language is `und`; pieces without
words count nothing; equal scores of a phrase's cuts go to the shorter first
part; equal scores of phrases go to the greater count, then by UTF-8 order;
repeated rows count each time; an empty table gives an empty result; other
columns are ignored; a piece of any length is one unit.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property
from itertools import islice, pairwise

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from . import sketch
from . import textbatch as tb
from .shared import cut, join_counted, shuffled

#: Bytes of texts that a task counts at once, and the rows that it sends at once.
CHUNK, ROWS = 8 << 20, 100_000
#: There are 2 ** LEAST_CELLS cells at least, 2 ** MOST_CELLS at most (more words than those only let more n-grams through), added up in 2 ** BLOCKS blocks, or fewer.
LEAST_CELLS, MOST_CELLS, BLOCKS = 20, 36, 12
#: A filter of frequent n-grams has so many bits, twice, at most (2 ** 29: 128 MB).
MOST_BITS = 29
#: A language's phrases are ranked in so many parts first.
PARTS = 16
#: Words of more bytes are hashed one by one.
LONG = 64

_ENDS = np.zeros(256, bool)
_ENDS[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
_BETWEEN = _ENDS.copy()
_BETWEEN[[0x09, 0x20]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_FIRST = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word, from eight bytes at a time."""
    import xxhash

    eight = np.ndarray(len(data) + 1, np.uint64, np.append(data, np.zeros(8, np.uint8)), strides=(1,))
    length = ends - starts
    h = tb.joined(eight[starts] & _FIRST[np.minimum(length, 8)], length.astype(np.uint64))
    more, k = np.flatnonzero((length > 8) & (length <= LONG)), 8
    while len(more):
        h[more] = tb.joined(h[more], eight[starts[more] + k] & _FIRST[np.minimum(length[more] - k, 8)])
        k += 8
        more = more[length[more] > k]
    for i in np.flatnonzero(length > LONG).tolist():
        h[i] = xxhash.xxh64_intdigest(data[starts[i] : ends[i]].tobytes())
    return h


def _texts(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    flat, begin = tb.gathered(data, starts, ends - starts, np.arange(len(starts)))
    return pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(begin), pa.py_buffer(flat))


def gram_hashes(h: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
    """The hashes of the n words from each place on, from those of the words."""
    out = h[at]
    for k in range(1, n):
        out = tb.joined(out, h[at + k])
    return out


def chunk_grams(wid: np.ndarray, at: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct n-grams that begin at the places `at`: a place of each, and how often it occurs. wid: each word's number."""
    code = pd.factorize(wid[at])[0]
    for k in range(1, n):
        code = pd.factorize((code << 32) | wid[at + k])[0]
    totals = np.bincount(code)
    first = np.zeros(len(totals), np.int64)
    first[code[::-1]] = at[::-1]
    return first, totals


class Counted:
    """The words of a chunk of texts, and what it sends of their n-grams."""

    def __init__(self, chunk: tb.Chunk, langs: pa.DictionaryArray):
        self.data, self.langs = _LOWER[chunk.data], langs.dictionary
        w = tb.words(chunk, _BETWEEN)
        self.starts, self.ends = w.starts, w.ends
        self.lang = np.asarray(langs.indices)[chunk.rows][w.doc()]
        salt = np.array([hash_of(x) for x in langs.dictionary.to_pylist()], np.uint64)
        self.h = tb.joined(word_hashes(self.data, self.starts, self.ends), salt[self.lang])
        self.next_too = np.zeros(len(self.h), bool)
        if len(self.h):
            self.next_too[:] = ~np.logical_or.reduceat(np.append(_ENDS[self.data], False), self.ends)
            self.next_too[w.offsets[1:][w.counts() > 0] - 1] = False

    @cached_property
    def numbers(self) -> np.ndarray:
        return pd.factorize(self.h)[0]

    def candidates(self, filters: list[Filter]):
        """For each length in turn the places of the n-grams in its filter; then, for the first length without filter, of those whose parts are in the one before."""
        at = np.arange(len(self.h))
        for n, f in enumerate(filters, 1):
            at = at[f.holds(gram_hashes(self.h, at, n))]
            yield n, at
            held = np.zeros(len(self.h) + 1, bool)
            held[at] = True
            at = at[self.next_too[at + n - 1] & held[at + 1]]
        yield len(filters) + 1, at

    def cells(self, at: np.ndarray, n: int, bits: int) -> pa.RecordBatch:
        """Rows (block, cells, times): how often n-grams fall into each cell."""
        cells, times = np.unique(cells_of(gram_hashes(self.h, at, n), bits), return_counts=True)
        width = np.uint64(block_bits(bits))
        block = (cells >> width).astype(np.int64)
        bounds = [*np.flatnonzero(np.diff(block, prepend=-1)).tolist(), len(block)]
        inner, times = (cells & ((np.uint64(1) << width) - np.uint64(1))).astype(np.uint32), times.astype(np.uint32)
        parts = lambda x: pa.array([x[i:j].tobytes() for i, j in pairwise(bounds)], pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(block[bounds[:-1]]), parts(inner), parts(times)], ["block", "cells", "times"])

    def whole(self, at: np.ndarray, n: int):
        """Rows (lang, gram, w), one for each n-gram."""
        first, totals = chunk_grams(self.numbers, at, n)
        for i in range(0, len(first), ROWS):
            own = first[i : i + ROWS]
            words = [_texts(self.data, self.starts[own + k], self.ends[own + k]) for k in range(n)]
            grams = words[0] if n == 1 else pc.binary_join_element_wise(*words, pa.scalar(" ", pa.large_string()))
            yield _rows(self.langs.take(pa.array(self.lang[own])), grams.cast(pa.string()), totals[i : i + ROWS])

    def lengths(self) -> pa.RecordBatch:
        """Each language's number of words, as that of the empty n-gram."""
        totals = np.bincount(self.lang, minlength=len(self.langs))
        return _rows(self.langs, pa.array([""] * len(totals), pa.string()), totals)


def _rows(langs: pa.Array, grams: pa.Array, totals: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([langs, grams, pa.array(totals.astype(np.int64))], ["lang", "gram", "w"])


def hash_of(text: str) -> int:
    import xxhash

    return xxhash.xxh64_intdigest(text.encode())


def block_bits(bits: int) -> int:
    return max(bits - BLOCKS, LEAST_CELLS)


def cells_of(hashes: np.ndarray, bits: int) -> np.ndarray:
    return hashes >> np.uint64(64 - bits)


@dataclass
class Filter:
    """A Bloom filter of cells of `bits` bits: what is in it by mistake costs a row, nothing is ever missing."""

    bitmap: np.ndarray
    width: int
    bits: int

    def holds(self, hashes: np.ndarray) -> np.ndarray:
        return sketch.present(self.bitmap, cells_of(hashes, self.bits), self.width)


def chunks_of(batches, filters: list[Filter]):
    """For each chunk of texts (lang, text) its words, and the lengths and places of the n-grams that may be frequent."""
    for batch in batches:
        langs = batch.column(0).dictionary_encode()
        for c in tb.chunks(batch.column(1), CHUNK):
            x = Counted(c, langs)
            yield x, x.candidates(filters)


def frequent(texts: DataFrame, filters: list[Filter], least: int, bits: int) -> Filter:
    """The filter of the next length, with 16 bits or more for each cell, twice, up to 2 ** MOST_BITS."""
    known = texts.sparkSession.sparkContext.broadcast(filters)
    block = block_bits(bits)

    def send(batches):
        for x, lengths in chunks_of(batches, known.value):
            *_, (n, at) = lengths
            if len(at):
                yield x.cells(at, n, bits)

    def add(group: pd.DataFrame) -> pd.DataFrame:
        cells, times = (np.frombuffer(b"".join(group[x]), np.uint32) for x in ("cells", "times"))
        often = np.flatnonzero(np.bincount(cells, times, 1 << block) >= least)
        return pd.DataFrame({"cell": often + (int(group["block"].iloc[0]) << block)})

    sent = texts.mapInArrow(send, "block long, cells binary, times binary")
    found = cut(sent.groupBy("block").applyInPandas(add, "cell long"))
    width = min(max((16 * found.count()).bit_length(), 20), MOST_BITS)
    return Filter(sketch.sketched(found, lambda batch: iter([np.asarray(batch.column(0)).view(np.uint64)]), width, 2, 1), width, bits)


def counts(texts: DataFrame, filters: list[Filter], least: int) -> DataFrame:
    """Rows (lang, gram, a): the n-grams in the filters that occur `least` times or more. Also, as the empty n-gram, each language's number of words."""
    known = texts.sparkSession.sparkContext.broadcast(filters)

    def send(batches):
        filters = known.value
        for x, lengths in chunks_of(batches, filters):
            yield x.lengths()
            for n, at in islice(lengths, len(filters)):
                yield from x.whole(at, n)

    sent = texts.mapInArrow(send, "lang string, gram string, w long")
    return sent.repartition("lang", "gram").groupBy("lang", "gram").agg(F.sum("w").alias("a")).where(F.col("a") >= least)


def with_parts(grams: DataFrame, most: int) -> DataFrame:
    """Rows (lang, phrase, size, a, l, r, score) of the n-grams (lang, gram, size, a) of two words and more, by their lowest-scoring cut."""
    words = F.split("gram", " ")
    cuts = F.transform(F.sequence(F.lit(1), F.col("size") - 1), lambda k: F.array(F.struct(k.alias("k"), F.lit(0).alias("side"), F.array_join(F.slice(words, F.lit(1), k), " ").alias("part")), F.struct(k.alias("k"), F.lit(1).alias("side"), F.array_join(F.slice(words, k + 1, F.col("size") - k), " ").alias("part"))))
    asked = grams.where("size > 1").select("lang", "gram", "size", "a", F.inline(F.flatten(cuts)))
    known = grams.select("lang", F.col("gram").alias("part"), F.col("a").alias("f"))
    answers = known.join(shuffled(asked.groupBy("lang", "part").agg(F.count("*").alias("asked"))), ["lang", "part"])
    told = join_counted(asked, cut(answers), ["lang", "part"], "asked")
    of = lambda k, side: F.max(F.when((F.col("k") == k) & (F.col("side") == side), F.col("f")))
    rows = told.groupBy("lang", "gram", "size", "a").agg(*(of(k, side).alias(f"f{k}_{side}") for k in range(1, most) for side in (0, 1)))
    big = lambda c: F.col(c).cast("decimal(14,0)")
    scored = lambda k: F.struct(whole(big("a") * big("a") * F.lit(1_000_000).cast("decimal(7,0)"), big(f"f{k}_0") * big(f"f{k}_1")).alias("score"), F.lit(k).alias("k"), F.col(f"f{k}_0").alias("l"), F.col(f"f{k}_1").alias("r"))
    lowest = F.array_min(F.filter(F.array(*(scored(k) for k in range(1, most))), lambda x: x["score"].isNotNull()))
    return rows.select("lang", F.col("gram").alias("phrase"), "size", "a", lowest.alias("cut")).select("lang", "phrase", "size", "a", "cut.l", "cut.r", "cut.score")


def whole(x: Column, y: Column) -> Column:
    """x div y for decimals, exactly."""
    return F.call_function("div", x, y)


def collocations(docs: DataFrame, most: int = 3, least: int = 10, share: int = 50, first: int = 2000, lang_col: str = "lang", text_col: str = "text") -> DataFrame:
    """Rows (lang, rank, phrase, a, l, r, n, score): each language's `first` best phrases of 2 to `most` words that occur `least` times or more.

    A phrase goes if a longer candidate that holds it has at least share / 100 of its occurrences.
    """
    texts = docs.select(F.coalesce(F.col(lang_col), F.lit("und")).alias("lang"), F.col(text_col).alias("text"))
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = min(max((size // 4).bit_length(), LEAST_CELLS), MOST_CELLS)  # a word with what is beside it has two bytes at least, mostly six
    filters: list[Filter] = []
    for _ in range(most):
        filters.append(frequent(texts, filters, least, bits))
    found = cut(counts(texts, filters, least))
    grams = found.where("gram != ''").withColumn("size", F.size(F.split("gram", " ")))
    total = found.where("gram = ''").groupBy("lang").agg(F.sum("a").alias("n"))
    words = F.split("gram", " ")
    inner = F.flatten(F.transform(F.sequence(F.lit(2), F.col("size") - 1), lambda s: F.transform(F.sequence(F.lit(1), F.col("size") - s + 1), lambda i: F.array_join(F.slice(words, i, s), " "))))
    longer = grams.where("size > 2").select("lang", "a", F.explode(F.array_distinct(inner)).alias("phrase")).groupBy("lang", "phrase").agg(F.max("a").alias("held"))
    kept = with_parts(grams, most).join(shuffled(longer), ["lang", "phrase"], "left").where(F.col("held").isNull() | (100 * F.col("held") < share * F.col("a")))
    order = [F.desc("score"), F.desc("a"), "phrase"]
    # the best of each part of a language first, so that no task ranks all its phrases
    part = F.pmod(F.xxhash64("phrase"), F.lit(PARTS))
    some = kept.withColumn("_part", part).withColumn("rank", F.row_number().over(Window.partitionBy("lang", "_part").orderBy(*order))).where(F.col("rank") <= first)
    best = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= first)
    return best.join(F.broadcast(total), "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
