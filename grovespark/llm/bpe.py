"""Byte-level BPE encoding and decoding by merge replay over a corpus slice.

The distinct pre-tokens of a slice of the corpus (SLICE_BYTES of a partition's
texts, or one longer text) lie one after another as a linked list of tokens. An inverted index
holds, for each rank, the positions of the token pairs that would merge into
it. Ranks are taken in rising order; each merge rewrites its positions and
looks up again only the pairs with their neighbours. The documents are then
put together from the encoded pre-tokens.

A task keeps a table of at most TABLE_WORDS encoded pre-tokens and drops it when
full: a matter of speed only. Nothing of it outlives the task.

Defined cases: a null text has no tokens; a null id stays null; repeated rows
give repeated rows; an empty table gives an empty result; columns other than
id and text are ignored, whatever their names; a text of any length is encoded
whole; of equal pairs in a chain the left one merges first.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterable
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textbatch as tb

TABLE_WORDS = 250_000
SLICE_BYTES = 8 << 20
NONE = np.int32(2**31 - 1)
_BAND = 512


class Ranks:
    """A vocabulary of byte strings, whose rank is both id and merge order."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        byte = [ranks[bytes([i])] for i in range(256)]
        self.byte = np.array(byte, np.int32)
        pairs = {}
        for token, rank in ranks.items():
            for i in range(1, len(token)):
                left, right = ranks.get(token[:i]), ranks.get(token[i:])
                if left is not None and right is not None:
                    pairs[left << 20 | right] = rank
        keys = np.fromiter(pairs, np.int64, len(pairs))
        order = np.argsort(keys)
        self.keys = np.append(keys[order], 2**62)
        self.merged = np.append(np.fromiter(pairs.values(), np.int32, len(pairs))[order], NONE)
        by_id = sorted(ranks.items(), key=lambda x: x[1])
        top = by_id[-1][1] + 1
        self.lengths = np.zeros(top, np.int64)
        self.lengths[[r for _, r in by_id]] = [len(t) for t, _ in by_id]
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.flat = np.frombuffer(b"".join(t for t, _ in by_id), np.uint8)

    def pair_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left.astype(np.int64) << 20 | right
        at = np.searchsorted(self.keys, key)
        return np.where(self.keys[at] == key, self.merged[at], NONE)

    def replay(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Token ids of all words, and how many each word has."""
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        flat = np.frombuffer(b"".join(words), np.uint8)
        n = len(flat)
        token = self.byte[flat]
        after = np.arange(1, n + 1, dtype=np.int32)
        before = np.arange(-1, n - 1, dtype=np.int32)
        ends = np.cumsum(lengths)
        after[ends[lengths > 0] - 1] = -1
        before[(ends - lengths)[lengths > 0]] = -1
        rank = np.full(n, NONE)
        inner = np.flatnonzero(after >= 0)
        rank[inner] = self.pair_ranks(token[inner], token[after[inner]])
        for low in range(0, len(self.lengths), _BAND):
            self._band(low, low + _BAND, token, after, before, rank)
        left = np.ones(n, bool)
        left[token < 0] = False
        return token[left].astype(np.uint32), np.bincount(np.repeat(np.arange(len(words)), lengths)[left], minlength=len(words))

    def _band(self, low, high, token, after, before, rank) -> None:
        """Replay the merges of ranks low <= r < high."""
        index: dict[int, list[np.ndarray]] = {}

        def post(at: np.ndarray) -> None:
            by = rank[at]
            order = np.argsort(by, kind="stable")
            at, by = at[order], by[order]
            cut = np.flatnonzero(by[1:] != by[:-1]) + 1
            for r, where in zip(by[np.append(0, cut)].tolist(), np.split(at, cut)):
                if r not in index:
                    index[r] = []
                    heapq.heappush(heap, r)
                index[r].append(where)

        heap: list[int] = []
        if len(at := np.flatnonzero((rank >= low) & (rank < high))):
            post(at)
        while heap:
            r = heapq.heappop(heap)
            posted = index.pop(r)
            at = posted[0] if len(posted) == 1 else np.unique(np.concatenate(posted))
            at = at[rank[at] == r]
            if not len(at):
                continue
            if len(at) > 1 and (chained := after[at[:-1]] == at[1:]).any():  # in a chain every second pair is used up
                head = np.append(True, ~chained)
                place = np.arange(len(at))
                at = at[(place - np.maximum.accumulate(np.where(head, place, 0))) % 2 == 0]
            used = after[at]
            following = after[used]
            token[at] = r
            after[at] = following
            token[used] = -1
            rank[used] = NONE
            more = following >= 0
            before[following[more]] = at[more]
            rank[at[~more]] = NONE
            ahead = before[at]
            touched = np.concatenate([at[more], ahead[ahead >= 0]])
            if len(touched):
                new = self.pair_ranks(token[touched], token[after[touched]])
                rank[touched] = new
                if len(now := touched[(new >= low) & (new < high)]):
                    post(np.unique(now))
                if (new < low).any():  # a rank below the band: go back for it
                    self._band(0, low, token, after, before, rank)

    def decoded(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bytes of all ids one after another, and where each id's begin (and the end)."""
        return tb.gathered(self.flat, self.starts, self.lengths, ids)


@cache
def load_ranks(path: str) -> Ranks:
    """A file of lines "base64 token, rank"."""
    with open(path, "rb") as lines:
        return Ranks({base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)})


class WordTable:
    """Encoded pre-tokens: ids lie in one growing array."""

    def __init__(self, encode, most: int = TABLE_WORDS):
        self.encode, self.most, self.codes = encode, most, {}
        self.ids, self.starts, self.lengths = tb.Growing(np.uint32), tb.Growing(np.int64), tb.Growing(np.int64)

    def add(self, words: Iterable[str]) -> None:
        """Encode those of the words (each given once) that are new."""
        new = [w for w in words if w not in self.codes]
        if not new:
            return
        if self.codes and len(self.codes) + len(new) > self.most:
            self.__init__(self.encode, self.most)
            new = list(words)
        ids, lengths = self.encode(new)
        self.codes.update(zip(new, range(len(self.codes), len(self.codes) + len(new))))
        self.starts.add(len(self.ids) + np.cumsum(lengths) - lengths)
        self.lengths.add(lengths)
        self.ids.add(ids)

    def assemble(self, pieces: tb.Pieces) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one after another, and where each text's begin (and the end)."""
        codes = np.fromiter(map(self.codes.__getitem__, pieces.distinct), np.int64, len(pieces.distinct))[pieces.codes]
        ids, begin = tb.gathered(self.ids.all(), self.starts.all(), self.lengths.all(), codes)
        return ids, begin[pieces.offsets]


def encode_words(ranks: Ranks, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """A word that is a token as a whole is that token; the others are merged."""
    raw = [w.encode() for w in words]
    ids, lengths = ranks.replay([b"" if w in ranks.ranks else w for w in raw])
    whole = np.array([ranks.ranks.get(w, -1) for w in raw], np.int64)
    known = np.flatnonzero(whole >= 0)
    begin = np.cumsum(lengths) - lengths
    lengths[known] = 1
    return np.insert(ids, begin[known], whole[known]), lengths


def word_table(path: str) -> WordTable:
    ranks = load_ranks(path)
    return WordTable(lambda words: encode_words(ranks, words))


def binaries(flat: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """A binary column whose values lie in flat, cut at offsets (of items)."""
    size = flat.dtype.itemsize
    return pa.Array.from_buffers(pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer((offsets * size).astype(np.int64)), pa.py_buffer(np.ascontiguousarray(flat))]).cast(pa.binary())


def encode(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text", decoded: bool = False) -> DataFrame:
    """Rows (id, ids): the token ids of each text as little-endian unsigned 32-bit integers.

    vocabulary: path of a rank file that every worker can read. decoded: adds what decode() would, in the same pass.
    """

    def run(batches):
        table, ranks = word_table(vocabulary), load_ranks(vocabulary)
        for batch in batches:
            for own in tb.slices(batch.column(1), SLICE_BYTES):
                cut = [(c.rows, tb.pieces([c.bytes_of(i).decode() for i in range(len(c))], True)) for c in own]
                words = set().union(*(p.distinct for _, p in cut))
                if len(words) <= TABLE_WORDS:
                    table.add(words)
                del words
                for rows, p in cut:
                    table.add(p.distinct)
                    ids, offsets = table.assemble(p)
                    columns = {id_col: batch.column(0)[rows], "ids": binaries(ids, offsets)}
                    if decoded:
                        text, begin = ranks.decoded(ids)
                        columns["decoded"] = binaries(text, begin[offsets])
                    yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))
            tb.release()

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(run, f"`{id_col}` {kind}, ids binary" + ", decoded binary" * decoded)


def decode(encoded: DataFrame, vocabulary: str, id_col: str = "doc_id") -> DataFrame:
    """Rows (id, ids, decoded) of rows (id, ids): the bytes that the ids stand for."""

    def run(batches):
        ranks = load_ranks(vocabulary)
        for batch in batches:
            for c in tb.chunks_of_binary(batch.column(1)):
                text, begin = ranks.decoded(c.data.view(np.uint32))
                yield pa.RecordBatch.from_arrays([batch.column(0)[c.rows], batch.column(1)[c.rows], binaries(text, begin[c.offsets // 4])], names=[id_col, "ids", "decoded"])

    kind = encoded.schema[id_col].dataType.simpleString()
    return encoded.select(id_col, "ids").mapInArrow(run, f"`{id_col}` {kind}, ids binary, decoded binary")
