"""Numpy helpers over the string column of one Arrow batch.

Every function works on whole texts. A batch is cut between documents into
chunks of about a megabyte, so memory in a task follows the chunk and the
longest single text, never the partition. Null texts count as empty ones.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U64 = np.uint64
CHUNK_BYTES = 1 << 20

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_BYTE_HASH = np.random.default_rng(20240229).integers(1, 2**63, 256, dtype=np.uint64)
_LOWER_HASH = _BYTE_HASH.copy()
_LOWER_HASH[ord("A") : ord("Z") + 1] = _BYTE_HASH[ord("a") : ord("z") + 1]
_BASE = 0x9E3779B97F4A7C15
_M1, _M2 = U64(0xBF58476D1CE4E5B9), U64(0x94D049BB133111EB)


def powers(n: int) -> np.ndarray:
    """_BASE ** i modulo 2 ** 64."""
    out = np.full(max(n, 1), U64(_BASE))
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values."""
    x = x ^ (x >> U64(30))
    x *= _M1
    x ^= x >> U64(27)
    x *= _M2
    x ^= x >> U64(31)
    return x


def joined(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Hash of the sequence a, b."""
    return mixed(a * U64(_BASE) + ((b << U64(29)) | (b >> U64(35))))


@dataclass
class Chunk:
    """Some documents of a batch, their UTF-8 bytes one after another."""

    rows: slice
    data: np.ndarray
    offsets: np.ndarray  # byte offset of each document, and the end

    def __len__(self) -> int:
        return len(self.offsets) - 1

    def bytes_of(self, i: int) -> bytes:
        return self.data[self.offsets[i] : self.offsets[i + 1]].tobytes()


def chunks(column: pa.Array, most: int = CHUNK_BYTES) -> Iterator[Chunk]:
    """The documents of a string column, in chunks of about `most` bytes, cut between documents."""
    yield from _chunks(pc.fill_null(column.cast(pa.large_string()), ""), most)


def slices(column: pa.Array, most: int) -> Iterator[list[Chunk]]:
    """The same chunks, in groups of about `most` bytes."""
    held, size = [], 0
    for c in chunks(column):
        if held and size + len(c.data) > most:
            yield held
            held, size = [], 0
        held.append(c)
        size += len(c.data)
    if held:
        yield held


def release() -> None:
    """Give memory that Arrow holds free back to the system."""
    pa.default_memory_pool().release_unused()


def chunks_of_binary(column: pa.Array, most: int = CHUNK_BYTES) -> Iterator[Chunk]:
    """The same for a binary column; each chunk's bytes are aligned anew."""
    for c in _chunks(pc.fill_null(column.cast(pa.large_binary()), b""), most):
        yield Chunk(c.rows, c.data.copy(), c.offsets)


def _chunks(column: pa.Array, most: int) -> Iterator[Chunk]:
    n = len(column)
    if not n:
        return
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64, n + 1, column.offset * 8)
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    first = 0
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + most, "right")) - 1
        last = min(n, max(last, first + 1))
        yield Chunk(slice(first, last), data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first])
        first = last


@dataclass
class Words:
    """Words `[^\\x20\\x09-\\x0D]+` of a chunk: byte starts and ends, and where each document's begin."""

    starts: np.ndarray
    ends: np.ndarray
    offsets: np.ndarray

    def counts(self) -> np.ndarray:
        return np.diff(self.offsets)

    def doc(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.offsets) - 1), self.counts())


def words(chunk: Chunk, space: np.ndarray = _SPACE) -> Words:
    """space: for each byte whether it stands between words."""
    word = np.zeros(len(chunk.data) + 1, bool)
    word[:-1] = ~space[chunk.data]
    before = np.zeros_like(word)
    before[1:] = word[:-1]
    edge = word != before
    inner = np.unique(chunk.offsets[1:-1])  # once each: an empty text repeats an offset
    both = inner[word[inner] & before[inner]]  # one document ends with a word and the next begins with one
    starts = np.sort(np.concatenate([np.flatnonzero(edge & word), both]))
    ends = np.sort(np.concatenate([np.flatnonzero(edge & ~word), both]))
    return Words(starts, ends, np.searchsorted(starts, chunk.offsets))


def segment_hash(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each stretch of values (uint64); values outside all stretches must be 0."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    length = ends - starts
    at = np.arange(len(values)) - np.repeat(starts, np.diff(np.append(starts, len(values))), axis=0) if starts[0] == 0 else None
    if at is None:
        at = np.arange(starts[0], len(values)) - np.repeat(starts, np.diff(np.append(starts, len(values))))
        values = values[starts[0] :]
        starts = starts - starts[0]
    np.minimum(at, int(length.max()), out=at)
    h = np.add.reduceat(values * powers(int(length.max()) + 1)[at], starts)
    return mixed(h + mixed(length.astype(np.uint64)))


def word_hashes(chunk: Chunk, w: Words, lower: bool = False, space: np.ndarray = _SPACE) -> np.ndarray:
    """A 64-bit hash of each word; lower: A-Z count as a-z."""
    values = (_LOWER_HASH if lower else _BYTE_HASH)[chunk.data]
    values[space[chunk.data]] = 0
    return segment_hash(values, w.starts, w.ends)


def ngram_hashes(h: np.ndarray, n: int) -> np.ndarray:
    """Hash of every n neighbours in h, by doubling; windows that cross documents are the caller's to drop."""
    if len(h) < n:
        return np.zeros(0, np.uint64)
    out, have, power, size = None, 0, h, 1
    while True:
        if n & size:
            if out is None:
                out, have = power, size
            else:
                m = min(len(out), len(power) - have)
                out, have = joined(out[:m], power[have : have + m]), have + size
        if have == n:
            return out
        power = joined(power[:-size], power[size:])
        size *= 2


def whole_windows(offsets: np.ndarray, n: int, total: int) -> np.ndarray:
    """Which of the `total` windows of n neighbours lie in one document."""
    ok = np.zeros(total, bool)
    starts, ends = offsets[:-1], np.maximum(offsets[1:] - n + 1, offsets[:-1])
    edge = np.zeros(total + 1, np.int32)
    np.add.at(edge, np.minimum(starts, total), 1)
    np.add.at(edge, np.minimum(ends, total), -1)
    np.greater(np.cumsum(edge[:-1]), 0, out=ok)
    return ok


def covered(starts: np.ndarray, ends: np.ndarray, total: int) -> np.ndarray:
    """Which of `total` positions lie in one of the spans [start, end)."""
    edge = np.zeros(total + 1, np.int32)
    np.add.at(edge, starts, 1)
    np.add.at(edge, ends, -1)
    return np.cumsum(edge[:-1]) > 0


def per_doc(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sum of flags in each document."""
    total = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=total[1:])
    return total[offsets[1:]] - total[offsets[:-1]]


#: Code points with the Unicode property White_Space.
WHITE_SPACE = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
SPACES, LETTERS, NUMBERS, OTHERS = 0, 1, 2, 3


@cache
def char_classes() -> np.ndarray:
    """The class of every code point, as the tokenizer libraries' own Unicode tables give it."""
    import tiktoken

    everything = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    byte = {bytes([i]): i for i in range(256)}
    table = np.full(0x110000, OTHERS, np.uint8)
    for pattern, kind in ((r"\p{L}+", LETTERS), (r"\p{N}+", NUMBERS)):
        library = tiktoken.Encoding("classes", pat_str=pattern, mergeable_ranks=byte, special_tokens={})  # what it does not match has no tokens
        table[np.frombuffer(library.decode(library.encode_ordinary(everything)).encode("utf-32-le"), np.uint32)] = kind
    table[WHITE_SPACE] = SPACES
    return table


class Growing:
    """An array that grows at its end without copying all of it each time."""

    def __init__(self, kind: type):
        self.held, self.n = np.zeros(1024, kind), 0

    def __len__(self) -> int:
        return self.n

    def add(self, values: np.ndarray) -> None:
        n = self.n + len(values)
        if n > len(self.held):
            self.held = np.append(self.held[: self.n], np.zeros(2 * n - self.n, self.held.dtype))
        self.held[self.n : n] = values
        self.n = n

    def all(self) -> np.ndarray:
        return self.held[: self.n]


@dataclass
class Pieces:
    """Pre-tokens of some texts: a code for each, the distinct ones by code, and where each text's begin."""

    codes: np.ndarray
    distinct: list[str]
    offsets: np.ndarray


def pieces(texts: list[str], spaced: bool) -> Pieces:
    """Cut texts as byte-pair tokenizers do before merging.

    spaced: as `'s|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+`.
    Else as `'s|'t|'re|'ve|'m|'ll|'d|\\p{L}+|\\p{N}|[^\\s\\p{L}\\p{N}]+`, dropping what is between.
    """
    import pandas as pd

    text = "".join(texts)
    n = len(text)
    ends_of = np.cumsum([0, *map(len, texts)])
    if not n:
        return Pieces(np.zeros(0, np.int64), [], np.zeros(len(texts) + 1, np.int64))
    cp = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    kind = char_classes()[cp]
    first = np.zeros(n + 1, bool)  # of a text
    first[ends_of] = True
    run = np.ones(n + 1, bool)
    run[1:-1] = kind[1:] != kind[:-1]
    run |= first
    at = np.flatnonzero(run[:-1])  # starts of runs of one class
    after = np.append(at[1:], n)
    cls = kind[at]
    begin = run[:-1].copy()
    if spaced:
        led = at[(cls != SPACES) & ~first[at] & (cp[at - 1] == 0x20)]
        begin[led] = False
        begin[led - 1] = True
        last = after[(cls == SPACES) & ~first[after]] - 1
        begin[last] = True
    else:
        begin |= kind == NUMBERS
    lone = at[(cls == OTHERS) & (after - at == 1) & (cp[at] == 0x27) & ~first[at + 1]]
    if spaced:
        lone = lone[first[lone] | (cp[lone - 1] != 0x20)]
    if len(lone):
        a = cp[np.minimum(lone + 1, n - 1)]
        b = np.where(first[np.minimum(lone + 2, n)], 0, cp[np.minimum(lone + 2, n - 1)])
        short = np.isin(a, [ord(x) for x in "stmd"])
        long = ((a == ord("r")) & (b == ord("e"))) | ((a == ord("v")) & (b == ord("e"))) | ((a == ord("l")) & (b == ord("l")))
        begin[lone[short | long] + 1] = False
        for where in (lone[short] + 2, lone[long] + 3):
            begin[where[where < n]] = True
    starts = np.flatnonzero(begin)
    ends = np.append(starts[1:], n)
    values = mixed(cp.astype(np.uint64) + U64(0x51ED270B))
    if not spaced:
        keep = kind[starts] != SPACES
        values[kind == SPACES] = 0
        starts, ends = starts[keep], ends[keep]
        if not len(starts):
            return Pieces(np.zeros(0, np.int64), [], np.zeros(len(texts) + 1, np.int64))
    codes, kinds = pd.factorize(segment_hash(values, starts, ends))
    where = np.full(len(kinds), -1, np.int64)
    where[codes[::-1]] = np.arange(len(codes))[::-1]
    distinct = [text[i:j] for i, j in zip(starts[where].tolist(), ends[where].tolist())]
    return Pieces(codes, distinct, np.searchsorted(starts, ends_of))


def gathered(flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The stretches of flat named by codes, one after another, and where each begins (and the end)."""
    n = lengths[codes]
    begin = np.zeros(len(codes) + 1, np.int64)
    np.cumsum(n, out=begin[1:])
    return flat[np.arange(begin[-1]) + np.repeat(starts[codes] - begin[:-1], n)], begin
