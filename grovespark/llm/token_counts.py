"""Token counts by prefix dynamic programming, for BPE vocabularies with word ends.

The encoding of a prefix of a word ends in exactly one token that can follow
the encoding of the shorter prefix before it. So, walking once over a word,
the table keeps for each prefix its last token and its token count, both as a
part of a longer word (open) and as a word of its own (closed). The counts of
any prefix of a text follow from these by addition, and truncation and budget
questions need no second encoding.

Defined cases: a null text has no bytes and no tokens; a null id stays null;
repeated rows give repeated rows; an empty table gives an empty result;
columns other than id and text are ignored, whatever their names. The special
strings of the vocabulary count as one token each, as in its library. A text of
any length is counted whole, also one that is a single word; there are no ties.
"""

from __future__ import annotations

import json
import re
from functools import cache, cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from . import textbatch as tb
from .textbatch import U64

TABLE_WORDS = 600_000  # kept by a worker process between batches and tasks; dropped when full
LONG_WORD = 128  # bytes; longer words are walked over one at a time
_SLOTS = 22


def _byte_letters() -> dict[str, int]:
    """Byte-level vocabularies write each byte as a printable character: by rule, not by table."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Lookup:
    """Ids of byte strings by their hash, read from the last byte to the first."""

    def __init__(self, tokens: dict[bytes, int]):
        hashes = {}
        for token, i in tokens.items():
            h = 0
            for n, b in enumerate(reversed(token)):
                h = (h + int(tb._BYTE_HASH[b]) * pow(tb._BASE, n, 2**64)) % 2**64
            hashes[h] = i
        if len(hashes) < len(tokens):
            raise ValueError("two tokens share a hash")
        keys = tb.mixed(np.fromiter(hashes, np.uint64, len(hashes)))
        order = np.argsort(keys)
        self.keys = np.append(keys[order], U64(2**64 - 1))
        self.ids = np.append(np.fromiter(hashes.values(), np.int32, len(hashes))[order], -1)
        self.slots = np.zeros(1 << _SLOTS, bool)
        self.slots[keys >> U64(64 - _SLOTS)] = True
        self.longest = max(map(len, tokens), default=0)

    def find(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where in h there are tokens, and which."""
        h = tb.mixed(h)
        maybe = np.flatnonzero(self.slots[h >> U64(64 - _SLOTS)])
        at = np.searchsorted(self.keys, h[maybe])
        hit = self.keys[at] == h[maybe]
        return maybe[hit], self.ids[at[hit]]


class Vocabulary:
    def __init__(self, path: str):
        with open(path) as f:
            spec = json.load(f)
        model = spec["model"]
        self.normalizer = Tokenizer.from_file(path).normalizer
        self.suffix = model["end_of_word_suffix"]
        letters = _byte_letters()
        self.special = [x["content"] for x in spec["added_tokens"]]
        ids = {t: i for t, i in model["vocab"].items() if t not in self.special}
        n = max(ids.values()) + 1
        self.rank, self.left, self.right = np.full(n, -1, np.int64), np.zeros(n, np.int64), np.zeros(n, np.int64)
        reached = np.zeros(n, bool)
        reached[[ids[c] for c in letters] + [ids[c + self.suffix] for c in letters]] = True
        merges = np.array([(ids[a], ids[b], ids[a + b]) for a, b in (m if isinstance(m, list) else m.split(" ") for m in model["merges"])], np.int64).reshape(-1, 3)
        a, b, made = merges.T
        self.left[made], self.right[made], self.rank[made] = a, b, np.arange(len(made))
        keys = a << 20 | b
        order = np.argsort(keys)
        self.keys, self.ranks = np.append(keys[order], 2**62), np.append(order, 2**40)
        apart = self.follows(a, b, np.arange(len(made)))
        for x, y, z, ok in zip(a.tolist(), b.tolist(), made.tolist(), apart.tolist()):
            reached[z] = ok and reached[x] and reached[y]
        inner, final = {}, {}
        for token, i in ids.items():
            if reached[i]:  # a token that no merge reaches never occurs
                closed = token.endswith(self.suffix)
                raw = bytes(letters[c] for c in (token[: -len(self.suffix)] if closed else token))
                (final if closed else inner)[raw] = i
        self.inner, self.final = Lookup(inner), Lookup(final)

    def follows(self, left: np.ndarray, right: np.ndarray, limit: np.ndarray | None = None) -> np.ndarray:
        """Whether the token right can come next after the token left in an encoding: no merge ever crosses
        the border between them. Their last merges are undone, latest first; of equal ranks the left one ran
        first. limit: look only at merges before these ranks.
        """
        pairs, back = np.unique(left.astype(np.int64) << 20 | right, return_inverse=True) if limit is None else (left << 20 | right, slice(None))
        a, b = pairs >> 20, pairs & 0xFFFFF
        limit = np.full(len(a), 2**40) if limit is None else limit
        out, live = np.ones(len(a), bool), np.arange(len(a))
        while len(live):
            key = a << 20 | b
            at = np.searchsorted(self.keys, key)
            crossed = (self.keys[at] == key) & (self.ranks[at] < limit)
            out[live[crossed]] = False
            by_a, by_b = self.rank[a], self.rank[b]
            go = ~crossed & ((by_a >= 0) | (by_b >= 0))
            live, a, b, by_a, by_b = live[go], a[go], b[go], by_a[go], by_b[go]
            undo_b = by_b >= by_a
            limit = np.where(undo_b, by_b + 1, by_a)
            a, b = np.where(undo_b, a, self.right[a]), np.where(undo_b, self.left[b], b)
        return out[back]

    @cached_property
    def _merges(self) -> tuple[dict[int, int], list[int], list[int], list[int]]:
        return dict(zip(self.keys[:-1].tolist(), self.ranks[:-1].tolist())), self.rank.tolist(), self.left.tolist(), self.right.tolist()

    def follows_one(self, a: int, b: int) -> bool:
        """The same for one pair."""
        merges, rank, left, right = self._merges
        limit = 2**40
        while True:
            if merges.get(a << 20 | b, limit) < limit:
                return False
            by_a, by_b = rank[a], rank[b]
            if by_a < 0 and by_b < 0:
                return True
            if by_b >= by_a:
                limit, b = by_b + 1, left[b]
            else:
                limit, a = by_a, right[a]

    def long_counts(self, values: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Open and closed counts of long words' prefixes: the tokens that may end at each byte are looked up for all bytes at once.

        values: the bytes' hashes, one word after another; first: where each byte's word begins.
        """
        n = len(values)
        power = tb.powers(max(self.inner.longest, self.final.longest) + 1)
        h, found = np.zeros(n, np.uint64), []
        for size in range(1, min(n, len(power) - 1) + 1):
            h = h[1:] if size > 1 else h  # of the `size` bytes that end at each byte from size - 1 on
            h = h + values[: n - size + 1] * power[size - 1]
            for lookup, final in ((self.inner, 0), (self.final, 1)):
                if size <= lookup.longest:
                    at, token = lookup.find(h)
                    inside = at >= first[at + size - 1]
                    at, token = at[inside], token[inside]
                    found.append(np.stack([at + size - 1, np.full(len(at), size), np.full(len(at), final), token]))
        found = np.concatenate(found, 1)
        end, size, final, token = (x.tolist() for x in found[:, np.argsort(found[0], kind="stable")])
        begin = first.tolist()
        last, opened, closed, known = [-1] * n, [0] * n, [0] * n, {}
        for i, k, f, t in zip(end, size, final, token):
            have = 0
            if i - k >= begin[i]:
                before = last[i - k]
                fit = known.get(pair := before << 20 | t)
                if fit is None:
                    fit = known[pair] = self.follows_one(before, t)
                if not fit:
                    continue
                have = opened[i - k]
            if f:
                closed[i] = have + 1
            else:
                last[i], opened[i] = t, have + 1
        return np.array(opened, np.int32), np.array(closed, np.int32)

    def prefix_counts(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For each prefix of 1.. bytes of all words, one word after another: its open and its closed token count; and where each word's begin."""
        order = sorted((i for i in range(len(words)) if len(words[i]) <= LONG_WORD), key=lambda i: -len(words[i]))
        length = np.array([len(words[i]) for i in order], np.int64)
        begin_of = np.zeros(len(words) + 1, np.int64)
        np.cumsum([len(w) for w in words], out=begin_of[1:])
        begin = begin_of[:-1][order]
        values = tb._BYTE_HASH[np.frombuffer(b"".join(words), np.uint8)]
        n = len(values)
        last, opened, closed = np.full(n, -1, np.int32), np.zeros(n, np.int32), np.zeros(n, np.int32)
        power = tb.powers(max(self.inner.longest, self.final.longest) + 1)
        size = np.diff(begin_of)
        if (size > LONG_WORD).any():
            own = np.repeat(size > LONG_WORD, size)
            size = size[size > LONG_WORD]
            opened[own], closed[own] = self.long_counts(values[own], np.repeat(np.cumsum(size) - size, size))
        for i in range(1, int(length[0]) + 1 if len(length) else 0):
            here = begin[: np.searchsorted(-length, -i, "right")] + i - 1  # of the words that have an i-th byte
            h = np.zeros(len(here), np.uint64)
            for size in range(1, min(i, len(power) - 1) + 1):
                h += values[here - size + 1] * power[size - 1]
                for lookup, count in ((self.inner, opened), (self.final, closed)):
                    if size > lookup.longest:
                        continue
                    at, token = lookup.find(h)
                    if not len(at):
                        continue
                    at = here[at]
                    if size < i:
                        fit = self.follows(last[at - size], token)
                        at, token = at[fit], token[fit]
                        count[at] = opened[at - size] + 1
                    else:
                        count[at] = 1
                    if lookup is self.inner:
                        last[at] = token
        return opened, closed, begin_of


@cache
def load_vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


@cache
def worker_table(path: str) -> PrefixTable:
    return PrefixTable(load_vocabulary(path))


_BEYOND_LATIN = re.compile("[^\\x00-\u024f]")


def normalized(text: str, normalizer) -> str:
    """What the library makes of a text: NFC and lower case. Latin letters, of which none combine, need no library for that."""
    return normalizer.normalize_str(text) if _BEYOND_LATIN.search(text) else text.lower()


class PrefixTable:
    """Closed counts of all prefixes of the words met so far, by code point."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary, self.codes = vocabulary, {}
        self.counts, self.starts, self.lengths = tb.Growing(np.int32), tb.Growing(np.int64), tb.Growing(np.int64)

    def add(self, words: list[str]) -> None:
        new = [w for w in dict.fromkeys(words) if w not in self.codes]
        if not new:
            return
        if self.codes and len(self.codes) + len(new) > TABLE_WORDS:
            self.__init__(self.vocabulary)
            new = list(dict.fromkeys(words))
        raw = [w.encode() for w in new]
        _, closed, begin = self.vocabulary.prefix_counts(raw)
        data = np.frombuffer(b"".join(raw), np.uint8)
        whole = np.append((data[1:] & 0xC0) != 0x80, True)  # where a character ends
        self.codes.update(zip(new, range(len(self.codes), len(self.codes) + len(new))))
        chars = tb.per_doc(whole, begin)
        self.starts.add(len(self.counts) + np.cumsum(chars) - chars)
        self.lengths.add(chars)
        self.counts.add(closed[whole])

    def of(self, pieces: tb.Pieces) -> np.ndarray:
        return np.fromiter(map(self.codes.__getitem__, pieces.distinct), np.int64, len(pieces.distinct))[pieces.codes]

    def full(self, code: np.ndarray) -> np.ndarray:
        """The counts of whole words."""
        return self.counts.all()[self.starts.all()[code] + self.lengths.all()[code] - 1]

    def prefixes(self, code: int) -> np.ndarray:
        """The counts of one word's prefixes."""
        first = self.starts.all()[code]
        return self.counts.all()[first : first + self.lengths.all()[code]]


def _cut(texts: list[str], v: Vocabulary) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Normalized stretches between special strings; of which text each is; and the count of special strings of each text."""
    split = re.compile("|".join(map(re.escape, v.special))).split if v.special else lambda x: [x]
    parts = [split(x) for x in texts]
    size = np.array([len(p) for p in parts], np.int64)
    return [normalized(x, v.normalizer) for p in parts for x in p], np.repeat(np.arange(len(texts)), size), size - 1


def _prepared(column: pa.Array, v: Vocabulary, table: PrefixTable):
    """Chunks of a text column, cut, with all their words in the table."""
    out = []
    for c in tb.chunks(column):
        texts, of, extra = _cut([c.bytes_of(i).decode() for i in range(len(c))], v)
        out.append((c, of, extra, tb.pieces(texts, False)))
    if len(set().union(*(p.distinct for *_, p in out))) <= TABLE_WORDS:
        table.add([w for *_, p in out for w in p.distinct])
    for x in out:
        table.add(x[-1].distinct)
        yield x


def count(docs: DataFrame, vocabulary: str, limit: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (id, n_bytes, n_tokens, over_limit, fit_tokens): fit_tokens is the token count of the longest
    prefix (of the normalized text, cut inside a word if need be) that has at most `limit` tokens.
    """

    def run(batches):
        v, table = load_vocabulary(vocabulary), worker_table(vocabulary)
        for batch in batches:
            for c, of, extra, p in _prepared(batch.column(1), v, table):
                code = table.of(p)
                full = table.full(code)
                total = np.zeros(len(full) + 1, np.int64)
                np.cumsum(full, out=total[1:])
                by_part = total[p.offsets[1:]] - total[p.offsets[:-1]]
                tokens = np.bincount(of, weights=by_part, minlength=len(c)).astype(np.int64) + extra
                fit = tokens.copy()
                for i in np.flatnonzero(tokens > limit).tolist():
                    fit[i] = _fit(table, code, total, p.offsets, np.flatnonzero(of == i), limit)
                yield pa.RecordBatch.from_arrays([batch.column(0)[c.rows], pa.array(np.diff(c.offsets)), pa.array(tokens), pa.array(tokens > limit), pa.array(fit)], names=[id_col, "n_bytes", "n_tokens", "over_limit", "fit_tokens"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(run, f"`{id_col}` {kind}, n_bytes long, n_tokens long, over_limit boolean, fit_tokens long")


def _fit(table: PrefixTable, code: np.ndarray, total: np.ndarray, offsets: np.ndarray, parts: np.ndarray, limit: int) -> int:
    """Tokens of the longest prefix of a text within the limit, from the stored prefix counts."""
    have = 0
    for k, part in enumerate(parts.tolist()):
        if k:
            have += 1  # the special string before this stretch
            if have > limit:
                return have - 1
        a, b = int(offsets[part]), int(offsets[part + 1])
        if have + total[b] - total[a] <= limit:
            have += int(total[b] - total[a])
            continue
        at = int(np.searchsorted(total, limit - have + total[a], "right")) - 1  # this many words fit whole
        have += int(total[at] - total[a])
        word = table.prefixes(code[at])
        fits = np.flatnonzero(word <= limit - have)
        return have + (int(word[fits[-1]]) if len(fits) else 0)
    return have


def prefix_table(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (id, ends, tokens): after the first ends[i] words and special strings a text has tokens[i] tokens."""

    def run(batches):
        v, table = load_vocabulary(vocabulary), worker_table(vocabulary)
        for batch in batches:
            for c, of, _, p in _prepared(batch.column(1), v, table):
                code = table.of(p)
                full = table.full(code).tolist()
                out: list[list[int]] = [[] for _ in range(len(c))]
                for part, i in enumerate(of.tolist()):
                    if part and of[part - 1] == i:
                        out[i].append(1)
                    out[i] += full[p.offsets[part] : p.offsets[part + 1]]
                sums = [np.cumsum(x, dtype=np.int64).tolist() for x in out]
                yield pa.RecordBatch.from_arrays([batch.column(0)[c.rows], pa.array([list(range(1, len(x) + 1)) for x in out], pa.list_(pa.int64())), pa.array(sums, pa.list_(pa.int64()))], names=[id_col, "ends", "tokens"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(run, f"`{id_col}` {kind}, ends array<bigint>, tokens array<bigint>")


def tokens_within(table: DataFrame, budget: int, id_col: str = "doc_id") -> DataFrame:
    """Rows (id, n_words, n_tokens): how much of each text's prefix table fits a token budget. No text is read again."""
    fits = F.filter("tokens", lambda x: x <= budget)
    return table.select(id_col, F.size(fits).cast("long").alias("n_words"), F.coalesce(F.get(fits, F.size(fits) - 1), F.lit(0)).cast("long").alias("n_tokens"))
