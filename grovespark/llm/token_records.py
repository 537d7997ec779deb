"""Token ids as length-delimited binary records with a separate offset index.

A record is: payload length (8 bytes), masked CRC-32C of the length (4 bytes),
payload, masked CRC-32C of the payload (4 bytes); all integers little-endian.
A payload is: document id (signed 64 bits; the least value stands for null),
bytes per token id (4 bytes, 2 or 4), token ids. For every `<part>.rec` a
`<part>.idx` holds, for each record, its byte offset, its token count and the
count of tokens before it in the part (three signed 64-bit integers), so a
reader can take records in any order.

Documents go to parts by ranges of their id and are written in ascending order.
A part is written under a name of its attempt and then renamed, so a task that
runs again after a lost executor, or twice, leaves the same file.

Defined cases: a null text has only the end id; a null id sorts first and is
read back as null; repeated rows are all written, ties in the order of a hash
of the text and then the text; an empty table writes no parts; columns other
than id and text are ignored, whatever their names; a text of any length is
one record (its length has 64 bits).
"""

from __future__ import annotations

import os
import re
import uuid
import zlib
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textbatch as tb
from .bpe import WordTable

NULL_ID = -(2**63)
TABLE_WORDS = 600_000  # kept by a worker process; dropped when full
BATCH_WORDS = 2_000
_POLYNOMIAL = 0x82F63B78  # CRC-32C, bits reversed
_BLOCK = 64


@cache
def _byte_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> np.uint32(1)) ^ np.uint32(_POLYNOMIAL), table >> np.uint32(1))
    return table


@cache
def _after_zeros(n: int) -> np.ndarray:
    """Four tables of 256: what n zero bytes make of each byte of a CRC state; n is _BLOCK times a power of two."""
    if n == _BLOCK:
        state = (np.arange(256, dtype=np.uint32)[None, :] << (np.arange(4, dtype=np.uint32)[:, None] * np.uint32(8))).ravel()
        for _ in range(n):
            state = _byte_table()[state & np.uint32(255)] ^ (state >> np.uint32(8))
        return state.reshape(4, 256)
    half = _after_zeros(n // 2)
    return _shifted(half.ravel(), n // 2).reshape(4, 256)


def _shifted(state: np.ndarray, n: int) -> np.ndarray:
    t = _after_zeros(n)
    return t[0][state & np.uint32(255)] ^ t[1][state >> np.uint32(8) & np.uint32(255)] ^ t[2][state >> np.uint32(16) & np.uint32(255)] ^ t[3][state >> np.uint32(24)]


def masked_crcs(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Masked CRC-32C of each stretch of bytes (4 bytes or more each).

    Each stretch is filled up in front with zeros to whole blocks, which a zero
    state does not notice; the blocks' states are joined in pairs.
    """
    blocks = -(-lengths // _BLOCK)
    offsets = np.zeros(len(lengths) + 1, np.int64)
    np.cumsum(blocks, out=offsets[1:])
    padded = np.zeros(int(offsets[-1]) * _BLOCK, np.uint8)
    target = offsets[1:] * _BLOCK - lengths
    for t, s, n in zip(target.tolist(), starts.tolist(), lengths.tolist()):
        padded[t : t + n] = data[s : s + n]
    padded[(target[:, None] + np.arange(4)).ravel()] ^= 0xFF
    state = np.zeros(len(padded) // _BLOCK, np.uint32)
    for column in np.ascontiguousarray(padded.reshape(-1, _BLOCK).T):
        state = _byte_table()[(state ^ column) & np.uint32(255)] ^ (state >> np.uint32(8))
    size = _BLOCK
    while len(state) > len(lengths):
        odd = blocks % 2 == 1
        state = np.insert(state, offsets[:-1][odd], np.uint32(0))
        blocks = (blocks + odd) // 2
        offsets = np.append(0, np.cumsum(blocks))
        state = _shifted(state[::2], size) ^ state[1::2]
        size *= 2
    crc = state ^ np.uint32(0xFFFFFFFF)
    return ((crc >> np.uint32(15)) | (crc << np.uint32(17))) + np.uint32(0xA282EAD8)


@cache
def _tokenizer(path: str):
    from tokenizers import Tokenizer

    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core; Spark runs the tasks side by side
    return Tokenizer.from_file(path)


@cache
def _special(path: str) -> dict[str, int]:
    import json

    with open(path) as f:
        return {x["content"]: x["id"] for x in json.load(f)["added_tokens"]}


@cache
def _token_bytes(path: str) -> np.ndarray:
    """How many bytes each id stands for; a byte-level vocabulary writes each byte as one character."""
    vocabulary = _tokenizer(path).get_vocab()
    out = np.zeros(max(vocabulary.values()) + 1, np.int64)
    out[list(vocabulary.values())] = list(map(len, vocabulary))
    return out


@cache
def _table(path: str) -> WordTable:
    def encode(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """One result for many words; a word ends where the tokens' bytes reach its last one."""
        batches = [words[k : k + BATCH_WORDS] for k in range(0, len(words), BATCH_WORDS)]
        ids = np.concatenate([np.array(x.ids, np.uint32) for x in _tokenizer(path).encode_batch_fast(batches, is_pretokenized=True, add_special_tokens=False)])
        token_ends = np.cumsum(_token_bytes(path)[ids])
        ends = np.cumsum(np.fromiter((len(w.encode()) for w in words), np.int64, len(words)))
        upto = np.searchsorted(token_ends, ends, "right")
        return ids, np.diff(upto, prepend=0)

    return WordTable(encode, TABLE_WORDS)


def token_ids(texts: list[str], tokenizer: str) -> tuple[np.ndarray, np.ndarray]:
    """The library's ids of all texts one after another, and where each text's begin (and the end).

    The library encodes each distinct pre-token once: it would cut a text at the same places and merge only inside them.
    """
    special = _special(tokenizer)
    table = _table(tokenizer)
    if not any(s in x for s in special for x in texts):
        p = tb.pieces(texts, True)
        table.add(p.distinct)
        return table.assemble(p)
    split = re.compile("(" + "|".join(map(re.escape, special)) + ")").split
    parts = [split(x) for x in texts]
    p = tb.pieces([x for part in parts for x in part[::2]], True)
    table.add(p.distinct)
    ids, begin = table.assemble(p)
    out, k = [], 0
    sizes = []
    for part in parts:
        own = []
        for i, x in enumerate(part):
            if i % 2:
                own.append(np.array([special[x]], np.uint32))
            else:
                own.append(ids[begin[k] : begin[k + 1]])
                k += 1
        out += own
        sizes.append(sum(map(len, own)))
    return np.concatenate(out), np.append(0, np.cumsum(sizes))


def framed(doc_ids: np.ndarray, ids: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The records' bytes one after another, and where each begins (and the end)."""
    width = 2 if not len(ids) or ids.max() < 65536 else 4
    body = ids.astype(f"<u{width}").view(np.uint8)
    size = np.diff(offsets) * width
    payload = size + 12
    begin = np.zeros(len(size) + 1, np.int64)
    np.cumsum(payload + 16, out=begin[1:])
    out = np.zeros(int(begin[-1]), np.uint8)

    def put(at: np.ndarray, values: np.ndarray, kind: str) -> None:
        raw = np.ascontiguousarray(values.astype(kind)).view(np.uint8).reshape(len(at), -1)
        out[at[:, None] + np.arange(raw.shape[1])] = raw

    put(begin[:-1], payload, "<u8")
    put(begin[:-1] + 8, masked_crcs(out, begin[:-1], np.full(len(size), 8)), "<u4")
    put(begin[:-1] + 12, doc_ids, "<i8")
    put(begin[:-1] + 20, np.full(len(size), width), "<u4")
    for t, s, n in zip((begin[:-1] + 24).tolist(), (offsets[:-1] * width).tolist(), size.tolist()):
        out[t : t + n] = body[s : s + n]
    put(begin[1:] - 4, masked_crcs(out, begin[:-1] + 12, payload), "<u4")
    return out, begin


def _filesystem(uri: str):
    from pyarrow.fs import FileSystem

    return FileSystem.from_uri(uri)


def write(docs: DataFrame, folder: str, tokenizer: str, end_id: int, id_col: str = "doc_id", text_col: str = "text") -> list[tuple[str, int, int, int]]:
    """Write all documents in ascending id order to `folder` (a URI that all executors share; new).

    Returns, in order, (part, records, tokens, tokens before it): as many as there are parts.
    """

    def run(batches):
        from pyspark import TaskContext

        fs, base = _filesystem(folder)
        fs.create_dir(base, recursive=True)
        part = f"part-{TaskContext.get().partitionId():06d}"
        attempt = uuid.uuid4().hex
        rec = idx = None
        records = tokens = at = 0
        for batch in batches:
            keys = batch.column(0).cast(pa.int64())
            keys = np.array(keys.fill_null(NULL_ID) if keys.null_count else keys)
            for c in tb.chunks(batch.column(1)):
                ids, offsets = token_ids([c.bytes_of(i).decode() for i in range(len(c))], tokenizer)
                ids = np.insert(ids, offsets[1:], np.uint32(end_id))
                offsets = offsets + np.arange(len(offsets))
                raw, begin = framed(keys[c.rows], ids, offsets)
                if rec is None:
                    rec, idx = (fs.open_output_stream(f"{base}/{part}.{attempt}.{x}") for x in ("rec", "idx"))
                rec.write(raw.tobytes())
                idx.write(np.stack([begin[:-1] + at, np.diff(offsets), offsets[:-1] + tokens], 1).astype("<i8").tobytes())
                records, tokens, at = records + len(c), tokens + len(ids), at + len(raw)
        if rec is not None:
            for stream, x in ((rec, "rec"), (idx, "idx")):
                stream.close()
                fs.move(f"{base}/{part}.{attempt}.{x}", f"{base}/{part}.{x}")
            yield pa.RecordBatch.from_pydict({"part": [part], "records": [records], "tokens": [tokens]})

    by = [F.col("_id"), F.xxhash64("_text"), F.col("_text")]
    parts = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).alias("_text")).repartitionByRange(*by[:2]).sortWithinPartitions(*by).mapInArrow(run, "part string, records long, tokens long")
    done, before = [], 0
    for part, records, tokens in sorted(map(tuple, parts.collect())):  # a row for each part
        done.append((part, records, tokens, before))
        before += tokens
    return done


def read(spark, folder: str, parts: list[tuple[str, int, int, int]]) -> DataFrame:
    """Rows (doc_id, start, ids) read back from the files in any order; checksums are verified.

    ids: little-endian unsigned 32-bit integers. start: token ids of all records before it.
    """

    def run(batches):
        fs, base = _filesystem(folder)
        for batch in batches:
            for part, before in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                with fs.open_input_file(f"{base}/{part}.idx") as f:
                    index = np.frombuffer(f.read(), "<i8").reshape(-1, 3)
                with fs.open_input_stream(f"{base}/{part}.rec") as f:
                    first = 0
                    while first < len(index):  # about a chunk of records at a time
                        last = int(np.searchsorted(index[:, 0], index[first, 0] + tb.CHUNK_BYTES, "right"))
                        if last < len(index):
                            raw = f.read(int(index[last, 0] - index[first, 0]))
                        else:
                            raw = f.read()
                        yield _parsed(np.frombuffer(raw, np.uint8), index[first:last] - [index[first, 0], 0, -before])
                        first = last

    rows = spark.createDataFrame([(p, b) for p, _, _, b in parts], "part string, before long")
    return rows.repartition(max(1, len(parts)), "part").mapInArrow(run, "doc_id long, start long, ids binary")


def _parsed(data: np.ndarray, index: np.ndarray) -> pa.RecordBatch:
    begin = index[:, 0]

    def take(at: np.ndarray, kind: str) -> np.ndarray:
        return data[at[:, None] + np.arange(int(kind[-1]))].view(kind).ravel()

    payload = take(begin, "<u8").astype(np.int64)
    if (masked_crcs(data, begin, np.full(len(begin), 8)) != take(begin + 8, "<u4")).any():
        raise ValueError("a record's length has a wrong checksum")
    if (masked_crcs(data, begin + 12, payload) != take(begin + 12 + payload, "<u4")).any():
        raise ValueError("a record has a wrong checksum")
    width = take(begin + 20, "<u4")
    size = payload - 12
    offsets = np.append(0, np.cumsum(size // width))
    ids = np.concatenate([data[a + 24 : a + 24 + n].view(f"<u{w}").astype("<u4") for a, n, w in zip(begin.tolist(), size.tolist(), width.tolist())])
    from .bpe import binaries

    key = take(begin + 12, "<i8")
    return pa.RecordBatch.from_arrays([pa.array(key, mask=key == NULL_ID), pa.array(index[:, 2]), binaries(ids, offsets)], names=["doc_id", "start", "ids"])


def crc32_of(column: pa.Array) -> pa.Array:
    """Unsigned CRC-32 of each binary value."""
    return pa.array([zlib.crc32(x.as_buffer()) for x in column], pa.int64())


def new_folder(spark, name: str) -> str:
    """A new place under the shared folder of spark.checkpoint.dir."""
    from .shared import shared_folder

    return os.path.join(shared_folder(spark), f"{name}-{uuid.uuid4().hex}")
