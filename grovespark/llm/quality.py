"""Quality rules: plain counts of a text, and a hashed n-gram likelihood ratio against the raw corpus.

Word unigrams and bigrams are hashed to BUCKETS buckets. Two multinomials over
the buckets are counted: one over every document (the raw corpus), one over
trusted documents (quality 1 and not toxic in all of their labels). A text's
score is the mean, over its n-grams, of log(trusted share / raw share). A text
is kept unless the plain rules fail it or its score is below THRESHOLD, a fixed
value: equal texts get equal verdicts.

The trusted multinomial is fitted on at most TRUSTED_ROWS documents, those
whose ids have the least hashes; the raw one counts the whole table.

Defined cases: a null text has no words and fails the plain rules; a null id
stays null and is never trusted; repeated rows count as often as they occur; an
empty table gives an empty result; with no trusted document all scores are 0;
a text without n-grams scores 0; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import textbatch as tb

BUCKETS = 1 << 16
TRUSTED_ROWS = 20_000
THRESHOLD = -0.25
SYMBOLS = "#*$%&|<>"
WINDOW = 8


def trusted_ids(labels: DataFrame, most: int = TRUSTED_ROWS) -> DataFrame:
    """Ids of at most `most` trusted documents."""
    good = labels.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.min("quality").alias("q"), F.max("toxic").alias("t")).where("q = 1 AND t = 0")
    return good.select("doc_id").orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)


def _grams(h: np.ndarray, w: tb.Words) -> tuple[np.ndarray, np.ndarray]:
    """The bucket of each word, and of each pair of neighbours (-1 where they are of two documents)."""
    top = np.uint64(64 - (BUCKETS.bit_length() - 1))
    one = (tb.mixed(h) >> top).astype(np.int64)
    two = (tb.ngram_hashes(h, 2) >> top).astype(np.int64)
    two[~tb.whole_windows(w.offsets, 2, len(two))] = -1
    return one, two


def multinomials(docs: DataFrame, trusted: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[np.ndarray, np.ndarray]:
    """Counts by bucket over trusted documents and over all."""

    def run(batches):
        counts = np.zeros((2, BUCKETS), np.int64)
        for batch in batches:
            flag = np.array(batch.column(1), dtype=bool)
            for c in tb.chunks(batch.column(0)):
                w = tb.words(c)
                one, two = _grams(tb.word_hashes(c, w), w)
                good = np.repeat(flag[c.rows], w.counts())
                for grams in (one, two):
                    g = good[: len(grams)]
                    counts[1] += np.bincount(grams[grams >= 0], minlength=BUCKETS)
                    counts[0] += np.bincount(grams[g & (grams >= 0)], minlength=BUCKETS)
        some = np.flatnonzero(counts[1])
        yield pa.RecordBatch.from_pydict({"bucket": some, "trusted": counts[0, some], "raw": counts[1, some]})

    own = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    marked = own.join(F.broadcast(trusted.select(F.col("doc_id").alias("_id"), F.lit(True).alias("_good"))), "_id", "left").select("_text", F.coalesce("_good", F.lit(False)))
    rows = marked.mapInArrow(run, "bucket long, trusted long, raw long").groupBy("bucket").agg(F.sum("trusted"), F.sum("raw"))
    out = np.zeros((2, BUCKETS), np.int64)
    for bucket, good, raw in rows.collect():  # BUCKETS rows at most
        out[:, bucket] = good, raw
    return out[0], out[1]


def log_ratios(trusted: np.ndarray, raw: np.ndarray) -> np.ndarray:
    """log(trusted share / raw share) by bucket; the trusted counts lean on the raw shares with the weight of one n-gram a bucket."""
    share = (raw + 1) / (raw.sum() + BUCKETS)
    return np.log((trusted + BUCKETS * share) / (trusted.sum() + BUCKETS)) - np.log(share)


def _repeated_lines(text: bytes) -> int:
    seen, n = set(), 0
    for line in text.split(b"\n"):
        if line in seen:
            n += 1
        elif line and not line.isspace():
            seen.add(line)
    return n


_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(SYMBOLS.encode())] = True


def apply_rules(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = (), as_column: str = "") -> DataFrame:
    """Rows (id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, score, kept) of all documents.

    keep: lead with these columns instead of the id. as_column: of the rest only the verdict, under this name.
    """
    ratios = log_ratios(*multinomials(docs, trusted_ids(labels), id_col, text_col))
    shared = docs.sparkSession.sparkContext.broadcast(ratios)  # BUCKETS doubles

    def run(batches):
        ratio = shared.value
        for batch in batches:
            for c in tb.chunks(batch.column(text_at)):
                w = tb.words(c)
                h = tb.word_hashes(c, w)
                n = w.counts()
                one, two = _grams(h, w)
                value, pairs = ratio[one], np.append(np.where(two >= 0, ratio[two], 0.0), 0.0)[: len(one)]
                begin = np.minimum(w.offsets[:-1], max(len(one) - 1, 0))
                total = np.where(n > 0, np.add.reduceat(value + pairs, begin), 0.0) if len(one) else np.zeros(len(c))
                score = total / np.maximum(2 * n - 1, 1)
                inner = np.zeros(len(c.data) + 1, np.int64)
                np.cumsum((c.data & 0xC0) != 0x80, out=inner[1:])
                in_words = np.append(0, np.cumsum(inner[w.ends] - inner[w.starts]))
                g = tb.ngram_hashes(h, WINDOW)
                ok = np.flatnonzero(tb.whole_windows(w.offsets, WINDOW, len(g)))
                repeat = np.zeros(len(c), np.int64)
                if len(ok):
                    doc = np.searchsorted(w.offsets, ok, "right") - 1
                    key = g[ok] ^ tb.mixed(doc.astype(np.uint64) + np.uint64(1))
                    order = np.argsort(key)
                    same = key[order[1:]] == key[order[:-1]]
                    twice = np.zeros(len(key), bool)
                    twice[order[1:][same]] = True
                    twice[order[:-1][same]] = True
                    at = ok[twice]
                    repeat = tb.per_doc(tb.covered(at, at + WINDOW, len(h)), w.offsets)
                failed = (n < 20) | (100 * repeat > 30 * n)
                columns = {
                    "n_words": n,
                    "word_chars": in_words[w.offsets[1:]] - in_words[w.offsets[:-1]],
                    "n_symbols": tb.per_doc(_SYMBOL[c.data], c.offsets),
                    "n_dup_lines": np.array([_repeated_lines(c.bytes_of(i)) for i in range(len(c))], np.int64),
                    "n_repeat_words": repeat,
                    "base_failed": failed,
                    "score": score,
                    "kept": ~failed & (score >= THRESHOLD),
                }
                own = [batch.column(i)[c.rows] for i in range(len(names))]
                yield pa.RecordBatch.from_arrays(own + [pa.array(x) for x in columns.values()], names=[*names, *columns])

    led = list(keep) or [id_col]
    names = [f"_{i}" for i in range(len(led))]
    text_at = led.index(text_col) if text_col in led else len(led)
    schema = T.StructType([T.StructField(n, docs.schema[x].dataType) for n, x in zip(names, led)])
    given = [F.col(x).alias(n) for n, x in zip(names, led)] + [F.col(text_col).alias("_text")]
    out = docs.select(*given[: max(len(led), text_at + 1)]).mapInArrow(
        run, T.StructType([*schema, *T.StructType.fromDDL("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, score double, kept boolean")])
    )
    if as_column:
        out = out.select(*names, F.col("kept").alias(as_column))
    return out.withColumnsRenamed(dict(zip(names, led)))
