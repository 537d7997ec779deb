"""Secret scans: fixed patterns, and tokens that a battery of randomness tests cannot tell from chance.

Patterns give the spans of kinds `assign`, `access` and `hex`. Every other run
of 16 or more characters of `[A-Za-z0-9+/_-]` with a letter is a candidate,
with `=` or `==` at its end. Its encoding is the smallest alphabet that holds
it. Three tests look for structure: chi-squared uniformity over that alphabet, runs above and
below its middle, and serial correlation of neighbours; Fisher's method joins
their p-values, and a joint one below STRUCTURED rules a candidate out. The
rest are tested against ordinary text: its chi-squared statistic grows with the
length by TEXT_COLLISIONS, its letters and digits take turns seldom
(TEXT_CHANGES, or TEXT_CASE_CHANGES with capitals), and its letters are mostly
the frequent ones (TEXT_LETTERS), so seldom all of them are hexadecimal digits.
A candidate's p-value joins the chances of text as even, as mixed and of
letters as rare, by Fisher's method. Benjamini and Hochberg's procedure at rate
FALSE_RATE, with weights in proportion to length, picks the discoveries of each
document (kind `random`). A document's spans depend on nothing but its text.

Starts and ends count code points; ends are exclusive.

Defined cases: a null text has no spans; a null id stays null; repeated rows
give repeated rows; an empty table gives an empty result; other columns are
ignored, or kept under their names if asked for; candidates that touch a
pattern's span are not tested; equal p-values are taken from left to right; a
text of any length is one unit, and no run reaches from one text into the next.
"""

from __future__ import annotations

import re
from math import comb, erf, erfc, log, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import textbatch as tb

BASE_KINDS = ("assign", "access", "hex")
KINDS = (*BASE_KINDS, "random")
FALSE_RATE = 0.003
STRUCTURED = 0.001
#: The chance that two characters of ordinary text are equal.
TEXT_COLLISIONS = 0.066
#: The chance that a letter of ordinary names and words follows a digit, or a digit a letter.
TEXT_CHANGES = 0.1
#: The same between small letters, capitals and digits, where a name has both cases.
TEXT_CASE_CHANGES = 0.3
#: Percent of the letters of English text, from a to z.
TEXT_LETTERS = (8.2, 1.5, 2.8, 4.3, 12.7, 2.2, 2.0, 6.1, 7.0, 0.15, 0.77, 4.0, 2.4, 6.7, 7.5, 1.9, 0.095, 6.0, 6.3, 9.1, 2.8, 0.98, 2.4, 0.15, 2.0, 0.074)
#: How much wider than chance the rareness of letters spreads: words repeat their parts, and other languages and names use other letters.
TEXT_SPREAD = 2.0

_ASSIGN = re.compile(r"""(?ai:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{32,}")
_RUN = re.compile(r"[A-Za-z0-9+/_-]{16,}={0,2}")
_HINTS = (b"passw", b"secret", b"token", b"apikey", b"api_key")
_LONG = np.zeros(256, bool)
_LONG[list(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-")] = True
_DIGITS, _LOWER, _UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: From the smallest to the largest.
ALPHABETS = [_DIGITS + "abcdef", _DIGITS + "ABCDEF", _UPPER + "234567", _DIGITS + _LOWER, _DIGITS + _UPPER, _UPPER + _LOWER + _DIGITS, _UPPER + _LOWER + _DIGITS + "+/", _UPPER + _LOWER + _DIGITS + "-_", _UPPER + _LOWER + _DIGITS + "+/-_="]

_SHARE = np.array(TEXT_LETTERS) / sum(TEXT_LETTERS)
_RARE = -np.log(_SHARE)
_RARE_MEAN = float((_SHARE * _RARE).sum())
_RARE_VARIANCE = float((_SHARE * (_RARE - _RARE_MEAN) ** 2).sum())
_HEX_SHARE = float(_SHARE[:6].sum())


def _above(z: float) -> float:
    return erfc(z / sqrt(2)) / 2


def _both_sides(z: float) -> float:
    return erfc(abs(z) / sqrt(2))


def _chi_above(x: float, df: float) -> float:
    """P(chi-squared with df degrees of freedom >= x), by the cube root of Wilson and Hilferty."""
    return _above(((max(x, 0.0) / df) ** (1 / 3) - (1 - 2 / (9 * df))) / sqrt(2 / (9 * df)))


def _at_least(k: int, n: int, rate: float) -> float:
    """P(at least k of n), each with the chance `rate`."""
    return sum(comb(n, j) * rate**j * (1 - rate) ** (n - j) for j in range(k, n + 1)) if n <= 1000 else _above((k - n * rate) / sqrt(n * rate * (1 - rate)))


def battery(token: str) -> tuple[float, float]:
    """(joint p-value of the randomness tests, p-value of being ordinary text) of a token."""
    token = token.rstrip("=")
    n = len(token)
    alphabet = next((a for a in ALPHABETS if set(token) <= set(a)), None)
    if alphabet is None or n < 16:
        return 0.0, 1.0
    k = len(alphabet)
    at = np.array([alphabet.index(c) for c in token], float)
    chi = float((np.bincount(at.astype(int), minlength=k) ** 2).sum()) * k / n - n
    ps = [_chi_above(chi, k - 1)]
    high = at >= k / 2
    n1 = int(high.sum())
    n0 = n - n1
    if n1 and n0:
        runs = 1 + int((high[1:] != high[:-1]).sum())
        mean = 1 + 2 * n1 * n0 / n
        spread = (mean - 1) * (mean - 2) / (n - 1)
        ps.append(_both_sides((runs - mean) / sqrt(spread)) if spread > 0 else 1.0)
    else:
        ps.append(2.0 ** (1 - n))
    around = at - at.mean()
    power = float((around**2).sum())
    ps.append(_both_sides((float((around[1:] * around[:-1]).sum()) / power + 1 / n) * sqrt(n)) if power else 0.0)
    joint = _chi_above(-2 * sum(log(max(p, 1e-300)) for p in ps), 6)
    more = n * max(k * TEXT_COLLISIONS - 1, 1.0)  # small alphabets: at least twice the collisions of chance
    even = (1 + erf((chi - (k - 1) - more) / sqrt(2 * (k - 1) + 4 * more) / sqrt(2))) / 2
    views = [even]
    cased = token != token.lower() and token != token.upper()
    if cased or not token.isalpha():
        kinds = [c.isdigit() + 2 * (cased and c.isupper()) for c in token if c.isalnum()]
        views.append(_at_least(sum(a != b for a, b in zip(kinds, kinds[1:])), n - 1, TEXT_CASE_CHANGES if cased else TEXT_CHANGES))
    letters = [ord(c) - 97 for c in token.lower() if c.isalpha()]
    if letters:
        rare = _HEX_SHARE ** len(letters) if k == 16 else _above((float(_RARE[letters].sum()) - len(letters) * _RARE_MEAN) / sqrt(TEXT_SPREAD * _RARE_VARIANCE * len(letters)))
        views.append(rare)
    return joint, _chi_above(-2 * sum(log(max(p, 1e-300)) for p in views), 2 * len(views))


def spans_of(text: str) -> list[tuple[str, int, int]]:
    found = [("assign", m.start(), m.end()) for m in _ASSIGN.finditer(text) if len(m[1]) >= 8]
    found += [("access", m.start(), m.end()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 16]
    found += [("hex", m.start(), m.end()) for m in _HEX.finditer(text)]
    tested = []
    for m in _RUN.finditer(text):
        if re.search("[A-Za-z]", m[0]) and not any(a < m.end() and m.start() < b for _, a, b in found):
            joint, p = battery(m[0])
            tested.append((p if joint >= STRUCTURED else 1.0, m.start(), m.end()))
    if tested:
        mean = sum(b - a for _, a, b in tested) / len(tested)
        ranked = sorted((p * mean / (b - a), a, b) for p, a, b in tested)
        last = max((i for i, (p, _, _) in enumerate(ranked, 1) if p <= FALSE_RATE * i / len(ranked)), default=0)
        found += [("random", a, b) for _, a, b in ranked[:last]]
    return sorted(found, key=lambda x: (x[1], KINDS.index(x[0])))


def _worth_reading(c: tb.Chunk) -> np.ndarray:
    """Which texts of a chunk have a run of 16 or more candidate characters, or a hint of an assignment."""
    long = np.append(_LONG[c.data], False)
    before = np.append(False, long[:-1])
    border = np.zeros(len(long), bool)  # no run crosses from one text to the next
    border[c.offsets] = True
    starts, ends = np.flatnonzero(long & (~before | border)), np.flatnonzero(before & (~long | border))
    out = np.zeros(len(c), bool)
    out[np.searchsorted(c.offsets, starts[ends - starts >= 16], "right") - 1] = True
    for i in np.flatnonzero(~out).tolist():
        text = c.bytes_of(i).lower()
        out[i] = any(x in text for x in _HINTS)
    return out


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = (), as_column: str = "spans") -> DataFrame:
    """Rows (id, spans) of all documents, led by the columns of `keep` instead of the id; spans (under the name as_column): array of (kind, start, end) by start, then kind."""

    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
    led = list(keep) or [id_col]
    names = [f"_{i}" for i in range(len(led))]
    text_at = led.index(text_col) if text_col in led else len(led)

    def run(batches):
        for batch in batches:
            for c in tb.chunks(batch.column(text_at)):
                worth = _worth_reading(c)
                spans = [[{"kind": k, "start": a, "end": b} for k, a, b in spans_of(c.bytes_of(i).decode())] if worth[i] else [] for i in range(len(c))]
                yield pa.RecordBatch.from_arrays([batch.column(i)[c.rows] for i in range(len(names))] + [pa.array(spans, kind)], names=[*names, "spans"])

    schema = T.StructType([T.StructField(n, docs.schema[x].dataType) for n, x in zip(names, led)])
    given = [F.col(x).alias(n) for n, x in zip(names, led)] + [F.col(text_col).alias("_text")]
    out = docs.select(*given[: max(len(led), text_at + 1)]).mapInArrow(run, T.StructType([*schema, *T.StructType.fromDDL("spans array<struct<kind:string,start:bigint,end:bigint>>")]))
    return out.withColumnRenamed("spans", as_column).withColumnsRenamed(dict(zip(names, led)))


def listed(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")


def of_kind(spans: Column, *kinds: str) -> Column:
    return F.filter(spans, lambda x: x["kind"].isin(*kinds))


def redacted(text: Column, spans: Column, mark: str = "[SECRET]") -> Column:
    """The text with every stretch covered by spans replaced by the mark. Spans are ordered by start."""
    start = F.struct(F.lit("").alias("out"), F.lit(0).cast("long").alias("at"))

    def step(done: Column, x: Column) -> Column:
        gap = F.substring(text, (done["at"] + 1).cast("int"), F.greatest(x["start"] - done["at"], F.lit(0)).cast("int"))
        fresh = x["start"] >= done["at"]
        return F.struct(
            F.when(fresh, F.concat(done["out"], gap, F.lit(mark))).otherwise(done["out"]).alias("out"),
            F.greatest(done["at"], x["end"]).alias("at"),
        )

    return F.when(F.size(spans) == 0, text).otherwise(F.aggregate(spans, start, step, lambda done: F.concat(done["out"], F.substring(text, (done["at"] + 1).cast("int"), F.length(text)))))
