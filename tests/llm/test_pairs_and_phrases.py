"""The Jaccard join, ranked search and collocations against plain versions, on real rows and odd ones; and on an empty table."""

import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from grovespark.llm import collocations, jaccard_join, lexical_search
from grovespark.llm import textbatch as tb

from . import brute
from .conftest import table

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def shingles(text):
    w = brute.words(brute.lowered(text))
    return frozenset(tuple(w[i : i + 3]) for i in range(len(w) - 2)) or frozenset([tuple(w)] if w else [])


def jaccard_components(rows, percent=90):
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            small, large = sorted((len(sets[a]), len(sets[b])))
            if small and 100 * small >= percent * large:
                shared = len(sets[a] & sets[b])
                if 100 * shared >= percent * (small + large - shared):
                    x, y = find(a), find(b)
                    root[max(x, y)] = min(x, y)
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[find(k)] = min(i, least.get(find(k), i))
    return Counter((i, len(sets[k]), least.get(find(k)) if sets[k] else i) for k, (i, _) in enumerate(rows))


def near_copies():
    """A large group: copies of one text with one to six words changed, and parts of it."""
    rng = np.random.default_rng(3)
    base = [f"w{i}" for i in rng.integers(0, 500, 150)]
    out = []
    for i in range(120):
        own = list(base)
        for at in rng.integers(0, 150, int(rng.integers(0, 7))):
            own[at] = f"new{rng.integers(0, 10**6)}"
        out.append((5_000_000 + i, " ".join(own[: 150 - i % 9])))
    return out


def test_jaccard_join(spark, docs, rows):
    more = near_copies()
    got = jaccard_join.similar(docs.unionByName(table(spark, more)))
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got.collect()) == jaccard_components(rows + more)


def test_sketch_is_a_lower_bound():
    rng = np.random.default_rng(5)
    values = np.unique(rng.integers(0, 2**63, 900).astype(np.uint64))
    for cut in (1, 5, 40, 300):
        both, offsets = np.concatenate([values, values[cut:]]), np.array([0, len(values), 2 * len(values) - cut])
        a, b = jaccard_join.sketch(both, offsets, np.arange(2), 3, 16)
        assert np.bitwise_count(a ^ b).sum() <= cut
    assert jaccard_join.most_apart(19, 90) == 1 and jaccard_join.most_apart(18, 90) == 0


def ranked(rows, items, k):
    lists = [Counter(TERM.findall(brute.lowered(t))) for _, t in rows]
    sizes = [sum(x.values()) for x in lists]
    docs, total = sum(n > 0 for n in sizes), sum(sizes)
    df = Counter(t for x in lists for t in x)
    out = Counter()
    for item, text in items:
        terms = [t for t in set(TERM.findall(brute.lowered(text))) if df[t]]
        w = {t: math.floor(1000 * math.log((2 * docs + 2) / (2 * df[t] + 1))) for t in terms}
        found = []
        for (i, _), x, n in zip(rows, lists, sizes):
            m = 10 + (90 * n * docs) // total
            score = sum(w[t] * ((10**9 * x[t]) // (1000 * x[t] + 8 * m)) for t in terms if t in x)
            if score > 0:
                found.append((-score, i is None, i or 0, i))
        for rank, (score, _, _, i) in enumerate(sorted(found)[:k], 1):
            out[item, rank, i, -score] += 1
    return out


def test_lexical_search(spark, docs, rows, sf):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    items += [(-1, None), (-2, ""), (-3, rows[0][1]), (-3, rows[0][1]), (None, "Strasse 中文字 nowhere")]
    index = lexical_search.build(docs)
    got = lexical_search.search(index, spark.createDataFrame(items, "item_id long, text string"), 10)
    assert Counter(tuple(r) for r in got.collect()) == ranked(rows, items, 10)


@pytest.mark.parametrize("most, least", [(3, 10), (4, 3)])
def test_collocations(spark, docs, rows, most, least):
    grams = Counter()
    for _, text in rows:
        for piece in re.split("[.,;:!?\n-\r]", brute.lowered(text)):
            w = re.findall("[^ \t]+", piece)
            grams.update(tuple(w[i : i + n]) for n in range(1, most + 1) for i in range(len(w) - n + 1))
    total = sum(c for g, c in grams.items() if len(g) == 1)
    often = {g: c for g, c in grams.items() if len(g) > 1 and c >= least}
    held = Counter()
    for g, c in often.items():
        for n in range(2, len(g)):
            for i in range(len(g) - n + 1):
                held[g[i : i + n]] = max(held[g[i : i + n]], c)
    kept = []
    for g, a in often.items():
        if 100 * held[g] >= 50 * a:
            continue
        score, _, l, r = min((10**6 * a * a // (grams[g[:k]] * grams[g[k:]]), k, grams[g[:k]], grams[g[k:]]) for k in range(1, len(g)))
        kept.append((-score, -a, " ".join(g).encode(), l, r))
    want = [(rank, p.decode(), -a, l, r, total, -s) for rank, (s, a, p, l, r) in enumerate(sorted(kept)[:500], 1)]
    one = docs.selectExpr("text", "cast(null as string) AS lang", "kept")
    got = sorted(tuple(r)[1:] for r in collocations.collocations(one, most, least, first=500).collect())
    assert got == want


def test_empty_tables(spark, empty):
    assert jaccard_join.similar(empty).count() == 0
    assert collocations.collocations(empty.selectExpr("text", "kept AS lang")).count() == 0
    items = spark.createDataFrame([(1, "some text")], "item_id long, text string")
    assert lexical_search.search(lexical_search.build(empty), items, 10).count() == 0


def test_collocations_with_too_few_cells(spark, docs, monkeypatch):
    """What shares a cell with frequent n-grams is counted with its text, and goes again if it is rare."""
    one = docs.selectExpr("text", "cast(null as string) AS lang")
    want = sorted(collocations.collocations(one, 3, 5, first=500).collect())
    assert want
    monkeypatch.setattr(collocations, "MOST_CELLS", 9)
    assert sorted(collocations.collocations(one, 3, 5, first=500).collect()) == want


def test_collocations_filters(spark):
    """All frequent n-grams are in the filters, and few others: only what is frequent leaves the tasks with its text."""
    rng = random.Random(3)
    often = ["often here", "and there", "İ often here"]
    rows = [("en", f"{rng.choice(often)}, r{rng.random()} s{rng.random()} {rng.choice(often)}") for _ in range(3_000)]
    texts = spark.createDataFrame(rows + [(None, None), ("de", "")], "lang string, text string").selectExpr("coalesce(lang, 'und') AS lang", "text").repartition(3)
    filters = []
    for _ in range(2):
        filters.append(collocations.frequent(texts, filters, 10, 24))
    x = collocations.Counted(next(tb.chunks(pa.array([t for _, t in rows]))), pa.array(["en"] * len(rows)).dictionary_encode())
    lengths = dict(x.candidates(filters))
    sent = {n: {g for b in x.whole(lengths[n], n) for g in b.column(1).to_pylist()} for n in (1, 2)}
    got = {r.gram: r.a for r in collocations.counts(texts, filters, 10).collect() if r.lang == "en"}
    pieces = [p.split() for _, t in rows for p in re.split("[.,]", t)]
    for n in (1, 2):
        seen = Counter(" ".join(p[i : i + n]) for p in pieces for i in range(len(p) - n + 1))
        want = {g: c for g, c in seen.items() if c >= 10}
        assert {g: c for g, c in got.items() if g and len(g.split(" ")) == n} == want
        assert want.keys() <= sent[n] and len(sent[n]) < len(want) + 0.01 * len(seen)
    assert got[""] == sum(map(len, pieces))


def test_word_hashes():
    words = [b"a", b"a\x00", b"a\x00\x00"]
    words += [b"x" * n + e for n in (6, 7, 8, 15, 16, 62, 63, 64, 65, 3_000) for e in (b"y", b"z", b"\x00")]
    data = np.frombuffer(b" ".join(words + words), np.uint8)
    length = np.array([len(w) for w in words + words])
    starts = np.cumsum(length + 1) - length - 1
    h = collocations.word_hashes(data, starts, starts + length)
    assert (h[: len(words)] == h[len(words) :]).all() and len(set(h.tolist())) == len(words)
