"""Every operator against a plain version or a library, on real rows and on odd ones; and on an empty table."""

from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from grovespark.llm import bpe, decontaminate, language_model, quality, queries, secret_scan, simhash, substrings, suffix_dedup, token_counts, token_records

from . import brute

VOCABULARY = queries._vocabulary


def bag(df, *columns):
    return Counter(tuple(r[c] for c in columns) for r in df.select(*columns).collect())


def test_quality_counts(spark, docs, rows, sf):
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    got = quality.apply_rules(docs, labels).cache()
    names = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    assert bag(got, *names) == Counter((i, *brute.base_rules(t)) for i, t in rows)
    out = got.toPandas()
    assert not (out["kept"] & out["base_failed"]).any()
    assert (out["kept"] == (~out["base_failed"] & (out["score"] >= quality.THRESHOLD))).all()


def test_quality_score(spark, docs, rows, sf):
    from grovespark.llm import textbatch as tb
    import pyarrow as pa

    labels = spark.read.parquet(f"{sf}/labels.parquet")
    trusted = {r.doc_id for r in quality.trusted_ids(labels).collect()}
    good, raw, grams = Counter(), Counter(), []
    for i, t in rows:
        (c,) = tb.chunks(pa.array([t], pa.string()))
        w = tb.words(c)
        one, two = quality._grams(tb.word_hashes(c, w), w)
        own = [*one.tolist(), *(x for x in two.tolist() if x >= 0)]
        grams.append(own)
        raw.update(own)
        if i in trusted:
            good.update(own)
    n_good, n_raw = sum(good.values()), sum(raw.values())
    share = {b: (raw[b] + 1) / (n_raw + quality.BUCKETS) for b in raw}
    ratio = {b: np.log((good[b] + quality.BUCKETS * share[b]) / (n_good + quality.BUCKETS) / share[b]) for b in raw}
    want = sorted((str(i), round(sum(ratio[b] for b in own) / max(len(own), 1), 6)) for (i, _), own in zip(rows, grams))
    got = sorted((str(r.doc_id), round(r.score, 6)) for r in quality.apply_rules(docs, labels).collect())
    assert [x for x, _ in got] == [x for x, _ in want]
    assert np.allclose([x for _, x in got], [x for _, x in want], atol=2e-6)


def test_substrings(docs, rows):
    want = brute.without_repeats([t for _, t in rows], 35)
    got = substrings.dedup(docs)
    assert bag(got, "doc_id", "n_words", "n_removed", "kept") == Counter((i, *x) for (i, _), x in zip(rows, want))
    for r in got.where("n_removed > 0").collect():
        assert sum(x.end - x.start for x in r.removed) == r.n_removed


def test_suffix_dedup(docs, rows):
    want = brute.without_repeats([t for _, t in rows], suffix_dedup.MATCH)
    got = suffix_dedup.dedup(docs)
    assert bag(got, "doc_id", "n_words", "n_removed", "kept") == Counter((i, *x) for (i, _), x in zip(rows, want))


def test_bpe(docs, rows):
    import public_tokenizers
    import tiktoken

    path = VOCABULARY("byte_bpe_50k.tiktoken")
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.load_ranks(path).ranks, special_tokens={})
    want = Counter((i, np.array(library.encode_ordinary(t or ""), "<u4").tobytes(), (t or "").encode()) for i, t in rows)
    coded = bpe.decode(bpe.encode(docs, path), path)
    for out in (coded, bpe.encode(docs, path, decoded=True)):
        assert Counter((r.doc_id, bytes(r.ids), bytes(r.decoded)) for r in out.collect()) == want


def test_secrets(docs, rows):
    got = secret_scan.scan(docs).collect()
    base = Counter((r.doc_id, tuple((s.kind, s.start, s.end) for s in r.spans if s.kind != "random")) for r in got)
    assert base == Counter((i, tuple(brute.base_secrets(t))) for i, t in rows)
    random = {r.doc_id: [(s.start, s.end) for s in r.spans if s.kind == "random"] for r in got}
    at = 10**9 + 9
    assert random[at] == [(4, 4 + len("Zt9qX2vLr8Kd4Wm1Yb7Nc3Hs6Pj5Fg0"))]  # of its text's two long tokens the repetitive one is no discovery


def test_redaction(spark, docs):
    got = secret_scan.scan(docs, keep=("doc_id", "text", "spans"), as_column="_found")
    out = got.select("doc_id", secret_scan.redacted(F.col("text"), F.col("_found")).alias("text")).where("doc_id = 1000000008").first()
    assert "hunter2" not in out.text and "AKIAIOS" not in out.text and "token=short" in out.text and "AKIA123" in out.text


def test_language_model(docs, rows):
    want = brute.unigram_scores(rows)
    got = language_model.score(docs).collect()
    a = sorted((str(r.doc_id), r.n_tokens, r.held_out, r.n_known, r.train_tokens, r.base_score) for r in got)
    b = sorted((str(i), x[1], x[0], *x[2:]) for (i, _), x in zip(rows, want))
    assert [x[:5] for x in a] == [x[:5] for x in b]
    assert np.allclose([x[5] for x in a], [x[5] for x in b], rtol=1e-12, atol=1e-9)
    held = [r for r in got if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)  # held-out text is likelier than by unigrams alone


def test_language_model_levels(docs, rows):
    """Levels from the filter are never below the true ones, and rarely above; n-grams that were not seen have none."""
    counts = language_model.cut(language_model.gram_counts(docs.select("text")))
    found = language_model.collected(*language_model.filter_slices(counts)[:2])
    from grovespark.llm import textbatch as tb
    import pyarrow as pa

    exact = [Counter() for _ in range(language_model.ORDERS)]
    for _, t in rows:
        (c,) = tb.chunks(pa.array([t], pa.string()))
        for own, g in zip(exact, language_model.Tokens(c).grams()):
            own.update(g.tolist())
    for order, own in enumerate(exact):
        seen = found.levels(np.array(list(own), np.uint64), order + 1)
        want = language_model.level_of(np.array(list(own.values())))
        assert (seen >= want).all() and (seen > want).mean() < 0.03
        others = np.random.default_rng(5).integers(0, 2**63, 20_000, dtype=np.uint64)
        assert (found.levels(others, order + 1) > 0).mean() < 0.03


def test_language_model_full_filter_ends():
    shape = language_model.Shape(6, [100, 100, 100], 9)
    full = language_model.Filter(shape, np.full(int(shape.begin[-1]), 2**64 - 1, np.uint64))
    assert (full.levels(np.arange(50, dtype=np.uint64), 2) == 9).all()


def test_language_model_score(docs, rows):
    """The score from exact counts by the stated formula; the filter's few false answers move it a little at most. Both ways of probing agree."""
    got = language_model.score(docs).select("doc_id", "n_tokens", "score").collect()
    want = Counter()
    for (i, t), x in zip(rows, brute.interpolated([(i, t) for i, t in rows])):
        want[i, len(brute.words(t)) + 1, x] += 1
    a = sorted(((str(r.doc_id), r.n_tokens, r.score) for r in got))
    b = sorted((str(i), n, x) for (i, n, x), k in want.items() for _ in range(k))
    assert [x[:2] for x in a] == [x[:2] for x in b]
    off = [abs(x[2] - y[2]) / x[1] for x, y in zip(a, b)]
    assert np.mean(off) < 0.03 and np.quantile(off, 0.99) < 0.25
    sliced = language_model.score(docs, broadcast_bytes=0).select("doc_id", "n_tokens", "score").collect()
    assert Counter((r.doc_id, r.n_tokens, round(r.score, 9)) for r in sliced) == Counter((r.doc_id, r.n_tokens, round(r.score, 9)) for r in got)


def test_simhash(docs, rows):
    fps = [brute.fingerprint(t) for _, t in rows]
    by_row = list(range(len(rows)))
    parts = brute.near_components(by_row, fps)
    least = {}
    for k, (i, _) in zip(by_row, rows):
        if i is not None:
            least[parts[k]] = min(least.get(parts[k], i), i)
    want = Counter((i, f"{fps[k]:016x}", least.get(parts[k])) for k, (i, _) in zip(by_row, rows))
    got = simhash.near_duplicates(docs)
    assert bag(got.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("f"), "component_id"), "doc_id", "f", "component_id") == want


@pytest.mark.parametrize("distance", [2, 3, 4])
def test_simhash_plan_loses_no_pair(spark, distance):
    rng = np.random.default_rng(3)
    base = rng.integers(0, 2**63, 60, dtype=np.uint64)
    near = np.array([int(x) ^ sum(1 << int(b) for b in rng.choice(64, rng.integers(0, 6), replace=False)) for x in np.repeat(base, 5)], np.uint64)
    fps = np.unique(np.concatenate([base, near])).view(np.int64).tolist()
    want = {(a, b) for a in fps for b in fps if a < b and ((a ^ b) & (2**64 - 1)).bit_count() <= distance}
    got = simhash.links(spark.createDataFrame([(x,) for x in fps], "fp long"), distance).collect()
    assert {(r.a, r.b) for r in got} == want


def test_token_counts(docs, rows):
    from tokenizers import Tokenizer

    path = VOCABULARY("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    library.no_truncation()
    library.no_padding()
    ids = library.encode_batch([t or "" for _, t in rows], add_special_tokens=False)
    want = Counter((i, len((t or "").encode()), len(x.ids), len(x.ids) > 2048) for (i, t), x in zip(rows, ids))
    assert bag(token_counts.count(docs, path, 2048), "doc_id", "n_bytes", "n_tokens", "over_limit") == want


def test_token_budget(docs, rows):
    path = VOCABULARY("word_bpe_49k.json")
    table = token_counts.prefix_table(docs, path)
    full = {(r.doc_id, r.tokens[-1] if r.tokens else 0) for r in table.collect()}
    assert full == {(r.doc_id, r.n_tokens) for r in token_counts.count(docs, path, 2048).collect()}
    within = token_counts.tokens_within(table, 100).collect()
    assert all(r.n_tokens <= 100 for r in within) and any(r.n_tokens > 80 for r in within)


def test_token_records(spark, docs, rows):
    import zlib

    from tokenizers import Tokenizer

    path = VOCABULARY("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    own = sorted([(i, t) for i, t in rows], key=lambda x: (x[0] is not None, x[0] or 0))
    folder = token_records.new_folder(spark, "records")
    got = token_records.read(spark, folder, token_records.write(docs, folder, path, 2)).orderBy("start").collect()
    assert [r.doc_id for r in got] == [i for i, _ in own]
    want = Counter((i, zlib.crc32(np.array([*x.ids, 2], "<u4").tobytes())) for (i, _), x in zip(own, library.encode_batch([t or "" for _, t in own], add_special_tokens=False)))
    assert Counter((r.doc_id, zlib.crc32(bytes(r.ids))) for r in got) == want
    start = 0
    for r in got:
        assert r.start == start
        start += len(r.ids) // 4


def test_record_checksums():
    """Masked CRC-32C of the RFC 3720 examples, and a damaged record."""
    def mask(crc):
        return ((crc >> 15 | crc << 17) + 0xA282EAD8) & 0xFFFFFFFF

    samples = {bytes(32): 0x8A9136AA, b"\xff" * 32: 0x62A8AB43, bytes(range(32)): 0x46DD794E, b"123456789": 0xE3069283}
    for data, crc in samples.items():
        assert token_records.masked_crcs(np.frombuffer(data, np.uint8), np.array([0]), np.array([len(data)])).tolist() == [mask(crc)]
    rows = [token_records.framed(np.array([k]), np.array(x, np.uint32), np.array([0, len(x)]))[0] for k, x in ((1, [5, 6]), (2, [70_000]), (3, [9]))]
    begin = np.cumsum([0, *map(len, rows)])[:-1]
    back = token_records._parsed(np.concatenate(rows), np.stack([begin, [2, 1, 1], [0, 2, 3]], 1))  # of two widths
    assert [np.frombuffer(x.as_py(), "<u4").tolist() for x in back.column(2)] == [[5, 6], [70_000], [9]]
    raw, begin = token_records.framed(np.array([7]), np.array([1, 2, 3], np.uint32), np.array([0, 3]))
    raw[26] ^= 1
    with pytest.raises(ValueError):
        token_records._parsed(raw, np.array([[0, 3, 0]]))


def test_decontamination(spark, docs, rows, sf):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    odd = [(900, "one"), (901, None), (902, ""), (None, "no id here at all"), (903, rows[0][1]), (903, rows[0][1]), (904, "three words only"), (905, rows[-4][1] or "x")]
    table = spark.createDataFrame(items + odd, "item_id long, text string")
    own = sorted(brute.contained(rows, items + odd), key=str)
    for limit in (decontaminate.BROADCAST_ROWS, 0):
        got = decontaminate.contained(docs, table, broadcast_rows=limit)
        assert sorted(map(tuple, got.select("doc_id", "item_id", "n_shingles", "n_shared").collect()), key=str) == own


def test_empty_tables(spark, empty, sf):
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    items = spark.read.parquet(f"{sf}/benchmark.parquet")
    ranks = VOCABULARY("byte_bpe_50k.tiktoken")
    folder = token_records.new_folder(spark, "records")
    for out in (
        quality.apply_rules(empty, labels),
        quality.apply_rules(empty, labels.limit(0)),
        substrings.dedup(empty),
        suffix_dedup.dedup(empty),
        bpe.decode(bpe.encode(empty, ranks), ranks),
        secret_scan.scan(empty),
        language_model.score(empty),
        simhash.near_duplicates(empty),
        token_counts.count(empty, VOCABULARY("word_bpe_49k.json"), 2048),
        token_records.read(spark, folder, token_records.write(empty, folder, VOCABULARY("byte_bpe_50k.json"), 2)),
        decontaminate.contained(empty, items),
        decontaminate.contained(empty, items.limit(0)),
    ):
        assert out.count() == 0
