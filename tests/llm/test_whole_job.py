"""Cases where an operator once did less than its whole job."""

import itertools
import random
from collections import Counter
from math import comb

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from grovespark.llm import bpe, components, decontaminate, language_model, quality, queries, secret_scan, shared, simhash, substrings, suffix_dedup, token_counts, token_records
from grovespark.llm import textbatch as tb

from . import brute
from .test_contracts import bag


@pytest.mark.parametrize("partitions", [1, 7])
def test_suffix_dedup_before_a_frequent_line(spark, partitions):
    """Many variants of 20 words, each in two documents, before one line that all have: the order has unrelated words between the two."""
    rng = random.Random(11)
    prose = lambda n: " ".join("".join(rng.choices("abcdefghij", k=6)) for _ in range(n))
    line, variants = prose(30), [prose(20) for _ in range(60)]
    own = [(i, f"{prose(40)} {variants[i % 60]} {line} {prose(40)}") for i in range(120)]
    table = spark.createDataFrame(own, "doc_id long, text string").repartition(3)
    want = brute.without_repeats([t for _, t in own], suffix_dedup.MATCH)
    assert all(x[1] >= 50 for x in want)
    shuffled = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        got = bag(suffix_dedup.dedup(table), "doc_id", "n_words", "n_removed", "kept")
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", shuffled)
    assert got == Counter((i, *x) for (i, _), x in zip(own, want))


def prose(rng, n, letters="abcdefghij", size=6):
    return " ".join("".join(rng.choices(letters, k=size)) for _ in range(n))


def test_secrets_end_with_their_text(spark):
    """Texts without delimiters, one after another, with empty ones between, in every partitioning."""
    rng = random.Random(4)
    bare = ["".join(rng.choices("0123456789abcdef", k=48)) for _ in range(5)]
    texts = [*bare, "", bare[0], "", "", "x" * 15, "y" * 20, None, "token=abcdefgh1", *("".join(rng.choices("ab12 =\nZ", k=rng.randrange(60))) for _ in range(300))]
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    want = {i: secret_scan.spans_of(t or "") for i, t in enumerate(texts)}
    assert all(want[i] == [("hex", 0, 48)] for i in range(5))
    for parts in (1, 7):
        assert {r.doc_id: [tuple(s) for s in r.spans] for r in secret_scan.scan(table.coalesce(1).repartition(parts)).collect()} == want


def test_secret_battery():
    """Random tokens pass the tests as often as their level says; lone short ones are found, words are not."""
    rng = random.Random(9)
    joint = [secret_scan.battery("".join(rng.choices(secret_scan.ALPHABETS[5], k=40)))[0] for _ in range(1500)]
    assert 0.02 < sum(p < 0.05 for p in joint) / len(joint) < 0.09
    assert secret_scan.battery("abcabcabcabcabc1abcabcabcabcabc1")[0] < secret_scan.STRUCTURED
    plain = ["internationalization2024", "customer_order_details_v2", "2024-02-29-release-notes-1", "abcdefghijklmnop1234567890", "kubernetes-proxy-config", "getUserAccountByEmailAddress", "XMLHttpRequestUpload", "covid19vaccine2021", "Donaudampfschifffahrtsgesellschaft"]
    assert not any(secret_scan.spans_of(f"see {t} there") for t in plain)
    assert not secret_scan.spans_of(" ".join(plain * 5))


def test_secret_recall():
    """Nine of ten random tokens are found from 16 characters on, of letters alone too (in one case: from 20); and of 24 characters beside 45 names."""
    rng = random.Random(10)
    beside = " ".join(["internationalization2024", "customer_order_details_v2", "implementation-notes", "getUserAccountByEmailAddress", "Donaudampfschifffahrtsgesellschaft"] * 9)
    letters = secret_scan.ALPHABETS[5][:52]
    for alphabet, size, least in ((0, 16, 0.9), (1, 16, 0.9), (3, 16, 0.9), (5, 16, 0.9), (6, 16, 0.9), (letters, 16, 0.9), (letters[:26], 20, 0.88), (letters[:26], 16, 0.75)):
        drawn = secret_scan.ALPHABETS[alphabet] if isinstance(alphabet, int) else alphabet
        found = lambda text, size: any(k in ("random", "hex") and a <= 4 and b >= 4 + size for k, a, b in secret_scan.spans_of(text))
        assert sum(found(f"key {''.join(rng.choices(drawn, k=size))} is here", size) for _ in range(500)) >= least * 500
        if len(drawn) > 26 or alphabet == 0:
            assert sum(found(f"key {''.join(rng.choices(drawn, k=24))} is {beside}", 24) for _ in range(100)) >= 88


def test_secret_levels():
    """Text of independent letters looks like no text less often than the level says; the sums of the binomial are those of a plain count."""
    rng = random.Random(12)
    drawn = ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", secret_scan.TEXT_LETTERS, k=rng.randrange(16, 40))) for _ in range(2000)]
    assert sum(secret_scan.battery(t)[1] < 0.01 for t in drawn) < 30
    for k, n, rate in ((0, 5, 0.3), (3, 5, 0.3), (5, 5, 0.3), (2, 9, 0.1)):
        ways = sum(rate ** sum(x) * (1 - rate) ** (n - sum(x)) for x in itertools.product((0, 1), repeat=n) if sum(x) >= k)
        assert abs(secret_scan._at_least(k, n, rate) - ways) < 1e-12
    assert abs(secret_scan._at_least(110, 1001, 0.1) - secret_scan._at_least(110, 1000, 0.1)) < 0.02  # the normal law beyond 1000
    assert secret_scan.battery("x" * 5000)[0] < secret_scan.STRUCTURED


@pytest.mark.parametrize("n", [1, 2, 3, 10])
def test_simhash_of_few_rows(spark, n):
    rng = random.Random(n)
    table = spark.createDataFrame([(i, prose(rng, 60)) for i in range(n)], "doc_id long, text string")
    assert {(r.doc_id, r.component_id) for r in simhash.near_duplicates(table).collect()} == {(i, i) for i in range(n)}


def test_simhash_probes_are_bounded():
    rng = np.random.default_rng(1)
    for n, bits in ((0, 0), (2, 64), (3, 5), (50, 3), (1000, 64)):
        both = np.zeros((64, 64), np.int64)
        for _ in range(n):
            b = (rng.random(64) < 0.5) & (np.arange(64) < bits)
            both += np.outer(b, b)
        plan = simhash.plan(n, both, 4)
        assert sum(t + 1 for _, t in plan) == 5
        assert sum(comb(len(own), k) for own, t in plan for k in range(t + 1)) <= simhash.MOST_PROBES


def test_large_tables_are_not_broadcast(spark):
    """Spark takes an exploded table for as many rows as before, and would send all probes to the driver; only counted tables are broadcast."""

    def plan(df):
        return df._jdf.queryExecution().executedPlan().toString()

    fps = spark.range(3_000).select(F.xxhash64("id").alias("fp"))
    assert "BroadcastHashJoin" in plan(fps.join(fps.select("fp", F.explode(F.sequence(F.lit(0), F.lit(200)))), "fp"))
    assert "Broadcast" not in plan(simhash.links(fps, 4))
    edges = spark.range(3_000).select(F.col("id").alias("u"), F.lit(-1).cast("long").alias("v"))
    assert "Broadcast" not in plan(components._star(edges, True)) + plan(components._star(edges, False))
    assert "Broadcast" not in plan(fps.join(shared.small(fps, rows=2_999), "fp"))
    assert "BroadcastHashJoin" in plan(fps.join(shared.small(fps, rows=3_000), "fp"))
    several = fps.select("fp", F.explode(F.sequence(F.lit(0), F.lit(200)))).select("fp")
    joined = plan(shared.join_counted(several, fps.withColumn("n", F.when(F.col("fp") > 0, 201).otherwise(1)), ["fp"], "n"))
    assert joined.count("BroadcastHashJoin") == 2 and joined.count("SortMergeJoin") == 1  # the frequent keys, twice, and the others


def test_language_model_sends_few_rows(spark, sf, monkeypatch):
    """A chunk of text sends a row for each part of a large filter, not for each of its many buckets; the scores are those of the filter in memory."""
    documents = spark.read.parquet(f"{sf}/documents.parquet")
    (c,) = tb.chunks(pa.array([r.text for r in documents.select("text").collect()], pa.string()), 1 << 30)
    tokens = language_model.Tokens(c)
    shape = language_model.Shape(9, [1, 1, 1], 1)
    for order in range(1, language_model.ORDERS + 1):
        g = language_model.distinct([(tokens, tokens.grams())], order)
        part, grams = shape.by_part(g)
        assert len(set(shape.bucket(g).tolist())) == 512 and part.tolist() == list(range(64))
        assert np.array_equal(np.concatenate(grams), np.unique(tokens.grams()[order - 1]))
    monkeypatch.setattr(language_model, "BUCKET_BYTES", len(c.data) // 512)
    scores = [bag(language_model.score(documents, broadcast_bytes=b).select("doc_id", F.round("score", 9).alias("score")), "doc_id", "score") for b in (0, 1 << 30)]
    assert scores[0] == scores[1]


def test_one_large_group_of_near_copies(spark):
    rng = random.Random(2)
    words = prose(rng, 400).split()
    own = [(i, " ".join([*words[:200], f"w{i}", *words[201:]])) for i in range(300)]
    fps = [brute.fingerprint(t) for _, t in own]
    want = brute.near_components([i for i, _ in own], fps)
    got = simhash.near_duplicates(spark.createDataFrame(own, "doc_id long, text string"))
    assert {r.doc_id: r.component_id for r in got.collect()} == want


def test_near_dedup_of_repeated_ids(spark):
    """Texts are told apart under one id, copies under none are reduced, equal rows stay once."""
    rng = random.Random(3)
    a, b, c = (prose(rng, 60) for _ in range(3))
    table = spark.createDataFrame([(3, a), (7, a), (7, b), (7, b), (None, c), (None, c), (None, b), (9, None), (8, None)], "doc_id long, text string")
    left = Counter((r.doc_id, r.text) for r in corpus_pipeline.near_dedup(spark, table, "").collect())
    assert left == Counter([(3, a), (7, b), (None, c), (8, None)])


def test_many_equal_rows(spark):
    """3,000 rows of one id and text, and as many without id."""
    text = prose(random.Random(6), 120)
    table = spark.createDataFrame([(1, text)] * 3000 + [(None, text)] * 3000 + [(2, prose(random.Random(7), 120))], "doc_id long, text string")
    for m in (substrings, suffix_dedup):
        assert bag(m.dedup(table), "doc_id", "n_removed") == Counter({(1, 120): 3000, (None, 120): 3000, (2, 0): 1})


def test_very_long_texts(spark, sf):
    """A word of 200,000 letters, a text of 200,000 words, and both twice over where copies matter."""
    import public_tokenizers
    import tiktoken
    from tokenizers import Tokenizer

    rng = random.Random(8)
    texts = ["".join(rng.choices("etaoinshrdlu", k=200_000)), prose(rng, 200_000), "=" * 100_000]
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    path = public_tokenizers.path
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.load_ranks(path("byte_bpe_50k.tiktoken")).ranks, special_tokens={})
    assert {r.doc_id: bytes(r.ids) for r in bpe.encode(table, path("byte_bpe_50k.tiktoken")).collect()} == {i: np.array(library.encode_ordinary(t), "<u4").tobytes() for i, t in enumerate(texts)}
    counted = Tokenizer.from_file(path("word_bpe_49k.json"))
    counted.no_truncation()
    assert {r.doc_id: r.n_tokens for r in token_counts.count(table, path("word_bpe_49k.json"), 2048).collect()} == {i: len(counted.encode(t, add_special_tokens=False).ids) for i, t in enumerate(texts)}
    folder = token_records.new_folder(spark, "records")
    back = token_records.read(spark, folder, token_records.write(table, folder, path("byte_bpe_50k.json"), 2)).collect()
    own = Tokenizer.from_file(path("byte_bpe_50k.json"))
    assert {r.doc_id: np.frombuffer(bytes(r.ids), "<u4").tolist() for r in back} == {i: [*own.encode(t, add_special_tokens=False).ids, 2] for i, t in enumerate(texts)}
    twice = table.union(table.withColumn("doc_id", F.col("doc_id") + 10))
    assert bag(substrings.dedup(twice), "doc_id", "n_removed") == bag(suffix_dedup.dedup(twice), "doc_id", "n_removed") == Counter({(i, len(texts[i % 10].split()) * (i % 10 == 1)): 1 for i in (0, 1, 2, 10, 11, 12)})
    assert {(r.doc_id, r.component_id) for r in simhash.near_duplicates(twice).collect()} >= {(11, 1), (10, 0), (12, 2)}
    scores = {r.doc_id: (r.n_tokens, r.base_score) for r in language_model.score(table).collect()}
    want = brute.unigram_scores(list(enumerate(texts)))
    assert all(scores[i][0] == w[1] and abs(scores[i][1] - w[4]) < 1e-6 * abs(w[4]) for i, w in enumerate(want))
    assert {r.doc_id: r.n_words for r in quality.apply_rules(table, spark.read.parquet(f"{sf}/labels.parquet")).collect()} == {i: len(t.split()) for i, t in enumerate(texts)}
    item = spark.createDataFrame([(5, " ".join(texts[1].split()[150_000:150_020]))], "item_id long, text string")
    assert [tuple(r)[:2] for r in decontaminate.contained(table, item).collect()] == [(1, 5)]
    assert [r.doc_id for r in secret_scan.scan(table).where("size(spans) > 0").collect()] == []


def test_classes_are_the_libraries(spark):
    """Every code point's class against the tokenizers library, whose tables the classes are not taken from."""
    from tokenizers import Regex, pre_tokenizers

    from grovespark.llm import textbatch as tb

    points = [*range(0xD800), *range(0xE000, 0x110000)]
    everything = "".join(map(chr, points))
    for pattern, kind in ((r"\p{L}+", tb.LETTERS), (r"\p{N}+", tb.NUMBERS), (r"\s+", tb.SPACES)):
        inside = np.ones(len(points), bool)
        for _, (a, b) in pre_tokenizers.Split(Regex(pattern), "removed").pre_tokenize_str(everything):
            inside[a:b] = False
        assert (inside == (tb.char_classes()[points] == kind)).all()


def test_query_digests(spark, sf):
    """The digest columns of the registered queries against plain versions."""
    import zlib

    import public_tokenizers
    import tiktoken
    from tokenizers import Tokenizer

    rows = [(r.doc_id, r.text or "") for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    path = public_tokenizers.path
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.load_ranks(path("byte_bpe_50k.tiktoken")).ranks, special_tokens={})
    ids = {i: np.array(library.encode_ordinary(t), "<u4").tobytes() for i, t in rows}
    assert bag(queries.op4_bpe(spark, sf), "doc_id", "n_tokens", "ids_sha256", "decoded_sha256") == Counter((i, len(ids[i]) // 4, brute.sha(ids[i]), brute.sha(t)) for i, t in rows)
    base = {i: ",".join(f"{k}:{a}:{b}" for k, a, b in brute.base_secrets(t)) for i, t in rows}
    found = queries.op5_secrets(spark, sf).collect()
    assert {r.doc_id: r.base_sha256 for r in found} == {i: brute.sha(x) for i, x in base.items()}
    assert all([x for x in r.spans.split(",") if x and not x.startswith("random")] == [x for x in base[r.doc_id].split(",") if x] for r in found)
    assert bag(queries.op7_simhash(spark, sf), "doc_id", "fingerprint") == Counter((i, f"{brute.fingerprint(t):016x}") for i, t in rows)
    own = Tokenizer.from_file(path("byte_bpe_50k.json"))
    start, want = 0, Counter()
    for i, t in sorted(rows):
        x = np.array([*own.encode(t, add_special_tokens=False).ids, 2], "<u4")
        want[i, start, len(x), zlib.crc32(x.tobytes())] += 1
        start += len(x)
    assert bag(queries.op10_token_records(spark, sf), "doc_id", "start", "n_tokens", "ids_crc32") == want
