"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, collocations, decontaminate, jaccard_join, language_model, lexical_search, quality, secret_scan, simhash, substrings, suffix_dedup, token_counts, token_records


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contained(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "n_shingles", "n_shared")


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.apply_rules(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op3_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.dedup(_table(spark, sf_dir, "documents")).select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = _vocabulary("byte_bpe_50k.tiktoken")
    coded = bpe.encode(_table(spark, sf_dir, "documents"), ranks, decoded=True)
    return coded.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    spans = F.col("spans")
    return secret_scan.scan(_table(spark, sf_dir, "documents")).select(
        "doc_id",
        *(F.size(secret_scan.of_kind(spans, k)).cast("long").alias(f"n_{k}") for k in secret_scan.KINDS),
        F.sha2(secret_scan.listed(secret_scan.of_kind(spans, *secret_scan.BASE_KINDS)).cast("binary"), 256).alias("base_sha256"),
        secret_scan.listed(spans).alias("spans"),
    )


def op6_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_model.score(_table(spark, sf_dir, "documents"))


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    near = simhash.near_duplicates(_table(spark, sf_dir, "documents"))
    return near.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count(_table(spark, sf_dir, "documents"), _vocabulary("word_bpe_49k.json"), 2048)


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    spans = F.array_join(F.transform("removed", lambda x: F.concat_ws(":", x["start"], x["end"])), ",")
    return suffix_dedup.dedup(_table(spark, sf_dir, "documents")).select("doc_id", "n_words", "n_removed", spans.alias("repeated"), F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


def op10_token_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = token_records.new_folder(spark, "records")
    parts = token_records.write(_table(spark, sf_dir, "documents"), folder, _vocabulary("byte_bpe_50k.json"), 2)
    back = token_records.read(spark, folder, parts)
    return back.select("doc_id", "start", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = lexical_search.build(_table(spark, sf_dir, "documents"))
    return lexical_search.search(index, _table(spark, sf_dir, "benchmark"), 10)


def op12_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.similar(_table(spark, sf_dir, "documents"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(_table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_decontaminate": op1_decontaminate,
        "op2_quality": op2_quality,
        "op3_substrings": op3_substrings,
        "op4_bpe": op4_bpe,
        "op5_secrets": op5_secrets,
        "op6_language_model": op6_language_model,
        "op7_simhash": op7_simhash,
        "op8_token_counts": op8_token_counts,
        "op9_suffix_dedup": op9_suffix_dedup,
        "op10_token_records": op10_token_records,
        "op11_lexical_search": op11_lexical_search,
        "op12_jaccard_join": op12_jaccard_join,
        "op13_collocations": op13_collocations,
    }


_DECONTAMINATE = r"""
WITH words AS (
    SELECT doc_id AS id, 0 AS kind, list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+'), lambda x: x <> '') AS w FROM documents
    UNION ALL
    SELECT item_id, 1, list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+'), lambda x: x <> '') FROM benchmark
), shingles AS (
    SELECT DISTINCT id, kind, array_to_string(w[i:i + 4], ' ') AS s FROM (SELECT id, kind, w, unnest(range(1, len(w) - 3)) AS i FROM words WHERE len(w) >= 5)
), items AS (SELECT id AS item_id, s, count(*) OVER (PARTITION BY id) AS n FROM shingles WHERE kind = 1)
SELECT d.id AS doc_id, item_id, n AS n_shingles, count(*) AS n_shared
FROM shingles d JOIN items USING (s) WHERE d.kind = 0
GROUP BY d.id, item_id, n HAVING count(*) >= ceil(0.8 * n - 1e-9)
"""

_SUBSTRINGS = r"""
WITH words AS (
    SELECT doc_id, list_filter(regexp_split_to_array(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents
), windows AS (
    SELECT doc_id, i, md5(array_to_string(w[i:i + 34], ' ')) AS h FROM (SELECT doc_id, w, unnest(range(1, len(w) - 33)) AS i FROM words WHERE len(w) >= 35)
), twice AS (SELECT h FROM windows GROUP BY h HAVING count(*) > 1),
gone AS (
    SELECT doc_id, list(DISTINCT i + j) AS gone_at FROM (SELECT doc_id, i, unnest(range(0, 35)) AS j FROM windows WHERE h IN (SELECT h FROM twice)) GROUP BY doc_id
), kept AS (
    SELECT doc_id, w, list_filter(range(1, len(w) + 1), lambda i: NOT list_contains(coalesce(gone_at, []), i)) AS own FROM words LEFT JOIN gone USING (doc_id)
)
SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - len(own))::BIGINT AS n_removed, sha256(array_to_string(list_transform(own, lambda i: w[i]), ' ')) AS kept_sha256 FROM kept
"""


_COLLOCATIONS = r"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang, list_filter(regexp_split_to_array(p, '[ \t]+'), lambda x: x <> '') AS w
    FROM (SELECT lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS p FROM documents)
), grams AS (
    SELECT lang, array_to_string(w[i:i + k - 1], ' ') AS g, k, count(*) AS a
    FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM pieces, (VALUES (1), (2), (3)) s(k) WHERE len(w) >= k) GROUP BY ALL
), total AS (SELECT lang, sum(len(w))::BIGINT AS n FROM pieces GROUP BY lang),
cand AS (SELECT lang, g, k, a, string_split(g, ' ') AS w FROM grams WHERE k > 1 AND a >= 10),
cuts AS (
    SELECT c.lang, c.g, c.k, c.a, i, x.a AS l, y.a AS r, ((1000000::HUGEINT * c.a * c.a) // (x.a::HUGEINT * y.a))::BIGINT AS score
    FROM (SELECT *, unnest(range(1, k)) AS i FROM cand) c
    JOIN grams x ON x.lang = c.lang AND x.g = array_to_string(c.w[1:i], ' ')
    JOIN grams y ON y.lang = c.lang AND y.g = array_to_string(c.w[i + 1:c.k], ' ')
), best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, i) = 1),
held AS (SELECT lang, g, max(a) AS held FROM (SELECT lang, a, unnest([array_to_string(w[1:2], ' '), array_to_string(w[2:3], ' ')]) AS g FROM cand WHERE k = 3) GROUP BY ALL),
kept AS (SELECT b.* FROM best b LEFT JOIN held h USING (lang, g) WHERE h.held IS NULL OR 100 * h.held < 50 * b.a)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, g) AS rank, g AS phrase, a, l, r, n, score
FROM kept JOIN total USING (lang) QUALIFY rank <= 2000
"""


_LEXICAL_SEARCH = r"""
WITH words AS (
    SELECT rowid_ AS r, doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t
    FROM (SELECT *, row_number() OVER () AS rowid_ FROM documents)
), tfs AS (SELECT r, doc_id, t, count(*) AS tf FROM words GROUP BY ALL),
sizes AS (SELECT r, count(*) AS n FROM words GROUP BY r),
corpus AS (SELECT count(*) AS docs, sum(n)::BIGINT AS total FROM sizes),
asked AS (
    SELECT DISTINCT i, item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t
    FROM (SELECT *, row_number() OVER () AS i FROM benchmark)
), weights AS (SELECT t, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM tfs, corpus WHERE t IN (SELECT t FROM asked) GROUP BY t, docs),
scores AS (
    SELECT i, item_id, r, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * docs) // total))))::BIGINT AS score
    FROM asked JOIN tfs USING (t) JOIN weights USING (t) JOIN sizes USING (r), corpus GROUP BY ALL
)
SELECT item_id, (row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id))::INTEGER AS rank, doc_id, score FROM scores WHERE score > 0 QUALIFY rank <= 10
"""


def oracle_sql() -> dict[str, str]:
    return {"op11_lexical_search": _LEXICAL_SEARCH, "op13_collocations": _COLLOCATIONS, "op1_decontaminate": _DECONTAMINATE, "op3_substrings": _SUBSTRINGS}
