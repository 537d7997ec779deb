"""From raw documents to token ids in five stages; each works on all that the one before kept.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
as Parquet and read again as the next one's docs. All but the last return the
columns of documents. Null ids and texts, very long texts, ties, repeated rows,
empty tables and further columns are as in the operators' docstrings.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from grovespark.llm import bpe, decontaminate, quality, secret_scan, simhash
from grovespark.llm.shared import cut, shared_folder, small

#: SQL cannot express the fingerprints' hashes nor the merges of the vocabulary.
ORACLE_SQL = None


def _free(name: str, docs: DataFrame) -> str:
    while name in docs.columns:
        name += "_"
    return name


def _met(rows: DataFrame, own: str, keys: DataFrame, how: str) -> DataFrame:
    """Semi or anti join of rows, whose column `own` is their key, with (id, key); null ids are equal."""
    i, k = _free("_id", rows), _free("_key", rows)
    named = keys.select(F.col("id").alias(i), F.col("key").alias(k))
    return rows.join(named, (F.col(own) == F.col(k)) & F.col("doc_id").eqNullSafe(F.col(i)), how)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    verdict = _free("_kept", docs)
    judged = quality.apply_rules(docs, labels, keep=tuple(docs.columns), as_column=verdict)
    return judged.where(F.col(verdict)).select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies one document stays, once: that with the least id, of equal ids that with the least hash of id and text."""
    own = _free("_own", docs)
    rows = docs.withColumn(own, decontaminate.row_key("doc_id", "text"))

    def named(keys: DataFrame, how: str) -> DataFrame:
        return _met(rows, own, small(keys), how)

    gone, several = simhash.losers(docs)
    if several.isEmpty():
        return named(gone, "left_anti").select(*docs.columns)
    once = named(several, "left_semi").dropDuplicates(["doc_id", own])
    return named(gone.union(several), "left_anti").union(once).select(*docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    found = decontaminate.contained(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    keys = cut(found.select(F.col("doc_id").alias("id"), F.col("row_key").alias("key")).distinct())
    own = _free("_own", docs)
    return _met(docs.withColumn(own, decontaminate.row_key("doc_id", "text")), own, small(keys), "left_anti").select(*docs.columns)


def redaction(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by a mark; n_chars follows."""
    spans = _free("_spans", docs)
    scanned = secret_scan.scan(docs, keep=tuple(docs.columns), as_column=spans)
    text = secret_scan.redacted(F.col("text"), F.col(spans))
    changed = scanned.withColumn("text", text)
    if "n_chars" in docs.columns:
        changed = changed.withColumn("n_chars", F.when(F.size(spans) > 0, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return changed.select(*docs.columns)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, and digests of them and of what they decode to."""
    import public_tokenizers

    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    coded = bpe.encode(docs, ranks, decoded=True)
    return coded.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"), "ids")


STAGES = [("quality rules", quality_rules), ("near dedup", near_dedup), ("decontamination", decontamination), ("secret redaction", redaction), ("encoding", encoding)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    for k, (_, stage) in enumerate(STAGES[:-1]):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
    return STAGES[-1][1](spark, docs, sf_dir)
