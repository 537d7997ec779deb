"""The pipeline stage by stage, each on its own input."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as P
from grovespark.llm import decontaminate, quality, queries, secret_scan, simhash

from . import brute


@pytest.fixture(scope="module")
def real(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet").cache()


def test_stages(spark, sf, real):
    names = [n for n, _ in P.STAGES]
    assert len(names) == 5 == len(set(names))
    labels = spark.read.parquet(f"{sf}/labels.parquet")

    kept = P.quality_rules(spark, real, sf).cache()
    want = {r.doc_id for r in quality.apply_rules(real, labels).where("kept").collect()}
    assert kept.columns == real.columns and {r.doc_id for r in kept.collect()} == want and want

    single = P.near_dedup(spark, kept, sf).cache()
    rows = [(r.doc_id, brute.fingerprint(r.text)) for r in kept.collect()]
    least = brute.near_components([i for i, _ in rows], [f for _, f in rows])
    assert single.columns == real.columns and {r.doc_id for r in single.collect()} == set(least.values())

    clean = P.decontamination(spark, single, sf).cache()
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    leaked = {i for i, *_ in brute.contained([(r.doc_id, r.text) for r in single.collect()], items)}
    assert clean.columns == real.columns and {r.doc_id for r in clean.collect()} == {r.doc_id for r in single.collect()} - leaked

    safe = P.redaction(spark, clean, sf).cache()
    assert safe.columns == real.columns and safe.count() == clean.count()
    assert not any(brute.base_secrets(r.text) for r in safe.collect())
    assert all(r.n_chars == len(r.text) for r in safe.collect())
    untouched = {r.doc_id: r.text for r in clean.collect() if not secret_scan.spans_of(r.text)}
    assert untouched.items() <= {r.doc_id: r.text for r in safe.collect()}.items()

    ids = P.encoding(spark, safe, sf)
    assert {r.doc_id: r.decoded_sha256 for r in ids.collect()} == {r.doc_id: brute.sha(r.text) for r in safe.collect()}
    assert Counter(r.doc_id for r in P.run(spark, sf).select("doc_id").collect()) == Counter(r.doc_id for r in safe.collect())


def test_odd_documents(spark, sf, docs):
    """Null ids and texts, repeated rows, further columns."""
    out = docs
    for _, stage in P.STAGES[:-1]:
        out = stage(spark, out, sf).cache()
        assert out.columns == docs.columns
    assert out.where("doc_id IS NULL").count() <= 2
    assert P.STAGES[-1][1](spark, out, sf).count() == out.count()


def test_no_documents(spark, sf, real):
    for _, stage in P.STAGES:
        assert stage(spark, real.limit(0), sf).count() == 0


def test_queries_take_whole_tables(spark, sf):
    n = spark.read.parquet(f"{sf}/documents.parquet").count()
    for name, f in queries.queries().items():
        if name not in ("op1_decontaminate", "op11_lexical_search", "op13_collocations"):  # whose rows are not one a document
            assert f(spark, sf).count() == n, name


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_sql(spark, sf, name):
    from tests import oracle

    got = oracle.spark_rows(queries.queries()[name](spark, sf))
    assert got == oracle.sql_rows(oracle.database(sf), queries.oracle_sql()[name])
