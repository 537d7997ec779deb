"""Registered queries of governed releases, over runs drawn from orders and line items, and their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import shapes
from ..operators import bundle, governance, graph, matching
from ..sources import features, registry
from ..sources.tables import load

FOUND: dict = {}


def query(f):
    FOUND[f.__name__] = f
    return f


def _sha(column):
    return F.sha2(column.cast("string"), 256)


def _order():
    return F.col("o_orderkey")


def _item():
    return F.col("l_orderkey")


def _runs(spark, sf):
    status = F.when(_order() % 9 == 0, "failed").when(_order() % 5 == 0, "approved").when(_order() % 8 == 0, "completed").otherwise("review")
    return load(spark, sf, "orders").select(_order().alias("run"), (_order() % 50).alias("snapshot"), _sha(_order() % 3).alias("commit"), status.alias("status"), _sha(_order()).alias("sha256"))


def _decisions(spark, sf):
    kind = F.when(_item() % 40 == 7, "needs_review").when((_item() + F.col("l_linenumber")) % 2 == 0, "matched").otherwise("create")
    proposed = F.when(kind == "create", F.concat(F.lit("p"), F.col("l_partkey")))
    return load(spark, sf, "lineitem").where((_item() % 45 != 2) | (F.col("l_linenumber") > 1)).select(_item().alias("run"), F.col("l_linenumber").cast("string").alias("code"), kind.alias("decision"), proposed.alias("proposed_id"))


def _approvals(spark, sf):
    sha = F.when(_order() % 12 == 0, _sha(F.lit("other"))).otherwise(_sha(_order()))
    return load(spark, sf, "orders").where(_order() % 5 < 2).select(_order().alias("run"), sha.alias("sha256"), F.col("o_custkey").cast("string").alias("approved_by"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("approved_at"), F.col("o_orderpriority").alias("rationale"))


@query
def approve_gate(spark, sf):
    asked = load(spark, sf, "orders").select(F.when(_order() % 11 == 0, -_order()).otherwise(_order()).alias("run"), F.when(_order() % 7 == 0, F.lit("x")).otherwise(_sha(_order())).alias("sha256"))
    items = load(spark, sf, "lineitem")
    findings = items.select(_item().alias("run"), F.when(_item() % 30 == 4, "blocker").when(_item() % 30 == 5, "error").otherwise("warning").alias("severity"))
    staged = items.select(_item().alias("run"), ((_item() % 47 != 3) | (F.col("l_linenumber") > 1)).alias("parsed"))
    return governance.approval_verdicts(asked, _runs(spark, sf), findings, _decisions(spark, sf), staged, _approvals(spark, sf))


def _context(spark, sf):
    s = F.col("s_suppkey")
    snapshots = spark.range(50).where("id % 10 != 9").select(F.col("id").alias("snapshot"), (F.col("id") % 4).alias("source"), _sha(F.col("id")).alias("source_sha256"), (F.col("id") + 1).alias("size"))
    sources = load(spark, sf, "supplier").where(s < 3).select(s.alias("source"), F.col("s_name").alias("publisher"))
    return governance.approved_context(_runs(spark, sf), _approvals(spark, sf), snapshots, sources)


@query
def approved_context(spark, sf):
    return _context(spark, sf).drop("rationale")


@query
def promote_gate(spark, sf):
    k = F.col("run")
    name = F.concat(F.lit("r"), k)
    known = _context(spark, sf)
    at = F.when(k % 13 == 0, "2023-01-01").otherwise("2025-01-01")
    manifests = known.select(
        name.alias("release_id"), _sha(name).alias("manifest_sha256"), F.when(k % 17 == 0, -k).otherwise(k).alias("run"), F.when(k % 19 == 0, F.lit("x")).otherwise(F.col("sha256")).alias("sha256"), "commit", "approved_by",
        F.when(k % 37 == 0, F.col("snapshot") + 1).otherwise(F.col("snapshot")).alias("snapshot"), F.when(k % 41 == 0, F.lit("y")).otherwise(F.col("source_sha256")).alias("source_sha256"),
        F.when(k % 43 == 0, F.lit("for no reason")).otherwise(F.col("rationale")).alias("rationale"),
        F.when(k % 23 == 0, F.lit("never")).otherwise(F.col("approved_at")).alias("approved_at"), F.when(k % 29 == 0, F.lit("r0")).otherwise(F.lit("stable-1")).alias("previous_release_id"), at.alias("published_at"),
    )
    old = known.where("run % 31 = 0").select(name.alias("release_id"), F.when(k % 2 == 0, "published").otherwise("draft").alias("status"), _sha(name).alias("manifest_sha256"), F.lit("2024-06-01").alias("published_at"))
    one = spark.createDataFrame([("stable-1", "published", "m", "2024-01-01")], "release_id string, status string, manifest_sha256 string, published_at string")
    stable = spark.createDataFrame([("stable-1",)], "release string")
    return governance.promotion_verdicts(manifests, known, old.unionByName(one), stable)


@query
def promote_faults(spark, sf):
    k = F.col("c_custkey")
    c = load(spark, sf, "customer")
    code, own = k.cast("string").alias("code"), F.concat(F.lit("t"), k)
    units = c.select(code, own.alias("territory_id"))
    matched = k % 3 != 0
    candidate = F.when(matched, F.when(k % 31 == 1, F.lit("other")).otherwise(own))
    decisions = c.where(k % 41 != 0).select(code, F.when(matched, "matched").otherwise("create").alias("decision"), candidate.alias("candidate_id"), F.when(~matched, own).alias("proposed_id"))
    territories = c.where((k % 3 != 0) | (k % 37 == 0)).select(own.alias("territory_id"))
    ended = F.when(k % 43 == 2, F.lit("2020-01-01"))
    identifiers = c.where(matched).select(F.lit(registry.CODE_SCHEME).alias("scheme"), k.cast("string").alias("value"), F.when(k % 47 == 4, "retired").otherwise("active").alias("status"), ended.alias("valid_to"), own.alias("territory_id"))
    return governance.promotion_faults(units, decisions, territories, identifiers)


@query
def staged_proposals(spark, sf):
    return governance.proposals(_decisions(spark, sf), _runs(spark, sf))


@query
def stable_release(spark, sf):
    channels = load(spark, sf, "customer").select(F.when(F.col("c_custkey") % 2 == 0, "stable").otherwise("next").alias("channel"), F.col("c_custkey").alias("release"))
    releases = load(spark, sf, "orders").select(F.col("o_custkey").alias("release_id"), _order().alias("run"), F.when(_order() % 4 == 0, "draft").otherwise("published").alias("status"))
    return governance.stable_release(channels, releases, _approvals(spark, sf))


@query
def candidate_faults(spark, sf):
    """Customers in the order of their keys: repeated ids and codes, codes out of order, missing parents, a ring, another snapshot."""
    k = F.col("c_custkey")
    name = lambda key: F.concat(F.lit("t"), key)
    code = F.when(k % 59 == 5, F.lit("12x")).when(k % 61 == 6, (k - 2).cast("string")).otherwise(k.cast("string"))
    region = F.when(k % 67 == 7, F.concat(F.lit("N"), k - k % 3)).otherwise(F.concat(F.lit("N"), k))
    one = lambda scheme, value: F.struct(F.lit(scheme).alias("scheme"), F.lit("active").alias("status"), value.alias("value"))
    parent = F.when(k % 71 == 8, name(k + 1)).when(k % 71 == 9, name(k - 1)).when(k % 73 == 10, F.lit("gone"))
    units = load(spark, sf, "customer").select(
        F.when(k % 79 == 11, name(k - 1)).otherwise(name(k)).alias("territory_id"), code.alias("code"), k.alias("position"), F.when(k % 83 == 12, "s2").otherwise("s1").alias("snapshot"),
        F.array(one(registry.CODE_SCHEME, code), one(registry.REGION_SCHEME, region)).alias("identifiers"), parent.alias("parent_id"), F.when(k % 89 == 13, F.lit("gone")).alias("county_id"),
    )
    return governance.candidate_faults(units.where("code != '12x' OR position % 2 = 1"), "s1").groupBy("fault").agg(F.count("*").alias("n"))


@query
def changelog_faults(spark, sf):
    k = F.col("o_orderkey")
    rows = load(spark, sf, "orders").select(
        k.alias("release_id"), F.when(k % 5 != 0, F.lit("r")).alias("previous_release_id"), (k % 6 != 0).alias("baseline"), (k % 7 == 0).alias("skipped"), (k % 3).alias("added"), F.when(k % 8 == 0, k % 3).otherwise(F.lit(0)).alias("removed"),
        F.lit(1).alias("changed"), F.lit(10).alias("unchanged"), (k % 9 - 7).alias("blocking"), (k % 3 + F.when(k % 10 == 0, 12).otherwise(11)).alias("territories"),
    )
    return governance.diff_faults(rows)


@query
def metadata_faults(spark, sf):
    k = F.col("o_orderkey")
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    time = lambda d: F.concat(d, F.lit("T10:00:00.000Z"))
    rows = load(spark, sf, "orders").select(
        k.alias("key"), F.concat(F.replace(day, F.lit("-"), F.lit(".")), F.when(k % 7 == 0, F.lit("")).otherwise(F.lit(".1"))).alias("release_id"), F.when(k % 5 == 0, F.lit("2020.01.01.1")).when(k % 5 == 1, F.lit("first")).alias("previous_release_id"),
        time(F.when(k % 11 == 0, F.date_format(F.date_sub("o_orderdate", 1), "yyyy-MM-dd")).otherwise(day)).alias("published_at"), F.repeat(F.lit("a"), F.when(k % 3 == 0, 39).otherwise(40)).alias("commit"), F.when(k % 4 == 0, F.lit("owner")).otherwise(F.lit("owner/name")).alias("repository"),
        F.when(k % 6 == 0, F.lit("  ")).when(k % 6 == 1, F.lit("someone")).otherwise(F.lit("x")).alias("approved_by"), F.when(k % 8 != 0, time(day)).alias("approved_at"), F.when(k % 9 == 0, F.lit("  short    ")).otherwise(F.lit("long enough")).alias("rationale"),
        _sha(k).alias("sha256"), F.when(k % 10 == 0, F.lit("https://data.gov.ro.example.org/x")).otherwise(F.lit("https://data.gov.ro/x")).alias("uri"), (k % 12).alias("size"),
    )
    return governance.metadata_faults(rows).groupBy("release_id", "fault").agg(F.count("*").alias("n"))


@query
def revision_rows(spark, sf):
    units = registry.with_identifiers(registry.forest(spark, sf)).withColumn("corrected_from", F.when(F.col("level") == 1, F.concat(F.lit("old-"), "code")))
    return governance.revision_rows(units, "r1").select("territory_id", "code", "official_name", "release_id", "metadata")


@query
def issued_identifiers(spark, sf):
    return governance.issued_identifiers(registry.with_identifiers(registry.forest(spark, sf)), "r1")


@query
def matchable_units(spark, sf):
    units = registry.forest(spark, sf).withColumn("recorded_to", F.when(F.col("code").cast("long") % 5 == 3, F.lit("2024-01-01")))
    code = units.select(F.lit(registry.CODE_SCHEME).alias("scheme"), "territory_id", F.col("code").alias("value"), F.when(F.col("code").cast("long") % 4 == 2, "retired").otherwise("active").alias("status"))
    return governance.matchable(units.drop("code"), code).select("territory_id", "official_name", "territory_type", "county_id", "code")


def _shapes(spark, sf):
    """Two shapes of most customers, the later one to the right of the first."""
    k = F.col("c_custkey")
    c = load(spark, sf, "customer").where(k % 6 != 0)
    at = lambda n: c.select(registry.unit_id(3, k).alias("territory_id"), F.lit(n).alias("at"), shapes.cell(k % 100 + n, F.floor(k / 100)).alias("polygons"))
    return at(1).unionByName(at(2))


@query
def county_map_inputs(spark, sf):
    units = registry.forest(spark, sf).where("level = 3")
    return governance.map_inputs(governance.decorated(units, _shapes(spark, sf)), shapes.bounds)


@query
def geometry_rows(spark, sf):
    k = F.col("c_custkey")
    matched = load(spark, sf, "customer").select(registry.unit_id(3, k).alias("territory_id"), F.concat(F.lit("f"), k).alias("feature"), F.concat(F.lit('{"id":'), k, F.lit("}")).alias("geometry"))
    return governance.geometry_rows(matched, "s1")


@query
def county_union(spark, sf):
    k = F.col("c_custkey")
    cells = load(spark, sf, "customer").select("c_nationkey", shapes.cell(k % 100, F.floor(k / 100)).alias("polygons"))
    return matching.union_measures(matching.union_boundary(cells, "c_nationkey"), "c_nationkey")


@query
def registry_report(spark, sf):
    names = spark.createDataFrame([(n,) for n in ("orders", "customer", "absent")], "name string")
    present = spark.createDataFrame([(n,) for n in ("orders", "customer", "nation")], "name string")
    return governance.registry_report(names, present, _runs(spark, sf), load(spark, sf, "orders").select(F.when(_order() % 4 == 0, "draft").otherwise("published").alias("status")))


@query
def contract_rows(spark, sf):
    return bundle.listed(bundle.contract(spark, shapes=True)).select("name", "required")


@query
def contract_verdicts(spark, sf):
    k = F.col("o_orderkey")
    names = F.array(*(F.lit(a[0]) for a in bundle.ARTIFACTS))
    version = F.when(k % 5 == 0, "2.1.0").when(k % 5 == 1, "1.0").otherwise(F.concat(F.lit("1."), k, F.lit(".0")))
    held = F.when(k % 7 == 0, F.slice(names, 2, 20)).when(k % 7 == 1, F.concat(names, F.slice(names, 1, 1))).when(k % 7 == 2, F.concat(names, F.array(F.lit("more")))).otherwise(names)
    return bundle.compatibility(load(spark, sf, "orders").select(k.alias("contract"), version.alias("version"), held.alias("names")))


@query
def legacy_redirects(spark, sf):
    return graph.redirects(graph.paths(registry.forest(spark, sf)), "/units/")


@query
def feature_downloads(spark, sf):
    k = F.col("c_custkey")
    return features.downloaded(load(spark, sf, "customer").select(F.when(k % 5 != 0, k).alias("object_id"), F.concat(F.lit("f"), k).alias("feature"), F.col("c_name").alias("line")))


_RUNS = "runs AS (SELECT o_orderkey AS run, o_orderkey % 50 AS snapshot, sha256((o_orderkey % 3)::VARCHAR) AS commit, CASE WHEN o_orderkey % 9 = 0 THEN 'failed' WHEN o_orderkey % 5 = 0 THEN 'approved' WHEN o_orderkey % 8 = 0 THEN 'completed' ELSE 'review' END AS status, sha256(o_orderkey::VARCHAR) AS sha256 FROM orders)"
_DECISIONS = "decisions AS (SELECT l_orderkey AS run, l_linenumber::VARCHAR AS code, CASE WHEN l_orderkey % 40 = 7 THEN 'needs_review' WHEN (l_orderkey + l_linenumber) % 2 = 0 THEN 'matched' ELSE 'create' END AS decision, CASE WHEN l_orderkey % 40 <> 7 AND (l_orderkey + l_linenumber) % 2 <> 0 THEN 'p' || l_partkey END AS proposed_id FROM lineitem WHERE l_orderkey % 45 <> 2 OR l_linenumber > 1)"
_APPROVALS = "approvals AS (SELECT o_orderkey AS run, CASE WHEN o_orderkey % 12 = 0 THEN sha256('other') ELSE sha256(o_orderkey::VARCHAR) END AS approved, o_custkey::VARCHAR AS approved_by, strftime(o_orderdate, '%Y-%m-%d') AS approved_at FROM orders WHERE o_orderkey % 5 < 2)"
_CONTEXT = f"{_RUNS}, {_APPROVALS}, context AS (SELECT run, snapshot, commit, status, sha256, approved_by, approved_at, s_suppkey AS source, s_name AS publisher, sha256(snapshot::VARCHAR) AS source_sha256, snapshot + 1 AS size, CASE WHEN status NOT IN ('approved', 'completed') THEN 'APPROVED_IMPORT_STATUS_INVALID' WHEN sha256 <> approved THEN 'APPROVED_CANDIDATE_DRIFT' END AS fault FROM runs JOIN approvals USING (run) JOIN supplier ON s_suppkey = snapshot % 4 WHERE s_suppkey < 3 AND snapshot % 10 <> 9)"

_FAULT = lambda fault, where: f"SELECT '{fault}' AS fault, count(*) AS n FROM {where} HAVING count(*) > 0"
_UNITS = """units AS (SELECT * FROM (SELECT CASE WHEN c_custkey % 79 = 11 THEN 't' || (c_custkey - 1) ELSE 't' || c_custkey END AS territory_id, CASE WHEN c_custkey % 59 = 5 THEN '12x' WHEN c_custkey % 61 = 6 THEN (c_custkey - 2)::VARCHAR ELSE c_custkey::VARCHAR END AS code, c_custkey AS position, CASE WHEN c_custkey % 83 = 12 THEN 's2' ELSE 's1' END AS snapshot,
  CASE WHEN c_custkey % 71 = 8 THEN 't' || (c_custkey + 1) WHEN c_custkey % 71 = 9 THEN 't' || (c_custkey - 1) WHEN c_custkey % 73 = 10 THEN 'gone' END AS parent_id, CASE WHEN c_custkey % 89 = 13 THEN 'gone' END AS county_id, 'N' || CASE WHEN c_custkey % 67 = 7 THEN c_custkey - c_custkey % 3 ELSE c_custkey END AS region FROM customer) WHERE code <> '12x' OR position % 2 = 1),
parents AS (SELECT territory_id AS id, any_value(parent_id) AS p FROM units WHERE parent_id IS NOT NULL GROUP BY territory_id)"""


def oracles(forest: str, slug: str) -> dict[str, str]:
    """The SQL of the queries. forest: a common table expression of that name; slug: the pattern of a slug."""
    meta = "m AS (SELECT o_orderkey AS k, strftime(o_orderdate, '%Y-%m-%d') AS d, strftime(o_orderdate, '%Y.%m.%d') || CASE WHEN o_orderkey % 7 = 0 THEN '' ELSE '.1' END AS release_id FROM orders)"
    rules = {"RELEASE_ID": "k % 7 = 0", "RELEASE_DATE": "k % 7 <> 0 AND k % 11 = 0", "PREVIOUS_RELEASE_ID": "k % 5 = 1", "COMMIT": "k % 3 = 0", "REPOSITORY": "k % 4 = 0", "APPROVED_BY": "k % 6 = 0", "APPROVED_AT": "k % 8 = 0", "RATIONALE": "k % 9 = 0", "SOURCE_URI": "k % 10 = 0", "SOURCE_SIZE": "k % 12 = 0"}
    k = "o_orderkey"
    diff_rules = {"DIFF_SKIPPED": f"{k} % 7 = 0", "DIFF_BLOCKED": f"{k} % 9 = 8", "DIFF_BASELINE": f"({k} % 5 = 0) = ({k} % 6 <> 0)", "DIFF_TOTALS": f"{k} % 10 = 0", "DIFF_REMOVALS": f"{k} % 8 = 0 AND {k} % 3 > 0"}
    return {
        "contract_rows": "SELECT name, name NOT LIKE 'territory-geometries%' AS required FROM (VALUES ('SHA256SUMS'), ('changelog.json'), ('contract.json'), ('contract.schema.json'), ('manifest.json'), ('release-manifest.schema.json'), ('territories.csv'), ('territories.json'), ('territories.ndjson'), ('territories.schema.json'), ('territory-identifiers.csv'), ('territory.schema.json'), ('validation-report.json'), ('territory-geometries.geojson'), ('territory-geometries.schema.json')) t(name)",
        "contract_verdicts": "SELECT o_orderkey AS contract, CASE WHEN o_orderkey % 5 = 0 THEN 'MAJOR_DIFFERS' WHEN o_orderkey % 5 = 1 THEN 'VERSION_INVALID' WHEN o_orderkey % 7 = 0 THEN 'ARTIFACT_MISSING' WHEN o_orderkey % 7 = 1 THEN 'ARTIFACTS_REPEATED' ELSE 'compatible' END AS verdict FROM orders",
        "legacy_redirects": f"WITH {forest} SELECT '/units/' || a.territory_id AS old, '/' || concat_ws('/', {slug.format('c.official_name')}, {slug.format('b.official_name')}, {slug.format('a.official_name')}) AS location FROM forest a LEFT JOIN forest b ON a.parent_id = b.territory_id LEFT JOIN forest c ON b.parent_id = c.territory_id",
        "feature_downloads": "SELECT CASE WHEN c_custkey % 5 <> 0 THEN c_custkey ELSE 0 END AS object_id, 'f' || c_custkey AS feature, sha256(c_name) AS sha256 FROM customer",
        "approve_gate": f"""WITH {_RUNS}, {_DECISIONS}, {_APPROVALS},
            asked AS (SELECT CASE WHEN o_orderkey % 11 = 0 THEN -o_orderkey ELSE o_orderkey END AS run, CASE WHEN o_orderkey % 7 = 0 THEN 'x' ELSE sha256(o_orderkey::VARCHAR) END AS sha256 FROM orders),
            b AS (SELECT l_orderkey AS run, count(*) AS n FROM lineitem WHERE l_orderkey % 30 IN (4, 5) GROUP BY 1), d AS (SELECT run, count(*) AS n, count(*) FILTER (decision <> 'needs_review') AS ok FROM decisions GROUP BY 1),
            s AS (SELECT l_orderkey AS run, count(*) AS n FROM lineitem WHERE l_orderkey % 47 <> 3 OR l_linenumber > 1 GROUP BY 1)
            SELECT a.run, CASE WHEN r.run IS NULL THEN 'IMPORT_RUN_NOT_FOUND' WHEN status NOT IN ('review', 'approved') THEN 'IMPORT_RUN_NOT_REVIEWABLE' WHEN r.sha256 <> a.sha256 THEN 'CANDIDATE_HASH_MISMATCH' WHEN b.n > 0 THEN 'CANDIDATE_HAS_BLOCKERS'
              WHEN coalesce(d.n, 0) = 0 OR d.n <> d.ok OR d.n <> coalesce(s.n, 0) THEN 'IDENTITY_REVIEW_INCOMPLETE' WHEN p.approved <> a.sha256 THEN 'APPROVAL_COLLISION' WHEN p.run IS NOT NULL THEN 'replayed' ELSE 'approved' END AS verdict
            FROM asked a LEFT JOIN runs r USING (run) LEFT JOIN b USING (run) LEFT JOIN d USING (run) LEFT JOIN s USING (run) LEFT JOIN approvals p USING (run)""",
        "approved_context": f"WITH {_CONTEXT} SELECT * FROM context",
        "promote_gate": f"""WITH {_CONTEXT} SELECT 'r' || run AS release_id, CASE WHEN run % 31 = 0 AND run % 2 = 0 THEN 'replayed' WHEN run % 31 = 0 THEN 'RELEASE_ID_COLLISION' WHEN run % 17 = 0 THEN 'APPROVED_IMPORT_NOT_FOUND' WHEN fault IS NOT NULL THEN 'APPROVED_IMPORT_INVALID'
            WHEN status <> 'approved' THEN 'IMPORT_ALREADY_RELEASED' WHEN run % 19 = 0 OR run % 37 = 0 OR run % 41 = 0 THEN 'RELEASE_CONTEXT_DRIFT' WHEN run % 23 = 0 OR run % 43 = 0 THEN 'RELEASE_APPROVAL_DRIFT' WHEN run % 29 = 0 THEN 'STABLE_CHANNEL_DRIFT' WHEN run % 13 = 0 THEN 'RELEASE_TIME_INVALID' ELSE 'promoted' END AS verdict FROM context""",
        "promote_faults": """SELECT c_custkey::VARCHAR AS code, 'PROMOTION_IDENTITY_MISMATCH' AS fault FROM customer WHERE c_custkey % 41 = 0 OR (c_custkey % 3 <> 0 AND c_custkey % 31 = 1)
            UNION ALL SELECT c_custkey::VARCHAR, 'PROMOTION_PROPOSED_ID_COLLISION' FROM customer WHERE c_custkey % 41 <> 0 AND c_custkey % 3 = 0 AND c_custkey % 37 = 0
            UNION ALL SELECT c_custkey::VARCHAR, 'PROMOTION_MATCHED_IDENTITY_MISSING' FROM customer WHERE c_custkey % 41 <> 0 AND c_custkey % 3 <> 0 AND (c_custkey % 31 = 1 OR c_custkey % 43 = 2 OR c_custkey % 47 = 4)
            UNION ALL SELECT NULL, 'PROMOTION_DECISIONS_INCOMPLETE' FROM (SELECT count(*) AS n FROM customer WHERE c_custkey % 41 = 0) WHERE n > 0""",
        "staged_proposals": f"WITH {_RUNS}, {_DECISIONS} SELECT DISTINCT code, proposed_id AS territory_id FROM decisions JOIN runs USING (run) WHERE decision = 'create' AND status <> 'failed'",
        "stable_release": f"WITH {_APPROVALS} SELECT o_custkey AS release_id, approved AS sha256 FROM orders JOIN customer ON c_custkey = o_custkey JOIN approvals ON run = o_orderkey WHERE c_custkey % 2 = 0 AND o_orderkey % 4 <> 0",
        "candidate_faults": f"WITH {_UNITS} "
        + " UNION ALL ".join([
            _FAULT("PARENT_ID_MISSING", "units WHERE parent_id NOT IN (SELECT territory_id FROM units)"),
            _FAULT("COUNTY_ID_MISSING", "units WHERE county_id IS NOT NULL"),
            _FAULT("CODE_INVALID", "units WHERE code = '12x'"),
            _FAULT("ID_REPEATED", "(SELECT territory_id FROM units GROUP BY 1 HAVING count(*) > 1)"),
            _FAULT("CODE_REPEATED", "(SELECT code FROM units GROUP BY 1 HAVING count(*) > 1)"),
            _FAULT("IDENTIFIER_REPEATED", "(SELECT code FROM units GROUP BY 1 HAVING count(*) > 1 UNION ALL SELECT region FROM units GROUP BY 1 HAVING count(*) > 1)"),
            _FAULT("SNAPSHOT_DIFFERS", "units WHERE snapshot <> 's1'"),
            _FAULT("ORDER", "(SELECT code, lag(code) OVER (ORDER BY position) AS before FROM units) WHERE try_cast(code AS BIGINT) <= try_cast(before AS BIGINT)"),
            _FAULT("HIERARCHY_CYCLE", "parents a JOIN parents b ON a.p = b.id AND b.p = a.id WHERE a.id < b.id"),
        ]),
        "changelog_faults": " UNION ALL ".join(f"SELECT {k} AS release_id, '{n}' AS fault FROM orders WHERE {c}" for n, c in diff_rules.items()),
        "metadata_faults": f"WITH {meta} SELECT release_id, fault, count(*) AS n FROM (" + " UNION ALL ".join(f"SELECT release_id, '{n}' AS fault FROM m WHERE {c}" for n, c in rules.items()) + ") GROUP BY ALL",
        "revision_rows": f"""WITH {forest} SELECT territory_id, code, official_name, 'r1' AS release_id, CASE WHEN level = 1 THEN '{{"releaseId":"r1","sourceCorrections":"old-' || code || '"}}' ELSE '{{"releaseId":"r1"}}' END AS metadata FROM forest""",
        "issued_identifiers": f"WITH {forest} SELECT territory_id, 'ro.ins.siruta' AS scheme, code AS value, status, 'ro.ins' AS issuer, 'statistical_territory_code' AS identifier_type, 'r1' AS release_id FROM forest UNION ALL SELECT territory_id, 'eu.eurostat.nuts', nuts, status, 'eu.eurostat', 'nuts_code', 'r1' FROM forest WHERE nuts IS NOT NULL",
        "matchable_units": f"WITH {forest} SELECT territory_id, official_name, territory_type, county_id, CASE WHEN code::BIGINT % 4 <> 2 THEN code END AS code FROM forest WHERE level < 3 AND code::BIGINT % 5 <> 3",
        "county_map_inputs": f"""WITH {forest}, s AS (SELECT '3-' || lpad(c_custkey::VARCHAR, 10, '0') AS territory_id, c_custkey % 100 + 2 AS x, c_custkey // 100 AS y FROM customer WHERE c_custkey % 6 <> 0)
            SELECT county_id, count(*) AS units, count(x) AS drawn, min(x)::DOUBLE AS min_x, min(y)::DOUBLE AS min_y, max(x)::DOUBLE + 1 AS max_x, max(y)::DOUBLE + 1 AS max_y, count(*) - count(x) AS missing FROM forest LEFT JOIN s USING (territory_id) WHERE level = 3 AND county_id IS NOT NULL GROUP BY county_id""",
        "geometry_rows": """SELECT '3-' || lpad(c_custkey::VARCHAR, 10, '0') AS territory_id, 'f' || c_custkey AS feature, '{"id":' || c_custkey || '}' AS geometry, 'source' AS geometry_kind, 'original' AS detail_level, 's1' AS snapshot, sha256('{"id":' || c_custkey || '}') AS geometry_sha256 FROM customer""",
        "county_union": """WITH c AS (SELECT c_nationkey, c_custkey % 100 AS x, c_custkey // 100 AS y FROM customer), m AS (SELECT a.c_nationkey, count(*) AS met FROM c a JOIN c b ON a.c_nationkey = b.c_nationkey AND ((b.x = a.x + 1 AND b.y = a.y) OR (b.x = a.x AND b.y = a.y + 1)) GROUP BY 1)
            SELECT c_nationkey, 4 * count(*) - 2 * coalesce(any_value(met), 0) AS edges, (4 * count(*) - 2 * coalesce(any_value(met), 0))::DOUBLE AS perimeter, count(*)::DOUBLE AS area FROM c LEFT JOIN m USING (c_nationkey) GROUP BY c_nationkey""",
        "registry_report": "SELECT false AS ok, 1 AS missing_tables, count(*) AS runs, count(*) FILTER (o_orderkey % 4 <> 0) AS published_releases, count(*) AS releases FROM orders",
    }
