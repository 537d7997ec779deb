"""Governed releases: staging, approval and promotion as queries over tables.

A gate returns verdicts or faults; the append that it guards follows only where
there is none. Every check is a partial aggregate or an equi-join.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import numbers
from ..sources.registry import CODE_SCHEME
from ..sources.tables import cut
from . import graph, paging, release

# Severities that block, states of runs, forms of codes and repositories, the types that polygons are matched to.
BLOCKING = ("error", "blocker")
REVIEWABLE, RELEASABLE, STAGED = ("review", "approved"), ("approved", "completed"), ("review", "approved", "completed")
CODE, REPOSITORY, SOURCE_URI = r"^\d{1,6}$", r"^[A-Za-z0-9_.-]+/[A-Za-z0-9_.-]+$", r"^https://data\.gov\.ro([:/?#].*)?$"
ELIGIBLE_TYPES = ("county", "bucharest", "municipality", "city", "commune", "sector")


def _first(*gates: tuple[Column, str]) -> Column:
    """The name of the first gate that does not hold; null if all hold. Null conditions do not hold."""
    out = F
    for fails, name in gates:
        out = out.when(F.coalesce(fails, F.lit(True)), F.lit(name))
    return out


def _some(*rules: tuple[Column, str]) -> Column:
    """The names of all rules that are broken. Null conditions are broken rules."""
    return F.array_compact(F.array(*(F.when(F.coalesce(broken, F.lit(True)), F.lit(name)) for broken, name in rules)))


def approval_verdicts(asked: DataFrame, runs: DataFrame, findings: DataFrame, decisions: DataFrame, staged: DataFrame, approvals: DataFrame) -> DataFrame:
    """Rows (run, verdict) of all asked approvals: approved, replayed, or the first gate that failed.

    asked: (run, sha256); runs: (run, status, sha256), one a run; findings: (run, severity); decisions: (run, decision);
    staged: (run, parsed); approvals: (run, sha256), those there are already, one a run.
    """
    n = F.coalesce
    blocking = findings.where(F.col("severity").isin(*BLOCKING)).groupBy("run").agg(F.count("*").alias("blocking"))
    decided = decisions.groupBy("run").agg(F.count("*").alias("decided"), F.count_if(F.col("decision").isin("matched", "create")).alias("resolved"))
    parsed = staged.where("parsed").groupBy("run").agg(F.count("*").alias("parsed"))
    j = asked.join(runs.select("run", "status", F.col("sha256").alias("_staged"), F.lit(True).alias("_known")), "run", "left")
    for part in (blocking, decided, parsed, approvals.select("run", F.col("sha256").alias("_approved"))):
        j = j.join(part, "run", "left")
    zero = F.lit(0)
    decided_, resolved, parsed_ = (n(F.col(c), zero) for c in ("decided", "resolved", "parsed"))
    again = F.col("_approved").isNotNull()
    fault = _first(
        (F.col("_known").isNull(), "IMPORT_RUN_NOT_FOUND"),
        (~F.col("status").isin(*REVIEWABLE), "IMPORT_RUN_NOT_REVIEWABLE"),
        (F.col("_staged") != F.col("sha256"), "CANDIDATE_HASH_MISMATCH"),
        (n(F.col("blocking"), zero) > 0, "CANDIDATE_HAS_BLOCKERS"),
        ((decided_ == 0) | (decided_ != resolved) | (decided_ != parsed_), "IDENTITY_REVIEW_INCOMPLETE"),
        (again & (F.col("_approved") != F.col("sha256")), "APPROVAL_COLLISION"),
    )
    return j.select("run", F.coalesce(fault, F.when(again, "replayed"), F.lit("approved")).alias("verdict"))


def approved_context(runs: DataFrame, approvals: DataFrame, snapshots: DataFrame, sources: DataFrame) -> DataFrame:
    """What a release of an approved run rests on: runs with their approval, snapshot and source, and the fault that keeps them back, or null.

    runs: (run, snapshot, commit, status, sha256); approvals: (run, sha256, approved_by, approved_at, rationale);
    snapshots: (snapshot, source, source_sha256, size); sources: (source, publisher).
    """
    j = runs.join(approvals.withColumnRenamed("sha256", "_approved"), "run").join(snapshots, "snapshot").join(sources, "source")
    fault = _first((~F.col("status").isin(*RELEASABLE), "APPROVED_IMPORT_STATUS_INVALID"), (F.col("sha256") != F.col("_approved"), "APPROVED_CANDIDATE_DRIFT"))
    return j.select("run", "snapshot", "commit", "status", "sha256", "approved_by", "approved_at", "rationale", "source", "publisher", "source_sha256", "size", fault.alias("fault"))


def promotion_verdicts(manifests: DataFrame, contexts: DataFrame, releases: DataFrame, stable: DataFrame) -> DataFrame:
    """Rows (release_id, verdict) of all manifests: promoted, replayed, or the first gate that failed.

    manifests: (release_id, manifest_sha256, run, sha256, commit, snapshot, source_sha256, approved_by, approved_at, rationale,
    previous_release_id, published_at), the snapshot and its hash as the candidate names them;
    contexts: of approved_context(); releases: (release_id, status, manifest_sha256, published_at), one a release;
    stable: (release), the release that the stable channel points to, one row or none.
    """
    c = contexts.select("run", *(F.col(x).alias(f"_{x}") for x in ("status", "sha256", "commit", "snapshot", "source_sha256", "approved_by", "approved_at", "rationale", "fault")), F.lit(True).alias("_known"))
    own = releases.select("release_id", F.col("status").alias("_state"), F.col("manifest_sha256").alias("_manifest"))
    now = stable.select(F.col("release").alias("_stable")).limit(1).join(releases.where("status = 'published'").select(F.col("release_id").alias("_stable"), F.col("published_at").alias("_since")), "_stable", "left")
    j = manifests.join(own, "release_id", "left").join(c, "run", "left").join(F.broadcast(now), F.lit(True), "left")  # one row at most
    differ = lambda *names: ~reduce(and_, (F.col(f"_{x}").eqNullSafe(F.col(x)) for x in names))
    there = F.col("_state").isNotNull()
    same = there & (F.col("_state") == "published") & (F.col("_manifest") == F.col("manifest_sha256"))
    fault = _first(
        (there, "RELEASE_ID_COLLISION"),
        (F.col("_known").isNull(), "APPROVED_IMPORT_NOT_FOUND"),
        (F.col("_fault").isNotNull(), "APPROVED_IMPORT_INVALID"),
        (F.col("_status") != "approved", "IMPORT_ALREADY_RELEASED"),
        (differ("sha256", "commit", "snapshot", "source_sha256"), "RELEASE_CONTEXT_DRIFT"),
        (differ("approved_by", "approved_at", "rationale"), "RELEASE_APPROVAL_DRIFT"),
        (~F.col("_stable").eqNullSafe(F.col("previous_release_id")), "STABLE_CHANNEL_DRIFT"),
        (F.col("_stable").isNotNull() & (F.col("_since").isNull() | (F.col("_since") >= F.col("published_at"))), "RELEASE_TIME_INVALID"),
    )
    return j.select("release_id", F.when(same, "replayed").otherwise(F.coalesce(fault, F.lit("promoted"))).alias("verdict"))


def promotion_faults(units: DataFrame, decisions: DataFrame, territories: DataFrame, identifiers: DataFrame) -> DataFrame:
    """Rows (code, fault): why the units of a candidate may not be promoted by these decisions; empty if they may.

    units: (code, territory_id); decisions: (code, decision, candidate_id, proposed_id), one a code; territories: (territory_id), those
    there are already; identifiers: (scheme, value, status, valid_to, territory_id).
    """
    target = F.when(F.col("decision") == "matched", F.col("candidate_id")).when(F.col("decision") == "create", F.col("proposed_id"))
    differs = units.join(decisions.select("code", target.alias("_target")), "code", "left").where(F.col("_target").isNull() | (F.col("_target") != F.col("territory_id")))
    proposed = decisions.where("decision = 'create'").select("code", F.col("proposed_id").alias("territory_id"))
    active = identifiers.where((F.col("scheme") == CODE_SCHEME) & (F.col("status") == "active") & F.col("valid_to").isNull()).select(F.col("value").alias("code"), F.col("territory_id").alias("candidate_id"))
    missing = decisions.where("decision = 'matched'").join(active, ["code", "candidate_id"], "left_anti")
    sizes = units.agg(F.count("*").alias("_units")).crossJoin(decisions.agg(F.count("*").alias("_decisions")))  # one row each
    named = lambda df, code, fault: df.select(code.alias("code"), F.lit(fault).alias("fault"))
    own = F.col("code")
    return (
        named(differs, own, "PROMOTION_IDENTITY_MISMATCH")
        .union(named(proposed.join(territories, "territory_id", "left_semi"), own, "PROMOTION_PROPOSED_ID_COLLISION"))
        .union(named(missing, own, "PROMOTION_MATCHED_IDENTITY_MISSING"))
        .union(named(sizes.where("_units != _decisions"), F.lit(None).cast("string"), "PROMOTION_DECISIONS_INCOMPLETE"))
    )


def proposals(decisions: DataFrame, runs: DataFrame) -> DataFrame:
    """Rows (code, territory_id): ids proposed in runs that are staged or beyond, each once."""
    made = decisions.where("decision = 'create' AND proposed_id IS NOT NULL").join(runs.where(F.col("status").isin(*STAGED)), "run", "left_semi")
    return made.select("code", F.col("proposed_id").alias("territory_id")).distinct()


def stable_release(channels: DataFrame, releases: DataFrame, approvals: DataFrame) -> DataFrame:
    """Rows (release_id, sha256): what the stable channel serves and the candidate that was approved for it. releases: (release_id, run, status)."""
    served = channels.where("channel = 'stable'").select(F.col("release").alias("release_id"))
    return served.join(releases.where("status = 'published'"), "release_id").join(approvals.select("run", "sha256"), "run").select("release_id", "sha256")


def out_of_order(units: DataFrame) -> DataFrame:
    """Rows (territory_id, code) whose code as a number is not above that of the unit before in the order of positions, which may have gaps. units: (territory_id, code, position).

    Codes that are no numbers are left to the check of their form.
    Units are numbered over range partitions and compared by an equi-join, so no task holds all of them.
    """
    units = cut(paging.numbered(units.select("territory_id", "code", "position"), "position", "territory_id", name="_at"))
    before = units.select((F.col("_at") + 1).alias("_at"), F.col("code").try_cast("long").alias("_before"))
    return units.join(before, "_at").where(F.col("code").try_cast("long") <= F.col("_before")).select("territory_id", "code")


def candidate_faults(units: DataFrame, snapshot: str) -> DataFrame:
    """Rows (territory_id, fault): why a candidate's units are no release; empty if they are one.

    units: (territory_id, code, position, snapshot, identifiers, parent_id, county_id).
    """
    named = lambda df, fault: df.select("territory_id", F.lit(fault).alias("fault"))
    invalid = units.where(~F.coalesce(F.col("code").rlike(CODE), F.lit(False)))
    repeated = units.groupBy("territory_id").agg(F.count("*").alias("n")).where("n > 1")
    # one identifier may pass from unit to unit in time
    since = ["valid_from"] if "valid_from" in units.schema["identifiers"].dataType.elementType.names else []
    owners = units.select("territory_id", F.inline("identifiers")).groupBy("scheme", "value", *since).agg(F.count("*").alias("n"), F.min("territory_id").alias("territory_id")).where("n > 1")
    # of a repeated unit the first parent in the order of positions counts, whatever order the rows are read in
    first = F.min_by("parent_id", F.struct("position", "parent_id"))
    parents = units.where("parent_id IS NOT NULL").groupBy(F.col("territory_id").alias("id")).agg(first.alias("parent"))
    rings = graph.cycles(parents).where("id = cycle").select(F.col("id").alias("territory_id"))
    return (
        release.reference_faults(units)
        .union(named(invalid, "CODE_INVALID"))
        .union(named(repeated, "ID_REPEATED"))
        .union(named(owners, "IDENTIFIER_REPEATED"))
        .union(named(units.where(~F.col("snapshot").eqNullSafe(F.lit(snapshot))), "SNAPSHOT_DIFFERS"))
        .union(named(out_of_order(units), "ORDER"))
        .union(named(rings, "HIERARCHY_CYCLE"))
    )


def diff_faults(changelogs: DataFrame) -> DataFrame:
    """Rows (release_id, fault) of changelogs that cannot be released.

    changelogs: (release_id, previous_release_id, baseline, skipped, added, removed, changed, unchanged, blocking, territories).
    """
    first = F.col("previous_release_id").isNull()
    faults = _some(
        (F.col("skipped"), "DIFF_SKIPPED"),
        (F.col("blocking") > 0, "DIFF_BLOCKED"),
        (first == F.col("baseline"), "DIFF_BASELINE"),
        (F.col("added") + F.col("changed") + F.col("unchanged") != F.col("territories"), "DIFF_TOTALS"),
        (F.col("removed") > 0, "DIFF_REMOVALS"),
    )
    return changelogs.select("release_id", F.explode(faults).alias("fault"))


def metadata_faults(metadata: DataFrame) -> DataFrame:
    """Rows (release_id, fault) of release metadata of a wrong form; nulls are of a wrong form, but for previous_release_id.

    metadata: (release_id, previous_release_id, published_at, commit, repository, approved_by, approved_at, rationale, sha256, uri, size), times as text.
    """
    date = numbers.release_date(F.col("release_id"))
    previous = F.col("previous_release_id")
    faults = _some(
        (date.isNull(), "RELEASE_ID"),
        (~numbers.utc_milliseconds(F.col("published_at")), "PUBLISHED_AT"),
        (date.isNotNull() & (F.substring("published_at", 1, 10) != date.cast("string")), "RELEASE_DATE"),
        (previous.isNotNull() & numbers.release_date(previous).isNull(), "PREVIOUS_RELEASE_ID"),
        (~F.col("commit").rlike(numbers.COMMIT), "COMMIT"),
        (~F.col("repository").rlike(REPOSITORY), "REPOSITORY"),
        (F.trim("approved_by") == "", "APPROVED_BY"),
        (~numbers.utc_milliseconds(F.col("approved_at")), "APPROVED_AT"),
        (F.length(F.trim("rationale")) < 10, "RATIONALE"),
        (~F.col("sha256").rlike(numbers.SHA256), "CANDIDATE_SHA256"),
        (~F.col("uri").rlike(SOURCE_URI), "SOURCE_URI"),
        (F.col("size") <= 0, "SOURCE_SIZE"),
    )
    return metadata.select("release_id", F.explode(faults).alias("fault"))


def revision_rows(units: DataFrame, release_id: str) -> DataFrame:
    """The rows that a promotion opens: the unit's columns, the release, and metadata as JSON with the correction of its source where there was one."""
    note = F.when(F.col("corrected_from").isNotNull(), F.to_json(F.struct(F.lit(release_id).alias("releaseId"), F.col("corrected_from").alias("sourceCorrections")))).otherwise(F.to_json(F.struct(F.lit(release_id).alias("releaseId"))))
    return units.drop("identifiers", "corrected_from").withColumn("release_id", F.lit(release_id)).join(units.select("code", note.alias("metadata")), "code")


def issued_identifiers(units: DataFrame, release_id: str) -> DataFrame:
    """The identifiers that a promotion adds, with issuer and type by their scheme."""
    own = F.col("scheme") == CODE_SCHEME
    rows = release.identifier_rows(units)
    return rows.withColumns({"issuer": F.when(own, "ro.ins").otherwise("eu.eurostat"), "identifier_type": F.when(own, "statistical_territory_code").otherwise("nuts_code"), "release_id": F.lit(release_id)})


def matchable(revisions: DataFrame, identifiers: DataFrame) -> DataFrame:
    """Current revisions of the types that polygons are matched to, each with its active code or null."""
    code = identifiers.where((F.col("scheme") == CODE_SCHEME) & (F.col("status") == "active")).select("territory_id", F.col("value").alias("code"))
    return revisions.where(F.col("recorded_to").isNull() & F.col("territory_type").isin(*ELIGIBLE_TYPES)).join(code, "territory_id", "left")


def geometry_rows(matched: DataFrame, snapshot: str) -> DataFrame:
    """Rows to append for matched polygons (territory_id, feature, geometry as JSON text): with the snapshot and the geometry's hash."""
    return matched.select("territory_id", "feature", "geometry", F.lit("source").alias("geometry_kind"), F.lit("original").alias("detail_level"), F.lit(snapshot).alias("snapshot"), F.sha2("geometry", 256).alias("geometry_sha256"))


def decorated(units: DataFrame, shapes: DataFrame) -> DataFrame:
    """Units with the polygons of their latest shape, or null. shapes: (territory_id, polygons, at), any number a unit."""
    last = shapes.groupBy("territory_id").agg(F.max_by("polygons", "at").alias("polygons"))
    return units.join(last, "territory_id", "left")


def map_inputs(units: DataFrame, box_of) -> DataFrame:
    """Rows (county_id, units, drawn, missing, box) of decorated units: what a county's map shows. box_of: polygons to (min_x, min_y, max_x, max_y)."""
    b = units.where("county_id IS NOT NULL").withColumn("_b", box_of(F.col("polygons")))
    out = b.groupBy("county_id").agg(F.count("*").alias("units"), F.count("polygons").alias("drawn"), F.min("_b.min_x").alias("min_x"), F.min("_b.min_y").alias("min_y"), F.max("_b.max_x").alias("max_x"), F.max("_b.max_y").alias("max_y"))
    return out.withColumn("missing", F.col("units") - F.col("drawn"))


def registry_report(names: DataFrame, present: DataFrame, runs: DataFrame, releases: DataFrame) -> DataFrame:
    """One row: whether all named tables are present, and counts of runs and published releases. names, present: (name)."""
    have = names.join(present.select("name", F.lit(True).alias("_there")).distinct(), "name", "left").agg((F.count_if(F.col("_there").isNull()) == 0).alias("ok"), F.count_if(F.col("_there").isNull()).alias("missing_tables"))
    published = releases.agg(F.count_if(F.col("status") == "published").alias("published_releases"), F.count("*").alias("releases"))
    return have.crossJoin(runs.agg(F.count("*").alias("runs"))).crossJoin(published)  # one row each


def append_once(rows: DataFrame, folder: str, key: str, least: int = 0) -> bool:
    """Appends rows to the table of a folder as the part of a key; False if that part was written before, and nothing is written then.

    A part that a lost job left unfinished is written anew. Fails, and writes nothing, if there are fewer rows than `least`.
    """
    spark: SparkSession = rows.sparkSession
    hadoop = spark._jvm.org.apache.hadoop.fs
    part = f"{folder.rstrip('/')}/run={key}"
    done = hadoop.Path(f"{part}/_SUCCESS")
    if done.getFileSystem(spark._jsc.hadoopConfiguration()).exists(done):
        return False
    if least and rows.limit(least).count() < least:
        raise ValueError(f"fewer than {least} rows")
    rows.write.mode("overwrite").parquet(part)
    return True
