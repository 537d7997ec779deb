"""Release bundles: deterministic lines, artifacts with hashes, writing once, verifying."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as X
from ..functions.hashing import canonical_json
from ..sources.snapshots import read_files

# The columns of the units' table.
HEADERS = ("territory_id", "official_name", "normalized_name", "short_name", "territory_type", "administrative_role", "administrative_level", "parent_territory_id", "county_territory_id", "is_uat", "is_locality", "is_county_seat", "rank", "status", "valid_from", "valid_to", "siruta", "nuts", "source_snapshot_id", "source_record_hash", "transformation_version")
IDENTIFIER_HEADERS = ("territory_id", "scheme", "value", "status", "valid_from", "valid_to")


def csv_lines(df: DataFrame, columns: tuple[str, ...], key: str) -> DataFrame:
    """Rows (key, line): every cell quoted, nulls empty."""
    return df.select(F.col(key), X.csv_line(*(F.col(c) if c in df.columns else F.lit(None) for c in columns)).alias("line"))


def json_lines(df: DataFrame, columns: tuple[str, ...], key: str) -> DataFrame:
    return df.select(F.col(key), canonical_json({c: F.col(c) for c in columns}, df.schema).alias("line"))


def identifier_rows(units: DataFrame) -> DataFrame:
    """Rows (territory_id, scheme, value, status), sorted within a unit by scheme and value."""
    ordered = F.array_sort(F.transform("identifiers", lambda x: F.struct(x["scheme"].alias("scheme"), x["value"].alias("value"), x["status"].alias("status"))))
    return units.select("territory_id", F.inline(ordered))


def first_of_scheme(scheme: str):
    """The first identifier of a scheme."""
    return F.get(F.filter("identifiers", lambda x: x["scheme"] == scheme), 0)["value"]


def counts(units: DataFrame) -> DataFrame:
    role = lambda r: F.count_if(F.col("administrative_role") == r)
    return units.agg(F.count("*").alias("territories"), role("county_uat").alias("counties"), role("local_uat").alias("local_uats"), role("locality").alias("localities"), role("administrative_subdivision").alias("subdivisions"))


def write_lines(lines: DataFrame, folder: str, key: str, header: str | None = None) -> None:
    """Lines in the order of the key, over as many files as Spark takes; the header is a file of its own that sorts first. Fails if the folder exists."""
    lines.repartitionByRange(key).sortWithinPartitions(key).select("line").write.mode("errorifexists").text(folder)
    if header is not None:
        lines.sparkSession.createDataFrame([(header,)], "line string").coalesce(1).write.text(f"{folder}/header")


def artifacts(spark: SparkSession, folder: str) -> DataFrame:
    """Rows (name, size, sha256) of the files below a folder; name: the path below it."""
    root = F.lit(folder.rstrip("/") + "/")
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    bare = lambda c: F.regexp_replace(c, r"^[a-z]+:/+", "/")
    return files.select(F.replace(bare(F.col("path")), bare(root), F.lit("")).alias("name"), F.col("length").alias("size"), F.sha2("content", 256).alias("sha256")).where(~F.col("name").rlike(r"(^|/)[._]"))


def sums(parts: DataFrame) -> DataFrame:
    return parts.select("name", F.concat_ws("  ", "sha256", "name").alias("line"))


def parse_sums(lines: DataFrame) -> DataFrame:
    """Rows (name, sha256) of lines `<sha256>  <name>`; lines of another form give a null name."""
    form = r"^([0-9a-f]{64})  (.+)$"
    return lines.select(F.nullif(F.regexp_extract("line", form, 2), F.lit("")).alias("name"), F.nullif(F.regexp_extract("line", form, 1), F.lit("")).alias("sha256"))


def verify(manifest: DataFrame, found: DataFrame) -> DataFrame:
    """Rows (name, fault) of files that are missing, unexpected, repeated, or differ; empty if the bundle is whole. Both: (name, size, sha256)."""
    m = manifest.groupBy("name").agg(F.count("*").alias("times"), F.min("size").alias("_size"), F.min("sha256").alias("_sha"))
    j = m.join(found.select("name", "size", "sha256", F.lit(True).alias("_there")), "name", "full_outer")
    fault = F.when(F.col("times").isNull(), "UNEXPECTED").when(F.col("times") > 1, "REPEATED").when(F.col("_there").isNull(), "MISSING").when(F.col("size") != F.col("_size"), "SIZE").when(F.col("sha256") != F.col("_sha"), "HASH")
    return j.select("name", fault.alias("fault")).where("fault IS NOT NULL")


def reference_faults(units: DataFrame) -> DataFrame:
    """Rows (territory_id, fault): parents and counties that are not units of the release, and codes that repeat."""
    ids = units.select(F.col("territory_id").alias("_id"))
    out = []
    for column in ("parent_id", "county_id"):
        out.append(units.where(F.col(column).isNotNull()).join(ids, F.col(column) == F.col("_id"), "left_anti").select("territory_id", F.lit(f"{column.upper()}_MISSING").alias("fault")))
    repeated = units.groupBy("code").agg(F.count("*").alias("n"), F.min("territory_id").alias("territory_id")).where("n > 1")
    return out[0].union(out[1]).union(repeated.select("territory_id", F.lit("CODE_REPEATED").alias("fault")))


def same_as_before(spark: SparkSession, path: str, sha256: str) -> bool:
    """Whether a file that was written once holds the same bytes."""
    return read_files(spark, path).where(F.col("sha256") == sha256).count() == 1


def import_report(units: DataFrame, release_id: str, manifest_sha256: str, current: tuple[str, str] | None = None, pinned: tuple[str | None, str | None] = (None, None)) -> DataFrame:
    """One row: whether a consumer takes a release, and to which one it could go back.

    Rejected if ids or codes repeat, a parent or county is not in it, or the release or manifest is not the pinned one.
    current and pinned: (release id, manifest hash).
    """
    ids = units.groupBy("territory_id").agg(F.count("*").alias("n")).where("n > 1").agg(F.count("*").alias("repeated_ids"))
    faults = reference_faults(units).agg(F.count_if(F.col("fault") == "CODE_REPEATED").alias("repeated_codes"), F.count_if(F.col("fault") != "CODE_REPEATED").alias("unresolved"))
    total = units.agg(F.count("*").alias("n"))
    j = total.crossJoin(ids).crossJoin(faults)  # one row each
    conflicts = F.col("repeated_ids") + F.col("repeated_codes") + F.col("unresolved")
    fits = all(want is None or want == have for want, have in zip(pinned, (release_id, manifest_sha256)))
    taken = (conflicts == 0) & F.lit(fits)
    back = F.lit(current[0] if current else None).cast("string")
    return j.select(
        F.when(taken, "accepted").otherwise("rejected").alias("status"), F.when(taken, F.col("n")).otherwise(0).cast("long").alias("accepted"), F.when(taken, 0).otherwise(F.col("n")).cast("long").alias("rejected"),
        conflicts.cast("long").alias("conflicts"), F.lit(release_id).alias("release_id"), F.lit(manifest_sha256).alias("manifest_sha256"), F.when(taken, back).alias("rollback_release_id"),
    )


def reconcile(observed: DataFrame, expected: DataFrame) -> DataFrame:
    """Rows (name, expected, observed) whose counts differ or that only one side has. Both: (name, n)."""
    o, e = observed.select("name", F.col("n").alias("observed")), expected.select("name", F.col("n").alias("expected"))
    return e.join(o, "name", "full_outer").where(~F.col("expected").eqNullSafe(F.col("observed"))).select("name", "expected", "observed")
