"""Release bundles: directories of sorted lines, with a table of what each holds, written once and verified when read.

The folder of a bundle holds one directory an artifact, then `manifest.json` and
last `SHA256SUMS`: a bundle without sums is unfinished and is refused.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import governance, merkle, release

# Artifacts of a release, with what they are for, their media type and the artifact that holds their schema.
ARTIFACTS = (
    ("SHA256SUMS", "checksums", "text/plain; charset=utf-8", None),
    ("changelog.json", "release-diff", "application/json", None),
    ("contract.json", "contract", "application/json", "contract.schema.json"),
    ("contract.schema.json", "contract-schema", "application/schema+json", None),
    ("manifest.json", "release-manifest", "application/json", "release-manifest.schema.json"),
    ("release-manifest.schema.json", "release-manifest-schema", "application/schema+json", None),
    ("territories.csv", "tabular-territories", "text/csv; charset=utf-8", None),
    ("territories.json", "territory-payload", "application/json", "territories.schema.json"),
    ("territories.ndjson", "streaming-territories", "application/x-ndjson", "territory.schema.json"),
    ("territories.schema.json", "territory-payload-schema", "application/schema+json", None),
    ("territory-identifiers.csv", "identifier-mapping", "text/csv; charset=utf-8", None),
    ("territory.schema.json", "territory-schema", "application/schema+json", None),
    ("validation-report.json", "validation-report", "application/json", None),
)
SHAPES = (("territory-geometries.geojson", "territory-geometries", "application/geo+json", "territory-geometries.schema.json"), ("territory-geometries.schema.json", "territory-geometries-schema", "application/schema+json", None))
MAJOR = 1


def listed(names: DataFrame) -> DataFrame:
    """Artifacts by name, in the order of the Unicode collation."""
    return names.orderBy(F.collate("name", "UNICODE"))


def contract(spark: SparkSession, shapes: bool = False) -> DataFrame:
    """Rows (name, purpose, media_type, schema, required): what a release of this contract holds."""
    rows = [(*a, True) for a in ARTIFACTS] + [(*a, False) for a in SHAPES if shapes]
    return spark.createDataFrame(rows, "name string, purpose string, media_type string, schema string, required boolean")


def compatibility(offered: DataFrame, shapes: bool = False) -> DataFrame:
    """Rows (contract, verdict) of offered contracts (contract, version, names: array): compatible, or why a consumer of MAJOR refuses them."""
    need = F.array(*(F.lit(a[0]) for a in (*ARTIFACTS, *(SHAPES if shapes else ()))))
    major = F.regexp_extract("version", r"^(\d+)\.\d+\.\d+$", 1).try_cast("int")
    repeated = F.size(F.array_distinct("names")) < F.size("names")
    verdict = F.when(major.isNull(), "VERSION_INVALID").when(major != MAJOR, "MAJOR_DIFFERS").when(F.col("names").isNull() | repeated, "ARTIFACTS_REPEATED").when(F.size(F.array_except(need, "names")) > 0, "ARTIFACT_MISSING").otherwise("compatible")
    return offered.select("contract", verdict.alias("verdict"))


def digest(lines: DataFrame, name: str) -> DataFrame:
    """One row (name, lines, digest): the root of the lines' hash tree, the same however they are dealt over files."""
    return merkle.root(lines).select(F.lit(name).alias("name"), "lines", F.col("sha256").alias("digest"))


def build(units: DataFrame, changelog: DataFrame, findings: DataFrame, folder: str, release_id: str, snapshot: str) -> DataFrame:
    """Writes the bundle of a release to a new folder; rows (name, lines, digest), its manifest. Nothing is written if anything keeps the release back.

    units: as candidate_faults() takes them, with the columns to release; changelog: one row of a release's changes;
    findings: (rule, severity). Artifacts that are one document elsewhere are lines here, as no task may hold a whole release.
    """
    if not findings.where(F.col("severity").isin(*governance.BLOCKING)).isEmpty():
        raise ValueError("findings block the release")
    faults = [r.fault for r in governance.candidate_faults(units, snapshot).select("fault").distinct().collect()]  # as few as there are checks
    if faults or units.isEmpty():
        raise ValueError(f"not a release: {sorted(faults) or 'no units'}")
    columns = tuple(c for c in units.columns if c not in ("identifiers", "position"))
    keyed = units.withColumn("_key", F.col("code").cast("long"))
    owned = release.identifier_rows(units).withColumn("_key", F.concat_ws("|", "territory_id", "scheme", "value"))
    names = ("territory_id", "scheme", "value", "status")
    parts = {
        "territories.ndjson": (release.json_lines(keyed, (*columns, "identifiers"), "_key"), None),
        "territories.csv": (release.csv_lines(keyed, columns, "_key"), ",".join(f'"{c}"' for c in columns)),
        "territory-identifiers.csv": (release.csv_lines(owned, names, "_key"), ",".join(f'"{c}"' for c in names)),
        "changelog.json": (release.json_lines(changelog, tuple(changelog.columns), changelog.columns[0]), None),
        "contract.json": (release.json_lines(contract(units.sparkSession), ("name", "purpose", "media_type", "schema", "required"), "name"), None),
        "validation-report.json": (release.json_lines(findings, ("rule", "severity"), "rule"), None),
    }
    for name, (lines, header) in parts.items():
        release.write_lines(lines, f"{folder}/{name}", lines.columns[0], header)
    manifest = reduce(DataFrame.unionByName, (digest(lines, name) for name, (lines, _) in parts.items())).withColumn("release_id", F.lit(release_id))
    release.write_lines(release.json_lines(manifest, ("name", "lines", "digest", "release_id"), "name"), f"{folder}/manifest.json", "name")
    sums = release.artifacts(units.sparkSession, folder)
    release.write_lines(release.sums(sums), f"{folder}/SHA256SUMS", "name")
    return units.sparkSession.read.schema(manifest.schema).json(f"{folder}/manifest.json")


def verified(spark: SparkSession, folder: str, release_id: str | None = None) -> DataFrame:
    """The units' lines of a bundle whose files and lines are those of its sums and manifest; fails for any other, or if it is another release."""
    found = release.artifacts(spark, folder)
    found = found.where(~F.startswith("name", F.lit("SHA256SUMS/")))
    listed = release.parse_sums(spark.read.text(f"{folder}/SHA256SUMS").select(F.col("value").alias("line")))
    sizes = found.select("name", "size")
    faults = release.verify(listed.join(sizes, "name", "left").select("name", "size", "sha256"), found)
    if not faults.isEmpty():
        raise ValueError("files differ from the sums")
    manifest = spark.read.schema("name string, lines long, digest string, release_id string").json(f"{folder}/manifest.json")
    if release_id is not None and not manifest.where(~F.col("release_id").eqNullSafe(F.lit(release_id))).isEmpty():
        raise ValueError("another release")
    lines = spark.read.text(f"{folder}/territories.ndjson").select(F.col("value").alias("line"))
    if digest(lines, "territories.ndjson").join(manifest, ["name", "lines", "digest"], "left_semi").isEmpty():
        raise ValueError("lines differ from the manifest")
    return lines
