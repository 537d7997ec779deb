"""Validation: what a record breaks is an array of findings beside it, made in one pass; few rules need more.

Records: (row_number, code, name, county, parent, type, level, nuts), codes as
text. Findings: (rule, severity, entity, detail); described() adds the rest.

Of a repeated code the first record by row number is what others refer to. The
first NUTS value of a county, well formed or not, is the county's; an empty one
is none.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.numbers import checksum_valid
from ..sources.tables import cut, small
from .graph import cycles

# Type code, territory type, administrative role, level, is a local unit, is a locality, is a county's seat.
TYPES = (
    (1, "municipality", "local_uat", 2, True, True, True),
    (2, "city", "local_uat", 2, True, True, False),
    (3, "commune", "local_uat", 2, True, False, False),
    (4, "municipality", "local_uat", 2, True, True, False),
    (5, "city", "local_uat", 2, True, True, True),
    (6, "sector", "administrative_subdivision", 3, False, False, False),
    (9, "component_locality", "locality", 3, False, True, False),
    (10, "component_locality", "locality", 3, False, True, False),
    (11, "village", "locality", 3, False, True, False),
    (17, "component_locality", "locality", 3, False, True, False),
    (18, "component_locality", "locality", 3, False, True, False),
    (19, "village", "locality", 3, False, True, False),
    (22, "village", "locality", 3, False, True, False),
    (23, "village", "locality", 3, False, True, False),
    (40, "county", "county_uat", 1, True, False, False),
)
CAPITAL = "(?iu)BUCUREȘTI|BUCUREŞTI"
COUNTY_TYPE = 40
NUTS = "^RO[0-9A-Z]{3}$"
PREFIX = "SIRUTA_"


@dataclass
class Profile:
    """What was reviewed: expected volumes, the parent code that means none, corrections and overrides."""

    rows: int | None = None
    levels: dict[int, int] = field(default_factory=dict)
    nuts3: int | None = None
    missing_nuts: int | None = None
    checksum_warnings: int | None = None
    sentinel: str | None = None
    sentinel_count: int | None = None
    overrides: dict[str, tuple] = field(default_factory=dict)  # code: (type code, level, territory type, role, is a local unit, is a locality, is a seat)
    corrections: dict[str, tuple] = field(default_factory=dict)  # county: (source value, corrected value, count, county unit's code)


def type_table(spark: SparkSession) -> DataFrame:
    return F.broadcast(spark.createDataFrame(TYPES, "type int, territory_type string, administrative_role string, expected_level int, is_uat boolean, is_locality boolean, is_county_seat boolean"))


def typed(records: DataFrame, overrides: dict[str, tuple] | None = None) -> DataFrame:
    """Adds what a record's type code says; the capital's county is its own type; an override counts while type and level are as reviewed."""
    spark = records.sparkSession
    out = records.join(type_table(spark), "type", "left")
    capital = (F.col("type") == COUNTY_TYPE) & F.coalesce(F.col("name").rlike(CAPITAL), F.lit(False))
    out = out.withColumn("territory_type", F.when(capital, "bucharest").otherwise(F.col("territory_type"))).withColumn("is_locality", capital | F.col("is_locality"))
    if overrides:
        rows = [(code, *x) for code, x in overrides.items()]
        given = F.broadcast(spark.createDataFrame(rows, "code string, _type int, _level int, _t string, _r string, _u boolean, _l boolean, _s boolean"))
        out = out.join(given, "code", "left")
        on = F.col("_type").isNotNull() & (F.col("_type") == F.col("type")) & (F.col("_level") == F.col("level"))
        for name, own in (("territory_type", "_t"), ("administrative_role", "_r"), ("is_uat", "_u"), ("is_locality", "_l"), ("is_county_seat", "_s"), ("expected_level", "_level")):
            out = out.withColumn(name, F.when(on, F.col(own)).otherwise(F.col(name)))
        out = out.drop("_t", "_r", "_u", "_l", "_s")
    return out


def finding(df: DataFrame, rule: str, severity: str, entity=None, detail=None) -> DataFrame:
    entity = F.lit(None) if entity is None else entity
    detail = F.lit(None) if detail is None else detail
    return df.select(F.lit(PREFIX + rule).alias("rule"), F.lit(severity).alias("severity"), entity.cast("string").alias("entity"), detail.cast("string").alias("detail"))


def effective_parent(parent, level, sentinel: str | None):
    """Null for 0, and at level 1 for the reviewed value that means none."""
    none = parent == "0"
    if sentinel is not None:
        none = none | ((parent == sentinel) & (level == 1))
    return F.when(~none, parent)


def corrected(records: DataFrame, corrections: dict[str, tuple]) -> DataFrame:
    out = F.col("nuts")
    for county, (source, value, *_) in corrections.items():
        out = F.when((F.col("county") == county) & F.col("nuts").eqNullSafe(F.lit(source)), F.lit(value)).otherwise(out)
    return records.withColumn("nuts", out)


def first_by_code(records: DataFrame) -> DataFrame:
    """The first record of each code."""
    return records.groupBy("code").agg(F.min_by(F.struct("*"), "row_number").alias("_r")).select("_r.*")


def last_by_code(records: DataFrame) -> DataFrame:
    """The last record of each code, with the row number of the first as `position`."""
    return records.groupBy("code").agg(F.max_by(F.struct("*"), "row_number").alias("_r"), F.min("row_number").alias("position")).select("_r.*", "position")


GROUPS = ("codes", "types", "nuts", "parents")


def row_findings(records: DataFrame, profile: Profile | None = None, groups: tuple[str, ...] = GROUPS, counties: DataFrame | None = None) -> DataFrame:
    """What single records break, of the groups of rules asked for. counties: what `_counties` gives for the same records and profile, if it is made already."""
    profile = profile or Profile()
    r = typed(records, profile.overrides if "types" in groups else None)
    r = corrected(r, profile.corrections).withColumn("up", effective_parent(F.col("parent"), F.col("level"), profile.sentinel))
    items = []

    def rule(when, name: str, detail=None, entity="code") -> None:
        detail = F.lit(None) if detail is None else detail
        items.append(F.when(when, F.struct(F.lit(PREFIX + name).alias("rule"), F.lit("blocker").alias("severity"), F.col(entity).cast("string").alias("entity"), detail.cast("string").alias("detail"))))

    if "codes" in groups:
        r = r.join(records.groupBy("code").agg(F.min("row_number").alias("_first_row")), "code", "left")
        rule(F.col("row_number") != F.col("_first_row"), "DUPLICATE_CODE", F.col("row_number"))
    if "types" in groups:
        rule(F.col("territory_type").isNull(), "UNKNOWN_TYPE", F.col("type"))
        rule(F.col("territory_type").isNotNull() & (F.col("expected_level") != F.col("level")), "TYPE_LEVEL_MISMATCH", F.col("level"))
        if profile.overrides:
            rule(F.col("_type").isNotNull() & ~((F.col("_type") == F.col("type")) & (F.col("_level") == F.col("level"))), "REVIEWED_TYPE_OVERRIDE_MISMATCH")
    if "nuts" in groups or "parents" in groups:
        r = r.join(small(_counties(records, profile) if counties is None else counties), "county", "left")
    if "nuts" in groups:
        some = F.col("nuts") != ""
        rule(some & ~F.col("nuts").rlike(NUTS), "NUTS_FORMAT_INVALID", F.col("nuts"))
        rule(some & (F.col("nuts") != F.col("_county_nuts")), "NUTS_COUNTY_CONFLICT", F.col("nuts"))
    if "parents" in groups:
        r = r.join(small(_parents(r, records)), "up", "left")
        rule((F.col("level") > 1) & F.col("up").isNull(), "REQUIRED_PARENT_MISSING", F.col("level"))
        rule(F.col("up").isNotNull() & F.col("_up_level").isNull(), "PARENT_MISSING", F.col("up"))
        rule((F.col("level") == 1) & F.col("up").isNotNull(), "ROOT_PARENT_INVALID", F.col("parent"))
        rule((F.col("level") > 1) & (F.col("_up_level") != F.col("level") - 1), "PARENT_LEVEL_INVALID", F.col("_up_level"))
        rule(F.col("_up_level").isNotNull() & ~F.col("county").eqNullSafe(F.col("_up_county")), "PARENT_COUNTY_MISMATCH", F.col("_up_county"))
        rule(~F.coalesce("_has_county", F.lit(False)), "COUNTY_MISSING", F.col("county"))
    return r.select(F.inline(F.array_compact(F.array(*items))))


def _counties(records: DataFrame, profile: Profile) -> DataFrame:
    """Rows (county, _county_nuts, _has_county): a county's first value, and whether it has a record of its own."""
    fixed = corrected(records, profile.corrections)
    return cut(fixed.groupBy("county").agg(F.min_by("nuts", F.when(F.col("nuts") != "", F.col("row_number"))).alias("_county_nuts"), F.bool_or(F.col("type") == COUNTY_TYPE).alias("_has_county")))


def _parents(children: DataFrame, records: DataFrame) -> DataFrame:
    """Rows (up, _up_level, _up_county) of the parents that are asked for and exist: as few as there are inner units."""
    first = records.groupBy("code").agg(F.min_by(F.struct("level", "county"), "row_number").alias("_r"))
    asked = children.where("up IS NOT NULL").select("up").distinct()
    return cut(asked.join(first, asked["up"] == first["code"]).select("up", F.col("_r.level").alias("_up_level"), F.col("_r.county").alias("_up_county")))


def duplicate_codes(records: DataFrame) -> DataFrame:
    return row_findings(records, groups=("codes",))


def type_rules(records: DataFrame, overrides: dict[str, tuple] | None = None) -> DataFrame:
    out = row_findings(records, Profile(overrides=overrides or {}), ("types",))
    if overrides:
        asked = records.sparkSession.createDataFrame([(c,) for c in overrides], "code string")
        out = out.unionByName(finding(asked.join(records, "code", "left_anti"), "REVIEWED_TYPE_OVERRIDE_MISSING", "blocker", F.col("code")))
    return out


def county_rules(records: DataFrame, profile: Profile, counties: DataFrame | None = None) -> DataFrame:
    """What counties break: one record after another with another code, one value in several counties, corrections that no longer fit."""
    own = records.where(F.col("type") == COUNTY_TYPE)
    before = F.lag("code").over(W.partitionBy("county").orderBy("row_number"))  # over county records only
    several = (_counties(records, profile) if counties is None else counties).where("_county_nuts IS NOT NULL").groupBy("_county_nuts").agg(F.sort_array(F.collect_set("county")).alias("counties")).where("size(counties) > 1")  # a county code has two digits
    parts = [
        finding(own.withColumn("_before", before).where("_before != code"), "DUPLICATE_COUNTY_CODE", "blocker", F.col("code"), F.concat_ws(",", "_before", "code")),
        finding(several, "NUTS_DUPLICATE_COUNTY_IDENTIFIER", "blocker", None, F.concat_ws(":", "_county_nuts", F.array_join("counties", ","))),
    ]
    if profile.corrections:
        parts.append(_corrections(records, profile))
    return reduce(DataFrame.unionByName, parts)


def _corrections(records: DataFrame, profile: Profile) -> DataFrame:
    """The anchor of a correction is the first record of its code in the whole snapshot; the count is not looked at where it is absent."""
    asked = records.sparkSession.createDataFrame([(county, source, count, unit) for county, (source, _, count, unit) in profile.corrections.items()], "_county string, _source string, _count long, _unit string")
    asked = F.broadcast(asked)
    anchors = records.join(asked.select(F.col("_unit").alias("code")).distinct(), "code", "left_semi").groupBy("code").agg(F.min_by(F.struct("county", "type", "level", "nuts"), "row_number").alias("_r"))
    seen = records.join(asked, (F.col("county") == F.col("_county")) & (F.col("nuts") == F.col("_source"))).groupBy("_county").agg(F.count("*").alias("_n"))
    j = asked.join(anchors, F.col("code") == F.col("_unit"), "left").join(seen, "_county", "left").withColumn("_n", F.coalesce("_n", F.lit(0)))
    fits = (F.col("_r.county") == F.col("_county")) & (F.col("_r.type") == COUNTY_TYPE) & (F.col("_r.level") == 1) & F.col("_r.nuts").eqNullSafe(F.col("_source"))
    return (
        finding(j.where("code IS NULL"), "REVIEWED_NUTS_CORRECTION_MISSING", "blocker", F.col("_unit"))
        .unionByName(finding(j.where(F.col("code").isNotNull() & ~F.coalesce(fits, F.lit(False))), "REVIEWED_NUTS_CORRECTION_MISMATCH", "blocker", F.col("_unit")))
        .unionByName(finding(j.where("code IS NOT NULL AND _n != _count"), "REVIEWED_NUTS_CORRECTION_COUNT_CHANGED", "blocker", F.col("_unit"), F.col("_n")))
    )


def nuts_rules(records: DataFrame, profile: Profile) -> DataFrame:
    return row_findings(records, profile, ("nuts",)).unionByName(county_rules(records, profile))


def parent_rules(records: DataFrame, sentinel: str | None = None) -> DataFrame:
    return row_findings(records, Profile(sentinel=sentinel), ("parents",))


def cycle_rule(records: DataFrame, sentinel: str | None = None) -> DataFrame:
    """A finding for each ring; the detail is its closed path from the least code on."""
    own = first_by_code(records)
    ring = cycles(own.select(F.col("code").alias("id"), effective_parent(F.col("parent"), F.col("level"), sentinel).alias("parent")))
    path = ring.groupBy("cycle").agg(F.array_sort(F.collect_list(F.struct("position", "id"))).alias("_p"))  # as long as the ring
    ids = F.transform("_p", lambda x: x["id"])
    return finding(path, "HIERARCHY_CYCLE", "blocker", None, F.array_join(F.concat(ids, F.slice(ids, 1, 1)), ">"))


def checksum_sample(records: DataFrame, most: int = 20) -> DataFrame:
    """The first `most` codes with a wrong check digit, by row: a report."""
    return records.where(~checksum_valid(F.col("code"))).select("row_number", "code").orderBy("row_number").limit(most)


def volume_rules(records: DataFrame, profile: Profile, counties: DataFrame | None = None) -> list[DataFrame]:
    """Counts against the reviewed profile, in one pass."""
    levels = sorted(profile.levels)
    seen = records.agg(
        F.count("*").alias("n"),
        *(F.count_if(F.col("level") == k).alias(f"l{k}") for k in levels),
        F.count_if(~checksum_valid(F.col("code"))).alias("bad"),
        F.count_if(F.coalesce("nuts", F.lit("")) == "").alias("missing"),
        F.count_if((F.col("parent") == profile.sentinel) & (F.col("level") == 1)).alias("sentinels") if profile.sentinel else F.lit(0).alias("sentinels"),
    ).crossJoin((_counties(records, profile) if counties is None else counties).agg(F.count_distinct("_county_nuts").alias("nuts3")))  # one row each
    items = []

    def rule(when, name: str, severity: str, detail) -> None:
        items.append(F.when(when, F.struct(F.lit(PREFIX + name).alias("rule"), F.lit(severity).alias("severity"), F.lit(None).cast("string").alias("entity"), detail.cast("string").alias("detail"))))

    for k in levels:
        rule(F.col(f"l{k}") != profile.levels[k], "LEVEL_VOLUME_CHANGED", "blocker", F.concat(F.lit(f"{k}:"), f"l{k}"))
    for column, want, name in (("n", profile.rows, "TOTAL_VOLUME_CHANGED"), ("nuts3", profile.nuts3, "NUTS3_VOLUME_CHANGED"), ("sentinels", profile.sentinel_count, "ROOT_PARENT_SENTINEL_COUNT_CHANGED")):
        if want is not None:
            rule(F.col(column) != want, name, "blocker", F.col(column))
    for column, want, same, other in (("bad", profile.checksum_warnings, "CHECKSUM_OFFICIAL_WARNING", "CHECKSUM_WARNING_COUNT_CHANGED"), ("missing", profile.missing_nuts, "NUTS_MISSING_VALUES", "NUTS_MISSING_COUNT_CHANGED")):
        if want is not None:
            some = (F.col(column) > 0) | F.lit(want > 0)
            rule(some & (F.col(column) == want), same, "warning", F.col(column))
            rule(some & (F.col(column) != want), other, "warning", F.col(column))
    return [seen.select(F.inline(F.array_compact(F.array(*items))))] if items else []


def row_rules(rows: DataFrame) -> list[DataFrame]:
    """rows: as parsing.parse_rows gives them."""
    return [finding(rows.where("extra_cells"), "EXTRA_CELLS", "error", F.col("record_key")), finding(rows.where("error IS NOT NULL"), "RECORD_INVALID", "error", F.col("record_key"), F.col("error"))]


def all_findings(records: DataFrame, profile: Profile | None = None) -> DataFrame:
    profile = profile or Profile()
    counties = _counties(records, profile)
    parts = [row_findings(records, profile, counties=counties), county_rules(records, profile, counties), cycle_rule(records, profile.sentinel), *volume_rules(records, profile, counties)]
    if profile.overrides:
        asked = records.sparkSession.createDataFrame([(c,) for c in profile.overrides], "code string")
        parts.append(finding(asked.join(records, "code", "left_anti"), "REVIEWED_TYPE_OVERRIDE_MISSING", "blocker", F.col("code")))
    return reduce(DataFrame.unionByName, parts)


def described(findings: DataFrame, version: str = "1.0.0") -> DataFrame:
    """Adds the rule's version and what kind of thing the finding is about."""
    return findings.withColumns({"rule_version": F.lit(version), "entity_kind": F.when(F.col("entity").isNull(), "import_run").otherwise("territory")})


def summary(findings: DataFrame) -> DataFrame:
    """One row: how many findings of each severity, and whether the import is blocked."""
    n = lambda s: F.count_if(F.col("severity") == s)
    out = findings.agg(n("warning").alias("warnings"), n("error").alias("errors"), n("blocker").alias("blockers"))
    return out.withColumn("status", F.when(F.col("errors") + F.col("blockers") > 0, "blocked").otherwise("passed"))


def by_rule(findings: DataFrame) -> DataFrame:
    return findings.groupBy("rule", "severity").agg(F.count("*").alias("n"))
