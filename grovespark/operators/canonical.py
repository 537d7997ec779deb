"""From validated records to the units of a release: ids, parents, counties, names, identifiers, provenance."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as X
from ..sources.registry import CODE_SCHEME, REGION_SCHEME
from ..sources.tables import cut, small
from . import validation as V


def build(records: DataFrame, ids: DataFrame, profile: V.Profile | None = None) -> DataFrame:
    """Units of records that passed validation. ids: (code, territory_id), one a code.

    A county is the unit of the last county record with its code. Parents and counties that have no id become null.
    Only counties carry a NUTS identifier, and note its correction. Columns of the record beyond the known ones are kept out.
    """
    profile = profile or V.Profile()
    r = V.typed(records, profile.overrides)
    up = V.effective_parent(F.col("parent"), F.col("level"), profile.sentinel)
    fixed = V.corrected(r.withColumn("_source", F.col("nuts")), profile.corrections).withColumn("up", up)
    own = fixed.join(ids, "code", "left")
    parents = cut(own.where("up IS NOT NULL").select("up").distinct().join(ids.select(F.col("code").alias("up"), F.col("territory_id").alias("parent_territory_id")), "up"))
    last = records.where(F.col("type") == V.COUNTY_TYPE).groupBy("county").agg(F.max_by("code", "row_number").alias("code"))
    counties = cut(last.join(ids, "code").select("county", F.col("territory_id").alias("county_territory_id")))
    j = own.join(small(parents), "up", "left").join(small(counties), "county", "left")
    county = F.col("administrative_role") == "county_uat"
    one = lambda scheme, value: F.struct(F.lit(scheme).alias("scheme"), value.alias("value"), F.lit("active").alias("status"))
    nuts = F.when(county & (F.col("nuts") != ""), one(REGION_SCHEME, F.col("nuts")))
    return j.select(
        "territory_id", "code", F.col("name").alias("official_name"), X.search_name(F.col("name")).alias("normalized_name"), X.short_name(F.col("name")).alias("short_name"),
        "territory_type", "administrative_role", F.col("level").alias("administrative_level"), "parent_territory_id", "county_territory_id", "is_uat", "is_locality", "is_county_seat",
        F.lit("active").alias("status"), F.array_sort(F.array_compact(F.array(nuts, one(CODE_SCHEME, F.col("code"))))).alias("identifiers"),
        F.when(county & ~F.col("nuts").eqNullSafe(F.col("_source")), F.col("_source")).alias("corrected_from"),
    )


def in_order(units: DataFrame) -> DataFrame:
    """By the number that the code is."""
    return units.orderBy(F.col("code").cast("long"))
