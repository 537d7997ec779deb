"""Polygon features to units, and the units that can be derived from their children."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import shapes as S
from ..functions.text import code_candidates, match_name
from ..sources.registry import ROOT_TYPES


def match(features: DataFrame, units: DataFrame) -> DataFrame:
    """Rows (feature, territory_id, how) of all features; how: code, county name, unit name, or null.

    features: (feature, code, name, rank (2 for counties, 3 for units), upper (the feature above)); units: (territory_id,
    code, name, territory_type, county_id). Codes are tried in order; a unit's name must be alone in its county.
    """
    by_code = units.select(F.explode(code_candidates(F.col("code"))).alias("_code"), F.col("territory_id").alias("_t")).groupBy("_code").agg(F.max("_t").alias("by_code"))
    tried = features.select("feature", F.posexplode(code_candidates(F.col("code"))).alias("_at", "_code")).join(by_code, "_code").groupBy("feature").agg(F.min_by("by_code", "_at").alias("by_code"))
    root = F.col("territory_type").isin(*ROOT_TYPES)
    counties = units.where(root).groupBy(match_name(F.col("name")).alias("_name")).agg(F.max("territory_id").alias("county"))
    alone = units.where(~root).groupBy("county_id", match_name(F.col("name")).alias("_name")).agg(F.count("*").alias("n"), F.min("territory_id").alias("by_unit")).where("n = 1").drop("n")
    own = features.withColumn("_name", match_name(F.coalesce("name", "code")))
    above = own.select(F.col("feature").alias("upper"), F.col("_name").alias("_above"))
    named = (
        own.join(tried, "feature", "left")
        .join(counties.withColumnRenamed("county", "by_county"), "_name", "left")
        .join(above, "upper", "left")
        .join(counties.select(F.col("_name").alias("_above"), F.col("county").alias("county_id")), "_above", "left")
        .join(alone, ["county_id", "_name"], "left")
    )
    county = F.when(F.col("rank") == 2, F.col("by_county"))
    unit = F.when(F.col("rank") == 3, F.col("by_unit"))
    how = F.when(F.col("by_code").isNotNull(), "code").when(county.isNotNull(), "county name").when(unit.isNotNull(), "unit name")
    return named.select("feature", F.coalesce("by_code", county, unit).alias("territory_id"), how.alias("how"))


def conflicts(matched: DataFrame) -> DataFrame:
    """Units claimed by several features: rows (territory_id, feature, kept), the first feature kept."""
    w = W.partitionBy("territory_id")
    return matched.where("territory_id IS NOT NULL").withColumns({"kept": F.min("feature").over(w), "_n": F.count("*").over(w)}).where("_n > 1 AND feature != kept").select("territory_id", "feature", "kept")


def derivable(units: DataFrame, shapes: DataFrame) -> DataFrame:
    """Rows (county_id, expected, actual, snapshots, verdict): whether each county's shape follows from its children's.

    units: the children (territory_id, county_id); shapes: (territory_id, snapshot), the latest of each.
    """
    j = units.where("county_id IS NOT NULL").join(shapes, "territory_id", "left")
    by = j.groupBy("county_id").agg(F.count("*").alias("expected"), F.count("snapshot").alias("actual"), F.count_distinct("snapshot").alias("snapshots"))
    return by.withColumn("verdict", F.when(F.col("expected") == 0, "no-eligible-children").when(F.col("actual") < F.col("expected"), "incomplete-children").when(F.col("snapshots") != 1, "ambiguous-snapshot").otherwise("derivable"))


def union_boundary(shapes: DataFrame, by: str) -> DataFrame:
    """Rows (by, x1, y1, x2, y2): the directed edges around the union of each group's polygons, the inside to their left.

    For polygons that meet edge to edge and do not overlap: an edge that two of them share runs both ways and falls out. shapes: (by, polygons).
    """
    e = shapes.select(by, F.inline(S.directed_edges(F.col("polygons"))))
    ahead = F.struct("x1", "y1") < F.struct("x2", "y2")
    turned = lambda a, b: F.when(ahead, F.col(a)).otherwise(F.col(b)).alias(a)
    once = e.select(by, turned("x1", "x2"), turned("y1", "y2"), turned("x2", "x1"), turned("y2", "y1"), F.when(ahead, 1).otherwise(-1).alias("way"))
    kept = once.groupBy(by, "x1", "y1", "x2", "y2").agg(F.sum("way").alias("way")).where("way != 0")
    back = F.col("way") < 0
    swap = lambda a, b: F.when(back, F.col(b)).otherwise(F.col(a)).alias(a)
    return kept.select(by, swap("x1", "x2"), swap("y1", "y2"), swap("x2", "x1"), swap("y2", "y1"))


def union_measures(boundary: DataFrame, by: str) -> DataFrame:
    """Rows (by, edges, perimeter, area) of a union, from its boundary."""
    length = F.sqrt(F.pow(F.col("x2") - F.col("x1"), 2) + F.pow(F.col("y2") - F.col("y1"), 2))
    return boundary.groupBy(by).agg(F.count("*").alias("edges"), F.sum(length).alias("perimeter"), (F.sum(F.col("x1") * F.col("y2") - F.col("x2") * F.col("y1")) / 2).alias("area"))
