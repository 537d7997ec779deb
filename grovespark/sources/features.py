"""GeoJSON features as rows, and back as lines in a fixed order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import shapes

# The properties that the feature service names.
PROPERTIES = "OBJECTID long, featureId string, name_1 string, name_2 string, name_3 string, nationalCode string, nationalLevel string, upperLevelUnit string"
RANKS = {"2ndOrder": 2, "3rdOrder": 3}


def read_features(spark: SparkSession, path: str) -> DataFrame:
    """Rows (object_id, feature, code, name, rank, upper, polygons) of FeatureCollections, a collection a file; polygons are null for other shapes."""
    schema = f"features array<struct<properties: struct<{PROPERTIES.replace(' ', ': ').replace(',:', ',')}>, geometry: string>>"
    one = spark.read.schema(schema).json(path, multiLine=True).select(F.inline("features"))
    p = lambda n: F.col(f"properties.{n}")
    rank = F
    for sign, value in RANKS.items():
        rank = rank.when(F.contains(p("nationalLevel"), F.lit(sign)), value)
    return one.select(
        p("OBJECTID").alias("object_id"), p("featureId").alias("feature"), p("nationalCode").alias("code"), F.coalesce(*(F.nullif(p(n), F.lit("")) for n in ("name_1", "name_2", "name_3"))).alias("name"),
        rank.alias("rank"), p("upperLevelUnit").alias("upper"), shapes.parse(F.col("geometry")).alias("polygons"),
    )


def feature_line(territory: Column, kind: Column, detail: Column, polygons: Column) -> Column:
    """One GeoJSON feature, its fields by name."""
    geometry = F.struct(polygons.alias("coordinates"), F.lit("MultiPolygon").alias("type"))
    properties = F.struct(detail.alias("detailLevel"), kind.alias("geometryKind"), territory.alias("territoryId"))
    return F.to_json(F.struct(geometry.alias("geometry"), properties.alias("properties"), F.lit("Feature").alias("type")), {"ignoreNullFields": "false"})


def in_order(rows: DataFrame) -> DataFrame:
    """Features (territory_id, geometry_kind, detail_level, ...) in the order of a collection."""
    return rows.orderBy("territory_id", "geometry_kind", "detail_level")


def downloaded(features: DataFrame) -> DataFrame:
    """Rows (object_id, feature, sha256) of downloaded features by number, those without one first. features: (object_id, feature, line)."""
    number = F.coalesce("object_id", F.lit(0))
    return features.select(number.alias("object_id"), "feature", F.sha2("line", 256).alias("sha256")).orderBy("object_id", "feature")
