"""Snapshots as files addressed by their hash: reading, sniffing, checking, archiving."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Media types by their signs.
XLSX = "application/vnd.openxmlformats-officedocument.spreadsheetml.sheet"
ZIP, JSON, XML, CSV, BYTES = "application/zip", "application/json", "application/xml", "text/csv", "application/octet-stream"
SAMPLE = 8192


def read_files(spark: SparkSession, path: str) -> DataFrame:
    """Rows (path, content, size, sha256)."""
    return spark.read.format("binaryFile").load(path).select("path", "content", F.col("length").alias("size"), F.sha2("content", 256).alias("sha256"))


def media_type(content: Column) -> Column:
    """The type that the bytes of a file show; content: binary."""
    head = F.hex(F.substring(content, 1, 4))
    zipped = head.rlike("^504B(03|05|07)(04|06|08)$")
    has = lambda name: F.contains(content, F.lit(name).cast("binary"))
    sample = F.make_valid_utf8(F.substring(content, 1, SAMPLE).cast("string"))
    text = F.regexp_replace(sample, r"(?U)^[\x{FEFF}\s]+", "")
    as_json = text.rlike(r"^[{\[]") & F.try_parse_json(F.make_valid_utf8(content.cast("string"))).isNotNull()
    return (
        F.when(zipped & has("[Content_Types].xml") & has("xl/workbook.xml"), XLSX)
        .when(zipped, ZIP)
        .when(as_json, JSON)
        .when(F.startswith(text, F.lit("<")), XML)
        .when(~F.contains(sample, F.lit("\x00")) & text.rlike("[;,\t]") & text.rlike("\r?\n"), CSV)
        .otherwise(BYTES)
    )


def media_type_of_text(text: Column) -> Column:
    return media_type(text.cast("binary"))


def archived_name(source: str, sha256: Column, extension: str) -> Column:
    return F.concat(F.lit(f"{source}/"), F.substring(sha256, 1, 2), F.lit("/"), sha256, F.lit(f".{extension}"))


def expected(files: DataFrame, size: int, sha256: str, types: tuple[str, ...]) -> DataFrame:
    """Files with the reason for refusing each: null if size, hash and type are as expected."""
    reason = F.when(F.col("size") != size, "SIZE_MISMATCH").when(F.col("sha256") != sha256, "HASH_MISMATCH").when(~media_type(F.col("content")).isin(*types), "MEDIA_TYPE_UNEXPECTED")
    return files.withColumn("refused", reason)


def catalog_resources(spark: SparkSession, path: str, resource_id: str, reviewed_url: str) -> DataFrame:
    """Rows (id, url, state, refused) of one resource in catalogue answers (JSON files): it must be active and have the reviewed URL."""
    schema = "result struct<resources: array<struct<id: string, url: string, state: string, format: string>>>"
    found = spark.read.schema(schema).json(path, multiLine=True).select(F.inline("result.resources")).where(F.col("id") == resource_id)
    return found.withColumn("refused", F.when(F.coalesce("state", F.lit("active")) != "active", "RESOURCE_INACTIVE").when(~F.col("url").eqNullSafe(F.lit(reviewed_url)), "RESOURCE_URL_CHANGED"))


def register(known: DataFrame, files: DataFrame) -> DataFrame:
    """The files whose (source, sha256) is not known yet, each once: appending them twice changes nothing."""
    return files.dropDuplicates(["source", "sha256"]).join(known.select("source", "sha256"), ["source", "sha256"], "left_anti")
