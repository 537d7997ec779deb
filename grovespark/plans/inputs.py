"""Inputs of the registered queries: the star schema with faults injected by key, the same in every run."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources import registry
from ..sources.tables import load


def records(spark: SparkSession, folder: str) -> DataFrame:
    """Source records (row_number, code, name, county, parent, type, level, nuts) with faults of every kind."""
    nation = load(spark, folder, "nation")
    of_nation = F.broadcast(nation.select(F.col("n_nationkey").alias("_n"), F.col("n_regionkey").alias("_r")))  # 25 rows at any scale
    text = lambda c: c.cast("string")
    nuts = lambda r: F.concat(F.lit("RO0"), F.lpad(text(r), 2, "0"))

    def rows(df, number, code, name, county, parent, kind, level, code_nuts):
        return df.select(number.cast("int").alias("row_number"), text(code).alias("code"), name.alias("name"), text(county).alias("county"), text(parent).alias("parent"), kind.cast("int").alias("type"), F.lit(level).alias("level"), code_nuts.alias("nuts"))

    region, k = load(spark, folder, "region"), F.col("c_custkey")
    of = lambda m: k % m == 0
    r, n, s = F.col("r_regionkey"), F.col("n_nationkey"), F.col("s_suppkey")
    customer = load(spark, folder, "customer").join(of_nation, F.col("c_nationkey") == F.col("_n"))
    supplier = load(spark, folder, "supplier").join(of_nation, F.col("s_nationkey") == F.col("_n"))
    return (
        rows(region, r + 1, r + 1, F.col("r_name"), r + 1, F.when(r == 4, 888888).otherwise(0), F.lit(40), 1, F.when(r != 2, nuts(r)).otherwise("BAD"))
        .unionByName(rows(nation, n + 100, n + 100, F.col("n_name"), F.col("n_regionkey") + 1, F.col("n_regionkey") + 1, n % 3 + 1, 2, F.when(n % 7 != 0, nuts(F.col("n_regionkey")))))
        .unionByName(rows(
            customer, 2 * k + 1000, F.when(of(97), 2 * k + 998).otherwise(2 * k + 1000), F.col("c_name"), F.when(of(53), 99).otherwise(F.col("_r") + 1),
            F.when(k % 113 == 1, 2 * k + 1002).when(k % 113 == 2, 2 * k + 998).when(of(89), 999999).when(of(83), 0).when(of(79), F.col("_r") + 1).otherwise(F.col("c_nationkey") + 100), F.when(of(71), 77).when(of(73), 2).otherwise(11), 3,
            F.when(of(61), F.lit("XX1")).when(of(67), F.lit("RO999")).otherwise(nuts(F.col("_r"))),
        ))
        .unionByName(rows(supplier, 2 * s + 1001, 2 * s + 1001, F.col("s_name"), F.col("_r") + 1, F.col("s_nationkey") + 100, F.when(s % 199 == 7, 40).otherwise(9), 3, F.when(s % 41 == 0, "").otherwise(nuts(F.col("_r")))))
    )


def ringed_edges(spark: SparkSession, folder: str) -> DataFrame:
    """Edges (id, parent) of customers: by the last digit of the key rings of two and three, tails, and plain children."""
    k = F.col("c_custkey")
    d = k % 10
    to = F.when(d == 1, k + 1).when(d == 2, k - 1).when(d.isin(3, 4), k + 1).when(d == 5, k - 2).when(d == 6, k - 1)
    return load(spark, folder, "customer").select(registry.unit_id(3, k).alias("id"), F.coalesce(registry.unit_id(3, to), registry.unit_id(2, F.col("c_nationkey"))).alias("parent"))


def broken_forest(spark: SparkSession, folder: str) -> DataFrame:
    """The forest with lost parents and wrong counties."""
    u = registry.forest(spark, folder)
    key = F.regexp_extract("territory_id", r"(\d+)$", 1).cast("long")
    village = F.col("territory_type") == "village"
    return u.withColumn("parent_id", F.when(village & (key % 101 == 0), F.lit("2-9999999999")).otherwise(F.col("parent_id"))).withColumn("county_id", F.when(village & (key % 103 == 0), F.lit("1-9999999999")).otherwise(F.col("county_id")))


def identities(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(codes, identifiers, proposals): by the key's remainder of 11 a case for each row of the decision table, and more."""
    k = F.col("c_custkey")
    c = load(spark, folder, "customer").select(k, (2 * k + 1000).cast("string").alias("code"), (k % 11).alias("m"))
    unit = lambda kind: F.concat(F.lit(kind), F.col("code"))

    def some(cases, kind, status, ended=False):
        end = F.to_date(F.lit("2020-01-01")) if ended else F.lit(None).cast("date")
        return c.where(F.col("m").isin(*cases)).select("code", unit(kind).alias("territory_id"), F.lit(status).alias("status"), end.alias("valid_to"))

    known = some([0, 1, 2, 3], "a", "active").union(some([3], "b", "active")).union(some([5, 7], "h", "retired")).union(some([9], "e", "active", True))
    asked = some([1], "a", "proposed").union(some([2], "p", "proposed")).union(some([4, 5, 6], "p", "proposed")).union(some([4], "p", "proposed")).union(some([6], "q", "proposed")).union(some([8], "r", "rejected"))
    return c.select("code"), known, asked.drop("valid_to")


def snapshots(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """(previous, current): rows (code, name, segment, record_hash) of customers."""
    k = F.col("c_custkey")
    c = load(spark, folder, "customer")

    def shaped(df, name: Column, segment: Column, note: Column):
        return df.select((2 * k + 1000).cast("string").alias("code"), name.alias("name"), segment.alias("segment"), F.sha2(F.concat_ws("|", name, segment, note), 256).alias("record_hash"))

    plain = F.lit("")
    before = shaped(c.where(k % 29 != 0), F.col("c_name"), F.col("c_mktsegment"), plain)
    after = shaped(c.where(k % 31 != 0), F.when(k % 37 == 0, F.concat("c_name", F.lit(" II"))).otherwise(F.col("c_name")), F.when(k % 41 == 0, F.lit("OTHER")).otherwise(F.col("c_mktsegment")), F.when(k % 43 == 0, F.lit("re-typed")).otherwise(plain))
    return before, after


def addresses(spark: SparkSession, folder: str) -> DataFrame:
    """Rows (event_id, ip): addresses spread over all of IPv4."""
    n = (F.col("event_id") * 2654435761) % 4294967296
    return load(spark, folder, "events").select("event_id", F.concat_ws(".", *(F.floor(n / 256**i).cast("long") % 256 for i in (3, 2, 1, 0))).alias("ip"))


def hits(spark: SparkSession, folder: str) -> DataFrame:
    return load(spark, folder, "events").select(F.col("user_id").alias("client"), F.col("event_id").alias("id"), F.unix_millis(F.col("ts").cast("timestamp")).alias("at"))


def features(spark: SparkSession, folder: str) -> DataFrame:
    """Polygon features (feature, code, name, rank, upper): some with codes, some to be matched by name."""
    region, nation = load(spark, folder, "region"), load(spark, folder, "nation")
    r, n = F.col("r_regionkey"), F.col("n_nationkey")
    two = region.select(F.concat(F.lit("r"), r).alias("feature"), F.when(r % 2 == 0, F.concat(F.lit("RO-"), F.lpad((r + 1).cast("string"), 6, "0"))).alias("code"), F.concat(F.lit("Județul "), "r_name").alias("name"), F.lit(2).alias("rank"), F.lit(None).cast("string").alias("upper"))
    three = nation.select(F.concat(F.lit("n"), F.lpad(n.cast("string"), 3, "0")).alias("feature"), F.when(n % 3 == 0, (n + 100).cast("string")).when(n % 3 == 1, F.lit("none")).alias("code"), F.when(n % 5 == 4, F.lit("Nowhere")).otherwise(F.col("n_name")).alias("name"), F.lit(3).alias("rank"), F.concat(F.lit("r"), "n_regionkey").alias("upper"))
    again = nation.where(n % 12 == 0).select(F.concat(F.lit("z"), F.lpad(n.cast("string"), 3, "0")).alias("feature"), (n + 100).cast("string").alias("code"), F.col("n_name").alias("name"), F.lit(3).alias("rank"), F.lit(None).cast("string").alias("upper"))
    return two.unionByName(three).unionByName(again)
