"""A registry of units in a forest, drawn from the star schema: regions, nations, customers and suppliers.

Ids are padded, so their order as text is the order of their keys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import load

# The schemes of identifiers.
CODE_SCHEME, REGION_SCHEME = "ro.ins.siruta", "eu.eurostat.nuts"
ROOT_TYPES = ("county", "bucharest")
LOCAL_TYPES = ("municipality", "city", "commune")


def unit_id(kind: int, key: Column) -> Column:
    return F.concat(F.lit(f"{kind}-"), F.lpad(key.cast("string"), 10, "0"))


def forest(spark: SparkSession, folder: str) -> DataFrame:
    """Rows (territory_id, code, official_name, normalized_name, territory_type, administrative_role, level, parent_id, county_id, status, nuts)."""
    region, nation = load(spark, folder, "region"), load(spark, folder, "nation")  # 5 and 25 rows at any scale
    customer, supplier = load(spark, folder, "customer"), load(spark, folder, "supplier")
    none, live = F.lit(None).cast("string"), F.lit("active")

    def units(df, kind, key, code, name, type_, role, level, parent, county, status, nuts):
        columns = {"territory_id": unit_id(kind, key), "code": code.cast("string"), "official_name": name, "normalized_name": F.lower(name), "territory_type": type_, "administrative_role": F.lit(role), "level": F.lit(level), "parent_id": parent, "county_id": county, "status": status, "nuts": nuts}
        return df.select(*(c.alias(n) for n, c in columns.items()))

    of_nation = F.broadcast(nation.select(F.col("n_nationkey").alias("_nation"), "n_regionkey"))
    kind_of = F.get(F.array(*map(F.lit, LOCAL_TYPES)), F.col("n_nationkey") % 3)
    parts = [
        units(region, 1, F.col("r_regionkey"), F.col("r_regionkey") + 1, F.col("r_name"), F.lit("county"), "county_uat", 1, none, unit_id(1, F.col("r_regionkey")), live, F.concat(F.lit("RO0"), F.lpad(F.col("r_regionkey").cast("string"), 2, "0"))),
        units(nation, 2, F.col("n_nationkey"), F.col("n_nationkey") + 100, F.col("n_name"), kind_of, "local_uat", 2, unit_id(1, F.col("n_regionkey")), unit_id(1, F.col("n_regionkey")), live, none),
        units(customer.join(of_nation, F.col("c_nationkey") == F.col("_nation"), "left"), 3, F.col("c_custkey"), 2 * F.col("c_custkey") + 1000, F.col("c_name"), F.lit("village"), "locality", 3, unit_id(2, F.col("c_nationkey")), unit_id(1, F.col("n_regionkey")), F.when(F.col("c_custkey") % 17 == 0, "abolished").otherwise("active"), none),
        units(supplier.join(of_nation, F.col("s_nationkey") == F.col("_nation"), "left"), 4, F.col("s_suppkey"), 2 * F.col("s_suppkey") + 1001, F.col("s_name"), F.lit("component_locality"), "locality", 3, unit_id(2, F.col("s_nationkey")), unit_id(1, F.col("n_regionkey")), live, none),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def with_identifiers(units: DataFrame) -> DataFrame:
    """Adds identifiers: array of (scheme, status, value)."""
    one = lambda scheme, value: F.struct(F.lit(scheme).alias("scheme"), F.col("status").alias("status"), value.alias("value"))
    code = F.array(one(CODE_SCHEME, F.col("code")))
    return units.withColumn("identifiers", F.when(F.col("nuts").isNull(), code).otherwise(F.array_union(code, F.array(one(REGION_SCHEME, F.col("nuts"))))))


def edges(units: DataFrame) -> DataFrame:
    return units.select(F.col("territory_id").alias("id"), F.col("parent_id").alias("parent"))
