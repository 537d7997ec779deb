"""Positions in a global order, without a task that sees all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..sources.tables import cut


def numbered(df: DataFrame, *keys: str, name: str = "position") -> DataFrame:
    """Adds the position from 0 in the order of the keys, which must tell all rows apart.

    Rows are range-partitioned and numbered in their partition; the partitions' counts, a row each, give the offsets.
    """
    parts = cut(df.repartitionByRange(*keys).withColumn("_part", F.spark_partition_id()))
    counts = parts.groupBy("_part").agg(F.count("*").alias("_n"))
    offsets = counts.select("_part", (F.sum("_n").over(W.orderBy("_part")) - F.col("_n")).alias("_before"))
    own = F.row_number().over(W.partitionBy("_part").orderBy(*keys)) - 1
    return parts.withColumn("_own", own).join(F.broadcast(offsets), "_part").withColumn(name, F.col("_before") + F.col("_own")).drop("_part", "_own", "_before")


def chunked(df: DataFrame, size: int, *keys: str) -> DataFrame:
    """Adds chunk: `size` rows in a row of the keys' order make one."""
    return numbered(df, *keys, name="chunk").withColumn("chunk", F.floor(F.col("chunk") / size))
