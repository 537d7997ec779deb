"""The folder that driver and executors share, and joins with sides of a checked size."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 64 << 20
#: So many keys can be hot at most.
HOT_KEYS = 10_000


def shared_folder(spark: SparkSession) -> str:
    """The value of spark.checkpoint.dir; where it is unset a new temporary folder in local runs, and an error on a cluster."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        set_dir = spark.sparkContext._jsc.sc().getCheckpointDir()
        if set_dir.isDefined():
            return set_dir.get()
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="shared-")
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def cut(df: DataFrame) -> DataFrame:
    """df with its lineage cut: written to a new table in the shared folder and read back."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/table-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def shuffled(df: DataFrame) -> DataFrame:
    """df, whose join is a shuffled one whatever Spark takes its size to be.

    Spark takes a table for as many rows after an explode as before, and one read from files for as large as they are
    compressed, so it would broadcast tables of many times the size that it allows.
    """
    return df.hint("merge")


def small(df: DataFrame, rows: int = BROADCAST_ROWS, size: Column | None = None) -> DataFrame:
    """df, which must be cheap to count, marked for broadcast if it has at most `rows` rows; else for a shuffled join.

    size: the bytes of a row's arrays and texts, which together must be at most BROADCAST_BYTES as well.
    """
    n, held = df.limit(rows + 1).agg(F.count("*"), F.coalesce(F.sum(size if size is not None else F.lit(0)), F.lit(0))).first()
    return F.broadcast(df) if n <= rows and held <= BROADCAST_BYTES else shuffled(df)


def join_counted(rows: DataFrame, table: DataFrame, keys: list[str], count: str) -> DataFrame:
    """rows.join(table, keys), where table has one row a key and the column `count` says how many of the rows have that key.

    Keys with more than a HOT_KEYS-th of all rows, so HOT_KEYS keys at most at any size, are broadcast: no task gets all rows of one.
    rows and table must be cheap to read again. The column `count` is left out.
    """
    least = rows.count() // HOT_KEYS
    hot = F.broadcast(table.where(F.col(count) > least))
    cold = table.where(F.col(count) <= least).drop(count)
    apart = rows.join(hot.select(*keys), keys, "left_anti").join(shuffled(cold), keys)
    return apart.unionByName(rows.join(hot.drop(count), keys))
