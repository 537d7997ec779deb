"""Parquet tables, and intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BROADCAST_ROWS = 100_000


def load(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir; where it is unset a temporary folder in local runs, and an error on a cluster."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        known = spark.sparkContext._jsc.sc().getCheckpointDir()
        if known.isDefined():
            return known.get()
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="shared-")
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def cut(df: DataFrame) -> DataFrame:
    """df written to the shared folder and read back, so that its lineage ends there."""
    path = f"{shared_folder(df.sparkSession)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """df marked for broadcast if it has at most `rows` rows (they are counted); else as it is, and a join shuffles it."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df
