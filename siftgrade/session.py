"""What every operator needs from the session: tables, shared storage, size checks."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Partitions up to which an input of fewer than there are cores is spread; no more than their size is moved.
SPREAD_PARTITIONS = 256
#: Rows a side may have before it is no longer broadcast; callers fall back to a shuffled join.
BROADCAST_ROWS = 200_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share: spark.checkpoint.dir; on one machine, where that is unset, one of our own."""
    where = spark.conf.get("spark.checkpoint.dir", None)
    if not where:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        where = tempfile.mkdtemp(prefix="spark-")
        spark.conf.set("spark.checkpoint.dir", where)
    return where


def written(df: DataFrame, *partition_by: str) -> DataFrame:
    """Cut the lineage: write df as Parquet to the shared folder and read it back."""
    spark = df.sparkSession
    path = os.path.join(shared_dir(spark), f"cut-{uuid.uuid4().hex}")
    writer = df.write.partitionBy(*partition_by) if partition_by else df.write
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """df over as many partitions as there are cores, for work that is heavy per row.

    Only an input of few partitions is redistributed, such as a single small file; a larger one stays as
    it is read. For frames whose plan has no exchange yet.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.isStreaming or not df.rdd.getNumPartitions() < min(cores, SPREAD_PARTITIONS):
        return df
    return df.repartition(cores)


def at_most(df: DataFrame, rows: int) -> bool:
    """Whether df has at most so many rows; reads no more than that from it."""
    return df.limit(rows + 1).count() <= rows


def checked_broadcast(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """df with a broadcast hint if it is proven to have at most so many rows, else as it is."""
    return F.broadcast(df) if at_most(df, rows) else df
