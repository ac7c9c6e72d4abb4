"""Scratch tables in the folder that all executors share, and broadcasts of a checked size."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Most rows, and most bytes of written Parquet, of a table that is broadcast; beyond either the same join shuffles.
BROADCAST_ROWS, BROADCAST_BYTES = 500_000, 32 << 20


def shared_dir(spark: SparkSession) -> str:
    """The folder that spark.checkpoint.dir names. Where it is unset, a new one on a single machine; an error on a cluster."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def new_dir(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def removed(spark: SparkSession, path: str) -> None:
    """Delete a scratch folder that is no longer read."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def written(df: DataFrame, name: str) -> DataFrame:
    """df written as Parquet into the shared folder and read back: cuts lineage and survives lost executors."""
    spark = df.sparkSession
    path = new_dir(spark, name)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._scratch = path
    return out


def freed(*tables: DataFrame) -> None:
    """Delete the files of written tables. The caller made them, and all that reads them has been written."""
    for table in tables:
        removed(table.sparkSession, table._scratch)


def estimated_bytes(df: DataFrame) -> int:
    """The optimizer's estimate; for a written table the size of its files."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def sized(df: DataFrame, limit: int = BROADCAST_ROWS, most: int = BROADCAST_BYTES) -> DataFrame:
    """df marked for broadcast if it has at most limit rows and so many bytes, else as it is (then the join shuffles).

    df should be a written table, as its rows are counted here.
    """
    return F.broadcast(df) if estimated_bytes(df) <= most and df.limit(limit + 1).count() <= limit else df
