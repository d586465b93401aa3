"""The folder that driver and executors share."""

from __future__ import annotations

import contextlib
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """What spark.checkpoint.dir names. Unset, a folder of this machine stands in where all of Spark runs in one process; a
    cluster has to name one."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        base = f"file:///tmp/segtrace-{spark.sparkContext.applicationId}"
        spark.conf.set("spark.checkpoint.dir", base)
    return base.rstrip("/")


def fresh_folder(spark: SparkSession, name: str) -> str:
    """A new folder below the shared one."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


@contextlib.contextmanager
def small_batches(spark: SparkSession, rows: int = 200) -> Iterator[None]:
    """Hand so many rows at once to Python in plans that run inside the block: pairs of long texts fill memory soon. The setting is put back after it."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def stored(df: DataFrame, name: str) -> DataFrame:
    """df written to the shared folder and read again: what several steps need is computed once, and lost executors cost no more."""
    path = fresh_folder(df.sparkSession, name)
    df.write.parquet(path, compression="zstd")  # letters of sequences take a quarter of their bytes
    return df.sparkSession.read.schema(df.schema).parquet(path)
