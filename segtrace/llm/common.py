"""Small helpers that the operators of this subpackage share."""

from __future__ import annotations

import contextlib
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..shared import fresh_folder, stored

#: One word: a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
WHITE = b" \t\n\r\x0b\f"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return small_batches(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession, rows: int = 2000) -> SparkSession:
    """Hand whole texts to Python in batches of few rows, which bounds the memory of workers and JVM alike.

    Spark reads this setting when a plan runs, so it stays set in the session.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    return spark


@contextlib.contextmanager
def batches_of(spark: SparkSession, rows: int) -> Iterator[None]:
    """Hand rows to Python in batches of so many for plans that run inside the block; the setting is put back after it."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder below the one that driver and executors share."""
    return fresh_folder(spark, name)


def saved(df: DataFrame, name: str) -> DataFrame:
    """Write df to the shared folder and read it again: lineage ends here and survives lost executors."""
    return stored(df, name)


def file_system(uri: str):
    """(pyarrow file system, path) of a URI or plain path; any store that pyarrow knows works."""
    from pyarrow import fs

    if "://" not in uri:
        return fs.LocalFileSystem(), uri.removeprefix("file:")
    return fs.FileSystem.from_uri(uri)


def refuse_full(folder: str) -> None:
    """ValueError if the folder holds files: parts of an earlier run would be read as records."""
    from pyarrow import fs

    store, base = file_system(folder)
    if store.get_file_info(fs.FileSelector(base, allow_not_found=True)):
        raise ValueError(f"{folder} holds files; parts of an earlier run would be read as records")


def crc_mod(id_col: str, n: int) -> Column:
    """crc32 of the id as text, mod n; null for a null id."""
    return F.pmod(F.crc32(F.col(id_col).cast("string")), F.lit(n)).cast("int")


def own(df: DataFrame, **columns: str) -> DataFrame:
    """Only the named columns under internal names, so that other columns of df can't clash."""
    return df.select(*[F.col(f"`{c}`").alias(name) for name, c in columns.items()])
