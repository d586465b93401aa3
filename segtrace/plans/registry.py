"""The registered queries and their SQL, filled by the modules that define them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """spark.read of the driver's tables by attribute."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self._dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self._dir}/{name}.parquet")


def query(sql: str | None = None):
    def register(f: Callable[[Tables], DataFrame]):
        QUERIES[f.__name__] = lambda spark, sf_dir: f(Tables(spark, sf_dir))
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return register


def text_of(dist: str, alias: str) -> Column:
    """A distribution of counts as plain text."""
    return F.array_join(F.transform(dist, lambda x: F.concat(x["key"], F.lit("="), x["weight"].cast("long").cast("string"))), ";").alias(alias)
