"""Identification of files as they arrive, and running best hits, with Structured Streaming."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def stream_table(spark: SparkSession, path: str, like: DataFrame, max_files: int = 100) -> DataFrame:
    """A stream of the Parquet files that arrive below path, with the columns of `like`."""
    return spark.readStream.schema(like.schema).option("maxFilesPerTrigger", max_files).parquet(path)


def each_batch(stream: DataFrame, job: Callable[[DataFrame], DataFrame], out: str, checkpoint: str) -> StreamingQuery:
    """Run a batch job (such as identify) over every micro-batch and append to out.

    A batch writes to a folder named by its number, so one that runs again after a failure replaces its own output.
    """

    def write(batch: DataFrame, number: int) -> None:
        job(batch).write.mode("overwrite").parquet(f"{out}/batch={number}")

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def running_best(hits: DataFrame, query: str, score: str, value: str) -> DataFrame:
    """Best value for each query over all batches so far (output mode complete or update); of equal scores the smallest value, as first come in order. A row
    without a score or a value is no hit."""
    # The largest score is the least negative one; NaN, the largest of all, stays so when turned.
    place = F.struct((~F.isnan(score)).alias("number"), (-F.col(score)).alias("turned"), F.col(value).alias("v"))
    best = F.min_by(value, F.when(F.col(score).isNotNull() & F.col(value).isNotNull(), place))
    return hits.groupBy(query).agg(F.max(score).alias(score), best.alias(value))


def windowed_counts(events: DataFrame, time: str, key: str, window: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """Rows for each key and window of event time; rows later than `late` are left out."""
    return events.withWatermark(time, late).groupBy(F.window(time, window).alias("w"), key).agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), key, "n")
