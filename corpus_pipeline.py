"""A corpus from raw documents in five stages, each an operator of segtrace.llm.

run() writes what each stage returns to the shared folder and hands it to the next one. Every stage but the
last returns the columns of documents; the last repeats each document as often as the mix takes it. An empty table gives an empty table; other columns than those of documents
are left out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from segtrace.llm.common import saved, small_batches, table
from segtrace.llm.compression import keep_quality
from segtrace.llm.decontaminate import decontaminate
from segtrace.llm.forest import deduplicate
from segtrace.llm.mixing import mix_documents
from segtrace.llm.pii import mask_pii

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules keep. A null or empty text goes; null ids and repeated rows are judged by their text."""
    small_batches(spark)
    return keep_quality(docs.select(*COLUMNS))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group with shingle similarity 0.8 or more: that with the smallest id. Null ids and texts without a
    word stay; rows that repeat the id that is kept all stay."""
    small_batches(spark)
    return deduplicate(docs, percent=80).select(*COLUMNS)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents into which no benchmark item leaked. Null ids and texts stay; of a repeated id all rows go if any leaks."""
    return decontaminate(docs, table(spark, sf_dir, "benchmark")).select(*COLUMNS)


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data replaced by its kind; n_chars follows the new text. A null text stays null, and
    so does its n_chars; repeated rows and null ids are treated alike."""
    small_batches(spark)
    masked = mask_pii(docs.select(*COLUMNS))
    return masked.withColumn("n_chars", F.length("text").cast("long"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it; copy counts from 1. Null is a source of its own; texts without a word are
    never taken; repeated rows share the copies of such rows."""
    return mix_documents(docs.select(*COLUMNS), weights=(3, 1, 2), total_share=1.5, most=2.0)


STAGES = [("quality rules", quality), ("minhash near-dedup", near_dedup), ("benchmark decontamination", benchmark), ("pii", pii), ("mixing", mixing)]

#: Compression ratios, MinHash and random rounding are beyond SQL; the tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
