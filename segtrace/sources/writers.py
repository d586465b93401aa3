"""Sinks: FASTA, reports, run records, and the inputs of further tools. `replace` overwrites, else existing output is an error."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.dist import serialize
from ..operators.assign import numbered
from ..schemas import DIST


def _mode(replace: bool) -> str:
    return "overwrite" if replace else "errorifexists"


def fasta_text(header: Column, seq: Column, wrap: int | None = None) -> Column:
    """One record as text, the sequence wrapped after `wrap` letters."""
    body = F.regexp_replace(seq, f"(.{{{wrap}}})(?=.)", "$1\n") if wrap else seq
    return F.concat(F.lit(">"), F.regexp_replace(header, "^>", ""), F.lit("\n"), body)


def write_fasta(df: DataFrame, path: str, wrap: int | None = None, replace: bool = False) -> None:
    df.select(fasta_text(F.col("header"), F.col("seq"), wrap).alias("value")).write.mode(_mode(replace)).text(path)


def write_fasta_by(df: DataFrame, path: str, key: str, wrap: int | None = 80, replace: bool = False) -> None:
    """One directory for each value of key; for files named by the key see fasta_files.write_named."""
    df.select(F.col(key), fasta_text(F.col("header"), F.col("seq"), wrap).alias("value")).write.mode(_mode(replace)).partitionBy(key).text(path)


def with_batches(df: DataFrame, size: int = 8, group: str = "source_file", order: str = "ord") -> DataFrame:
    """Adds batch: 1 for the first `size` records of a group, 2 for the next ..."""
    return numbered(df, group, order, "__n").withColumn("batch", F.ceil(F.col("__n") / size)).drop("__n")


def flat(df: DataFrame) -> DataFrame:
    """Distributions as their text, everything else as it is."""
    return df.select(*[serialize(F.col(f"`{c}`")).alias(c) if kind == DIST else F.col(f"`{c}`") for c, kind in df.dtypes])


def write_report(df: DataFrame, path: str, sep: str = "\t", replace: bool = False) -> None:
    flat(df).write.mode(_mode(replace)).csv(path, sep=sep, header=True, nullValue="NA")


def write_state(df: DataFrame, path: str, replace: bool = False) -> None:
    """Run records as JSON lines."""
    df.write.mode(_mode(replace)).json(path)


def tool_input(df: DataFrame, separator: str = "_", original: bool = False) -> DataFrame:
    """(header, seq): `id separator segment`, repeats numbered `__DUP2` ... before the separator.

    df has internal_id, header, segment_name, seq, ord; with original the header is used in place of the id.
    """
    name = F.regexp_replace(F.coalesce(F.nullif(F.trim("header"), F.lit("")), F.col("internal_id")) if original else F.col("internal_id"), "^>", "")
    rows = df.withColumn("name", name).withColumn("nth", F.row_number().over(Window.partitionBy("name", "segment_name").orderBy("ord")))
    full = F.concat("name", F.when(F.col("nth") > 1, F.concat(F.lit("__DUP"), F.col("nth"))).otherwise(""), F.lit(separator), "segment_name")
    return rows.select(full.alias("header"), "seq")


def constellation_input(df: DataFrame) -> DataFrame:
    """(sample_id, segment_name, header, seq): one record for each sample and segment, the last in order."""
    last = df.groupBy("sample_id", "segment_name").agg(F.max_by("seq", "ord").alias("seq"))
    return last.select("sample_id", "segment_name", F.concat("sample_id", F.lit("_"), "segment_name").alias("header"), "seq")


def genbank_to_fasta(records: DataFrame) -> DataFrame:
    """(header, seq) of read_genbank's records."""
    return records.select(F.concat_ws(" ", "record_id", "definition").alias("header"), "seq")
