"""Curation of updates: row and group filters, cross-checks, set operations on tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import determining_component, full_subtype, ncbi_accession
from ..schemas import require


def drop_incomplete(df: DataFrame, *columns: str) -> DataFrame:
    """Rows without a null or empty cell in the columns."""
    keep = F.lit(True)
    for c in columns:
        keep = keep & F.col(c).isNotNull() & (F.col(c).cast("string") != "")
    return df.filter(keep)


def length_outliers(df: DataFrame, bounds: DataFrame, key: str, bound_key: str, length: str) -> DataFrame:
    """Rows whose length is outside min_len..max_len of their kind; kinds without bounds pass."""
    dim = bounds.select(F.col(bound_key).alias("__k"), "min_len", "max_len")
    return df.join(dim, df[key] == dim["__k"]).filter(~F.col(length).between(F.col("min_len"), F.col("max_len"))).drop("__k")


def complete_groups(df: DataFrame, group: str, n: int) -> DataFrame:
    """Rows of groups with at least n rows; a null group passes. Counts are partial first; the rows themselves are joined, not sorted."""
    whole = df.filter(F.col(group).isNotNull()).groupBy(F.col(group).alias("__g")).agg(F.count("*").alias("__n")).filter(F.col("__n") >= n).select("__g")
    return df.join(whole, df[group] == whole["__g"], "left_semi").unionByName(df.filter(F.col(group).isNull()))


def groups_with_any_bad(df: DataFrame, group: str, bad) -> DataFrame:
    """Rows of groups in which any row is bad (a boolean column; null counts as bad). A null group never is."""
    worst = df.groupBy(F.col(group).alias("__g")).agg(F.bool_or(F.coalesce(bad, F.lit(True))).alias("__b")).filter("__b")
    return df.join(worst.select("__g"), df[group] == worst["__g"], "left_semi")


def offending_genotypes(df: DataFrame, group: str = "ASSEMBLY", genotype: str = "GENOTYPE", accession: str = "ACCESSION") -> DataFrame:
    """Accessions of assemblies in which any genotype isn't a whole HxNy."""
    return groups_with_any_bad(df, group, ~full_subtype(F.col(genotype))).select(accession).distinct()


def missing_profile(df: DataFrame, *columns: str) -> DataFrame:
    """One row: for each column, how many cells are null or empty."""
    return df.agg(*[F.count_if(F.col(c).isNull() | (F.col(c).cast("string") == "")).alias(c) for c in columns or df.columns])


def multi_valued(df: DataFrame, dist: str) -> DataFrame:
    """Rows whose distribution has several keys."""
    return df.filter(F.size(dist) > 1)


def non_null(df: DataFrame, column: str) -> DataFrame:
    """Rows with a value in the column."""
    return df.filter(F.col(column).isNotNull() & (F.col(column).cast("string") != ""))


def matching(df: DataFrame, **values: object) -> DataFrame:
    """Rows whose columns equal the values."""
    for c, v in values.items():
        df = df.filter(F.col(c) == F.lit(v))
    return df


def set_value(df: DataFrame, key: str, value: object, column: str, new: object) -> DataFrame:
    """df with `column` replaced where key has the value."""
    return df.withColumn(column, F.when(F.col(key) == F.lit(value), F.lit(new)).otherwise(F.col(column)))


def header_contains(df: DataFrame, texts: list[str], column: str = "header") -> DataFrame:
    """Rows whose header contains any of a short list of texts, whatever the case."""
    hit = F.lit(False)
    for t in texts:
        hit = hit | F.contains(F.upper(F.col(column)), F.lit(t.upper()))
    return df.filter(hit)


def fill_missing(df: DataFrame, lookup: DataFrame, key: str, *columns: str) -> DataFrame:
    """df with nulls in the columns filled from lookup rows of the same key."""
    right = lookup.select(F.col(key).alias("__k"), *[F.col(c).alias(f"__{c}") for c in columns])
    out = df.join(right, df[key] == right["__k"], "left")
    return out.withColumns({c: F.coalesce(c, f"__{c}") for c in columns}).drop("__k", *[f"__{c}" for c in columns])


def crosscheck_internal(declared: DataFrame, reported: DataFrame) -> DataFrame:
    """Accessions (segments other than 4 and 6) whose reported segment differs or whose genotype isn't among the reported.

    declared(accession, segment int, genotype), reported(accession, segment int, genotypes array). Null reports offend.
    """
    both = declared.filter(~F.col("segment").isin(4, 6)).join(reported.withColumnsRenamed({"segment": "r_segment", "genotypes": "r_genotypes"}), "accession")
    good = (F.col("segment") == F.col("r_segment")) & F.array_contains("r_genotypes", F.col("genotype"))
    return both.filter(~F.coalesce(good, F.lit(False))).select("accession").distinct()


def crosscheck_determining(declared: DataFrame, reported: DataFrame) -> DataFrame:
    """Accessions of segments 4 and 6 whose reported segment, H or N component differs."""
    both = declared.filter(F.col("segment").isin(4, 6)).join(reported.withColumnsRenamed({"segment": "r_segment", "genotypes": "r_genotypes"}), "accession")
    mine = determining_component(F.col("segment"), F.array("genotype"))
    theirs = determining_component(F.col("segment"), F.col("r_genotypes"))
    good = (F.col("segment") == F.col("r_segment")) & (mine == theirs)
    return both.filter(~F.coalesce(good, F.lit(False))).select("accession").distinct()


def append_metadata(main: DataFrame, new: DataFrame) -> DataFrame:
    """main and the rows of new in main's columns, absent ones null."""
    return main.unionByName(new.select(*[c for c in new.columns if c in main.columns]), allowMissingColumns=True).select(*main.columns)


def append_missing(main: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """main and those rows of new whose key it lacks, each key once."""
    seen = main.select(F.col(key).alias("__k")).distinct()
    return main.unionByName(new.join(seen, new[key] == seen["__k"], "left_anti").dropDuplicates([key]).select(*main.columns))


def reconcile(left: DataFrame, right: DataFrame, key: str, right_key: str | None = None) -> DataFrame:
    """(key, side): keys that only one table has, `left` or `right`."""
    a, b = left.select(F.col(key).alias("key")).distinct(), right.select(F.col(right_key or key).alias("key")).distinct()
    return a.exceptAll(b).withColumn("side", F.lit("left")).unionByName(b.exceptAll(a).withColumn("side", F.lit("right")))


def reference_lookup(wanted: DataFrame, records: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """(records that are wanted, wanted keys without a record)."""
    keys = wanted.select(key).distinct()
    return records.join(keys, key, "left_semi"), keys.join(records, key, "left_anti")


def union_bag(*tables: DataFrame) -> DataFrame:
    """All rows of tables with equal headers, repeated ones too."""
    out = tables[0]
    for t in tables[1:]:
        out = out.unionByName(require(t, *out.columns).select(*out.columns))
    return out


def union_distinct(*tables: DataFrame) -> DataFrame:
    """Distinct rows of tables with equal headers."""
    return union_bag(*tables).distinct()


def header_accessions(df: DataFrame, column: str = "header") -> DataFrame:
    """Distinct NCBI accessions in headers."""
    return df.select(ncbi_accession(F.concat(F.lit(">"), F.regexp_replace(column, "^>", ""))).alias("accession")).filter("accession is not null").distinct()


def sample_n(df: DataFrame, n: int, seed: int = 0, key: list[str] | None = None) -> DataFrame:
    """n rows without replacement (all if there are fewer); a sampling operator, so the limit is its purpose.

    Rows are taken in the order of a hash of the seed and the key columns (all columns, which then can't be maps, without a key), so a seed gives the same rows
    however the table is partitioned; equal keys stand in for one another.
    """
    columns = [F.col(f"`{c}`") for c in (key or df.columns)]
    return df.orderBy(F.xxhash64(F.lit(seed), *columns), *columns).limit(n)
