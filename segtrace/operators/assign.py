"""Identification: numbering, tiers, best hits, and the merged report."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.dist import EMPTY, to_proportions
from ..functions.domain import CONTIG_FLOOR, CONTIG_STEP, REPRESENTATIVE_IDENTITY
from ..functions.text import known
from ..shared import stored


def length_filter(df: DataFrame, low: int = 400, high: int = 4000, column: str = "length") -> tuple[DataFrame, DataFrame]:
    """(kept, rejected) by low <= length <= high; a null length is rejected."""
    fits = F.coalesce(F.col(column).between(low, high), F.lit(False))
    return df.filter(fits), df.filter(~fits)


def numbered(df: DataFrame, group: str, order: str, out: str, most_rows: int = 5_000_000) -> DataFrame:
    """df with `out`: the row's place (from 1) in its group by order. Rows of one group that tie in order are told apart arbitrarily.

    Groups of up to most_rows are sorted by a task each. If any is larger, the rows are cut into ranges of (group, order), numbered
    within each, and the counts of the ranges before are added, so no task sorts a whole group.
    """
    place = F.row_number().over(Window.partitionBy(group).orderBy(order))
    largest = df.groupBy(group).count().agg(F.max("count")).first()[0] or 0
    if largest <= most_rows:
        return df.withColumn(out, place.cast("long"))
    cut = stored(df.repartitionByRange(group, order).withColumn("__part", F.spark_partition_id()), "ranges")
    counts = cut.groupBy(F.col(group).alias("__g"), F.col("__part").alias("__p")).agg(F.count("*").alias("__n"))
    before = F.sum("__n").over(Window.partitionBy("__g").orderBy("__p").rowsBetween(Window.unboundedPreceding, -1))
    counts = counts.withColumn("__before", F.coalesce(before, F.lit(0))).drop("__n")
    rows = cut.withColumn(out, F.row_number().over(Window.partitionBy(group, "__part").orderBy(order)))
    rows = rows.join(counts, rows[group].eqNullSafe(counts["__g"]) & (F.col("__part") == F.col("__p")))
    return rows.withColumn(out, (F.col(out) + F.col("__before")).cast("long")).drop("__part", "__g", "__p", "__before")


def assign_internal_ids(df: DataFrame, group: str = "sample_id", order: str = "ord", prefix: str = "Seq-") -> DataFrame:
    """Adds internal_id: prefix and the row's place in its group."""
    return numbered(df, group, order, "__n").withColumn("internal_id", F.concat(F.lit(prefix), F.col("__n").cast("string"))).drop("__n")


def first_wins(df: DataFrame, keys: list[str], order: list) -> DataFrame:
    """One row for each key: the first in order. (dropDuplicates has no order.)"""
    n = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("__n", n).filter("__n = 1").drop("__n")


def last_wins(df: DataFrame, keys: list[str], order: str = "ord") -> DataFrame:
    return first_wins(df, keys, [F.desc(order)])


def top_targets(df: DataFrame, k: int, query: str, order: list) -> DataFrame:
    """At most k rows for each query, in order; adds rank."""
    n = F.row_number().over(Window.partitionBy(query).orderBy(*order))
    return df.withColumn("rank", n).filter(F.col("rank") <= k)


def best_hit(hits: DataFrame, threshold: float = 0.0, query: str = "qseqid", evalue: str = "evalue", pident: str = "pident", order: list | None = None) -> DataFrame:
    """The hit of each query with the lowest e-value, then highest identity; the threshold is applied after the choice."""
    best = first_wins(hits, [query], [F.asc(evalue), F.desc(pident), *(order or [F.asc("sseqid")])])
    return best.filter(F.col(pident) >= threshold)


def best_row(df: DataFrame, group: str, value: str, order: str) -> DataFrame:
    """The row of each group with the highest value, nulls last, first in order on ties."""
    return first_wins(df, [group], [F.desc_nulls_last(value), F.asc(order)])


def best_contigs(df: DataFrame, floor: float = CONTIG_FLOOR, group: str = "sample_id", segment: str = "segment", length: str = "length", pident: str = "pident", order: str = "ord") -> DataFrame:
    """For each group and segment the longest contig, then the best identity, if it reaches the floor."""
    return first_wins(df, [group, segment], [F.desc(length), F.desc_nulls_last(pident), F.asc(order)]).filter(F.col(length) >= floor)


def contig_limit(chosen: DataFrame, start: int, floor: int = CONTIG_FLOOR, step: int = CONTIG_STEP, segments: int = 8, group: str = "sample_id", length: str = "length") -> DataFrame:
    """(group, min_used): the highest rung of start, start - step, ..., floor that the shortest chosen contig reaches
    when all segments are found, else the floor."""
    top = max(start, floor)
    rung = F.greatest(F.lit(floor), F.lit(top) - step * F.ceil(F.greatest(F.lit(0), F.lit(top) - F.min(length)) / step))
    return chosen.groupBy(group).agg(F.when(F.count("*") >= segments, rung).otherwise(F.lit(floor)).cast("int").alias("min_used"))


def assign_clusters(ids: DataFrame, members: DataFrame, id_col: str = "internal_id") -> DataFrame:
    """ids with the cluster each joined (as a member, not as its representative), identity; `>Unassigned` otherwise."""
    joined = members.filter(~F.col("is_rep")).select(F.col("accession").alias("__m"), F.col("cluster"), F.col("identity").alias("pident"))
    out = ids.join(joined, ids[id_col] == joined["__m"], "left").drop("__m")
    return out.withColumn("cluster", F.coalesce("cluster", F.lit(">Unassigned")))


def attach_cluster_profile(assigned: DataFrame, profiles: DataFrame, key: str = "cluster", profile_key: str = "cluster") -> DataFrame:
    """assigned with the profile of its cluster or representative; null where there is none."""
    other = [c for c in profiles.columns if c != profile_key and c not in assigned.columns]
    right = profiles.select(F.col(profile_key).alias("__k"), *other)
    return assigned.join(right, assigned[key] == right["__k"], "left").drop("__k")


def unassigned(all_rows: DataFrame, done: DataFrame, key: str = "internal_id", done_key: str | None = None) -> DataFrame:
    """Rows whose key no row of done has: what the next tier gets."""
    other = done.select(F.col(done_key or key).alias("__d")).filter(F.col("__d").isNotNull()).distinct()
    return all_rows.join(other, all_rows[key] == other["__d"], "left_anti")


def annotate_by_representative(hits: DataFrame, profiles: DataFrame, threshold: float = REPRESENTATIVE_IDENTITY) -> DataFrame:
    """Best hits that reach the threshold, with the profile of the cluster that the hit represents."""
    best = best_hit(hits, threshold).select(F.col("qseqid").alias("internal_id"), F.col("sseqid").alias("representative"), "pident")
    return attach_cluster_profile(best, profiles, "representative", "representative")


def annotate_by_metadata(hits: DataFrame, metadata: DataFrame, threshold: float = 0.0) -> DataFrame:
    """Best hits with genotype, segment, host, country and date of the accession that was hit."""
    best = best_hit(hits, threshold).select(F.col("qseqid").alias("internal_id"), F.col("sseqid").alias("representative"), "pident")
    meta = metadata.select(F.col("ACCESSION").alias("__a"), *[F.trim(F.col(c).cast("string")).alias(c.lower()) for c in ("GENOTYPE", "SEGMENT", "HOST", "COUNTRY")], known(F.col("COLLECTION_DATE")).alias("collection_date"))
    return best.join(meta, best["representative"] == meta["__a"], "left").drop("__a")


def restore_names(df: DataFrame, id_map: DataFrame, key: str) -> DataFrame:
    """df with internal ids in `key` replaced by the original headers; other values stay."""
    names = id_map.select(F.col("internal_id").alias("__i"), F.col("header").alias("__h"))
    return df.join(names, df[key] == names["__i"], "left").withColumn(key, F.coalesce("__h", key)).drop("__i", "__h")


def attach_length(report: DataFrame, sequences: DataFrame, key: str = "sample_name") -> DataFrame:
    """report with the length of the named sequence, 0 if there is none."""
    norm = lambda c: F.lower(F.trim(F.regexp_replace(c, "^>", "")))
    lengths = sequences.groupBy(norm(F.col("header")).alias("__h")).agg(F.max("length").alias("length"))
    return report.join(lengths, norm(report[key]) == lengths["__h"], "left").withColumn("length", F.coalesce("length", F.lit(0))).drop("__h")


def compile_report(ids: DataFrame, tiers: list[tuple[str, DataFrame]], key: str = "internal_id") -> DataFrame:
    """One row for each id: of the first tier that has it, with assigned_by; else `Unassigned`.

    Tiers may overlap; order decides. Columns of a tier that another lacks are null there.
    """
    merged = None
    for place, (name, rows) in enumerate(tiers):
        tagged = rows.withColumns({"assigned_by": F.lit(name), "__tier": F.lit(place)})
        merged = tagged if merged is None else merged.unionByName(tagged, allowMissingColumns=True)
    best = first_wins(merged, [key], [F.asc("__tier")]).drop("__tier")
    out = ids.join(best.withColumnRenamed(key, "__id"), ids[key] == F.col("__id"), "left").drop("__id")
    return out.withColumn("assigned_by", F.coalesce("assigned_by", F.lit("Unassigned")))


def shares(df: DataFrame, *columns: str) -> DataFrame:
    """Distributions as shares with three decimals; an empty one stays."""
    return df.withColumns({c: to_proportions(F.coalesce(F.col(c), F.lit(None).cast(EMPTY))) for c in columns})
