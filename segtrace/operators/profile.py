"""Profiles of clusters: counted values, date ranges, roll-ups of distributions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dist import largest_remainder
from ..functions.text import any_token, partial_date


def _ordered_dist(rows: DataFrame, group: list[str], key: str, weight: str, order: str, out: str) -> DataFrame:
    """(group, out): one distribution per group, keys in `order`."""
    cells = F.sort_array(F.collect_list(F.struct(F.col(order).alias("o"), F.col(key).cast("string").alias("key"), F.col(weight).cast("double").alias("weight"))))
    return rows.groupBy(*group).agg(F.transform(cells, lambda x: F.struct(x["key"].alias("key"), x["weight"].alias("weight"))).alias(out))


def value_counts(members: DataFrame, group: str, columns: list[str], order: str) -> DataFrame:
    """(group, a distribution for each column): counts of distinct values, in the order each first appears.

    Null values are left out; a group whose column is all null has null there. Counts are aggregated before
    anything is collected, so a list is as long as its distinct values.
    """
    tall = members.select(group, F.col(order).alias("__o"), F.explode(F.array(*[F.struct(F.lit(c).alias("attr"), F.col(c).cast("string").alias("key")) for c in columns])).alias("cell"))
    counts = tall.select(group, "cell.attr", "cell.key", "__o").filter("key is not null").groupBy(group, "attr", "key").agg(F.count("*").alias("n"), F.min("__o").alias("first"))
    cells = F.sort_array(F.collect_list(F.struct("first", "key", F.col("n").cast("double").alias("weight"))))
    dists = counts.groupBy(group, "attr").agg(F.transform(cells, lambda x: F.struct(x["key"].alias("key"), x["weight"].alias("weight"))).alias("dist"))
    return dists.groupBy(group).pivot("attr", columns).agg(F.first("dist"))


def date_range(members: DataFrame, group: str, date: str, order: str) -> DataFrame:
    """(group, date_min, date_max, collection_date): earliest and latest partial dates as they were written, `a - b`,
    one value if equal, Unknown if none is a date. Of equal dates the first in order counts."""
    d = partial_date(F.col(date))
    raw = F.trim(date)
    low = F.min_by(F.when(d.isNotNull(), raw), F.when(d.isNotNull(), F.struct(d.alias("d"), F.col(order).alias("o"))))
    high = F.max_by(F.when(d.isNotNull(), raw), F.when(d.isNotNull(), F.struct(d.alias("d"), (-F.col(order)).alias("o"))))
    out = members.groupBy(group).agg(F.min(d).alias("date_min"), F.max(d).alias("date_max"), low.alias("low"), high.alias("high"))
    text = F.when(F.col("low").isNull(), "Unknown").when(F.col("low") == F.col("high"), F.col("low")).otherwise(F.concat("low", F.lit(" - "), "high"))
    return out.select(group, "date_min", "date_max", text.alias("collection_date"))


def cluster_profile(members: DataFrame, metadata: DataFrame) -> DataFrame:
    """The profile of each cluster: representative, counts of genotypes, segments, hosts and countries, date range."""
    meta = metadata.select(F.col("ACCESSION").alias("__a"), F.col("GENOTYPE").alias("genotypes"), F.col("SEGMENT").alias("segments"), F.col("HOST").alias("hosts"), F.col("COUNTRY").alias("countries"), F.col("COLLECTION_DATE").alias("__d"))
    rows = members.join(meta, members["accession"] == meta["__a"], "left")
    counts = value_counts(rows, "cluster", ["genotypes", "segments", "hosts", "countries"], "member_idx")
    dates = date_range(rows, "cluster", "__d", "member_idx")
    reps = members.groupBy("cluster").agg(F.max(F.when(F.col("is_rep"), F.col("accession"))).alias("representative"))
    return reps.join(counts, "cluster", "left").join(dates, "cluster", "left").select("cluster", "representative", "genotypes", "segments", "hosts", "countries", "date_min", "date_max", "collection_date")


def exploded(df: DataFrame, keys: list[str], dist: str) -> DataFrame:
    """(keys, key, weight): one row per entry of a distribution."""
    return df.select(*keys, F.explode(dist).alias("__e")).select(*keys, F.col("__e.key").alias("key"), F.col("__e.weight").alias("weight"))


def rollup_distribution(entries: DataFrame, keys: list[str], level: str, out: str, drop_unknown: bool = True, shares: bool = True) -> DataFrame:
    """(keys, out): entries(keys, weight, level) summed by level into a distribution ordered by key; shares of two decimals."""
    rows = entries.filter(F.col(level).isNotNull() & (F.col(level) != "Unknown")) if drop_unknown else entries
    sums = rows.groupBy(*keys, F.col(level).alias("key")).agg(F.sum("weight").alias("weight"))
    dists = _ordered_dist(sums, keys, "key", "weight", "key", out)
    return dists.withColumn(out, largest_remainder(F.col(out))) if shares else dists


def subtypes(df: DataFrame, group: str, genotypes: str) -> DataFrame:
    """(group, h, n, mixed): distinct H and N tokens of all keys of a distribution, and whether one says mixed."""
    keys = df.select(group, F.explode(F.transform(genotypes, lambda x: x["key"])).alias("g"))
    token = lambda letter: F.sort_array(F.collect_set(any_token(F.col("g"), letter)))
    return keys.groupBy(group).agg(token("H").alias("h"), token("N").alias("n"), F.bool_or(F.lower("g").contains("mixed")).alias("mixed"))


def field_keys(report: DataFrame, field: str) -> DataFrame:
    """Rows with an identity, with `<field>_keys`: the keys of a distribution."""
    return report.filter("pident is not null").withColumn(f"{field}_keys", F.transform(field, lambda x: x["key"]))


def cluster_field(profiles: DataFrame, field: str, clusters: DataFrame | None = None, key: str = "cluster") -> DataFrame:
    """(key, field) of the profiles, of those that clusters(key) lists if given."""
    rows = profiles if clusters is None else profiles.join(clusters.select(key).distinct(), key, "left_semi")
    return rows.select(key, field)


def distinct_in_order(df: DataFrame, column: str, order: str) -> DataFrame:
    """(column, first): distinct values with the place each first appears at."""
    return df.groupBy(column).agg(F.min(order).alias("first"))


def collected(df: DataFrame, key: Column | str, value: str, order: str) -> DataFrame:
    """(key, values): the values of each key in order."""
    cells = F.sort_array(F.collect_list(F.struct(F.col(order).alias("o"), F.col(value).alias("v"))))
    return df.groupBy(key).agg(F.transform(cells, lambda x: x["v"]).alias("values"))


def cluster_composition(report: DataFrame, members: DataFrame, metadata: DataFrame) -> DataFrame:
    """Members, with metadata, of the clusters that occur in reports: distinct by cluster and accession."""
    seen = report.select("cluster").filter("cluster is not null").distinct()
    rows = members.join(seen, "cluster", "left_semi").select("cluster", "accession", "is_rep").dropDuplicates(["cluster", "accession"])
    return rows.join(metadata, rows["accession"] == metadata["ACCESSION"]).drop(metadata["ACCESSION"])
