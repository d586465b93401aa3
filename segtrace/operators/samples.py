"""Per-sample work: demultiplexing, genotype, routing, clades, mutations, constellations, summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.dist import first_key
from ..functions.domain import CLADE_SUBTYPES, CONSTELLATION_CLADE, CONSTELLATION_SEGMENTS, LOCUS_ORDER, SEGMENTS, SUMMARY_FIELDS
from ..functions.text import leading_token, mutation_parts, safe_name, sample_id, segment_name
from ..schemas import with_defaults
from .dims import mutation_dim


def demultiplex(sequences: DataFrame, pattern: str, header: str = "header") -> tuple[DataFrame, DataFrame]:
    """(sequences with sample_id, headers without one)."""
    tagged = sequences.withColumn("sample_id", sample_id(F.col(header), pattern))
    return tagged.filter("sample_id is not null"), tagged.filter("sample_id is null").select(header)


def safe_file_names(ids: DataFrame, column: str = "sample_id") -> DataFrame:
    """(column, file_name): safe names; of ids with the same one, all but the first get a part of their SHA-1."""
    rows = ids.select(column).distinct().withColumn("safe", safe_name(F.col(column)))
    n = F.row_number().over(Window.partitionBy("safe").orderBy(column))
    return rows.select(column, F.when(n == 1, F.col("safe")).otherwise(F.concat("safe", F.lit("_"), F.substring(F.sha1(column), 1, 10))).alias("file_name"))


def chosen_contigs(report: DataFrame, chosen: DataFrame, key: str = "sample_name") -> DataFrame:
    """Report rows of the chosen contigs; samples without a chosen contig keep all rows."""
    some = chosen.select("sample_id").distinct()
    return report.join(chosen.select(key), key, "left_semi").unionByName(report.join(some, "sample_id", "left_anti"))


def sample_genotype(rows: DataFrame, group: str = "sample_id", segment: str = "segment", genotypes: str = "genotypes") -> DataFrame:
    """(group, h, n, genotype): the one H token of segment 4 and the one N token of segment 6, else Undetermined.

    genotypes is an array; all rows and all keys of a sample count.
    """
    rows = rows.select(group, segment, F.explode_outer(genotypes).alias("g"))
    token = lambda number, letter: F.collect_set(F.when(F.col(segment) == number, leading_token(F.col("g"), letter)))
    one = lambda c: F.when(F.size(c) == 1, F.get(c, F.lit(0)))
    sets = rows.groupBy(group).agg(token(4, "H").alias("hs"), token(6, "N").alias("ns"))
    out = sets.select(group, one("hs").alias("h"), one("ns").alias("n"))
    both = F.concat(F.coalesce("h", F.lit("")), F.coalesce("n", F.lit("")))
    return out.withColumn("genotype", F.when(both == "", "Undetermined").otherwise(both))


def sample_segments(rows: DataFrame, group: str = "sample_id", segment: str = "segment", name: str = "sample_name", reference: str = "representative", order: str = "ord") -> DataFrame:
    """(group, segment, segment_name, names, refs): sequences and references of each segment, in order."""
    cells = F.sort_array(F.collect_list(F.struct(F.col(order).alias("o"), F.col(name).alias("n"), F.col(reference).alias("r"))))
    out = rows.filter(F.col(segment).between(1, 8)).groupBy(group, segment).agg(cells.alias("cells"))
    return out.select(group, segment, segment_name(F.col(segment)).alias("segment_name"), F.transform("cells", lambda x: x["n"]).alias("names"), F.transform("cells", lambda x: x["r"]).alias("refs"))


def route(rows: DataFrame, genotypes: DataFrame, consensus: bool = True, force_markers: bool = True, force_constellation: bool = False, clades: DataFrame | None = None) -> DataFrame:
    """rows with to_clade, to_markers and to_constellation.

    Clade: HA sequences (consensus) with a subtype in the short list. Markers: H5 samples, or all if forced. Constellation: H5
    samples whose clade is the qualifying one, or (contigs) all if forced.
    """
    kept = rows.filter("segment is not null").join(genotypes.select("sample_id", "h"), "sample_id", "left")
    if clades is not None:
        kept = kept.join(clades.select("sample_id", "clade"), "sample_id", "left")
    clade = F.col("clade") if clades is not None else F.lit(None).cast("string")
    subtype = F.exists("genotypes", lambda g: leading_token(g, "H").isin(*CLADE_SUBTYPES))
    h5 = F.coalesce(F.col("h") == "H5", F.lit(False))
    return kept.withColumns(
        {
            "to_clade": F.lit(consensus) & (F.col("segment") == 4) & F.coalesce(subtype, F.lit(False)),
            "to_markers": (h5 & F.lit(consensus)) | F.lit(force_markers),
            "to_constellation": F.coalesce(h5 & F.lit(consensus) & (clade == CONSTELLATION_CLADE), F.lit(False)) | F.lit(force_constellation),
        }
    )


def clade_decision(samples: DataFrame, clades: DataFrame) -> DataFrame:
    """(sample_id, clade): the clade of the sample's HA, Unassigned, Unassigned by error, or Non-applicable.

    samples(sample_id, h, ha_names array), clades(seq_name, clade, errors).
    """
    fit = F.col("h").isin(*CLADE_SUBTYPES) & (F.size(F.array_distinct("ha_names")) == 1)
    rows = samples.withColumn("fit", F.coalesce(fit, F.lit(False))).withColumn("ha", F.get("ha_names", F.size("ha_names") - 1))
    found = rows.join(clades.dropDuplicates(["seq_name"]), F.col("ha") == F.col("seq_name"), "left")
    blank = lambda c: F.coalesce(F.trim(c), F.lit("")) == ""
    decision = F.when(~F.col("fit"), "Non-applicable").when(F.col("seq_name").isNull(), "Unassigned").when(~blank("errors"), "Unassigned by error").when(blank("clade"), "Unassigned").otherwise(F.trim("clade"))
    return found.select("sample_id", decision.alias("clade"))


def _locus_rank(locus: Column) -> Column:
    rank = F.lit(len(LOCUS_ORDER))
    for k, name in enumerate(LOCUS_ORDER):
        rank = F.when(locus == name, k).otherwise(rank)
    return rank


def ordered_labels(labels: Column) -> Column:
    """Distinct labels by rank of their locus, then locus, then label."""
    cells = F.transform(F.filter(F.transform(labels, lambda x: F.trim(x)), lambda x: x != ""), lambda x: F.struct(_locus_rank(F.substring_index(x, ":", 1)).alias("r"), F.substring_index(x, ":", 1).alias("l"), x.alias("label")))
    return F.transform(F.array_sort(F.array_distinct(cells)), lambda x: x["label"])


def mutations_of_interest(markers: DataFrame, effects: DataFrame | None = None) -> DataFrame:
    """(sample, locus, segment, mutation, label, effect): distinct markers that the catalogue lists for their own segment.

    Repeats go first, then the distinct texts are taken apart, and an equi-join with the catalogue says which count and what they are called.
    """
    rows = markers.select("sample", "raw").distinct().select("sample", mutation_parts(F.col("raw")).alias("m")).filter("m is not null")
    rows = rows.select("sample", "m.locus", "m.segment", "m.mutation").distinct()
    return rows.join(mutation_dim(markers.sparkSession, effects), ["segment", "mutation"]).select("sample", "locus", "segment", "mutation", "label", "effect")


def marker_order() -> list[Column]:
    """Sort keys of marker tables: sample, locus, mutation."""
    return [F.col("sample"), _locus_rank(F.col("locus")), F.col("locus"), F.col("mutation")]


def mutation_strings(found: DataFrame) -> DataFrame:
    """(sample, mutations_of_interest): labels in report order, joined by `;`."""
    return found.groupBy("sample").agg(F.array_join(ordered_labels(F.collect_set("label")), ";").alias("mutations_of_interest"))


def segment_order(segment: Column) -> Column:
    """Rank of a segment acronym; unknown ones last."""
    rank = F.lit(999)
    for k, name in enumerate(SEGMENTS, 1):
        rank = F.when(F.trim(segment) == name, k).otherwise(rank)
    return rank


def _valid(c: str, blank: bool) -> Column:
    text = F.trim(F.col(f"`{c}`"))
    return text.isNotNull() & (text != "?") & ((text != "") if blank else F.lit(True))


def constellation_rows(raw: DataFrame, names: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(rows, skipped): rows with trimmed cells, sub-genotype `N/A` by default, and `constellation` for several valid
    segments or `expanded` for one; rows without any are skipped with a reason.

    names(segment_name, header), optional, are the sequences of the sample: a row with one valid segment gets the header of
    that segment's only sequence, another the stem that all headers share, if there is one.
    """
    cells = F.size(F.filter(F.array(*[F.when(_valid(c, False), F.lit(c)) for c in CONSTELLATION_SEGMENTS]), lambda x: x.isNotNull()))
    found = F.filter(F.array(*[F.when(_valid(c, True), F.lit(c)) for c in CONSTELLATION_SEGMENTS]), lambda x: x.isNotNull())
    rows = raw.withColumns({"n_valid": cells, "__found": found, "__name": F.trim("`Sample Name`")})
    if names is not None:
        one = names.groupBy("segment_name").agg(F.count("*").alias("n"), F.first(F.trim("header")).alias("only")).filter("n = 1")
        stem = F.when(F.col("header").endswith(F.concat(F.lit("_"), "segment_name")), F.regexp_replace("header", F.concat(F.lit("_"), F.col("segment_name"), F.lit("$")), ""))
        stems = names.select(F.regexp_replace(stem, "^>", "").alias("stem")).agg(F.collect_set("stem").alias("stems")).select(F.when(F.size("stems") == 1, F.get("stems", F.lit(0))).alias("__stem"))
        rows = rows.join(one.select(F.col("segment_name").alias("__s"), "only"), (F.size("__found") == 1) & (F.get("__found", F.lit(0)) == F.col("__s")), "left").join(F.broadcast(stems))
        rows = rows.withColumn("__name", F.coalesce("only", "__stem", "__name")).drop("__s", "only", "__stem")
    text = lambda c, default="": F.coalesce(F.nullif(F.trim(F.col(f"`{c}`")), F.lit("")), F.lit(default))
    rows = with_defaults(rows, **{"Sub-genotype": "", "Notes": ""})
    good = rows.filter("n_valid > 0").select(
        F.col("__name").alias("sample_name"), text("Genotype").alias("genotype"), text("Sub-genotype", "N/A").alias("sub_genotype"), *[text(c).alias(c) for c in CONSTELLATION_SEGMENTS], text("Notes").alias("notes"),
        F.when(F.col("n_valid") > 1, "constellation").otherwise("expanded").alias("output_format"), "ord",
    )
    return good, rows.filter("n_valid = 0").select(F.col("__name").alias("sample_name"), F.lit("no_valid_segment").alias("reason"))


def constellation_summary(rows: DataFrame, group: str = "sample_id") -> DataFrame:
    """One row for each sample: genotype and sub-genotype of the row with most valid segments, blanks from the first row
    that has them; each segment from the first row where it is valid."""
    score = sum((_valid(c, True).cast("int") for c in CONSTELLATION_SEGMENTS), F.lit(0))
    first = lambda c, ok: F.min_by(F.when(ok, F.trim(F.col(f"`{c}`"))), F.when(ok, F.col("ord")))
    full = lambda c: F.coalesce(F.trim(F.col(c)), F.lit("")) != ""
    best = lambda c: F.max_by(F.trim(c), F.struct(score.alias("s"), (-F.col("ord")).alias("o")))
    pick = lambda c: F.coalesce(F.nullif(best(c), F.lit("")), first(c, full(c)), F.lit(""))
    segments = [F.coalesce(first(c, _valid(c, True)), F.lit("")).alias(f"genin2_{c.lower()}") for c in CONSTELLATION_SEGMENTS]
    return rows.groupBy(group).agg(pick("genotype").alias("genin2_genotype"), pick("sub_genotype").alias("genin2_subgenotype"), *segments)


def batch_summary(samples: DataFrame, *parts: DataFrame) -> DataFrame:
    """One row of SUMMARY_FIELDS for each sample; parts are tables by sample_id; absent fields are empty."""
    out = samples
    for part in parts:
        out = out.join(part, "sample_id", "left")
    return with_defaults(out, **dict.fromkeys(SUMMARY_FIELDS, "")).select("sample_id", *SUMMARY_FIELDS)


def batch_counts(summary: DataFrame) -> DataFrame:
    """One row: samples that went well and that failed."""
    return summary.agg(F.count_if(F.lower("status") == "ok").alias("n_ok"), F.count_if(F.lower("status") != "ok").alias("n_failed"))


def successful(summary: DataFrame) -> DataFrame:
    """Rows with status ok and a tag."""
    return summary.filter((F.lower(F.trim("status")) == "ok") & (F.coalesce(F.trim("file_tag"), F.lit("")) != ""))


def report_segment(df: DataFrame, column: str = "segment") -> DataFrame:
    """df with the segment distribution replaced by its first key as a number."""
    return df.withColumn(column, first_key(F.col(column)).try_cast("int"))
