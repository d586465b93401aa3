"""Jobs: identification, roll-up, routing, database build and update. All samples are handled in one plan."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dist import EMPTY, clean, keys, largest_remainder, serialize, to_proportions
from ..functions.domain import CLUSTER_IDENTITY, UPDATE_LENGTHS
from ..functions.text import ambiguous_percent, header_accession, known, length_class, segment_number
from ..operators import assign, dims, profile, quality, samples, similarity
from ..shared import stored


def _one(c: str):
    """A scalar column as a distribution of one key; null stays."""
    return F.when(F.col(c).isNotNull(), F.array(F.struct(F.col(c).cast("string").alias("key"), F.lit(1.0).alias("weight")))).otherwise(F.lit(None).cast(EMPTY))


def identify(sequences: DataFrame, members: DataFrame | None, representatives: DataFrame, database: DataFrame, profiles: DataFrame, metadata: DataFrame, low: int = 400, high: int = 4000, k: int = 11, skip_clusters: bool = False, expected: float | None = None) -> DataFrame:
    """The ID report of all samples: one row for each sequence of accepted length.

    sequences(sample_id, ord, header, seq, length), representatives(id, seq) and database(id, seq). Tier 1 is the cluster of a sequence: the one in which
    members(accession, cluster, is_rep, identity) has it, by its internal id (`sample/Seq-n`) or header, as a clustering of database and samples together gives; else the nearest
    representative with 99 % over the shorter. Without members (None) all go by the representatives. Tier 2 is the best local hit
    among representatives, if it has 90 % or more; tier 3 the best local hit in the whole database, whatever its identity. A
    hit needs a common word of k letters and, with expected, an e-value of at most that. Each tier gets what is left.
    """
    kept, _ = assign.length_filter(sequences, low, high)
    ids = assign.assign_internal_ids(assign.last_wins(kept, ["sample_id", "header"]))
    ids = ids.withColumn("id", F.concat_ws("/", "sample_id", "internal_id"))
    names = ids.select("sample_id", F.col("header").alias("sample_name"), F.col("id").alias("internal_id"))
    dist = ("segments", "genotypes", "hosts", "countries")

    def profiled(df: DataFrame) -> DataFrame:
        segment, genotype, host, country = dist
        return df.select("internal_id", "cluster", "representative", "pident", F.col(segment).alias("segment"), to_proportions(F.col(genotype)).alias("genotype"), to_proportions(F.col(host)).alias("host"), to_proportions(F.col(country)).alias("country"), "collection_date")

    tiers, left = [], ids
    if not skip_clusters:
        left = stored(left, "sequences")
        tier, listed = left, None
        if members is not None:
            listed = stored(_listed(left, members, profiles), "listed")
            tiers.append(("CD-HIT", profiled(listed)))
            tier = assign.unassigned(left, listed, "id", "internal_id")
        near = similarity.near_targets(tier.select("id", "seq"), representatives, CLUSTER_IDENTITY, k, low)
        near = assign.first_wins(near, ["qseqid"], [F.desc("pident"), F.asc("sseqid")])
        first = stored(near.select(F.col("qseqid").alias("internal_id"), F.col("sseqid").alias("representative"), "pident"), "members")
        tiers.append(("CD-HIT", profiled(assign.attach_cluster_profile(first, profiles, "representative", "representative"))))
        left = stored(assign.unassigned(tier, first, "id", "internal_id"), "left")  # several steps need it, letters and all
        hits = similarity.similarity_join(left.select("id", "seq"), representatives, 0.0, k, expected=expected)
        second = stored(assign.annotate_by_representative(hits, profiles), "hits")
        tiers.append(("C-BLAST", profiled(second)))
        left = stored(assign.unassigned(left, second, "id", "internal_id"), "left")
    hits = similarity.similarity_join(left.select("id", "seq"), database, 0.0, k, expected=expected)
    third = assign.annotate_by_metadata(hits, metadata)
    third = third.select("internal_id", F.lit("UNCLUSTERED").alias("cluster"), "representative", "pident", *[_one(c).alias(c) for c in ("segment", "genotype", "host", "country")], "collection_date")
    tiers.append(("L-BLAST", third))
    report = assign.compile_report(names, tiers)
    return report.withColumns({"representative": F.coalesce("representative", F.lit("Unassigned")), "collection_date": known(F.col("collection_date"))})


def _listed(ids: DataFrame, members: DataFrame, profiles: DataFrame) -> DataFrame:
    """Sequences that the cluster table has as members, with their cluster's profile and representative; an internal id goes before a header."""
    names = ids.select("id", F.explode(F.array(F.struct(F.lit(0).alias("o"), F.col("id").alias("name")), F.struct(F.lit(1).alias("o"), F.col("header").alias("name")))).alias("x")).select("id", "x.*")
    found = assign.assign_clusters(names, members, "name").filter(F.col("cluster") != ">Unassigned")
    found = assign.first_wins(found, ["id"], [F.asc("o"), F.desc_nulls_last("pident"), F.asc("cluster")])
    return assign.attach_cluster_profile(found.select(F.col("id").alias("internal_id"), "cluster", "pident"), profiles, "cluster", "cluster")


def report_rollup(report: DataFrame, geo: DataFrame, taxa: DataFrame, places: DataFrame, hosts: DataFrame, key: list[str]) -> DataFrame:
    """report with host_family, host_class, country_region and country_continent, as text shares.

    places and hosts are synonym tables (raw, canonical).
    """
    lookup = dims.taxa_lookup(taxa)

    def rolled(dist: str, synonyms: DataFrame, reference: DataFrame, levels: dict[str, object]) -> DataFrame:
        entries = dims.resolve(profile.exploded(report, key, dist), "key", synonyms, reference, "term")
        out = report.select(*key).distinct()
        for name, level in levels.items():
            found = level(entries)
            sums = profile.rollup_distribution(found, key, "level", name, shares=False)
            out = out.join(sums.withColumn(name, serialize(F.col(name))), key, "left")
        return out

    by_taxa = lambda level: lambda df: dims.rollup_taxa(df, "term", lookup, level, "level")
    by_geo = lambda mode: lambda df: dims.rollup_geo(df, "term", geo, mode, "level")
    a = rolled("host", hosts, taxa.select("name"), {"host_family": by_taxa("family"), "host_class": by_taxa("class")})
    b = rolled("country", places, geo.select(F.col("country").alias("name")), {"country_region": by_geo("region"), "country_continent": by_geo("continent")})
    out = report.join(a, key, "left").join(b, key, "left")
    return out.withColumns({c: F.coalesce(c, F.lit("Unknown")) for c in ("host_family", "host_class", "country_region", "country_continent")})


def route_samples(report: DataFrame, consensus: bool = True, **options) -> DataFrame:
    """Routing flags for the rows of a report with a segment; see operators.samples.route."""
    rows = samples.report_segment(report).withColumn("genotypes", keys(F.col("genotype")))
    return samples.route(rows, samples.sample_genotype(rows), consensus, **options)


def demultiplex(sequences: DataFrame, pattern: str, force: bool = False) -> DataFrame:
    """Sequences with sample_id; an error that counts unmatched headers unless forced."""
    matched, rest = samples.demultiplex(sequences, pattern)
    if not force and (n := rest.count()):
        raise ValueError(f"{n} headers do not match the pattern")
    return matched


def build_cluster_db(sequences: DataFrame, metadata: DataFrame, identity: float = CLUSTER_IDENTITY, k: int = 11) -> tuple[DataFrame, DataFrame]:
    """(members, profiles) of the clusters of sequences(accession, seq)."""
    led = similarity.identity_clusters(sequences.select(F.col("accession").alias("id"), "seq"), identity, k)
    rows = led.join(sequences.select(F.col("accession").alias("id"), F.length("seq").alias("length")), "id")
    members = rows.select(F.concat(F.lit(">Cluster "), "leader").alias("cluster"), F.col("id").alias("accession"), "length", (F.col("id") == F.col("leader")).alias("is_rep"))
    members = assign.assign_internal_ids(members.withColumn("o", F.struct(~F.col("is_rep"), -F.col("length"), "accession")), "cluster", "o", "")
    members = members.withColumn("member_idx", F.col("internal_id").cast("int") - 1).drop("internal_id", "o")
    return members, profile.cluster_profile(members, metadata)


def curate_update(new_metadata: DataFrame, new_sequences: DataFrame, spark_dims: DataFrame | None = None, n_segments: int = 8, max_ambiguous: float = 10.0) -> tuple[DataFrame, DataFrame]:
    """(metadata, sequences) of an update that pass: complete cells, whole genotypes, lengths, complete assemblies, few ambiguities."""
    bounds = spark_dims if spark_dims is not None else dims.segment_dim(new_metadata.sparkSession, UPDATE_LENGTHS)
    rows = new_metadata.withColumn("SEGMENT", segment_number(F.col("SEGMENT").cast("string"))).withColumn("LENGTH", F.col("LENGTH").try_cast("int"))
    rows = quality.drop_incomplete(rows, "SEGMENT", "GENOTYPE", "HOST", "COUNTRY").withColumn("GENOTYPE", F.replace("GENOTYPE", F.lit("v"), F.lit("")))
    rows = stored(rows, "update")
    bad = quality.offending_genotypes(rows)
    rows = rows.join(bad, "ACCESSION", "left_anti")
    outliers = quality.length_outliers(rows, bounds, "SEGMENT", "num", "LENGTH").select("ACCESSION")
    rows = stored(quality.complete_groups(rows.join(outliers, "ACCESSION", "left_anti"), "ASSEMBLY", n_segments), "update")
    seqs = new_sequences.withColumn("accession", header_accession(F.col("header"))).filter(F.coalesce(ambiguous_percent(F.col("seq")) <= max_ambiguous, F.lit(False)))
    seqs = stored(seqs.join(rows.select(F.col("ACCESSION").alias("accession")), "accession", "left_semi"), "update-sequences")
    return rows.join(seqs.select(F.col("accession").alias("ACCESSION")), "ACCESSION", "left_semi"), seqs


def update_db(main_metadata: DataFrame, main_sequences: DataFrame, metadata: DataFrame, sequences: DataFrame, report: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(metadata, sequences) with what a curated update adds, without accessions whose report contradicts their metadata.

    report(accession, segment int, genotypes array) comes from identify().
    """
    declared = metadata.select(F.col("ACCESSION").alias("accession"), F.col("SEGMENT").alias("segment"), F.col("GENOTYPE").alias("genotype"))
    bad = stored(quality.crosscheck_internal(declared, report).unionByName(quality.crosscheck_determining(declared, report)).distinct(), "contradicted")
    new = metadata.join(bad.withColumnRenamed("accession", "ACCESSION"), "ACCESSION", "left_anti")
    seqs = sequences.join(bad, "accession", "left_anti")
    fresh = quality.append_missing(main_metadata, quality.append_metadata(main_metadata.limit(0), new), "ACCESSION")
    return fresh, main_sequences.unionByName(seqs.join(main_sequences.select("accession"), "accession", "left_anti"), allowMissingColumns=True)


def reconcile_db(metadata: DataFrame, sequences: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(differences, sequences that the metadata names)."""
    diff = quality.reconcile(metadata, sequences, "ACCESSION", "accession")
    return diff, sequences.join(metadata.select(F.col("ACCESSION").alias("accession")), "accession", "left_semi")


def batch_report(report: DataFrame, inputs: DataFrame, mutations: DataFrame, clades: DataFrame, constellations: DataFrame) -> DataFrame:
    """One summary row for each sample of inputs(sample_id, input_file, file_tag); a sample without a report row failed."""
    rows = samples.report_segment(report).withColumn("genotypes", keys(F.col("genotype")))
    genotype = samples.sample_genotype(rows).select("sample_id", "genotype")
    alive = report.select("sample_id").distinct().withColumn("status", F.lit("ok"))
    found = samples.mutation_strings(mutations).withColumnRenamed("sample", "sample_id")
    summary = samples.batch_summary(inputs, alive, genotype, clades, found, samples.constellation_summary(constellations))
    return summary.withColumn("status", F.when(F.col("status") == "", "failed").otherwise(F.col("status")))


def segment_background(report: DataFrame, sequences: DataFrame, bounds: DataFrame) -> DataFrame:
    """Report rows with segment name and rank, length and its class, and rounded shares, in segment order."""
    rows = assign.attach_length(samples.report_segment(report), sequences)
    rows = rows.join(bounds, rows["segment"] == bounds["num"], "left")
    rows = rows.withColumn("length_class", length_class(F.col("length"), F.col("min_len"), F.col("max_len")))
    shares = {c: largest_remainder(clean(F.col(c))) for c in ("genotype", "host", "country")}
    return rows.withColumns(shares).withColumn("rank", samples.segment_order(F.col("name"))).orderBy("sample_id", "rank", "sample_name")


def mutation_table(markers: DataFrame, effects: DataFrame | None = None) -> DataFrame:
    return samples.mutations_of_interest(markers, effects).orderBy(*samples.marker_order())


def clade_table(clades: DataFrame) -> DataFrame:
    """All clade rows with their subtype; an absent clade is N/A."""
    return clades.select("seq_name", F.coalesce(F.nullif(F.trim("clade"), F.lit("")), F.lit("N/A")).alias("clade"), "subtype").orderBy("subtype", "seq_name")


