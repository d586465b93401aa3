"""Scans of the formats that sequence work uses. All are plain text splits: files are read in parallel."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions.dist import EMPTY, parse_distribution
from ..schemas import HITS, METADATA, require


def _ordered(df: DataFrame) -> DataFrame:
    """Adds file, and ord: rows in file order within a file. Must sit directly on the scan."""
    return df.select("*", F.col("_metadata.file_path").alias("source_file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("ord"))


def read_fasta(spark: SparkSession, path: str | list[str], recursive: bool = False, pattern: str = "*.{fasta,fa,fna}") -> DataFrame:
    """(source_file, ord, header, accession, seq, length) of FASTA files.

    A header is a line that starts with `>`; `;` in it becomes `_`. With recursive, all files below path whose
    names fit the pattern are read. Sequences are normalised. Text before the first header is left out. Repeated headers are kept: see
    operators.assign.last_wins.
    """
    reader = spark.read.option("lineSep", "\n>")
    if recursive:
        reader = reader.option("recursiveFileLookup", "true").option("pathGlobFilter", pattern)
    rows = _first_marked(_ordered(reader.text(path))).filter(F.col("value").startswith(">") | ~F.col("leads"))
    lines = F.split(F.col("value"), r"\r?\n")
    header = F.replace(F.trim(F.regexp_replace(lines[0], "^>", "")), F.lit(";"), F.lit("_"))
    seq = F.array_join(F.transform(F.slice(lines, 2, F.greatest(F.size(lines) - 1, F.lit(1))), lambda x: F.trim(x)), "")
    out = rows.select("source_file", "ord", header.alias("header"), T.normalize_sequence(seq).alias("seq"))
    return out.select("source_file", "ord", "header", T.header_accession(F.col("header")).alias("accession"), "seq", F.length("seq").alias("length"))


def _first_marked(rows: DataFrame) -> DataFrame:
    """rows with leads: whether a row is its file's first. The separator takes the mark from all other records, so text before the first mark can only
    be told by that. A task reads a part of one file or several files one after another, in the order of ord, and only the part that begins at byte 0 has a first row; a file
    may be the second or a later one of a task, so the least ord of each such part counts: one number for each file."""
    firsts = rows.filter("block = 0").groupBy("source_file").agg(F.min("ord").alias("ord")).withColumn("leads", F.lit(True))
    return rows.join(firsts, ["source_file", "ord"], "left").withColumn("leads", F.coalesce("leads", F.lit(False)))


def fasta_headers(spark: SparkSession, path: str | list[str], fields: bool = False) -> DataFrame:
    """Headers and accessions only; with fields, also the pipe-separated parts."""
    rows = read_fasta(spark, path).select("source_file", "ord", "header", "accession")
    return rows.withColumn("fields", F.split("header", r"\|")) if fields else rows


def read_clusters(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(cluster, member_idx, accession, length, is_rep, strand, identity) of cluster text files."""
    rows = spark.read.option("lineSep", "\n>Cluster ").text(path)
    lines = F.split(F.regexp_replace("value", "^>Cluster ", ""), r"\r?\n")
    # Two steps: beside the explode, the cluster's name would be cut out of the whole record again for each of its lines.
    records = rows.select(F.concat(F.lit(">Cluster "), F.trim(lines[0])).alias("cluster"), F.slice(lines, 2, F.greatest(F.size(lines) - 1, F.lit(1))).alias("lines"))
    each = records.select("cluster", F.explode("lines").alias("line"))
    part = lambda p: F.regexp_extract("line", p, 1)
    return each.filter(F.trim("line") != "").select(
        "cluster",
        part(r"^\s*(\d+)\t").cast("int").alias("member_idx"),
        part(r">(.+?)\.\.\.").alias("accession"),
        part(r"(\d+)(?:nt|aa),").cast("int").alias("length"),
        F.col("line").rlike(r"\*\s*$").alias("is_rep"),
        F.nullif(part(r"at ([+-])/"), F.lit("")).alias("strand"),
        F.nullif(part(r"([\d.]+)%\s*$"), F.lit("")).cast("double").alias("identity"),
    )


def read_metadata(spark: SparkSession, path: str | list[str], sep: str = ";", required: tuple[str, ...] = ("ACCESSION",)) -> DataFrame:
    """Sequence metadata with upper-case names; the known columns that the file lacks are null, required ones must be there."""
    raw = spark.read.csv(path, sep=sep, header=True)
    raw = require(raw.toDF(*[c.strip().upper() for c in raw.columns]), *required)
    fields = [f.split() for f in METADATA.split(", ")]
    number = lambda c: F.col(c).try_cast("int")
    cell: dict[str, Column] = {c: (T.segment_number(F.col(c)) if c == "SEGMENT" else number(c)) if kind == "int" else F.col(c) for c, kind in fields if c in raw.columns}
    return raw.select(*[(cell[c] if c in cell else F.lit(None).cast(kind)).cast(kind).alias(c) for c, kind in fields])


def read_hits(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """The twelve columns of tabular search output."""
    return spark.read.csv(path, sep="\t", schema=HITS)


def read_report(spark: SparkSession, path: str | list[str], required: tuple[str, ...] = ("SAMPLE_NAME",), null_value: str = "NA") -> DataFrame:
    """A tab-separated report with trimmed cells; required columns must be there. `NA` is null."""
    raw = require(spark.read.csv(path, sep="\t", header=True, nullValue=null_value), *required)
    return raw.select(*[F.trim(F.col(f"`{c}`")).alias(c) for c in raw.columns])


def read_markers(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(sample, raw) mutation markers; blank rows are left out."""
    raw = read_report(spark, path, ("Sample", "Mutations in your sample"), "")
    return raw.select(F.col("Sample").alias("sample"), F.col("`Mutations in your sample`").alias("raw")).filter("sample <> '' and raw <> ''")


def read_clades(spark: SparkSession, path: str | list[str], subtype_pattern: str = r"(H\d+)[^/]*$") -> DataFrame:
    """(seq_name, clade, errors, subtype): the subtype comes from the file name; absent columns are null."""
    raw = require(spark.read.csv(path, sep="\t", header=True), "seqName")
    tag = F.nullif(F.regexp_extract("_metadata.file_path", subtype_pattern, 1), F.lit(""))
    more = [F.col(c) if c in raw.columns else F.lit(None).cast("string").alias(c) for c in ("clade", "errors")]
    return raw.select(F.trim("seqName").alias("seq_name"), *more, tag.alias("subtype"))


def read_constellations(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Constellation rows with ord in place of row order."""
    raw = require(spark.read.csv(path, sep="\t", header=True), "Sample Name", "Genotype")
    return raw.select("*", F.monotonically_increasing_id().alias("ord"))


def read_tree(spark: SparkSession, path: str) -> DataFrame:
    """(tree variant) of JSON files that hold an object with an object `tree`; others raise an error."""
    whole = F.parse_json("value")
    tree = F.variant_get(whole, "$.tree", "variant")
    kind = F.schema_of_variant(tree)
    checked = F.when(F.coalesce(kind.startswith("OBJECT"), F.lit(False)), tree).otherwise(F.raise_error(F.lit("the file has no object `tree`")).cast("variant"))
    return spark.read.text(path, wholetext=True).select(checked.alias("tree"))


def read_cluster_profiles(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Cluster profiles of text tables with five or six fields; distributions are dictionary literals."""
    raw = spark.read.csv(path, sep="\t", header=True)
    names = {c: c.strip().lower() for c in raw.columns}
    raw = require(raw.toDF(*names.values()), "cluster", "representative")
    dist = lambda c: (parse_distribution(F.col(c)) if c in raw.columns else F.lit(None).cast(EMPTY)).alias(c)
    date = T.known(F.col("collection_date")) if "collection_date" in raw.columns else F.lit("Unknown")
    return raw.select("cluster", "representative", *[dist(c) for c in ("genotypes", "segments", "hosts", "countries")], date.alias("collection_date"))


def read_genbank(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(record_id, definition, seq, features array<struct<type, location, qualifiers map>>) of GenBank flat files."""
    rows = spark.read.option("lineSep", "\n//").text(path).filter(F.col("value").contains("LOCUS"))
    part = lambda p: F.regexp_extract("value", p, 1)
    version, locus = part(r"(?m)^VERSION\s+(\S+)"), part(r"(?m)^\s*LOCUS\s+(\S+)")
    definition = F.trim(F.regexp_replace(part(r"(?ms)^DEFINITION\s+(.*?)(?=^\S)"), r"\s+", " "))
    table = part(r"(?ms)^FEATURES[^\n]*\n(.*?)(?=^ORIGIN|^CONTIG|\z)")
    blocks = F.filter(F.split(table, r"(?m)^ {5}(?=\S)"), lambda b: F.trim(b) != "")
    quals = lambda b: F.transform(
        F.regexp_extract_all(b, F.lit(r'(?s)\n\s+/(\w+=(?:"(?:[^"]|"")*"|[^\n]*))'), F.lit(1)),
        lambda q: F.struct(F.substring_index(q, "=", 1).alias("key"), F.regexp_replace(F.regexp_replace(q, r'(?s)^\w+="?|"$', ""), r"\s*\n\s+", " ").alias("value")),
    )
    unique = lambda q: F.map_from_arrays(F.array_distinct(F.transform(q, lambda x: x["key"])), F.transform(F.array_distinct(F.transform(q, lambda x: x["key"])), lambda k: F.filter(q, lambda x: x["key"] == k)[0]["value"]))
    features = F.transform(
        blocks,
        lambda b: F.struct(
            F.regexp_extract(b, r"^(\S+)", 1).alias("type"), F.regexp_replace(F.regexp_extract(b, r"(?s)^\S+\s+(.*?)(?=\n\s+/|\z)", 1), r"\s+", "").alias("location"), unique(quals(b)).alias("qualifiers")
        ),
    )
    seq = F.upper(F.regexp_replace(part(r"(?s)\nORIGIN[^\n]*\n(.*)$"), "[^A-Za-z]", ""))
    return rows.select(F.coalesce(F.nullif(version, F.lit("")), locus).alias("record_id"), definition.alias("definition"), seq.alias("seq"), features.alias("features"))


_LOCATION_PART = r"[^,()]*[(]|[^,()]+|[),]"


def location_spans(location: str) -> list[tuple[int, int, bool]]:
    """(first, last, whether complemented) of a location's spans in the order in which they are put together; places from 1, inclusive.

    `join(...)`, `order(...)` and `complement(...)` may stand in each other; complement turns both the order of what it holds and each span. A single number
    is one base, `a^b` is a place between bases and so none, `a.b` a base within a range, of which the whole range is taken; `<` and `>` don't count, spans of
    other records (`X1.1:4..5`) are left out. ValueError if the text is no location.
    """
    groups: list[tuple[bool, list[tuple[int, int, bool]]]] = [(False, [])]
    for part in re.findall(_LOCATION_PART, re.sub(r"\s+", "", location)):
        if part.endswith("("):
            if part not in ("join(", "order(", "complement(", "one-of(", "bond(", "gap("):
                raise ValueError(f"not a location: {location}")
            groups.append((part == "complement(", []))
        elif part == ")":
            if len(groups) < 2:
                raise ValueError(f"not a location: {location}")
            turned, inner = groups.pop()
            groups[-1][1].extend([(a, b, not t) for a, b, t in reversed(inner)] if turned else inner)
        elif part != "," and ":" not in part and "^" not in part:
            span = re.fullmatch(r"[<>]?(\d+)(?:\.{1,2}[<>]?(\d+))?", part)
            if span is None:
                raise ValueError(f"not a location: {location}")
            groups[-1][1].append((int(span[1]), int(span[2] or span[1]), False))
    if len(groups) != 1:
        raise ValueError(f"not a location: {location}")
    return groups[0][1]


_PAIRED = str.maketrans("ACGTUNRYKMBDHVSWacgtun", "TGCAANYRMKVHDBSWtgcaan")


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(header, seq) of (header, location, seq)."""
    for batch in batches:
        out: list[str | None] = []
        for location, seq in zip(batch["location"].to_pylist(), batch["seq"].to_pylist(), strict=True):
            try:
                parts = [(seq or "")[a - 1 : b] if not turned else (seq or "")[a - 1 : b].translate(_PAIRED)[::-1] for a, b, turned in location_spans(location or "")]
                out.append("".join(parts))
            except ValueError:
                out.append(None)
        yield pa.RecordBatch.from_pydict({"header": batch["header"], "seq": pa.array(out, pa.string())})


def feature_sequences(records: DataFrame, feature_type: str = "CDS") -> DataFrame:
    """(header, seq) of the features of one type: the spans of the location put together, each complemented where the location says so.

    The header is `id | type_gene`; a feature without a gene is called by its product, else unknown. Spans in other records are left out; a text
    that is no location gives a null sequence.
    """
    q = lambda k: F.try_element_at("f.qualifiers", F.lit(k))
    rows = records.select("record_id", "seq", F.explode("features").alias("f")).filter(F.col("f.type") == feature_type)
    name = F.coalesce(q("gene"), q("product"), F.lit("unknown"))
    return rows.select(F.concat("record_id", F.lit(f" | {feature_type}_"), name).alias("header"), F.col("f.location").alias("location"), "seq").mapInArrow(_cut, "header string, seq string")
