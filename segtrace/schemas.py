"""Table schemas of the library."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DIST = "array<struct<key:string,weight:double>>"
SEQUENCES = "source_file string, ord bigint, header string, accession string, seq string, length int"
METADATA = (
    "ACCESSION string, ORGANISM_NAME string, GENBANK_REFSEQ string, ASSEMBLY string, RELEASE_DATE string, ISOLATE string, SPECIES string,"
    " LENGTH int, NUC_COMPLETENESS string, GENOTYPE string, SEGMENT int, COUNTRY string, HOST string, COLLECTION_DATE string"
)
MEMBERS = "cluster string, member_idx int, accession string, length int, is_rep boolean, strand string, identity double"
HITS = (
    "qseqid string, sseqid string, pident double, length int, mismatch int, gapopen int, qstart int, qend int, sstart int, send int,"
    " evalue double, bitscore double"
)
PROFILE = f"cluster string, representative string, genotypes {DIST}, segments {DIST}, hosts {DIST}, countries {DIST}, collection_date string"
REPORT = (
    f"sample_id string, sample_name string, segment {DIST}, cluster string, representative string, pident double, assigned_by string,"
    f" genotype {DIST}, host {DIST}, country {DIST}, collection_date string"
)


def require(df: DataFrame, *columns: str) -> DataFrame:
    """df if it has the columns, else an error that names the missing ones."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df


def with_defaults(df: DataFrame, **defaults: object) -> DataFrame:
    """df with absent columns added and nulls replaced by the defaults."""
    values = {c: F.coalesce(F.col(f"`{c}`"), F.lit(v)) if c in df.columns else F.lit(v) for c, v in defaults.items()}
    return df.withColumns(values)
