"""Column functions over text: sequences, subtypes, headers, dates, mutations, names."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from .domain import LOCUS_OF, SEGMENT_OF_LOCUS, SEGMENT_WORDS, SEGMENTS

AMBIGUOUS = "RYSWKMBDHVN"


def _lookup(key: Column, values: dict, default: Column | None = None) -> Column:
    """A small fixed dictionary as a CASE expression; null where absent, or the default."""
    out = F.lit(None) if default is None else default
    for k, v in values.items():
        out = F.when(key == F.lit(k), F.lit(v)).otherwise(out)
    return out


def normalize_sequence(seq: Column) -> Column:
    """Upper case (A-Z) without `-`, X as N, U as T, and whatever isn't a IUPAC code as N."""
    return F.regexp_replace(F.translate(seq, "abcdefghijklmnopqrstuvwxyzXU-", "ABCDEFGHIJKLMNOPQRSTTVWNYZNT"), "[^ACGTRYSWKMBDHVN]", "N")


def ambiguous_percent(seq: Column) -> Column:
    """Percent of ambiguity codes, two decimals; null for an empty sequence."""
    n = F.length(seq)
    return F.when(n > 0, F.round(100.0 * (n - F.length(F.translate(seq, AMBIGUOUS, ""))) / n, 2))


def full_subtype(genotype: Column) -> Column:
    """Whether a genotype without its v's is a whole HxNy."""
    return F.coalesce(F.replace(F.lower(F.trim(genotype)), F.lit("v"), F.lit("")).rlike(r"^h\d+n\d+$"), F.lit(False))


def leading_token(genotype: Column, letter: str) -> Column:
    """H or N token of one or two digits at the start, or behind the H token of a whole subtype; else null."""
    whole = F.regexp_extract(genotype, r"^(H\d{1,2})(N\d{1,2})", 1 if letter == "H" else 2)
    alone = F.regexp_extract(genotype, rf"^({letter}\d{{1,2}})", 1)
    return F.coalesce(F.nullif(whole, F.lit("")), F.nullif(alone, F.lit("")))


def any_token(genotype: Column, letter: str) -> Column:
    """First token of the letter and any number of digits, in upper case; else null."""
    return F.nullif(F.upper(F.regexp_extract(genotype, rf"(?i)({letter}\d+)", 1)), F.lit(""))


def strict_token(genotype: Column, letter: str) -> Column:
    """Token of a genotype that is HxNy, Hx or Ny as a whole, after upper case and without a last V; else null."""
    clean = F.regexp_replace(F.replace(F.upper(F.trim(genotype)), F.lit("Ñ"), F.lit("N")), "V$", "")
    pattern = r"^(H\d+)(?:N\d+)?$" if letter == "H" else r"^(?:H\d+)?(N\d+)$"
    return F.nullif(F.regexp_extract(clean, pattern, 1), F.lit(""))


def determining_component(segment: Column, genotypes: Column) -> Column:
    """First H token for segment 4, first N token for segment 6, else the first genotype (genotypes: array)."""

    def first(letter: str) -> Column:
        return F.get(F.filter(F.transform(genotypes, lambda g: strict_token(g, letter)), lambda t: t.isNotNull()), F.lit(0))

    whole = F.get(genotypes, F.lit(0))
    return F.when(segment == 4, F.coalesce(first("H"), whole)).when(segment == 6, F.coalesce(first("N"), whole)).otherwise(whole)


def mined_genotype(text: Column) -> Column:
    """HxNy in free text, else its H and N tokens put together, else UD."""
    found = lambda p: F.nullif(F.regexp_extract(text, rf"(?i)({p})", 1), F.lit(""))
    h, n = found(r"H\d{1,2}"), found(r"N\d{1,2}")
    return F.coalesce(found(r"H\d{1,2}N\d{1,2}"), F.nullif(F.concat(F.coalesce(h, F.lit("")), F.coalesce(n, F.lit(""))), F.lit("")), F.lit("UD"))


def mined_segment(text: Column) -> Column:
    """Number of the first segment (1 to 8) that a word of the text names, else UD."""
    out = F.lit("UD")
    for number, words in reversed(list(enumerate(SEGMENT_WORDS, 1))):
        out = F.when(text.rlike(r"(?i)\b(" + "|".join(map(re.escape, words)) + r")\b"), F.lit(str(number))).otherwise(out)
    return out


def mined_segment_loose(text: Column) -> Column:
    """Number of the last segment whose words occur anywhere in the text, case-sensitive; null if none."""
    out = F.lit(None).cast("string")
    for number, words in enumerate(SEGMENT_WORDS, 1):
        hit = F.lit(False)
        for w in words:
            hit = hit | text.contains(w)
        out = F.when(hit, F.lit(str(number))).otherwise(out)
    return out


def ncbi_accession(header: Column) -> Column:
    """RefSeq, GenBank or numeric accession behind `>`, tried in that order; null if none."""
    patterns = (r">([A-Z]{1,2}_\d+\.\d+)", r">([A-Z]+\d+\.\d+)", r">(\d+\.\d+)")
    return F.coalesce(*[F.nullif(F.regexp_extract(header, p, 1), F.lit("")) for p in patterns])


def strain_parts(organism: Column) -> Column:
    """struct(host, location, number, year) of a strain name in brackets; four parts mean a human host."""
    five = [F.regexp_extract(organism, r"\(([^/]+)/([^/]+)/([^/]+)/([^/]+)/([^/]+)\)", k) for k in range(1, 6)]
    four = [F.regexp_extract(organism, r"\(([^/]+)/([^/]+)/([^/]+)/([^/]+)\)", k) for k in range(1, 5)]
    names = ("host", "location", "number", "year")
    pack = lambda cols: F.struct(*[c.alias(n) for c, n in zip(cols, names, strict=True)])
    return F.when(five[0] != "", pack(five[1:])).when(four[0] != "", pack([F.lit("Homo sapiens"), *four[1:]]))


def header_accession(header: Column) -> Column:
    """What stands before the first pipe, without `>` and spaces."""
    return F.regexp_replace(F.substring_index(header, "|", 1), "[> ]", "")


def segment_number(cell: Column) -> Column:
    """Number of a segment given by acronym or number; null if neither."""
    return F.coalesce(_lookup(F.upper(F.trim(cell)), {s: k for k, s in enumerate(SEGMENTS, 1)}), cell.try_cast("int"))


def segment_name(number: Column) -> Column:
    return F.try_element_at(F.array(*map(F.lit, SEGMENTS)), F.when(number.between(1, 8), number.cast("int")))


def percent_identity(cell: Column) -> Column:
    return F.replace(F.trim(cell), F.lit("%"), F.lit("")).try_cast("double")


def length_class(length: Column, low: Column, high: Column) -> Column:
    return F.when(length < low, "below").when(length > high, "above").when(length.isNotNull(), "ok")


def known(text: Column, default: str = "Unknown") -> Column:
    """Trimmed text; blank, null and nan become the default."""
    clean = F.trim(text.cast("string"))
    return F.when(clean.isNull() | (clean == "") | (F.lower(clean) == "nan"), default).otherwise(clean)


def norm_key(text: Column) -> Column:
    """Key for case-insensitive lookups; null for blank."""
    return F.nullif(F.lower(F.trim(text)), F.lit(""))


def partial_date(text: Column) -> Column:
    """Date of YYYY, YYYY-MM or YYYY-MM-DD with 01 for what is missing; null if it isn't one."""
    clean = F.trim(text)
    whole = F.concat(clean, F.when(F.length(clean) == 4, "-01-01").when(F.length(clean) == 7, "-01").otherwise(""))
    return F.when(clean.rlike(r"^\d{4}(-\d{2}(-\d{2})?)?$"), F.try_to_date(whole, "yyyy-MM-dd"))


def locus_segment(locus: Column) -> Column:
    return _lookup(locus, SEGMENT_OF_LOCUS, locus)


def mutation_parts(text: Column) -> Column:
    """struct(locus, segment, mutation) of `locus:A123T`; the mutation loses its first letter; null without a colon."""
    locus, rest = F.trim(F.substring_index(text, ":", 1)), F.trim(F.regexp_replace(text, "(?s)^[^:]*:", ""))
    short = F.when(rest.rlike(r"^[A-Z]\d+[A-Z]"), F.regexp_extract(rest, r"^[A-Z](\d+[A-Z])", 1)).otherwise(rest)
    good = text.contains(":") & (locus != "") & (rest != "")
    return F.when(good, F.struct(locus.alias("locus"), locus_segment(locus).alias("segment"), short.alias("mutation")))


def mutation_label(segment: Column, mutation: Column) -> Column:
    """locus:mutation as shown in reports."""
    out = segment
    for (s, m), locus in LOCUS_OF.items():
        out = F.when((segment == s) & (mutation == m), F.lit(locus)).otherwise(out)
    return F.concat(out, F.lit(":"), mutation)


def sample_id(header: Column, pattern: str) -> Column:
    """The group `sample` of a regular expression, else its first group; null without a match or when blank."""
    java = pattern.replace("(?P<", "(?<").replace("(?P=", "(?=")
    compiled = re.compile(pattern)
    if not compiled.groups:
        raise ValueError("the pattern needs a group")
    return F.nullif(F.trim(F.regexp_extract(header, java, compiled.groupindex.get("sample", 1))), F.lit(""))


def safe_name(text: Column) -> Column:
    """A name fit for file systems."""
    clean = F.regexp_replace(F.trim(F.replace(text, F.lit("/"), F.lit("_"))), r"[^A-Za-z0-9._-]+", "_")
    return F.coalesce(F.nullif(F.regexp_replace(clean, r"^[._]+|[._]+$", ""), F.lit("")), F.lit("sample"))


def path_tag(path: Column) -> Column:
    """A relative path as one flat name, without its last extension."""
    return F.replace(F.regexp_replace(path, r"\.[^./]*$", ""), F.lit("/"), F.lit("__"))


def sample_tag(path: Column) -> Column:
    """File stem, and the start of the SHA-1 of its folder if it has one."""
    stem = F.regexp_replace(F.regexp_replace(path, r"^.*/", ""), r"\.[^./]*$", "")
    parent = F.regexp_extract(path, r"^(.*)/[^/]*$", 1)
    return F.when(parent.isin("", "."), stem).otherwise(F.concat(stem, F.lit("_"), F.substring(F.sha1(parent), 1, 10)))
