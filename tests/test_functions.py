"""Text and distribution functions on the golden cases."""

import pytest
from pyspark.sql import functions as F

from segtrace.functions import dist as D
from segtrace.functions import text as T
from segtrace.operators.samples import ordered_labels, segment_order


def one(spark, column, **cells):
    names = list(cells)
    df = spark.createDataFrame([tuple(cells.values())], ", ".join(f"{n} {'int' if isinstance(cells[n], int) else 'string'}" for n in names))
    return df.select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(("raw", "want"), [("acx", "ACN"), ("ac-x", "ACN"), ("uJ", "TN"), ("AC Gé", "ACNGN"), ("", ""), (None, None)])
def test_normalize_sequence(spark, raw, want):
    assert one(spark, T.normalize_sequence(F.col("s")), s=raw) == want


@pytest.mark.parametrize(("seq", "want"), [("A" * 9 + "N", 10.0), ("A" * 8999 + "R" * 1001, 10.01), ("", None), (None, None)])
def test_ambiguous_percent(spark, seq, want):
    assert one(spark, T.ambiguous_percent(F.col("s")), s=seq) == want


@pytest.mark.parametrize(("raw", "want"), [("2021", "2021-01-01"), ("2021-03", "2021-03-01"), ("2020-12-31", "2020-12-31"), ("2021-13", None), ("", None), ("x", None), (None, None)])
def test_partial_date(spark, raw, want):
    got = one(spark, T.partial_date(F.col("s")), s=raw)
    assert (got and str(got)) == want


@pytest.mark.parametrize(("raw", "want"), [("", "Unknown"), (None, "Unknown"), ("NaN", "Unknown"), ("nan", "Unknown"), ("2022-02-04", "2022-02-04"), (" a ", "a")])
def test_known(spark, raw, want):
    assert one(spark, T.known(F.col("s")), s=raw) == want


@pytest.mark.parametrize(("raw", "want"), [("H5N1", True), ("h3n2", True), ("H5N1v", True), ("H5", False), ("mixed", False), (None, False)])
def test_full_subtype(spark, raw, want):
    assert one(spark, T.full_subtype(F.col("s")), s=raw) is want


def test_tokens(spark):
    assert one(spark, T.leading_token(F.col("s"), "H"), s="H5N1") == "H5"
    assert one(spark, T.leading_token(F.col("s"), "N"), s="H5N1") == "N1"
    assert one(spark, T.leading_token(F.col("s"), "H"), s="N1") is None
    assert one(spark, T.any_token(F.col("s"), "N"), s="a h12n345") == "N345"
    assert one(spark, T.strict_token(F.col("s"), "N"), s="h1ñ2v") == "N2"
    assert one(spark, T.strict_token(F.col("s"), "H"), s="xH1") is None


@pytest.mark.parametrize(("segment", "genos", "want"), [(4, ["N1", "H5N1"], "H5"), (6, ["H5N1"], "N1"), (4, ["mixed"], "mixed"), (3, ["H5N1"], "H5N1"), (6, [], None)])
def test_determining_component(spark, segment, genos, want):
    df = spark.createDataFrame([(segment, genos)], "s int, g array<string>")
    assert df.select(T.determining_component(F.col("s"), F.col("g"))).first()[0] == want


def test_mining(spark):
    assert one(spark, T.mined_genotype(F.col("s")), s="A/duck (h5n1)") == "h5n1"
    assert one(spark, T.mined_genotype(F.col("s")), s="H5 and N8") == "H5N8"
    assert one(spark, T.mined_genotype(F.col("s")), s="none") == "UD"
    assert one(spark, T.mined_segment(F.col("s")), s="segment 4 hemagglutinin") == "4"
    assert one(spark, T.mined_segment(F.col("s")), s="nothing") == "UD"
    assert one(spark, T.mined_segment_loose(F.col("s")), s="PB2 and M1") == "7"
    assert one(spark, T.ncbi_accession(F.col("s")), s=">NM_0012.3 x") == "NM_0012.3"
    assert one(spark, T.ncbi_accession(F.col("s")), s=">AB123.1") == "AB123.1"
    assert one(spark, T.ncbi_accession(F.col("s")), s="no") is None
    assert one(spark, T.header_accession(F.col("s")), s="> AB1|x|y") == "AB1"
    assert tuple(one(spark, T.strain_parts(F.col("s")), s="Influenza (A/duck/France/12/2020)")) == ("duck", "France", "12", "2020")
    assert tuple(one(spark, T.strain_parts(F.col("s")), s="Influenza (A/Paris/12/2020)")) == ("Homo sapiens", "Paris", "12", "2020")


def test_segments_and_names(spark):
    assert one(spark, T.segment_number(F.col("s")), s=" ha ") == 4
    assert one(spark, T.segment_number(F.col("s")), s="7") == 7
    assert one(spark, T.segment_number(F.col("s")), s="x") is None
    assert one(spark, T.segment_name(F.col("s")), s=8) == "NS"
    assert one(spark, T.segment_name(F.col("s")), s=9) is None
    assert one(spark, T.percent_identity(F.col("s")), s=" 99.1% ") == 99.1
    assert one(spark, T.safe_name(F.col("s")), s="..a b/c?") == "a_b_c"
    assert one(spark, T.safe_name(F.col("s")), s="???") == "sample"
    assert one(spark, T.path_tag(F.col("s")), s="a/b/s2.fasta") == "a__b__s2"
    assert one(spark, T.sample_tag(F.col("s")), s="s1.fasta") == "s1"
    assert one(spark, T.sample_tag(F.col("s")), s="a/s1.fasta").startswith("s1_")
    assert one(spark, T.sample_id(F.col("s"), r"(?P<sample>EPI_ISL_\d+)"), s="EPI_ISL_1|HA") == "EPI_ISL_1"
    assert one(spark, T.sample_id(F.col("s"), r"(?P<sample>EPI_ISL_\d+)"), s="other") is None


def test_mutation_parts(spark):
    assert tuple(one(spark, T.mutation_parts(F.col("s")), s="M2:A31N")) == ("M2", "MP", "31N")
    assert one(spark, T.mutation_parts(F.col("s")), s="A31N") is None
    labels = "PB2:627K PB1-F2:66S PB1:13P PA:127V HA:156A NP:105V NA:275Y M2:31N M1:95K PB2:627K".split()
    df = spark.createDataFrame([(labels,)], "l array<string>")
    got = df.select(ordered_labels(F.col("l"))).first()[0]
    assert ";".join(got) == "PB2:627K;PB1:13P;PB1-F2:66S;PA:127V;HA:156A;NP:105V;NA:275Y;M1:95K;M2:31N"
    assert one(spark, segment_order(F.col("s")), s="PB1") < one(spark, segment_order(F.col("s")), s="HA") < one(spark, segment_order(F.col("s")), s="?")


def dist(spark, cell):
    return spark.createDataFrame([(cell,)], "c string").select(D.parse_distribution(F.col("c")).alias("d"))


@pytest.mark.parametrize(
    ("cell", "want"),
    [
        ("{'Gallus gallus': 1, 'Anas platyrhynchos': 1, 'Homo sapiens': 1}", "{'Anas platyrhynchos': 0.34, 'Gallus gallus': 0.33, 'Homo sapiens': 0.33}"),
        ("{'a': 0.8, 'b': 0.2}", "{'a': 0.80, 'b': 0.20}"),
        ("{4: 1.0}", "{'4': 1.00}"),
        ("H5N1", "{'H5N1': 1.00}"),
        ('{"Cote d\'Ivoire": 2}', '{"Cote d\'Ivoire": 1.00}'),
        ("{}", "Unknown"),
        ("{'a': 0}", "Unknown"),
        ("", "Unknown"),
        (None, "Unknown"),
    ],
)
def test_serialize(spark, cell, want):
    assert dist(spark, cell).select(D.serialize(F.col("d"))).first()[0] == want


def test_shares(spark):
    df = dist(spark, "{'a': 1, 'b': 2}")
    assert [tuple(x) for x in df.select(D.to_proportions(F.col("d"))).first()[0]] == [("a", 0.333), ("b", 0.667)]
    assert [tuple(x) for x in df.select(D.clean(F.col("d"))).first()[0]] == [("a", 0.01), ("b", 0.02)]
    assert df.select(D.first_key(F.col("d"))).first()[0] == "a"
    assert [x["weight"] for x in dist(spark, "{'a': 0}").select(D.to_proportions(F.col("d"))).first()[0]] == [0.0]
