"""Readers and writers on small files."""

import json
import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from segtrace.operators import assign, dims
from segtrace.sources import fasta_files, readers, writers

GEO = {"tree": {
    "Americas": {"rank": "region", "children": {"Northern America": {"rank": "sub-region", "children": {"United States of America": {"rank": "country"}}},
        "Latin America and the Caribbean": {"rank": "sub-region", "children": {"South America": {"rank": "intermediate-region", "children": {"Brazil": {"rank": "country"}}}}}}},
    "Europe": {"rank": "region", "children": {"Western Europe": {"rank": "sub-region", "children": {"France": {"rank": "country"}}}}},
    "Asia": {"rank": "region", "children": {"South-eastern Asia": {"rank": "sub-region", "children": {"Viet Nam": {"rank": "country"}}}}},
}}
TAXA = {"tree": {"Aves": {"rank": "class", "children": {
    "Anseriformes": {"rank": "order", "children": {"Anatidae": {"rank": "family", "children": {"Spatula": {"rank": "genus", "children": {"Spatula versicolor": {"rank": "species"}}},
        "Anas": {"rank": "genus", "children": {"Anas platyrhynchos": {"rank": "species"}}}}}}},
    "Galliformes": {"rank": "order", "children": {"Phasianidae": {"rank": "family", "children": {"Gallus": {"rank": "genus", "children": {"Gallus gallus": {"rank": "species"}}}}}}}}},
    "Mammalia": {"rank": "class", "children": {"Primates": {"rank": "order", "children": {"Hominidae": {"rank": "family", "children": {"Homo": {"rank": "genus", "children": {"Homo sapiens": {"rank": "species"}}}}}}}}}}}


@pytest.fixture(scope="module")
def trees(spark, tmp_path_factory):
    out = {}
    for name, tree in (("geo", GEO), ("taxa", TAXA)):
        path = tmp_path_factory.mktemp(name) / "tree.json"
        path.write_text(json.dumps(tree))
        nodes = dims.walk_tree(readers.read_tree(spark, str(path)))
        out[name] = (dims.geo_dim if name == "geo" else dims.taxa_dim)(nodes).cache()
    return out


def test_walk_edges(spark):
    """Chains, stars and random trees against plain walks; roots without, with a missing, and with themselves as parent; circles."""
    rng = random.Random(1)
    parent = {k: (None if k == 0 else k - 1) for k in range(150)} | {1000 + k: rng.choice([1000, 1000 + rng.randrange(max(k, 1)), None]) if k else None for k in range(300)} | {5000: 9999, 5001: 5001, 5002: 5001}
    rows = [(k, p, f"n{k}", f"r{k % 5}") for k, p in parent.items()] + [(7, 6, "n7", "r2"), (None, 3, "x", "y")]
    got = {r.name: (r.rank, r.depth, [tuple(x) for x in r.lineage]) for r in dims.walk_edges(spark.createDataFrame(rows, "id long, parent long, name string, rank string")).collect()}

    def path(k):
        above = parent[k] if parent[k] in parent and parent[k] != k else None
        return [*(path(above) if above is not None else []), (f"n{k}", f"r{k % 5}")]

    assert got == {f"n{k}": (f"r{k % 5}", len(path(k)), path(k)) for k in parent}
    with pytest.raises(ValueError, match="circle"):
        dims.walk_edges(spark.createDataFrame([(1, 2, "a", "r"), (2, 1, "b", "r")], "id long, parent long, name string, rank string"), most_rounds=5)
    nodes = dims.walk_tree(spark.createDataFrame([(json.dumps(TAXA["tree"]),)], "t string").select(F.parse_json("t").alias("tree")))
    edges = nodes.select(F.col("name").alias("id"), F.try_element_at("lineage", F.lit(-2))["name"].alias("parent"), "name", "rank")
    key = lambda df: sorted((r.name, r.rank, r.depth, [tuple(x) for x in r.lineage]) for r in df.collect())
    assert key(dims.walk_edges(edges)) == key(nodes)


def test_fasta_round_trip(spark, tmp_path):
    text = ">a;1|x desc\nacgt\nACx-\n\n>b\nUUU\n>a;1|x desc\nGGGG\n"
    (tmp_path / "in.fasta").write_text(text)
    rows = readers.read_fasta(spark, str(tmp_path / "in.fasta")).orderBy("ord").collect()
    assert [(r.header, r.accession, r.seq, r.length) for r in rows] == [("a_1|x desc", "a_1", "ACGTACN", 7), ("b", "b", "TTT", 3), ("a_1|x desc", "a_1", "GGGG", 4)]
    last = assign.last_wins(readers.read_fasta(spark, str(tmp_path / "in.fasta")), ["header"]).collect()
    assert {r.seq for r in last} == {"TTT", "GGGG"}
    long = spark.createDataFrame([(f"s{k}", "ACGT" * k) for k in range(1, 60)], "header string, seq string")
    writers.write_fasta(long.repartition(3), str(tmp_path / "out"), wrap=80)
    back = readers.read_fasta(spark, str(tmp_path / "out"))
    assert {(r.header, r.seq) for r in back.collect()} == {(r.header, r.seq) for r in long.collect()}
    with pytest.raises(Exception, match="already exists"):
        writers.write_fasta(long, str(tmp_path / "out"))


def test_many_files_in_a_task(spark, tmp_path):
    """Text before the first header goes, wherever its file stands in a task; files without a header give nothing."""
    for k in range(40):
        (tmp_path / f"f{k:02}.fasta").write_text(("; a remark\nmore\n" if k % 2 else "") + f">h{k}\nACGT\n>i{k}\nGG\n")
    (tmp_path / "none.fasta").write_text("only text\nand more\n")
    (tmp_path / "empty.fasta").write_text("")
    rows = readers.read_fasta(spark, str(tmp_path))
    assert sorted((r.header, r.seq) for r in rows.collect()) == sorted([(f"h{k}", "ACGT") for k in range(40)] + [(f"i{k}", "GG") for k in range(40)])
    assert rows.rdd.getNumPartitions() < 40 or spark.conf.get("spark.sql.adaptive.enabled") == "true"


def test_long_file_in_many_tasks(spark, tmp_path):
    """A file cut into parts keeps all records, each once, its first one too."""
    (tmp_path / "long.fasta").write_text("before\n" + "".join(f">r{k}\n{'ACGT' * (k % 50 + 1)}\n" for k in range(2000)))
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
        got = [(r.header, r.length) for r in readers.read_fasta(spark, str(tmp_path)).collect()]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    assert sorted(got) == sorted((f"r{k}", 4 * (k % 50 + 1)) for k in range(2000))


def test_named_files(spark, tmp_path):
    """A file for each key, found by the reader's own pattern; hot keys over several tasks, odd keys, replacing, and a job that fails."""
    rows = [(f"s{k % 3}", f"h{k}", "ACGT" * (k % 9)) for k in range(60)] + [("hot", f"x{k}", "AC") for k in range(300)] + [("a/b", "h1", "AC"), ("A_B", "h2", "GT"), (None, "h3", "TT"), ("", "h4", None), ("../up", "h5", "A"), (".hid", "h6", "C")]
    df, out = spark.createDataFrame(rows, "sample string, header string, seq string"), str(tmp_path / "named")
    fasta_files.write_named(df.repartition(4), out, "sample", wrap=5)
    names = {p.name for p in tmp_path.joinpath("named").iterdir()}
    assert {"s0.fasta", "s1.fasta", "s2.fasta", "hot.fasta", "unnamed.fasta", "hid.fasta"} <= names and not any(n.startswith(("_", ".")) for n in names)
    assert len({n.lower() for n in names}) == len(names) and {n for n in names if n.lower().startswith("a_b")} in ({"A_B.fasta", "a_b.2.fasta"}, {"A_B.2.fasta", "a_b.fasta"})
    back = readers.read_fasta(spark, out, recursive=True).select("header", "seq", F.regexp_extract("source_file", r"/([^/]+?)(?:\.\d+)?\.fasta$", 1).alias("k")).collect()
    assert sorted((r.header, r.seq, r.k) for r in back) == sorted((h, q or "", fasta_files.safe_name(k)) for k, h, q in rows)
    assert (tmp_path / "named" / "s1.fasta").read_text().split(">")[2].split("\n")[1] in ("ACGTA", "ACGT", "")
    with pytest.raises(FileExistsError):
        fasta_files.write_named(df, out, "sample")
    fasta_files.write_named(df.filter("sample = 's0'"), out, "sample", replace=True)
    assert {p.name for p in tmp_path.joinpath("named").iterdir()} == {"s0.fasta"}
    bad = df.withColumn("seq", F.when(F.col("header") == "h59", F.raise_error(F.lit("stop"))).otherwise(F.col("seq")))
    with pytest.raises(Exception, match="stop"):
        fasta_files.write_named(bad, str(tmp_path / "failed"), "sample")
    assert not [p for p in tmp_path.joinpath("failed").rglob("*") if p.is_file()] if (tmp_path / "failed").exists() else True
    fasta_files.write_named(df.limit(0), str(tmp_path / "none"), "sample")


SEQ = "AAACCGGTTTACGTAACCGG"


@pytest.mark.parametrize(("location", "want"), [
    ("1..3", "AAA"), ("4", "C"), ("<1..>3", "AAA"), ("complement(4..5)", "GG"), ("complement(1..6)", "CGGTTT"),
    ("join(1..3,6..7)", "AAAGG"), ("join(complement(1..3),complement(4..5))", "TTTGG"), ("join(complement(1..3),6..7)", "TTTGG"),
    ("complement(join(1..3,6..7))", "CCTTT"), ("join(1..2,complement(join(4..5,8..9)),12)", "AA" + "AAGG" + "C"), ("order(1..2,4..5)", "AACC"),
    ("join(J00194.1:4..5,1..3)", "AAA"), ("complement(complement(4..6))", "CCG"), ("3^4", ""), ("join(2.4,10..11)", "AACTA"), ("join( 1..3,\n 4..5 )", "AAACC"),
    ("19..40", "GG"), ("", ""), ("nonsense(1..2)", None), ("join(1..2", None), ("1..x", None), ("1..2)", None),
])
def test_locations(spark, location, want):
    got = list(readers._cut([pa.RecordBatch.from_pydict({"header": ["h"], "location": [location], "seq": [SEQ]})]))[0]
    assert got["seq"].to_pylist() == [want]


def test_feature_sequences(spark):
    kind = "record_id string, seq string, features array<struct<type:string,location:string,qualifiers:map<string,string>>>"
    rows = [("R1", SEQ, [("CDS", "join(complement(1..3),6..7)", {"gene": "a"}), ("gene", "1..2", {}), ("CDS", "J1.1:1..2", {"product": "p"}), ("CDS", "bad(", {})]), ("R2", None, [("CDS", "1..2", {})]), ("R3", SEQ, [])]
    got = {r.header: r.seq for r in readers.feature_sequences(spark.createDataFrame(rows, kind)).collect()}
    assert got == {"R1 | CDS_a": "TTTGG", "R1 | CDS_p": "", "R1 | CDS_unknown": None, "R2 | CDS_unknown": ""}


def test_lines_are_trimmed(spark, tmp_path):
    """Blanks around any line go, and nothing else."""
    (tmp_path / "in.fasta").write_text(">a\n AC \n  GT\nTT  \n>b\n1AC1\n2GT2\n")
    rows = {r.header: r.seq for r in readers.read_fasta(spark, str(tmp_path / "in.fasta")).collect()}
    assert rows == {"a": "ACGTTT", "b": "NACNNGTN"}


def test_fasta_dir(spark, tmp_path):
    for name, head in (("x/a.fasta", "one"), ("x/y/b.fa", "two"), ("x/c.txt", "no")):
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_text(f">{head}\nAC\n")
    rows = readers.read_fasta(spark, str(tmp_path / "x"), recursive=True).collect()
    assert {r.header for r in rows} == {"one", "two"}
    assert {tuple(r.fields) for r in readers.fasta_headers(spark, str(tmp_path / "x" / "a.fasta"), fields=True).collect()} == {("one",)}


def test_clusters(spark, tmp_path):
    (tmp_path / "c.clstr").write_text(">Cluster 0\n0\t1700nt, >ACC1... *\n1\t1699nt, >ACC2... at +/99.50%\n>Cluster 1\n0\t900nt, >ACC3... *\n")
    got = {(r.cluster, r.member_idx, r.accession, r.length, r.is_rep, r.strand, r.identity) for r in readers.read_clusters(spark, str(tmp_path / "c.clstr")).collect()}
    assert got == {(">Cluster 0", 0, "ACC1", 1700, True, None, None), (">Cluster 0", 1, "ACC2", 1699, False, "+", 99.5), (">Cluster 1", 0, "ACC3", 900, True, None, None)}


def test_metadata_and_reports(spark, tmp_path):
    (tmp_path / "m.csv").write_text("Accession;Genotype;Segment;Host\nA1;H5N1;HA;duck\nA2;;6;\n")
    got = [(r.ACCESSION, r.GENOTYPE, r.SEGMENT, r.COLLECTION_DATE) for r in readers.read_metadata(spark, str(tmp_path / "m.csv")).orderBy("ACCESSION").collect()]
    assert got == [("A1", "H5N1", 4, None), ("A2", None, 6, None)]
    with pytest.raises(ValueError, match="ORGANISM"):
        readers.read_metadata(spark, str(tmp_path / "m.csv"), required=("ORGANISM",))
    (tmp_path / "r.tsv").write_text("SAMPLE_NAME\tSEGMENT\n s1 \t NA\ns2\tNA\n")
    assert [tuple(r) for r in readers.read_report(spark, str(tmp_path / "r.tsv")).orderBy("SAMPLE_NAME").collect()] == [("s1", "NA"), ("s2", None)]
    (tmp_path / "h.tsv").write_text("q\ts\t99.5\t100\t0\t0\t1\t100\t1\t100\t1e-30\t180\n")
    assert readers.read_hits(spark, str(tmp_path / "h.tsv")).first().evalue == 1e-30
    (tmp_path / "p.tsv").write_text("Cluster\tRepresentative\tGenotypes\tSegments\tHosts\tCountries\n>Cluster 1\tREP1\t{'H5N1': 2}\t{4: 2}\t{}\t{'France': 2}\n")
    row = readers.read_cluster_profiles(spark, str(tmp_path / "p.tsv")).first()
    assert (row.representative, row.collection_date, row.segments[0].key) == ("REP1", "Unknown", "4")


def test_genbank(spark, tmp_path):
    (tmp_path / "g.gb").write_text(
        'LOCUS       AB1 12 bp\nDEFINITION  Some virus,\n            long name.\nACCESSION   AB1\nVERSION     AB1.1\nFEATURES             Location/Qualifiers\n     source          1..12\n                     /host="duck"\n'
        '     CDS             join(1..3,7..9)\n                     /gene="HA"\n                     /note="a\n                     b"\n     CDS             complement(1..4)\n                     /product="p"\nORIGIN\n        1 acgtacgtac gt\n//\n'
        "LOCUS       AB2 4 bp\nDEFINITION  x.\nVERSION     AB2.1\nFEATURES             Location/Qualifiers\nORIGIN\n        1 aaaa\n//\n"
    )
    records = readers.read_genbank(spark, str(tmp_path / "g.gb"))
    rows = {r.record_id: r for r in records.collect()}
    assert rows["AB1.1"].definition == "Some virus, long name." and rows["AB1.1"].seq == "ACGTACGTACGT" and rows["AB2.1"].seq == "AAAA"
    assert rows["AB1.1"].features[1].qualifiers == {"gene": "HA", "note": "a b"}
    got = {(r.header, r.seq) for r in readers.feature_sequences(records).collect()}
    assert got == {("AB1.1 | CDS_HA", "ACGGTA"), ("AB1.1 | CDS_p", "ACGT")}
    assert {r.header for r in writers.genbank_to_fasta(records).collect()} == {"AB1.1 Some virus, long name.", "AB2.1 x."}


def test_tables_of_tools(spark, tmp_path):
    (tmp_path / "markers.tsv").write_text("Sample\tMutations in your sample\na\tM2:A31N\n\tx\nb\t\n")
    assert [tuple(r) for r in readers.read_markers(spark, str(tmp_path / "markers.tsv")).collect()] == [("a", "M2:A31N")]
    (tmp_path / "clades_H5.tsv").write_text("seqName\tclade\n s1\t2.3.4.4b\n")
    assert [tuple(r) for r in readers.read_clades(spark, str(tmp_path / "clades_H5.tsv")).collect()] == [("s1", "2.3.4.4b", None, "H5")]


def test_dims(spark, trees):
    geo = {r.country: (r.region, r.continent) for r in trees["geo"].collect()}
    assert geo["United States of America"] == ("Northern America", "North America")
    assert geo["Brazil"] == ("South America", "South America")
    assert geo["Viet Nam"] == ("South-Eastern Asia", "Asia")
    taxa = {r.name: tuple(r)[2:] for r in trees["taxa"].collect()}
    assert taxa["Spatula versicolor"] == ("Spatula versicolor", "Spatula", "Anatidae", "Anatidae", "Anseriformes", "Anseriformes", "Aves")
    assert taxa["Anatidae"] == (None, None, "Anatidae", "Anatidae", "Anseriformes", "Anseriformes", "Aves")
    assert taxa["Aves"] == (None, None, None, None, "Aves", None, "Aves")


@pytest.mark.parametrize(("term", "level", "want"), [("Phasianidae", "order", "Galliformes"), ("phasianidae", "class", "Aves"), ("Aves", "family", "Aves"), ("Aves", "order", "Unknown"), ("Gallus sp.", "family", "Phasianidae"), ("stone", "class", "Unknown"), (None, "class", "Unknown")])
def test_rollup_taxa(spark, trees, term, level, want):
    df = spark.createDataFrame([(term,)], "t string")
    assert dims.rollup_taxa(df, "t", dims.taxa_lookup(trees["taxa"]), level, "x").first()["x"] == want


def test_bad_tree(spark, tmp_path):
    (tmp_path / "bad.json").write_text('{"tree": [1]}')
    with pytest.raises(Exception, match="no object"):
        readers.read_tree(spark, str(tmp_path / "bad.json")).select(F.to_json("tree")).collect()
