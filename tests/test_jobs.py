"""Operators and jobs on the small cases: tiers, contigs, routing, composition, curation, clusters, streams."""

import random

import pytest
from pyspark.sql import functions as F
from test_sources import trees  # noqa: F401

from segtrace.functions import dist as D
from segtrace.operators import assign, dims, profile, quality, samples, similarity
from segtrace.plans import jobs
from segtrace.schemas import DIST
from segtrace.sources import writers
from segtrace.streaming import identify as streaming


def test_best_hit_then_threshold(spark):
    hits = spark.createDataFrame([("q1", "a", 89.0, 0.0), ("q1", "b", 99.0, 1e-9), ("q2", "a", 95.0, 1e-5), ("q2", "b", 96.0, 1e-5)], "qseqid string, sseqid string, pident double, evalue double")
    assert [(r.qseqid, r.sseqid) for r in assign.best_hit(hits, 90).collect()] == [("q2", "b")]


def test_tiers_are_disjoint(spark):
    ids = spark.createDataFrame([(f"Seq-{k}",) for k in (1, 2, 10, 11)], "internal_id string")
    tier = lambda *names: spark.createDataFrame([(n, n.lower()) for n in names], "internal_id string, representative string")
    got = {r.internal_id: r.assigned_by for r in assign.compile_report(ids, [("one", tier("Seq-1")), ("two", tier("Seq-1", "Seq-10"))]).collect()}
    assert got == {"Seq-1": "one", "Seq-10": "two", "Seq-2": "Unassigned", "Seq-11": "Unassigned"}
    assert {r.internal_id for r in assign.unassigned(ids, tier("Seq-1")).collect()} == {"Seq-2", "Seq-10", "Seq-11"}


def test_large_groups_are_numbered_in_ranges(spark):
    """Cut into ranges, groups get the same numbers as from one sort; a null group is one too."""
    rows = spark.range(3000).selectExpr("CASE WHEN id % 10 < 7 THEN 'hot' WHEN id % 10 < 9 THEN concat('g', id % 50) END AS g", "(id * 7919) % 3001 AS o")
    few, cut = ({(r.g, r.o): r.n for r in assign.numbered(rows, "g", "o", "n", most).collect()} for most in (10_000, 10))
    assert few == cut and max(few.values()) == 2100
    assert assign.numbered(rows.limit(0), "g", "o", "n").count() == 0


def test_best_row_puts_missing_last(spark):
    df = spark.createDataFrame([("s", None, 1), ("s", 5.0, 2), ("s", 5.0, 3)], "g string, v double, o int")
    assert assign.best_row(df, "g", "v", "o").first().o == 2


def test_contig_ladder(spark):
    """Closed form against a loop that relaxes the limit rung by rung."""
    rng = random.Random(3)
    for case in range(6):
        rows = [("s", seg, rng.choice([60, 110, 130, 300, 500, 900]), float(rng.randint(90, 100)), k) for k, seg in enumerate(rng.choices(range(1, 9), k=12 if case else 40))]
        df = spark.createDataFrame(rows, "sample_id string, segment int, length int, pident double, ord int")
        start, floor, step = 800, 125, 50
        chosen, rung, used = {}, start, floor
        while True:
            for _, seg, n, p, o in sorted(rows, key=lambda r: (-r[2], -r[3], r[4])):
                if n >= rung:
                    chosen.setdefault(seg, o)
            used = rung
            if len(chosen) == 8 or rung == floor:
                break
            rung = max(floor, rung - step)
        best = assign.best_contigs(df)
        assert {r.segment: r.ord for r in best.collect()} == chosen
        limit = [r.min_used for r in assign.contig_limit(best, start).collect()]
        assert limit == ([used] if chosen else [])


def test_shares_and_rollup(spark, trees):  # noqa: F811
    report = spark.createDataFrame(
        [("a", "{'Gallus gallus': 0.8, 'Anas platyrhynchos': 0.2}", "{'USA': 0.9, 'Brazil': 0.1}"), ("b", "Homo sapiens", "Brazil"), ("c", "{'Gallus gallus': 1, 'Anas platyrhynchos': 1, 'Homo sapiens': 1}", "{'USA': 1, 'France': 1, 'Brazil': 1}"), ("d", "", None)],
        "id string, h string, c string",
    ).select("id", D.parse_distribution(F.col("h")).alias("host"), D.parse_distribution(F.col("c")).alias("country"))
    places = spark.createDataFrame([("USA", "United States of America"), ("unknown", None)], "raw string, canonical string")
    hosts = spark.createDataFrame([("chicken", "Gallus gallus")], "raw string, canonical string")
    got = {r.id: (r.host_family, r.host_class, r.country_region, r.country_continent) for r in jobs.report_rollup(report, trees["geo"], trees["taxa"], places, hosts, ["id"]).collect()}
    assert got["a"] == ("{'Phasianidae': 0.80, 'Anatidae': 0.20}", "{'Aves': 1.00}", "{'Northern America': 0.90, 'South America': 0.10}", "{'North America': 0.90, 'South America': 0.10}")
    assert got["b"] == ("{'Hominidae': 1.00}", "{'Mammalia': 1.00}", "{'South America': 1.00}", "{'South America': 1.00}")
    assert got["c"][0] == "{'Anatidae': 0.34, 'Hominidae': 0.33, 'Phasianidae': 0.33}" and got["c"][1] == "{'Aves': 0.67, 'Mammalia': 0.33}"
    assert got["c"][2] == "{'Northern America': 0.34, 'South America': 0.33, 'Western Europe': 0.33}" and got["c"][3] == "{'Europe': 0.34, 'North America': 0.33, 'South America': 0.33}"
    assert set(got["d"]) == {"Unknown"}


def test_composition(spark):
    members = spark.createDataFrame([(">Cluster 1", "ACC1", True), (">Cluster 1", "ACC2", False), (">Cluster 2", "ACC3", True)], "cluster string, accession string, is_rep boolean")
    meta = spark.createDataFrame([("ACC1", "duck"), ("ACC2", "hen"), ("ACC3", "pig")], "ACCESSION string, HOST string")
    report = spark.createDataFrame([(">Cluster 1",), (">Cluster 1",), ("UNCLUSTERED",), (None,)], "cluster string")
    assert {(r.accession, r.HOST) for r in profile.cluster_composition(report, members, meta).collect()} == {("ACC1", "duck"), ("ACC2", "hen")}


def test_dates_and_profile(spark):
    members = spark.createDataFrame([("c", k, a, k == 0) for k, a in enumerate(["A", "B", "C", "D", "E"])], "cluster string, member_idx int, accession string, is_rep boolean")
    meta = spark.createDataFrame([("A", "H5N1", 4, "duck", "France", "2021"), ("B", "H5N1", 4, "hen", "France", "2021-03"), ("C", None, 4, "duck", "Spain", "2020-12-31"), ("D", "H1N1", 4, "duck", "Spain", "2021-13"), ("E", "H1N1", 4, "duck", "Spain", "")], "ACCESSION string, GENOTYPE string, SEGMENT int, HOST string, COUNTRY string, COLLECTION_DATE string")
    row = profile.cluster_profile(members, meta).first()
    assert row.collection_date == "2020-12-31 - 2021-03" and row.representative == "A"
    assert [tuple(x) for x in row.hosts] == [("duck", 4.0), ("hen", 1.0)] and [tuple(x) for x in row.genotypes] == [("H5N1", 2.0), ("H1N1", 2.0)]


def test_curation(spark):
    rows = [(a, g, k) for a, g in (("x", "H5N1"), ("y", "H5"), ("z", "mixed"), ("w", "h3n2"), (None, "bad")) for k in (1, 2)]
    df = spark.createDataFrame([(f"{a}{k}", a, g) for a, g, k in rows], "ACCESSION string, ASSEMBLY string, GENOTYPE string")
    assert {r.ACCESSION for r in quality.offending_genotypes(df).collect()} == {"y1", "y2", "z1", "z2"}
    sizes = spark.createDataFrame([(g, k) for g, n in (("a", 7), ("b", 8), ("c", 9)) for k in range(n)], "g string, k int")
    assert {r.g for r in quality.complete_groups(sizes, "g", 8).collect()} == {"b", "c"}
    assert quality.drop_incomplete(spark.createDataFrame([("a", ""), ("b", None), ("c", "x")], "k string, v string"), "v").count() == 1


def test_update(spark):
    meta = spark.createDataFrame([(f"A{k}", "asm", k, "H5N1v", "duck", "France", 2300 if k == 1 else 2250 if k == 2 else 2100 if k == 3 else 1700 if k == 4 else 1500 if k == 5 else 1400 if k == 6 else 1000 if k == 7 else 850) for k in range(1, 9)], "ACCESSION string, ASSEMBLY string, SEGMENT int, GENOTYPE string, HOST string, COUNTRY string, LENGTH int")
    seqs = spark.createDataFrame([(f"A{k}|x", "ACGT" * 10 if k != 5 else "N" * 40) for k in range(1, 9)], "header string, seq string")
    kept, chosen = jobs.curate_update(meta, seqs)
    assert kept.count() == 7 and chosen.count() == 7
    report = spark.createDataFrame([(f"A{k}", k, ["H5N1"] if k != 3 else ["H1N1"]) for k in range(1, 9)], "accession string, segment int, genotypes array<string>")
    main = spark.createDataFrame([("A1", "asm", 1, "H5N1", "duck", "France", 2300)], kept.select("ACCESSION", "ASSEMBLY", "SEGMENT", "GENOTYPE", "HOST", "COUNTRY", "LENGTH").schema)
    whole, _ = jobs.update_db(main, chosen.limit(0), kept, chosen, report)
    assert sorted(r.ACCESSION for r in whole.collect()) == ["A1", "A2", "A4", "A6", "A7", "A8"]


def _mutate(rng, seq, rate):
    return "".join(rng.choice("ACGT") if rng.random() < rate else c for c in seq)


def test_similarity_recall(spark):
    """Every pair at 90 % by brute-force alignment is found, on either strand, with its identity."""
    rng = random.Random(5)
    base = ["".join(rng.choice("ACGT") for _ in range(300)) for _ in range(6)]
    targets = [(f"t{k}", s) for k, s in enumerate(base)]
    queries = [(f"q{k}", _mutate(rng, s, 0.03)) for k, s in enumerate(base)] + [("gap", base[0][:150] + base[0][155:]), ("far", "".join(rng.choice("ACGT") for _ in range(300))), ("short", "ACG"), ("empty", "")]
    q, t = spark.createDataFrame(queries, "id string, seq string"), spark.createDataFrame(targets, "id string, seq string")
    q = q.unionByName(q.filter("id = 'q1'").select(F.lit("rev").alias("id"), similarity.reverse_complement(F.col("seq")).alias("seq")))
    got = {(r.qseqid, r.sseqid): (r.pident, r.strand) for r in similarity.similarity_join(q, t, 0.9, 11).collect()}
    assert set(got) == {(f"q{k}", f"t{k}") for k in range(6)} | {("gap", "t0"), ("rev", "t1")}
    assert got["rev", "t1"][1] == "-" and got["rev", "t1"][0] == got["q1", "t1"][0]
    assert got["gap", "t0"][0] == pytest.approx(100 * 295 / 300)


def test_identify(spark):
    rng = random.Random(7)
    base = ["".join(rng.choice("ACGT") for _ in range(500)) for _ in range(3)]
    seqs = [("s", 1, "near", _mutate(rng, base[0], 0.002)), ("s", 2, "mid", _mutate(rng, base[1], 0.04)), ("s", 3, "db", base[2]), ("s", 4, "none", "".join(rng.choice("ACGT") for _ in range(500))), ("s", 5, "tiny", "ACGT")]
    seqs = spark.createDataFrame([(*r, len(r[3])) for r in seqs], "sample_id string, ord int, header string, seq string, length int")
    reps = spark.createDataFrame([("R0", base[0]), ("R1", base[1])], "id string, seq string")
    db = reps.unionByName(spark.createDataFrame([("D2", base[2])], "id string, seq string"))
    profiles = spark.createDataFrame([(f">C{k}", f"R{k}", [("4", 1.0)], [("H5N1", 3.0), ("H1N1", 1.0)], [("duck", 2.0)], [("France", 2.0)], "2021") for k in range(2)], f"cluster string, representative string, segments {DIST}, genotypes {DIST}, hosts {DIST}, countries {DIST}, collection_date string")
    meta = spark.createDataFrame([("D2", "H3N2", 6, "pig", " South Korea ", None)], "ACCESSION string, GENOTYPE string, SEGMENT int, HOST string, COUNTRY string, COLLECTION_DATE string")
    report = jobs.identify(seqs, None, reps, db, profiles, meta)
    got = {r.sample_name: r for r in report.collect()}
    assert {k: r.assigned_by for k, r in got.items()} == {"near": "CD-HIT", "mid": "C-BLAST", "db": "L-BLAST", "none": "Unassigned"}
    assert [tuple(x) for x in got["near"].genotype] == [("H5N1", 0.75), ("H1N1", 0.25)]
    assert got["db"].country[0].key == "South Korea" and got["db"].collection_date == "Unknown" and got["none"].representative == "Unassigned"
    routed = {r.sample_name: (r.segment, r.to_clade) for r in jobs.route_samples(report).collect()}
    assert routed["near"] == (4, True) and routed["db"] == (6, False)
    members, built = jobs.build_cluster_db(db.select(F.col("id").alias("accession"), "seq"), meta)
    assert members.count() == 3 and built.count() == 3
    summary = jobs.batch_report(report, spark.createDataFrame([("s", "in", "tag"), ("t", "in2", "tag2")], "sample_id string, input_file string, file_tag string"), spark.createDataFrame([("s", "PB2:627K")], "sample string, label string"), spark.createDataFrame([("s", "x")], "sample_id string, clade string"),
        spark.createDataFrame([], "sample_id string, ord int, genotype string, sub_genotype string, PB2 string, PB1 string, PA string, NP string, `NA` string, MP string, NS string"))
    assert {r.sample_id: (r.status, r.mutations_of_interest) for r in summary.collect()} == {"s": ("ok", "PB2:627K"), "t": ("failed", "")}
    background = jobs.segment_background(report, seqs, dims.segment_dim(spark))
    assert {r.sample_name: r.length_class for r in background.collect()}["near"] == "below"


def test_sample_is_repeatable(spark):
    """A seed draws the same rows whatever the partitions, another seed others; fewer rows are all taken."""
    df = spark.range(500).selectExpr("id", "id % 7 AS g")
    drawn = [sorted(r.id for r in quality.sample_n(d, 40, seed).collect()) for d, seed in ((df, 1), (df.repartition(13, "g"), 1), (df.repartition(3), 1), (df, 2))]
    assert drawn[0] == drawn[1] == drawn[2] != drawn[3] and len(set(drawn[0])) == 40
    assert quality.sample_n(df.limit(5), 40).count() == 5 and quality.sample_n(df, 3, key=["id"]).count() == 3


def test_demultiplex(spark):
    df = spark.createDataFrame([("EPI_ISL_1|HA", "A"), ("EPI_ISL_1|NA", "C")], "header string, seq string")
    pattern = r"(?P<sample>EPI_ISL_\d+)"
    assert {r.sample_id for r in jobs.demultiplex(df, pattern).collect()} == {"EPI_ISL_1"}
    more = df.unionByName(spark.createDataFrame([("other", "G")], "header string, seq string"))
    with pytest.raises(ValueError, match="1 headers"):
        jobs.demultiplex(more, pattern)
    assert jobs.demultiplex(more, pattern, force=True).count() == 2
    names = samples.safe_file_names(spark.createDataFrame([("a b",), ("a/b",)], "sample_id string")).collect()
    assert len({r.file_name for r in names}) == 2 and "a_b" in {r.file_name for r in names}


def test_markers_and_inputs(spark):
    markers = spark.createDataFrame([("sample_b", "M2:A31N"), ("sample_b", "PB1:I13P"), ("sample_a", "M1:T95K"), ("sample_a", "PB1-F2:N66S"), ("sample_a", "PB2:E627K"), ("sample_a", "HA:E627K"), ("x", "bad")], "sample string, raw string")
    assert [(r.sample, r.label) for r in jobs.mutation_table(markers).collect()] == [("sample_a", "PB2:627K"), ("sample_a", "PB1-F2:66S"), ("sample_a", "M1:95K"), ("sample_b", "M2:31N")]
    rows = spark.createDataFrame([("Seq-1", ">orig_x", "HA", "A", 1), ("Seq-2", ">orig_x", "HA", "C", 2)], "internal_id string, header string, segment_name string, seq string, ord int")
    assert {r.header for r in writers.tool_input(rows).collect()} == {"Seq-1_HA", "Seq-2_HA"}
    assert {r.header for r in writers.tool_input(rows, "__SEP__", True).collect()} == {"orig_x__SEP__HA", "orig_x__DUP2__SEP__HA"}


def test_constellation_names(spark):
    raw = spark.createDataFrame([("n1", "G", None, "1", "?", "", None, None, None, None, None, 1), ("n2", "G", "", "?", "?", "?", "?", "?", "?", "?", " x ", 2), ("n3", "G", "s", "1", "2", "3", "4", "5", "6", "7", "", 3)], "`Sample Name` string, Genotype string, `Sub-genotype` string, PB2 string, PB1 string, PA string, NP string, `NA` string, MP string, NS string, Notes string, ord int")
    names = spark.createDataFrame([("PB2", "stem_PB2"), ("HA", "stem_HA")], "segment_name string, header string")
    good, skipped = samples.constellation_rows(raw, names)
    got = {r.ord: (r.sample_name, r.sub_genotype, r.output_format) for r in good.collect()}
    assert got[3] == ("stem", "s", "constellation") and got[1][:2] == ("stem_PB2", "N/A")
    assert [r.reason for r in skipped.collect()] == ["no_valid_segment"]


def test_streams(spark, tmp_path):
    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    for k in range(3):
        spark.createDataFrame([(k, 10 * k, "a"), (k, 5, "b")], "q int, score int, hit string").coalesce(1).write.mode("append").parquet(src)
    like = spark.read.parquet(src)
    streaming.each_batch(streaming.stream_table(spark, src, like, 1), lambda df: assign.first_wins(df, ["q"], [F.desc("score")]), out, str(tmp_path / "cp")).awaitTermination(120)
    assert spark.read.parquet(out).count() == 3
    query = streaming.running_best(streaming.stream_table(spark, src, like, 1), "q", "score", "hit").writeStream.outputMode("complete").format("memory").queryName("best").option("checkpointLocation", str(tmp_path / "cp2")).trigger(availableNow=True).start()
    query.awaitTermination(120)
    assert {r.q: r.hit for r in spark.table("best").collect()} == {0: "b", 1: "a", 2: "a"}
