"""Registered queries of the jobs, and of functions and operators that no other query reaches. Sequences and reports are
derived from the driver's tables by Spark."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import dist as D
from ..functions import text as T
from ..functions.domain import LENGTHS, SEGMENTS, UPDATE_LENGTHS
from ..operators import assign, dims, profile, quality, samples
from ..schemas import with_defaults
from ..shared import stored
from . import jobs
from .queries import _FOUND_SQL, _LR, _SAMPLE_SQL, _SEG, _markers, _nation_entries, _sample_rows, _tree
from .registry import Tables, query, text_of

_HEX, _DNA = "0123456789abcdef", "ACGTTGCACATGGTAC"


def _text(c: str) -> Column:
    return F.col(c).cast("string")


def _one(c: Column) -> Column:
    """A distribution of one key."""
    return F.array(F.struct(c.cast("string").alias("key"), F.lit(1.0).alias("weight")))


def _dna(key: Column, digests: int) -> Column:
    """Letters made of digests of a key and a number, 32 each."""
    return F.translate(F.concat(*[F.md5(F.concat(key, F.lit(f"/{i}"))) for i in range(digests)]), _HEX, _DNA)


@query("""
WITH b AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_discount, l_extendedprice DESC, l_partkey) AS n FROM lineitem)
SELECT 'q' || l_orderkey AS internal_id, l_partkey::VARCHAR AS representative, p_brand AS genotype, p_size::VARCHAR AS segment, p_type AS host, coalesce(nullif(CASE WHEN l_partkey % 3 = 0 THEN '' ELSE '20' || (10 + l_partkey % 9) END, ''), 'Unknown') AS collection_date
FROM b JOIN part ON l_partkey = p_partkey WHERE n = 1""")
def annotate_by_metadata(t: Tables) -> DataFrame:
    hits = t.lineitem.select(F.concat(F.lit("q"), _text("l_orderkey")).alias("qseqid"), F.col("l_partkey").alias("sseqid"), F.col("l_discount").alias("evalue"), F.col("l_extendedprice").alias("pident"))
    day = F.when(F.col("p_partkey") % 3 == 0, " ").otherwise(F.concat(F.lit("20"), (10 + F.col("p_partkey") % 9).cast("string")))
    meta = t.part.select(F.col("p_partkey").alias("ACCESSION"), F.concat(F.lit(" "), "p_brand").alias("GENOTYPE"), F.col("p_size").alias("SEGMENT"), F.col("p_type").alias("HOST"), F.lit("x").alias("COUNTRY"), day.alias("COLLECTION_DATE"))
    out = assign.annotate_by_metadata(hits, meta)
    return out.select("internal_id", _text("representative").alias("representative"), "genotype", "segment", "host", "collection_date")


@query("""
WITH m AS (SELECT c_nationkey, c_custkey, c_mktsegment, CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE '20' || (10 + c_custkey % 7) END AS y FROM customer),
c AS (SELECT c_nationkey, c_mktsegment, count(*) AS n, min(c_custkey) AS f FROM m GROUP BY ALL),
h AS (SELECT c_nationkey, string_agg(c_mktsegment || '=' || n, ';' ORDER BY f) AS hosts FROM c GROUP BY 1),
d AS (SELECT c_nationkey, min(c_custkey)::VARCHAR AS representative, min(y) AS a, max(y) AS b FROM m GROUP BY 1)
SELECT c_nationkey AS cluster, representative, hosts, CASE WHEN a IS NULL THEN 'Unknown' WHEN a = b THEN a ELSE a || ' - ' || b END AS collection_date FROM d JOIN h USING (c_nationkey)""")
def whole_cluster_profile(t: Tables) -> DataFrame:
    """Customers of a nation as members of a cluster, the first as its representative."""
    k = F.col("c_custkey")
    first = t.customer.groupBy(F.col("c_nationkey").alias("n")).agg(F.min("c_custkey").alias("f"))
    members = t.customer.join(first, F.col("c_nationkey") == F.col("n")).select(F.col("c_nationkey").alias("cluster"), k.cast("int").alias("member_idx"), k.cast("string").alias("accession"), (k == F.col("f")).alias("is_rep"))
    day = F.when(k % 4 > 0, F.concat(F.lit("20"), (10 + k % 7).cast("string")))
    meta = t.customer.select(k.cast("string").alias("ACCESSION"), F.lit("H5N1").alias("GENOTYPE"), (k % 8 + 1).alias("SEGMENT"), F.col("c_mktsegment").alias("HOST"), F.lit("x").alias("COUNTRY"), day.alias("COLLECTION_DATE"))
    return profile.cluster_profile(members, meta).select("cluster", "representative", text_of("hosts", "hosts"), "collection_date")


@query("""
WITH c AS (SELECT c_nationkey, c_mktsegment, min(c_custkey) AS f FROM customer GROUP BY ALL)
SELECT c_nationkey, string_agg(c_mktsegment, ';' ORDER BY f) AS keys FROM c WHERE c_nationkey % 2 = 0 GROUP BY 1""")
def field_keys(t: Tables) -> DataFrame:
    counts = profile.value_counts(t.customer, "c_nationkey", ["c_mktsegment"], "c_custkey").withColumn("pident", F.when(F.col("c_nationkey") % 2 == 0, 99.0))
    return profile.field_keys(counts, "c_mktsegment").select("c_nationkey", F.array_join("c_mktsegment_keys", ";").alias("keys"))


@query("""
WITH c AS (SELECT c_nationkey, c_mktsegment, count(*) AS n, min(c_custkey) AS f FROM customer GROUP BY ALL)
SELECT c_nationkey, string_agg(c_mktsegment || '=' || n, ';' ORDER BY f) AS segments FROM c WHERE c_nationkey IN (SELECT n_nationkey FROM nation WHERE n_regionkey < 2) GROUP BY 1""")
def cluster_field(t: Tables) -> DataFrame:
    """One field of the profiles of a list of clusters."""
    counts = profile.value_counts(t.customer, "c_nationkey", ["c_mktsegment"], "c_custkey")
    wanted = t.nation.filter("n_regionkey < 2").select(F.col("n_nationkey").alias("c_nationkey"))
    return profile.cluster_field(counts, "c_mktsegment", wanted, "c_nationkey").select("c_nationkey", text_of("c_mktsegment", "segments"))


@query("""
SELECT r_name AS name, NULL AS subfamily, NULL AS family, r_name AS division, r_name AS class FROM region
UNION ALL SELECT n_name, n_name, n_name, r_name, r_name FROM nation JOIN region ON n_regionkey = r_regionkey""")
def taxa_dimension(t: Tables) -> DataFrame:
    """Regions as classes and nations as families of a taxonomy tree: subfamily and division fall back."""
    as_taxa = F.when(F.col("rank") == "region", "class").otherwise("family")
    lineage = F.transform("lineage", lambda x: F.struct(x["name"].alias("name"), F.when(x["rank"] == "region", "class").otherwise("family").alias("rank")))
    nodes = dims.walk_tree(_tree(t)).select("name", as_taxa.alias("rank"), "depth", lineage.alias("lineage"))
    return dims.taxa_dim(nodes).select("name", "subfamily", "family", "division", "class")


@query(r"""
SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN 'NC_' || o_orderkey || '.1' WHEN 1 THEN 'AB' || o_orderkey || '.2' WHEN 2 THEN o_orderkey || '.3' END AS accession FROM orders""")
def ncbi_accession(t: Tables) -> DataFrame:
    """RefSeq, GenBank and numeric accessions in headers, and headers without one."""
    k = _text("o_orderkey")
    kind = F.col("o_orderkey") % 4
    header = F.when(kind == 0, F.concat(F.lit(">NC_"), k, F.lit(".1 |x"))).when(kind == 1, F.concat(F.lit(">AB"), k, F.lit(".2"))).when(kind == 2, F.concat(F.lit(">"), k, F.lit(".3|y"))).otherwise(F.concat(F.lit(">id "), k))
    return t.orders.select("o_orderkey", T.ncbi_accession(header).alias("accession"))


@query("SELECT 'AB' || o_orderkey || '.2' AS accession FROM orders WHERE o_orderkey % 2 = 0")
def header_accessions(t: Tables) -> DataFrame:
    """Distinct accessions in headers, each header twice."""
    k = F.col("o_orderkey")
    rows = t.orders.select(F.when(k % 2 == 0, F.concat(F.lit("AB"), k.cast("string"), F.lit(".2|"), "o_orderstatus")).otherwise("none").alias("header"))
    return quality.header_accessions(rows.unionByName(rows))


@query("""
SELECT o_orderkey, CASE o_orderkey % 3 WHEN 0 THEN 'duck' WHEN 1 THEN 'Homo sapiens' END AS host, CASE WHEN o_orderkey % 3 < 2 THEN o_orderpriority END AS location,
  CASE WHEN o_orderkey % 3 < 2 THEN o_custkey::VARCHAR END AS number, CASE WHEN o_orderkey % 3 < 2 THEN strftime(o_orderdate, '%Y') END AS year FROM orders""")
def strain_parts(t: Tables) -> DataFrame:
    kind, rest = F.col("o_orderkey") % 3, F.concat_ws("/", "o_orderpriority", _text("o_custkey"), F.date_format("o_orderdate", "yyyy"))
    name = F.when(kind == 0, F.concat(F.lit("Virus (A/duck/"), rest, F.lit(")"))).when(kind == 1, F.concat(F.lit("Virus (A/"), rest, F.lit(")"))).otherwise("Virus")
    return t.orders.select("o_orderkey", T.strain_parts(name).alias("p")).select("o_orderkey", "p.host", "p.location", "p.number", "p.year")


_NAMES = "['PB2', 'PB1', 'PA', 'HA', 'NP', 'NA', 'MP', 'NS']"


@query(f"""
SELECT o_orderkey, CASE WHEN o_orderkey % 10 < 8 THEN (o_orderkey % 10 + 1)::INT END AS number, CASE WHEN o_orderkey % 10 < 8 THEN {_NAMES}[o_orderkey % 10 + 1] END AS name,
  CASE WHEN o_orderkey % 5 > 0 THEN (o_orderkey % 100)::DOUBLE END AS pident, o_orderkey % 3 < 2 AS whole, CASE WHEN o_orderkey % 10 < 8 THEN (o_orderkey % 10 + 1)::INT ELSE 999 END AS rank FROM orders""")
def cell_values(t: Tables) -> DataFrame:
    """Segments by acronym or number, identities with a percent sign, whole subtypes with stray v's, and report order."""
    k = F.col("o_orderkey")
    at = (k % 10 + 1).cast("int")
    segment = F.when(k % 10 < 8, F.when(k % 2 == 0, T.segment_name(at)).otherwise(F.concat(F.lit(""), at.cast("string")))).otherwise("other")
    pident = F.when(k % 5 > 0, F.concat(F.lit(" "), (k % 100).cast("string"), F.when(k % 2 == 0, "%").otherwise(""))).otherwise("NA")
    geno = F.when(k % 3 == 0, "H5N1v").when(k % 3 == 1, "h12n3").otherwise("H5")
    number = T.segment_number(F.lower(segment))
    return t.orders.select("o_orderkey", number.alias("number"), T.segment_name(number).alias("name"), T.percent_identity(pident).alias("pident"), T.full_subtype(geno).alias("whole"), samples.segment_order(T.segment_name(number)).alias("rank"))


@query("SELECT page_id, CASE WHEN strpos(url, 'NS') > 0 THEN 'NS' ELSE 'none' END AS hit FROM pages")
def mined_segment_loose(t: Tables) -> DataFrame:
    """Segment names anywhere in a text, case-sensitive: a marker is put behind some URLs."""
    seen = T.mined_segment_loose(F.regexp_replace("url", "[^NS]", " "))
    return t.pages.select("page_id", F.when(seen == "8", "NS").otherwise("none").alias("hit"))


@query("""
WITH c AS (SELECT c_nationkey, c_mktsegment, count(*) AS w FROM customer GROUP BY ALL), s AS (SELECT *, sum(w) OVER (PARTITION BY c_nationkey) AS total FROM c)
SELECT c_nationkey, c_mktsegment, round(CASE WHEN total > 1.1 THEN w / 100.0::DOUBLE ELSE w END, 3)::DOUBLE AS share FROM s""")
def clean_distribution(t: Tables) -> DataFrame:
    """Counts taken for percentages wherever they add up to more than 1.1."""
    counts = profile.value_counts(t.customer, "c_nationkey", ["c_mktsegment"], "c_custkey").withColumn("d", D.clean(F.col("c_mktsegment")))
    return profile.exploded(counts, ["c_nationkey"], "d").select("c_nationkey", F.col("key").alias("c_mktsegment"), F.col("weight").alias("share"))


@query("SELECT least(200, count(*)) AS n, least(200, count(*)) AS n_distinct, least(200, count(*)) AS n_known FROM orders")
def sample_n(t: Tables) -> DataFrame:
    """200 orders drawn without replacement (the sampling operator): how many, how many distinct, how many of the table."""
    drawn = quality.sample_n(t.orders.select("o_orderkey"), 200, seed=7)
    known = t.orders.select(F.col("o_orderkey").alias("known"))
    return drawn.join(known, F.col("o_orderkey") == F.col("known"), "left").agg(F.count("*").alias("n"), F.countDistinct("o_orderkey").alias("n_distinct"), F.count("known").alias("n_known"))


@query(_FOUND_SQL + """,
e AS (SELECT *, CASE locus WHEN 'PB1-F2' THEN 'PB1' WHEN 'M1' THEN 'MP' WHEN 'M2' THEN 'MP' ELSE locus END AS segment FROM p)
SELECT sample, locus || ':' || mutation AS label, CASE WHEN segment IN ('PB2', 'HA') THEN 'effect of ' || segment END AS effect,
  row_number() OVER (PARTITION BY sample ORDER BY list_position(['PB2', 'PB1', 'PB1-F2', 'PA', 'PA-X', 'HA', 'NP', 'NA', 'M1', 'M2'], locus), locus, mutation) AS place FROM e""")
def mutation_table(t: Tables) -> DataFrame:
    """Markers with their effects, and the place of each in its sample in report order."""
    effects = _markers(t).select(T.mutation_parts(F.col("raw")).alias("m")).select("m.segment", "m.mutation").distinct().filter(F.col("segment").isin("PB2", "HA"))
    found = jobs.mutation_table(_markers(t), effects.withColumn("effect", F.concat(F.lit("effect of "), "segment")))
    place = F.row_number().over(Window.partitionBy("sample").orderBy(*samples.marker_order()))
    return found.select("sample", "label", "effect", place.cast("long").alias("place"))


@query("SELECT c_custkey AS sample_id FROM customer WHERE c_acctbal >= 0 AND c_custkey % 3 > 0")
def successful(t: Tables) -> DataFrame:
    k = F.col("c_custkey")
    rows = t.customer.select(k.alias("sample_id"), F.when(F.col("c_acctbal") < 0, "failed").otherwise(" OK ").alias("status"), F.when(k % 3 > 0, "tag").otherwise(" ").alias("file_tag"))
    return samples.successful(rows).select("sample_id")


@query("""
WITH r AS (SELECT *, row_number() OVER (PARTITION BY o_custkey, o_orderpriority ORDER BY o_totalprice DESC, o_orderkey) AS n FROM orders), c AS (SELECT o_custkey, o_orderkey FROM r WHERE n = 1 AND o_totalprice >= 300000)
SELECT o_orderkey FROM c UNION ALL SELECT o_orderkey FROM orders WHERE o_custkey NOT IN (SELECT o_custkey FROM c)""")
def chosen_contigs(t: Tables) -> DataFrame:
    """Orders of customers restricted to the best of each priority, where any is large enough."""
    rows = t.orders.select(F.col("o_custkey").alias("sample_id"), F.col("o_orderpriority").alias("segment"), F.col("o_totalprice").alias("length"), F.lit(1.0).alias("pident"), F.col("o_orderkey").alias("ord"), _text("o_orderkey").alias("sample_name"))
    return samples.chosen_contigs(rows, assign.best_contigs(rows, 300000)).select(F.col("ord").alias("o_orderkey"))


@query("SELECT doc_id, coalesce(quality, -1) AS quality, 'none' AS note FROM documents LEFT JOIN labels USING (doc_id)")
def with_default_values(t: Tables) -> DataFrame:
    return with_defaults(t.documents.join(t.labels, "doc_id", "left"), quality=-1, note="none").select("doc_id", "quality", "note")


@query("SELECT count(*) FILTER (WHERE c_acctbal >= 0) AS n_ok, count(*) FILTER (WHERE NOT c_acctbal >= 0) AS n_failed FROM customer")
def batch_counts(t: Tables) -> DataFrame:
    return samples.batch_counts(t.customer.select(F.when(F.col("c_acctbal") < 0, "failed").otherwise("OK").alias("status")))


_IDENTIFIED = """
WITH s AS (SELECT DISTINCT o_custkey AS c, o_orderkey % 4 AS kind FROM orders)
SELECT 'o' || c || '_' || kind AS sample_name, CASE WHEN {listed} THEN 'CD-HIT' WHEN kind = 3 THEN 'Unassigned' WHEN c % 2 = 1 THEN 'L-BLAST' WHEN kind = 1 THEN 'C-BLAST' ELSE 'CD-HIT' END AS assigned_by,
  CASE WHEN kind = 3 AND NOT {listed} THEN 'Unassigned' ELSE 'c' || c END AS representative, CASE WHEN {listed} THEN 'H5N1' WHEN kind = 3 THEN NULL WHEN c % 2 = 1 THEN 'H1N1' ELSE 'H5N1' END AS genotype FROM s"""


def _identified(t: Tables, members: DataFrame | None) -> DataFrame:
    """Sequences of 416 letters for each customer and kind of order: a copy of the customer's own (0), one with every fortieth
    letter changed (1), a piece of it behind other letters (2), or another (3). Customers of even keys represent clusters."""
    tasks = int(t.spark.conf.get("spark.sql.shuffle.partitions"))  # the letters take longer than the bytes of the keys suggest
    seqs = t.orders.select("o_custkey", (F.col("o_orderkey") % 4).alias("kind")).distinct().repartition(tasks, "o_custkey", "kind")
    own = _dna(F.concat(F.lit("c"), _text("o_custkey")), 13)
    worn = F.array_join(F.transform(F.sequence(F.lit(0), F.lit(10)), lambda i: F.concat(F.substring(own, i * 40 + 1, F.lit(39)), F.translate(F.substring(own, i * 40 + 40, F.lit(1)), "ACGT", "CGTA"))), "")
    piece = F.substring(own, 1, 416)
    seq = F.when(F.col("kind") == 0, own).when(F.col("kind") == 1, worn).when(F.col("kind") == 2, piece).otherwise(_dna(F.concat(F.lit("other"), _text("o_custkey")), 13))
    rows = seqs.select(F.concat(F.lit("s"), (F.col("o_custkey") % 10).cast("string")).alias("sample_id"), (F.col("o_custkey") * 4 + F.col("kind")).alias("ord"), F.concat(F.lit("o"), _text("o_custkey"), F.lit("_"), _text("kind")).alias("header"), seq.alias("seq"))
    name = F.concat(F.lit("c"), _text("c_custkey"))
    database = stored(t.customer.repartition(tasks, "c_custkey").select(name.alias("id"), _dna(name, 13).alias("seq"), "c_custkey"), "database")
    even = F.col("c_custkey") % 2 == 0
    profiles = t.customer.filter(even).select(F.concat(F.lit(">C"), _text("c_custkey")).alias("cluster"), name.alias("representative"), *[_one(F.lit(v)).alias(c) for c, v in (("segments", "4"), ("genotypes", "H5N1"), ("hosts", "duck"), ("countries", "x"))], F.lit("2021").alias("collection_date"))
    meta = t.customer.select(name.alias("ACCESSION"), F.lit("H1N1").alias("GENOTYPE"), F.lit(4).alias("SEGMENT"), F.lit("pig").alias("HOST"), F.lit("x").alias("COUNTRY"), F.lit(None).cast("string").alias("COLLECTION_DATE"))
    # Unlike sequences have words of 24 letters in common by chance from some 15,000 customers on; such hits (scores of 24 to about 40 of 416) are told by their e-values.
    report = jobs.identify(stored(rows.withColumn("length", F.length("seq")), "sequences"), members, database.filter(even).select("id", "seq"), database.select("id", "seq"), profiles, meta, k=24, expected=1e-20)
    return report.select("sample_name", "assigned_by", "representative", D.first_key(F.col("genotype")).alias("genotype"))


@query(_IDENTIFIED.format(listed="false"))
def identify(t: Tables) -> DataFrame:
    return _identified(t, None)


@query(_IDENTIFIED.format(listed="(c % 2 = 0 AND (kind = 3 OR kind = 1 AND c % 4 = 0))"))
def identify_by_members(t: Tables) -> DataFrame:
    """A cluster table has sequences that are like no representative as members, and worn ones that the search would find."""
    listed = t.orders.filter("o_custkey % 2 = 0 AND (o_orderkey % 4 = 3 OR o_orderkey % 4 = 1 AND o_custkey % 4 = 0)").select("o_custkey", (F.col("o_orderkey") % 4).alias("kind")).distinct()
    name = F.concat(F.lit("o"), _text("o_custkey"), F.lit("_"), _text("kind"))
    return _identified(t, listed.select(F.concat(F.lit(">C"), _text("o_custkey")).alias("cluster"), name.alias("accession"), F.lit(False).alias("is_rep"), F.lit(99.5).alias("identity")))


_REGION = "SELECT c_mktsegment AS g, {level} AS k, count(*) AS w FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY ALL"
_SHARES = "SELECT g, '{' || string_agg('''' || k || ''': ' || printf('%.2f', units / 100.0::DOUBLE), ', ' ORDER BY units DESC, k) || '}' AS shares FROM x GROUP BY g"


def _shares(level: str) -> str:
    return f"({_LR.format(counts=_REGION.format(level=level))} {_SHARES})"


@query(f"""SELECT a.g AS c_mktsegment, a.shares AS country_region, a.shares AS host_class, b.shares AS host_family FROM {_shares("r_name")} a JOIN {_shares("n_name")} b USING (g)""")
def report_rollup(t: Tables) -> DataFrame:
    """Market segments with their nations as countries and as hosts, rolled up over a geography and a taxonomy."""
    entries = _nation_entries(t)
    cells = F.sort_array(F.collect_list(F.struct(F.col("n_name").alias("key"), "weight")))
    report = entries.groupBy("c_mktsegment").agg(cells.alias("host")).withColumn("country", F.col("host"))
    tree = dims.walk_tree(_tree(t))
    lineage = F.transform("lineage", lambda x: F.struct(x["name"].alias("name"), F.when(x["rank"] == "region", "class").otherwise("family").alias("rank")))
    taxa = dims.taxa_dim(tree.select("name", F.when(F.col("rank") == "region", "class").otherwise("family").alias("rank"), "depth", lineage.alias("lineage")))
    none = t.nation.select(F.lower("n_name").alias("raw"), F.col("n_name").alias("canonical"))
    out = jobs.report_rollup(report, dims.geo_dim(tree), taxa, none, none, ["c_mktsegment"])
    return out.select("c_mktsegment", "country_region", "host_class", "host_family")


@query(_SAMPLE_SQL + """,
o AS (SELECT sample_id, coalesce(nullif(coalesce(h, '') || coalesce(n, ''), ''), 'Undetermined') AS genotype FROM x),
m AS (SELECT user_id AS sample_id, string_agg(DISTINCT 'PB2:' || (event_id % 3) || 'K', ';' ORDER BY 'PB2:' || (event_id % 3) || 'K') AS muts FROM events GROUP BY 1),
k AS (SELECT user_id AS sample_id, arg_max(event_type, [(event_id % 3 > 0)::INT + (event_id % 2)::INT, -event_id]) AS gt, arg_min(event_id % 3, event_id) FILTER (WHERE event_id % 3 > 0) AS pb2,
  arg_min('7', event_id) FILTER (WHERE event_id % 2 = 1) AS ns FROM events GROUP BY 1)
SELECT c_custkey AS sample_id, CASE WHEN o.sample_id IS NULL THEN 'failed' ELSE 'ok' END AS status, coalesce(genotype, '') AS genotype, coalesce(muts, '') AS mutations_of_interest, CASE WHEN c_custkey % 2 = 0 THEN '2.3' ELSE '' END AS clade,
  coalesce(gt, '') AS genin2_genotype, coalesce(pb2::VARCHAR, '') AS genin2_pb2, coalesce(ns, '') AS genin2_ns
FROM customer LEFT JOIN o ON c_custkey = o.sample_id LEFT JOIN m ON c_custkey = m.sample_id LEFT JOIN k ON c_custkey = k.sample_id""")
def batch_report(t: Tables) -> DataFrame:
    """One row for each customer: whether there are orders, and what they, the events and the clade table tell."""
    rows = _sample_rows(t)
    report = rows.select("sample_id", _one(F.col("segment")).alias("segment"), _one(F.get("genotypes", F.lit(0))).alias("genotype"))
    inputs = t.customer.select(F.col("c_custkey").alias("sample_id"), F.col("c_name").alias("input_file"), F.lit("tag").alias("file_tag"))
    marks = t.events.select(F.col("user_id").alias("sample"), F.concat(F.lit("PB2:"), (F.col("event_id") % 3).cast("string"), F.lit("K")).alias("label"))
    clades = t.customer.filter("c_custkey % 2 = 0").select(F.col("c_custkey").alias("sample_id"), F.lit("2.3").alias("clade"))
    n = F.col("event_id")
    filled = {"genotype": F.col("event_type"), "PB2": F.when(n % 3 > 0, (n % 3).cast("string")).otherwise("?"), "NS": F.when(n % 2 == 1, "7")}
    cells = t.events.select(F.col("user_id").alias("sample_id"), n.alias("ord"), *[filled.get(c, F.lit("")).alias(c) for c in ("genotype", "sub_genotype", *(s for s in SEGMENTS if s != "HA"))])
    return jobs.batch_report(report, inputs, marks, clades, cells).select("sample_id", "status", "genotype", "mutations_of_interest", "clade", "genin2_genotype", "genin2_pb2", "genin2_ns")


@query("""
WITH s AS (SELECT 'C' || c_custkey AS accession, c_custkey // 5 AS g, 320 - c_custkey % 3 AS length FROM customer),
r AS (SELECT *, first_value(accession) OVER (PARTITION BY g ORDER BY length DESC, accession) AS leader FROM s)
SELECT accession, '>Cluster ' || leader AS cluster, accession = leader AS is_rep, (row_number() OVER (PARTITION BY g ORDER BY accession <> leader, length DESC, accession) - 1)::INT AS member_idx FROM r""")
def build_cluster_db(t: Tables) -> DataFrame:
    """Customers in groups of five with one sequence, some cut short: clusters at 99 % with the longest as leader."""
    k = F.col("c_custkey")
    seq = F.substring(_dna(F.concat(F.lit("g"), F.floor(k / 5).cast("string")), 10), F.lit(1), (320 - k % 3).cast("int"))
    rows = t.customer.select(F.concat(F.lit("C"), k.cast("string")).alias("accession"), seq.alias("seq"))
    meta = rows.select(F.col("accession").alias("ACCESSION"), *[F.lit("x").alias(c) for c in ("GENOTYPE", "SEGMENT", "HOST", "COUNTRY", "COLLECTION_DATE")])
    members, _ = jobs.build_cluster_db(rows, meta)
    return members.select("accession", "cluster", "is_rep", "member_idx")


def _bounds(lengths: dict[str, tuple[int, int]]) -> str:
    return "(VALUES " + ", ".join(f"({k}, '{s}', {lengths[s][0]}, {lengths[s][1]})" for k, s in enumerate(SEGMENTS, 1)) + ") AS b(num, name, lo, hi)"


_CURATED = f"""
WITH r AS (SELECT o_orderkey AS k, o_custkey AS c, o_orderstatus AS s, lo + CASE WHEN o_orderkey % 17 = 0 THEN -1 ELSE 0 END AS len, lo, hi FROM orders JOIN {_bounds(UPDATE_LENGTHS)} ON num = o_orderkey % 8 + 1 WHERE o_orderkey % 13 > 0),
g AS (SELECT * FROM r WHERE c NOT IN (SELECT c FROM r WHERE s = 'P') AND len BETWEEN lo AND hi),
w AS (SELECT *, count(*) OVER (PARTITION BY c) AS n FROM g),
u AS (SELECT k FROM w WHERE n >= 4 AND k % 19 > 0)"""


def _update(t: Tables) -> tuple[DataFrame, DataFrame]:
    """Orders as an update: incomplete, offending, too short, lone or ambiguous ones among them."""
    k = F.col("o_orderkey")
    bounds = dims.segment_dim(t.spark, UPDATE_LENGTHS).select("num", "min_len")
    rows = t.orders.join(bounds, (k % 8 + 1) == F.col("num")).select(
        F.concat(F.lit("A"), k.cast("string")).alias("ACCESSION"), _text("o_custkey").alias("ASSEMBLY"), T.segment_name((k % 8 + 1).cast("int")).alias("SEGMENT"), F.when(F.col("o_orderstatus") == "P", "mixed").otherwise("H5N1v").alias("GENOTYPE"),
        F.when(k % 13 == 0, "").otherwise("duck").alias("HOST"), F.lit("x").alias("COUNTRY"), (F.col("min_len") - (k % 17 == 0).cast("int")).cast("string").alias("LENGTH"),
    )
    seqs = t.orders.select(F.concat(F.lit("A"), k.cast("string"), F.lit("|x")).alias("header"), F.when(k % 19 == 0, "NNNNACGT").otherwise("ACGTACGT").alias("seq"))
    return jobs.curate_update(rows, seqs, n_segments=4)


@query(_CURATED + " SELECT 'A' || k AS accession, 'metadata' AS side FROM u UNION ALL SELECT 'A' || k, 'sequences' FROM u")
def curate_update(t: Tables) -> DataFrame:
    meta, seqs = _update(t)
    return meta.select(F.col("ACCESSION").alias("accession"), F.lit("metadata").alias("side")).unionByName(seqs.select("accession", F.lit("sequences").alias("side")))


@query(_CURATED + """
SELECT 'A' || o_orderkey AS accession FROM orders WHERE o_orderkey % 7 = 0 UNION SELECT 'A' || k FROM u WHERE k % 23 > 0""")
def update_db(t: Tables) -> DataFrame:
    """The curated orders added to a database that has every seventh, without those whose report contradicts them."""
    meta, seqs = _update(t)
    k = F.col("o_orderkey")
    report = t.orders.select(F.concat(F.lit("A"), k.cast("string")).alias("accession"), (k % 8 + 1 + (k % 23 == 0).cast("int")).cast("int").alias("segment"), F.array(F.lit("H5N1")).alias("genotypes"))
    main = t.orders.filter("o_orderkey % 7 = 0").select(F.concat(F.lit("A"), k.cast("string")).alias("ACCESSION"), *[F.lit(None).cast(kind).alias(c) for c, kind in meta.dtypes if c != "ACCESSION"])
    stored = main.select(F.col("ACCESSION").alias("accession"), F.lit("h").alias("header"), F.lit("ACGT").alias("seq"))
    whole, _ = jobs.update_db(main, stored, meta, seqs, report)
    return whole.select(F.col("ACCESSION").alias("accession"))


@query(f"""
SELECT o_custkey AS sample_id, 'n' || o_orderkey AS sample_name, name, (o_orderkey % 3000)::INT AS length, CASE WHEN o_orderkey % 3000 < lo THEN 'below' WHEN o_orderkey % 3000 > hi THEN 'above' ELSE 'ok' END AS length_class, num AS rank
FROM orders JOIN {_bounds(LENGTHS)} ON num = {_SEG}""")
def segment_background(t: Tables) -> DataFrame:
    """Orders of all customers as sequences of a segment: length, its class, and report order."""
    rows = _sample_rows(t)
    name = F.concat(F.lit("n"), F.col("ord").cast("string"))
    report = rows.select("sample_id", name.alias("sample_name"), _one(F.col("segment")).alias("segment"), *[_one(F.lit("x")).alias(c) for c in ("genotype", "host", "country")])
    seqs = rows.select(F.concat(F.lit(">"), name).alias("header"), (F.col("ord") % 3000).cast("int").alias("length"))
    return jobs.segment_background(report, seqs, dims.segment_dim(t.spark)).select("sample_id", "sample_name", "name", "length", "length_class", "rank")


@query("""
SELECT doc_id AS key, 'right' AS side FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels) UNION ALL SELECT DISTINCT doc_id, 'left' FROM labels WHERE doc_id NOT IN (SELECT doc_id FROM documents)
UNION ALL SELECT doc_id, 'kept' FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)""")
def reconcile_db(t: Tables) -> DataFrame:
    """Labels as metadata and documents as sequences."""
    diff, kept = jobs.reconcile_db(t.labels.select(F.col("doc_id").alias("ACCESSION")), t.documents.select(F.col("doc_id").alias("accession")))
    return diff.unionByName(kept.select(F.col("accession").alias("key"), F.lit("kept").alias("side")))
