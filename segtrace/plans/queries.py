"""Registered queries: each applies an operator to whole driver tables; SQL is the same in DuckDB's dialect.

The tables hold no sequences, so each operator gets a table of the same shape.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import dist as D
from ..functions import text as T
from ..functions.domain import SUMMARY_FIELDS
from ..operators import assign, dims, profile, quality, samples, similarity
from ..sources import writers
from ..streaming.identify import running_best
from .registry import Tables, query, text_of

_NORM = "regexp_replace(translate(text, 'abcdefghijklmnopqrstuvwxyzXU-', 'ABCDEFGHIJKLMNOPQRSTTVWNYZNT'), '[^ACGTRYSWKMBDHVN]', 'N', 'g')"


@query(f"SELECT doc_id, md5({_NORM}) AS seq_md5, length({_NORM}) AS seq_length FROM documents")
def normalize_sequence(t: Tables) -> DataFrame:
    seq = T.normalize_sequence(F.col("text"))
    return t.documents.select("doc_id", F.md5(seq).alias("seq_md5"), F.length(seq).cast("long").alias("seq_length"))


@query(f"SELECT doc_id, round(100.0 * length(regexp_replace({_NORM}, '[^RYSWKMBDHVN]', '', 'g')) / length({_NORM}), 2) AS ambiguous FROM documents WHERE length(text) > 0")
def ambiguous_fraction(t: Tables) -> DataFrame:
    return t.documents.filter(F.length("text") > 0).select("doc_id", T.ambiguous_percent(T.normalize_sequence(F.col("text"))).alias("ambiguous"))


@query("SELECT doc_id, n_chars, n_chars BETWEEN 400 AND 4000 AS accepted FROM documents")
def length_filter(t: Tables) -> DataFrame:
    kept, rejected = assign.length_filter(t.documents.select("doc_id", "n_chars"), 400, 4000, "n_chars")
    return kept.withColumn("accepted", F.lit(True)).unionByName(rejected.withColumn("accepted", F.lit(False)))


@query("SELECT l_partkey, l_orderkey, l_linenumber, l_suppkey, 'Seq-' || row_number() OVER (PARTITION BY l_partkey ORDER BY l_orderkey, l_linenumber, l_suppkey, l_extendedprice) AS internal_id FROM lineitem")
def assign_internal_ids(t: Tables) -> DataFrame:
    rows = t.lineitem.withColumn("ord", F.struct("l_orderkey", "l_linenumber", "l_suppkey", "l_extendedprice"))
    return assign.assign_internal_ids(rows, "l_partkey", "ord").select("l_partkey", "l_orderkey", "l_linenumber", "l_suppkey", "internal_id")


@query(r"""
SELECT p_partkey, trim(split_part(p_brand || '|' || p_name, '|', 1)) AS accession,
  coalesce(nullif(upper(regexp_extract(p_brand, '(?i)(d#?\d+)', 1)), ''), 'none') AS token,
  CASE WHEN regexp_matches(p_name, '(?i)\bna\b') THEN '6' ELSE 'UD' END AS segment FROM part""")
def mine_text(t: Tables) -> DataFrame:
    header = F.concat(F.col("p_brand"), F.lit("|"), F.col("p_name"))
    token = F.coalesce(F.nullif(F.upper(F.regexp_extract("p_brand", r"(?i)(d#?\d+)", 1)), F.lit("")), F.lit("none"))
    return t.part.select("p_partkey", T.header_accession(header).alias("accession"), token.alias("token"), T.mined_segment(F.col("p_name")).alias("segment"))


@query(r"""
SELECT page_id, coalesce(nullif(regexp_extract(url, '(?i)(h\d{1,2}n\d{1,2})', 1), ''),
  nullif(regexp_extract(url, '(?i)(h\d{1,2})', 1) || regexp_extract(url, '(?i)(n\d{1,2})', 1), ''), 'UD') AS genotype,
  nullif(upper(regexp_extract(url, '(?i)(N\d+)', 1)), '') AS any_n FROM pages""")
def mine_genotype(t: Tables) -> DataFrame:
    return t.pages.select("page_id", T.mined_genotype(F.col("url")).alias("genotype"), T.any_token(F.col("url"), "N").alias("any_n"))


@query("""
WITH r AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_discount, l_extendedprice DESC, l_partkey, l_linenumber, l_suppkey) AS n FROM lineitem)
SELECT l_orderkey, l_partkey, l_discount, l_extendedprice FROM r WHERE n = 1 AND l_extendedprice >= 20000""")
def best_hit(t: Tables) -> DataFrame:
    order = [F.asc("l_partkey"), F.asc("l_linenumber"), F.asc("l_suppkey")]
    best = assign.best_hit(t.lineitem, 20000, "l_orderkey", "l_discount", "l_extendedprice", order)
    return best.select("l_orderkey", "l_partkey", "l_discount", "l_extendedprice")


@query("""
WITH r AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY value DESC NULLS LAST, event_id) AS n FROM events)
SELECT user_id, event_id, value FROM r WHERE n = 1""")
def best_row_per_sample(t: Tables) -> DataFrame:
    return assign.best_row(t.events, "user_id", "value", "event_id").select("user_id", "event_id", "value")


@query("""
WITH r AS (SELECT *, row_number() OVER (PARTITION BY o_custkey, o_orderpriority ORDER BY o_totalprice DESC, o_orderkey) AS n FROM orders)
SELECT o_custkey, o_orderpriority, o_orderkey, o_totalprice FROM r WHERE n = 1 AND o_totalprice >= 125000""")
def best_contig_per_segment(t: Tables) -> DataFrame:
    best = assign.best_contigs(t.orders.withColumn("pident", F.lit(1.0)), 125000, "o_custkey", "o_orderpriority", "o_totalprice", "pident", "o_orderkey")
    return best.select("o_custkey", "o_orderpriority", "o_orderkey", "o_totalprice")


@query("""
WITH r AS (SELECT *, row_number() OVER (PARTITION BY o_custkey, o_orderpriority ORDER BY o_totalprice DESC, o_orderkey) AS n FROM orders),
c AS (SELECT o_custkey, count(*) AS k, min(o_totalprice) AS m FROM r WHERE n = 1 AND o_totalprice >= 12500 GROUP BY o_custkey)
SELECT o_custkey, CASE WHEN k >= 5 THEN greatest(12500, 400000 - 5000 * ceil(greatest(0, 400000 - m) / 5000)) ELSE 12500 END::INT AS min_used FROM c""")
def contig_limit(t: Tables) -> DataFrame:
    best = assign.best_contigs(t.orders.withColumn("pident", F.lit(1.0)), 12500, "o_custkey", "o_orderpriority", "o_totalprice", "pident", "o_orderkey")
    return assign.contig_limit(best, 400000, 12500, 5000, 5, "o_custkey", "o_totalprice")


@query("""
WITH r AS (SELECT *, row_number() OVER (PARTITION BY l_partkey ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber) AS rank FROM lineitem)
SELECT l_partkey, l_orderkey, l_extendedprice, rank FROM r WHERE rank <= 5""")
def topk_targets(t: Tables) -> DataFrame:
    top = assign.top_targets(t.lineitem, 5, "l_partkey", [F.desc("l_extendedprice"), F.asc("l_orderkey"), F.asc("l_linenumber")])
    return top.select("l_partkey", "l_orderkey", "l_extendedprice", F.col("rank").cast("long").alias("rank"))


@query("SELECT l_orderkey, l_partkey, l_extendedprice FROM (SELECT *, count(*) OVER (PARTITION BY l_orderkey) AS n FROM lineitem) WHERE n >= 4")
def complete_groups(t: Tables) -> DataFrame:
    return quality.complete_groups(t.lineitem, "l_orderkey", 4).select("l_orderkey", "l_partkey", "l_extendedprice")


@query("SELECT DISTINCT l_orderkey, l_partkey FROM lineitem WHERE l_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')")
def groups_with_any_bad(t: Tables) -> DataFrame:
    return quality.groups_with_any_bad(t.lineitem, "l_orderkey", F.col("l_returnflag") == "R").select("l_orderkey", "l_partkey").distinct()


@query("""
WITH b AS (SELECT p_type, (floor(avg(p_size)) - 15)::INT AS lo, (floor(avg(p_size)) + 15)::INT AS hi FROM part GROUP BY p_type)
SELECT p_partkey, p_type, p_size, CASE WHEN p_size < lo THEN 'below' ELSE 'above' END AS length_class FROM part JOIN b USING (p_type) WHERE p_size NOT BETWEEN lo AND hi""")
def length_outliers(t: Tables) -> DataFrame:
    mid = F.floor(F.avg("p_size"))
    bounds = t.part.groupBy(F.col("p_type").alias("kind")).agg((mid - 15).cast("int").alias("min_len"), (mid + 15).cast("int").alias("max_len"))
    out = quality.length_outliers(t.part, bounds, "p_type", "kind", "p_size")
    return out.select("p_partkey", "p_type", "p_size", T.length_class(F.col("p_size"), F.col("min_len"), F.col("max_len")).alias("length_class"))


@query("""
WITH c AS (SELECT c_nationkey, c_mktsegment, count(*) AS n, min(c_custkey) AS f FROM customer GROUP BY ALL)
SELECT c_nationkey, string_agg(c_mktsegment || '=' || n, ';' ORDER BY f) AS segments FROM c GROUP BY c_nationkey""")
def cluster_profile(t: Tables) -> DataFrame:
    return profile.value_counts(t.customer, "c_nationkey", ["c_mktsegment"], "c_custkey").select("c_nationkey", text_of("c_mktsegment", "segments"))


_LR = """
WITH c AS ({counts}), s AS (SELECT *, w * 1.0::DOUBLE / sum(w) OVER (PARTITION BY g) * 100 AS e FROM c),
u AS (SELECT *, floor(e)::BIGINT AS units, e - floor(e) AS left_ FROM s),
r AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY left_ DESC, k) AS n, 100 - sum(units) OVER (PARTITION BY g) AS open FROM u),
x AS (SELECT g, k, (units + CASE WHEN n <= open THEN 1 ELSE 0 END) AS units FROM r)
"""


@query(_LR.format(counts="SELECT c_nationkey AS g, c_mktsegment AS k, count(*) AS w FROM customer GROUP BY ALL") + """
SELECT g AS c_nationkey, '{' || string_agg('''' || k || ''': ' || printf('%.2f', units / 100.0::DOUBLE), ', ' ORDER BY units DESC, k) || '}' AS shares FROM x GROUP BY g""")
def largest_remainder(t: Tables) -> DataFrame:
    counts = profile.value_counts(t.customer, "c_nationkey", ["c_mktsegment"], "c_custkey")
    return counts.select("c_nationkey", D.serialize(F.col("c_mktsegment")).alias("shares"))


@query("""
WITH c AS (SELECT c_mktsegment, c_nationkey, count(*) AS w FROM customer GROUP BY ALL)
SELECT c_mktsegment, c_nationkey, round(w * 1.0::DOUBLE / sum(w) OVER (PARTITION BY c_mktsegment), 3) AS share FROM c""")
def to_proportions(t: Tables) -> DataFrame:
    counts = profile.value_counts(t.customer, "c_mktsegment", ["c_nationkey"], "c_custkey").withColumn("d", D.to_proportions(F.col("c_nationkey")))
    rows = profile.exploded(counts, ["c_mktsegment"], "d")
    return rows.select("c_mktsegment", F.col("key").cast("int").alias("c_nationkey"), F.col("weight").alias("share"))


def _nation_entries(t: Tables) -> DataFrame:
    """Customers of each market segment by nation, spelt in lower case here and there to exercise the lookups."""
    named = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    rows = named.groupBy("c_mktsegment", "n_name").agg(F.count("*").cast("double").alias("weight"))
    return rows.withColumn("place", F.lower("n_name"))


@query(_LR.format(counts="SELECT c_mktsegment AS g, r_name AS k, count(*) AS w FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY ALL") + """
SELECT g AS c_mktsegment, '{' || string_agg('''' || k || ''': ' || printf('%.2f', units / 100.0::DOUBLE), ', ' ORDER BY units DESC, k) || '}' AS regions FROM x GROUP BY g""")
def rollup_distribution(t: Tables) -> DataFrame:
    geo = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).select(F.col("n_name").alias("country"), F.col("r_name").alias("region"))
    rows = dims.rollup_geo(_nation_entries(t), "place", geo, "region", "level")
    sums = profile.rollup_distribution(rows, ["c_mktsegment"], "level", "regions", shares=False)
    return sums.select("c_mktsegment", D.serialize(F.col("regions")).alias("regions"))


@query("""
SELECT c_mktsegment, n_name, CASE WHEN n_nationkey % 5 = 0 THEN 'Unknown' WHEN n_nationkey % 5 = 1 THEN 'NATION_0' ELSE n_name END AS resolved, count(*)::DOUBLE AS weight
FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY ALL""")
def resolve_synonyms(t: Tables) -> DataFrame:
    syn = t.nation.filter(F.col("n_nationkey") % 5 < 2).select(F.col("n_name").alias("raw"), F.when(F.col("n_nationkey") % 5 == 1, "nation_0").alias("canonical"))
    out = dims.resolve(_nation_entries(t), "place", syn, t.nation.select(F.col("n_name").alias("name")))
    return out.select("c_mktsegment", "n_name", "resolved", "weight")


@query("""
WITH d AS (SELECT o_custkey, o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN strftime(o_orderdate, '%Y') WHEN 1 THEN strftime(o_orderdate, '%Y-%m') WHEN 2 THEN strftime(o_orderdate, '%Y-%m-%d') ELSE 'n/a' END AS raw,
  CASE o_orderkey % 4 WHEN 0 THEN date_trunc('year', o_orderdate) WHEN 1 THEN date_trunc('month', o_orderdate) WHEN 2 THEN o_orderdate END::DATE AS d FROM orders),
a AS (SELECT o_custkey, first(raw ORDER BY d, o_orderkey) FILTER (WHERE d IS NOT NULL) AS lo, first(raw ORDER BY d DESC, o_orderkey) FILTER (WHERE d IS NOT NULL) AS hi FROM d GROUP BY o_custkey)
SELECT o_custkey, CASE WHEN lo IS NULL THEN 'Unknown' WHEN lo = hi THEN lo ELSE lo || ' - ' || hi END AS collection_date FROM a""")
def date_range(t: Tables) -> DataFrame:
    kind, day = F.col("o_orderkey") % 4, F.col("o_orderdate")
    raw = F.when(kind == 0, F.date_format(day, "yyyy")).when(kind == 1, F.date_format(day, "yyyy-MM")).when(kind == 2, F.date_format(day, "yyyy-MM-dd")).otherwise("n/a")
    return profile.date_range(t.orders.withColumn("raw", raw), "o_custkey", "raw", "o_orderkey").select("o_custkey", "collection_date")


@query("""
SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F') AND c_custkey NOT IN (SELECT user_id FROM events WHERE event_type = 'purchase')""")
def tier_cascade(t: Tables) -> DataFrame:
    left = assign.unassigned(t.customer, t.orders.filter("o_orderstatus = 'F'"), "c_custkey", "o_custkey")
    return assign.unassigned(left, t.events.filter("event_type = 'purchase'"), "c_custkey", "user_id").select("c_custkey")


@query("""
WITH a AS (SELECT o_custkey AS id, min(o_orderkey) AS hit FROM orders WHERE o_orderstatus = 'F' GROUP BY 1), b AS (SELECT o_custkey AS id, min(o_orderkey) AS hit FROM orders WHERE o_orderstatus = 'P' GROUP BY 1),
e AS (SELECT user_id AS id, min(event_id) AS hit FROM events WHERE event_type = 'purchase' GROUP BY 1)
SELECT c_custkey AS id, coalesce(a.hit, b.hit, e.hit) AS hit, CASE WHEN a.id IS NOT NULL THEN 'CD-HIT' WHEN b.id IS NOT NULL THEN 'C-BLAST' WHEN e.id IS NOT NULL THEN 'L-BLAST' ELSE 'Unassigned' END AS assigned_by
FROM customer LEFT JOIN a ON c_custkey = a.id LEFT JOIN b ON c_custkey = b.id LEFT JOIN e ON c_custkey = e.id""")
def compile_report(t: Tables) -> DataFrame:
    tier = lambda s: t.orders.filter(F.col("o_orderstatus") == s).groupBy(F.col("o_custkey").alias("id")).agg(F.min("o_orderkey").alias("hit"))
    last = t.events.filter("event_type = 'purchase'").groupBy(F.col("user_id").alias("id")).agg(F.min("event_id").alias("hit"))
    return assign.compile_report(t.customer.select(F.col("c_custkey").alias("id")), [("CD-HIT", tier("F")), ("C-BLAST", tier("P")), ("L-BLAST", last)], "id")


@query("""
WITH m AS (SELECT o_custkey AS cluster, o_orderkey AS accession FROM orders), a AS (SELECT l_orderkey, min(l_partkey) AS p FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1)
SELECT c_custkey, coalesce(cluster, -1) AS cluster, p FROM customer LEFT JOIN (SELECT cluster, min(p) AS p FROM m JOIN a ON accession = l_orderkey GROUP BY 1) ON c_custkey = cluster""")
def assign_clusters(t: Tables) -> DataFrame:
    members = t.orders.join(t.lineitem.filter("l_returnflag = 'R'"), F.col("o_orderkey") == F.col("l_orderkey")).groupBy("o_custkey").agg(F.min("l_partkey").alias("p"))
    members = members.select(F.col("o_custkey").cast("string").alias("accession"), F.col("o_custkey").cast("string").alias("cluster"), F.lit(False).alias("is_rep"), F.col("p").cast("double").alias("identity"))
    out = assign.assign_clusters(t.customer.select("c_custkey", F.col("c_custkey").cast("string").alias("internal_id")), members)
    cluster = F.when(F.col("cluster") == ">Unassigned", F.lit(-1)).otherwise(F.col("cluster").try_cast("long"))
    return out.select("c_custkey", cluster.cast("long").alias("cluster"), F.col("pident").cast("long").alias("p"))


@query("""
WITH b AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_discount, l_extendedprice DESC, l_partkey) AS n FROM lineitem)
SELECT l_orderkey AS internal_id, l_partkey AS representative, p_brand AS genotype, p_size AS segment, p_type AS host FROM b JOIN part ON l_partkey = p_partkey WHERE n = 1 AND l_extendedprice >= 20000""")
def annotate_best_hit(t: Tables) -> DataFrame:
    hits = t.lineitem.select(F.col("l_orderkey").alias("qseqid"), F.col("l_partkey").alias("sseqid"), F.col("l_discount").alias("evalue"), F.col("l_extendedprice").alias("pident"))
    profiles = t.part.select(F.col("p_partkey").alias("representative"), F.col("p_brand").alias("genotype"), F.col("p_size").alias("segment"), F.col("p_type").alias("host"))
    return assign.annotate_by_representative(hits, profiles, 20000).select("internal_id", "representative", "genotype", "segment", "host")


@query("""
WITH s AS (SELECT DISTINCT l_suppkey AS cluster FROM lineitem WHERE l_returnflag = 'R' AND l_quantity >= 49)
SELECT DISTINCT l_suppkey AS cluster, l_partkey AS accession, p_name, p_brand FROM lineitem JOIN part ON l_partkey = p_partkey WHERE l_suppkey IN (SELECT cluster FROM s)""")
def cluster_composition(t: Tables) -> DataFrame:
    members = t.lineitem.select(F.col("l_suppkey").alias("cluster"), F.col("l_partkey").alias("accession"), F.lit(False).alias("is_rep"))
    report = t.lineitem.filter("l_returnflag = 'R' and l_quantity >= 49").select(F.col("l_suppkey").alias("cluster"))
    meta = t.part.select(F.col("p_partkey").alias("ACCESSION"), "p_name", "p_brand")
    return profile.cluster_composition(report, members, meta).select("cluster", "accession", "p_name", "p_brand")


def _declared(t: Tables) -> tuple[DataFrame, DataFrame]:
    """Orders as declared (segment by priority, genotype HxNy by key) and reported with errors in some."""
    k, seg = F.col("o_orderkey"), F.substring("o_orderpriority", 1, 1).cast("int") + 2
    geno = lambda x: F.concat(F.lit("H"), (x % 16 + 1).cast("string"), F.lit("N"), (x % 9 + 1).cast("string"))
    declared = t.orders.select(k.alias("accession"), seg.alias("segment"), geno(k).alias("genotype"))
    wrong = F.col("o_orderstatus") == "P"
    reported = t.orders.select(k.alias("accession"), F.when(k % 11 == 0, seg + 1).otherwise(seg).alias("segment"), F.array(geno(F.when(wrong, k + 1).otherwise(k))).alias("genotypes"))
    return declared, reported


_SEG = "substr(o_orderpriority, 1, 1)::INT + 2"


@query(f"SELECT o_orderkey AS accession FROM orders WHERE {_SEG} NOT IN (4, 6) AND (o_orderkey % 11 = 0 OR o_orderstatus = 'P')")
def crosscheck_internal(t: Tables) -> DataFrame:
    return quality.crosscheck_internal(*_declared(t))


@query(f"""SELECT o_orderkey AS accession FROM orders WHERE {_SEG} IN (4, 6) AND (o_orderkey % 11 = 0 OR (o_orderstatus = 'P' AND
  CASE WHEN {_SEG} = 4 THEN (o_orderkey % 16) <> ((o_orderkey + 1) % 16) ELSE (o_orderkey % 9) <> ((o_orderkey + 1) % 9) END))""")
def crosscheck_determining(t: Tables) -> DataFrame:
    return quality.crosscheck_determining(*_declared(t))


@query("""
SELECT doc_id AS key, 'left' AS side FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)
UNION ALL SELECT DISTINCT doc_id, 'right' FROM labels WHERE doc_id NOT IN (SELECT doc_id FROM documents)""")
def reconcile(t: Tables) -> DataFrame:
    return quality.reconcile(t.documents, t.labels, "doc_id")


@query("SELECT doc_id, 'label' AS origin FROM labels UNION ALL SELECT doc_id, 'document' FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def append_missing(t: Tables) -> DataFrame:
    return quality.append_missing(t.labels.select("doc_id", F.lit("label").alias("origin")), t.documents.select("doc_id", F.lit("document").alias("origin")), "doc_id")


@query("SELECT doc_id, quality, toxic FROM labels UNION ALL SELECT doc_id, NULL, NULL FROM documents")
def append_metadata(t: Tables) -> DataFrame:
    return quality.append_metadata(t.labels, t.documents)


@query("SELECT md5(text) AS text_md5 FROM (SELECT text FROM documents UNION SELECT text FROM benchmark)")
def union_distinct(t: Tables) -> DataFrame:
    return quality.union_distinct(t.documents.select(F.md5("text").alias("text_md5")), t.benchmark.select(F.md5("text").alias("text_md5")))


@query("SELECT n_regionkey AS region, n_name AS name FROM nation UNION ALL SELECT r_regionkey, r_name FROM region UNION ALL SELECT c_nationkey, c_mktsegment FROM customer")
def union_bag(t: Tables) -> DataFrame:
    a = t.nation.select(F.col("n_regionkey").alias("region"), F.col("n_name").alias("name"))
    b = t.region.select(F.col("r_regionkey").alias("region"), F.col("r_name").alias("name"))
    return quality.union_bag(a, b, t.customer.select(F.col("c_nationkey").alias("region"), F.col("c_mktsegment").alias("name")))


@query("SELECT count(*) FILTER (WHERE text IS NULL OR text = '') AS text, count(*) FILTER (WHERE lang IS NULL OR lang = '') AS lang, count(*) FILTER (WHERE source IS NULL OR source = '') AS source FROM documents")
def missing_profile(t: Tables) -> DataFrame:
    return quality.missing_profile(t.documents, "text", "lang", "source")


@query("SELECT p_brand, count(DISTINCT p_type) AS n_types FROM part GROUP BY p_brand HAVING count(DISTINCT p_type) > 1")
def multi_valued_groups(t: Tables) -> DataFrame:
    counts = profile.value_counts(t.part, "p_brand", ["p_type"], "p_partkey")
    return quality.multi_valued(counts, "p_type").select("p_brand", F.size("p_type").cast("long").alias("n_types"))


@query("SELECT event_id, 'k' AS key, json_extract(props, '$.k')::DOUBLE AS weight FROM events WHERE props LIKE '{%'")
def parse_literal(t: Tables) -> DataFrame:
    return profile.exploded(t.events.withColumn("d", D.parse_distribution(F.col("props"))), ["event_id"], "d")


@query(r"""
WITH s AS (SELECT page_id, nullif(trim(regexp_extract(url, '://([^/]+)/', 1)), '') AS sample_id FROM pages)
SELECT page_id, sample_id, regexp_replace(regexp_replace(trim(replace(sample_id, '/', '_')), '[^A-Za-z0-9._-]+', '_', 'g'), '^[._]+|[._]+$', '', 'g') AS file_name FROM s WHERE sample_id IS NOT NULL""")
def demultiplex(t: Tables) -> DataFrame:
    found, _ = samples.demultiplex(t.pages.select("page_id", F.col("url").alias("header")), r"://(?P<sample>[^/]+)/")
    names = samples.safe_file_names(found)
    return found.join(names, "sample_id").select("page_id", "sample_id", "file_name")


@query(r"""
SELECT page_id, regexp_replace(regexp_replace(url, '^.*/', ''), '\.[^./]*$', '') || '_' || substr(sha1(regexp_extract(url, '^(.*)/[^/]*$', 1)), 1, 10) AS sample_tag,
  replace(regexp_replace(url, '\.[^./]*$', ''), '/', '__') AS file_tag FROM pages""")
def path_tags(t: Tables) -> DataFrame:
    return t.pages.select("page_id", T.sample_tag(F.col("url")).alias("sample_tag"), T.path_tag(F.col("url")).alias("file_tag"))


@query("""
WITH c AS (SELECT event_type AS sample_id, count(*) AS n, min(user_id) AS u FROM events GROUP BY 1)
SELECT sample_id, string_agg(event_id::VARCHAR, ',' ORDER BY event_id) AS ids FROM (SELECT event_type AS sample_id, event_id, row_number() OVER (PARTITION BY event_type, user_id ORDER BY event_id) AS n FROM events) WHERE n = 1 GROUP BY 1""")
def group_by_pattern(t: Tables) -> DataFrame:
    firsts = assign.first_wins(t.events, ["event_type", "user_id"], [F.asc("event_id")])
    rows = profile.collected(firsts.withColumnRenamed("event_type", "sample_id"), "sample_id", "event_id", "event_id")
    return rows.select("sample_id", F.array_join(F.transform("values", lambda x: x.cast("string")), ",").alias("ids"))


#: Locus and mutation of an event, by its id: marker text of the form locus:A123T.
_MARKERS = ("PB2:E627K", "PB2:D701N", "PB1-F2:N66S", "PA:A85I", "HA:T156A", "NP:I100V", "NA:H275Y", "M2:S31N", "M1:T95K", "HA:A627K", "NS:A1B")
_MARKER_SQL = "CASE event_id % 11 " + " ".join(f"WHEN {k} THEN '{m}'" for k, m in enumerate(_MARKERS)) + " END"
_FOUND_SQL = f"""
WITH m AS (SELECT DISTINCT user_id AS sample, {_MARKER_SQL} AS raw FROM events WHERE event_id % 11 < 9),
p AS (SELECT sample, split_part(raw, ':', 1) AS locus, regexp_extract(split_part(raw, ':', 2), '^[A-Z](\\d+[A-Z])', 1) AS mutation FROM m)"""


def _markers(t: Tables) -> DataFrame:
    return t.events.select(F.col("user_id").alias("sample"), F.element_at(F.array(*map(F.lit, _MARKERS)), (F.col("event_id") % 11 + 1).cast("int")).alias("raw"))


@query(_FOUND_SQL + """
SELECT sample, locus, CASE locus WHEN 'PB1-F2' THEN 'PB1' WHEN 'M1' THEN 'MP' WHEN 'M2' THEN 'MP' ELSE locus END AS segment, mutation, locus || ':' || mutation AS label FROM p""")
def mutations_of_interest(t: Tables) -> DataFrame:
    return samples.mutations_of_interest(_markers(t)).drop("effect")


@query(_FOUND_SQL + """
SELECT sample, string_agg(locus || ':' || mutation, ';' ORDER BY list_position(['PB2', 'PB1', 'PB1-F2', 'PA', 'PA-X', 'HA', 'NP', 'NA', 'M1', 'M2'], locus), locus || ':' || mutation) AS mutations_of_interest FROM p GROUP BY sample""")
def mutation_strings(t: Tables) -> DataFrame:
    return samples.mutation_strings(samples.mutations_of_interest(_markers(t)))


def _sample_rows(t: Tables) -> DataFrame:
    """Orders as sequences of a customer: segment 3 to 7 by priority, a genotype by status and key."""
    k = F.col("o_orderkey")
    geno = F.when(F.col("o_orderstatus") == "F", "H5N1").when(F.col("o_orderstatus") == "O", F.concat(F.lit("H"), (k % 2 + 5).cast("string"))).otherwise("N1")
    return t.orders.select(F.col("o_custkey").alias("sample_id"), (F.substring("o_orderpriority", 1, 1).cast("int") + 2).alias("segment"), F.array(geno).alias("genotypes"), k.alias("ord"), k.cast("string").alias("sample_name"), F.col("o_orderstatus").alias("representative"))


_SAMPLE_SQL = f"""
WITH g AS (SELECT o_custkey AS sample_id, o_orderkey AS ord, {_SEG} AS segment, CASE o_orderstatus WHEN 'F' THEN 'H5N1' WHEN 'O' THEN 'H' || (o_orderkey % 2 + 5) ELSE 'N1' END AS geno FROM orders),
t AS (SELECT *, nullif(regexp_extract(geno, '^(H\\d+)', 1), '') AS h, nullif(regexp_extract(geno, '(N\\d+)$', 1), '') AS n FROM g),
s AS (SELECT sample_id, count(DISTINCT h) FILTER (WHERE segment = 4) AS nh, max(h) FILTER (WHERE segment = 4) AS h, count(DISTINCT n) FILTER (WHERE segment = 6) AS nn, max(n) FILTER (WHERE segment = 6) AS n FROM t GROUP BY 1),
x AS (SELECT sample_id, CASE WHEN nh = 1 THEN h END AS h, CASE WHEN nn = 1 THEN n END AS n FROM s)"""


@query(_SAMPLE_SQL + " SELECT sample_id, h, n, coalesce(nullif(coalesce(h, '') || coalesce(n, ''), ''), 'Undetermined') AS genotype FROM x")
def sample_genotype(t: Tables) -> DataFrame:
    return samples.sample_genotype(_sample_rows(t))


@query(_SAMPLE_SQL + """
SELECT t.sample_id, ord, (segment = 4 AND t.h IN ('H1', 'H3', 'H5')) IS TRUE AS to_clade, coalesce(x.h = 'H5', false) AS to_markers FROM t JOIN x USING (sample_id)""")
def route_samples(t: Tables) -> DataFrame:
    rows = _sample_rows(t)
    return samples.route(rows, samples.sample_genotype(rows), force_markers=False).select("sample_id", "ord", "to_clade", "to_markers")


@query(f"""SELECT o_custkey AS sample_id, {_SEG} AS segment, string_agg(o_orderkey::VARCHAR, ',' ORDER BY o_orderkey) AS names, string_agg(o_orderstatus, ',' ORDER BY o_orderkey) AS refs FROM orders GROUP BY 1, 2""")
def sample_segments(t: Tables) -> DataFrame:
    out = samples.sample_segments(_sample_rows(t))
    return out.select("sample_id", "segment", F.array_join("names", ",").alias("names"), F.array_join("refs", ",").alias("refs"))


@query(_SAMPLE_SQL + """,
a AS (SELECT sample_id, count(DISTINCT ord) FILTER (WHERE segment = 4) AS k, max(ord) FILTER (WHERE segment = 4) AS ha FROM t GROUP BY 1)
SELECT a.sample_id, CASE WHEN NOT coalesce(x.h IN ('H1', 'H3', 'H5') AND k = 1, false) THEN 'Non-applicable' WHEN ha % 4 = 0 THEN 'Unassigned' WHEN ha % 4 = 1 THEN 'Unassigned by error' WHEN ha % 4 = 2 THEN 'Unassigned' ELSE '2.3.4.4b' END AS clade
FROM a JOIN x USING (sample_id)""")
def clade_decision(t: Tables) -> DataFrame:
    rows = _sample_rows(t)
    ha = F.sort_array(F.collect_list(F.when(F.col("segment") == 4, F.struct("ord", "sample_name"))))
    names = rows.groupBy("sample_id").agg(F.transform(ha, lambda x: x["sample_name"]).alias("ha_names"))
    k = F.col("o_orderkey") % 4
    found = t.orders.filter(k != 0).select(F.col("o_orderkey").cast("string").alias("seq_name"), F.when(k == 3, "2.3.4.4b").otherwise(" ").alias("clade"), F.when(k == 1, "too short").alias("errors"))
    return samples.clade_decision(samples.sample_genotype(rows).join(names, "sample_id"), found)


_CELLS = {"PB2": 2, "PB1": 3, "PA": 4, "NP": 5, "NA": 6, "MP": 7, "NS": 8}


def _constellations(t: Tables) -> DataFrame:
    """Events as constellation rows: a cell of a user is filled, `?` or empty by the event's id."""
    k = F.col("event_id")
    cells = [F.when(k % m == 0, (k % 100).cast("string")).when(k % m == 1, "?").otherwise("").alias(c) for c, m in _CELLS.items()]
    return t.events.select(F.col("user_id").alias("sample_id"), k.alias("ord"), F.when(k % 3 > 0, F.col("event_type")).otherwise("").alias("genotype"), F.lit("").alias("sub_genotype"), *cells)


_CELL_SQL = ", ".join(f"CASE WHEN event_id % {m} = 0 THEN (event_id % 100)::VARCHAR WHEN event_id % {m} = 1 THEN '?' ELSE '' END AS {c}" for c, m in _CELLS.items())


@query(f"""
WITH c AS (SELECT user_id AS sample_id, event_id AS ord, CASE WHEN event_id % 3 > 0 THEN event_type ELSE '' END AS genotype, {_CELL_SQL} FROM events),
s AS (SELECT *, {" + ".join(f"({c} NOT IN ('', '?'))::INT" for c in _CELLS)} AS score FROM c)
SELECT sample_id, coalesce(nullif(first(genotype ORDER BY score DESC, ord), ''), first(genotype ORDER BY ord) FILTER (WHERE genotype <> ''), '') AS genin2_genotype, '' AS genin2_subgenotype,
{", ".join(f"coalesce(first({c} ORDER BY ord) FILTER (WHERE {c} NOT IN ('', '?')), '') AS genin2_{c.lower()}" for c in _CELLS)} FROM s GROUP BY sample_id""")
def constellation_summary(t: Tables) -> DataFrame:
    return samples.constellation_summary(_constellations(t))


@query(f"""
WITH c AS (SELECT event_id, {_CELL_SQL} FROM events), s AS (SELECT *, {" + ".join(f"({c} <> '?')::INT" for c in _CELLS)} AS k FROM c)
SELECT event_id, CASE WHEN k > 1 THEN 'constellation' ELSE 'expanded' END AS output_format FROM s WHERE k > 0""")
def constellation_rows(t: Tables) -> DataFrame:
    raw = _constellations(t).withColumn("Sample Name", F.col("ord").cast("string")).withColumnRenamed("genotype", "Genotype")
    rows, _ = samples.constellation_rows(raw)
    return rows.select(F.col("ord").alias("event_id"), "output_format")


@query(_SAMPLE_SQL + """,
o AS (SELECT sample_id, coalesce(nullif(coalesce(h, '') || coalesce(n, ''), ''), 'Undetermined') AS genotype FROM x)
SELECT c_custkey AS sample_id, c_name AS file_tag, CASE WHEN o.sample_id IS NULL THEN 'failed' ELSE 'ok' END AS status, coalesce(genotype, '') AS genotype FROM customer LEFT JOIN o ON c_custkey = o.sample_id""")
def batch_summary(t: Tables) -> DataFrame:
    found = samples.sample_genotype(_sample_rows(t)).select("sample_id", "genotype").withColumn("status", F.lit("ok"))
    inputs = t.customer.select(F.col("c_custkey").alias("sample_id"), F.col("c_name").alias("file_tag"))
    out = samples.batch_summary(inputs, found)
    assert out.columns[1:] == list(SUMMARY_FIELDS)
    return out.select("sample_id", "file_tag", F.when(F.col("status") == "", "failed").otherwise(F.col("status")).alias("status"), "genotype")


_SHINGLES = r"""
s AS (SELECT DISTINCT k, id, unnest([array_to_string(w[i : i + 7], ' ') FOR i IN range(1, len(w) - 6)]) AS g FROM w WHERE len(w) >= 8),
n AS (SELECT k, id, count(*) AS n FROM s GROUP BY ALL)"""


@query(r"""
WITH w AS (SELECT 'q' AS k, item_id AS id, [x FOR x IN regexp_split_to_array(lower(text), '[\s\x0B]+') IF x <> ''] AS w FROM benchmark UNION ALL SELECT 't', doc_id, [x FOR x IN regexp_split_to_array(lower(text), '[\s\x0B]+') IF x <> ''] FROM documents),""" + _SHINGLES + """
SELECT a.id AS q, b.id AS t, count(*) AS shared, any_value(x.n) AS nq, any_value(y.n) AS nt FROM s a JOIN s b ON a.g = b.g AND a.k = 'q' AND b.k = 't' JOIN n x ON x.k = 'q' AND x.id = a.id JOIN n y ON y.k = 't' AND y.id = b.id GROUP BY ALL""")
def word_overlap(t: Tables) -> DataFrame:
    """Benchmark items against documents: runs of eight words in common."""
    q = similarity.with_shingles(t.benchmark.select("item_id", "text"), "text", 8)
    d = similarity.with_shingles(t.documents.select("doc_id", "text"), "text", 8)
    out = similarity.shared_words(q, d, "item_id", "doc_id")
    return out.select("q", "t", "shared", F.col("nq").cast("long").alias("nq"), F.col("nt").cast("long").alias("nt"))


def _sequence(text: str) -> Column:
    return F.regexp_replace(F.lower(F.col(text)), r"\s+", " ")


@query()
def similarity_join(t: Tables) -> DataFrame:
    """Benchmark items against all documents as sequences: local hits of a common run of 32 letters, the best five for each item."""
    q = t.benchmark.select(F.col("item_id").alias("id"), _sequence("text").alias("seq"))
    d = t.documents.select(F.col("doc_id").alias("id"), _sequence("text").alias("seq"))
    return similarity.similarity_join(q, d, 0.9, k=16, both_strands=False, window=17)


@query()
def identity_clusters(t: Tables) -> DataFrame:
    """All turns of conversations as sequences, clustered at 98 % of the shorter."""
    turns = t.conversations.select(F.concat_ws(":", "conv_id", "turn").alias("id"), _sequence("text").alias("seq"))
    return similarity.identity_clusters(turns, 0.98, k=16)


@query()
def greedy_clusters(t: Tables) -> DataFrame:
    """Orders that share a part from the same supplier: greedy clusters, highest price first."""
    v = t.lineitem.groupBy(F.col("l_orderkey").alias("id")).agg(F.max("l_extendedprice").alias("length"))
    one = t.lineitem.select(F.col("l_orderkey").alias("a"), "l_partkey", "l_suppkey").distinct()
    two = one.withColumnRenamed("a", "b")
    edges = one.join(two, ["l_partkey", "l_suppkey"]).filter("a < b").groupBy("a", "b").agg(F.count("*").cast("double").alias("weight"))
    return similarity.greedy_clusters(v, edges)


def _tree(t: Tables) -> DataFrame:
    """Regions and their nations as one JSON tree, built from the tables."""
    leaf = F.concat(F.lit('"'), F.col("n_name"), F.lit('": {"rank": "country"}'))
    per = t.nation.groupBy("n_regionkey").agg(F.array_join(F.sort_array(F.collect_list(leaf)), ", ").alias("leaves"))
    node = F.concat(F.lit('"'), F.col("r_name"), F.lit('": {"rank": "region", "children": {'), F.coalesce("leaves", F.lit("")), F.lit("}}"))
    rows = t.region.join(per, F.col("r_regionkey") == F.col("n_regionkey"), "left").agg(F.array_join(F.sort_array(F.collect_list(node)), ", ").alias("nodes"))
    return rows.select(F.parse_json(F.concat(F.lit("{"), F.col("nodes"), F.lit("}"))).alias("tree"))


@query("""
SELECT r_name AS name, 'region' AS rank, 1 AS depth, r_name AS lineage FROM region
UNION ALL SELECT n_name, 'country', 2, r_name || ' > ' || n_name FROM nation JOIN region ON n_regionkey = r_regionkey""")
def walk_tree(t: Tables) -> DataFrame:
    nodes = dims.walk_tree(_tree(t))
    return nodes.select("name", "rank", F.col("depth").cast("int").alias("depth"), F.array_join(F.transform("lineage", lambda x: x["name"]), " > ").alias("lineage"))


@query("""
SELECT r_name AS name, 'region' AS rank, 1 AS depth, r_name AS lineage FROM region
UNION ALL SELECT n_name, 'country', 2, r_name || ' > ' || n_name FROM nation JOIN region ON n_regionkey = r_regionkey
UNION ALL SELECT c_name, 'customer', 3, r_name || ' > ' || n_name || ' > ' || c_name FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
UNION ALL SELECT 'o' || o_orderkey, 'order', 4, r_name || ' > ' || n_name || ' > ' || c_name || ' > o' || o_orderkey FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""")
def walk_edges(t: Tables) -> DataFrame:
    """Regions, nations, customers and orders as one table of nodes and parents."""
    key = lambda letter, c: F.concat(F.lit(letter), F.col(c).cast("string"))
    nodes = t.region.select(key("r", "r_regionkey").alias("id"), F.lit(None).cast("string").alias("parent"), F.col("r_name").alias("name"), F.lit("region").alias("rank"))
    nodes = nodes.unionAll(t.nation.select(key("n", "n_nationkey"), key("r", "n_regionkey"), "n_name", F.lit("country")))
    nodes = nodes.unionAll(t.customer.select(key("c", "c_custkey"), key("n", "c_nationkey"), "c_name", F.lit("customer")))
    nodes = nodes.unionAll(t.orders.select(key("o", "o_orderkey"), key("c", "o_custkey"), key("o", "o_orderkey"), F.lit("order")))
    return dims.walk_edges(nodes).select("name", "rank", "depth", F.array_join(F.transform("lineage", lambda x: x["name"]), " > ").alias("lineage"))


@query("""SELECT c_custkey, r_name AS continent, r_name AS region FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""")
def geo_dimension(t: Tables) -> DataFrame:
    geo = dims.geo_dim(dims.walk_tree(_tree(t)))
    named = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    return dims.rollup_geo(dims.rollup_geo(named, "n_name", geo, "continent", "continent"), "n_name", geo, "region", "region").select("c_custkey", "continent", "region")


@query("""
SELECT p_partkey, p_type AS family, coalesce(m, 'Unknown') AS above FROM part LEFT JOIN (SELECT p_type AS k, min(p_brand) AS m FROM part GROUP BY 1) ON p_type = k""")
def taxa_rollup(t: Tables) -> DataFrame:
    dim = t.part.groupBy(F.col("p_type").alias("family")).agg(F.min("p_brand").alias("class"))
    none = F.lit(None).cast("string")
    dim = dim.select(F.col("family").alias("name"), F.lit("family").alias("rank"), none.alias("species"), none.alias("genus"), F.col("family").alias("subfamily"), "family", F.col("class").alias("division"), none.alias("order"), "class")
    lookup = dims.taxa_lookup(dim)
    rows = dims.rollup_taxa(dims.rollup_taxa(t.part, "p_type", lookup, "family", "family"), "p_type", lookup, "class", "above")
    return rows.select("p_partkey", "family", "above")


@query("""
SELECT l_partkey AS part, string_agg(DISTINCT 'N' || (l_suppkey % 9 + 1), ',' ORDER BY 'N' || (l_suppkey % 9 + 1)) AS n, bool_or(l_returnflag = 'R') AS mixed FROM lineitem GROUP BY 1""")
def subtypes_per_group(t: Tables) -> DataFrame:
    geno = F.concat(F.lit("h3n"), (F.col("l_suppkey") % 9 + 1).cast("string"), F.when(F.col("l_returnflag") == "R", " mixed").otherwise(""))
    counts = profile.value_counts(t.lineitem.withColumn("geno", geno), "l_partkey", ["geno"], "l_orderkey")
    return profile.subtypes(counts, "l_partkey", "geno").select(F.col("l_partkey").alias("part"), F.array_join("n", ",").alias("n"), "mixed")


@query("SELECT l_orderkey, coalesce(s_name, l_suppkey::VARCHAR) AS supplier, l_partkey FROM lineitem LEFT JOIN (SELECT * FROM supplier WHERE s_suppkey % 2 = 0) ON l_suppkey = s_suppkey")
def restore_names(t: Tables) -> DataFrame:
    names = t.supplier.filter("s_suppkey % 2 = 0").select(F.col("s_suppkey").cast("string").alias("internal_id"), F.col("s_name").alias("header"))
    rows = t.lineitem.select("l_orderkey", F.col("l_suppkey").cast("string").alias("supplier"), "l_partkey")
    return assign.restore_names(rows, names, "supplier")


@query("SELECT c_custkey, coalesce(n, 0) AS length FROM customer LEFT JOIN (SELECT o_custkey, max(o_orderkey)::INT AS n FROM orders GROUP BY 1) ON c_custkey = o_custkey")
def attach_length(t: Tables) -> DataFrame:
    seqs = t.orders.select(F.concat(F.lit(">"), F.col("o_custkey").cast("string")).alias("header"), F.col("o_orderkey").cast("int").alias("length"))
    return assign.attach_length(t.customer.withColumn("sample_name", F.col("c_custkey").cast("string")), seqs).select("c_custkey", "length")


@query("SELECT d.doc_id, coalesce(CASE WHEN d.doc_id % 2 = 0 THEN 1 END, quality) AS quality FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id")
def fill_missing(t: Tables) -> DataFrame:
    rows = t.documents.select("doc_id", F.when(F.col("doc_id") % 2 == 0, F.lit(1)).alias("quality"))
    return quality.fill_missing(rows, t.labels, "doc_id", "quality").select("doc_id", "quality")


@query("SELECT DISTINCT user_id AS key, user_id IN (SELECT c_custkey FROM customer) AS found FROM events")
def reference_lookup(t: Tables) -> DataFrame:
    found, missing = quality.reference_lookup(t.events.select(F.col("user_id").alias("key")), t.customer.select(F.col("c_custkey").alias("key")), "key")
    return found.withColumn("found", F.lit(True)).unionByName(missing.withColumn("found", F.lit(False)))


@query("""
WITH r AS (SELECT l_orderkey, l_returnflag, l_partkey, row_number() OVER (PARTITION BY l_orderkey, l_returnflag ORDER BY l_partkey, l_linenumber, l_suppkey) AS n FROM lineitem)
SELECT l_orderkey || CASE WHEN n > 1 THEN '__DUP' || n ELSE '' END || '_' || l_returnflag AS header, l_partkey::VARCHAR AS seq FROM r""")
def tool_input(t: Tables) -> DataFrame:
    rows = t.lineitem.select(F.col("l_orderkey").cast("string").alias("internal_id"), F.lit("").alias("header"), F.col("l_returnflag").alias("segment_name"), F.col("l_partkey").cast("string").alias("seq"), F.struct("l_partkey", "l_linenumber", "l_suppkey").alias("ord"))
    return writers.tool_input(rows)


@query("SELECT user_id AS sample_id, event_type AS segment_name, user_id || '_' || event_type AS header, arg_max(event_id, event_id)::VARCHAR AS seq FROM events GROUP BY 1, 2")
def constellation_input(t: Tables) -> DataFrame:
    rows = t.events.select(F.col("user_id").alias("sample_id"), F.col("event_type").alias("segment_name"), F.col("event_id").cast("string").alias("seq"), F.col("event_id").alias("ord"))
    return writers.constellation_input(rows)


@query(f"""SELECT doc_id, md5('>' || doc_id || chr(10) || rtrim(regexp_replace(s, '(.{{80}})', '\\1' || chr(10), 'g'), chr(10))) AS record_md5
FROM (SELECT doc_id, {_NORM} || '*' AS s FROM documents)""")
def fasta_records(t: Tables) -> DataFrame:
    seq = F.concat(T.normalize_sequence(F.col("text")), F.lit("*"))
    return t.documents.select("doc_id", F.md5(writers.fasta_text(F.col("doc_id").cast("string"), seq, 80)).alias("record_md5"))


@query("SELECT lang, doc_id, ceil(row_number() OVER (PARTITION BY lang ORDER BY doc_id) / 8.0)::BIGINT AS batch FROM documents")
def split_batches(t: Tables) -> DataFrame:
    return writers.with_batches(t.documents.select("lang", "doc_id"), 8, "lang", "doc_id")


@query("SELECT user_id, max(value) AS value, arg_max(event_id, value) AS event_id FROM events GROUP BY 1")
def running_best_hits(t: Tables) -> DataFrame:
    return running_best(t.events, "user_id", "value", "event_id").select("user_id", "value", "event_id")


@query("SELECT l_orderkey, l_partkey, l_quantity FROM lineitem WHERE l_returnflag = 'R' AND l_linestatus = 'O'")
def metadata_predicates(t: Tables) -> DataFrame:
    rows = quality.drop_incomplete(quality.non_null(t.lineitem, "l_shipdate"), "l_returnflag", "l_linestatus")
    return quality.matching(rows, l_returnflag="R", l_linestatus="O").select("l_orderkey", "l_partkey", "l_quantity")


@query("SELECT page_id, url FROM pages WHERE contains(upper(url), 'EXAMPLE.COM') OR contains(upper(url), 'UTM_')")
def filter_header_contains(t: Tables) -> DataFrame:
    return quality.header_contains(t.pages, ["example.com", "utm_"], "url").select("page_id", "url")


@query("SELECT c_custkey, CASE WHEN c_mktsegment = 'BUILDING' THEN 'CONSTRUCTION' ELSE c_mktsegment END AS c_mktsegment FROM customer")
def set_value(t: Tables) -> DataFrame:
    return quality.set_value(t.customer, "c_mktsegment", "BUILDING", "c_mktsegment", "CONSTRUCTION").select("c_custkey", "c_mktsegment")


@query("SELECT p_brand, min(p_partkey) AS first FROM part GROUP BY 1")
def distinct_in_order(t: Tables) -> DataFrame:
    return profile.distinct_in_order(t.part, "p_brand", "p_partkey")


@query("SELECT o_orderkey, o_custkey, o_orderdate FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS n FROM orders) WHERE n = 1")
def last_wins(t: Tables) -> DataFrame:
    rows = t.orders.withColumn("ord", F.struct("o_orderdate", "o_orderkey"))
    return assign.last_wins(rows, ["o_custkey"]).select("o_orderkey", "o_custkey", "o_orderdate")
