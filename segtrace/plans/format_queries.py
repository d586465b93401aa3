"""Registered queries of scans and sinks: the driver's tables are written in each format to the shared folder and read back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import dims, profile
from ..shared import fresh_folder
from ..sources import fasta_files, readers, writers
from .registry import Tables, query, text_of

_DNA = "regexp_replace(translate({0}, 'abcdefghijklmnopqrstuvwxyzXU-', 'ABCDEFGHIJKLMNOPQRSTTVWNYZNT'), '[^ACGTRYSWKMBDHVN]', 'N', 'g')"
_SEQ = _DNA.format("md5(o_orderkey::VARCHAR)")
_BASES = "translate(md5(o_orderkey::VARCHAR), '0123456789abcdef', 'ACGTACGTACGTACGT')"


def _orders(t: Tables) -> DataFrame:
    """Orders as sequences: 32 letters of the key's digest."""
    k = F.col("o_orderkey").cast("string")
    return t.orders.select(F.concat(F.lit("o"), k, F.lit("|"), "o_orderstatus").alias("header"), F.md5(k).alias("seq"), "o_orderkey", "o_orderstatus")


def _customers(t: Tables) -> DataFrame:
    return t.customer.select("c_mktsegment", F.concat(F.lit("c"), F.col("c_custkey").cast("string")).alias("header"), F.repeat(F.lit("ACGT"), F.lit(4)).alias("seq"))


def _lines(df: DataFrame, folder: str) -> str:
    """df(value) as a text file; returns the folder."""
    df.select("value").write.text(folder)
    return folder


@query(f"SELECT 'o' || o_orderkey || '|' || o_orderstatus AS header, 'o' || o_orderkey AS accession, {_SEQ} AS seq, 32 AS length FROM orders")
def read_fasta(t: Tables) -> DataFrame:
    folder = fresh_folder(t.spark, "fasta")
    writers.write_fasta(_orders(t), folder, wrap=20)
    return readers.read_fasta(t.spark, folder).select("header", "accession", "seq", "length")


@query("SELECT c_mktsegment AS segment, 'c' || c_custkey AS header, 16 AS length FROM customer")
def read_fasta_dir(t: Tables) -> DataFrame:
    """One directory for each market segment, read as one table."""
    folder = fresh_folder(t.spark, "fasta-by")
    writers.write_fasta_by(_customers(t), folder, "c_mktsegment", wrap=10)
    back = readers.read_fasta(t.spark, folder, recursive=True, pattern="*.txt")
    return back.select(F.regexp_extract("source_file", "c_mktsegment=([^/]+)/", 1).alias("segment"), "header", "length")


@query("SELECT c_mktsegment AS segment, 'c' || c_custkey AS header, 16 AS length FROM customer")
def write_named_fasta(t: Tables) -> DataFrame:
    """One file for each market segment that carries its name, found by the reader's own pattern."""
    folder = fresh_folder(t.spark, "fasta-named")
    fasta_files.write_named(_customers(t), folder, "c_mktsegment", wrap=10)
    back = readers.read_fasta(t.spark, folder, recursive=True)
    return back.select(F.regexp_extract("source_file", r"/([^/.]+)(?:\.\d+)?\.fasta$", 1).alias("segment"), "header", "length")


@query("SELECT 'o' || o_orderkey AS accession, o_orderstatus AS second FROM orders")
def fasta_headers(t: Tables) -> DataFrame:
    folder = fresh_folder(t.spark, "fasta")
    writers.write_fasta(_orders(t), folder)
    return readers.fasta_headers(t.spark, folder, fields=True).select("accession", F.get("fields", F.lit(1)).alias("second"))


_MEMBERS = "SELECT '>Cluster ' || c_nationkey AS cluster, (row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) - 1)::INT AS member_idx, c_custkey FROM customer"


@query(f"""
WITH m AS ({_MEMBERS})
SELECT cluster, member_idx, 'C' || c_custkey AS accession, (400 + c_custkey % 900)::INT AS length, member_idx = 0 AS is_rep,
  CASE WHEN member_idx > 0 THEN CASE WHEN c_custkey % 2 = 0 THEN '+' ELSE '-' END END AS strand, CASE WHEN member_idx > 0 THEN 99 + (c_custkey % 100) / 100.0::DOUBLE END AS identity FROM m""")
def read_clusters(t: Tables) -> DataFrame:
    """Customers of a nation as members of a cluster, in cluster text."""
    rows = t.customer.select(F.col("c_nationkey").alias("k"), F.col("c_custkey").alias("c"))
    each = F.sort_array(F.collect_list("c"))
    line = lambda c, i: F.concat(
        i.cast("string"), F.lit("\t"), (400 + c % 900).cast("string"), F.lit("nt, >C"), c.cast("string"), F.lit("... "),
        F.when(i == 0, "*").otherwise(F.concat(F.lit("at "), F.when(c % 2 == 0, "+").otherwise("-"), F.lit("/99."), F.lpad((c % 100).cast("string"), 2, "0"), F.lit("%"))),
    )
    text = rows.groupBy("k").agg(each.alias("m")).select(F.concat(F.lit(">Cluster "), F.col("k").cast("string"), F.lit("\n"), F.array_join(F.transform("m", line), "\n")).alias("value"))
    return readers.read_clusters(t.spark, _lines(text, fresh_folder(t.spark, "clusters")))


@query("""
SELECT 'A' || o_orderkey AS accession, CASE WHEN o_orderkey % 3 > 0 THEN 'H' || (o_orderkey % 16 + 1) || 'N1' END AS genotype, (o_orderkey % 8 + 1)::INT AS segment, floor(o_totalprice)::INT AS length,
  o_orderpriority AS host, strftime(o_orderdate, '%Y-%m') AS collection_date FROM orders""")
def read_metadata(t: Tables) -> DataFrame:
    """Orders as sequence metadata: segments by acronym or number, an absent genotype is an empty cell."""
    k, folder = F.col("o_orderkey"), fresh_folder(t.spark, "metadata")
    segment = F.when(k % 2 == 0, T.segment_name((k % 8 + 1).cast("int"))).otherwise((k % 8 + 1).cast("string"))
    rows = t.orders.select(
        F.concat(F.lit("A"), k.cast("string")).alias("Accession"), F.when(k % 3 > 0, F.concat(F.lit("H"), (k % 16 + 1).cast("string"), F.lit("N1"))).alias("Genotype"), segment.alias("Segment"),
        F.floor("o_totalprice").cast("int").alias("Length"), F.col("o_orderpriority").alias("Host"), F.date_format("o_orderdate", "yyyy-MM").alias("Collection_Date"),
    )
    rows.write.csv(folder, sep=";", header=True)
    back = readers.read_metadata(t.spark, folder, required=("ACCESSION", "SEGMENT"))
    return back.select(F.col("ACCESSION").alias("accession"), F.col("GENOTYPE").alias("genotype"), F.col("SEGMENT").alias("segment"), F.col("LENGTH").alias("length"), F.col("HOST").alias("host"), F.col("COLLECTION_DATE").alias("collection_date"))


@query("""
SELECT 'q' || l_orderkey AS qseqid, 't' || l_partkey AS sseqid, l_extendedprice AS pident, l_quantity::INT AS length, l_linenumber AS mismatch, 0 AS gapopen, 1 AS qstart, l_quantity::INT AS qend, 1 AS sstart, l_quantity::INT AS send,
  l_discount AS evalue, l_tax AS bitscore FROM lineitem""")
def read_hits(t: Tables) -> DataFrame:
    """Lines of orders as tabular hits."""
    n, zero, one, folder = F.col("l_quantity").cast("int"), F.lit(0), F.lit(1), fresh_folder(t.spark, "hits")
    rows = t.lineitem.select(F.concat(F.lit("q"), F.col("l_orderkey").cast("string")), F.concat(F.lit("t"), F.col("l_partkey").cast("string")), "l_extendedprice", n, "l_linenumber", zero, one, n, one, n, "l_discount", "l_tax")
    rows.toDF(*map(str, range(12))).write.csv(folder, sep="\t")
    return readers.read_hits(t.spark, folder)


@query("""
WITH c AS (SELECT c_nationkey AS g, c_mktsegment AS k, count(*) AS w FROM customer GROUP BY ALL), s AS (SELECT *, w * 1.0::DOUBLE / sum(w) OVER (PARTITION BY g) * 100 AS e FROM c),
u AS (SELECT *, floor(e)::BIGINT AS units, e - floor(e) AS left_ FROM s), r AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY left_ DESC, k) AS n, 100 - sum(units) OVER (PARTITION BY g) AS open FROM u),
x AS (SELECT g, k, (units + CASE WHEN n <= open THEN 1 ELSE 0 END) AS units FROM r)
SELECT 'n' || g AS sample_name, '{' || string_agg('''' || k || ''': ' || printf('%.2f', units / 100.0::DOUBLE), ', ' ORDER BY units DESC, k) || '}' AS host, CASE WHEN g % 2 = 0 THEN 'x' END AS note FROM x GROUP BY g""")
def read_report(t: Tables) -> DataFrame:
    """Distributions written as report text, an absent note as NA."""
    folder = fresh_folder(t.spark, "report")
    counts = profile.value_counts(t.customer, "c_nationkey", ["c_mktsegment"], "c_custkey")
    rows = counts.select(F.concat(F.lit("n"), F.col("c_nationkey").cast("string")).alias("SAMPLE_NAME"), F.col("c_mktsegment").alias("HOST"), F.when(F.col("c_nationkey") % 2 == 0, " x ").alias("NOTE"))
    writers.write_report(rows, folder)
    return readers.read_report(t.spark, folder, ("SAMPLE_NAME", "HOST")).select(F.col("SAMPLE_NAME").alias("sample_name"), F.col("HOST").alias("host"), F.col("NOTE").alias("note"))


@query("SELECT user_id::VARCHAR AS sample, 'PB2:E' || (event_id % 700) || 'K' AS raw FROM events WHERE event_id % 5 > 0")
def read_markers(t: Tables) -> DataFrame:
    folder = fresh_folder(t.spark, "markers")
    raw = F.when(F.col("event_id") % 5 > 0, F.concat(F.lit("PB2:E"), (F.col("event_id") % 700).cast("string"), F.lit("K")))
    t.events.select(F.col("user_id").alias("Sample"), raw.alias("Mutations in your sample")).write.csv(folder, sep="\t", header=True)
    return readers.read_markers(t.spark, folder)


@query("""
SELECT 's' || o_orderkey AS seq_name, CASE WHEN o_orderkey % 4 > 0 THEN '2.3.' || (o_orderkey % 4) ELSE 'N/A' END AS clade, 'H' || (o_orderkey % 3 + 1) AS subtype FROM orders""")
def clade_table(t: Tables) -> DataFrame:
    """A folder of clade tables for each subtype, read at once; an absent clade is N/A."""
    from .jobs import clade_table as table

    folder, k = fresh_folder(t.spark, "clades"), F.col("o_orderkey")
    rows = t.orders.select(F.concat(F.lit("s"), k.cast("string")).alias("seqName"), F.when(k % 4 > 0, F.concat(F.lit("2.3."), (k % 4).cast("string"))).alias("clade"), (k % 3 + 1).cast("string").alias("H"))
    rows.withColumn("kind", F.concat(F.lit("H"), "H")).drop("H").write.partitionBy("kind").csv(folder, sep="\t", header=True)
    return table(readers.read_clades(t.spark, folder, r"kind=(H\d+)/"))


@query("SELECT 'e' || event_id AS name, event_type AS genotype, CASE WHEN event_id % 2 = 0 THEN '1' END AS pb2 FROM events")
def read_constellations(t: Tables) -> DataFrame:
    folder = fresh_folder(t.spark, "constellations")
    t.events.select(F.concat(F.lit("e"), F.col("event_id").cast("string")).alias("Sample Name"), F.col("event_type").alias("Genotype"), F.when(F.col("event_id") % 2 == 0, "1").alias("PB2")).write.csv(folder, sep="\t", header=True)
    return readers.read_constellations(t.spark, folder).select(F.col("Sample Name").alias("name"), F.col("Genotype").alias("genotype"), F.col("PB2").alias("pb2"))


@query("SELECT n_name AS name, r_name AS parent FROM nation JOIN region ON n_regionkey = r_regionkey UNION ALL SELECT r_name, NULL FROM region")
def read_tree(t: Tables) -> DataFrame:
    """Regions and nations as a JSON tree in a file."""
    leaf = F.struct(F.lit("country").alias("rank"))
    per = t.nation.groupBy("n_regionkey").agg(F.map_from_entries(F.collect_list(F.struct("n_name", leaf))).alias("leaves"))
    rows = t.region.join(per, F.col("r_regionkey") == F.col("n_regionkey"), "left")
    tree = F.map_from_entries(F.collect_list(F.struct("r_name", F.struct(F.lit("region").alias("rank"), F.col("leaves").alias("children")))))
    folder = _lines(rows.agg(F.to_json(F.struct(tree.alias("tree"))).alias("value")).coalesce(1), fresh_folder(t.spark, "tree"))
    return dims.walk_tree(readers.read_tree(t.spark, folder)).select("name", F.try_element_at("lineage", F.lit(-2))["name"].alias("parent"))


@query("""
WITH c AS (SELECT c_nationkey, c_mktsegment, count(*) AS n, min(c_custkey) AS f FROM customer GROUP BY ALL)
SELECT '>Cluster ' || c_nationkey AS cluster, 'R' || min(f) AS representative, string_agg(c_mktsegment || '=' || n, ';' ORDER BY f) AS hosts, 'Unknown' AS collection_date FROM c GROUP BY c_nationkey""")
def read_cluster_profiles(t: Tables) -> DataFrame:
    """Five-field profile tables with dictionary literals."""
    folder = fresh_folder(t.spark, "profiles")
    counts = profile.value_counts(t.customer, "c_nationkey", ["c_mktsegment"], "c_custkey")
    first = t.customer.groupBy(F.col("c_nationkey").alias("k")).agg(F.min("c_custkey").alias("f"))
    rows = counts.join(first, F.col("c_nationkey") == F.col("k"))
    text = F.concat(F.lit("{"), F.array_join(F.transform("c_mktsegment", lambda x: F.concat(F.lit("'"), x["key"], F.lit("': "), x["weight"].cast("int").cast("string"))), ", "), F.lit("}"))
    rows.select(F.concat(F.lit(">Cluster "), F.col("k").cast("string")).alias("Cluster"), F.concat(F.lit("R"), F.col("f").cast("string")).alias("Representative"), F.lit("{}").alias("Genotypes"), F.lit("{4: 1}").alias("Segments"), text.alias("Hosts")).write.csv(folder, sep="\t", header=True)
    return readers.read_cluster_profiles(t.spark, folder).select("cluster", "representative", text_of("hosts", "hosts"), "collection_date")


def _genbank(t: Tables, place: Column | None = None) -> DataFrame:
    """Orders as GenBank records: a coding sequence over the first twelve letters, one in two on the other strand."""
    k = F.col("o_orderkey").cast("string")
    seq = F.lower(F.translate(F.md5(k), "0123456789abcdef", "ACGTACGTACGTACGT"))
    place = place if place is not None else F.when(F.col("o_orderkey") % 2 == 0, "complement(1..12)").otherwise("join(1..6,9..14)")
    text = F.concat(
        F.lit("LOCUS       R"), k, F.lit(" 32 bp\nDEFINITION  Order of\n            "), "o_orderstatus", F.lit(".\nVERSION     R"), k, F.lit(".1\nFEATURES             Location/Qualifiers\n     CDS             "), place,
        F.lit('\n                     /gene="G'), (F.col("o_orderkey") % 8).cast("string"), F.lit('"\nORIGIN\n        1 '), F.substring(seq, 1, 10), F.lit(" "), F.substring(seq, 11, 22), F.lit("\n//"),
    )
    return readers.read_genbank(t.spark, _lines(t.orders.select(text.alias("value")), fresh_folder(t.spark, "genbank")))


@query(f"SELECT 'R' || o_orderkey || '.1' AS record_id, 'Order of ' || o_orderstatus || '.' AS definition, {_BASES} AS seq, 1 AS n_features FROM orders")
def read_genbank(t: Tables) -> DataFrame:
    return _genbank(t).select("record_id", "definition", "seq", F.size("features").alias("n_features"))


@query(f"""
SELECT 'R' || o_orderkey || '.1 | CDS_G' || (o_orderkey % 8) AS header,
  CASE WHEN o_orderkey % 2 = 0 THEN reverse(translate({_BASES}[1:12], 'ACGT', 'TGCA')) ELSE {_BASES}[1:6] || {_BASES}[9:14] END AS seq FROM orders
UNION ALL SELECT 'R' || o_orderkey || '.1 Order of ' || o_orderstatus || '.', {_BASES} FROM orders""")
def genbank_to_fasta(t: Tables) -> DataFrame:
    """Whole records and their coding sequences as FASTA rows."""
    records = _genbank(t)
    return readers.feature_sequences(records).unionByName(writers.genbank_to_fasta(records))


_TURNED = "reverse(translate({}, 'ACGT', 'TGCA'))"


@query(f"""
SELECT 'R' || o_orderkey || '.1 | CDS_G' || (o_orderkey % 8) AS header, CASE o_orderkey % 6
  WHEN 0 THEN {_TURNED.format(f"{_BASES}[1:3]")} || {_TURNED.format(f"{_BASES}[4:5]")}
  WHEN 1 THEN {_TURNED.format(f"{_BASES}[1:3]")} || {_BASES}[6:7]
  WHEN 2 THEN {_TURNED.format(f"{_BASES}[9:14]")} || {_TURNED.format(f"{_BASES}[1:6]")}
  WHEN 3 THEN {_BASES}[4:8] WHEN 4 THEN {_BASES}[5:5] || {_BASES}[7:20] ELSE {_BASES}[2:3] || {_TURNED.format(f"{_BASES}[8:9]")} || {_TURNED.format(f"{_BASES}[5:6]")} END AS seq FROM orders""")
def feature_locations(t: Tables) -> DataFrame:
    """Joins of complements, both strands in one feature, a complement of a join, a remote span, single bases, and nested ones."""
    forms = ["join(complement(1..3),complement(4..5))", "join(complement(1..3),6..7)", "complement(join(1..6,9..14))", "join(J00194.1:1..9,<4..>8)", "order(5,7..20)", "join(2..3,complement(join(5..6,8..9)))"]
    return readers.feature_sequences(_genbank(t, F.element_at(F.array(*map(F.lit, forms)), (F.col("o_orderkey") % 6 + 1).cast("int"))))


@query("SELECT c_custkey AS sample_id, CASE WHEN c_acctbal < 0 THEN 'failed' ELSE 'ok' END AS status FROM customer")
def write_state(t: Tables) -> DataFrame:
    folder = fresh_folder(t.spark, "state")
    writers.write_state(t.customer.select(F.col("c_custkey").alias("sample_id"), F.when(F.col("c_acctbal") < 0, "failed").otherwise("ok").alias("status")), folder)
    return t.spark.read.schema("sample_id long, status string").json(folder)


@query("SELECT 'c' || c_custkey AS header, TRUE AS refused FROM customer")
def write_replaces(t: Tables) -> DataFrame:
    """Nations, then customers, to one place: refused, and done once replacing is asked for."""
    folder = fresh_folder(t.spark, "replaced")
    rows = lambda df, c: df.select(F.concat(F.lit("c"), F.col(c).cast("string")).alias("header"), F.lit("ACGT").alias("seq"))
    writers.write_fasta(rows(t.nation, "n_nationkey"), folder)
    try:
        writers.write_fasta(rows(t.customer, "c_custkey"), folder)
        refused = False
    except Exception as error:  # Spark's error classes differ by how the session is connected
        refused = "already exists" in str(error)
    writers.write_fasta(rows(t.customer, "c_custkey"), folder, replace=True)
    return readers.read_fasta(t.spark, folder).select("header", F.lit(refused).alias("refused"))


@query("SELECT c_nationkey, count(*) AS n FROM customer GROUP BY 1")
def write_report_csv(t: Tables) -> DataFrame:
    folder = fresh_folder(t.spark, "csv")
    writers.write_report(t.customer.groupBy("c_nationkey").agg(F.count("*").alias("n")), folder, sep=",")
    back = t.spark.read.csv(folder, header=True)
    return back.select(F.col("c_nationkey").cast("int").alias("c_nationkey"), F.col("n").cast("long").alias("n"))

