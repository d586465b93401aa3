"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .centroids import cluster
from .common import table
from .compression import quality_rules
from .decontaminate import leaks
from .forest import near_duplicates
from .gam import classify
from .lm_trie import learn_and_score
from .mixing import mix
from .negatives import mine_negatives
from .perspective import rotate
from .pii import pii_report
from .token_files import read_records, token_digests, write_tokens
from .urls import Rule, filter_urls
from .warc import archive_pages, page_records

URL_RULES = [Rule("block", "net", "/"), Rule("allow", "example.net", "/en/"), Rule("block", "example.com", "/de/"), Rule("allow", "org", "/fr/")]


def op1_lm_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Learnt from the documents whose crc32(doc_id as text) mod 7 isn't 2, scored on all."""
    return learn_and_score(table(spark, sf_dir, "documents"), fold=7, held=2)


def op2_template_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for each benchmark item that leaked into a document."""
    return leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages against the rules and a list: the URLs of the pages whose id is divisible by 100."""
    pages = table(spark, sf_dir, "pages")
    return filter_urls(pages, pages.filter(F.col("page_id") % 100 == 0), URL_RULES)


def op4_compression_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents"))


def op5_pivotal_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents"), weights=(3, 1, 2), total_share=1.5, most=2.0)


def op6_lsh_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), percent=85)


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    back = page_records(spark, archive_pages(table(spark, sf_dir, "pages")))
    return back.withColumns({"page_id": F.col("page_id").cast("long"), "refers_to": F.col("refers_to").cast("long")})


def op8_perspectives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rotate(table(spark, sf_dir, "conversations"))


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii_report(table(spark, sf_dir, "documents"))


def op10_gam_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), label_col="quality", fold=5, threshold=0.3)


def op11_orchard_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """40 centroids, 5 rounds, over all vectors of 64 components."""
    return cluster(table(spark, sf_dir, "embeddings"), k=40, rounds=5, seed=2, scale=256, dims=64)


def op12_cover_tree_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Anchors are the rows whose id is divisible by 100; the label of every seventh id is moved on by one."""
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine_negatives(table(spark, sf_dir, "embeddings").withColumn("label", moved), every=100, positives=5, negatives=5, low=80, high=100)


def op13_token_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of all documents written as records, in the order of doc_id, and read back."""
    import public_tokenizers

    folder = write_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), end_id=2)
    return token_digests(read_records(spark, folder))


QUERIES = {f.__name__: f for f in (op1_lm_trie, op2_template_decontamination, op3_url_filter, op4_compression_bands, op5_pivotal_mixing, op6_lsh_forest, op7_warc, op8_perspectives, op9_pii, op10_gam_quality, op11_orchard_clusters, op12_cover_tree_negatives, op13_token_records)}

_HOST = "translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_PATH = "regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1)"
_KEPT = r"regexp_replace(regexp_replace(regexp_extract(url, '(?s)^[^?#]*\?([^#]*)', 1), '(^|&)(utm_[a-z]+|ref|fbclid|gclid)=[^&]*', '', 'g'), '^&', '')"



def _rounds_sql(k: int, rounds: int, seed: int, scale: int, dims: int) -> str:
    """k-means as one common table expression for each step."""
    near = "SELECT q.vec_id, v, n, (list_inner_product(v, v) - 2 * list_inner_product(v, c) + list_inner_product(c, c))::BIGINT AS d FROM q, c{r}"
    best = "SELECT vec_id, any_value(v) AS v, arg_min(n, [d, n]) AS n, min(d) AS d FROM ({near}) GROUP BY vec_id"
    steps = [
        f"q AS MATERIALIZED (SELECT vec_id, list_transform(embedding, lambda x: floor({scale} * x::DOUBLE)) AS v FROM embeddings WHERE len(embedding) = {dims} AND len(list_filter(embedding, lambda x: isfinite(x))) = {dims})",
        f"c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY sha256('{seed}:' || vec_id)) - 1 AS n, v AS c FROM q ORDER BY n LIMIT {k})",
    ]
    for r in range(rounds + 1):
        steps.append(f"a{r} AS MATERIALIZED ({best.format(near=near.format(r=r))})")
        means = f"SELECT n, i, floor(sum(v[i]) / count(*)) AS m FROM (SELECT n, v, unnest(range(1, {dims + 1})) AS i FROM a{r}) GROUP BY n, i"
        steps.append(f"c{r + 1} AS MATERIALIZED (SELECT c{r}.n, coalesce(l, c) AS c FROM c{r} LEFT JOIN (SELECT n, list(m ORDER BY i) AS l FROM ({means}) GROUP BY n) USING (n))")
    return f"WITH {', '.join(steps)}" + rf"""
SELECT vec_id, n::INT AS cluster, d AS distance, (sum(d) OVER (PARTITION BY n))::BIGINT AS cluster_inertia, (sum(d) OVER ())::BIGINT AS inertia,
  sha256(array_to_string(list_transform(c, lambda x: x::BIGINT), ',')) AS centroid_sha256 FROM a{rounds} JOIN c{rounds} USING (n)"""


ORACLES = {
    "op12_cover_tree_negatives": """
WITH e AS MATERIALIZED (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings WHERE label IS NOT NULL AND vec_id IS NOT NULL AND len(list_filter(embedding, lambda x: isfinite(x))) = len(embedding)),
s AS MATERIALIZED (SELECT a.vec_id AS a, b.vec_id AS b, a.label = b.label AS same, list_inner_product(a.v, b.v)::BIGINT AS score FROM e a JOIN e b ON a.vec_id % 100 = 0),
p AS (SELECT * FROM s WHERE same AND a <> b QUALIFY row_number() OVER (PARTITION BY a ORDER BY score DESC, b) <= 5)
SELECT p.a AS anchor_id, p.b AS positive_id, (row_number() OVER (PARTITION BY p.a, p.b ORDER BY n.score DESC, n.b))::INT AS rank, n.b AS negative_id,
  p.score AS positive_score, n.score AS negative_score
FROM p JOIN s n ON n.a = p.a AND NOT n.same AND 80 * p.score <= 100 * n.score AND n.score <= p.score QUALIFY rank <= 5
""",
    "op11_orchard_clusters": _rounds_sql(40, 5, 2, 256, 64),
    "op3_url_filter": rf"""
WITH p AS (SELECT page_id, url, {_HOST} AS host, {_PATH} AS path, {_KEPT} AS kept FROM pages),
c AS (SELECT page_id, host, path, CASE WHEN host <> '' THEN regexp_replace(regexp_replace(host, '^www\.', ''), ':(80|443)$', '')
      || regexp_replace(path, '/+$', '') || CASE WHEN kept <> '' THEN '?' || kept ELSE '' END END AS key FROM p),
listed AS (SELECT DISTINCT key AS k FROM c WHERE page_id % 100 = 0 AND key IS NOT NULL),
r AS (SELECT c.*, CASE WHEN (host = 'example.net' OR ends_with(host, '.example.net')) AND starts_with(path, '/en/') THEN 'example.net/en/'
      WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/de/') THEN 'example.com/de/'
      WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/fr/') THEN 'org/fr/'
      WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/') THEN 'net/' END AS rule FROM c)
SELECT page_id, host, path, rule, k IS NOT NULL AS listed,
  CASE rule WHEN 'net/' THEN 'block' WHEN 'example.com/de/' THEN 'block' WHEN 'example.net/en/' THEN 'allow' WHEN 'org/fr/' THEN 'allow'
  ELSE CASE WHEN k IS NOT NULL THEN 'block' ELSE 'allow' END END AS verdict
FROM r LEFT JOIN listed ON key = k
""",
    "op6_lsh_forest": r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')] ELSE [array_to_string(w[i : i + 4], ' ') FOR i IN range(1, len(w) - 3)] END) AS g FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
i AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM i JOIN n x ON a = x.doc_id JOIN n y ON b = y.doc_id WHERE 100 * c >= 85 * (x.n + y.n - c)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r(a, b) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a),
c AS (SELECT a, min(b) AS component_id FROM r GROUP BY a)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM documents d LEFT JOIN n USING (doc_id) JOIN c ON a = d.doc_id
""",
    "op7_warc": """
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS hex FROM pages),
d AS (SELECT *, list_aggregate([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + (((('0x' || substr(hex, 1 + 5 * (k // 4), 5))::BIGINT) >> (15 - 5 * (k % 4))) & 31), 1)
      FOR k IN range(32)], 'string_agg', '') AS payload_digest FROM p),
m AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS keeper FROM d)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = keeper THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> keeper THEN keeper END AS refers_to FROM m
""",
    "op8_perspectives": r"""
WITH t AS (SELECT conv_id, turn, replace(replace(coalesce(role, 'unknown'), '<|', '<\|'), '|>', '|\>') AS role, replace(coalesce(text, ''), '<|', '<\|') AS text, coalesce(turn // 64, -1) AS block,
  CASE WHEN count(*) OVER (PARTITION BY conv_id, turn // 64) > 128 THEN (row_number() OVER (PARTITION BY conv_id, turn // 64 ORDER BY turn NULLS FIRST, role, text) - 1) // 64 ELSE 0 END AS piece FROM conversations),
s AS (SELECT DISTINCT conv_id, role AS speaker FROM t WHERE role <> 'system'),
r AS (SELECT t.*, speaker, CASE WHEN role = 'system' THEN '<|system|>' || chr(10) WHEN role = speaker THEN '<|assistant|>' || chr(10)
      ELSE '<|user name=' || role || '|>' || chr(10) END AS head, text || '<|end|>' || chr(10) AS body FROM t JOIN s USING (conv_id)),
o AS (SELECT *, coalesce(sum(length(head) + length(body)) OVER (PARTITION BY conv_id, speaker ORDER BY block, piece, turn, role, text
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS pos FROM r)
SELECT conv_id, speaker, block, piece, min(turn) AS first_turn, count(*) AS n_turns, count(*) FILTER (WHERE role = speaker) AS n_masked, min(pos) AS start,
  string_agg(head || body, '' ORDER BY turn, role, text) AS rendered,
  coalesce(string_agg((pos + length(head))::VARCHAR || ':' || (pos + length(head) + length(body))::VARCHAR, ',' ORDER BY pos) FILTER (WHERE role = speaker), '') AS mask
FROM o GROUP BY conv_id, speaker, block, piece
""",
}
