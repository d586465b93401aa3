"""URL filters: path rules, and a blocked Bloom filter of listed URLs before an exact hash join.

The list's canonical URLs are hashed into blocks of eight 64-bit words, one bit in each word, and blocks
are put together with bit_or. The filter's size follows the list up to `max_blocks`; it is broadcast, and
beyond that size more false positives pass, which the exact join removes all the same. So only pages the
filter lets through are shuffled, and the result is exact at any size. The list side of the join has one
row per URL; a URL that a third of all pages share is split by AQE on the page side.

Defined cases: a url that is null or has no `://` has an empty host and path, fits no rule and is never
listed (verdict allow); repeated pages are judged alike; an empty list blocks nothing; other columns of
either table are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import own, saved

WORDS = 8  # words in a block; six hash bits choose the bit of each


@dataclass(frozen=True)
class Rule:
    verdict: str  # allow or block
    host: str  # fits this host and all subdomains
    path: str  # fits paths that start so

    @property
    def text(self) -> str:
        return self.host + self.path


def host_of(url: Column) -> Column:
    return F.translate(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    return F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def canonical(url: Column) -> Column:
    """Host without `www.` and port 80 or 443, path without a last `/`, and the query without tracking
    parameters; scheme and fragment don't count. Null without a host."""
    host = F.regexp_replace(F.regexp_replace(host_of(url), r"^www\.", ""), r":(80|443)$", "")
    path = F.regexp_replace(path_of(url), r"/+$", "")
    query = F.regexp_extract(url, r"(?s)^[^?#]*\?([^#]*)", 1)
    kept = F.regexp_replace(F.regexp_replace(query, r"(^|&)(utm_[a-z]+|ref|fbclid|gclid)=[^&]*", ""), r"^&", "")
    return F.when(host != "", F.concat(host, path, F.when(kept != "", F.concat(F.lit("?"), kept)).otherwise("")))


def matching_rule(host: Column, path: Column, rules: list[Rule]) -> tuple[Column, Column]:
    """Text and verdict of the longest rule that fits, else null; `rules` is a short list held in the plan."""
    text, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.text), r.text)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        text, verdict = F.when(fits, F.lit(rule.text)).otherwise(text), F.when(fits, F.lit(rule.verdict)).otherwise(verdict)
    return text, verdict


def _address(key: Column, blocks: int) -> tuple[Column, list[Column]]:
    """Block number and the word masks of a key."""
    first, second = F.xxhash64(key, F.lit(11)), F.xxhash64(key, F.lit(29))
    masks = [F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftrightunsigned(second, 6 * k).bitwiseAND(F.lit(63)).cast("int")) for k in range(WORDS)]
    return F.pmod(first, F.lit(blocks)), masks


def build_filter(keys: DataFrame, n_keys: int, max_blocks: int = 1 << 17, keys_per_block: int = 32) -> tuple[DataFrame, int]:
    """keys(key) to (block, w0..w7), and the number of blocks. 16 bits a key until max_blocks (64 bytes each)."""
    blocks = max(1, min(max_blocks, -(-n_keys // keys_per_block)))
    block, masks = _address(F.col("key"), blocks)
    bits = keys.select(block.alias("block"), *[m.alias(f"w{k}") for k, m in enumerate(masks)])
    return bits.groupBy("block").agg(*[F.bit_or(f"w{k}").alias(f"w{k}") for k in range(WORDS)]), blocks


def probed(df: DataFrame, key: Column, bloom: DataFrame, blocks: int, out: str) -> DataFrame:
    """df plus `out`: whether the filter may hold the key (it never says no to one it holds; a null key is never held)."""
    block, masks = _address(key, blocks)
    hit = key.isNotNull()
    for k, m in enumerate(masks):
        hit = hit & (F.col(f"w{k}").bitwiseAND(m) == m)
    seen = df.withColumn("at", block).join(F.broadcast(bloom.withColumnRenamed("block", "at")), "at", "left")
    return seen.select(*[f"`{c}`" for c in df.columns], F.coalesce(hit, F.lit(False)).alias(out))


def listed_pages(pages: DataFrame, listed: DataFrame, max_blocks: int = 1 << 17) -> DataFrame:
    """pages(key, ...) plus `listed`: whether listed(key) has the key. Null keys are never listed."""
    keys = saved(listed.select("key").filter(F.col("key").isNotNull()).distinct(), "listed")
    n = keys.count()
    if not n:
        return pages.withColumn("listed", F.lit(False))
    bloom, blocks = build_filter(keys, n, max_blocks)
    bloom = saved(bloom, "bloom")
    names = [f"`{c}`" for c in pages.columns]
    seen = probed(pages, F.col("key"), bloom, blocks, "possible")
    exact = keys.select(F.col("key").alias("list_key"))
    checked = seen.filter("possible").join(exact, F.col("key") == F.col("list_key"), "left")
    return seen.filter(~F.col("possible")).select(*names, F.lit(False).alias("listed")).unionByName(checked.select(*names, F.col("list_key").isNotNull().alias("listed")))


def filter_urls(pages: DataFrame, listed: DataFrame, rules: list[Rule], id_col: str = "page_id", url_col: str = "url", max_blocks: int = 1 << 17) -> DataFrame:
    """Per row of pages: id, host, path, rule, listed and verdict. listed: a table with a column of URLs, url_col.

    The verdict is the longest fitting rule's, else block if the canonical URL is listed, else allow.
    """
    url = F.coalesce(F.col("url"), F.lit(""))
    rows = own(pages, id=id_col, url=url_col).select("id", host_of(url).alias("host"), path_of(url).alias("path"), canonical(url).alias("key"))
    rule, verdict = matching_rule(F.col("host"), F.col("path"), rules)
    rows = rows.withColumn("rule", rule).withColumn("rule_verdict", verdict)
    bad = own(listed, url=url_col).select(canonical(F.col("url")).alias("key"))
    out = listed_pages(rows, bad, max_blocks)
    return out.select(F.col("id").alias(id_col), "host", "path", "rule", "listed", F.coalesce("rule_verdict", F.when(F.col("listed"), "block").otherwise("allow")).alias("verdict"))
