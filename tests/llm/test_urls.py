"""URL filter: SQL, odd URLs, and a filter so small that most lookups are false positives."""

from comparing import assert_same, duck
from conftest_data import SF

from segtrace.llm.queries import ORACLES, QUERIES, URL_RULES
from segtrace.llm.urls import Rule, filter_urls

URLS = [
    (1, "http://A.Example.NET/en/1"), (2, "https://x.example.com/de/"), (3, "https://x.org/fr/a?b#c"), (4, "https://anet/x"), (5, "https://net"), (6, "https://net/"), (7, None), (8, ""), (9, "no scheme"),
    (10, "http://www.q.io:80/p/?utm_source=a&x=1#f"), (11, "https://q.io/p?x=1"), (12, "https://q.io/p?x=2"), (12, "https://q.io/p?x=2"), (None, "https://q.io/p"), (13, "mailto:a@b\n://h\n/p\nq"),
]


def test_equals_sql(spark):
    assert_same(QUERIES["op3_url_filter"](spark, SF), duck(SF), ORACLES["op3_url_filter"])


def test_rules_and_list(spark):
    pages = spark.createDataFrame([(*r, 1, "x") for r in URLS], "page_id long, url string, key int, host string")
    listed = spark.createDataFrame([("http://q.io/p?x=1",), (None,), ("junk",), ("http://q.io/p?x=1",)], "url string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in filter_urls(pages, listed, URL_RULES).collect()}
    assert got[1] == ("a.example.net", "/en/1", "example.net/en/", "allow") and got[2][2:] == ("example.com/de/", "block")
    assert got[3] == ("x.org", "/fr/a", "org/fr/", "allow") and got[4][2:] == (None, "allow")
    assert got[5] == ("net", "", None, "allow") and got[6][2:] == ("net/", "block")
    assert got[7] == got[8] == got[9] == ("", "", None, "allow") and got[10][3] == got[11][3] == "block" and got[12][3] == "allow"
    assert got[13][:2] == ("h\n", "/p\nq")
    assert filter_urls(pages, listed, URL_RULES).count() == len(URLS)
    assert filter_urls(pages, listed.limit(0), [Rule("block", "q.io", "/")]).filter("listed").count() == 0
    assert filter_urls(pages.limit(0), listed, URL_RULES).count() == 0


def test_small_filter_stays_exact(spark):
    pages = spark.range(3000).selectExpr("id AS page_id", "concat('https://h', id % 900, '.io/') AS url")
    listed = pages.filter("page_id % 3 = 0 AND page_id < 600")
    got = {r.url: r.listed for r in filter_urls(pages, listed, [], max_blocks=1).select("page_id", "listed").join(pages, "page_id").collect()}
    assert got == {u.url: u.url in {f"https://h{k}.io/" for k in range(0, 600, 3)} for u in pages.collect()}
