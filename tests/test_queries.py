import pytest
from comparing import SF, assert_same, duck

from segtrace.plans import ORACLES, QUERIES


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, con, name):
    assert_same(QUERIES[name](spark, SF), con, ORACLES[name])


def test_clusters_are_greedy(spark):
    """Leaders and members equal a sequential pass, highest price first."""
    got = {r.id: r.leader for r in QUERIES["greedy_clusters"](spark, SF).collect()}
    rows = spark.read.parquet(f"{SF}/lineitem.parquet").select("l_orderkey", "l_partkey", "l_suppkey", "l_extendedprice").collect()
    price, held = {}, {}
    for o, p, s, x in rows:
        price[o] = max(price.get(o, 0), x)
        held.setdefault((p, s), set()).add(o)
    near = {o: {} for o in price}
    for group in held.values():
        for a in group:
            for b in group - {a}:
                near[a][b] = near[a].get(b, 0) + 1
    leaders = set()
    for o in sorted(price, key=lambda o: (-price[o], o)):
        if not leaders & near[o].keys():
            leaders.add(o)
    want = {o: o if o in leaders else max((b for b in near[o] if b in leaders), key=lambda b: (near[o][b], price[b], -b)) for o in price}
    assert got == want


def test_every_query_is_registered():
    import __spark_entry__

    assert set(QUERIES) <= set(__spark_entry__.queries())
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
