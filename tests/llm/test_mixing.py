"""Pivotal mixing: targets by hand, words near them, probabilities kept, reruns equal."""

import pytest
from conftest_data import DOCS, SF, docs_frame
from pyspark.sql import functions as F

from segtrace.llm.mixing import mix, mix_documents, round_dependently, targets
from segtrace.llm.queries import QUERIES


def by_hand(sizes, weights, share, most):
    want, full = share * sum(sizes), set()
    while True:
        free = [k for k in range(len(sizes)) if k not in full]
        left = want - sum(most * sizes[k] for k in full)
        whole = sum(weights[k] for k in free)
        goal = [most * sizes[k] if k in full else left * weights[k] / whole for k in range(len(sizes))]
        over = {k for k in free if goal[k] > most * sizes[k] + 1e-9}
        if not over:
            return goal
        full |= over


@pytest.mark.parametrize("sizes", [[100, 100, 100], [10, 1000, 1000], [1, 2, 3, 4000], [5], [0, 7, 9]])
def test_targets(spark, sizes):
    weights = [(3.0, 1.0, 2.0)[k % 3] for k in range(len(sizes))]
    df = spark.createDataFrame([(str(k), s, w) for k, (s, w) in enumerate(zip(sizes, weights, strict=True))], "source string, source_size long, weight double")
    got = {r.source: r.target for r in targets(df, 1.5, 2.0).collect()}
    assert [got[str(k)] for k in range(len(sizes))] == pytest.approx(by_hand(sizes, weights, 1.5, 2.0))


def test_table(spark):
    rows = QUERIES["op5_pivotal_mixing"](spark, SF).collect()
    again = QUERIES["op5_pivotal_mixing"](spark, SF).collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, again))
    largest = max(r.size for r in rows)
    for source in {r.source for r in rows}:
        own = [r for r in rows if r.source == source]
        assert sum(r.size for r in own) == own[0].source_size
        assert abs(sum(r.taken for r in own) - own[0].target) <= largest
    assert all(r.taken <= 2 * r.size and r.taken == r.copies * r.size for r in rows)
    assert sum({r.source: r.target for r in rows}.values()) == pytest.approx(1.5 * sum(r.size for r in rows))


def test_tree_keeps_sums_and_probabilities(spark):
    """Many small buckets and fan-in 2: the sum of words stays; over seeds each row is taken as often as it should."""
    rows = [("a" if k % 3 else None, k, 1 + k % 7, 0.3) for k in range(60)]
    df = spark.createDataFrame(rows, "source string, id long, size long, p double")
    taken = dict.fromkeys(range(60), 0)
    for seed in range(6):
        got = round_dependently(df, seed, per_bucket=8, fan_in=2).collect()
        assert len(got) == 60 and {r.p for r in got} <= {0.0, 1.0}
        for source in ("a", None):
            want = sum(0.3 * z for s, _, z, _ in rows if s == source)
            assert abs(sum(r.size * r.p for r in got if r.source == source) - want) < 7.001
        for r in got:
            taken[r.id] += r.p
    assert 0.15 < sum(taken.values()) / 360 < 0.45


def test_one_id_or_text_is_spread(spark):
    """Null ids, one id, and one row many times over: buckets stay small, and equal rows share their copies."""
    docs = [(None, f"{'w ' * (k % 5 + 1)}text {k}") for k in range(300)] + [(7, f"other {k} words here") for k in range(300)] + [(8, "the very same row")] * 300
    frame = docs_frame(spark, docs)
    keyed = frame.selectExpr("doc_id AS id", "xxhash64(text) AS text").groupBy("id", "text").count().selectExpr("id", "text", "explode(sequence(1, count)) AS nth")
    buckets = keyed.selectExpr("pmod(xxhash64(1, id, text, nth), 30) AS b").groupBy("b").count()
    assert buckets.agg(F.max("count")).first()[0] < 90
    rows = mix(frame).collect()
    assert len(rows) == 900 and all(r.taken <= 2 * r.size for r in rows)
    got = mix_documents(frame)
    assert got.count() == sum(r.copies for r in rows) and got.agg(F.max("copy")).first()[0] <= 2


def test_odd_rows(spark):
    frame = docs_frame(spark, DOCS)
    rows = mix(frame).collect()
    assert len(rows) == len(DOCS) and all(r.taken == 0 for r in rows if r.size == 0) and all(r.taken <= 2 * r.size for r in rows)
    out = mix_documents(frame)
    assert out.columns == [*frame.columns, "copy"] and out.count() == sum(r.copies for r in rows)
    clash = mix_documents(frame.withColumn("copy", F.lit("old")))
    assert clash.columns == [*frame.columns, "copy"] and clash.count() == out.count()
    assert mix(docs_frame(spark, [])).count() == 0 and mix_documents(docs_frame(spark, [])).count() == 0
