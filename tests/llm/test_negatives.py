"""Cover trees against their definition, searches against all inner products, the query against SQL, odd rows."""

import math
import sys

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from segtrace.llm.covertree import Best, CoverTree, _farthest_first, _levels, descend
from segtrace.llm.negatives import mine_negatives
from segtrace.llm.queries import ORACLES, QUERIES

sys.path.insert(0, __file__.rpartition("/llm/")[0])
from comparing import SF, assert_same, duck  # noqa: E402

FAR = np.iinfo(np.int64)


def test_levels_nest_cover_and_keep_apart():
    rng = np.random.default_rng(2)
    points = np.concatenate([rng.normal(size=(20, 3)) + 40 * c for c in rng.normal(size=(9, 3))])
    centres, taken, owner = _farthest_first(points, 40)
    levels, far = _levels(points, centres, taken), lambda a, b: np.sqrt(((points[a] - points[b]) ** 2).sum(axis=-1))
    assert len(levels) > 3 and levels[-1][0] == 40
    for depth, (size, parent) in enumerate(levels):
        chosen = centres[:size]
        apart = [far(a, b) for k, a in enumerate(chosen) for b in chosen[:k]]
        if depth:
            above = levels[depth - 1][0]
            assert (parent[:above] == np.arange(above)).all() and size > above
            assert (far(chosen, centres[parent]) <= taken[above] + 1e-9).all()
            assert min(apart) >= taken[size - 1] - 1e-9
    assert (owner == np.array([[far(p, c) for c in centres] for p in range(len(points))]).argmin(axis=1)).mean() > 0.99


@given(st.integers(1, 120), st.integers(1, 6), st.integers(1, 9), st.integers(0, 2**32), st.sampled_from([1, 3, 400, 1 << 26]))
@settings(max_examples=60, deadline=None)
def test_radii_bound_and_search_is_exact(n, dims, leaf, seed, spread):
    """Small spreads give equal vectors and ties; the large one leaves floating point."""
    rng = np.random.default_rng(seed)
    vectors, ids = rng.integers(-spread + 1, spread, (n, dims)), rng.permutation(n) * 3
    tree = CoverTree.load(CoverTree.build(ids, vectors, leaf).dump())
    assert sorted(zip(tree.ids.tolist(), map(tuple, tree.vectors.tolist()), strict=True)) == sorted(zip(ids.tolist(), map(tuple, vectors.tolist()), strict=True))
    squares = (vectors.astype(float) ** 2).sum(axis=1)

    def check(node):
        a, b = tree.first[node], tree.first[node] + tree.many[node]
        below = list(range(a, b)) if tree.leaf[node] else [p for k in range(a, b) for p in check(k)]
        far = [math.dist(tree.centre[node], tree.vectors[p]) for p in below]  # the raised distance isn't smaller
        assert max(far) <= tree.radius[node] * (1 + 1e-9) + 1e-6 and tree.least[node] == min(tree.ids[p] for p in below)
        return below

    assert sorted(check(0)) == list(range(n)) and squares.max() >= 0
    queries = rng.integers(-spread + 1, spread, (7, dims))
    own = rng.choice(ids, 7)
    exact = [[sum(int(x) * int(y) for x, y in zip(q, v, strict=True)) for v in vectors] for q in queries]
    low, high = np.sort(rng.choice(np.array(exact).ravel(), (2, 7, 2)), axis=0)
    low[0], high[0], low[1], high[1] = FAR.min, FAR.max, 1, 0
    best = Best(queries, own, low, high, 3)
    descend(tree, best, np.arange(7))
    for k in range(7):
        for w in range(2):
            want = sorted((-s, int(i)) for s, i in zip(exact[k], ids, strict=True) if i != own[k] and low[k, w] <= s <= high[k, w])[:3]
            assert [(-int(s), int(i)) for s, i in zip(best.scores[k, w], best.ids[k, w], strict=True) if i != FAR.max] == want


def test_search_skips_nodes():
    rng = np.random.default_rng(3)
    vectors = np.concatenate([rng.integers(-20, 20, (300, 8)) + 500 * c for c in rng.normal(size=(12, 8)).round(1)]).astype(np.int64)
    tree = CoverTree.build(np.arange(len(vectors)), vectors)
    best = Best(vectors[::90], np.arange(len(vectors))[::90], np.full((40, 1), FAR.min), np.full((40, 1), FAR.max), 5)
    descend(tree, best, np.arange(40))
    assert best.products < 40 * len(vectors) / 3


def test_query_equals_sql(spark):
    for sf in (SF, SF.replace("0.001", "0.01")):
        assert_same(QUERIES["op12_cover_tree_negatives"](spark, sf), duck(sf), ORACLES["op12_cover_tree_negatives"])


def brute(rows, every, positives, negatives):
    kept = [(i, x, tuple(math.floor(256 * float(c)) for c in v)) for i, x, v in rows if i is not None and x is not None and v is not None and all(c is not None and math.isfinite(c) and abs(256 * c) < 1 << 26 for c in v)]
    dot = lambda a, b: sum(x * y for x, y in zip(a, b, strict=False))
    out = []
    for i, x, v in kept:
        if i % every == 0:
            near = sorted((-dot(v, w), j) for j, y, w in kept if y == x and j != i)[:positives]
            for p, j in near:
                hard = sorted((-dot(v, w), k) for k, y, w in kept if y != x and 80 * -p <= 100 * dot(v, w) <= 100 * -p)[:negatives]
                out += [(i, j, r, k, -p, -s) for r, (s, k) in enumerate(hard, 1)]
    return sorted(out)


@pytest.mark.parametrize("block", [4, 50, 4096])
def test_small_trees(spark, block):
    """Labels over several trees, hot labels and vectors, few dimensions, so that windows are full."""
    rng = np.random.default_rng(5)
    rows = [(k, int(rng.integers(0, 3)) if k % 3 else 1, rng.normal(size=3).round(2).tolist()) for k in range(240)]
    rows += [(k, k % 2, [0.5, 0.5, 0.25]) for k in range(240, 330)]
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>")
    got = mine_negatives(df, every=10, block=block, anchors_at_once=7, pivots=3)
    assert sorted(map(tuple, got.collect())) == brute(rows, 10, 5, 5)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    good = [(0, 1, [1.0, 1.0]), (0, 1, [1.0, 1.0]), (1, 1, [1.0, 0.5]), (2, 1, []), (3, 2, [0.9, 0.6, 7.0]), (3, 2, [0.9, 0.6]), (4, 2, [1.0]), (5, 3, [0.75, 0.75]), (10, 4, [-1.0, -1.0]), (11, 4, [1.0, 1.0])]
    bad = [(20, None, [1.0, 1.0]), (None, 1, [1.0, 1.0]), (30, 1, None), (40, 1, [1.0, None]), (50, 1, [nan, 1.0]), (60, 2, [inf, 1.0]), (70, 2, [1e9, 1.0]), (None, None, None)]
    schema = "vec_id long, label int, embedding array<double>, id long, v string, pivot int, far long, anchor_id long"
    frame = lambda rows: spark.createDataFrame([(i, x, v, 1, "x", 2, 3, 4) for i, x, v in rows], schema)
    got = mine_negatives(frame(good + bad), every=10, positives=3, negatives=2)
    assert sorted(map(tuple, got.collect())) == brute(good + bad, 10, 3, 2)
    for rows in ([], bad, good[:1]):
        none = mine_negatives(frame(rows), every=10)
        assert none.count() == 0 and none.columns == got.columns
