"""Orchard's search against all distances, the query against SQL, odd rows."""

import sys

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from segtrace.llm.centroids import Orchard, cluster
from segtrace.llm.queries import ORACLES, QUERIES

sys.path.insert(0, __file__.rpartition("/llm/")[0])
from comparing import SF, assert_same, duck  # noqa: E402


def plain(vectors, centroids):
    """(number, squared distance) with Python's integers, pair by pair."""
    far = lambda a, b: sum((int(x) - int(y)) ** 2 for x, y in zip(a, b, strict=True))
    return [min((far(v, c), k) for k, c in enumerate(centroids))[::-1] for v in vectors]


@given(st.integers(1, 12), st.integers(0, 30), st.integers(1, 5), st.integers(0, 2**32), st.sampled_from([1, 2, 300, 1 << 26]))
@settings(max_examples=150, deadline=None)
def test_nearest(k, n, dims, seed, spread):
    """Small spreads give ties and equal centroids, the large one the largest components."""
    rng = np.random.default_rng(seed)
    centroids, vectors = rng.integers(-spread + 1, spread, (k, dims)), rng.integers(-spread + 1, spread, (n, dims))
    which, dist, measured = Orchard(centroids).nearest(vectors)
    assert list(zip(which.tolist(), dist.tolist(), strict=True)) == plain(vectors, centroids)
    assert n <= measured <= n * k


def test_search_leaves_out_far_centroids():
    rng = np.random.default_rng(1)
    centroids = rng.integers(-100_000, 100_000, (40, 8))
    vectors = centroids[rng.integers(0, 40, 2000)] + rng.integers(-50, 50, (2000, 8))
    which, _, measured = Orchard(centroids).nearest(vectors)
    assert which.tolist() == [k for k, _ in plain(vectors, centroids)] and measured < 2000 * 10


def test_query_equals_sql(spark):
    assert_same(QUERIES["op11_orchard_clusters"](spark, SF), duck(SF), ORACLES["op11_orchard_clusters"])


def brute(rows, k, rounds, scale):
    import hashlib
    import math

    kept = [(i, tuple(math.floor(scale * float(x)) for x in v)) for i, v in rows]
    key = lambda r: (r[0] is None, hashlib.sha256(f"2:{r[0]}".encode()).hexdigest() if r[0] is not None else "", r[1])
    centroids = [v for _, v in sorted(kept, key=key)[:k]]
    for _ in range(rounds):
        near = [c for c, _ in plain([v for _, v in kept], centroids)]
        for c in range(len(centroids)):
            mine = [v for (_, v), n in zip(kept, near, strict=True) if n == c]
            if mine:
                centroids[c] = tuple(sum(x) // len(mine) for x in zip(*mine, strict=True))
    near = plain([v for _, v in kept], centroids)
    total = sum(d for _, d in near)
    sha = lambda c: hashlib.sha256(",".join(map(str, centroids[c])).encode()).hexdigest()
    return sorted((repr(i), c, d, sum(e for b, e in near if b == c), total, sha(c)) for (i, _), (c, d) in zip(kept, near, strict=True))


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    good = [(k, [float(k % 3), -k / 7, k / 5]) for k in range(20)] + [(3, [0.0, -3 / 7, 0.6]), (3, [9.0, 9.0, 9.0]), (None, [1.0, 2.0, 3.0]), (5, [0.1, 0.1, 0.1])]
    bad = [(30, None), (31, []), (32, [1.0, 2.0]), (33, [1.0, None, 2.0]), (34, [nan, 1.0, 1.0]), (35, [inf, 1.0, 1.0]), (36, [1.0] * 4), (37, [1e30, 0.0, 0.0]), (None, None)]
    schema = "vec_id long, embedding array<double>, id long, v string, cluster int, distance long"
    frame = lambda rows: spark.createDataFrame([(i, v, 1, "x", 2, 3) for i, v in rows], schema)
    got = cluster(frame(good + bad), 4, 3, 2, dims=3)
    assert sorted((repr(r[0]), *r[1:]) for r in map(tuple, got.collect())) == brute(good, 4, 3, 256)
    few = cluster(frame(good[:2]), 4, 3, 2, dims=3).collect()
    assert {r.cluster for r in few} == {0, 1} and {r.distance for r in few} == {0}
    for rows in ([], bad):
        none = cluster(frame(rows), 4, 3, 2, dims=3)
        assert none.count() == 0 and none.columns == got.columns
    same = cluster(frame([(k, [1.0, 1.0, 1.0]) for k in range(50)]), 4, 3, 2, dims=3).collect()
    assert {(r.cluster, r.distance, r.inertia) for r in same} == {(0, 0, 0)}
