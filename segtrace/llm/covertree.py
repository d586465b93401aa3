"""A cover tree over vectors for searches by inner product, in numpy.

Norms. Each candidate x gets one component more, sqrt(M^2 - |x|^2) with M the largest norm of the tree, so all have norm M and the largest inner
product with a query (whose further component is 0) is the smallest distance. The tree is built in that space.

Levels. Points are taken farthest first: each next centre is the point farthest from all centres so far. The centres whose distance at
that time was above s / 2^l are level l (s: the first such distance). So levels are nested, centres of a level are more than s / 2^l apart, every
point is within s / 2^l of one, and a centre's parent is the nearest centre one level up. It ends when there is a centre for every `leaf`
points; the last level's nodes hold the points nearest to them. Of a node the covering radius is kept: the largest distance from its
centre to a point below it.

Bounds. For a node with centre p and radius r, and a query q, every point x below has |q.x - q.p| <= |q| r. Inner products are computed exactly (in
floating point only while all of them are below 2^52), and bounds get a margin for rounding.
"""

from __future__ import annotations

import heapq
import io

import numpy as np

LEAF = 32
_EXACT = 2.0**52


class CoverTree:
    """ids and vectors of the points (leaf by leaf, in each by id), and for each node: vector of its centre, radius, smallest id below, its
    children (first, many) or points (first, many), and whether it is a leaf. Node 0 is the root."""

    def __init__(self, **arrays: np.ndarray):
        self.__dict__.update(arrays)

    @classmethod
    def build(cls, ids: np.ndarray, vectors: np.ndarray, leaf: int = LEAF) -> CoverTree:
        order = np.argsort(ids, kind="stable")
        ids, vectors = ids[order], vectors[order]
        squares = (vectors.astype(float) ** 2).sum(axis=1)
        raised = np.column_stack([vectors, np.sqrt(np.maximum(squares.max() - squares, 0))])
        centres, taken, owner = _farthest_first(raised, -(-len(ids) // leaf))
        levels = _levels(raised, centres, taken)
        return cls(**_nodes(ids, vectors, raised, centres, owner, levels))

    def dump(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, **self.__dict__)
        return out.getvalue()

    @classmethod
    def load(cls, data: bytes) -> CoverTree:
        return cls(**np.load(io.BytesIO(data)))


def _farthest_first(points: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(the centres, the distance at which each was taken, the nearest centre's number of each point)."""
    first = int(((points - points.mean(axis=0)) ** 2).sum(axis=1).argmin())
    centres, taken = [first], [np.inf]
    far, owner = ((points - points[first]) ** 2).sum(axis=1), np.zeros(len(points), np.int64)
    while len(centres) < most and far.max() > 0:
        new = int(far.argmax())
        taken.append(float(np.sqrt(far[new])))
        dist = ((points - points[new]) ** 2).sum(axis=1)
        owner = np.where(dist < far, len(centres), owner)
        far = np.minimum(far, dist)
        centres.append(new)
    return np.array(centres), np.array(taken), owner


def _levels(points: np.ndarray, centres: np.ndarray, taken: np.ndarray) -> list[tuple[int, np.ndarray]]:
    """From the root down: (how many centres the level has, the number one level up that each of them is below)."""
    levels, size = [(1, np.zeros(1, np.int64))], 1
    scale = taken[1] if len(taken) > 1 else 0.0
    while size < len(centres):
        scale /= 2
        more = max(int((taken > scale).sum()), size)
        if more == size:
            continue
        upper, parent = points[centres[:size]], np.arange(more)
        for k in range(size, more):
            parent[k] = ((upper - points[centres[k]]) ** 2).sum(axis=1).argmin()
        levels.append((more, parent))
        size = more
    return levels


def _nodes(ids: np.ndarray, vectors: np.ndarray, points: np.ndarray, centres: np.ndarray, owner: np.ndarray, levels: list[tuple[int, np.ndarray]]) -> dict[str, np.ndarray]:
    above = [owner]  # of each point, the centre it is below; from the last level up
    for _, parent in levels[:0:-1]:
        above.append(parent[above[-1]])
    above.reverse()
    # A level's nodes stand in the order of their parents, so the children of a node are neighbours.
    place = np.zeros(1, np.int64)
    centre, radius, least, first, many, leaf = [], [], [], [], [], []
    start = 0
    for depth, (size, _) in enumerate(levels):
        under = above[depth]
        far = np.zeros(size)
        np.maximum.at(far, under, np.sqrt(((points - points[centres[under]]) ** 2).sum(axis=1)))
        smallest = np.full(size, np.iinfo(np.int64).max)
        np.minimum.at(smallest, under, ids)
        order = np.argsort(place, kind="stable")
        centre.append(centres[:size][order])
        radius.append(far[order])
        least.append(smallest[order])
        last = depth + 1 == len(levels)
        if last:
            counts = np.bincount(under, minlength=size)[order]
            first.append(np.cumsum(counts) - counts)
            rank = np.empty(size, np.int64)
            rank[order] = np.arange(size)
            points_order = np.argsort(rank[under], kind="stable")
        else:
            parent = levels[depth + 1][1]
            counts = np.bincount(parent, minlength=size)[order]
            first.append(start + size + np.cumsum(counts) - counts)
            rank = np.empty(size, np.int64)
            rank[order] = np.arange(size)
            place = rank[parent]
        many.append(counts)
        leaf.append(np.full(size, last))
        start += size
    joined = {"radius": radius, "least": least, "first": first, "many": many, "leaf": leaf}
    out = {k: np.concatenate(v) for k, v in joined.items()}
    small = np.int32 if np.abs(vectors).max(initial=0) < 1 << 31 else np.int64
    return out | {"centre": vectors[np.concatenate(centre)].astype(small), "ids": ids[points_order], "vectors": vectors[points_order].astype(small)}


class Best:
    """For each query and each of its windows of scores the best `k` points so far: larger scores first, smaller ids on ties.

    low, high: [queries, windows] of inclusive bounds; a window with low > high wants nothing.
    """

    def __init__(self, queries: np.ndarray, own: np.ndarray, low: np.ndarray, high: np.ndarray, k: int):
        self.queries, self.own, self.low, self.high, self.k = queries.astype(np.int64), own, low, high, k
        self.norm = np.sqrt((queries.astype(float) ** 2).sum(axis=1))
        self.scores = np.full((*low.shape, k), np.iinfo(np.int64).min)
        self.ids = np.full((*low.shape, k), np.iinfo(np.int64).max)
        self.products = 0

    def product(self, rows: np.ndarray, vectors: np.ndarray) -> np.ndarray:
        """Exact inner products of some queries with some vectors."""
        self.products += len(rows) * len(vectors)
        longest = np.sqrt((vectors.astype(float) ** 2).sum(axis=1).max(initial=0))
        if self.norm[rows].max(initial=0) * longest < _EXACT:
            return self.queries[rows].astype(float) @ vectors.astype(float).T
        return self.queries[rows] @ vectors.astype(np.int64).T

    def wanted(self, rows: np.ndarray, upper: np.ndarray, lower: np.ndarray, least: np.ndarray | int) -> np.ndarray:
        """Which of the queries still want points with scores of lower to upper and ids from `least` on."""
        worst, place = self.scores[rows, :, -1], self.ids[rows, :, -1]
        up, down, least = upper[:, None], lower[:, None], np.broadcast_to(least, len(rows))[:, None]
        beats = (up > worst) | ((up == worst) & (least <= place))
        return (beats & (up >= self.low[rows]) & (down <= self.high[rows])).any(axis=1)

    def bounds(self, rows: np.ndarray, centres: np.ndarray, radius: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(upper, lower) bounds, [rows, nodes], of the scores below nodes."""
        middle = self.product(rows, centres).astype(float)
        width = self.norm[rows][:, None] * radius
        width = width * (1 + 1e-9) + np.where(radius > 0, 1e-6 + 1e-12 * np.abs(middle), 0)
        width += np.where(np.abs(middle) < _EXACT, 0, 1e-12 * np.abs(middle))
        return middle + width, middle - width

    def add(self, rows: np.ndarray, ids: np.ndarray, vectors: np.ndarray) -> None:
        """Verify points, their ids rising: exact scores, put where they belong."""
        score = self.product(rows, vectors).astype(np.int64)
        for w in range(self.low.shape[1]):
            worst, place = self.scores[rows, w, -1][:, None], self.ids[rows, w, -1][:, None]
            fit = (score >= self.low[rows, w][:, None]) & (score <= self.high[rows, w][:, None]) & (ids != self.own[rows][:, None])
            fit &= (score > worst) | ((score == worst) & (ids < place))
            some = np.flatnonzero(fit.any(axis=1))
            if not len(some):
                continue
            at = rows[some]
            new = np.where(fit[some], score[some], np.iinfo(np.int64).min)
            scores = np.concatenate([self.scores[at, w], new], axis=1)
            names = np.concatenate([self.ids[at, w], np.where(fit[some], np.broadcast_to(ids, new.shape), np.iinfo(np.int64).max)], axis=1)
            order = np.argsort(names, axis=1, kind="stable")
            scores, names = np.take_along_axis(scores, order, 1), np.take_along_axis(names, order, 1)
            # The smallest number's negative isn't a number: turned bits order like negatives.
            order = np.argsort(~scores, axis=1, kind="stable")[:, : self.k]
            self.scores[at, w], self.ids[at, w] = np.take_along_axis(scores, order, 1), np.take_along_axis(names, order, 1)


def descend(tree: CoverTree, best: Best, rows: np.ndarray) -> None:
    """Best-first descent for some queries together: the node with the largest upper bound next, for those queries that still want it."""
    upper, lower = best.bounds(rows, tree.centre[:1], tree.radius[:1])
    heap = [(0.0, 0, rows, upper[:, 0], lower[:, 0])]
    while heap:
        _, node, rows, upper, lower = heapq.heappop(heap)
        keep = best.wanted(rows, upper, lower, tree.least[node])
        rows = rows[keep]
        if not len(rows):
            continue
        a, b = tree.first[node], tree.first[node] + tree.many[node]
        if tree.leaf[node]:
            best.add(rows, tree.ids[a:b], tree.vectors[a:b])
            continue
        upper, lower = best.bounds(rows, tree.centre[a:b], tree.radius[a:b])
        for k in range(a, b):
            up, down = upper[:, k - a], lower[:, k - a]
            keep = best.wanted(rows, up, down, tree.least[k])
            if keep.any():
                heapq.heappush(heap, (-float(up[keep].max()), k, rows[keep], up[keep], down[keep]))
