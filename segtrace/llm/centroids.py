"""k-means over integer vectors, each vector's nearest centroid found by Orchard's search.

Orchard's search. For every centroid the others are listed by their distance from it. A vector starts at some centroid
and walks that one's list; at a closer centroid it goes on in the list of that one, from its start; centroids it has met are marked and not
measured again. It stops where a list's next entry is strictly farther from the present centroid than twice the vector's own distance: by the
triangle inequality nothing from there on is nearer, and as the end is strict, all that are equally near have been met (of
these the smaller number wins). Distances are squared integers, so "twice" is four times and every comparison is exact. Vectors of a
batch walk side by side in numpy.

A round is one pass over the stored vectors. Tasks hold the centroids (k x dims numbers, a bound by parameters) and give count and sums
for each centroid; Spark adds these up, and k x dims sums come to the driver. Lost executors cost their tasks only.

Defined cases: rows with a null vector, another number of components, or a null, non-finite or too large component (2^26 and more in
absolute value after scaling, so that four times a squared distance fits 64 bits) take no part. Repeated rows and ties each count; equal ids are put in order by their
vectors, null ids come last. With fewer vectors than k there are as many centroids as vectors; an empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import own, saved

LARGEST = 1 << 26
_ROWS = 4096


def integer_vectors(df: DataFrame, id_col: str, vector_col: str, scale: int, dims: int | None = None, **more: str) -> DataFrame:
    """(id, v, more): rows whose vector has only finite components, and dims of them unless that is None; v: floor(scale * x)."""
    rows = own(df, id=id_col, raw=vector_col, **more)
    scaled = F.transform("raw", lambda x: F.floor(F.lit(float(scale)) * x.cast("double")))
    fit = F.forall("raw", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(F.lit(float(scale)) * x.cast("double")) < LARGEST))
    if dims is not None:
        fit = fit & (F.size("raw") == dims)
    return rows.filter(F.coalesce(fit, F.lit(False))).select("id", scaled.cast("array<int>").alias("v"), *more)


def matrix(column: pa.ListArray, dims: int) -> np.ndarray:
    """Vectors of equal length as rows."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims).astype(np.int64)


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances of all rows of a to all rows of b, exact."""
    return ((a[:, None, :] - b[None, :, :]) ** 2).sum(axis=2)


class Orchard:
    """Centroids with their neighbour lists."""

    def __init__(self, centroids: np.ndarray):
        self.centroids = centroids
        between = np.stack([((centroids - c) ** 2).sum(axis=1) for c in centroids])
        np.fill_diagonal(between, -1)  # each list begins with the centroid itself
        self.order = np.argsort(between, axis=1, kind="stable")[:, 1:]
        self.between = np.take_along_axis(between, self.order, axis=1)
        # Where to start: the nearest by the few components in which centroids differ most.
        self.coarse = np.argsort(-centroids.astype(float).var(axis=0), kind="stable")[:4]

    def nearest(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """(number of the nearest centroid, squared distance) of each row, and how many distances were measured."""
        n, k = len(vectors), len(self.centroids)
        now = squared(vectors[:, self.coarse], self.centroids[:, self.coarse]).argmin(axis=1) if n else np.zeros(0, np.int64)
        dist = ((vectors - self.centroids[now]) ** 2).sum(axis=1)
        met = np.zeros((n, k), bool)
        met[np.arange(n), now] = True
        at, live, measured = np.zeros(n, np.int64), np.arange(n if k > 1 else 0), n
        while len(live):
            here, place = now[live], at[live]
            live = live[self.between[here, place] <= 4 * dist[live]]
            other = self.order[now[live], at[live]]
            at[live] += 1
            fresh = ~met[live, other]
            row, other = live[fresh], other[fresh]
            met[row, other] = True
            measured += len(row)
            found = ((vectors[row] - self.centroids[other]) ** 2).sum(axis=1)
            nearer = (found < dist[row]) | ((found == dist[row]) & (other < now[row]))
            row, other = row[nearer], other[nearer]
            now[row], dist[row], at[row] = other, found[nearer], 0
            live = live[at[live] < k - 1]
        return now, dist, measured


def first_centroids(vectors: DataFrame, k: int, seed: int) -> np.ndarray:
    """The k vectors (id, v) with the smallest SHA-256 of `seed:id`, in its order."""
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256)
    rows = vectors.select(key.alias("key"), "v").orderBy(F.asc_nulls_last("key"), "v").limit(k).collect()
    return np.array([r.v for r in rows], np.int64)


def _sums(centroids: np.ndarray):
    search, dims = Orchard(centroids), centroids.shape[1]

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, total = np.zeros(len(centroids), np.int64), np.zeros(centroids.shape, np.int64)
        for batch in batches:
            for a in range(0, len(batch), _ROWS):
                rows = matrix(batch.column(0).slice(a, _ROWS), dims)
                which = search.nearest(rows)[0]
                order = np.argsort(which, kind="stable")
                here, first = np.unique(which[order], return_index=True)
                total[here] += np.add.reduceat(rows[order], first, axis=0)
                count += np.bincount(which, minlength=len(centroids))
        some = np.flatnonzero(count)
        place = np.tile(np.arange(dims, dtype=np.int32), len(some))
        columns = [np.repeat(some, dims).astype(np.int32), place, np.repeat(count[some], dims), total[some].ravel()]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["cluster", "place", "n", "total"])

    return add


def improve(vectors: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """Centroids after one round: floor of the mean of each one's vectors, componentwise; those without vectors stay."""
    sums = vectors.select("v").mapInArrow(_sums(centroids), "cluster int, place int, n long, total long")
    got = sums.groupBy("cluster", "place").agg(F.sum("n").alias("n"), F.sum("total").alias("total")).toArrow()
    out = centroids.copy()
    out[got["cluster"].to_numpy(), got["place"].to_numpy()] = got["total"].to_numpy() // got["n"].to_numpy()
    return out


def assign(vectors: DataFrame, centroids: np.ndarray) -> DataFrame:
    """(id, cluster, distance) of each vector."""
    search, dims = Orchard(centroids), centroids.shape[1]
    kind = vectors.schema["id"].dataType.simpleString()

    def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, len(batch), _ROWS):
                part = batch.slice(a, _ROWS)
                which, dist, _ = search.nearest(matrix(part.column(1), dims))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(which.astype(np.int32)), pa.array(dist)], names=["id", "cluster", "distance"])

    return vectors.select("id", "v").mapInArrow(nearest, f"id {kind}, cluster int, distance long")


def cluster(df: DataFrame, k: int, rounds: int, seed: int, scale: int = 256, dims: int = 64, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(id, cluster, distance, cluster_inertia, inertia, centroid_sha256) of each vector that takes part, after `rounds` rounds."""
    spark = df.sparkSession
    vectors = saved(integer_vectors(df, id_col, vector_col, scale, dims), "vectors")
    centroids = first_centroids(vectors, k, seed)
    if not len(centroids):
        empty = vectors.select(F.col("id").alias(id_col), F.lit(0).alias("cluster"), *[F.lit(0).cast("long").alias(c) for c in ("distance", "cluster_inertia", "inertia")], F.lit("").alias("centroid_sha256"))
        return empty.limit(0)
    for _ in range(rounds):
        centroids = improve(vectors, centroids)
    rows = saved(assign(vectors, centroids), "assigned")
    sums = {r.cluster: r.total for r in rows.groupBy("cluster").agg(F.sum("distance").alias("total")).collect()}
    named = [(c, sums.get(c, 0), sum(sums.values()), hashlib.sha256(",".join(map(str, centroid.tolist())).encode()).hexdigest()) for c, centroid in enumerate(centroids)]
    about = spark.createDataFrame(named, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")  # k rows
    return rows.join(F.broadcast(about), "cluster").select(F.col("id").alias(id_col), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
