"""Hard negatives by inner product: candidates in cover trees, anchors searched against them best first.

Trees. Rows are sorted by (label, nearest of some pivots, distance from it, id) in ranges, and cut into trees of at most `block` rows
with one label each, so a label or vector that many rows share fills many trees, and rows of a tree are near each other. Each task writes its trees
to one file in the shared folder and returns a directory row for each: label, root's centre and radius, smallest id, place in the file. Pivots only
decide which rows share a tree; any choice gives the same results.

Search. Anchors are dealt in the same order. A task holds up to `anchors_at_once` of them, reads the directory a piece at a time, and goes through the
trees by their roots' bounds: first those of the anchors' labels for the positives, then the others for negatives within the window of scores of
each positive. Trees whose bounds no anchor wants are not read. What a task keeps is a few best rows for each anchor, so nothing grows with the
candidates, and no partial results are shuffled.

Defined cases: rows with a null id or label, a null vector, or a component that is null, not finite or too large (2^26 and more in absolute value after
scaling) take no part. Shorter vectors count as filled up with zeros. Repeated rows each count, as candidates and as anchors; rows
with the anchor's id are not its positives. Ties go by id. A negative positive score has an empty window. Empty tables give no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .centroids import integer_vectors, matrix, squared
from .common import file_system, saved, shared_dir
from .covertree import Best, CoverTree, descend

_PLACED = "id long, label long, pivot int, far long, v array<int>"
_TREES = "label long, file string, start long, size long, points int, radius double, least long, centre array<int>"
_FOUND = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def _names(schema: str) -> list[str]:
    return [field.split()[0] for field in schema.split(", ")]


def _lists(rows: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.arange(len(rows) + 1, dtype=np.int32) * rows.shape[1]), pa.array(rows.astype(np.int32).ravel()))


def _pivots(vectors: DataFrame, many: int) -> np.ndarray:
    rows = vectors.orderBy(F.xxhash64("id"), "id", "v").select("v").limit(many).collect()
    return np.array([r.v for r in rows], np.int64)


def _placer(pivots: np.ndarray):
    dims = pivots.shape[1]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, len(batch), 500):
                part = batch.slice(a, 500)
                dist = squared(matrix(part.column(2), dims), pivots)
                near = dist.argmin(axis=1)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(near.astype(np.int32)), pa.array(dist[np.arange(len(near)), near]), part.column(2)], names=_names(_PLACED))

    return place


def _grouped(batches: Iterator[pa.RecordBatch], dims: int, most: int, key: str | None) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(label, ids, labels, vectors) of up to `most` neighbouring rows, of one label if key is given."""
    ids, labels, vectors = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros((0, dims), np.int64)

    def cut() -> int:
        end = min(len(ids), most)
        return end if key is None or not end else min(end, int(np.searchsorted(labels, labels[0], side="right")))

    for batch in batches:
        ids, labels = np.append(ids, batch.column("id").to_numpy()), np.append(labels, batch.column("label").to_numpy())
        vectors = np.concatenate([vectors, matrix(batch.column("v"), dims)])
        while len(ids) > (end := cut()):
            yield int(labels[0]), ids[:end], labels[:end], vectors[:end]
            ids, labels, vectors = ids[end:], labels[end:], vectors[end:]
    while len(ids):
        end = cut()
        yield int(labels[0]), ids[:end], labels[:end], vectors[:end]
        ids, labels, vectors = ids[end:], labels[end:], vectors[end:]


def _planter(folder: str, dims: int, block: int):
    def plant(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        context = TaskContext.get()
        store, base = file_system(folder)
        store.create_dir(base, recursive=True)
        name, at = f"trees-{context.partitionId():06d}-{context.taskAttemptId()}.bin", 0
        rows, centres = [], []
        with store.open_output_stream(f"{base}/{name}", compression=None) as out:
            for label, ids, _, vectors in _grouped(batches, dims, block, "label"):
                tree = CoverTree.build(ids, vectors)
                data = tree.dump()
                out.write(data)
                rows.append((label, name, at, len(data), len(ids), float(tree.radius[0]), int(tree.least[0])))
                centres.append(tree.centre[0])
                at += len(data)
        if rows:
            kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.float64(), pa.int64()]
            columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([*columns, _lists(np.stack(centres))], names=_names(_TREES))

    return plant


class Forest:
    """Trees in a folder, and their directory (Parquet) in another."""

    def __init__(self, folder: str, directory: str, dims: int):
        self.folder, self.directory, self.dims = folder, directory, dims

    def pieces(self, rows: int = 512) -> Iterator[dict[str, np.ndarray]]:
        """The directory, some trees at a time."""
        import pyarrow.parquet as pq
        from pyarrow import fs

        store, base = file_system(self.directory)
        for info in sorted(store.get_file_info(fs.FileSelector(base)), key=lambda i: i.path):
            if info.path.endswith(".parquet"):
                with store.open_input_file(info.path) as source:
                    for batch in pq.ParquetFile(source).iter_batches(rows):
                        if len(batch):
                            yield {c: batch.column(c).to_numpy(zero_copy_only=False) for c in _names(_TREES)[:-1]} | {"centre": matrix(batch.column("centre"), self.dims)}

    def search(self, best: Best, labels: np.ndarray, same: bool) -> None:
        """Best rows among the trees of each query's own label, or of all others."""
        store, base = file_system(self.folder)
        everyone = np.arange(len(labels))
        for piece in self.pieces():
            upper, lower = best.bounds(everyone, piece["centre"], piece["radius"])
            for t in np.argsort(-upper.max(axis=0), kind="stable"):
                rows = np.flatnonzero((labels == piece["label"][t]) == same)
                rows = rows[best.wanted(rows, upper[rows, t], lower[rows, t], piece["least"][t])]
                if len(rows):
                    with store.open_input_file(f"{base}/{piece['file'][t]}") as source:
                        tree = CoverTree.load(source.read_at(int(piece["size"][t]), int(piece["start"][t])))
                    descend(tree, best, rows)


def plant(placed: DataFrame, dims: int, block: int, tasks: int) -> Forest:
    """Cover trees over placed(_PLACED)."""
    folder = shared_dir(placed.sparkSession, "trees")
    order = ["label", "pivot", "far", "id"]
    dealt = placed.repartitionByRange(tasks, *order).sortWithinPartitions(*order)
    directory = saved(dealt.mapInArrow(_planter(folder, dims, block), _TREES), "directory")
    return Forest(folder, directory.inputFiles()[0].rpartition("/")[0], dims)


def _miner(forest: Forest, at_once: int, positives: int, negatives: int, low: int, high: int):
    far = np.iinfo(np.int64)

    def mine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, ids, labels, vectors in _grouped(batches, forest.dims, at_once, None):
            near = Best(vectors, ids, np.full((len(ids), 1), far.min), np.full((len(ids), 1), far.max), positives)
            forest.search(near, labels, same=True)
            score, found = near.scores[:, 0], near.ids[:, 0] != far.max
            # low * score <= 100 * other <= high * score, in whole numbers
            window = Best(vectors, ids, np.where(found, -(-(low * np.where(found, score, 0)) // 100), 1), np.where(found, high * np.where(found, score, 0) // 100, 0), negatives)
            forest.search(window, labels, same=False)
            a, p, r = np.nonzero(window.ids != far.max)
            columns = [ids[a], near.ids[a, 0, p], (r + 1).astype(np.int32), window.ids[a, p, r], score[a, p], window.scores[a, p, r]]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=_names(_FOUND))

    return mine


def mine_negatives(df: DataFrame, every: int = 100, positives: int = 5, negatives: int = 5, low: int = 80, high: int = 100, scale: int = 256, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", block: int = 4096, anchors_at_once: int = 512, pivots: int = 64) -> DataFrame:
    """(_FOUND) for each anchor (id divisible by `every`) and each of its best rows of the same label: the best rows of other labels whose
    score is from low to high hundredths of the positive's."""
    spark = df.sparkSession
    rows = integer_vectors(df, id_col, vector_col, scale, label=label_col).select(F.col("id").cast("long").alias("id"), F.col("label").cast("long").alias("label"), "v")
    rows = saved(rows.filter("id IS NOT NULL AND label IS NOT NULL"), "vectors")
    n, dims, anchors = rows.agg(F.count("*"), F.max(F.size("v")), F.count_if(F.col("id") % every == 0)).first()
    if not n:
        return spark.createDataFrame([], _FOUND)
    dims = max(dims, 1)
    even = rows.withColumn("v", F.concat("v", F.array_repeat(F.lit(0), F.lit(dims) - F.size("v"))))
    placed = saved(even.mapInArrow(_placer(_pivots(even, pivots)), _PLACED), "placed")
    usual = int(spark.conf.get("spark.sql.shuffle.partitions"))
    forest = plant(placed, dims, block, max(min(usual, -(-n // block)), -(-n // (16 * block))))
    tasks = max(min(usual, anchors), -(-anchors // anchors_at_once), 1)
    order = ["label", "pivot", "far", "id"]
    dealt = placed.filter(F.col("id") % every == 0).repartitionByRange(tasks, *order).sortWithinPartitions(*order)
    return dealt.select("id", "label", "v").mapInArrow(_miner(forest, anchors_at_once, positives, negatives, low, high), _FOUND)
