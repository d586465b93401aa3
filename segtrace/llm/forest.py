"""MinHash near-dedup by an LSH forest.

A text's set is its distinct `width`-word shingles. Texts with equal sets are one class from the start.
For each class, `trees` orders of `depth` MinHash values each are sorted; in every order the next `near`
classes whose signatures share a prefix of at least `least` values are candidates. The neighbours in a
sorted order share the longest prefixes there are, so the depth adapts to the region: long where many
texts are alike, short where few are. A sketch that travels with the signature drops candidates that
can't be near the threshold; what is left is confirmed on full sets of shingles.

A window misses partners where a region is crowded. So regions (classes with a common prefix in some tree) that
still hold several components are gone through once more: each class outside a region's largest component meets the
others there that are in other components. Where more than `outside` classes stand outside, that would be too many
pairs; the classes of such regions are joined exactly instead, on the rarest shingles of each set (a prefix filter).
Every pair in different components that shares a region is thus looked at in one pass, so links found by it can't
make a second pass find more; regions that are one component cost nothing.

Orders are cut into ranges of (tree, signature, id), so a third of all rows with one prefix spread over
many tasks; the rows next to a cut are compared in a second small join. Each text is first confirmed with
its likeliest partner; the other candidates are confirmed only where that has not already put both in one
component, which spares all pairs within a group and loses no link between components.

Components are found by rounds of local and star contraction, each written to the shared folder.

Defined cases: null or empty texts have empty sets and stay alone; a null id stays alone, is kept and has
no component; rows that repeat an id are one vertex; other columns are ignored. Ids are integers.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import own, saved
from .urls import build_filter, probed
from .words import mix, word_codes

_U = np.uint64


@dataclass(frozen=True)
class Forest:
    width: int = 5
    trees: int = 16
    depth: int = 8
    least: int = 3
    near: int = 4
    sketch: int = 24  # values of the next trees, a byte each
    sketch_least: int = 11
    outside: int = 16
    check: int = 64  # values compared before two classes of a crowded region become candidates
    slack: float = 0.175  # their shared fraction may lie so far below the threshold (3.5 standard deviations)
    seed: int = 7


def _shingle_hashes(column: pa.Array, width: int) -> list[np.ndarray]:
    """Distinct 64-bit shingle hashes of each text, rising."""
    counts, codes, named = word_codes(column)
    ids = named[codes] if len(codes) else np.zeros(0, _U)
    run = np.zeros(max(0, len(ids) - width + 1), _U)
    for k in range(width):
        run = run * _U(0x9E3779B97F4A7C15) + ids[k : k + len(run)]
    run = mix(run)
    out, at = [], 0
    for n in counts.tolist():
        if n >= width:
            out.append(np.unique(run[at : at + n - width + 1]))
        elif n:
            h = np.array([n], _U)
            for x in ids[at : at + n]:
                h = h * _U(0x9E3779B97F4A7C15) + x
            out.append(mix(h))
        else:
            out.append(np.zeros(0, _U))
        at += n
    return out


def signatures(docs: DataFrame, forest: Forest) -> DataFrame:
    """docs(id, text) to (id, n, k1, k2, sig): size and 128-bit key of each set, and trees * depth MinHash values of 16 bits."""
    total = forest.trees * forest.depth

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rng = np.random.default_rng(forest.seed)
        a = rng.integers(0, 1 << 63, total, dtype=np.uint64) * _U(2) + _U(1)
        b = rng.integers(0, 1 << 63, total, dtype=np.uint64)
        with np.errstate(over="ignore"):
            for whole in batches:
                for batch in (whole.slice(k, 512) for k in range(0, max(1, len(whole)), 512)):
                    sets = _shingle_hashes(batch.column(1), forest.width)
                    sizes = np.array([len(s) for s in sets], np.int64)
                    full = np.flatnonzero(sizes)
                    sig = np.zeros((len(sets), total), ">u2")
                    k1, k2 = np.zeros(len(sets), _U), np.zeros(len(sets), _U)
                    step = 64  # documents at a time: their hashes stay in the cache
                    for at in range(0, len(full), step):
                        some = full[at : at + step]
                        joined = np.concatenate([sets[i] for i in some])
                        starts = np.append(0, np.cumsum(sizes[some])[:-1])
                        k1[some] = np.add.reduceat(mix(joined), starts)
                        k2[some] = np.add.reduceat(mix(joined + _U(0x51)), starts)
                        for h in range(total):
                            low = np.minimum.reduceat(joined * a[h] + b[h], starts)
                            sig[some, h] = (mix(low) >> _U(48)).astype(np.uint16)
                    bits = [sig[i].tobytes() if sizes[i] else None for i in range(len(sets))]
                    yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes), pa.array(k1.view(np.int64)), pa.array(k2.view(np.int64)), pa.array(bits, pa.binary())], names=["id", "n", "k1", "k2", "sig"])

    return docs.mapInArrow(sign, "id long, n long, k1 long, k2 long, sig binary")


def _tree_rows(classes: DataFrame, f: Forest) -> DataFrame:
    """classes(id, sig) to a row for each tree: (tree, key, sketch, id)."""

    def grow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.binary()
        for batch in batches:
            if not len(batch):
                continue
            sig = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint8).reshape(len(batch), f.trees, f.depth, 2)
            low = sig[..., 1]
            for t in range(f.trees):
                others = np.concatenate([low[:, (t + 1 + k) % f.trees] for k in range(-(-f.sketch // f.depth))], axis=1)[:, : f.sketch]
                keys, marks = sig[:, t].reshape(len(batch), -1), np.ascontiguousarray(others)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(batch), t, np.int32)), pa.array([x.tobytes() for x in keys], kind), pa.array([x.tobytes() for x in marks], kind), batch.column(0)], names=["tree", "key", "sketch", "id"]
                )

    return classes.select("id", "sig").mapInArrow(grow, "tree int, key binary, sketch binary, id long")


def candidates(classes: DataFrame, f: Forest) -> DataFrame:
    """classes(id, sig) to pairs (a < b, score): neighbours in some order; score adds up how alike they looked."""
    tasks = int(classes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = _tree_rows(classes, f).repartitionByRange(tasks, "tree", "key", "id").sortWithinPartitions("tree", "key", "id")

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        names = ["a", "b", "score", "part", "rank", "tree", "key", "sketch"]
        kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.binary()]
        tail, first = None, True

        def edge(table: pa.Table, side: int) -> pa.RecordBatch:
            """Rows next to a cut: this partition's last ones wait at cut `part`, its first ones at `part - 1`."""
            n = len(table)
            rank = np.arange(n - 1, -1, -1) if side else np.arange(n)
            cols = [table["id"], None, None, np.full(n, part if side else part - 1), rank * 2 + side, table["tree"], table["key"], table["sketch"]]
            return pa.RecordBatch.from_arrays([pa.nulls(n, t) if c is None else pa.concat_arrays(c.chunks) if isinstance(c, pa.ChunkedArray) else pa.array(c).cast(t) for c, t in zip(cols, kinds, strict=True)], names=names)

        for batch in batches:
            if not len(batch):
                continue
            new = pa.Table.from_batches([batch])
            table = new if tail is None else pa.concat_tables([tail, new])
            if first:
                yield edge(table.slice(0, f.near), 0)
                first = False
            n, fresh = len(table), len(table) - len(batch)
            ids, trees = table["id"].to_numpy(), table["tree"].to_numpy()
            keys = np.frombuffer(b"".join(table["key"].to_pylist()), np.uint16).reshape(n, f.depth)
            marks = np.frombuffer(b"".join(table["sketch"].to_pylist()), np.uint8).reshape(n, f.sketch)
            for s in range(1, f.near + 1):
                lo = max(0, fresh - s)  # pairs whose later row is new
                if n - s <= lo:
                    continue
                x, y = slice(lo, n - s), slice(lo + s, n)
                hit = np.flatnonzero((trees[x] == trees[y]) & (keys[x, : f.least] == keys[y, : f.least]).all(axis=1))
                alike = (marks[x][hit] == marks[y][hit]).sum(axis=1)
                hit, alike = hit[alike >= f.sketch_least], alike[alike >= f.sketch_least]
                u, v = ids[x][hit], ids[y][hit]
                m = len(hit)
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(u, v)), pa.array(np.maximum(u, v)), pa.array(alike.astype(np.int32)), *[pa.nulls(m, t) for t in kinds[3:]]], names=names)
            tail = table.slice(max(0, n - f.near))
        if tail is not None:
            yield edge(tail, 1)

    found = saved(ordered.mapInArrow(match, "a long, b long, score int, part int, rank int, tree int, key binary, sketch binary"), "neighbours")
    waiting = found.filter(F.col("part").isNotNull())
    side = lambda odd, **names: waiting.filter(F.col("rank") % 2 == odd).select("part", "tree", F.substring("key", 1, 2 * f.least).alias("prefix"), F.col("a").alias(names["id"]), F.floor(F.col("rank") / 2).alias(names["rank"]))
    across = side(1, id="x", rank="before").join(side(0, id="y", rank="after"), ["part", "tree", "prefix"]).filter(F.col("before") + F.col("after") < f.near)
    across = across.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"), F.lit(f.sketch_least).alias("score"))
    pairs = found.filter(F.col("part").isNull()).select("a", "b", "score").unionByName(across).filter(F.col("a") < F.col("b"))
    return pairs.groupBy("a", "b").agg(F.sum("score").alias("score"))


def _sized(df: DataFrame, rows: int, per_task: int = 50_000) -> DataFrame:
    """df, whose last shuffle's partitions are read by as many tasks as about that many rows are worth."""
    most = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.coalesce(max(1, -(-rows // per_task))) if rows < per_task * most else df


def _across_components(classes: DataFrame, f: Forest, percent: int) -> tuple[DataFrame, DataFrame]:
    """classes(id, sig, component) to pairs (a < b) in different components that share a region of some tree, and to the
    classes (id, component) of regions with more than `outside` classes outside the largest component, left to _exact_pairs."""
    width = 2 * f.depth
    turned = F.substring("sig", F.col("tree") * width + 1, F.lit(2 * f.least))
    classes = saved(classes, "placed")
    n_classes = classes.count()
    rows = classes.withColumn("tree", F.explode(F.sequence(F.lit(0), F.lit(f.trees - 1)))).select("id", "sig", "component", "tree")
    placed = rows.withColumn("region", F.xxhash64("tree", turned)).select("region", "id", "component", "tree")
    parts = placed.groupBy("region", "component").count()
    sizes = parts.groupBy("region").agg(F.sum("count").alias("n"), F.max("count").alias("most"), F.max_by("component", F.struct("count", "component")).alias("largest"))
    sizes = sizes.filter("n > most").select(F.col("region").alias("at"), (F.col("n") - F.col("most")).alias("others"), "largest")
    live = saved(placed.join(sizes, F.col("region") == F.col("at")).drop("at"), "crowded")
    # Signatures stay behind until it is known which few rows are in question.
    ready = live.filter(F.col("others") <= f.outside).join(classes.select("id", "sig"), "id")
    ready = saved(_sized(ready, n_classes * f.trees), "ready")
    sketch = lambda name: F.substring(F.concat("sig", "sig"), (F.col("tree") + 1) * width + 1, F.lit(2 * f.check)).alias(name)
    few = ready.filter(F.col("component") != F.col("largest")).select("region", F.col("id").alias("x"), F.col("component").alias("cx"), sketch("sx"))
    all_ = ready.select("region", F.col("id").alias("y"), F.col("component").alias("cy"), sketch("sy"), (F.col("component") != F.col("largest")).alias("both"))
    met = few.join(all_, "region").filter((F.col("cx") != F.col("cy")) & (~F.col("both") | (F.col("x") < F.col("y")))).select("x", "y", "sx", "sy")
    pairs = _sized(met, ready.count()).mapInArrow(_alike(f.check * (percent / 100 - f.slack)), "a long, b long")
    return pairs.distinct(), saved(live.filter(F.col("others") > f.outside).select("id", "component").distinct(), "over")


def _exact_pairs(crowd: DataFrame, texts: DataFrame, percent: int, width: int) -> DataFrame:
    """All pairs (a < b) of crowd(id, component) in different components whose sets can be near enough.

    With its shingles ordered by how few sets have them, a set of n shares one of its first n - ceil(n * percent / 100) + 1
    with any set that near. Sets that meet so are left out only where sizes or positions rule them out. Shingles
    that one set alone has come first and meet nobody, so they are counted but not kept.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opener = zstandard.ZstdDecompressor()
        with np.errstate(over="ignore"):
            for whole in batches:
                for batch in (whole.slice(k, 64) for k in range(0, len(whole), 64)):
                    words = pa.array([opener.decompress(x).decode() for x in batch.column(1).to_pylist()], pa.string())
                    sets = _shingle_hashes(words, width)
                    sizes = np.array([len(x) for x in sets], np.int64)
                    keys = np.array([mix(x).sum(dtype=_U) for x in sets], _U)  # an id may have several texts
                    cols = [np.repeat(x, sizes) for x in (batch.column(0).to_numpy(), keys.view(np.int64), sizes)]
                    yield pa.RecordBatch.from_arrays([*map(pa.array, cols), pa.array(np.concatenate(sets).view(np.int64))], names=["id", "key", "n", "h"])

    some = texts.join(crowd.select("id"), "id", "left_semi").select("id", "packed")
    sets = saved(some.mapInArrow(cut, "id long, key long, n long, h long"), "sets")
    counts = sets.groupBy("h").agg(F.count("*").alias("df")).filter("df > 1").withColumnRenamed("h", "of")
    held = sets.join(counts, F.col("h") == F.col("of")).groupBy("id", "key", "n").agg(F.sort_array(F.collect_set(F.struct("df", "h"))).alias("held"))
    alone = F.col("n") - F.size("held")
    first = F.greatest(F.lit(0), F.col("n") - F.floor((F.col("n") * percent + 99) / 100) + 1 - alone).cast("int")
    marks = held.select("id", "n", alone.alias("alone"), F.posexplode(F.slice("held", F.lit(1), first)).alias("k", "mark"))
    marks = marks.select("id", "n", (F.col("n") - F.col("alone") - F.col("k")).alias("rest"), F.col("mark.h").alias("h")).join(crowd, "id")
    marks = saved(marks, "marks")
    parts = marks.groupBy("h", "component").count()
    sizes = parts.groupBy("h").agg(F.sum("count").alias("total"), F.max("count").alias("most"), F.max_by("component", F.struct("count", "component")).alias("largest"))
    live = marks.join(sizes.filter("total > most").select(F.col("h").alias("at"), "largest"), F.col("h") == F.col("at")).withColumn("both", F.col("component") != F.col("largest"))
    live = saved(live.drop("at", "largest"), "marks")
    x = live.filter("both").select("h", F.col("id").alias("x"), F.col("component").alias("cx"), F.col("n").alias("nx"), F.col("rest").alias("rx"))
    y = live.select("h", F.col("id").alias("y"), F.col("component").alias("cy"), F.col("n").alias("ny"), F.col("rest").alias("ry"), "both")
    near = (F.col("cx") != F.col("cy")) & (~F.col("both") | (F.col("x") < F.col("y")))
    near &= (F.least("nx", "ny") * 100 >= F.greatest("nx", "ny") * percent) & (F.least("rx", "ry") * (100 + percent) >= (F.col("nx") + F.col("ny")) * percent)
    return x.join(y, "h").filter(near).select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()


def _alike(least: float):
    def filter_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            x, y = (np.frombuffer(b"".join(batch.column(k).to_pylist()), np.uint16).reshape(len(batch), -1) for k in (2, 3))
            hit = (x == y).sum(axis=1) >= least
            u, v = batch.column(0).to_numpy()[hit], batch.column(1).to_numpy()[hit]
            yield pa.RecordBatch.from_arrays([pa.array(np.minimum(u, v)), pa.array(np.maximum(u, v))], names=["a", "b"])

    return filter_pairs


def _packed_texts(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """(id, packed) of the documents named in ids(id): a Bloom filter of the ids keeps other texts from being shuffled."""
    n = ids.count()
    bloom, blocks = build_filter(ids.select(F.col("id").alias("key")), n)
    some = docs.filter(F.col("id").isNotNull() & F.col("text").isNotNull()).select("id", "text")
    some = probed(some, F.col("id"), saved(bloom, "bloom"), blocks, "named").filter("named").select("id", "text")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            packed = [packer.compress(x) for x in batch.column(1).cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(packed, pa.binary())], names=["id", "packed"])

    return saved(some.mapInArrow(pack, "id long, packed binary"), "texts")


def _ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("a").alias("id")).unionByName(pairs.select(F.col("b").alias("id"))).distinct()


def confirmed(pairs: DataFrame, texts: DataFrame, percent: int, width: int) -> DataFrame:
    """pairs(a, b) whose full sets of shingles have 100 * intersection >= percent * union."""
    left = texts.select(F.col("id").alias("a"), F.col("packed").alias("pa"))
    right = texts.select(F.col("id").alias("b"), F.col("packed").alias("pb"))
    both = pairs.select("a", "b").join(left, "a").join(right, "b").select("a", "b", "pa", "pb")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opener = zstandard.ZstdDecompressor()

        @lru_cache(maxsize=8)
        def shingles(packed: bytes) -> frozenset:
            words = opener.decompress(packed).lower().split()
            if len(words) < width:
                return frozenset([tuple(words)] if words else [])
            return frozenset(zip(*(words[k:] for k in range(width)), strict=False))

        for batch in batches:
            good = []
            for pa_, pb_ in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                x, y = shingles(pa_), shingles(pb_)
                common = 0 if 100 * min(len(x), len(y)) < percent * max(len(x), len(y)) else len(x & y)
                good.append(bool(x) and 100 * common >= percent * (len(x) + len(y) - common))
            yield batch.select([0, 1]).filter(pa.array(good, pa.bool_()))

    return both.mapInArrow(compare, "a long, b long")


def _forests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The edges (u, v) of one task to an edge from each vertex to the smallest one it reaches over them."""
    parent: dict[int, int] = {}

    def find(x: int) -> int:
        root = x
        while (up := parent.setdefault(root, root)) != root:
            root = up
        while parent[x] != root:
            parent[x], x = root, parent[x]
        return root

    for batch in batches:
        for u, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            u, v = find(u), find(v)
            if u != v:
                parent[max(u, v)] = min(u, v)
    pairs = [(x, root) for x in parent if (root := find(x)) != x]
    yield pa.RecordBatch.from_arrays([pa.array([p[k] for p in pairs], pa.int64()) for k in (0, 1)], names=["u", "v"])


def components(edges: DataFrame, per_task: int = 200_000) -> DataFrame:
    """edges(a, b) to (id, root): root is the smallest id reachable. Vertices without edges are not listed.

    In each round, tasks of about per_task edges contract what they hold to stars; when that takes one task, all is
    done. Else two star contractions follow: each vertex hands its larger neighbours, then its smaller ones, to the
    smallest of them. The number of rounds grows with the logarithm of the longest chain.
    """
    edges = saved(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u > v").distinct(), "edges")
    mark = None
    while True:
        tasks = -(-edges.count() // per_task)
        held = edges.coalesce(1) if tasks <= 1 else edges.repartition(tasks)
        edges = saved(held.mapInArrow(_forests, "u long, v long"), "edges")
        if tasks <= 1:
            return edges.select(F.col("u").alias("id"), F.col("v").alias("root"))
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        lowest = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.filter("v > u").join(lowest, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u > v").distinct()
        lowest = large.groupBy(F.col("u").alias("w")).agg(F.min("v").alias("m"))
        small = large.join(lowest, F.col("u") == F.col("w"))
        small = small.select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v")).filter("u > v").distinct()
        edges = saved(small, "edges")
        now = tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == mark:
            return edges.select(F.col("u").alias("id"), F.col("v").alias("root"))
        mark = now


def near_duplicates(docs: DataFrame, percent: int = 80, forest: Forest = Forest(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of docs: id, n_shingles, component_id (the smallest id reachable over links) and kept (it is that id)."""
    rows = own(docs, id=id_col, text=text_col).withColumn("id", F.col("id").cast("long"))
    signed = saved(signatures(rows, forest), "signatures")
    real = signed.filter(F.col("id").isNotNull() & (F.col("n") > 0))
    classes = saved(real.groupBy("k1", "k2").agg(F.min("id").alias("id"), F.first("sig").alias("sig")), "classes")
    # An id that repeats with other texts ties its classes together.
    several = real.groupBy("id").agg((F.min("k1") != F.max("k1")).alias("several")).filter("several").select("id")
    tied = real.join(several, "id").select(F.col("id").alias("a"), "k1", "k2").join(classes.select("k1", "k2", F.col("id").alias("b")), ["k1", "k2"]).select("a", "b")
    pairs = saved(candidates(classes, forest), "candidates")
    texts = _packed_texts(rows, _ends(pairs))
    twice = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"), "score"))
    best = twice.groupBy("a").agg(F.max_by("b", F.struct("score", -F.col("b"))).alias("b")).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    links = saved(confirmed(best, texts, percent, forest.width).unionByName(tied), "links")
    roots = components(links)
    root = lambda name: roots.select(F.col("id").alias(f"{name}_id"), F.col("root").alias(f"{name}_root"))
    rest = pairs.join(best.select("a", "b"), ["a", "b"], "left_anti")
    rest = rest.join(root("a"), F.col("a") == F.col("a_id"), "left").join(root("b"), F.col("b") == F.col("b_id"), "left")
    rest = rest.filter(F.coalesce("a_root", "a") != F.coalesce("b_root", "b")).select("a", "b")
    links = saved(links.unionByName(confirmed(rest, texts, percent, forest.width)), "links")
    roots = components(links)
    placed = classes.select("id", "sig").join(roots.withColumnRenamed("id", "of"), F.col("id") == F.col("of"), "left").select("id", "sig", F.coalesce("root", "id").alias("component"))
    more, crowd = _across_components(placed, forest, percent)
    known = pairs.select("a", "b")
    more = saved(more.join(known, ["a", "b"], "left_anti"), "candidates")
    if more.limit(1).count():
        links = saved(links.unionByName(confirmed(more, _packed_texts(rows, _ends(more)), percent, forest.width)), "links")
        roots = components(links)
    if crowd.limit(1).count():
        texts = _packed_texts(rows, crowd.select("id").distinct())
        now = crowd.select("id").join(roots.withColumnRenamed("id", "of"), F.col("id") == F.col("of"), "left").select("id", F.coalesce("root", "id").alias("component")).distinct()
        more = saved(_exact_pairs(saved(now, "over"), texts, percent, forest.width).join(known.unionByName(more), ["a", "b"], "left_anti"), "candidates")
        if more.limit(1).count():
            links = saved(links.unionByName(confirmed(more, texts, percent, forest.width)), "links")
            roots = components(links)
    heads = classes.select("k1", "k2", F.col("id").alias("head")).join(roots, F.col("head") == F.col("id"), "left").select("k1", "k2", F.coalesce("root", "head").alias("component"))
    out = signed.join(heads.withColumnsRenamed({"k1": "c1", "k2": "c2"}), (F.col("k1") == F.col("c1")) & (F.col("k2") == F.col("c2")) & (F.col("n") > 0), "left")
    component = F.when(F.col("id").isNotNull(), F.coalesce("component", "id"))
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), component.alias("component_id"), F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"))


def deduplicate(docs: DataFrame, percent: int = 80, forest: Forest = Forest(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with one document of each component: that of the smallest id; null ids stay."""
    found = near_duplicates(docs, percent, forest, id_col, text_col)
    gone = found.filter(~F.col("kept")).select(F.col(id_col).alias("gone_id")).distinct()
    return docs.join(gone, docs[id_col] == gone["gone_id"], "left_anti")
