"""Connected components of an edge table, and the greedy longest-first pass inside them."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..shared import stored
from .assign import first_wins

PER_TASK = 500_000


def _united(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Union-find over all edges of a task: (id, component) of its ids."""
    parent: dict = {}

    def root(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    kind = None
    for batch in batches:
        kind = batch.schema.field("a").type
        for a, b in zip(batch["a"].to_pylist(), batch["b"].to_pylist(), strict=True):
            a, b = root(a), root(b)
            if a != b:
                parent[max(a, b)] = min(a, b)
    if parent:
        yield pa.RecordBatch.from_pydict({"id": pa.array(list(parent), kind), "component": pa.array([root(x) for x in parent], kind)})


def components(edges: DataFrame, per_task: int = PER_TASK) -> DataFrame:
    """(id, component) of every id in edges(a, b): the smallest id that can be reached.

    Up to per_task edges one task unites them. Beyond, stars are contracted: in turn each id hands its larger neighbours to the smallest one, and each id with
    its smaller neighbours goes to the smallest of them, until nothing changes. These are joins and partial minima, and the number
    of rounds grows with the logarithm of the ids, whatever the length of chains. Nulls are left out.
    """
    kind = edges.schema["a"].dataType.simpleString()
    links = edges.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    links = stored(links, "links")
    if links.limit(per_task + 1).count() <= per_task:
        return links.coalesce(1).mapInArrow(_united, f"id {kind}, component {kind}")
    before = None
    while True:
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy(F.col("a").alias("v")).agg(F.min("b").alias("m")).select("v", F.least("v", "m").alias("m"))
        large = both.filter("b > a").join(least, F.col("a") == F.col("v")).select(F.col("m").alias("a"), "b").filter("a <> b").distinct()
        large = stored(large, "links")
        low = large.groupBy(F.col("b").alias("v")).agg(F.min("a").alias("m"))
        small = large.join(low, F.col("b") == F.col("v")).select(F.col("m").alias("x"), "a", "b")
        small = small.select(F.col("x").alias("a"), F.explode(F.array("a", "b")).alias("b")).filter("a <> b").distinct()
        links = stored(small, "links")
        now = links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    roots = links.groupBy(F.col("b").alias("id")).agg(F.min("a").alias("component"))
    return roots.unionByName(roots.select(F.col("component").alias("id"), "component").distinct())


def _sequential(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The longest-first pass over all components of a task; their edges (both ways) come with the lengths of their ends."""
    near: dict = {}
    kind = None
    for batch in batches:
        kind = batch.schema.field("a").type
        for a, b, weight, la, lb in zip(*(batch[c].to_pylist() for c in ("a", "b", "weight", "la", "lb")), strict=True):
            near.setdefault((-la, a), []).append((-weight, -lb, b))
    leads: set = set()
    order = sorted(near)
    for place in order:
        if not any(near_place < place and near_place in leads for near_place in ((length, b) for _, length, b in near[place])):
            leads.add(place)
    out = [(a, a if (length, a) in leads else min((w, n, b) for w, n, b in near[length, a] if (n, b) in leads)[2]) for length, a in order]
    if out:
        yield pa.RecordBatch.from_pydict({"id": pa.array([i for i, _ in out], kind), "leader": pa.array([x for _, x in out], kind)})


def greedy_clusters(vertices: DataFrame, edges: DataFrame, per_task: int = PER_TASK) -> DataFrame:
    """(id, leader): what a sequential longest-first pass over vertices(id, length) gives, edges(a, b, weight) both ways or one.

    The first vertex, longest and then by id, leads; each next one leads unless an earlier leader is its neighbour. A member takes the leader of the largest weight,
    the earliest on ties. Components are independent, so the pass runs over whole components, many to a task; components with more than
    per_task edges take rounds instead (in_rounds). Vertices with a null id or length take no part.
    """
    known = vertices.filter("id IS NOT NULL AND length IS NOT NULL").groupBy("id").agg(F.max("length").alias("length"))
    ends = [known.withColumnsRenamed({"id": x, "length": f"l{x}"}) for x in "ab"]
    both = edges.select("a", "b", "weight").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"), "weight")).filter("a <> b")
    near = stored(both.groupBy("a", "b").agg(F.max("weight").cast("double").alias("weight")).join(ends[0], "a").join(ends[1], "b"), "edges")
    parts = stored(components(near.filter("a < b"), per_task), "components")
    sizes = near.join(parts, F.col("a") == F.col("id")).groupBy("component").agg(F.count("*").alias("n"))
    total, largest = sizes.agg(F.sum("n"), F.max("n")).first()
    kind = vertices.schema["id"].dataType.simpleString()
    rows = near.join(parts, F.col("a") == F.col("id"))
    found = None
    if (largest or 0) > 2 * per_task:
        large = sizes.filter(F.col("n") > 2 * per_task).select("component")
        slow = rows.join(large, "component", "left_semi")
        found = in_rounds(slow.select(F.col("a").alias("id"), F.col("la").alias("length")).distinct(), slow.select("a", "b", "weight", "la", "lb"))
        rows = rows.join(large, "component", "left_anti")
    tasks = max(1, -(-(total or 0) // per_task))
    fast = rows.repartition(tasks, "component").select("a", "b", "weight", "la", "lb").mapInArrow(_sequential, f"id {kind}, leader {kind}")
    found = fast if found is None else found.unionByName(fast)
    alone = known.join(near.select(F.col("a").alias("id")), "id", "left_anti").select("id", F.col("id").alias("leader"))
    return alone.unionByName(found)


def in_rounds(vertices: DataFrame, near: DataFrame) -> DataFrame:
    """The same pass for components of any size, over near(a, b, weight, la, lb), both ways: each round makes leaders of all vertices without an undecided
    earlier neighbour, and decides their neighbours. As many rounds as the longest chain of decisions."""
    place = lambda x: F.struct((-F.col(f"l{x}")).alias("l"), F.col(x).alias("i"))
    near = stored(near.withColumns({"pa": place("a"), "pb": place("b")}), "near")
    live, open_, turns = near, vertices.select("id"), []
    while open_.limit(1).count():
        waits = live.filter("pb < pa").select(F.col("a").alias("id")).distinct()
        new = open_.join(waits, "id", "left_anti")
        covered = live.join(new.select(F.col("id").alias("b")), "b", "left_semi").select(F.col("a").alias("id")).distinct()
        turned = stored(new.withColumn("leads", F.lit(True)).unionByName(covered.withColumn("leads", F.lit(False))), "turned")
        open_ = stored(open_.join(turned, "id", "left_anti"), "open")
        live = stored(live.join(turned.select(F.col("id").alias("a")), "a", "left_anti").join(turned.select(F.col("id").alias("b")), "b", "left_anti"), "live")
        turns.append(turned)
    state = turns[0]
    for more in turns[1:]:
        state = state.unionByName(more)
    leaders = state.filter("leads").select("id")
    options = near.join(leaders.withColumnRenamed("id", "b"), "b", "left_semi").join(state.filter("not leads").select(F.col("id").alias("a")), "a", "left_semi")
    best = first_wins(options, ["a"], [F.desc("weight"), F.asc("pb")]).select(F.col("a").alias("id"), F.col("b").alias("leader"))
    return leaders.select("id", F.col("id").alias("leader")).unionByName(best)
