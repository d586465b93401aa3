"""Mixing sources to target weights by pivotal dependent rounding.

Every source gets a target in words; a document of a source whose target is r times its size is wanted
r times, so it is copied floor(r) times and once more with probability r - floor(r). Those probabilities
are rounded together: of two fractional documents of a source, mass is moved at random from one to the
other, keeping the source's expected words, until one is 0 or 1; the other goes on. Each document keeps
its probability, and the words taken differ from the target by less than one document.

The pairing is a reduction tree: buckets of a source (hash of id, text and the row's number among rows equal in all
that) are rounded in parallel and leave one fractional document each; these meet in fewer and fewer buckets until one
per source is left, which is rounded alone. So a source, an id or a text with a third of all rows is spread over buckets like any
other.

Random numbers come from hashes of (seed, the same, level), so reruns and retried tasks agree.

Defined cases: a null text has size 0; documents of size 0 are never taken; null is a source of its own;
repeated rows are rounded each for itself (they are counted, not collected); an empty table gives no row; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, own, saved

_EPS = 1e-12  # nearer to 0 or 1 than this counts as whole


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def cyclic_weights(sources: DataFrame, weights: tuple[float, ...]) -> DataFrame:
    """Weights dealt round to the sources by code point, null last. The window spans one row of two numbers per source."""
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    return sources.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (rank % len(weights) + 1).cast("int")))


def targets(sources: DataFrame, total_share: float, most: float) -> DataFrame:
    """(source, source_size, weight) plus target: total_share of all sizes dealt by weight, at most `most`
    times a source's size, the excess dealt again among the others until none is above.

    Each round is one aggregate over the sources (one row each); only sums reach the driver.
    """
    whole = sources.agg(F.sum("source_size")).first()[0] or 0
    wanted, level = min(total_share, most) * whole, 0.0
    limit = most * F.col("source_size")
    while True:
        full = (limit <= F.col("weight") * level) if level else F.lit(False)
        got = sources.agg(F.sum(F.when(full, limit).otherwise(0.0)), F.sum(F.when(full, 0.0).otherwise(F.col("weight"))), F.sum(F.when(full, 1).otherwise(0))).first()
        free = got[1] or 0.0
        new = (wanted - (got[0] or 0.0)) / free if free else level
        if new <= level or not free:
            break
        level = new
    return sources.withColumn("target", F.least(limit.cast("double"), F.col("weight") * F.lit(float(level))))


def _pivotal(rows: pd.DataFrame, seed: int, level: int, close: bool) -> pd.DataFrame:
    """Round the fractional rows of one bucket; the last one stays fractional unless `close`."""
    rows = rows.sort_values(["draw", "size", "p"], kind="stable").reset_index(drop=True)
    p, size = rows["p"].to_numpy(float).copy(), rows["size"].to_numpy(float)
    draw = np.random.default_rng([seed & 0x7FFFFFFF, level, int(rows["draw"].iloc[0]) & 0x7FFFFFFFFFFFFFFF]).random(len(rows) + 1)
    held = -1
    for k in range(len(rows)):
        if not _EPS < p[k] < 1 - _EPS:
            p[k] = round(p[k])
            continue
        if held < 0:
            held = k
            continue
        i, j, ratio = held, k, size[held] / size[k]
        up = min(1 - p[i], p[j] / ratio)  # i gains, j gives: the sum of size * p stays
        down = min(p[i], (1 - p[j]) / ratio)
        step = up if draw[k] < down / (up + down) else -down
        p[i] += step
        p[j] -= step * ratio
        held = -1
        for x in (i, j):
            if _EPS < p[x] < 1 - _EPS:
                held = x
            else:
                p[x] = round(p[x])
    if close and held >= 0:
        p[held] = float(draw[-1] < p[held])
    return rows.assign(p=p)


def _solver(seed: int, level: int, close: bool):
    def solve(rows: pd.DataFrame) -> pd.DataFrame:
        return _pivotal(rows, seed, level, close)

    return solve


def round_dependently(df: DataFrame, seed: int = 1, per_bucket: int = 10_000, fan_in: int = 256) -> DataFrame:
    """Rows (source, id, size > 0, p in [0, 1), ...) to the same rows with p 0 or 1. What a row is told apart by are its
    source, id, size and further columns.

    per_bucket: about as many rows are rounded by one task at the leaves; fan_in: buckets that meet above.
    """
    further = [c for c in df.columns if c not in ("source", "id", "size", "p")]
    rows = df.select("source", "id", "size", "p", *further, F.xxhash64(F.lit(seed), "id", *further).alias("draw"))
    largest = rows.groupBy("source").count().agg(F.max("count")).first()[0] or 0
    buckets = max(1, -(-largest // per_bucket))
    rows = rows.withColumn("bucket", F.pmod("draw", F.lit(buckets)).cast("long"))
    schema, done, level = rows.schema, None, 0
    whole = F.col("p").isin(0.0, 1.0)
    while True:
        close = buckets == 1

        rows = saved(rows.groupBy("source", "bucket").applyInPandas(_solver(seed, level, close), schema), "rounded")
        done = rows.filter(whole) if done is None else done.unionByName(rows.filter(whole))
        if close:
            return done.select("source", "id", "size", "p", *further)
        buckets, level = -(-buckets // fan_in), level + 1
        rows = rows.filter(~whole).withColumn("bucket", F.pmod("bucket", F.lit(buckets)))


def mix(df: DataFrame, weights: tuple[float, ...] = (3, 1, 2), total_share: float = 1.5, most: float = 2.0, seed: int = 1, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """Per row of df: id, source, size, source_size, target of the source, copies and taken words."""
    plan = _plan(df, weights, total_share, most, seed, id_col, text_col, source_col)
    return plan.select(F.col("id").alias(id_col), F.col("source").alias(source_col), "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))


def _plan(df: DataFrame, weights: tuple[float, ...], total_share: float, most: float, seed: int, id_col: str, text_col: str, source_col: str) -> DataFrame:
    """Per row of df: id, source, size, text (its hash), nth (its number among equal ones), source_size, target and copies."""
    rows = own(df, id=id_col, text=text_col, source=source_col).select("id", "source", word_count(F.col("text")).alias("size"), F.xxhash64("text").alias("text"))
    counts = rows.groupBy("id", "source", "size", "text").agg(F.count("*").alias("n"))
    docs = saved(counts.select("id", "source", "size", "text", F.explode(F.sequence(F.lit(1).cast("long"), "n")).alias("nth")), "sizes")
    sources = saved(docs.groupBy("source").agg(F.sum("size").alias("source_size")), "sources")
    goal = targets(cyclic_weights(sources, weights), total_share, most)
    rate = F.when(F.col("source_size") > 0, F.least(F.lit(float(most)), F.col("target") / F.col("source_size"))).otherwise(0.0)
    goal = goal.select(F.col("source").alias("of"), "source_size", "target", rate.alias("rate")).withColumn("whole", F.floor(F.col("rate") + _EPS))
    goal = saved(goal.withColumn("part", F.greatest(F.lit(0.0), F.col("rate") - F.col("whole"))), "targets")
    same = F.col("source").eqNullSafe(F.col("of"))
    wanted = docs.join(_sized(goal), same)
    open_ = (F.col("part") > _EPS) & (F.col("size") > 0)
    extra = round_dependently(wanted.filter(open_).select("source", "id", "size", F.col("part").alias("p"), "text", "nth"), seed)
    flat = wanted.filter(~open_).select("source", "id", "size", F.lit(0.0).alias("p"), "text", "nth")
    copies = F.when(F.col("size") > 0, F.col("whole") + F.col("p")).otherwise(0).cast("long")
    out = flat.unionByName(extra).join(_sized(goal), same).withColumn("copies", copies)
    return out.select("id", "source", "size", "text", "nth", "source_size", "target", "copies")


def mix_documents(df: DataFrame, weights: tuple[float, ...] = (3, 1, 2), total_share: float = 1.5, most: float = 2.0, seed: int = 1, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", copy_col: str = "copy") -> DataFrame:
    """df with each row as often as mix() takes it, numbered from 1 in a new last column, copy_col; the rest go.

    A column of df of that name is replaced. Rows that agree in id, source and text share the copies of such rows.
    """
    plan = _plan(df, weights, total_share, most, seed, id_col, text_col, source_col)
    # Rows with equal keys share their copies evenly: each gets the whole part, and a hash order deals out what is left.
    plan = plan.groupBy(F.col("id").alias("pi"), F.col("source").alias("ps"), F.col("size").alias("pz"), F.col("text").alias("ph")).agg(F.sum("copies").alias("copies"), F.count("*").alias("rows")).filter("copies > 0")
    df = df.drop(copy_col)
    key = [F.col(id_col).alias("i"), F.col(source_col).alias("s"), word_count(F.col(text_col)).alias("z"), F.xxhash64(text_col).alias("h")]
    rows = df.select(F.struct("*").alias("row"), *key)
    met = rows.join(plan, F.col("i").eqNullSafe(F.col("pi")) & F.col("s").eqNullSafe(F.col("ps")) & (F.col("z") == F.col("pz")) & (F.col("h") == F.col("ph")))
    single = met.filter("rows = 1").select("row", "copies")
    nth = F.row_number().over(Window.partitionBy("i", "s", "z", "h").orderBy(F.xxhash64("row")))
    several = met.filter("rows > 1").withColumn("copies", F.floor(F.col("copies") / F.col("rows")) + (nth <= F.col("copies") % F.col("rows")).cast("long")).filter("copies > 0").select("row", "copies")
    return single.unionByName(several).select("row", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("copy")).select("row.*", F.col("copy").alias(copy_col))


def _sized(goal: DataFrame, most_rows: int = 100_000) -> DataFrame:
    """Broadcast the sources' targets up to most_rows, else leave the join to a shuffle."""
    return F.broadcast(goal) if goal.limit(most_rows + 1).count() <= most_rows else goal
