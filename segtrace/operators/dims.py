"""Dimensions: trees to geography and taxonomy tables, synonyms, roll-ups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.domain import AMERICAS, LENGTHS, MUTATIONS, RANKS, REGION_SPELLING, SEGMENTS
from ..functions.text import mutation_label, norm_key
from ..shared import stored


def segment_dim(spark: SparkSession, lengths: dict[str, tuple[int, int]] = LENGTHS) -> DataFrame:
    """(num, name, min_len, max_len), one row per segment."""
    return spark.createDataFrame([(k, s, *lengths[s]) for k, s in enumerate(SEGMENTS, 1)], "num int, name string, min_len int, max_len int")


def mutation_dim(spark: SparkSession, effects: DataFrame | None = None) -> DataFrame:
    """(segment, mutation, label, effect) of the mutations of interest; effects(segment, mutation, effect) is optional."""
    rows = spark.createDataFrame([(s, m) for s, muts in MUTATIONS.items() for m in muts], "segment string, mutation string")
    rows = rows.withColumn("label", mutation_label(F.col("segment"), F.col("mutation")))
    return rows.join(effects, ["segment", "mutation"], "left") if effects is not None else rows.withColumn("effect", F.lit(None).cast("string"))


def walk_tree(tree: DataFrame, max_depth: int = 40) -> DataFrame:
    """(name, rank, depth, lineage array<struct<name, rank>>) of every node; tree has one variant column, name to {rank, children}.

    One recursive query: each step opens the children of the nodes found before.
    """
    rows = tree.select(F.col(tree.columns[0]).alias("tree"))
    return tree.sparkSession.sql(
        f"""
        WITH RECURSIVE walk(name, rank, depth, lineage, children) MAX RECURSION LEVEL {max_depth} AS (
          SELECT e.key, variant_get(e.value, '$.rank', 'string'), 1, array(named_struct('name', e.key, 'rank', variant_get(e.value, '$.rank', 'string'))),
                 variant_get(e.value, '$.children', 'variant')
          FROM {{tree}}, LATERAL variant_explode(tree) AS e
          UNION ALL
          SELECT e.key, variant_get(e.value, '$.rank', 'string'), depth + 1,
                 array_append(lineage, named_struct('name', e.key, 'rank', variant_get(e.value, '$.rank', 'string'))), variant_get(e.value, '$.children', 'variant')
          FROM walk, LATERAL variant_explode(children) AS e)
        SELECT name, rank, depth, lineage FROM walk""",
        tree=rows,
    )


def walk_edges(nodes: DataFrame, id_col: str = "id", parent_col: str = "parent", most_rounds: int = 40) -> DataFrame:
    """(name, rank, depth, lineage) of every node of nodes(id, parent, name, rank), the rows that walk_tree has, for trees of any size.

    Pointer doubling: each node keeps the part of its lineage that it has and the node above that part; a round puts the part of that node in front, so
    parts double and a tree of depth d takes log2(d) + 1 joins. Nodes whose lineage is whole take no part in later rounds. A null parent, one that the table lacks, or the node itself
    as parent makes a root; a repeated id counts once (its smallest row), a null id not at all. ValueError if parents form a circle.
    """
    rows = nodes.filter(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("id")).agg(F.min(F.struct(F.col(parent_col).alias("parent"), "name", "rank")).alias("x"))
    rows = rows.select("id", F.nullif("x.parent", "id").alias("parent"), "x.name", "x.rank")
    there = rows.select(F.col("id").alias("known"))
    part = F.array(F.struct("name", "rank"))
    open_ = stored(rows.join(there, F.col("parent") == F.col("known"), "left").select("id", F.col("known").alias("up"), part.alias("lineage")), "tree")
    parts = []
    for _ in range(most_rounds):
        parts.append(open_.filter("up IS NULL"))
        left = open_.filter("up IS NOT NULL")
        if not left.limit(1).count():
            break
        # What the node above has by now: whole, of an earlier round, or still open.
        above = left.select(F.col("id").alias("a"), F.col("up").alias("next"), F.col("lineage").alias("front"))
        for done in parts:
            above = above.unionByName(done.select(F.col("id").alias("a"), F.col("up").alias("next"), F.col("lineage").alias("front")))
        open_ = stored(left.join(above, F.col("up") == F.col("a")).select("id", F.col("next").alias("up"), F.concat("front", "lineage").alias("lineage")), "tree")
    else:
        raise ValueError("parents form a circle, or the tree is deeper than 2^most_rounds")
    whole = parts[0]
    for more in parts[1:]:
        whole = whole.unionByName(more)
    last = F.element_at("lineage", -1)
    return whole.select(last["name"].alias("name"), last["rank"].alias("rank"), F.size("lineage").alias("depth"), "lineage")


def geo_dim(nodes: DataFrame, leaf_rank: str = "country") -> DataFrame:
    """(country, region, continent): a country's parent and root; the Americas are split by region."""
    region = F.coalesce(F.try_element_at("lineage", F.lit(-2))["name"], F.lit("Unknown"))
    for old, new in REGION_SPELLING.items():
        region = F.when(region == old, F.lit(new)).otherwise(region)
    rows = nodes.filter(F.lower(F.trim("rank")) == leaf_rank).select(F.col("name").alias("country"), region.alias("region"), F.get("lineage", F.lit(0))["name"].alias("root"))
    continent = F.col("root")
    for name, part in AMERICAS.items():
        continent = F.when((F.col("root") == "Americas") & (F.col("region") == name), F.lit(part)).otherwise(continent)
    return rows.select("country", "region", continent.alias("continent"))


def taxa_dim(nodes: DataFrame) -> DataFrame:
    """(name, rank, species ... class): the name at each rank of the lineage, null if missing.

    Subfamily falls back to family, division to order, then to class.
    """

    def named(rank: str) -> Column:
        return F.get(F.filter("lineage", lambda x: F.lower(F.trim(x["rank"])) == rank), F.lit(0))["name"]

    at = {r: named(r) for r in RANKS}
    at["subfamily"] = F.coalesce(at["subfamily"], at["family"])
    at["division"] = F.coalesce(at["division"], at["order"], at["class"])
    return nodes.select("name", "rank", *[at[r].alias(r) for r in RANKS])


def resolve(df: DataFrame, column: str, synonyms: DataFrame, reference: DataFrame, out: str = "resolved") -> DataFrame:
    """df with the canonical spelling of a column: first synonyms(raw, canonical, null for unknown), then reference(name).

    Case and outer blanks don't count; what neither table has keeps its spelling; unknown is `Unknown`.
    """
    lower = lambda t, key, keep: t.groupBy(norm_key(F.col(key)).alias(f"__{key}")).agg(*keep)
    syn = lower(synonyms, "raw", [F.min("canonical").alias("__canonical"), F.lit(True).alias("__listed")]).filter("__raw is not null")
    ref = lower(reference, "name", [F.min("name").alias("__spelling")])
    step = df.join(syn, norm_key(F.col(column)) == F.col("__raw"), "left")
    step = step.withColumn("__term", F.when(F.col("__listed"), F.col("__canonical")).otherwise(F.trim(F.col(column))))
    step = step.join(ref, norm_key(F.col("__term")) == F.col("__name"), "left")
    value = F.coalesce("__spelling", F.nullif("__term", F.lit("")), F.lit("Unknown"))
    return step.withColumn(out, value).drop("__raw", "__canonical", "__listed", "__term", "__name", "__spelling")


def taxa_lookup(dim: DataFrame) -> DataFrame:
    """(term, level_idx, slots): where each term is found, a row's own name before any other row that holds it."""
    slots = F.array(*RANKS)
    places = dim.withColumn("slots", slots).select("name", "slots", F.posexplode("slots").alias("level_idx", "term"))
    places = places.filter("term is not null").withColumn("own", (F.col("name") == F.col("term")).cast("int"))
    order = Window.partitionBy(norm_key(F.col("term"))).orderBy(F.desc("own"), "name", "level_idx")
    return places.withColumn("n", F.row_number().over(order)).filter("n = 1").select(norm_key(F.col("term")).alias("term"), "level_idx", "slots")


def clean_taxon(term: Column) -> Column:
    """A taxon without `sp.` or `spp.` at its end."""
    return F.trim(F.regexp_replace(term, r"\s+spp?\.?\s*$", ""))


def rollup_taxa(df: DataFrame, column: str, lookup: DataFrame, level: str, out: str) -> DataFrame:
    """df with the name of each taxon at a level; a taxon above the level stays itself; what isn't found is Unknown."""
    idx = RANKS.index(level)
    found = df.join(lookup.withColumnRenamed("term", "__t"), norm_key(clean_taxon(F.col(column))) == F.col("__t"), "left")
    return found.withColumn(out, F.coalesce(F.get("slots", F.greatest(F.col("level_idx"), F.lit(idx))), F.lit("Unknown"))).drop("__t", "level_idx", "slots")


def rollup_geo(df: DataFrame, column: str, dim: DataFrame, mode: str, out: str) -> DataFrame:
    """df with the country, region or continent of each place; what isn't a known country is Unknown."""
    keyed = dim.select(norm_key(F.col("country")).alias("__c"), F.col(mode).alias("__v"))
    found = df.join(keyed, norm_key(F.col(column)) == F.col("__c"), "left")
    return found.withColumn(out, F.coalesce("__v", F.lit("Unknown"))).drop("__c", "__v")
