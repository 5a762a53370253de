"""Groups of nearly equal texts, by the overlap of their word shingles.

Texts whose sets of shingles have a Jaccard similarity of at least a given percentage are linked,
and what is connected by links is one group. The search is exact: of two such sets, the rarest
shingles (as many as may be missing from the other, and one more) have one in common. Texts with
equal sets are one before that, so only different sets are paired; every pair is verified. Sets hold 64-bit
hashes. Nothing is collected; the count of a hot shingle and the least neighbour of a node of many
links are broadcast, for fewer than ``HOT_SHARE`` such keys, so their rows stay where they are. Sets that
share one of their rarest shingles are paired one by one: k near copies that differ make k * k / 2 pairs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.operators.common import stored

SHINGLE = 5
PERCENT = 80
HOT_SHARE = 1000


def shingles(words: Column, k: int = SHINGLE) -> Column:
    """The different runs of k words, as sorted hashes; fewer words are one run, none are none."""
    n = F.size(words)
    places = F.when(n > k, F.sequence(F.lit(1), n - (k - 1))).when(n > 0, F.array(F.lit(1))).otherwise(
        F.array().cast("array<int>"))
    return F.array_sort(F.array_distinct(F.transform(places, lambda i: F.xxhash64(F.array_join(F.slice(words, i, k), " ")))))


def join_counted(rows: DataFrame, side: DataFrame, keys: list[str], total: int, how: str) -> DataFrame:
    """Stored ``rows`` joined with stored ``side``, unique in ``keys``, whose ``n`` counts rows of a key
    and adds up to ``total`` or less."""
    hot = F.broadcast(side.where(F.col("n") * HOT_SHARE > total))
    marked = rows.join(hot, keys, "left")
    rest = marked.where("n is null").select(rows.columns).join(side, keys, how)
    return marked.where("n is not null").unionByName(rest)


def prefixes(sets: DataFrame, keys: list[str], percent: int) -> DataFrame:
    """(keys, shingle, id, size): the rarest shingles of each set, without those no other set has."""
    parts = stored(sets.select(*keys, "id", F.explode("shingles").alias("shingle")))
    shared = stored(parts.groupBy(*keys, "shingle").agg(F.count(F.lit(1)).alias("n")).where("n > 1"))
    counted = join_counted(parts, shared, [*keys, "shingle"], parts.count(), "left")
    ranked = counted.groupBy(*keys, "id").agg(
        F.array_sort(F.collect_list(F.struct(F.coalesce("n", F.lit(1)).alias("n"), "shingle"))).alias("all"))
    needed = F.floor((F.size("all") * percent + 99) / 100).cast("int")
    return (ranked.select(*keys, "id", F.size("all").alias("size"), F.inline(F.slice("all", F.lit(1), F.size("all") - needed + 1)))
            .where("n > 1").drop("n"))


def linked(sets: DataFrame, keys: list[str], percent: int = PERCENT) -> DataFrame:
    """(a, b): ids of different stored sets of the same keys that are similar enough."""
    lists = stored(prefixes(sets, keys, percent))
    a, b = (lists.select(*keys, "shingle", F.col("id").alias(c), F.col("size").alias(f"{c}_size")) for c in "ab")
    pairs = (a.join(b, [*keys, "shingle"]).where("a < b")
             .where(F.least("a_size", "b_size") * 100 >= F.greatest("a_size", "b_size") * percent)
             .select("a", "b").distinct())
    for c in "ab":
        pairs = pairs.join(sets.select(F.col("id").alias(c), F.col("shingles").alias(f"{c}_set")), c)
    both, either = F.size(F.array_intersect("a_set", "b_set")), F.size(F.array_union("a_set", "b_set"))
    return pairs.where(both * 100 >= either * percent).select("a", "b")


def least_linked(edges: DataFrame, least: Column) -> DataFrame:
    """Stored links (u, v) with ``m``, the aggregate ``least`` over all links of u."""
    low = stored(edges.groupBy("u").agg(least.alias("m"), F.count(F.lit(1)).alias("n")))
    return join_counted(edges, low, ["u"], edges.count(), "inner")


def connected(links: DataFrame) -> DataFrame:
    """(id, root) for every id of the links (a, b) but the roots, the smallest ids connected. In turn,
    larger and smaller neighbours are hung on the smallest one, until no link changes."""
    edges = stored(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    while True:
        ways = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        hung = stored(least_linked(ways, F.least(F.min("v"), F.col("u"))).where("v > u")
                       .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        flat = stored(least_linked(hung, F.min("v")).select(
            F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v"))
            .where("u <> v").distinct())
        if flat.count() == edges.count() and flat.join(edges, ["u", "v"], "left_anti").isEmpty():
            return flat.select(F.col("u").alias("id"), F.col("v").alias("root"))
        edges = flat


def near_groups(texts: DataFrame, keys: list[str], words: Column, percent: int = PERCENT,
                k: int = SHINGLE) -> DataFrame:
    """``texts`` with ``near_id``, equal for rows of one group. Groups do not cross ``keys``, which are
    not null; texts without a word are one group of their keys."""
    rows = texts.withColumn("__shingles", shingles(words, k))
    sets = stored(rows.groupBy(*keys, F.col("__shingles").alias("shingles")).agg(F.count(F.lit(1)).alias("__n"))
                   .drop("__n").withColumn("id", F.monotonically_increasing_id()))
    roots = connected(linked(sets, keys, percent))
    named = sets.join(roots, "id", "left").select(*keys, F.col("shingles").alias("__shingles"),
                                                  F.coalesce("root", "id").alias("near_id"))
    return rows.join(named, [*keys, "__shingles"]).drop("__shingles")
