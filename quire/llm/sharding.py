"""Hierarchical weighted hash tree: rows descend region, rack and shard levels.

At every level each child draws ``-ln(u) / weight`` with ``u`` hashed from the key and
the child's path, and the smallest draw wins, so a child is chosen in proportion to
its weight. A draw depends on nothing but the key and that child: when a weight
changes, rows move only into or out of the subtree it belongs to. A shard added as a
subtree of its own at the root therefore takes rows only into itself.

Everything is DataFrame expressions; the assignment needs no shuffle.

Nulls: a null key hashes as its own value (all null keys share a shard); a null text
counts zero bytes. Repeated rows get the same shard and different slots. An empty
table gives an empty result. Columns of the input other than those named are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.llm.common import materialise

UNIT = 2.0 ** -53


@dataclass(frozen=True)
class Node:
    """A subtree; a leaf has a shard number. Its weight is the sum of its leaves'."""
    path: str
    weight: float
    children: tuple["Node", ...] = ()
    shard: int | None = None


def leaf(path: str, shard: int, weight: float = 1.0) -> Node:
    return Node(path, weight, (), shard)


def branch(path: str, children: list[Node]) -> Node:
    return Node(path, sum(c.weight for c in children), tuple(children))


def hash_tree(n_shards: int, racks_per_region: int = 2, shards_per_rack: int = 4,
              weights: dict[int, float] | None = None) -> Node:
    """Shards dealt to racks and racks to regions in order of their numbers."""
    w = weights or {}
    per_region = racks_per_region * shards_per_rack
    regions = []
    for r in range(0, n_shards, per_region):
        racks = []
        for k in range(r, min(r + per_region, n_shards), shards_per_rack):
            path = f"r{r // per_region}/k{(k - r) // shards_per_rack}"
            racks.append(branch(path, [leaf(f"{path}/s{s}", s, w.get(s, 1.0))
                                       for s in range(k, min(k + shards_per_rack, n_shards, r + per_region))]))
        regions.append(branch(f"r{r // per_region}", racks))
    return branch("", regions)


def with_own_subtree(tree: Node, shard: int, weight: float = 1.0) -> Node:
    """``tree`` with one more shard in a region and rack of its own, so that no row
    moves between the shards that were there."""
    path = f"x{shard}"
    added = branch(path, [branch(f"{path}/k0", [leaf(f"{path}/k0/s{shard}", shard, weight)])])
    return branch(tree.path, [*tree.children, added])


def draw(key: Column, node: Node) -> Column:
    u = (F.shiftrightunsigned(F.xxhash64(key, F.lit(node.path)), 11) + F.lit(0.5)) * F.lit(UNIT)
    return -F.log(u) / F.lit(float(node.weight))


def shard_of(key: Column, tree: Node) -> Column:
    """The shard that ``key`` reaches from the root of ``tree``."""
    if tree.shard is not None:
        return F.lit(tree.shard)
    live = [c for c in tree.children if c.weight > 0]
    if not live:
        raise ValueError(f"no child of {tree.path or 'the root'} has a positive weight")
    if len(live) == 1:
        return shard_of(key, live[0])
    won = F.array_min(F.array(*[F.struct(draw(key, c).alias("draw"), F.lit(i).alias("child"))
                                for i, c in enumerate(live)]))["child"]
    if all(c.shard is not None for c in live):
        return F.element_at(F.array(*[F.lit(c.shard) for c in live]), won + 1)
    out = F.when(won == 0, shard_of(key, live[0]))
    for i, c in enumerate(live[1:], 1):
        out = out.when(won == i, shard_of(key, c))
    return out


def number_slots(df: DataFrame, shard: str = "shard", slot: str = "slot") -> DataFrame:
    """Number the rows of every shard from 0 without a gap. Rows are numbered inside
    (shard, input partition), and the partitions' counts give the first number of
    each, so no task ever holds a whole shard. ``df`` is written once: both branches
    must see the same row order."""
    rows = materialise(df.withColumn("__rid", F.monotonically_increasing_id()), "shard-rows")
    rows = rows.withColumn("__part", F.shiftright("__rid", 33))
    before = Window.partitionBy(shard).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    first = (rows.groupBy(shard, "__part").agg(F.count(F.lit(1)).alias("__n"))
             .select(shard, "__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__first")))
    inside = Window.partitionBy(shard, "__part").orderBy("__rid")
    return (rows.withColumn("__i", F.row_number().over(inside) - 1).join(first, [shard, "__part"])
            .withColumn(slot, F.col("__first") + F.col("__i")).drop("__rid", "__part", "__first", "__i"))


def place_documents(docs: DataFrame, tree: Node, grown: Node | None = None) -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot, grown_shard) of every row of ``docs``."""
    body = F.coalesce(F.col("text"), F.lit(""))
    key = F.col("doc_id")
    rows = docs.select(
        key, (F.octet_length(body) + 8).cast("long").alias("size"),
        F.crc32(body.cast("binary")).cast("long").alias("text_crc32"),
        shard_of(key, tree).cast("int").alias("shard"),
        (shard_of(key, grown) if grown else F.lit(None)).cast("int").alias("grown_shard"))
    return number_slots(rows)


def write_shards(df: DataFrame, tree: Node, key: str, path: str) -> None:
    """Write whole rows into one folder per shard."""
    df.withColumn("shard", shard_of(F.col(key), tree)).write.partitionBy("shard").parquet(path)
