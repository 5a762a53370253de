"""Prefix trie of conversations, with totals of every subtree by parallel tree contraction.

Texts are hashed once and go no further. A turn's place in its conversation is its rank in a
range sort; a prefix is identified by sums of 40-bit hashes of (turn, depth), three of them,
which are running sums over chunks of a conversation, so one of any length spreads over many
tasks. Conversations with equal sums at a depth share a node, named by its smallest member and
its depth.

Contraction: in a round, *rake* adds every leaf to its parent and takes it away, then
*compress* takes away every node with one child whose drawn priority beats its parent's and its
child's; the child hangs on to the grandparent, its edge carrying what the node held, and
a log keeps (node, child, what lies between). Chains shrink by a third a round, so rounds are
about logarithmic in the depth. Then the logs are expanded, last round first: a node's
total is its own plus its child's. Each round joins tables that are unique in their keys,
after counts and sums that combine before the shuffle; each round's tables are written.

Nulls: rows without a conv_id belong to no conversation; null role or text is empty; null turns come
first. Turns of equal number are in order of their hash, repeated rows are turns of their own. An
empty table has no nodes. Further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.llm.common import join_unique, materialise, placed, prepare

FAMILY = 5                 # conversation c starts like conversation c - c % FAMILY
MOST_SHARED = 9            # with fewer turns than this
CHUNK = 1024               # turns of one running sum
ENDS = 4096                # conversation ids in one block of ends
SUMS = ("p1", "p2", "p3")
ABOVE = ("q1", "q2", "q3")


def turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, pos, n, hash, bytes) of every turn: its place, from 0, among the n of its
    conversation."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    rows = conversations.where("conv_id is not null").select(
        "conv_id", "turn", F.octet_length(text).cast("long").alias("bytes"),
        F.unhex(F.substring(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256), 1, 40))
        .alias("hash"))
    return placed(rows, "conv_id", ["turn", "hash"], "trie-turns").select("conv_id", "pos", "n", "hash", "bytes")


def shared(conv_id: Column) -> Column:
    return F.crc32(conv_id.cast("string").cast("binary")) % MOST_SHARED


def rebuilt(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conversations with their new length, their turns as conv_id, depth, hash, bytes)."""
    own = rows.where("pos = 0").select("conv_id", "n", shared(F.col("conv_id")).alias("h"),
                                       (F.col("conv_id") - F.col("conv_id") % FAMILY).alias("base"))
    own = materialise(own, "trie-conversations")
    bases = own.select(F.col("conv_id").alias("base"), F.col("n").alias("n_base"))
    taken = F.least(F.col("h"), F.coalesce("n_base", F.lit(0)))
    convs = materialise(own.join(bases, "base", "left").withColumn("taken", taken).withColumn(
        "length", F.col("taken") + F.greatest(F.col("n") - F.col("h"), F.lit(0))), "trie-lengths")
    first = rows.where(F.col("pos") < MOST_SHARED).select(
        F.col("conv_id").alias("base"), F.col("pos"), "hash", "bytes")
    heads = (convs.where("taken > 0").select("conv_id", "base", "taken").join(first, "base")
             .where("pos < taken").select("conv_id", (F.col("pos") + 1).alias("depth"), "hash", "bytes"))
    tails = rows.drop("n").where(F.col("pos") >= shared(F.col("conv_id")))
    tails = join_unique(tails, convs.select("conv_id", "h", "taken"), ["conv_id"], convs.select("conv_id", "n"),
                        convs.agg(F.sum("n")).first()[0] or 0)
    tails = tails.select("conv_id", (F.col("pos") - F.col("h") + F.col("taken") + 1).alias("depth"), "hash", "bytes")
    return convs, heads.unionByName(tails)


def running_sums(rows: DataFrame, at: str, columns: list[str], name: str) -> DataFrame:
    """Stored ``rows`` with each of ``columns`` summed up to and with ``at``, within conv_id."""
    rows = rows.withColumn("__chunk", F.floor(F.col(at) / CHUNK).cast("long"))
    window = Window.partitionBy("conv_id", "__chunk").orderBy(at)
    summed = rows.withColumns({c: F.sum(c).over(window) for c in columns})
    if (rows.agg(F.max("__chunk")).first()[0] or 0) > 0:
        chunks = materialise(rows.groupBy("conv_id", "__chunk").agg(*[F.sum(c).alias(c) for c in columns]),
                             f"{name}-chunks")
        before = running_sums(chunks.withColumnRenamed("__chunk", "chunk"), "chunk", columns, f"{name}-up")
        before = before.select("conv_id", (F.col("chunk") + 1).alias("__chunk"),
                               *[F.col(c).alias(f"__{c}") for c in columns])
        summed = summed.join(before, ["conv_id", "__chunk"], "left").withColumns(
            {c: F.col(c) + F.coalesce(f"__{c}", F.lit(0)) for c in columns}).drop(*[f"__{c}" for c in columns])
    return summed.drop("__chunk")


def prefixes(rows: DataFrame) -> DataFrame:
    """Turns with the sums that identify their prefix, and those of the prefix one shorter."""
    lanes = {p: F.shiftrightunsigned(F.xxhash64("hash", "depth", F.lit(k)), 24) for k, p in enumerate(SUMS)}
    rows = rows.withColumns(lanes).withColumns({q: F.col(p) for p, q in zip(SUMS, ABOVE)}).drop("hash")
    rows = running_sums(materialise(rows, "trie-rebuilt"), "depth", list(SUMS), "trie-sums")
    return rows.withColumns({q: F.col(p) - F.col(q) for p, q in zip(SUMS, ABOVE)})


def ends_digest(ends: DataFrame) -> DataFrame:
    """(depth, sums, ends_sha256) of the nodes where conversations end, from (conv_id, depth,
    sums). Ids are joined in blocks of a range of ids; a node's blocks are hashed as a stream."""
    node = ["depth", *SUMS]
    blocks = ends.groupBy(*node, F.floor(F.col("conv_id") / ENDS).cast("long").alias("block")).agg(
        F.sort_array(F.collect_list("conv_id")).alias("ids"))
    blocks = blocks.withColumn("ids", F.array_join(F.col("ids").cast("array<string>"), ","))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last, sha = None, None
        for pdf in batches:
            out = []
            for *key, ids in pdf[[*node, "ids"]].itertuples(index=False, name=None):
                if key == last:
                    sha.update(b"," + ids.encode())
                    continue
                if last is not None:
                    out.append((*last, sha.hexdigest()))
                last, sha = key, hashlib.sha256(ids.encode())
            yield pd.DataFrame(out, columns=[*node, "ends_sha256"])
        if last is not None:
            yield pd.DataFrame([(*last, sha.hexdigest())], columns=[*node, "ends_sha256"])

    sorted_blocks = blocks.repartition(*node).sortWithinPartitions(*node, "block")
    return sorted_blocks.mapInPandas(run, ", ".join(f"{c} long" for c in node) + ", ends_sha256 string")


def trie_nodes(conversations: DataFrame) -> DataFrame:
    """One row a node: conv_id, depth, parent_conv_id, n_convs, n_children, bytes, ends_sha256."""
    convs, rows = rebuilt(turns(conversations))
    rows = materialise(prefixes(rows), "trie-prefixes")
    node = ["depth", *SUMS]
    nought = {c: F.lit(0).cast("long") for c in ("depth", *SUMS)}
    root = convs.agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs")).where("n_convs > 0")
    root = root.withColumns({**nought, **{q: F.lit(None).cast("long") for q in ABOVE}, "bytes": F.lit(0).cast("long")})
    nodes = rows.groupBy(*node).agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"),
                                    F.min("bytes").alias("bytes"), *[F.min(q).alias(q) for q in ABOVE])
    ends = rows.join(convs.select("conv_id", F.col("length").alias("depth")), ["conv_id", "depth"]).select(
        "conv_id", *node).unionByName(convs.where("length = 0").withColumns(nought).select("conv_id", *node))
    nodes = nodes.unionByName(root).join(ends_digest(ends), node, "left")
    nodes = materialise(nodes, "trie-nodes")
    up = [(F.col("depth") - 1).alias("depth"), *[F.col(q).alias(p) for p, q in zip(SUMS, ABOVE)]]
    children = materialise(nodes.where("depth > 0").groupBy(*up).agg(F.count(F.lit(1)).alias("n")), "trie-children")
    below = nodes.where("depth > 0").select("conv_id", "n_convs", "bytes", "ends_sha256",
                                            *up, *[F.col(p).alias(f"own_{p}") for p in SUMS])
    named = join_unique(below, nodes.select(*node, F.col("conv_id").alias("parent_conv_id")), node, children,
                        children.agg(F.sum("n")).first()[0] or 0)
    named = named.select("conv_id", "parent_conv_id", "n_convs", "bytes", "ends_sha256",
                         (F.col("depth") + 1).alias("depth"), *[F.col(f"own_{p}").alias(p) for p in SUMS])
    top = nodes.where("depth = 0").select("conv_id", F.lit(None).cast("long").alias("parent_conv_id"),
                                          "n_convs", "bytes", "ends_sha256", *node)
    return named.unionByName(top).join(children, node, "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", F.coalesce("n", F.lit(0)).alias("n_children"), "bytes",
        F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"))


def subtree_totals(tree: DataFrame, values: list[str]) -> DataFrame:
    """(conv_id, depth, values): the sums over each node's subtree. ``tree`` has conv_id, depth,
    parent_conv_id (null: root; parents are one less deep), n_children and ``values``."""
    node, up = ["conv_id", "depth"], ["up_conv", "up_depth"]
    extra = [f"extra_{v}" for v in values]     # what compressed nodes on the edge above held
    tree = tree.select(*node, F.col("parent_conv_id").alias("up_conv"),
                       F.when(F.col("parent_conv_id").isNotNull(), F.col("depth") - 1).alias("up_depth"),
                       "n_children", *values, *[F.lit(0).cast("long").alias(e) for e in extra])
    left, raked, logs, k = materialise(tree, "trie-round0"), [], [], 0
    while True:
        k += 1
        leaf = F.col("n_children") == 0
        raked.append(materialise(left.where(leaf).select(*node, *values), f"trie-raked{k}"))
        kids = left.groupBy(*up).agg(
            *[F.sum(F.when(leaf, F.col(v) + F.col(e)).otherwise(0)).alias(f"sum_{v}") for v, e in zip(values, extra)],
            F.count_if(~leaf).alias("n_left"), F.min(F.when(~leaf, F.struct(*node, *extra))).alias("kid"))
        kids = kids.select(*[F.col(u).alias(c) for c, u in zip(node, up)], *[f"sum_{v}" for v in values], "n_left", "kid")
        left = left.where(~leaf).drop("n_children").join(kids, node).withColumnRenamed("n_left", "n_children")
        left = left.withColumns({v: F.col(v) + F.col(f"sum_{v}") for v in values}).drop(*[f"sum_{v}" for v in values])

        def drawn(*of: str) -> Column:
            return F.xxhash64(*of, F.lit(k))
        goes = ((F.col("n_children") == 1) & F.col("up_conv").isNotNull() & (drawn(*node) > drawn(*up))
                & (drawn(*node) > drawn("kid.conv_id", "kid.depth")))
        left = materialise(left.withColumn("goes", F.coalesce(goes, F.lit(False))), f"trie-rake{k}")
        if left.isEmpty():
            break
        gone = left.where("goes")
        logs.append(materialise(gone.select(
            *[F.col(c).alias(f"own_{c}") for c in node], "kid.conv_id", "kid.depth",
            *[(F.col(v) + F.col(f"kid.{e}")).alias(f"own_{v}") for v, e in zip(values, extra)]), f"trie-log{k}"))
        moved = gone.select("kid.conv_id", "kid.depth", *[F.col(u).alias(f"new_{u}") for u in up],
                            *[(F.col(v) + F.col(e)).alias(f"add_{v}") for v, e in zip(values, extra)])
        left = left.where("not goes").drop("goes", "kid").join(moved, node, "left")
        left = left.withColumns({
            **{u: F.when(F.col("new_up_conv").isNotNull(), F.col(f"new_{u}")).otherwise(F.col(u)) for u in up},
            **{e: F.col(e) + F.coalesce(f"add_{v}", F.lit(0)) for v, e in zip(values, extra)}})
        left = materialise(left.drop(*[f"new_{u}" for u in up], *[f"add_{v}" for v in values]), f"trie-round{k}")
    found = reduce(DataFrame.unionByName, raked)
    for k, log in reversed(list(enumerate(logs, 1))):
        whole = log.join(found, node).select(*[F.col(f"own_{c}").alias(c) for c in node],
                                             *[(F.col(f"own_{v}") + F.col(v)).alias(v) for v in values])
        found = found.unionByName(materialise(whole, f"trie-expanded{k}"))
    return found


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens and
    ends_sha256 of every node."""
    prepare(conversations.sparkSession)
    nodes = materialise(trie_nodes(conversations).withColumns({
        "n_leaves": (F.col("n_children") == 0).cast("long"),
        "saved_tokens": (F.col("n_convs") - 1) * F.col("bytes")}), "trie-named")
    totals = subtree_totals(nodes, ["n_leaves", "saved_tokens"])
    return nodes.drop("n_leaves", "saved_tokens", "bytes").join(totals, ["conv_id", "depth"])
