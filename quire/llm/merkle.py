"""Merkle manifest of a table: a hash tree per source, a tree over the sources' roots, and for
every row a proof that is checked by folding it to the root.

Leaves are hashed in the JVM and texts go no further. Their places (rank within the source, by
doc_id) come from a range sort whose partitions are counted, so a source with a third of all
rows spreads over many tasks. A superblock is the subtree of ``FAN ** DEPTH`` consecutive leaves.
Going up, each superblock becomes its top node, and the tops are the leaves of the next
level, until every source has one node, its subroot; subroots are ranked by source and go up
in the same way. Going down, the nodes of a level are cogrouped, by superblock, with the top
node that each belongs to and the siblings above it ("outer" nodes); one call reduces the
superblock again, joins inner and outer siblings to whole proofs and, at the leaves, hashes
the proofs and folds the possibly tampered leaves to the root. A task holds one superblock.

Nulls: null fields hash as ``-``; null sources are a tree of their own, the first; null ids come
first in their tree and are not tampered with. Rows of equal id and source are in order of
their leaf; equal rows have equal leaves, and a place each. An empty table gives no
rows. Further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.llm.common import materialise, placed, prepare

FAN = 16
DEPTH = 3                          # levels of a superblock
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
TAMPERED_EVERY = 5
FOREST = "sources"                 # the name of the tree over the subroots


def digest(text: str) -> str:
    return hashlib.sha256(text.encode("ascii")).hexdigest()


def leaf_of(fields: dict[str, Column]) -> Column:
    """sha256 of the fields, each ``-`` if null, else its bytes in UTF-8 counted and given."""
    parts = []
    for name in FIELDS:
        value = fields[name].cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-")))
    return F.sha2(F.concat(*parts), 256)


def tampered_text(doc_id: Column, text: Column) -> Column:
    """The text that is checked: with A-Z in lower case for about one id in five."""
    touched = F.crc32(doc_id.cast("string").cast("binary")) % TAMPERED_EVERY == 0
    return F.when(touched, F.translate(text, UPPER, LOWER)).otherwise(text)


def records(docs: DataFrame) -> DataFrame:
    """(tree, doc_id, digest, given): the leaf, and that of the row as it is given for checking
    (null where nothing changed)."""
    fields = {c: F.col(c) for c in FIELDS}
    given = tampered_text(fields["doc_id"], fields["text"])
    tree = F.coalesce(F.concat(F.lit("+"), F.col("source").cast("string")), F.lit(""))
    changed = F.coalesce(given != F.col("text"), F.lit(False))
    return docs.select(tree.alias("tree"), "doc_id", leaf_of(fields).alias("digest"),
                       F.when(changed, leaf_of({**fields, "text": given})).alias("given"))


def block() -> Column:
    return F.floor(F.col("pos") / (FAN ** DEPTH)).cast("long")


def levels_of(leaves: list[str], n: int) -> list[list[str]]:
    """A superblock's levels, leaves first: to one node if it holds its whole tree of ``n``
    leaves, else ``DEPTH`` steps up."""
    levels = [leaves]
    while len(levels[-1]) > 1 if n <= FAN ** DEPTH else len(levels) <= DEPTH:
        below = levels[-1]
        levels.append([digest("".join(below[i:i + FAN])) for i in range(0, len(below), FAN)])
    return levels


def tops(nodes: DataFrame) -> DataFrame:
    """The top nodes of all superblocks, as nodes of the next level."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("pos")
        n = int(pdf["n"].iloc[0])
        top = levels_of(pdf["digest"].tolist(), n)[-1][0]
        return pd.DataFrame({"tree": [pdf["tree"].iloc[0]], "pos": [int(pdf["pos"].iloc[0]) // FAN ** DEPTH],
                             "digest": [top], "n": [-(-n // FAN ** DEPTH)]})

    return (nodes.select("tree", "pos", "digest", "n").groupBy("tree", block().alias("block"))
            .applyInPandas(run, "tree string, pos long, digest string, n long"))


def inner_paths(levels: list[list[str]]) -> Iterator[list[str]]:
    """Per leaf of a superblock, ``left|right`` siblings of each step up."""
    runs = [["".join(level[i:i + FAN]) for i in range(0, len(level), FAN)] for level in levels[:-1]]
    for leaf in range(len(levels[0])):
        path, at = [], leaf
        for run in runs:
            together, i = run[at // FAN], 64 * (at % FAN)
            path.append(f"{together[:i]}|{together[i + 64:]}")
            at //= FAN
        yield path


def fold(leaf: str, path: list[str]) -> str:
    for step in path:
        left, right = step.split("|")
        leaf = digest(left + leaf + right)
    return leaf


def descend(nodes: DataFrame, outer: DataFrame) -> DataFrame:
    """(tree, pos, path, subroot, root) of nodes, from those of the nodes a superblock above."""
    def run(inner: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
        inner, top = inner.sort_values("pos"), above.iloc[0]
        rest = top["path"].split("/") if top["path"] else []
        levels = levels_of(inner["digest"].tolist(), int(inner["n"].iloc[0]))
        return pd.DataFrame({
            "tree": inner["tree"], "pos": inner["pos"],
            "path": ["/".join(path + rest) for path in inner_paths(levels)],
            "subroot": top["subroot"], "root": top["root"]})

    return (nodes.select("tree", "pos", "digest", "n").groupBy("tree", block().alias("block"))
            .cogroup(outer.groupBy("tree", "pos"))
            .applyInPandas(run, "tree string, pos long, path string, subroot string, root string"))


def prove(leaves: DataFrame, outer: DataFrame) -> DataFrame:
    """The leaves' rows of the manifest: proofs joined and hashed, given leaves folded."""
    def run(inner: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
        inner, top = inner.sort_values("pos"), above.iloc[0]
        rest = top["path"].split("/") if top["path"] else []
        rest_proof = "".join(rest).replace("|", "")
        levels = levels_of(inner["digest"].tolist(), int(inner["n"].iloc[0]))
        proofs, folded = [], []
        for leaf, given, path in zip(inner["digest"], inner["given"], inner_paths(levels)):
            proofs.append(digest("".join(path).replace("|", "") + rest_proof))
            folded.append(fold(given if isinstance(given, str) else leaf, path + rest))
        return pd.DataFrame({
            "doc_id": inner["doc_id"], "leaf": inner["digest"], "subroot": top["subroot"],
            "root": top["root"], "proof_sha256": proofs, "folded_root": folded,
            "verified": [x == top["root"] for x in folded]})

    # ids travel as text: pandas would make floats of numbers beside nulls
    rows = (leaves.select("tree", "pos", "digest", "n", F.col("doc_id").cast("string"), "given")
            .groupBy("tree", block().alias("block")).cogroup(outer.groupBy("tree", "pos"))
            .applyInPandas(run, "doc_id string, leaf string, subroot string, root string, proof_sha256 string, "
                                "folded_root string, verified boolean"))
    return rows.withColumn("doc_id", F.col("doc_id").cast(leaves.schema["doc_id"].dataType))


def climb(leaves: DataFrame, name: str) -> list[DataFrame]:
    """The levels of all trees, leaves first; in the last one every tree has one node. There
    are about as many as a tree's leaves have digits to the base of ``FAN ** DEPTH``."""
    levels = [leaves]
    while len(levels) == 1 or (levels[-1].agg(F.max("n")).first()[0] or 1) > 1:
        levels.append(materialise(tops(levels[-1]), f"{name}-level{len(levels)}"))
    return levels


def outer_nodes(levels: list[DataFrame], top: DataFrame, name: str) -> DataFrame:
    """What ``prove`` or ``descend`` of the lowest level needs, from that of the top level."""
    for k in range(len(levels) - 2, 0, -1):
        top = materialise(descend(levels[k], top), f"{name}-outer{k}")
    return top


def manifest(docs: DataFrame) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root and verified of every row."""
    prepare(docs.sparkSession)
    leaves = placed(materialise(records(docs), "merkle-records"), "tree", ["doc_id", "digest"], "merkle-leaves")
    levels = climb(leaves, "merkle")
    forest = levels[-1].select(F.lit(FOREST).alias("forest"), F.col("tree").alias("source"), "digest")
    forest = materialise(placed(forest, "forest", ["source"], "merkle-sources").withColumnRenamed("forest", "tree"),
                         "merkle-forest")
    roots = climb(forest, "merkle-forest")
    top = roots[-1].select("tree", "pos", F.lit("").alias("path"), F.col("digest").alias("subroot"),
                           F.col("digest").alias("root"))
    paths = descend(forest, outer_nodes(roots, top, "merkle-forest")).select("pos", "path", "root")
    subroots = forest.join(paths, "pos").select(
        F.col("source").alias("tree"), F.lit(0).cast("long").alias("pos"), "path",
        F.col("digest").alias("subroot"), "root")
    return prove(leaves, outer_nodes(levels, materialise(subroots, "merkle-subroots"), "merkle"))
