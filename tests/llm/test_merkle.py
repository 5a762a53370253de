"""The manifest against a plain re-computation."""

import hashlib
import zlib

import pytest

from quire.llm import merkle
from quire.llm.queries import QUERIES


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain_leaf(doc_id, source, lang, n_chars, text):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}"
                       for v in (doc_id, source, lang, n_chars, text)))


def plain_tree(leaves):
    """(top, path of (left, right) per leaf)."""
    paths, level, spans = [[] for _ in leaves], leaves, [[i] for i in range(len(leaves))]
    while len(level) > 1:
        above, wider = [], []
        for a in range(0, len(level), 16):
            run = level[a:a + 16]
            for i in range(len(run)):
                for leaf in spans[a + i]:
                    paths[leaf].append(("".join(run[:i]), "".join(run[i + 1:])))
            above.append(sha("".join(run)))
            wider.append([x for s in spans[a:a + 16] for x in s])
        level, spans = above, wider
    return level[0], paths


def plain_manifest(rows):
    """Sorted rows of the manifest, from (doc_id, text, lang, source, n_chars)."""
    trees = {}
    for doc_id, text, lang, source, n in rows:
        given = text
        if doc_id is not None and text is not None and zlib.crc32(str(doc_id).encode()) % 5 == 0:
            given = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
        leaf = plain_leaf(doc_id, source, lang, n, text)
        trees.setdefault(source, []).append(
            ((doc_id is not None, doc_id or 0, leaf), doc_id, leaf, plain_leaf(doc_id, source, lang, n, given)))
    names = sorted(trees, key=lambda s: (s is not None, (s or "").encode()))
    for s in names:
        trees[s].sort(key=lambda r: r[0])
    done = {s: plain_tree([r[2] for r in trees[s]]) for s in names}
    root, root_paths = plain_tree([done[s][0] for s in names])
    out = []
    for k, s in enumerate(names):
        for (_, doc_id, leaf, given), path in zip(trees[s], done[s][1]):
            whole, folded = path + root_paths[k], given
            for left, right in whole:
                folded = sha(left + folded + right)
            out.append((doc_id, leaf, done[s][0], root, sha("".join(a + b for a, b in whole)), folded, folded == root))
    return sorted(out, key=repr)


def manifest_rows(df):
    return sorted([(r["doc_id"], r["leaf"], r["subroot"], r["root"], r["proof_sha256"], r["folded_root"], r["verified"])
                   for r in df.collect()], key=repr)


def plain_rows(df):
    return [(r["doc_id"], r["text"], r["lang"], r["source"], r["n_chars"]) for r in df.collect()]


def test_query(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    got = manifest_rows(QUERIES["op12_merkle"](spark, sf))
    assert got == plain_manifest(plain_rows(docs)) and not all(r[-1] for r in got)


def test_edges(spark, edge_docs, empty_docs):
    got = merkle.manifest(edge_docs)
    assert dict(got.dtypes)["doc_id"] == "bigint"
    assert manifest_rows(got) == plain_manifest(plain_rows(edge_docs))
    assert merkle.manifest(empty_docs).collect() == []


@pytest.mark.parametrize("n", [1, 16, 17, 256, 257])
def test_sizes_of_one_source(spark, n):
    rows = [(i, f"Text {i}", "en", "a", i) for i in range(n)] + [(None, "Lone", None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    assert manifest_rows(merkle.manifest(docs)) == plain_manifest(rows)


def test_levels_of_superblocks(spark, monkeypatch):
    """Superblocks of 16 leaves: a source with most rows climbs many levels, the forest two."""
    monkeypatch.setattr(merkle, "DEPTH", 1)
    big = (1 << 60) + 1        # would not survive a float
    rows = [(big + i, f"Text {i % 7}", "en", "hot" if i % 3 else f"s{i % 40}", i) for i in range(1500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    assert manifest_rows(merkle.manifest(docs.repartition(16))) == plain_manifest(rows)


def test_one_repeated_row(spark):
    rows = [(5, "Same", "en", "a", 4)] * 300 + [(None, "Same", "en", "a", 4)] * 20
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    assert manifest_rows(merkle.manifest(docs)) == plain_manifest(rows)
