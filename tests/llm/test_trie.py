"""The prefix trie against a plain one."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from quire.llm import trie
from quire.llm.queries import QUERIES

SCHEMA = "conv_id long, turn long, role string, text string"


def plain_trie(rows):
    convs = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            h = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()[:40]
            convs.setdefault(conv, []).append(((turn is not None, turn or 0, h), (role, text)))
    own = {c: [x for _, x in sorted(v)] for c, v in convs.items()}
    if not own:
        return []
    made = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (c % 5 if c >= 0 else -(-c % 5))
        made[c] = tuple(own.get(base, [])[:h] + own[c][h:])
    members, kids = {}, {}
    for c, s in made.items():
        for d in range(len(s) + 1):
            members.setdefault(s[:d], []).append(c)
    for key in members:
        if key:
            kids.setdefault(key[:-1], []).append(key)
    total = {}
    for key in sorted(members, key=len, reverse=True):
        saved = (len(members[key]) - 1) * (len(key[-1][1].encode()) if key else 0)
        below = [total[k] for k in kids.get(key, [])]
        total[key] = (sum(x for x, _ in below) or int(not below), saved + sum(y for _, y in below))
    out = []
    for key, who in members.items():
        ends = ",".join(map(str, sorted(c for c in who if len(made[c]) == len(key))))
        out.append((min(who), len(key), min(members[key[:-1]]) if key else None, len(who), len(kids.get(key, [])),
                    *total[key], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def nodes_of(df):
    return sorted([(r["conv_id"], r["depth"], r["parent_conv_id"], r["n_convs"], r["n_children"], r["n_leaves"],
                    r["saved_tokens"], r["ends_sha256"]) for r in df.collect()], key=repr)


def test_query(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet")
            .select("conv_id", "turn", "role", "text").collect()]
    got = QUERIES["op13_trie"](spark, sf)
    assert {t for c, t in got.dtypes if c != "ends_sha256"} == {"bigint"}
    assert nodes_of(got) == plain_trie(rows)


def test_edges(spark):
    rows = [(None, 0, "user", "nobody's"), (0, None, None, None), (0, 1, "user", "a"), (0, 1, "user", "a"),
            (5, 2, "user", "é"), (5, 2, "user", "b"), (5, None, "user", ""), (6, 0, "user", "x" * 100_000),
            (7, 0, "user", None), (-3, 0, "user", "a"), (-3, 1, "user", "b"), (-5, 0, "user", "c"), (11, 9, "u", "z")]
    docs = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit("clash") for c in ("n", "pos", "depth", "hash", "kid")})
    assert nodes_of(trie.prefix_trie(docs)) == plain_trie(rows)
    assert trie.prefix_trie(docs.limit(0)).collect() == []
    assert trie.prefix_trie(docs.where("conv_id is null")).collect() == []


def test_one_hot_conversation_and_first_turn(spark, monkeypatch):
    """A conversation with a third of all turns, cut into many chunks; a first turn and a whole
    conversation that very many share."""
    monkeypatch.setattr(trie, "CHUNK", 7)
    monkeypatch.setattr(trie, "ENDS", 16)
    rng = random.Random(4)
    rows = [(10, t, "user", f"t{t}") for t in range(150)]
    for c in range(20, 100):
        rows.append((c, 0, "user", "hello"))
        rows += [(c, t, "user", rng.choice("ab")) for t in range(1, rng.choice([1, 1, 4, 12]))]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(12)
    assert nodes_of(trie.prefix_trie(docs)) == plain_trie(rows)


@pytest.mark.parametrize("shape", ["chain", "star", "random"])
def test_contraction(spark, shape):
    rng = random.Random(6)
    n = 70
    up = {v: v - 1 if shape == "chain" else 0 if shape == "star" else rng.randrange(v) for v in range(1, n)}
    depth = {0: 0}
    for v in range(1, n):
        depth[v] = depth[up[v]] + 1
    kids = {v: sum(u == v for u in up.values()) for v in range(n)}
    tree = spark.createDataFrame([(v, depth[v], up.get(v), kids[v], v + 1) for v in range(n)],
                                 "conv_id long, depth long, parent_conv_id long, n_children long, x long")
    want = {v: v + 1 for v in range(n)}
    for v in range(n - 1, 0, -1):
        want[up[v]] += want[v]
    got = {r["conv_id"]: r["x"] for r in trie.subtree_totals(tree, ["x"]).collect()}
    assert got == want
