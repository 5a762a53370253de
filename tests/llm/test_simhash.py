"""SimHash near-duplicates against brute force."""

import random
import re

import numpy as np
import xxhash

from quire.llm import simhash
from quire.llm.queries import QUERIES


def plain_fingerprint(text):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not words:
        return 0
    grams = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hs = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def plain_components(fps, ids):
    fps = np.array(fps, dtype=np.uint64)
    root = list(range(len(fps)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i in range(len(fps)):
        for j in np.flatnonzero(np.bitwise_count(fps[i + 1:] ^ fps[i]) <= 3):
            a, b = find(i), find(i + 1 + int(j))
            root[max(a, b)] = min(a, b)
    groups = {}
    for i in range(len(fps)):
        groups.setdefault(find(i), []).append(i)
    out = [None] * len(fps)
    for g in groups.values():
        low = min((ids[i] for i in g if ids[i] is not None), default=None)
        for i in g:
            out[i] = low
    return out


def test_query(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    got = {r["doc_id"]: r for r in QUERIES["op8_simhash"](spark, sf).collect()}
    fps = [plain_fingerprint(d["text"]) for d in docs]
    want = plain_components(fps, [d["doc_id"] for d in docs])
    assert len(got) == len(docs)
    for d, fp, c in zip(docs, fps, want):
        assert got[d["doc_id"]]["fingerprint"] == f"{fp:016x}" and got[d["doc_id"]]["component_id"] == c


def planted(n=400, seed=2):
    """Random fingerprints with chains and clusters of neighbours at 1 to 4 bits."""
    rng = random.Random(seed)
    fps = [0, 1, 3, (1 << 64) - 1]
    while len(fps) < n:
        x = rng.choice(fps) if rng.random() < 0.7 else rng.getrandbits(64)
        for b in rng.sample(range(64), rng.choice([0, 1, 2, 3, 3, 4])):
            x ^= 1 << b
        fps.append(x)
    return fps


def test_links_connect_what_brute_force_connects(spark):
    fps = sorted(set(planted()))
    signed = np.array(fps, dtype=np.uint64).view(np.int64).tolist()
    df = spark.createDataFrame([(f,) for f in signed], "fp long").repartition(5)
    roots = {r["node"]: r["root"] for r in simhash.components(simhash.ball_links(df, len(fps))).collect()}
    want = plain_components(fps, signed)
    ours = [roots.get(f, f) for f in signed]
    assert ours == want


def test_nodes_of_very_many_links(spark):
    """One node is the smallest of 20,000 links, one the largest of as many; both are one component."""
    low, high = -(1 << 40), 1 << 40
    links = [(low, i) for i in range(20_000)] + [(i, high) for i in range(19_999, 40_000)] + [(-7, -6), (-6, -5), (-9, -9)]
    got = {r["node"]: r["root"] for r in simhash.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {low: low, high: low, -7: -7, -6: -7, -5: -7, **{i: low for i in range(40_000)}}
    assert simhash.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_many_rows_of_one_fingerprint(spark):
    """A third of the rows has no word, so fingerprint zero; the others differ."""
    docs = spark.range(6000).selectExpr("id + 1 as doc_id", "if(id % 3 = 0, ' ', concat('w', id, ' x', id * 7, ' y', id)) as text")
    got = simhash.near_duplicates(docs.repartition(8)).collect()
    fps = {r["doc_id"]: r["fp"] for r in got}
    assert len(got) == len(fps) == 6000
    assert {r["component_id"] for r in got if r["fp"] == 0} == {1} and sum(f == 0 for f in fps.values()) == 2000
    ids = sorted(fps)
    want = plain_components([fps[i] % (1 << 64) for i in ids], ids)
    assert {r["doc_id"]: r["component_id"] for r in got} == dict(zip(ids, want))


def test_a_task_holds_few_buckets(spark):
    fps = spark.range(40_000).selectExpr("xxhash64(id) as fp")
    assert simhash.ball_links(fps, 40_000).rdd.getNumPartitions() == 64 // simhash.TASK_BUCKETS


def test_edges(spark, edge_docs, empty_docs):
    rows = simhash.near_duplicates(edge_docs).collect()
    docs = edge_docs.collect()
    assert len(rows) == len(docs)
    fps = [plain_fingerprint(d["text"]) for d in docs]
    want = plain_components(fps, [d["doc_id"] for d in docs])
    expect = sorted(zip([d["doc_id"] for d in docs], fps, want), key=repr)
    assert sorted(((r["doc_id"], r["fp"] % (1 << 64), r["component_id"]) for r in rows), key=repr) == expect
    kept = simhash.keep_one_of_each(edge_docs)
    assert kept.columns == edge_docs.columns
    left = kept.collect()
    assert len(left) == len({(c, None if c is not None else f) for f, c in zip(fps, want)})
    assert {r["doc_id"] for r in left if r["doc_id"] is not None} == {c for c in want if c is not None}
    assert simhash.near_duplicates(empty_docs).count() == 0
    assert simhash.keep_one_of_each(empty_docs).count() == 0


def test_fingerprint_of_texts():
    for t in ("", None, "A", "a b", "A b c", "a b c d e\x0bf g É", "a " * 1000, "\x00 x\x1cy z"):
        assert simhash.fingerprint(t) == plain_fingerprint(t), t
