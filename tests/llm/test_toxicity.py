"""Toxic passages: segments against brute force, the law, held-out accuracy, odd input."""

import random
import zlib

import numpy as np

from quire.llm import toxicity
from quire.llm.queries import QUERIES

SF_FIT = "/root/testdata/sf0.1"


def fold(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 4 == 2


def plain_segments(s):
    """By the definition: the best segment (shortest, then first), then left and right of it."""
    if not len(s) or max(s) <= 0:
        return []
    best = max(((round(sum(s[a:b]), 9), -(b - a), -a) for a in range(len(s)) for b in range(a + 1, len(s) + 1)))
    a, n = -best[2], -best[1]
    left = plain_segments(s[:a])
    right = [(x + a + n, y + a + n, z) for x, y, z in plain_segments(s[a + n:])]
    return left + [(a, a + n, best[0])] + right


def test_segments():
    rng = random.Random(1)
    assert toxicity.segments(np.array([])) == [] and toxicity.segments(np.array([-1.0, 0.0])) == []
    for n in range(1, 26):
        for _ in range(12):
            s = [rng.uniform(-1.5, 1.0) for _ in range(n)]
            got = toxicity.segments(np.array(s))
            assert [(a, b) for a, b, _ in got] == [(a, b) for a, b, _ in plain_segments(s)]
            assert all(abs(z - sum(s[a:b])) < 1e-9 for a, b, z in got)


def test_segments_take_linear_time():
    s = np.tile([0.5, -1.0], 200_000)
    assert len(toxicity.segments(s)) == 200_000
    s = np.concatenate([np.tile([1.0, -0.9], 100_000), [50_000.0]])
    assert toxicity.segments(s)[-1][1] == len(s)


def test_law_of_random_scores():
    """lambda and K foretell how often the best segment of random text passes a score."""
    rng = np.random.default_rng(3)
    edges = (np.arange(toxicity.BINS) - toxicity.BINS // 2 + 0.5) * toxicity.WIDTH
    values, p = edges[[72, 78, 88, 96]], np.array([0.5, 0.3, 0.15, 0.05])

    def best(n):
        return max((x for _, _, x in toxicity.segments(rng.choice(values, n, p=p))), default=0.0)
    histogram = np.zeros(toxicity.BINS)
    histogram[[72, 78, 88, 96]] = p * 1e6
    lengths = rng.integers(50, 1500, 1500)
    found = np.array([best(n) for n in lengths])
    slope, log_k = toxicity.law(histogram, lengths, found, np.ones(len(found)))
    assert abs((p * np.exp(slope * values)).sum() - 1) < 0.01
    for score in (8.0, 10.0, 12.0):
        seen = np.mean([best(600) >= score for _ in range(1500)])
        told = 1 - np.exp(-np.exp(log_k) * 600 * np.exp(-slope * score))
        assert abs(seen - told) < 0.06


def test_log_odds_chain():
    units = ["*", "badword", "badwor*", "badwo*", "badw*", "bad*", "plain", "plain*", "plai*", "pla*"]
    clean, toxic = np.array([900, 0, 0, 0, 0, 0, 500, 500, 500, 500]), np.array([100, 60, 60, 60, 60, 60, 55, 55, 55, 55])
    words, starts = toxicity.log_odds(units, clean, toxic)
    scorer = toxicity.Scorer(words, starts)
    got = scorer.of(["badword", "badwording", "unseen", "plain", "plain"]) + toxicity.COST
    share = 100.5 / 1001
    for n_clean, n_toxic in [(0, 60)] * 5:
        share = (n_toxic + 20 * share) / (n_clean + n_toxic + 20)
    want = np.log(share / (1 - share)) - np.log(100.5 / 900.5)
    assert abs(got[0] - want) < 1e-9 and got[1] > 2 and got[2] == 0 and abs(got[3]) < 0.1
    assert got[4] == 0                     # a repeat of the word before


def test_query(spark):
    got = QUERIES["op11_toxicity"](spark, SF_FIT).toPandas()
    assert len(got) == spark.read.parquet(f"{SF_FIT}/documents.parquet").count()
    assert (got["held_out"] == got["doc_id"].map(fold)).all()
    assert got["score"].between(0, 1).all() and (got["predicted"] == (got["score"] >= 0.3)).all()
    labels = spark.read.parquet(f"{SF_FIT}/labels.parquet").toPandas()
    both = got[got["held_out"]].merge(labels, on="doc_id")
    assert both[both["toxic"] == 1]["predicted"].mean() > 0.9
    assert both[both["toxic"] == 0]["predicted"].mean() < 0.03


def corpus():
    rng = random.Random(5)
    plain = ["tree", "river", "stone", "cloud", "winter", "paper", "garden", "letter"]
    rows, labels = [], []
    for i in range(600):
        words = [rng.choice(plain) for _ in range(rng.randint(20, 120))]
        if i % 4 == 0:
            at = rng.randrange(len(words))
            words[at:at] = ["vile", "rotten", "vermin"]
        rows.append((i, " ".join(words).title()))
        labels.append((i, 1, int(i % 4 == 0)))
    return rows, labels


def test_passages(spark):
    rows, labels = corpus()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = toxicity.train(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    got = {r["doc_id"]: r for r in toxicity.with_toxicity(docs, model).collect()}
    for i, text in rows:
        assert got[i]["predicted"] == int(i % 4 == 0)
        if i % 4 == 0:
            assert any("vile rotten vermin" in p["words"] for p in got[i]["passages"])
        for p in got[i]["passages"]:
            assert p["expected"] < toxicity.SIGNIFICANT and text.lower()[p["start"]:p["end"]] == p["words"]


def test_edges(spark, edge_docs, empty_docs):
    labels = spark.createDataFrame(
        [(1, 1, 0), (2, 0, 0), (2, 1, 1), (None, 1, 0), (3, 1, None), (6, 0, 1), (6, 0, 1), (99, 1, 0), (8, 1, 0)],
        "doc_id long, quality int, toxic int")
    model = toxicity.train(edge_docs, labels)
    got = toxicity.with_toxicity(edge_docs, model)
    rows = got.collect()
    assert len(rows) == edge_docs.count() and all(0 <= r["score"] <= 1 for r in rows)
    assert set(edge_docs.columns) <= set(got.columns)
    assert toxicity.train(edge_docs, labels.limit(0)).constant == 0.0
    one = spark.createDataFrame([(1, 1)], "doc_id long, toxic int")
    assert toxicity.train(spark.createDataFrame([(1, "x")], "doc_id long, text string"), one).constant == 1.0
    assert toxicity.with_toxicity(empty_docs, model).count() == 0
    # a fold that is held out teaches nothing
    out = next(i for i in range(1, 500) if fold(i))
    docs = spark.createDataFrame([(out, "x")], "doc_id long, text string")
    assert toxicity.train(docs, spark.createDataFrame([(out, 1)], "doc_id long, toxic int")).constant == 0.0
    assert {r["score"] for r in toxicity.with_toxicity(docs, toxicity.Model(constant=0.0)).collect()} == {0.0}
