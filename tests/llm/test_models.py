"""The classifiers: held-out accuracy, defined results on odd input, no leaks."""

import numpy as np
import zlib

from quire.llm import langid, quality
from quire.llm.queries import QUERIES

SF_FIT = "/root/testdata/sf0.1"


def fold(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 3 == 1


def auc(y, x):
    order = np.argsort(x, kind="stable")
    rank = np.empty(len(x))
    rank[order] = np.arange(1, len(x) + 1)
    n1 = y.sum()
    return (rank[y == 1].sum() - n1 * (n1 + 1) / 2) / (n1 * (len(y) - n1))


def test_quality_query(spark):
    got = QUERIES["op2_quality"](spark, SF_FIT).toPandas()
    assert len(got) == spark.read.parquet(f"{SF_FIT}/documents.parquet").count()
    assert (got["held_out"] == got["doc_id"].map(fold)).all()
    assert got["score"].between(0, 1).all() and (got["predicted"] == (got["score"] >= 0.5)).all()
    labels = spark.read.parquet(f"{SF_FIT}/labels.parquet").toPandas()
    both = got[got["held_out"]].merge(labels, on="doc_id")
    assert auc(both["quality"].to_numpy(), both["score"].to_numpy()) > 0.97
    assert (both["predicted"] == both["quality"]).mean() > 0.95


def test_quality_edges(spark, edge_docs, empty_docs):
    labels = spark.createDataFrame(
        [(1, 1, 0), (2, 0, 0), (2, 1, 0), (None, 1, 0), (3, None, 0), (6, 0, 1), (6, 0, 1), (99, 1, 0)],
        "doc_id long, quality int, toxic int")
    model = quality.train(edge_docs, labels)
    rows = quality.with_scores(edge_docs.select("doc_id", "text"), model).collect()
    assert len(rows) == edge_docs.count() and all(0 <= r["score"] <= 1 for r in rows)
    assert quality.keep_good(edge_docs, model).columns == edge_docs.columns
    none = quality.train(edge_docs, labels.limit(0))
    assert none.constant == 0.5
    assert {r["predicted"] for r in quality.with_scores(edge_docs.select("doc_id", "text"), none).collect()} == {1}
    only_bad = quality.train(edge_docs, labels.where("quality = 0 and doc_id = 6"))
    assert only_bad.constant in (0.0, 0.5)
    assert quality.keep_good(edge_docs, quality.Model(constant=0.0)).count() == edge_docs.count()
    assert quality.with_scores(empty_docs.select("doc_id", "text"), model).count() == 0
    # a fold that is held out teaches nothing
    out = next(i for i in range(1, 500) if fold(i))
    docs = spark.createDataFrame([(out, "x " * 500)], "doc_id long, text string")
    one = spark.createDataFrame([(out, 0, 0)], "doc_id long, quality int, toxic int")
    assert quality.train(docs, one).constant == 0.5


def test_quality_fitted_edges(spark, edge_docs):
    good = [(i, f"plain words of a sentence number {i} that goes on. " * 20) for i in range(0, 400, 2)]
    bad = [(i, f"BUY!!! $$$ {i} NOW!!! ### " * 30) for i in range(1, 400, 2)]
    docs = spark.createDataFrame(good + bad, "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1 - i % 2, 0) for i in range(400)], "doc_id long, quality int, toxic int")
    model = quality.train(docs, labels)
    assert model.constant is None
    held = [r for r in quality.with_scores(docs, model).collect() if fold(r["doc_id"])]
    assert held and all(r["predicted"] == 1 - r["doc_id"] % 2 for r in held)
    rows = quality.with_scores(edge_docs.select("doc_id", "text"), model).collect()
    assert all(0 <= r["score"] <= 1 for r in rows)
    by_text = {}
    for r in rows:
        assert by_text.setdefault(r["text"] or "", r["score"]) == r["score"]


def test_language_query(spark):
    got = QUERIES["op3_language"](spark, SF_FIT).toPandas()
    docs = spark.read.parquet(f"{SF_FIT}/documents.parquet").select("doc_id", "lang").toPandas()
    assert len(got) == len(docs) and got["score"].between(0, 1).all()
    assert (got["held_out"] == got["doc_id"].map(fold)).all()
    both = got[got["held_out"]].merge(docs, on="doc_id")
    assert (both["lang_pred"] == both["lang"]).mean() > 0.97


def test_language_edges(spark, edge_docs, empty_docs):
    net = langid.train(edge_docs)
    assert net is not None and set(net.languages) <= {"en", "de", "es", "fr"}
    rows = langid.with_language(edge_docs.select("doc_id", "text"), net).collect()
    assert len(rows) == edge_docs.count()
    for r in rows:
        spoken = any(c.isalpha() for c in r["text"] or "")
        assert (r["lang_pred"] != "und") == spoken and 0 <= r["score"] <= 1
    assert langid.train(empty_docs) is None
    assert {r["lang_pred"] for r in langid.with_language(edge_docs.select("text"), None).collect()} == {"und"}
    assert langid.with_language(empty_docs.select("doc_id", "text"), net).count() == 0


def test_every_language_is_learnt(spark):
    """No cap on the number of values: the rarest is a class beside six hundred others."""
    rows = [(i, f"word{i} " * 20, f"l{i % 601}") for i in range(1300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    known = {lang for i, _, lang in rows if not fold(i)}
    assert {lang for lang, _ in langid.training_windows(docs)} == known and len(known) > 500


def test_network_gradient():
    """The analytic step lowers the loss on a separable toy problem to near nothing."""
    rng = np.random.default_rng(0)
    texts = [rng.choice(np.frombuffer(b"abcd", np.uint8), 100).tobytes() for _ in range(200)] + \
        [rng.choice(np.frombuffer(b"wxyz", np.uint8), 100).tobytes() for _ in range(200)]
    codes = np.concatenate([langid.windows(t) for t in texts])
    net = langid.fit(codes, np.repeat([0, 1], 200), ["a", "b"], epochs=4)
    assert langid.identify(net, ["abcdabcd", "wxyz" * 100, ""])[0][:2] == ["a", "b"]


def test_windows_cover_whole_text():
    raw = bytes(range(256)) * 5 + b"end"
    assert langid.windows(raw).tobytes()[:len(raw)] == raw
    assert langid.windows(b"").shape == (1, langid.LENGTH)
    assert b"".join(quality.blocks("é" * 5000)) == ("é" * 5000).encode() and quality.blocks(None) == [b""]
