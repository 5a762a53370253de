"""Decontamination and quality rules against brute force; the pipeline as a whole."""

import hashlib
import re
from collections import Counter

import numpy as np
from harness import compare, duck

import __spark_entry__ as E
import corpus_pipeline
from quire.llm import decontam, packing, pii, robust, simhash
from quire.llm.common import materialise, table
from quire.llm.queries import ORACLES, QUERIES
from quire.llm.tokens import vocabulary_path

WORD = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def item_words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plain_contamination(text, items):
    w = item_words(text)
    hit, ids = set(), set()
    for item_id, t in items:
        v = item_words(t)
        n = min(13, len(v))
        for s in range(len(v) - n + 1 if v else 0):
            for p in range(len(w) - n + 1):
                if w[p:p + n] == v[s:s + n]:
                    hit.update(range(p, p + n))
                    ids.add(item_id)
    ids = sorted(str(i) for i in ids if i is not None)
    return len(w), len(hit), ids, len(hit) > 0 and 20 * len(hit) >= len(w)


def test_decontamination_query(spark, sf):
    ok, msg = compare(QUERIES["op6_decontamination"](spark, sf), duck(sf), ORACLES["op6_decontamination"])
    assert ok, msg


ITEMS = [(1, "The quick brown fox jumps over the lazy dog and then runs far away into woods"), (2, "Short one"),
         (2, "another Short"), (3, None), (4, ""), (None, "no id here"), (5, "a a a a a a a a a a a a a a a"), (5, "ÉA b")]
DOCS = ["x y the quick brown fox jumps over the lazy dog and then runs far away into woods z",
        "THE QUICK brown-fox; jumps over the lazy dog and then runs far", "quick brown fox jumps over the lazy dog and",
        "short one short one", "one short another SHORT", "a " * 40, "a " * 12, "Éa b éa b", "no id here " + "word " * 100]


def test_decontamination_edges(spark, edge_docs, empty_docs):
    bench = spark.createDataFrame([(*r, "clash") for r in ITEMS], "item_id long, text string, words string")
    docs = edge_docs.unionByName(spark.createDataFrame(
        [(100 + i, t) for i, t in enumerate(DOCS)], "doc_id long, text string"), allowMissingColumns=True)
    rows = decontam.contamination(docs, bench).collect()
    have = docs.collect()
    assert len(rows) == len(have)

    def key(d, r):
        return (repr(d), *r[:2], tuple(r[2]), r[3])
    want = sorted(key(d["doc_id"], plain_contamination(d["text"], ITEMS)) for d in have)
    assert sorted(key(r["doc_id"], (r["n_words"], r["n_hit"], r["items"], r["contaminated"])) for r in rows) == want
    clean = decontam.keep_clean(docs, bench)
    assert clean.columns == docs.columns
    assert sorted(repr(r) for r in clean.collect()) == sorted(
        repr(d) for d in have if not plain_contamination(d["text"], ITEMS)[3])
    assert decontam.contamination(empty_docs, bench).count() == 0
    none = decontam.contamination(docs, bench.limit(0)).collect()
    assert len(none) == len(have) and not any(r["n_hit"] for r in none)


def plain_near(texts, items, slop=3):
    """Items with a proximity match of each text."""
    all_words = [item_words(t) for t in texts]
    counts = Counter(x for w in all_words for x in w)
    out = [set() for _ in texts]
    for item_id, t in items:
        v = item_words(t)
        n = min(13, len(v))
        for s in range(len(v) - n + 1 if v else 0):
            g = v[s:s + n]
            first, *rest = sorted(range(n), key=lambda i: (counts[g[i]], g[i].encode(), i))[:2]
            for ids, w in zip(out, all_words):
                for at in (p - first for p, x in enumerate(w) if x == g[first]):
                    there = [g[i] in w[max(0, at + i - slop):max(0, at + i + slop + 1)] for i in range(n)]
                    if all(there[i] for i in rest) and 4 * sum(there) >= 3 * n:
                        ids.add(item_id)
    return [sorted(str(i) for i in ids if i is not None) for ids in out]


def test_proximity(spark):
    fox = "the quick brown fox jumps over the lazy dog and then runs far away into woods"
    texts = DOCS + [None, "", fox.replace("lazy", "tired old"), "so " + fox.replace("then ", ""),
                    fox.replace("brown", "x x x x x x"), " ".join(reversed(fox.split())), "fox woods",
                    "jumps over the lazy dog and then runs far away into", "short x x one", "short x x x x one"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    rows = {r["doc_id"]: r for r in decontam.contamination(docs, bench).collect()}
    want = plain_near(texts, ITEMS)
    assert [rows[i]["near_items"] for i in range(len(texts))] == want
    assert all(r["n_near"] == len(r["near_items"]) and set(r["items"]) <= set(r["near_items"]) for r in rows.values())
    assert sum(len(r["near_items"]) > len(r["items"]) for r in rows.values()) >= 3
    strict = {r["doc_id"]: r for r in decontam.contamination(docs, bench, slop=0).collect()}
    assert all(strict[i]["items"] == rows[i]["items"] and strict[i]["n_hit"] == rows[i]["n_hit"] for i in rows)


def test_texts_are_shuffled_by_either_way(spark):
    """The join with the texts gives the same spans with the bitmap and, over its bound, without."""
    docs = spark.createDataFrame(list(enumerate(DOCS)), "doc_id long, text string")
    items = materialise(decontam.benchmark_items(spark.createDataFrame(ITEMS, "item_id long, text string")), "i")
    terms = materialise(decontam.vocabulary(items), "t")
    index = decontam.build_index(docs, terms)
    found = decontam.candidates(index, decontam.window_anchors(items, terms, index))
    few, all_rows = ({(r["k1"], r["k2"], repr(r["spans"])) for r in decontam.text_matches(
        docs, items, found, max_bytes=n).collect()} for n in (64 << 20, 0))
    assert few == all_rows and few


def plain_statistics(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    grams = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    many = Counter(grams)
    cover = {p for i, g in enumerate(grams) if many[g] > 1 for p in range(i, i + 3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)),
            len(cover), len(words) < 50 or 100 * len(cover) > 50 * len(words))


NAMES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


def test_statistics(spark, sf, edge_docs, empty_docs):
    extra = spark.createDataFrame([(200, "a b c a b c\n\nx\nx\n \nx y"), (201, "a a a a"), (202, "# é| <\x0b>\r\n b\x1cb"),
                                   (203, "w " * 5000), (204, "a b a b a b c a b")], "doc_id long, text string")
    docs = edge_docs.unionByName(extra, allowMissingColumns=True)
    rows = robust.judge(docs, ["doc_id", "text"]).collect()
    assert len(rows) == docs.count()
    for r in rows:
        assert tuple(r[n] for n in NAMES) == plain_statistics(r["text"]), r["text"][:80] if r["text"] else r
        assert r["kept"] == (not r["base_failed"]) and r["distance2"] is None
    assert robust.judge(empty_docs, ["doc_id"]).count() == 0
    texts = {r["doc_id"]: r["text"] for r in table(spark, sf, "documents").collect()}
    got = QUERIES["op9_quality_rules"](spark, sf).collect()
    assert len(got) == len(texts)
    for r in got:
        assert tuple(r[n] for n in NAMES) == plain_statistics(texts[r["doc_id"]])


def low(v, q):
    return np.sort(v, axis=0)[max(0, int(np.ceil(q * len(v))) - 1)]


def plain_estimate(x):
    """(log determinant, squared distances, squared fence) in numpy with exact quantiles: the best
    of all starts, every one carried on until its determinant falls no more."""
    floor = np.array(robust.LEAST_SPREAD)
    centre = low(x, 0.5)
    spread = np.maximum(1.4826 * low(np.abs(x - centre), 0.5), floor)
    z = (x - centre) / spread
    length = np.linalg.norm(z, axis=1, keepdims=True)
    drawn = [np.divide(z, length, out=np.zeros_like(z), where=length > 0), np.tanh(z)]
    first = [(centre, np.diag(spread ** 2))] + [
        ((centre + spread * d).mean(0), np.cov((centre + spread * d).T, bias=True) + np.diag(floor ** 2)) for d in drawn]
    found = []
    for mean, cov in first:
        last = np.inf
        while True:
            off = x - mean
            d2 = np.einsum("ij,ij->i", off @ np.linalg.inv(cov), off)
            near = x[d2 <= low(d2, robust.SUBSET)]
            new = np.cov(near.T, bias=True) + np.diag(floor ** 2)
            det = np.linalg.slogdet(new)[1]
            if not det < last - robust.FALL:
                break
            mean, cov, last = near.mean(0), new, det
        found.append((last, len(found), mean, cov))
    det, _, mean, cov = min(found, key=lambda f: f[:2])
    off = x - mean
    d2 = np.einsum("ij,ij->i", off @ np.linalg.inv(cov), off)
    d = np.cbrt(d2)
    half = max(low(d, 0.5) - low(d, 0.25), robust.LEAST_RANGE / 2)
    inside = d[d <= low(d, 0.5) + half * (1 + 4 * robust.FENCE)]
    reach = max(low(inside, 0.75) - low(inside, 0.25), robust.LEAST_RANGE)
    return det, d2, (low(inside, 0.75) + robust.FENCE * reach) ** 3


def test_distances(spark):
    """Distances and verdicts of every group against numpy. Quantiles are approximate, so verdicts
    may differ on the fence itself."""
    docs = table(spark, "/root/testdata/sf0.1", "documents")
    pdf = robust.judge(docs, ["doc_id", "lang", "source"]).toPandas()
    rows = robust.with_vectors(robust.text_statistics(docs, ["doc_id"]).withColumn("base_failed", robust.base_failed()))
    pdf = pdf.merge(rows.select("doc_id", *robust.COORDINATES).toPandas(), on="doc_id")
    use = pdf[~pdf["base_failed"]]
    seen = 0
    for _, group in use.groupby(["lang", "source"]):
        if len(group) < robust.LEAST_ROWS:
            continue
        seen += 1
        _, want, fence = plain_estimate(group[list(robust.COORDINATES)].to_numpy())
        assert np.corrcoef(np.cbrt(want), np.cbrt(group["distance2"]))[0, 1] > 0.99
        clear = np.abs(np.cbrt(want / fence) - 1) > 0.1
        assert ((want <= fence) == group["kept"])[clear].all()
    assert seen >= 20
    assert (pdf["kept"] <= ~pdf["base_failed"]).all()
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet").toPandas()
    both = use.merge(labels, on="doc_id")
    assert both[both["quality"] == 1]["kept"].mean() > 0.99 and both[both["quality"] == 0]["kept"].mean() < 0.05


def test_pipeline(spark, sf, edge_docs):
    """Every stage on what the one before kept, against brute force where there is one."""
    docs = table(spark, sf, "documents")
    columns = docs.columns
    bench = [(r["item_id"], r["text"]) for r in table(spark, sf, "benchmark").collect()]
    texts = {}
    for name, stage in corpus_pipeline.STAGES:
        before = {r["doc_id"]: r for r in docs.collect()}
        docs = materialise(stage(spark, docs, sf), f"test-{name}")
        if name == "packing":
            pieces = docs.collect()
            assert {p["doc_id"] for p in pieces} == set(before)
            assert all(p["offset"] + p["length"] <= packing.WINDOW for p in pieces)
            continue
        assert docs.columns == columns
        after = {r["doc_id"]: r for r in docs.collect()}
        if name == "pseudonyms":
            assert set(after) == set(before)
            assert any(after[d]["text"] != before[d]["text"] for d in after)
            assert all(after[d]["lang"] == before[d]["lang"] for d in after)
            continue
        assert all(before[d] == after[d] for d in after)
        if name == "quality":
            labels = {r["doc_id"]: r["quality"] for r in table(spark, sf, "labels").collect()}
            gone = [d for d in before if d in labels and d not in after]
            assert np.mean([labels[d] == 0 for d in gone]) > 0.8 and len(after) > 0.75 * len(before)
        if name == "near_duplicates":
            fps = {d: simhash.fingerprint(r["text"]) for d, r in before.items()}
            order = sorted(before)
            from test_simhash import plain_components
            comps = plain_components([fps[d] for d in order], order)
            assert set(after) == set(comps)
        if name == "decontamination":
            bad = {d for d, r in before.items() if not d in after}
            grams = {tuple(v[s:s + 13]) for _, t in bench for v in [item_words(t)] for s in range(max(1, len(v) - 12))}
            for d, r in before.items():
                w = item_words(r["text"])
                touched = any(tuple(w[p:p + 13]) in grams for p in range(len(w) - 12))
                assert (d in bad) == (touched and plain_contamination(r["text"], bench)[3])
    assert corpus_pipeline.run(spark, sf).count() == len(pieces)
    assert "pipeline" in E.queries() and all(f"op{i}_" in " ".join(E.queries()) for i in range(1, 11))


def test_pipeline_stages_on_odd_rows(spark, sf, edge_docs, empty_docs):
    for docs in (edge_docs, empty_docs):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, sf)
            if name != "packing":
                assert out.columns == docs.columns
            assert out.count() >= 0
