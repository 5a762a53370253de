"""Which rows an estimate of the quality rules comes from, and what copies do to it."""

import numpy as np

from quire.llm import robust
from test_rules import plain_estimate


def words(rng, n, junk=False):
    got = ["".join(rng.choice(list("abcdefghijklmnop"), rng.integers(3, 8))) for _ in range(n)]
    return " ".join(w + "#$%&" * junk for w in got)


def test_small_groups_have_the_estimate_of_their_language(spark):
    """Rows of small groups are judged by all rows of their language, or by all."""
    rng = np.random.default_rng(3)
    rows = [(i, words(rng, int(rng.integers(60, 200))), "en", "large") for i in range(300)]
    rows += [(1000 + i, words(rng, int(rng.integers(60, 200)), i < 2), "en", "tiny") for i in range(10)]
    rows += [(2000 + i, words(rng, int(rng.integers(60, 200)), i < 2), None, "odd") for i in range(5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = {r["doc_id"]: r for r in robust.judge(docs, ["doc_id"]).collect()}
    assert len(got) == len(rows) and all(r["distance2"] is not None for r in got.values())
    assert {d for d, r in got.items() if not r["kept"]} == {1000, 1001, 2000, 2001}


def test_copies_in_a_third_of_a_source(spark):
    """One junk text in more than a third of a source's rows neither passes nor hides others."""
    rng = np.random.default_rng(5)
    copy = words(rng, 80, True)
    rows = [(i, words(rng, int(rng.integers(60, 200))), "en", "a") for i in range(240)]
    rows += [(1000 + i, copy, "en", "a") for i in range(150)]
    rows += [(2000 + i, words(rng, int(rng.integers(60, 200)), True), "en", "a") for i in range(10)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = {r["doc_id"]: r["kept"] for r in robust.judge(docs, ["doc_id"]).collect()}
    assert {d for d, kept in got.items() if not kept} == {r[0] for r in rows if r[0] >= 1000}


def test_smallest_determinant_of_the_starts(spark):
    """Each group's estimate is no wider than that of any start carried on in numpy."""
    rng = np.random.default_rng(7)
    x = rng.normal(size=(400, 5)) @ rng.normal(size=(5, 5)) * 3
    x[:150] = x[:150] * 0.2 + 8
    rows = spark.createDataFrame([("g", *map(float, v)) for v in x], "grp string, " + ", ".join(
        f"{c} double" for c in robust.COORDINATES))
    est = robust.robust_estimate(rows).collect()
    assert len(est) == 1 and est[0]["fence2"] > 0
    inverse = np.array([[est[0][f"p{min(i, j)}{max(i, j)}"] for j in range(5)] for i in range(5)])
    assert -np.linalg.slogdet(inverse)[1] <= plain_estimate(x)[0] + 1e-2


def test_sweeps_invert(spark):
    """Inverse and determinant of one covariance against numpy."""
    rng = np.random.default_rng(8)
    x = rng.normal(size=(300, 5)) @ rng.normal(size=(5, 5)) * 2 + 3
    rows = spark.createDataFrame([("g", "s", *map(float, v)) for v in x], "grp string, start string, " + ", ".join(
        f"{c} double" for c in robust.COORDINATES))
    got = robust.solved(robust.moments(rows)).first()
    cov = np.cov(x.T, bias=True) + np.diag(np.array(robust.LEAST_SPREAD) ** 2)
    inverse = np.array([[got[f"p{min(i, j)}{max(i, j)}"] for j in range(5)] for i in range(5)])
    assert np.allclose(inverse @ cov, np.eye(5), atol=1e-6) and abs(got["log_det"] - np.linalg.slogdet(cov)[1]) < 1e-6
