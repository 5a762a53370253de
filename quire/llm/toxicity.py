"""Toxic passages: maximum-scoring segments of token log-odds, with extreme-value statistics.

A token is a run of letters in lower case. Its score is the log-odds of lying in a toxic
rather than a clean document, from counts of labelled documents under a chain of Dirichlet
priors: the prior of a word is the estimate of its first six letters, theirs that of five,
and so on to three and to the share of toxic documents. So an unknown word has the score of
its longest known beginning. ``COST`` is taken from every token's score, which makes the score
of clean text fall on average.

A linear-time scan finds all maximal-scoring segments of a text. In clean text the best of
n tokens follows an extreme-value law, so K * n * exp(-lambda * S) segments of score S or more
are expected by chance: lambda solves E[exp(lambda * s)] = 1 over the scores of clean tokens, K
is the likeliest one given the best segments of clean documents. Passages that are expected
fewer than ``SIGNIFICANT`` times are returned. A text is summed up by the negated logarithms of
the expectations, of its best segment and of all that are expected less than once; a logistic
calibration turns the two into a score from 0 to 1.

Learnt from is a bounded sample of about ``per_class`` labelled documents of either class, equal
texts of one label counted once, chosen by a hash of the id; words and their beginnings
seen in fewer than two of them are left to their priors. The calibration scores each half of
the sample by what the other half taught. Texts are scored whole. Only texts and labels are
learnt from.

Nulls: a null text is an empty one, which has no segments. Labels without id or toxic, and ids
with both labels, teach nothing; repeated labels count once. With labels of one class only every
score is that class's (0 or 1), with none 0. An empty table gives no rows. Further columns pass
through, unless they are named ``score``, ``predicted`` or ``passages``, which are set.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm.common import materialise, prepare, small_side

TOKEN = re.compile(r"[^\W\d_]+")
PREFIXES = (3, 4, 5, 6)
STRENGTH = 20.0            # pseudo-documents of each prior
COST = 0.7
PER_CLASS = 8000
SIGNIFICANT = 0.05
TOXIC_FROM = 0.3
RIDGE = 1e-4
BINS, WIDTH = 160, 0.125   # of the histogram of token scores, around zero
KNOWN_WORDS = 400_000      # scores that a task remembers


@dataclass(frozen=True)
class Model:
    """Log-odds by word and by beginning, the law's parameters, the calibration; or a constant."""
    words: dict[str, float] | None = None
    starts: dict[str, float] | None = None
    slope: float = 1.0             # lambda
    log_k: float = 0.0
    centre: tuple[float, ...] = (0.0, 0.0)
    scale: tuple[float, ...] = (1.0, 1.0)
    weights: tuple[float, ...] = (0.0, 0.0, 0.0)
    constant: float | None = None


def held_out(doc_id):
    """The fold that is never learnt from: crc32 of the id as text, modulo 4, is 2."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 4 == 2


def tokens(text: str | None) -> list[str]:
    return TOKEN.findall((text or "").lower())


class Scorer:
    """Scores of tokens, remembered. A token that only repeats the one before it tells
    nothing new, and costs."""

    def __init__(self, words: dict[str, float], starts: dict[str, float]):
        self.words, self.starts, self.seen = words, starts, {}

    def look_up(self, word: str) -> float:
        got = self.words.get(word)
        if got is None:
            got = next((self.starts[word[:k]] for k in reversed(PREFIXES)
                        if len(word) >= k and word[:k] in self.starts), 0.0)
        if len(self.seen) >= KNOWN_WORDS:
            self.seen.clear()
        self.seen[word] = got - COST
        return got - COST

    def of(self, found: list[str]) -> np.ndarray:
        get, look_up = self.seen.get, self.look_up
        scores = [get(w) for w in found]
        if None in scores:
            scores = [look_up(w) if s is None else s for w, s in zip(found, scores)]
        out = np.array(scores, dtype=float)
        out[[i for i, (a, b) in enumerate(zip(found, found[1:]), 1) if a == b]] = -COST
        return out


def segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal-scoring segments (first, end, score) of a sequence, in one pass: a new
    positive item joins the nearest segment to its left that starts lower and ends lower
    than it, with all between, until there is none. ``link`` skips those that start higher."""
    total = np.cumsum(scores)
    first, end, low, high, link = [], [], [], [], []
    for p in np.flatnonzero(scores > 0).tolist():
        right = float(total[p])
        left, start = right - float(scores[p]), p
        j = len(low) - 1
        while True:
            while j >= 0 and low[j] >= left:
                j = link[j]
            if j < 0 or high[j] >= right:
                break
            left, start = low[j], first[j]
            for part in (first, end, low, high, link):
                del part[j:]
            j = len(low) - 1
        first.append(start), end.append(p + 1), low.append(left), high.append(right), link.append(j)
    return [(a, b, r - x) for a, b, x, r in zip(first, end, low, high)]


def evidence(found: list[tuple[int, int, float]], n: int, slope: float, log_k: float) -> tuple[float, float]:
    """-log of the expectation of the best segment, and the sum over all; what is expected
    once or more counts nothing."""
    logs = [max(0.0, slope * s - log_k - math.log(n)) for _, _, s in found]
    return max(logs, default=0.0), sum(logs)


def terms(best: float, total: float) -> tuple[float, float]:
    return math.log1p(best), math.log1p(total)


# -- learning

def labelled_sample(docs: DataFrame, labels: DataFrame, per_class: int) -> DataFrame:
    """(toxic, part, weight, text) of the bounded sample, in two parts. weight: labels that
    one sampled label stands for."""
    known = (labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1) & ~held_out(F.col("doc_id")))
             .groupBy("doc_id").agg(F.min("toxic").alias("toxic"), F.max("toxic").alias("other"))
             .where("toxic = other"))
    counts = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    share = F.when(F.col("toxic") == 1, F.lit(per_class / max(1, counts.get(1, 0)))).otherwise(
        F.lit(per_class / max(1, counts.get(0, 0))))
    picked = known.where(F.pmod(F.xxhash64("doc_id", F.lit("toxic")), F.lit(1 << 30)) < share * (1 << 30)).select(
        "doc_id", "toxic", (1.0 / F.least(share, F.lit(1.0))).alias("weight"))
    texts = docs.select("doc_id", "text").join(small_side(picked, "toxic-picked"), "doc_id")
    texts = texts.groupBy("toxic", F.sha2(F.coalesce("text", F.lit("")), 256).alias("same")).agg(
        F.min("text").alias("text"), F.min("weight").alias("weight"))
    return materialise(texts.select("toxic", F.pmod(F.xxhash64("same"), F.lit(2)).alias("part"), "weight", "text"),
                       "toxic-sample")


def document_counts(sample: DataFrame) -> pd.DataFrame:
    """(unit, part, clean, toxic): documents of the sample that hold a word, or (unit ends
    with ``*``) a word that begins so; with fewer than two in all left out. The unit ``*`` is
    every document."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts: Counter = Counter()

        def out() -> pd.DataFrame:
            return pd.DataFrame([(u, p, n * (1 - y), n * y) for (u, p, y), n in counts.items()],
                                columns=["unit", "part", "clean", "toxic"])
        for pdf in batches:
            for y, p, text in zip(pdf["toxic"].tolist(), pdf["part"].tolist(), pdf["text"]):
                held = set(tokens(text))
                units = held | {f"{w[:k]}*" for w in held for k in PREFIXES if len(w) >= k} | {"*"}
                counts.update((u, p, y) for u in units)
                if len(counts) > 1_000_000:
                    yield out()
                    counts.clear()
        yield out()

    found = sample.select("toxic", "part", "text").mapInPandas(run, "unit string, part long, clean long, toxic long")
    found = found.groupBy("unit").agg(*[
        F.sum(F.when(F.col("part") == p, F.col(c)).otherwise(0)).alias(f"{c}{p}")
        for p in (0, 1) for c in ("clean", "toxic")])
    return found.where("clean0 + clean1 + toxic0 + toxic1 >= 2").toPandas().sort_values("unit", ignore_index=True)


def log_odds(units: list[str], clean: np.ndarray, toxic: np.ndarray) -> tuple[dict[str, float], dict[str, float]]:
    """Scores of words and of beginnings. The share of toxic documents among a unit's is
    shrunk to that of the unit one shorter. A word as good as its beginning is left out."""
    count = {u: (c, t) for u, c, t in zip(units, clean.tolist(), toxic.tolist()) if c + t > 0}
    c, t = count.get("*", (0, 0))
    share = {"": (t + 0.5) / (c + t + 1.0)}
    base = math.log(share[""] / (1 - share[""]))

    def score(q: float) -> float:
        return math.log(q / (1 - q)) - base

    def known(word: str) -> float:
        return next((share[word[:k]] for k in reversed(PREFIXES) if len(word) >= k and word[:k] in share), share[""])

    starts, words = {}, {}
    for unit in sorted((u for u in count if u.endswith("*") and u != "*"), key=len):
        c, t = count[unit]
        share[unit[:-1]] = (t + STRENGTH * known(unit[:-2])) / (c + t + STRENGTH)
        starts[unit[:-1]] = score(share[unit[:-1]])
    for unit, (c, t) in count.items():
        if not unit.endswith("*"):
            prior = known(unit)
            got = score((t + STRENGTH * prior) / (c + t + STRENGTH))
            if abs(got - score(prior)) > 0.05:
                words[unit] = got
    return words, starts


def law(histogram: np.ndarray, n: np.ndarray, best: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """(lambda, log K) from the scores of clean tokens and the best segments of clean texts."""
    s = (np.arange(BINS) - BINS // 2 + 0.5) * WIDTH
    top = np.flatnonzero(histogram)[-1] if histogram.any() else 0
    p = histogram.astype(float)
    p[max(top, BINS // 2 + int(2 / WIDTH))] += 0.5 * max(1.0, weight.min(initial=1.0))   # a positive score there must be
    p /= p.sum()
    low, high = 0.0, 64.0
    if (p * s).sum() >= 0:
        high = 1e-3
    for _ in range(80):
        middle = (low + high) / 2
        if (p * np.exp(np.minimum(middle * s, 700))).sum() < 1:
            low = middle
        else:
            high = middle
    slope = max(high, 1e-3)
    events = max(0.5, float((weight * (best > 0)).sum()))
    return slope, math.log(events / max(1.0, float((weight * n * np.exp(-slope * best)).sum())))


def calibrate(x: np.ndarray, y: np.ndarray, weight: np.ndarray):
    """Logistic regression by damped Newton steps, on centred and scaled terms."""
    centre, scale = x.mean(0), np.maximum(x.std(0), 1e-9)
    z = np.column_stack([np.ones(len(x)), (x - centre) / scale])
    weight = weight / weight.sum()
    ridge = np.diag([0.0] + [RIDGE] * x.shape[1])

    def loss(w):
        m = z @ w
        return float((weight * (np.logaddexp(0, m) - y * m)).sum() + w @ ridge @ w / 2)

    w = np.zeros(z.shape[1])
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -35, 35)))
        gradient = z.T @ (weight * (y - p)) - ridge @ w
        step = np.linalg.solve(z.T @ (z * (weight * p * (1 - p))[:, None]) + ridge + 1e-9 * np.eye(len(w)), gradient)
        size = 1.0
        while size > 1e-4 and loss(w + size * step) > loss(w):
            size /= 2
        w = w + size * step
        if np.abs(step).max() < 1e-8:
            break
    return centre, scale, w


def cross_scored(sample: DataFrame, halves: list[tuple[dict, dict]]) -> DataFrame:
    """(toxic, weight, n, scores found by the other half's lexicon as: best, histogram, and the
    segments' scores)."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scorers = [Scorer(*half) for half in halves]
        for pdf in batches:
            rows = []
            for y, p, w, text in zip(pdf["toxic"].tolist(), pdf["part"].tolist(), pdf["weight"].tolist(), pdf["text"]):
                s = scorers[1 - p].of(tokens(text))
                bins = np.clip(np.floor(s / WIDTH).astype(int) + BINS // 2, 0, BINS - 1)
                found = [x for _, _, x in segments(s)]
                rows.append((y, w, len(s), max(found, default=0.0), np.bincount(bins, minlength=BINS).tolist(), found))
            yield pd.DataFrame(rows, columns=["toxic", "weight", "n", "best", "histogram", "found"])

    return materialise(sample.mapInPandas(
        run, "toxic int, weight double, n long, best double, histogram array<long>, found array<double>"), "toxic-scored")


def train(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> Model:
    prepare(docs.sparkSession)
    sample = labelled_sample(docs, labels, per_class)
    classes = {r["toxic"] for r in sample.select("toxic").distinct().collect()}
    if len(classes) < 2:
        return Model(constant=float(max(classes, default=0)))
    counts = document_counts(sample.withColumn("toxic", F.col("toxic").cast("int")))
    units = counts["unit"].tolist()

    def lexicon(*parts: int):
        return log_odds(units, sum(counts[f"clean{p}"] for p in parts).to_numpy(),
                        sum(counts[f"toxic{p}"] for p in parts).to_numpy())

    scored = cross_scored(sample, [lexicon(0), lexicon(1)])
    clean = scored.where("toxic = 0")
    histogram = np.zeros(BINS)
    for r in clean.select("weight", F.posexplode("histogram")).groupBy("pos").agg(
            F.sum(F.col("col") * F.col("weight")).alias("n")).collect():
        histogram[r["pos"]] = r["n"]
    rows = clean.select("weight", "n", "best").toPandas()
    slope, log_k = law(histogram, rows["n"].to_numpy(), rows["best"].to_numpy(), rows["weight"].to_numpy())
    log_n = F.log(F.greatest(F.col("n"), F.lit(1)).cast("double"))
    logs = F.transform("found", lambda s: F.greatest(F.lit(0.0), s * slope - log_k - log_n))
    features = scored.select("toxic", "weight", F.coalesce(F.array_max(logs), F.lit(0.0)).alias("best"),
                             F.aggregate(logs, F.lit(0.0), lambda a, x: a + x).alias("total")).toPandas()
    features = features.sort_values(features.columns.tolist(), ignore_index=True)
    x = np.log1p(features[["best", "total"]].to_numpy())
    centre, scale, w = calibrate(x, features["toxic"].to_numpy(dtype=float), features["weight"].to_numpy())
    words, starts = lexicon(0, 1)
    return Model(words, starts, slope, log_k, tuple(centre.tolist()), tuple(scale.tolist()), tuple(w.tolist()))


# -- scoring

def passages_of(text: str, found: list[tuple[int, int, float]], n: int, model: Model) -> list[dict]:
    """Places (in code points of the text in lower case), words, scores and expectations of the
    significant segments."""
    kept = [(a, b, s, math.exp(min(700.0, model.log_k + math.log(n) - model.slope * s))) for a, b, s in found]
    kept = [x for x in kept if x[3] < SIGNIFICANT]
    if not kept:
        return []
    lowered = text.lower()
    spans = [m.span() for m in TOKEN.finditer(lowered)]
    return [{"start": spans[a][0], "end": spans[b - 1][1], "words": lowered[spans[a][0]:spans[b - 1][1]],
             "score": s, "expected": e} for a, b, s, e in kept]


def probability(model: Model, best: float, total: float) -> float:
    m = model.weights[0] + sum(w * (t - c) / k for w, t, c, k in
                               zip(model.weights[1:], terms(best, total), model.centre, model.scale))
    return 1 / (1 + math.exp(-max(-35.0, min(35.0, m))))


PASSAGES = "array<struct<start: int, end: int, words: string, score: double, expected: double>>"


def scores_udf(model: Model, passages: bool):
    fields = f"score double, passages {PASSAGES}" if passages else "score double"

    @F.pandas_udf(fields)
    def run(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        scorer = Scorer(model.words, model.starts)
        for part in texts:
            rows = []
            for text in part:
                s = scorer.of(tokens(text))
                found = segments(s)
                p = probability(model, *evidence(found, max(1, len(s)), model.slope, model.log_k))
                rows.append((p, passages_of(text, found, len(s), model)) if passages else (p,))
            yield pd.DataFrame(rows, columns=["score", "passages"][:1 + passages])
    return run


def with_toxicity(docs: DataFrame, model: Model, passages: bool = True) -> DataFrame:
    """``docs`` with ``score``, ``predicted`` (1 from ``TOXIC_FROM`` on) and ``passages``."""
    prepare(docs.sparkSession)
    if model.constant is not None:
        out = docs.withColumn("score", F.lit(model.constant))
        if passages:
            out = out.withColumn("passages", F.array().cast(PASSAGES))
    else:
        got = docs.withColumn("__toxic", scores_udf(model, passages)("text"))
        out = got.withColumn("score", F.col("__toxic.score"))
        if passages:
            out = out.withColumn("passages", F.col("__toxic.passages"))
        out = out.drop("__toxic")
    return out.withColumn("predicted", (F.col("score") >= TOXIC_FROM).cast("int"))
