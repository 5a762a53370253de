"""Compression classifier: Zstandard dictionaries of good and of bad text.

Two dictionaries are built from blocks of labelled texts. A text is cut into blocks, each
block is compressed on its own with either dictionary and with none, and the sizes are
summed. The difference of the two dictionaries' sizes, over the plain size, says which
kind of text it resembles; the plain size over the text's bytes says how redundant it is.
A logistic calibration on further labelled texts turns the difference, given the
redundancy, into a score from 0 (bad) to 1 (good).

What is learnt from is bounded: about ``per_class`` labelled documents of either class for
the dictionaries and as many for the calibration (chosen by a hash of the id, so alike at
every size), and of each dictionary document ``blocks_of_text`` blocks. Texts are scored
whole. Only texts and labels are learnt from; ids choose the sample and nothing else.

Nulls: a null text is scored as the empty text, whose block has no bytes. Labels without
id or quality, and ids with both labels, teach nothing; repeated labels count once. With
labels of one class only every score is that class's (0 or 1), with none 0.5. An empty
table gives no rows. Further columns pass through ``with_scores`` unless they are named
``score`` or ``predicted``, which it sets.
"""

from __future__ import annotations

import functools
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.llm.common import held_out, materialise, prepare

BLOCK = 4096
PER_CLASS = 4000
BLOCKS_OF_TEXT = 2
DICTIONARY_BYTES = 112 << 10
LEVEL = 3
RIDGE = 1e-4


@dataclass(frozen=True)
class Model:
    """Dictionaries (bad, good), feature centres and scales, weights; or a constant."""
    dictionaries: tuple[bytes, bytes] = (b"", b"")
    centre: tuple[float, ...] = ()
    scale: tuple[float, ...] = ()
    weights: tuple[float, ...] = ()
    constant: float | None = None


def blocks(text: str | None, size: int = BLOCK) -> list[bytes]:
    raw = (text or "").encode("utf-8", "surrogatepass")
    return [raw[i:i + size] for i in range(0, max(1, len(raw)), size)]


@functools.lru_cache(maxsize=4)
def compressors(dictionaries: tuple[bytes, bytes]):
    import zstandard
    plain = {"level": LEVEL, "write_content_size": False, "write_checksum": False, "write_dict_id": False}
    out = [zstandard.ZstdCompressor(**plain)]
    for raw in dictionaries:
        d = zstandard.ZstdCompressionDict(raw)
        d.precompute_compress(level=LEVEL)
        out.append(zstandard.ZstdCompressor(dict_data=d, **plain))
    return [c.compress for c in out]


def sizes(text: str | None, dictionaries: tuple[bytes, bytes]) -> tuple[float, float]:
    """(difference of the dictionaries' sizes over the plain size, plain size over bytes)."""
    plain, bad, good = compressors(dictionaries)
    parts = blocks(text)
    n_plain = sum(len(plain(b)) for b in parts)
    difference = sum(len(bad(b)) for b in parts) - sum(len(good(b)) for b in parts)
    return difference / n_plain, n_plain / max(1, sum(map(len, parts)))


def sizes_udf(dictionaries: tuple[bytes, bytes]):
    @F.pandas_udf("difference double, redundancy double")
    def run(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for part in texts:
            got = np.array([sizes(t, dictionaries) for t in part], dtype=float).reshape(-1, 2)
            yield pd.DataFrame(got, columns=["difference", "redundancy"])
    return run


def terms(d, r) -> list:
    """The calibration's terms: the difference, the redundancy, and their products."""
    return [d, r, d * r, d * d, r * r]


def labelled_sample(docs: DataFrame, labels: DataFrame, per_class: int) -> DataFrame:
    """(doc_id, quality, part, weight, text) of the bounded sample; part 0 makes the
    dictionaries, part 1 the calibration. weight: labels that one sampled label stands for."""
    known = (labels.where(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1) & ~held_out(F.col("doc_id")))
             .groupBy("doc_id").agg(F.min("quality").alias("quality"), F.max("quality").alias("other"))
             .where("quality = other"))
    counts = {r["quality"]: r["count"] for r in known.groupBy("quality").count().collect()}
    share = F.when(F.col("quality") == 1, F.lit(2.0 * per_class / max(1, counts.get(1, 0)))).otherwise(
        F.lit(2.0 * per_class / max(1, counts.get(0, 0))))
    picked = known.where(F.pmod(F.xxhash64("doc_id", F.lit("sample")), F.lit(1 << 30)) < share * (1 << 30)).select(
        "doc_id", "quality", F.pmod(F.xxhash64("doc_id", F.lit("part")), F.lit(2)).alias("part"),
        (1.0 / F.least(share, F.lit(1.0))).alias("weight"))
    # at most about four times per_class rows of four numbers; one text an id, however often it is repeated
    texts = (docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id")
             .groupBy("doc_id", "quality", "part", "weight").agg(F.min("text").alias("text")))
    return materialise(texts, "quality-sample")


def dictionary_blocks(sample: DataFrame) -> dict[int, list[bytes]]:
    """Blocks of the dictionary documents by class, chosen by a hash of document and block."""
    size, most = BLOCK, BLOCKS_OF_TEXT

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for d, q, t in zip(pdf["doc_id"], pdf["quality"], pdf["text"]):
                parts = blocks(t, size)
                order = sorted(range(len(parts)), key=lambda i: zlib.crc32(f"{d} {i}".encode()))
                rows += [(d, q, parts[i]) for i in order[:most] if parts[i]]
            yield pd.DataFrame(rows, columns=["doc_id", "quality", "block"])

    out: dict[int, list[bytes]] = {0: [], 1: []}
    for r in sorted(sample.where("part = 0").select("doc_id", "quality", "text")
                    .mapInPandas(run, "doc_id long, quality int, block binary").collect()):
        out[r["quality"]].append(bytes(r["block"]))
    return out


def build_dictionary(samples: list[bytes]) -> bytes:
    """A trained dictionary; where there is too little to train on, the samples themselves."""
    import zstandard
    try:
        size = min(DICTIONARY_BYTES, max(1024, sum(map(len, samples)) // 4))
        return zstandard.train_dictionary(size, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-DICTIONARY_BYTES:]


def calibrate(x: np.ndarray, y: np.ndarray, weight: np.ndarray):
    """Logistic regression by damped Newton steps, on centred and scaled terms."""
    centre, scale = x.mean(0), np.maximum(x.std(0), 1e-9)
    z = np.column_stack([np.ones(len(x)), (x - centre) / scale])
    weight = weight / weight.sum()
    w = np.zeros(z.shape[1])
    ridge = RIDGE * np.eye(len(w))

    def loss(w):
        m = z @ w
        return float((weight * (np.logaddexp(0, m) - y * m)).sum() + RIDGE / 2 * w @ w)

    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -35, 35)))
        gradient = z.T @ (weight * (y - p)) - RIDGE * w
        step = np.linalg.solve(z.T @ (z * (weight * p * (1 - p))[:, None]) + ridge, gradient)
        size = 1.0
        while size > 1e-4 and loss(w + size * step) > loss(w):
            size /= 2
        w = w + size * step
        if np.abs(step).max() < 1e-8:
            break
    return centre, scale, w


def train(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> Model:
    prepare(docs.sparkSession)
    sample = labelled_sample(docs, labels, per_class)
    found = dictionary_blocks(sample)
    if not found[0] or not found[1]:
        return Model(constant=1.0 if found[1] else 0.0 if found[0] else 0.5)
    dictionaries = (build_dictionary(found[0]), build_dictionary(found[1]))
    rows = (sample.where("part = 1")
            .select("doc_id", "quality", "weight", sizes_udf(dictionaries)("text").alias("s"))
            .select("doc_id", "quality", "weight", "s.*").collect())
    rows.sort()
    y = np.array([r["quality"] for r in rows], dtype=float)
    if not 0 < y.sum() < len(y):
        return Model(dictionaries, (0.0,) * 5, (1.0,) * 5, (0.0, 10.0, 0.0, 0.0, 0.0, 0.0))
    x = np.array([terms(r["difference"], r["redundancy"]) for r in rows])
    centre, scale, w = calibrate(x, y, np.array([r["weight"] for r in rows]))
    return Model(dictionaries, tuple(centre.tolist()), tuple(scale.tolist()), tuple(w.tolist()))


def score_column(model: Model, s: Column) -> Column:
    """The calibrated score of a text whose sizes are in ``s``."""
    logit = F.lit(model.weights[0])
    for t, c, k, w in zip(terms(s["difference"], s["redundancy"]), model.centre, model.scale, model.weights[1:]):
        logit = logit + (t - F.lit(c)) / F.lit(k) * F.lit(w)
    return F.lit(1.0) / (F.lit(1.0) + F.exp(F.greatest(F.lit(-35.0), F.least(F.lit(35.0), -logit))))


def with_scores(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with ``score`` and ``predicted`` (1 from 0.5 on)."""
    prepare(docs.sparkSession)
    if model.constant is not None:
        out = docs.withColumn("score", F.lit(model.constant))
    else:
        sized = docs.withColumn("__sizes", sizes_udf(model.dictionaries)("text"))
        out = sized.withColumn("score", score_column(model, F.col("__sizes"))).drop("__sizes")
    return out.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def keep_good(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs`` that the classifier does not reject, columns as they were. Where all
    labels are of one class, there is nothing to tell documents apart by, and none is rejected."""
    prepare(docs.sparkSession)
    if model.constant is not None:
        return docs
    sized = docs.withColumn("__sizes", sizes_udf(model.dictionaries)("text"))
    return sized.where(score_column(model, F.col("__sizes")) >= 0.5).drop("__sizes")
