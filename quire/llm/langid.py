"""Language identification by a byte convolutional network, trained in numpy.

A text's bytes are cut into fixed-length windows. Every byte has a small vector; filters
of several widths slide over them, each filter's largest answer in the window is kept, and
a softmax over the languages follows. A text's probabilities are its windows' averages,
weighted by their bytes. Windows of many texts go through the network as one batch.

Trained on a bounded sample: about ``SAMPLE_DOCUMENTS`` documents in all, as many of each
language as there are (chosen by a hash of the id), ``WINDOWS_OF_TEXT`` windows of each.
Texts are identified whole. Only texts and non-null languages are learnt from.

Nulls: a null text, or one without a letter, is ``und`` with score 0; so is every text
where there is nothing to learn from. A null doc_id counts as the empty text when folds
are drawn. Repeated ids teach once. An empty table gives no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm.common import held_out, prepare, small_side

LENGTH = 128
WIDTHS = (2, 3, 4)
FILTERS = 8                # of each width
VECTOR = 8                 # numbers a byte
SAMPLE_DOCUMENTS = 6000
WINDOWS_OF_TEXT = 4
EPOCHS = 6
BATCH = 128
RATE = 4e-3
LEAST_DOCUMENTS = 20       # of each language
CHUNK = 256                # windows in one pass
UNKNOWN = "und"


@dataclass
class Network:
    languages: list[str]
    vectors: np.ndarray    # (256, VECTOR)
    filters: np.ndarray    # (widest * VECTOR, filters); narrower ones end in zeros
    bias: np.ndarray
    out: np.ndarray        # (filters, languages)
    out_bias: np.ndarray


def windows(raw: bytes) -> np.ndarray:
    """All of a text's windows, the last filled up with zero bytes."""
    n = max(1, -(-len(raw) // LENGTH))
    out = np.zeros(n * LENGTH, dtype=np.uint8)
    out[:len(raw)] = np.frombuffer(raw, np.uint8)
    return out.reshape(n, LENGTH)


def filter_mask() -> np.ndarray:
    mask = np.zeros((max(WIDTHS) * VECTOR, len(WIDTHS) * FILTERS), dtype=np.float32)
    for i, w in enumerate(WIDTHS):
        mask[:w * VECTOR, i * FILTERS:(i + 1) * FILTERS] = 1
    return mask


def new_network(languages: list[str], rng: np.random.Generator) -> Network:
    f = len(WIDTHS) * FILTERS

    def draw(*shape, scale):
        return rng.normal(0, scale, shape).astype(np.float32)

    return Network(languages, draw(256, VECTOR, scale=0.5),
                   draw(max(WIDTHS) * VECTOR, f, scale=0.25) * filter_mask(), np.zeros(f, np.float32),
                   draw(f, len(languages), scale=0.2), np.zeros(len(languages), np.float32))


def spans(net: Network, codes: np.ndarray) -> np.ndarray:
    """The vectors under the widest filter at every position: (windows, positions, width)."""
    x = net.vectors[codes].reshape(len(codes), LENGTH * VECTOR)
    wide = np.lib.stride_tricks.sliding_window_view(x, max(WIDTHS) * VECTOR, axis=1)[:, ::VECTOR]
    return np.ascontiguousarray(wide)


def pooled(net: Network, wide: np.ndarray) -> np.ndarray:
    return (wide.reshape(-1, wide.shape[2]) @ net.filters).reshape(len(wide), -1, net.filters.shape[1])


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def probabilities(net: Network, codes: np.ndarray) -> np.ndarray:
    """(windows, languages), a bounded number of windows at a time."""
    out = []
    for i in range(0, len(codes), CHUNK):
        hidden = np.maximum(pooled(net, spans(net, codes[i:i + CHUNK])).max(1) + net.bias, 0)
        out.append(softmax(hidden @ net.out + net.out_bias))
    return np.concatenate(out)


def fit(codes: np.ndarray, target: np.ndarray, languages: list[str], epochs: int = EPOCHS, seed: int = 7) -> Network:
    """Adam on the cross-entropy; classes weigh the same however many windows they have."""
    rng = np.random.default_rng(seed)
    net = new_network(languages, rng)
    names = ("vectors", "filters", "bias", "out", "out_bias")
    first = {n: np.zeros_like(getattr(net, n)) for n in names}
    second = {n: np.zeros_like(getattr(net, n)) for n in names}
    mask = filter_mask()
    weight = (len(target) / np.maximum(1, np.bincount(target, minlength=len(languages))) / len(languages))[target]
    steps = 0
    for _ in range(epochs):
        order = rng.permutation(len(codes))
        for i in range(0, len(order), BATCH):
            pick = order[i:i + BATCH]
            c, y = codes[pick], target[pick]
            n = len(pick)
            wide = spans(net, c)
            z = pooled(net, wide)
            at = z.argmax(1)                                              # (n, filters)
            top = np.take_along_axis(z, at[:, None, :], 1)[:, 0] + net.bias
            hidden = np.maximum(top, 0)
            d = softmax(hidden @ net.out + net.out_bias)
            d[np.arange(n), y] -= 1
            d = (d * (weight[pick] / n)[:, None]).astype(np.float32)
            back = (d @ net.out.T) * (top > 0)                            # (n, filters)
            seen = wide[np.arange(n)[:, None], at]                        # (n, filters, width)
            grad = {"out": hidden.T @ d, "out_bias": d.sum(0), "bias": back.sum(0),
                    "filters": np.einsum("nf,nfw->wf", back, seen) * mask}
            into = (back[:, :, None] * net.filters.T).reshape(-1, VECTOR)  # one row a byte under a filter
            under = c[np.arange(n)[:, None, None], at[:, :, None] + np.arange(max(WIDTHS))].ravel()
            grad["vectors"] = np.stack([np.bincount(under, into[:, k], 256) for k in range(VECTOR)], 1)
            steps += 1
            for name in names:
                g = grad[name]
                first[name] = 0.9 * first[name] + 0.1 * g
                second[name] = 0.999 * second[name] + 0.001 * g * g
                move = first[name] / (1 - 0.9 ** steps) / (np.sqrt(second[name] / (1 - 0.999 ** steps)) + 1e-8)
                setattr(net, name, (getattr(net, name) - RATE * move).astype(np.float32))
    return net


def training_windows(docs: DataFrame, total: int = SAMPLE_DOCUMENTS) -> list[tuple[str, bytes]]:
    """(language, window) of the bounded sample, in a fixed order."""
    known = docs.select("doc_id", "text", "lang").where(
        F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id")))
    counts = small_side(known.groupBy("lang").agg(F.count(F.lit(1)).alias("n")), "languages")
    n_languages = counts.count()
    if not n_languages:
        return []
    each = max(LEAST_DOCUMENTS, total // n_languages)
    share = counts.select("lang", (F.lit(float(each)) / F.col("n")).alias("share"))
    draw = F.pmod(F.xxhash64("doc_id", F.lit("language")), F.lit(1 << 30))
    sample = (known.join(share, "lang").where(draw < F.col("share") * (1 << 30))
              .groupBy("doc_id", "lang").agg(F.min("text").alias("text")))
    most = WINDOWS_OF_TEXT

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for d, lang, text in zip(pdf["doc_id"], pdf["lang"], pdf["text"]):
                parts = windows(text.encode("utf-8", "surrogatepass"))
                order = sorted(range(len(parts)), key=lambda i: zlib.crc32(f"{d} {i}".encode()))
                rows += [(lang, parts[i].tobytes()) for i in order[:most]]
            yield pd.DataFrame(rows, columns=["lang", "bytes"])

    got = sample.mapInPandas(run, "lang string, bytes binary").collect()
    return sorted((r["lang"], bytes(r["bytes"])) for r in got)


def train(docs: DataFrame, total: int = SAMPLE_DOCUMENTS) -> Network | None:
    prepare(docs.sparkSession)
    rows = training_windows(docs, total)
    if not rows:
        return None
    languages = sorted({lang for lang, _ in rows})
    codes = np.frombuffer(b"".join(raw for _, raw in rows), np.uint8).reshape(-1, LENGTH)
    place = {lang: i for i, lang in enumerate(languages)}
    return fit(codes, np.array([place[lang] for lang, _ in rows]), languages)


def identify(net: Network, texts: list[str]) -> tuple[list[str], np.ndarray]:
    """Language and probability of each text."""
    raw = [t.encode("utf-8", "surrogatepass") for t in texts]
    parts = [windows(r) for r in raw]
    count = np.array([len(p) for p in parts])
    p = probabilities(net, np.concatenate(parts))
    first = np.cumsum(count) - count
    weight = np.full(len(p), float(LENGTH))
    weight[first + count - 1] = [max(1, len(r) - LENGTH * (len(q) - 1)) for r, q in zip(raw, parts)]
    mean = np.add.reduceat(p * weight[:, None], first) / np.add.reduceat(weight, first)[:, None]
    best = mean.argmax(1)
    return [net.languages[i] for i in best], np.clip(mean[np.arange(len(best)), best], 0, 1)


def with_language(docs: DataFrame, net: Network | None) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``."""
    prepare(docs.sparkSession)
    if net is None:
        return docs.withColumns({"lang_pred": F.lit(UNKNOWN), "score": F.lit(0.0)})

    @F.pandas_udf("lang string, score double")
    def run(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for part in texts:
            out = pd.DataFrame({"lang": [UNKNOWN] * len(part), "score": np.zeros(len(part))})
            held: list[int] = []
            size = 0
            values = part.tolist()
            for i, t in enumerate(values):
                if t is not None:
                    held.append(i)
                    size += len(t)
                if held and (size > 1 << 20 or i == len(values) - 1):
                    names, score = identify(net, [values[k] for k in held])
                    out.loc[held, "lang"] = names
                    out.loc[held, "score"] = score
                    held, size = [], 0
            yield out

    # a letter anywhere: the JVM's own search stops at the first
    spoken = F.when(F.col("text").rlike("\\p{L}"), F.col("text"))
    found = docs.withColumn("__found", run(spoken))
    return found.withColumns({"lang_pred": F.col("__found.lang"), "score": F.col("__found.score")}).drop("__found")
