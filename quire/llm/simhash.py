"""Near duplicates by SimHash, found by meet-in-the-middle ball hashing.

Fingerprints that differ in at most three bits must be linked. Each distinct fingerprint
emits the variants of itself within half that distance; two fingerprints whose variants
coincide collide. Half of three is one and a half, so one side has to go one bit and the
other two, and the parity of the bit count tells the sides apart:

* differences of one or two bits: both sides emit all variants with one bit flipped;
* a difference of three bits joins an even and an odd fingerprint. Two of the three bits
  lie in the same half of the word, so it is enough that odd fingerprints also emit the
  variants with two bits of the same half flipped; the even side flips the third.

So a fingerprint emits 65 or 1057 variants whatever the number of documents. Variants are
spread by an invertible mix, dealt to buckets in packed blocks, and sorted per bucket.
All fingerprints that emit a variant with at most one flip lie within three bits of every
other emitter of it: each group of colliding emitters is linked to one of those, never
pair by pair, and the difference of every link is verified. (Two emitters with two flips
each differ by two bits, which single flips find, or by more than three.)

Links are reduced inside each bucket to a spanning forest; connected components are then
found by alternating large-star and small-star steps on tables in the shared folder.
Copies share a fingerprint and enter the graph once. Nothing is collected.

Nulls: a null text has no words, so fingerprint zero, linked like any other; a null doc_id
gets its component and never names one while another id is there. Repeated rows are
copies. An empty table gives an empty result. Further columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.llm.common import join_unique, materialise, prepare

SHINGLE = 3
SEED = 42
DISTANCE = 3
BUCKET_BYTES = 4 << 20
TASK_BUCKETS = 4         # buckets of one task, whatever their number
TASK_FINGERPRINTS = 20_000
CHUNK = 4096             # fingerprints expanded at once
MIX = np.uint64(0x9E3779B97F4A7C15)


def fingerprint(text: str | None, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """64-bit SimHash of the word shingles of a text, with repeats; zero without words."""
    from xxhash import xxh64_intdigest
    if not text:
        return 0
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    if len(words) <= shingle:
        return xxh64_intdigest(b" ".join(words), seed)
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.concatenate([[0], ends[:len(words) - shingle]]).tolist()
    stops = (ends[shingle - 1:] - 1).tolist()
    votes = np.zeros(64, dtype=np.int64)
    for i in range(0, len(starts), 1 << 16):
        hashes = np.array([xxh64_intdigest(line[a:b], seed)
                           for a, b in zip(starts[i:i + (1 << 16)], stops[i:i + (1 << 16)])], dtype=">u8")
        votes += np.unpackbits(hashes.view(np.uint8)).reshape(-1, 64).sum(0, dtype=np.int64)
    bits = np.packbits(2 * votes > len(starts))
    return int.from_bytes(bits.tobytes(), "big")


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, text_hash, fp): fp is the fingerprint as a signed long. doc_id and
    text_hash together name a row up to exact copies of it."""
    prepare(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = np.array([fingerprint(t.as_py(), shingle) for t in b.column(2)], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(fp.view(np.int64))],
                                             ["doc_id", "text_hash", "fp"])

    return docs.select("doc_id", row_hash().alias("text_hash"), "text").mapInArrow(
        run, "doc_id long, text_hash long, fp long")


def row_hash():
    return F.xxhash64(F.col("text"))


def mix(x: np.ndarray) -> np.ndarray:
    """An invertible spread of 64-bit words; the same word always goes the same way."""
    x = x ^ (x >> np.uint64(32))
    x = x * MIX
    return x ^ (x >> np.uint64(29))


def flips() -> tuple[np.ndarray, np.ndarray]:
    """The bit masks of one flip (with none first), and of two flips in the same half."""
    bit = np.uint64(1) << np.arange(64, dtype=np.uint64)
    one = np.concatenate([[np.uint64(0)], bit])
    two = [bit[i] | bit[j] for h in (0, 32) for i in range(h, h + 32) for j in range(i + 1, h + 32)]
    return one, np.array(two, dtype=np.uint64)


def variants(fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All variants of the fingerprints, and for each the number of its mask."""
    one, two = flips()
    odd = fp[np.bitwise_count(fp) % 2 == 1]
    near = fp[:, None] ^ one
    far = odd[:, None] ^ two
    code = np.concatenate([np.broadcast_to(np.arange(65), near.shape).ravel(),
                           np.broadcast_to(np.arange(65, 65 + len(two)), far.shape).ravel()])
    return np.concatenate([near.ravel(), far.ravel()]), code.astype(np.uint16)


def star_links(word: np.ndarray, code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links among the emitters of equal variants, each group's to its first emitter with
    at most one flip, verified and without repeats."""
    order = np.lexsort((code, word))
    word, code = word[order], code[order]
    start = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
    size = np.diff(np.append(start, len(word)))
    mask = np.concatenate(flips())
    fp = word ^ mask[code]
    hub = np.repeat(start, size)
    linked = (np.arange(len(word)) != hub) & (code[hub] < 65)
    a, b = fp[hub[linked]], fp[linked]
    near = (np.bitwise_count(a ^ b) <= DISTANCE) & (a != b)
    pairs = np.unique(np.stack([np.minimum(a[near], b[near]), np.maximum(a[near], b[near])], 1), axis=0)
    return pairs[:, 0], pairs[:, 1]


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each node of the links, the smallest node it is connected to by them."""
    nodes, ab = np.unique(np.concatenate([a, b]), return_inverse=True)
    a, b = ab[:len(a)], ab[len(a):]
    root = np.arange(len(nodes))
    while True:
        low = np.minimum(root[a], root[b])
        np.minimum.at(root, root[a], low)
        np.minimum.at(root, root[b], low)
        while (root[root] != root).any():
            root = root[root]
        if (root[a] == root[b]).all():
            break
    child = np.flatnonzero(root != np.arange(len(nodes)))
    return nodes[root[child]], nodes[child]


def ball_links(fps: DataFrame, n_rows: int) -> DataFrame:
    """(a, b): links between distinct fingerprints within three bits, enough to connect
    all that are connected. ``fps`` has one row a fingerprint, in column fp."""
    prepare(fps.sparkSession)
    n_buckets = 1 << max(3, math.ceil(math.log2(max(1, n_rows) * 561 * 10 / BUCKET_BYTES + 1)))
    shift = np.uint64(64 - int(math.log2(n_buckets)))

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        for b in batches:
            held.append(b.column(0).to_numpy(zero_copy_only=False).view(np.uint64))
            if sum(map(len, held)) >= CHUNK:
                yield from blocks(np.concatenate(held))
                held = []
        if held:
            yield from blocks(np.concatenate(held))

    def blocks(fp: np.ndarray) -> Iterator[pa.RecordBatch]:
        for i in range(0, len(fp), CHUNK):
            word, code = variants(fp[i:i + CHUNK])
            bucket = (mix(word) >> shift).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            word, code, bucket = word[order], code[order], bucket[order]
            start = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
            ends = np.append(start[1:], len(word))
            yield pa.RecordBatch.from_arrays(
                [pa.array(bucket[start]),
                 pa.array([word[a:b].tobytes() for a, b in zip(start, ends)], pa.binary()),
                 pa.array([code[a:b].tobytes() for a, b in zip(start, ends)], pa.binary())],
                ["bucket", "words", "codes"])

    def collide(pdf: pd.DataFrame) -> pd.DataFrame:
        a, b = star_links(np.frombuffer(b"".join(pdf["words"]), np.uint64),
                          np.frombuffer(b"".join(pdf["codes"]), np.uint16))
        if len(a):
            a, b = forest(a, b)
        return pd.DataFrame({"a": a.view(np.int64), "b": b.view(np.int64)})

    # each fingerprint becomes thousands of bytes: many tasks, however few bytes come in
    spread = fps.select("fp").repartition(max(1, math.ceil(n_rows / TASK_FINGERPRINTS)))
    return (spread.mapInArrow(emit, "bucket long, words binary, codes binary")
            .repartition(n_buckets // TASK_BUCKETS, "bucket").groupBy("bucket").applyInPandas(collide, "a long, b long"))


def components(links: DataFrame) -> DataFrame:
    """(node, root): for each node of the links (a, b), the smallest node connected to it.
    Alternating large-star and small-star steps; each step's table is written, and the
    steps end when one changes nothing. A node may have any number of links: those of a node
    with a large share of them are not gathered in one task."""
    edges = materialise(links.where("a <> b").select(
        F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links")
    while True:
        both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = (_with_least(both, F.least(F.min("v"), F.col("u"))).where("v > u")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct())
        large = materialise(large, "links-large")
        small = _with_least(large, F.min("v")).select(
            F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v"))
        small = materialise(small.where("u <> v").distinct(), "links-small")
        if not _changed(edges, small):
            return small.select(F.col("u").alias("node"), F.col("v").alias("root")).unionAll(
                small.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
        edges = small


def _with_least(edges: DataFrame, least: Column) -> DataFrame:
    """Stored links (u, v) with ``m``, the aggregate ``least`` of all links of u."""
    low = materialise(edges.groupBy("u").agg(least.alias("m"), F.count(F.lit(1)).alias("n")), "links-least")
    total = low.agg(F.sum("n")).first()[0] or 0
    return join_unique(edges, low.select("u", "m"), ["u"], low.select("u", "n"), total)


def _changed(before: DataFrame, after: DataFrame) -> bool:
    """Whether two sets of links differ, by count and by sums of two hashes of each link."""
    def digest(df: DataFrame):
        return df.agg(F.count(F.lit(1)), *[F.sum(F.shiftright(F.xxhash64("u", "v", F.lit(s)), 16))
                                           for s in (1, 2)]).first()
    return tuple(digest(before)) != tuple(digest(after))


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, text_hash, fp, component_id) of every row: component_id is the smallest
    doc_id among all rows connected to it."""
    rows = materialise(fingerprints(docs, shingle), "fingerprints")
    nodes = rows.groupBy("fp").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("n"))
    nodes = materialise(nodes, "distinct-fingerprints")
    n_nodes, n_rows = nodes.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    roots = components(ball_links(nodes, n_nodes))
    placed = nodes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root"))
    placed = materialise(placed, "placed-fingerprints")
    low = materialise(placed.groupBy("root").agg(
        F.min("first").alias("component_id"), F.count(F.lit(1)).alias("n")), "component-ids")
    named = materialise(join_unique(placed, low.select("root", "component_id"), ["root"], low.select("root", "n"), n_nodes)
                        .select("fp", "component_id"), "named-fingerprints")
    return join_unique(rows, named, ["fp"], nodes.select("fp", "n"), n_rows).select(
        "doc_id", "text_hash", "fp", "component_id")


def keep_one_of_each(docs: DataFrame) -> DataFrame:
    """The row with the smallest doc_id of each component, all columns as they were. Of
    rows that repeat both doc_id and text one stays."""
    found = near_duplicates(docs).withColumn("__simhash_id", F.coalesce("doc_id", F.lit(-1)))
    first = (found.groupBy("component_id", "__simhash_id", "text_hash").agg(F.count(F.lit(1)).alias("n"))
             .groupBy("component_id")
             .agg(F.min(F.struct(F.col("__simhash_id") == -1, "__simhash_id", F.col("text_hash").alias("__simhash_text"), "n")).alias("k"))
             .select("k.__simhash_id", "k.__simhash_text", "k.n"))
    first = materialise(first, "kept-ids")
    rows = (docs.withColumn("__simhash_id", F.coalesce("doc_id", F.lit(-1))).withColumn("__simhash_text", row_hash())
            .join(first.select("__simhash_id", "__simhash_text"), ["__simhash_id", "__simhash_text"], "left_semi"))
    if first.where("n > 1").limit(1).count():
        rows = rows.dropDuplicates(["__simhash_id", "__simhash_text"])
    return rows.select(docs.columns)
