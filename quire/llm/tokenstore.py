"""Token files: frequency-ranked ids in byte-aligned variable-length coding.

Ids are ranked by their count over all documents, so that the commonest take one byte.
A rank takes one to four bytes; its length minus one is two bits, four ids to a control
byte, and control bytes are kept apart from the data bytes. A reader looks the four
lengths of each control byte up in a table, so decoding is a handful of numpy calls.

A file is a run of blocks, each followed by a line feed (the files are written by
Spark's own text writer, which copies bytes as they are and commits them task by task):

    magic "QTS1", then little-endian u32: kind, documents, ids, data bytes
    kind 0: ids by rank (u32 each), first in every file
    kind 1: doc_id (i64 each), null flags (u8 each), lengths (u32 each), control, data

Files follow each other in ascending doc_id order (part number order). Null ids come
first; rows of equal doc_id are in order of length and checksum, and so adjacent.

Nulls: a null text is empty (only the end id). Very long texts make a block of their own
size. An empty table gives no documents. Further columns of the input are ignored.
"""

from __future__ import annotations

import math
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quire.llm.common import fresh_path, materialise, prepare
from quire.llm.tokens import tokenizer

END_ID = 2
BLOCK_IDS = 1 << 18
FILE_IDS = 8_000_000
HEAD = struct.Struct("<4sIIII")
MAGIC = b"QTS1"

LENGTHS = np.array([[(c >> 2 * i & 3) + 1 for i in range(4)] for c in range(256)], dtype=np.uint8)


def encode_ranks(ranks: np.ndarray) -> tuple[bytes, bytes]:
    """(control bytes, data bytes) of an array of ranks."""
    ranks = np.ascontiguousarray(ranks, dtype="<u4")
    size = 1 + (ranks > 0xFF) + (ranks > 0xFFFF) + (ranks > 0xFFFFFF)
    codes = np.zeros(-(-len(ranks) // 4) * 4, dtype=np.uint8)
    codes[:len(ranks)] = size - 1
    control = (codes.reshape(-1, 4) << np.array([0, 2, 4, 6], dtype=np.uint8)).sum(1, dtype=np.uint8)
    data = ranks.view(np.uint8).reshape(-1, 4)[np.arange(4) < size[:, None]]
    return control.tobytes(), data.tobytes()


def decode_ranks(control: bytes, data: bytes, n: int) -> np.ndarray:
    size = LENGTHS[np.frombuffer(control, np.uint8)].reshape(-1)[:n].astype(np.int64)
    start = np.cumsum(size) - size
    raw = np.concatenate([np.frombuffer(data, np.uint8), np.zeros(3, np.uint8)])
    out = raw[start].astype(np.uint32)
    for k in range(1, 4):
        at = np.flatnonzero(size > k)
        out[at] |= raw[start[at] + k].astype(np.uint32) << np.uint32(8 * k)
    return out


def table_block(by_rank: np.ndarray) -> bytes:
    data = np.ascontiguousarray(by_rank, "<u4").tobytes()
    return HEAD.pack(MAGIC, 0, 0, len(by_rank), len(data)) + data


def document_block(doc_ids: list[int | None], ids: list[np.ndarray], rank_of: np.ndarray) -> bytes:
    control, data = encode_ranks(rank_of[np.concatenate(ids)])
    lengths = np.array([len(x) for x in ids], dtype="<u4")
    return b"".join([
        HEAD.pack(MAGIC, 1, len(ids), int(lengths.sum()), len(data)),
        np.array([d or 0 for d in doc_ids], dtype="<i8").tobytes(),
        np.array([d is None for d in doc_ids], dtype=np.uint8).tobytes(),
        lengths.tobytes(), control, data])


def read_blocks(raw: bytes) -> Iterator[tuple[list[int | None], list[np.ndarray]]]:
    """Documents of one file: their ids and the arrays of token ids, block by block."""
    at, by_rank = 0, np.empty(0, np.uint32)
    while at < len(raw):
        magic, kind, n_docs, n_ids, n_data = HEAD.unpack_from(raw, at)
        if magic != MAGIC:
            raise ValueError(f"no block at byte {at}")
        at += HEAD.size
        if kind == 0:
            by_rank = np.frombuffer(raw, "<u4", n_ids, at)
            at += n_data + 1
            continue
        keys = np.frombuffer(raw, "<i8", n_docs, at).tolist()
        null = np.frombuffer(raw, np.uint8, n_docs, at + 8 * n_docs)
        lengths = np.frombuffer(raw, "<u4", n_docs, at + 9 * n_docs)
        at += 13 * n_docs
        n_control = -(-n_ids // 4)
        ranks = decode_ranks(raw[at:at + n_control], raw[at + n_control:at + n_control + n_data], n_ids)
        at += n_control + n_data + 1
        yield ([None if z else k for k, z in zip(keys, null)],
               np.split(by_rank[ranks], np.cumsum(lengths)[:-1]))


def tokenise(docs: DataFrame, vocabulary: str, end_id: int = END_ID) -> DataFrame:
    """One row a document (ids as bytes, with a row number that makes ties stable) and
    one row a partition with the counts of its ids; written once, in the shared folder."""
    prepare(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        words = tokenizer(vocabulary)
        row = TaskContext.get().partitionId() << 33
        counts = np.zeros(max(words.tok.get_vocab_size(), end_id + 1), dtype=np.int64)
        tail = np.array([end_id], np.uint32)
        for b in batches:
            for i in range(0, b.num_rows, 256):
                part = b.slice(i, 256)
                ids = [np.concatenate([x, tail]) for x in words.encode_many(part.column(1).to_pylist())]
                counts += np.bincount(np.concatenate(ids), minlength=len(counts))
                yield pa.RecordBatch.from_arrays([
                    part.column(0), pa.array(range(row, row + len(ids)), pa.int64()),
                    pa.array([len(x) for x in ids], pa.int64()),
                    pa.array([zlib.crc32(x) for x in ids], pa.int64()),
                    pa.array([x.astype(words.kind).tobytes() for x in ids], pa.binary()),
                    pa.nulls(len(ids), pa.binary())], names)
                row += len(ids)
        used = np.flatnonzero(counts)
        if len(used):
            pairs = np.stack([used, counts[used]], 1).astype("<i8")
            yield pa.RecordBatch.from_arrays([
                pa.nulls(1, pa.int64()), pa.array([row], pa.int64()), pa.array([0], pa.int64()),
                pa.array([0], pa.int64()), pa.nulls(1, pa.binary()),
                pa.array([pairs.tobytes()], pa.binary())], names)

    names = ["doc_id", "row", "n_tokens", "ids_crc32", "ids", "counts"]
    out = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        run, "doc_id long, row long, n_tokens long, ids_crc32 long, ids binary, counts binary")
    return materialise(out, "token-ids")


def rank_ids(tokens: DataFrame) -> np.ndarray:
    """All used ids by falling count (ties by id): at most one entry per vocabulary
    entry, which bounds what the driver gets."""
    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for raw in b.column(0).to_pylist():
                got = np.frombuffer(raw, "<i8").reshape(-1, 2)
                yield pa.RecordBatch.from_arrays([pa.array(got[:, 0]), pa.array(got[:, 1])], ["id", "n"])

    rows = (tokens.where(F.col("counts").isNotNull()).select("counts")
            .mapInArrow(pairs, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).collect())
    return np.array([r["id"] for r in sorted(rows, key=lambda r: (-r["n"], r["id"]))], dtype=np.uint32)


def write_token_files(tokens: DataFrame, path: str, vocabulary: str, file_ids: int = FILE_IDS) -> None:
    """Write all documents of ``tokens`` to ``path`` in ascending doc_id order."""
    by_rank = rank_ids(tokens)
    rank_of = np.zeros(int(by_rank.max()) + 1 if len(by_rank) else 1, dtype=np.uint32)
    rank_of[by_rank] = np.arange(len(by_rank), dtype=np.uint32)
    docs = tokens.where(F.col("ids").isNotNull()).drop("counts")
    total = docs.agg(F.sum("n_tokens")).first()[0] or 0
    n_files = max(1, math.ceil(total / file_ids))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = tokenizer(vocabulary).kind
        keys: list[int | None] = []
        ids: list[np.ndarray] = []
        held, first = 0, True
        for b in batches:
            for key, raw in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if first:
                    first = False
                    yield block(table_block(by_rank))
                keys.append(key)
                ids.append(np.frombuffer(raw, kind))
                held += len(ids[-1])
                if held >= BLOCK_IDS:
                    yield block(document_block(keys, ids, rank_of))
                    keys, ids, held = [], [], 0
        if keys:
            yield block(document_block(keys, ids, rank_of))

    def block(raw: bytes) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([raw], pa.binary())], ["block"])

    (docs.repartitionByRange(n_files, "doc_id", "n_tokens", "ids_crc32", "row")
     .sortWithinPartitions("doc_id", "n_tokens", "ids_crc32", "row").select("doc_id", "ids")
     .mapInArrow(run, "block binary").select(F.col("block").cast("string"))
     .write.option("lineSep", "\n").text(path))


def read_token_files(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """Documents read back from the files, with the number of ids in all before them."""
    prepare(spark)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for name, raw in zip(b.column(0).to_pylist(), b.column(1)):
                before = 0
                for keys, ids in read_blocks(raw.as_buffer().to_pybytes()):
                    n = np.array([len(x) for x in ids], dtype=np.int64)
                    arrays = [
                        pa.array([name.rsplit("/", 1)[-1]] * len(keys)), pa.array(keys, pa.int64()),
                        pa.array(before + np.cumsum(n) - n), pa.array(n),
                        pa.array([zlib.crc32(np.ascontiguousarray(x, "<u4")) for x in ids], pa.int64())]
                    if with_ids:
                        arrays.append(pa.array([x.tolist() for x in ids], pa.list_(pa.int64())))
                    yield pa.RecordBatch.from_arrays(arrays, names)
                    before += int(n.sum())

    names = ["file", "doc_id", "local_start", "n_tokens", "ids_crc32"] + (["ids"] if with_ids else [])
    schema = "file string, doc_id long, local_start long, n_tokens long, ids_crc32 long"
    docs = (spark.read.format("binaryFile").load(path).select("path", "content")
            .mapInArrow(run, schema + (", ids array<long>" if with_ids else "")))
    docs = materialise(docs, "token-digest") if not with_ids else docs
    # one row a file: the files' first numbers are sums over a short list
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    first = (docs.groupBy("file").agg(F.sum("n_tokens").alias("n"))
             .select("file", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first")))
    return (docs.join(first, "file").withColumn("start", F.col("first") + F.col("local_start"))
            .select("doc_id", "start", "n_tokens", "ids_crc32", *(["ids"] if with_ids else [])))


def store_documents(docs: DataFrame, vocabulary: str) -> DataFrame:
    """Tokenise, write the files, read them back."""
    spark = docs.sparkSession
    path = fresh_path(spark, "token-files")
    write_token_files(tokenise(docs, vocabulary), path, vocabulary)
    return read_token_files(spark, path)
