"""WARC archives with a Zstandard dictionary in front.

An archive is a ``.warc.zst`` file: first a skippable frame (magic 0x184D2A5D) that holds
a dictionary built from the archive's own records, then every record as a Zstandard
frame of its own, compressed with that dictionary. Any record can be read alone.

The files are written by Spark's text writer, so any file system that Spark knows will
do and a lost task leaves nothing half written. The writer puts a separator after each
row; it is set to the eight bytes of an empty skippable frame, which readers pass over.

One partition is one archive. A payload of at least ``min_bytes`` that occurs again is
written once: the record with the largest page_id is the response, the others are
revisit records that refer to it and keep the payload's digest and length.

Nulls: a null html is the empty payload; a null url is an empty target; a null page_id is
written as ``null`` and never referred to while a copy has an id. Rows that tie on the
largest page_id are all responses. An archive with too few records to build a dictionary
from has none. An empty table gives no records. Further columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
from collections.abc import Iterator
from itertools import chain

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm.common import HOT_SHARE, fresh_path, materialise, prepare

# Fixed values of the archive and frame formats.
DICTIONARY_MAGIC = 0x184D2A5D
SKIPPABLE_LOW, SKIPPABLE_HIGH = 0x184D2A50, 0x184D2A5F
SEPARATOR = "P*M\x18\x00\x00\x00\x00"          # an empty skippable frame, 0x184D2A50
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD_DATE = "2000-01-01T00:00:00Z"            # the pages table has no capture time

MIN_BYTES = 1000
DICTIONARY_BYTES = 64 << 10
SAMPLE_BYTES = 2 << 20       # records held back in a task to build the dictionary from
SAMPLE_RECORD = 16 << 10     # of a record, what the dictionary is built from
LEVEL = 3


def record(page_id: int | None, url: str | None, payload: bytes, n_bytes: int, sha1: str,
           refers_to: int | None) -> bytes:
    """One WARC record. A revisit has the response's HTTP head and no payload."""
    revisit = refers_to is not None
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            f"Content-Length: {n_bytes}\r\n\r\n").encode()
    block = http if revisit else http + payload
    digest = base64.b32encode(bytes.fromhex(sha1)).decode()
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}",
            f"WARC-Record-ID: <urn:page:{'null' if page_id is None else page_id}>",
            f"WARC-Target-URI: {' '.join((url or '').split())}", f"WARC-Date: {RECORD_DATE}",
            f"WARC-Payload-Digest: sha1:{digest}"]
    if revisit:
        head += [f"WARC-Refers-To: <urn:page:{refers_to}>", f"WARC-Profile: {PROFILE}"]
    head += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_record(raw: bytes) -> dict:
    head, _, rest = raw.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    if not version.startswith("WARC/1."):
        raise ValueError("not a WARC record")
    field = dict(x.split(": ", 1) for x in lines)
    block = rest[:int(field["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    n_bytes = int(re.search(rb"\r\nContent-Length: (\d+)", http)[1])
    sha1 = base64.b32decode(field["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
    revisit = field["WARC-Type"] == "revisit"
    if not revisit and (len(payload) != n_bytes or hashlib.sha1(payload).hexdigest() != sha1):
        raise ValueError(f"payload of {field['WARC-Record-ID']} differs from its digest")

    def number(name: str) -> int | None:
        text = field.get(name, "<urn:page:null>")[len("<urn:page:"):-1]
        return None if text == "null" else int(text)

    return {"page_id": number("WARC-Record-ID"), "url": field["WARC-Target-URI"],
            "payload_bytes": n_bytes, "payload_digest": sha1, "record_type": field["WARC-Type"],
            "refers_to": number("WARC-Refers-To"), "payload": None if revisit else payload}


def build_dictionary(records: list[bytes]) -> bytes:
    """A Zstandard dictionary, or nothing where the records are too few or too alike."""
    import zstandard
    samples = [r[:SAMPLE_RECORD] for r in records]
    size = min(DICTIONARY_BYTES, sum(map(len, samples)) // 8)
    if len(samples) < 16 or size < 1024:
        return b""
    try:
        return zstandard.train_dictionary(size, samples, d=8, k=256).as_bytes()
    except zstandard.ZstdError:
        return b""


def archive_rows(records: Iterator[bytes], level: int = LEVEL) -> Iterator[bytes]:
    """The rows of one archive: the dictionary's frame, then a frame for each record."""
    import zstandard
    held, size = [], 0
    for r in records:
        held.append(r)
        size += len(r)
        if size >= SAMPLE_BYTES:
            break
    if not held:
        return
    raw = build_dictionary(held)
    if raw:
        yield struct.pack("<II", DICTIONARY_MAGIC, len(raw)) + raw
    compress = zstandard.ZstdCompressor(
        level=level, dict_data=zstandard.ZstdCompressionDict(raw) if raw else None,
        write_content_size=True).compress
    for r in chain(held, records):
        yield compress(r)


def archive_records(raw: bytes) -> Iterator[bytes]:
    """The records of one archive's bytes."""
    import zstandard
    at, reader = 0, zstandard.ZstdDecompressor()
    view = memoryview(raw)
    while at < len(raw):
        magic = struct.unpack_from("<I", raw, at)[0]
        if SKIPPABLE_LOW <= magic <= SKIPPABLE_HIGH:
            size = struct.unpack_from("<I", raw, at + 4)[0]
            if magic == DICTIONARY_MAGIC and at == 0:
                reader = zstandard.ZstdDecompressor(
                    dict_data=zstandard.ZstdCompressionDict(raw[8:8 + size]))
            at += 8 + size
            continue
        one = reader.decompressobj()
        parts = []
        while not one.eof:
            piece = view[at:at + (1 << 16)]
            if not len(piece):
                raise ValueError("the archive ends inside a record")
            parts.append(one.decompress(piece))
            at += len(piece)
        at -= len(one.unused_data)
        yield b"".join(parts)


def with_first_copies(pages: DataFrame, min_bytes: int = MIN_BYTES) -> DataFrame:
    """``pages`` with its payload, digest and, for later copies, ``refers_to``. The page
    ids of equal payloads are reduced to their largest before anything is joined; short
    payloads get join keys of their own, so that they neither match nor pile up. A share of
    rows is a thousandth of all, or half a shuffle partition's where that is less. Payloads with
    more rows than a share, which are fewer than the shares, are broadcast as keys and dealt to
    as many parts as they hold shares."""
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select(
        F.col("page_id").cast("long"), F.col("url").cast("string"), payload.alias("payload"),
        F.octet_length(payload).cast("long").alias("n_bytes"), F.sha1(payload).alias("sha1"))
    rows = rows.withColumn("same", F.when(F.col("n_bytes") >= min_bytes, F.concat_ws(
        "-", "sha1", F.xxhash64("payload").cast("string"), F.col("n_bytes").cast("string"))))
    first = materialise(rows.where(F.col("same").isNotNull()).groupBy("same")
                        .agg(F.max("page_id").alias("first"), F.count(F.lit(1)).alias("n"))
                        .where("n > 1"), "first-copies")
    total = pages.count()
    share = max(HOT_SHARE, 2 * int(pages.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    hot = F.broadcast(first.where(F.col("n") * share > total).select(
        "same", F.ceil(F.col("n") * share / F.lit(max(total, 1))).alias("parts")))
    first = (first.drop("n").join(hot, "same", "left")
             .withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce("parts", F.lit(1)) - 1)))
             .drop("parts"))
    rows = rows.withColumn("same", F.coalesce(
        "same", F.concat(F.lit("own-"), F.xxhash64("page_id", "url", "sha1").cast("string"))))
    rows = rows.join(hot, "same", "left").withColumn(
        "part", F.coalesce(F.monotonically_increasing_id() % F.col("parts"), F.lit(0)))
    return (rows.join(first, ["same", "part"], "left")
            .withColumn("refers_to", F.when(F.col("page_id").isNull() | (F.col("page_id") != F.col("first")),
                                            F.col("first")))
            .select("page_id", "url", F.when(F.col("refers_to").isNull(), F.col("payload")).alias("payload"),
                    "n_bytes", "sha1", "refers_to"))


def write_archives(pages: DataFrame, path: str, min_bytes: int = MIN_BYTES, level: int = LEVEL) -> None:
    prepare(pages.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def records() -> Iterator[bytes]:
            for b in batches:
                ids, urls, sizes, digests, firsts = (b.column(i).to_pylist() for i in (0, 1, 3, 4, 5))
                for i, payload in enumerate(b.column(2)):
                    yield record(ids[i], urls[i], payload.as_py() or b"", sizes[i], digests[i], firsts[i])

        held, size = [], 0
        for row in archive_rows(records(), level):
            held.append(row)
            size += len(row)
            if size > 4 << 20:
                yield pa.RecordBatch.from_arrays([pa.array(held, pa.binary())], ["row"])
                held, size = [], 0
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(held, pa.binary())], ["row"])

    (with_first_copies(pages, min_bytes).mapInArrow(run, "row binary")
     .select(F.col("row").cast("string")).write.option("lineSep", SEPARATOR).text(path))


def read_archives(spark: SparkSession, path: str, with_payload: bool = False) -> DataFrame:
    """All records of the archives in ``path``; payloads are checked against their digests."""
    prepare(spark)
    names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64()]
    schema = ("page_id long, url string, payload_bytes long, payload_digest string, "
              "record_type string, refers_to long")
    if with_payload:
        names, kinds, schema = [*names, "payload"], [*kinds, pa.binary()], schema + ", payload binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for raw in b.column(0):
                held = []
                for r in archive_records(raw.as_buffer().to_pybytes()):
                    held.append(parse_record(r))
                    if len(held) >= (64 if with_payload else 4096):
                        yield rows(held)
                        held = []
                if held:
                    yield rows(held)

    def rows(held: list[dict]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([r[n] for r in held], k) for n, k in zip(names, kinds)], names)

    return (spark.read.format("binaryFile").load(path).select("content").mapInArrow(run, schema))


def archive_pages(pages: DataFrame) -> DataFrame:
    """Write archives of all pages, read them back."""
    path = fresh_path(pages.sparkSession, "archives")
    write_archives(pages, path)
    return read_archives(pages.sparkSession, path)
