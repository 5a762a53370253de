"""Incremental ingestion (R1, R2) with Structured Streaming.

R1: new message files are picked up by ``readStream`` (``trigger(availableNow)``,
checkpointed). Each micro-batch appends its messages to a table partitioned by batch_id, and
keeps the daily selection up to date: a table of *versions* holds, for every (day, label), the best ``max_messages`` so far, with their bodies. A batch is cut to its own
best (salted, so a day with most of its rows is no burden), merged with the last version
of just those days and labels, and written as a version of its own. So a late message
changes one entry, no message of an earlier batch is read again, and no day that the batch does
not touch is published. A batch that is run again after a failure sees the versions before
it and rewrites its own partitions, so every sink is idempotent.

R2: streaming double-send removal that keeps the first message by list order: a streaming
aggregate per (day, label, subject key), combined before its shuffle, whose state a watermark
clears a day after its messages. Each batch writes the keys whose first message
changed; ``survivors`` reads the last word on each.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.functions.text import first_line
from quire.operators import select as S
from quire.operators.common import bounded_broadcast
from quire.params import Params
from quire.sinks.tables import publish as write_versions
from quire.sinks.tables import newest, read_published
from quire.sources import catalog as C
from quire.sources.fixtures import sent_at


def _documents_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents table as a stream, be it one file or a folder of files: a pattern that only it
    matches, as a stream reads a single file by a pattern only."""
    schema = C.table(spark, sf_dir, "documents").schema
    return spark.readStream.schema(schema).parquet(f"{sf_dir.rstrip('/')}/documents.parque[t]")


def _in_batches(spark: SparkSession, sf_dir: str, out: str, batches: int) -> DataFrame:
    """The documents as a stream of about ``batches`` file batches (for showing
    re-publication): every task writes a file for each arrival, and a trigger takes its
    share of the files."""
    docs = C.table(spark, sf_dir, "documents")
    path = f"{out}/incoming"
    docs.withColumn("arrival", F.pmod("doc_id", F.lit(batches))).write.partitionBy("arrival").parquet(path)
    n_files = len(spark.read.parquet(path).inputFiles())
    return (spark.readStream.schema(docs.schema).option("maxFilesPerTrigger", max(1, n_files // batches))
            .option("recursiveFileLookup", "true").parquet(path))


def _as_messages(docs: DataFrame) -> DataFrame:
    doc = F.col("doc_id")
    return docs.select(doc.alias("message_id"), C.day_of(doc).alias("digest_date"), doc.alias("list_pos"),
                       F.coalesce(F.col("source"), F.lit("")).alias("sender"),
                       first_line(F.col("text")).alias("subject"),
                       F.coalesce(F.col("text"), F.lit("")).alias("body"),
                       F.concat(C.day_of(doc).cast("string"), F.lit(C.DATE_SUFFIX)).alias("date"))


def _put(df: DataFrame, path: str, *partitions: str) -> None:
    """Write ``df`` over the partitions it has rows of."""
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partitions).parquet(path))


def with_month(df: DataFrame) -> DataFrame:
    """``df`` with the month of its day: what versions are partitioned by, as days are too many for folders."""
    return df.withColumn("month", F.date_format("digest_date", "yyyy-MM"))


def last_versions(versions: DataFrame, groups: DataFrame, before: int) -> DataFrame:
    """The rows of the newest version, older than batch ``before``, of each (day, label) in ``groups``."""
    old = versions.where(F.col("batch_id") < before).join(groups, [*S.DAY_KEYS, "month"], "left_semi")
    newest = old.groupBy(*S.DAY_KEYS).agg(F.max("batch_id").alias("batch_id"))
    return old.join(newest, [*S.DAY_KEYS, "batch_id"], "left_semi").drop("batch_id")


def merge_selection(messages: DataFrame, labels: DataFrame, path: str, batch_id: int, p: Params) -> DataFrame:
    """The daily selection of the days and labels that ``messages`` (one batch, stored) touch, after
    it; written to ``path`` as version ``batch_id``. A message that comes again counts once."""
    spark = messages.sparkSession
    narrow = messages.select("message_id", "digest_date", "list_pos")
    best = S.daily_topk(S.label_filter(narrow, labels), p)
    best, _ = S.fetch_bodies(best, messages.drop("list_pos"))
    versions = with_month(best).select(*S.DAY_KEYS, "message_id", "list_pos", *[
        c for c in messages.columns if c not in ("message_id", "digest_date", "list_pos")], F.lit(batch_id).alias("batch_id"), "month")
    # the table, before its first version
    versions.limit(0).write.mode("append").partitionBy("batch_id", "month").parquet(path)
    stored = spark.read.schema(versions.schema)
    new = versions.drop("batch_id")
    groups = bounded_broadcast(new.select(*S.DAY_KEYS, "month").distinct())
    both = last_versions(stored.parquet(path), groups, batch_id).unionByName(new).dropDuplicates([*S.DAY_KEYS, "message_id"])
    now = S.daily_topk(both, p).withColumn("batch_id", F.lit(batch_id)).hint("rebalance", "month")   # a month's rows in few files
    _put(now, path, "batch_id", "month")
    return stored.parquet(path).where(F.col("batch_id") == batch_id).drop("batch_id", "month")


def ingest_messages(stream: DataFrame, labels: DataFrame, out: str, p: Params,
                    publish: Callable[[DataFrame], DataFrame]) -> str:
    """Run R1 on a stream of messages until it is drained; ``publish`` turns selected newsletters
    into pages. Every batch publishes its days as a version (``read_published`` of ``published``
    has the newest of each); the pages table, whose path is returned, holds them once the stream
    is drained."""
    messages_path, versions_path, pages_path = f"{out}/messages", f"{out}/published", f"{out}/digest_pages"

    def batch(df: DataFrame, batch_id: int) -> None:
        rows = df.withColumn("batch_id", F.lit(batch_id))
        _put(rows, messages_path, "batch_id")
        stored = df.sparkSession.read.schema(rows.schema).parquet(messages_path)
        stored = stored.where(F.col("batch_id") == batch_id).drop("batch_id")
        if stored.isEmpty():
            return
        chosen = merge_selection(stored, labels, f"{out}/selection", batch_id, p)
        pages = publish(S.usable(chosen, p)[1])
        write_versions({"digest_pages": pages}, pages, versions_path)

    q = (stream.writeStream.foreachBatch(batch)
         .option("checkpointLocation", f"{out}/_checkpoint_ingest").trigger(availableNow=True).start())
    q.awaitTermination()
    spark = stream.sparkSession
    if newest(spark, versions_path) is not None:
        schema = spark.read.parquet(f"{versions_path}/digest_pages").drop("version").schema
        read_published(spark, versions_path, "digest_pages", schema).write.mode("overwrite").parquet(pages_path)
    return pages_path


def ingest(spark: SparkSession, sf_dir: str, out: str, p: Params,
           publish: Callable[[DataFrame], DataFrame], batches: int = 1) -> str:
    """R1 on the documents, as one batch or several."""
    stream = _documents_stream(spark, sf_dir) if batches == 1 else _in_batches(spark, sf_dir, out, batches)
    return ingest_messages(_as_messages(stream), C.message_labels(spark, sf_dir), out, p, publish)


def messages_of(stream: DataFrame) -> DataFrame:
    """No rows, with the columns of ``stream``."""
    return stream.sparkSession.createDataFrame([], stream.schema)


def dedup_messages(stream: DataFrame, labels: DataFrame, out: str, watermark: str = "1 day") -> str:
    """Run R2 on a stream of messages with a time ``ts`` until it is drained; returns the path
    of the changes. A message that comes more than ``watermark`` after its day is left out."""
    first = F.struct("list_pos", "message_id")
    changes = (stream.join(labels, "message_id")
               .withColumn("key", S.subject_key(F.col("subject")))
               .withWatermark("ts", watermark)
               .groupBy(F.window("ts", "1 day"), "digest_date", "label", "key").agg(F.min(first).alias("first"))
               .select("digest_date", "label", "key", "first.*"))
    path = f"{out}/dedup"
    # the table, before its first batch: a stream without files has none
    (messages_of(stream).select("digest_date", F.lit("").alias("label"), F.lit("").alias("key"), "list_pos", "message_id")
     .write.mode("overwrite").parquet(f"{path}/batch_id=-1"))

    def batch(df: DataFrame, batch_id: int) -> None:
        _put(df.withColumn("batch_id", F.lit(batch_id)), path, "batch_id")

    q = (changes.writeStream.foreachBatch(batch).outputMode("update")
         .option("checkpointLocation", f"{out}/_checkpoint_dedup").trigger(availableNow=True).start())
    q.awaitTermination()
    return path


def survivors(spark: SparkSession, path: str) -> DataFrame:
    """The first message by list order of each (day, label, key), from the changes at ``path``: a
    later change of a key always has a smaller ``list_pos``."""
    changes = spark.read.parquet(path)
    return changes.groupBy(*S.DAY_KEYS, "key").agg(F.min_by("message_id", "list_pos").alias("message_id"))


def dedup_stream(spark: SparkSession, sf_dir: str, out: str, watermark: str = "1 day") -> DataFrame:
    """R2 on the documents: the survivors."""
    messages = _as_messages(_documents_stream(spark, sf_dir)).withColumn(
        "ts", sent_at(F.col("message_id")).cast("timestamp"))   # watermarks need TIMESTAMP, not _NTZ
    return survivors(spark, dedup_messages(messages, C.message_labels(spark, sf_dir), out, watermark))
