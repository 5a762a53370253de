"""Engine views over the driver's test tables.

The test tables hold no mail, so the mail-shaped views are *derived* from them by
plain projections (no sampling, no filtering): every document is one message.

* ``messages``       documents -> (message_id, digest_date, list_pos, sender, subject, body)
* ``message_labels`` labels    -> (message_id, label)
* ``pages``          pages     -> (page_id, url, html)
* ``events``         events    -> (event_id, ts, user_id, event_type, value, props)
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.functions.text import first_line

# Fixed values of the fixture mapping (shared with the SQL oracle).
FIRST_DAY = _dt.date(2024, 1, 1)
DOCS_PER_DAY = 60      # a day holds so many documents; days grow with the table
LABEL_OF_QUALITY = "Newsletter"   # labels.quality = 1
LABEL_OF_TOXIC = "Flagged"        # labels.toxic = 1
DATE_SUFFIX = "T08:00:00+00:00"    # fixture messages are all sent at 08:00 UTC


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def day_of(doc_id: Column) -> Column:
    return F.date_add(F.lit(FIRST_DAY), F.floor(doc_id / DOCS_PER_DAY).cast("int"))


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One message per document; listing order is ``doc_id``."""
    d = table(spark, sf_dir, "documents")
    return d.select(
        F.col("doc_id").alias("message_id"),
        day_of(F.col("doc_id")).alias("digest_date"),
        F.col("doc_id").alias("list_pos"),
        F.coalesce(F.col("source"), F.lit("")).alias("sender"),
        first_line(F.col("text")).alias("subject"),
        F.coalesce(F.col("text"), F.lit("")).alias("body"),
        F.concat(day_of(F.col("doc_id")).cast("string"), F.lit(DATE_SUFFIX)).alias("date"),
    )


def bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the bulk fetch returns per message id: headers' values and the body."""
    return messages(spark, sf_dir).select("message_id", "digest_date", "sender", "subject", "date", "body")


def message_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Narrow listing (no bodies): what the list call returns per message."""
    d = table(spark, sf_dir, "documents")
    return d.select(
        F.col("doc_id").alias("message_id"),
        day_of(F.col("doc_id")).alias("digest_date"),
        F.col("doc_id").alias("list_pos"),
    )


def message_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    lab = table(spark, sf_dir, "labels")
    good = lab.filter(F.col("quality") == 1).select(
        F.col("doc_id").alias("message_id"), F.lit(LABEL_OF_QUALITY).alias("label"))
    bad = lab.filter(F.col("toxic") == 1).select(
        F.col("doc_id").alias("message_id"), F.lit(LABEL_OF_TOXIC).alias("label"))
    return good.unionByName(bad)


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", "url", "html")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events")

