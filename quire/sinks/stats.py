"""Run statistics (B3): what the reference logs per run, as a table per day."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.operators.select import DAY_KEYS

# Preview lengths of the run log.
PREVIEW = 100
SENDER_PREVIEW = 50
SUBJECT_PREVIEW = 60


def message_previews(nl: DataFrame) -> DataFrame:
    """Per selected message: sender and subject previews as the run log shows them."""
    return nl.select(*DAY_KEYS, "list_pos", "message_id",
                     F.substring("sender", 1, SENDER_PREVIEW).alias("sender_preview"),
                     F.substring("subject", 1, SUBJECT_PREVIEW).alias("subject_preview"))


def run_stats(found: DataFrame, fetched: DataFrame, counts: DataFrame, digests: DataFrame) -> DataFrame:
    """(digest_date, label, found, fetched, unique_count, categories, n_flags,
    summary_preview): messages listed, messages with a usable body, and those left once
    repeated subjects are gone."""
    d = (found.join(fetched, DAY_KEYS, "left").join(counts, DAY_KEYS, "left").join(digests, DAY_KEYS, "left"))
    cats = F.array_join(F.coalesce(F.col("active_categories"), F.array().cast("array<string>")), ", ")
    return d.select(
        *DAY_KEYS,
        *[F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(n)
          for c, n in (("found", "found"), ("fetched", "fetched"), ("newsletter_count", "unique_count"))],
        F.when(cats == "", F.lit("None")).otherwise(cats).alias("categories"),
        F.coalesce(F.size("domain_flags"), F.lit(0)).cast("int").alias("n_flags"),
        F.substring(F.coalesce(F.col("executive_summary"), F.lit("")), 1, PREVIEW).alias("summary_preview"),
    )
