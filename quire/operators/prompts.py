"""Prompt rendering (T14): our own wording around the message blocks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.functions import taxonomy as TX

EXTRACT_TEMPLATE = (
    "You are an analyst writing a daily briefing from newsletters.\n"
    "Date: %s\n\n"
    "You get the full text of %d newsletters. Give, per source, a short summary, key facts and links;\n"
    "group all insights into these categories:\n   %s\n"
    "add a 3-4 sentence executive summary and a list of domain flags.\n"
    "Answer with JSON only: {\"executive_summary\": ..., \"categories\": {...}, \"per_source\": [...],\n"
    " \"domain_flags\": [...], \"active_categories\": [...]}\n\n---\n\n%s\n"
)
MERGE_TEMPLATE = (
    "You are merging partial briefings of the same day into one.\n"
    "Date: %s\n\nMerge and deduplicate; answer with the same JSON shape.\n\nPartial briefings:\n%s\n"
)
PARTIAL_SEP = "\n\n---\n\n"


def long_date(d: Column) -> Column:
    return F.date_format(d, "MMMM dd, yyyy")


def render_prompts(blocks: DataFrame, tx: TX.Taxonomy = TX.DEFAULT) -> DataFrame:
    """(digest_date, label, chunk_id, n_messages, est_tokens, block) -> + prompt."""
    return blocks.withColumn(
        "prompt", F.format_string(EXTRACT_TEMPLATE, long_date(F.col("digest_date")),
                                  F.col("n_messages"), F.lit(tx.bullets_text()), F.col("block")))
