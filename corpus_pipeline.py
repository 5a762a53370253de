"""The corpus pipeline: five stages over ``documents``, each calling one operator.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet
and read again as the next one's ``docs``. All but the last return the columns of
``documents``; the last returns the pieces of the packed sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quire.llm import decontam, packing, pii, quality, simhash
from quire.llm.common import materialise, table
from quire.llm.tokens import vocabulary_path


PII_KEY = "corpus"         # a run on real data passes its own
CACHE_WORDS = 300_000      # of a packing worker: it shares its executor with what other stages left there


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the compression classifier rejects go. It is learnt from the labels
    of the documents that reach it."""
    return quality.keep_good(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays."""
    return simhash.keep_one_of_each(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold benchmark passages go."""
    return decontam.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def pseudonymise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal numbers, dates, addresses and secrets get pseudonyms."""
    return pii.pseudonymise(docs, PII_KEY, counts=False).select(docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of packed sequences."""
    return packing.pack_documents(docs, vocabulary_path(), cache_words=CACHE_WORDS)


STAGES = [
    ("quality", quality_filter),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontaminate),
    ("pseudonyms", pseudonymise),
    ("packing", pack),
]

# Fingerprints and token ids are beyond SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, with a table between each two."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
