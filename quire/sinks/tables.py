"""Sinks (B1, B2, B3, C9): digests as JSON; pages, blocks, statistics, quarantine and
model answers as Parquet tables.

A run publishes some days of some labels. What it publishes becomes visible in one step: its
tables are written as a version of their own, then the (day, label) pairs that the run covers, and
last a one-row file in ``commits``. A version is a folder of as many files as its rows need,
not of one for each day: runs may cover any number of days. Readers resolve, for each pair, the newest committed version
that covers it; so a run that dies before its commit changes nothing, pages and their blocks
never differ in age, and a day that a later run covers but finds empty has no page.

Statistics and quarantine are versions of a log of their own, read in the same way. JSON digests
are partitioned by ``digest_date`` and ``label`` with dynamic partition overwrite: writing a day of a
label again replaces exactly its files.

Model answers are only ever added: one row per call, keyed by the prompt's hash.
"""

from __future__ import annotations

import time
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.operators.common import bounded_broadcast

PARTITION = ["digest_date", "label"]
COVERED, COMMITS = "covered", "commits"
RUN_LOG = "run_"               # statistics and quarantine: dry runs, which publish no page, write them too


def overwrite_days(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
       .partitionBy(*PARTITION).format(fmt).save(path))


def write_digests_json(digests: DataFrame, path: str) -> None:
    """Dry-run output: one JSON object per (day, label). Compact UTF-8, not the
    reference's indented ASCII-escaped file: same values, other bytes."""
    overwrite_days(digests, path, "json")


def publish(tables: dict[str, DataFrame], covered: DataFrame, base: str, log: str = "") -> str:
    """Publish ``tables`` (by name, each with digest_date and label) as one version, the newest of
    the ``covered`` (day, label) pairs. Returns the version. Versions are ordered by their time,
    so one writer at a time publishes a pair. Tables of another ``log`` have commits of their own."""
    version = f"{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
    pairs = None if any(covered is df for df in tables.values()) else covered.select(*PARTITION)
    for name, df in tables.items():
        path = f"{base}/{name}/version={version}"
        df.write.parquet(path)
        # what was written tells its days, so no table is computed twice
        written = df.sparkSession.read.schema(df.schema).parquet(path).select(*PARTITION)
        pairs = written if pairs is None else pairs.unionByName(written)
    pairs.distinct().write.parquet(f"{base}/{log}{COVERED}/version={version}")
    one = covered.sparkSession.range(1).select(F.lit(version).alias("version"))
    one.coalesce(1).write.mode("append").parquet(f"{base}/{log}{COMMITS}")
    return version


def newest(spark: SparkSession, base: str, log: str = "") -> DataFrame | None:
    """(digest_date, label, version): the newest committed version of each pair ever published;
    None before the first."""
    try:
        commits = spark.read.schema("version string").parquet(f"{base}/{log}{COMMITS}")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    covered = spark.read.schema("digest_date date, label string, version string").parquet(f"{base}/{log}{COVERED}")
    return covered.join(F.broadcast(commits), "version", "left_semi").groupBy(*PARTITION).agg(
        F.max("version").alias("version"))


def read_published(spark: SparkSession, base: str, name: str, schema: T.StructType, log: str = "") -> DataFrame:
    """The published rows of a table: of each (day, label), those of its newest version."""
    latest = newest(spark, base, log)
    if latest is None:
        return spark.createDataFrame([], schema)
    stored = spark.read.schema(T.StructType([*schema.fields, T.StructField("version", T.StringType())]))
    rows, latest = stored.parquet(f"{base}/{name}"), bounded_broadcast(latest)
    same = [rows[c].eqNullSafe(latest[c]) for c in PARTITION]         # a day may be unknown
    return rows.join(latest, [*same, rows["version"] == latest["version"]], "left_semi").select(schema.fieldNames())


def write_pages(pages: DataFrame, blocks: DataFrame, base: str, covered: DataFrame | None = None,
                **others: DataFrame) -> None:
    """Publish ``digest_pages`` (one row per day and label), ``digest_blocks`` and ``others`` in
    one step. ``covered``: the days and labels that the run decides on, if more than have pages."""
    covered = pages if covered is None else covered
    publish({"digest_pages": pages, "digest_blocks": blocks, **others}, covered, base)


def write_run(stats: DataFrame, failed: DataFrame, base: str) -> None:
    """Publish ``run_stats`` and ``quarantine`` of a run's days and labels in one step."""
    publish({"run_stats": stats, "quarantine": failed}, stats, base, RUN_LOG)


def add_answers(answers: DataFrame, base: str) -> None:
    answers.write.mode("append").parquet(f"{base}/answers")


def read_answers(spark: SparkSession, base: str) -> DataFrame | None:
    """The answers stored by earlier runs, None before the first."""
    try:
        return spark.read.schema("prompt_hash string, response string, error string").parquet(f"{base}/answers")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
