"""Helpers shared by the training-data operators."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quire.operators.common import BROADCAST_MAX_BYTES, row_bytes
from quire.session import scratch_path, ship_package


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new folder for one run, inside the shared checkpoint folder."""
    return scratch_path(spark, f"{name}-{uuid.uuid4().hex}")


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a compressed table in the shared folder and read it back: the
    lineage is cut there, and a lost executor costs no recomputation."""
    path = fresh_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small_side(df: DataFrame, name: str, max_bytes: int = BROADCAST_MAX_BYTES) -> DataFrame:
    """``df`` written to the shared folder, and marked for broadcast if its rows have few
    enough bytes; else Spark joins it by a shuffle."""
    stored = materialise(df, name)
    return F.broadcast(stored) if row_bytes(stored) <= max_bytes else stored


def placed(rows: DataFrame, tree: str, order: list[str], name: str) -> DataFrame:
    """``rows`` with ``pos``, their rank in ``tree`` by ``order``, and ``n``, the rows of the tree.
    Only counts per partition and tree meet in a window."""
    keys = [F.col(tree), *[F.col(c).asc_nulls_first() for c in order], F.col("__row")]
    sorted_rows = materialise(
        rows.withColumn("__row", F.monotonically_increasing_id())
        .repartitionByRange(*keys).sortWithinPartitions(*keys).drop("__row")
        .withColumn("__at", F.monotonically_increasing_id())
        .withColumn("__part", F.shiftright("__at", 33)), name)
    counts = sorted_rows.groupBy("__part", tree).agg(F.count(F.lit(1)).alias("__n"), F.min("__at").alias("__first"))
    whole = Window.partitionBy(tree)
    before = F.sum("__n").over(whole.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1))
    offsets = counts.select("__part", tree, (F.coalesce(before, F.lit(0)) - F.col("__first")).alias("__offset"),
                            F.sum("__n").over(whole).alias("n"))
    return (sorted_rows.join(small_side(offsets, f"{name}-offsets"), ["__part", tree])
            .withColumn("pos", F.col("__at") + F.col("__offset")).drop("__part", "__at", "__offset"))


HOT_SHARE = 1000


def join_unique(rows: DataFrame, side: DataFrame, keys: list[str], counts: DataFrame, total: int) -> DataFrame:
    """Stored ``rows`` joined with ``side``, which is unique in ``keys``; ``counts`` has the rows
    of each key as ``n``, ``total`` is their sum. Keys of over a thousandth of all rows are fewer
    than ``HOT_SHARE``: their part of ``side`` is broadcast, and the rest joins by a shuffle."""
    hot = F.broadcast(counts.where(F.col("n") * HOT_SHARE > total).select(*keys, F.lit(True).alias("__hot")))
    marked = rows.join(hot, keys, "left")
    few = F.broadcast(side.join(hot, keys).drop("__hot"))
    return (marked.where("__hot").drop("__hot").join(few, keys)
            .unionByName(marked.where("__hot is null").drop("__hot").join(side, keys)))


def prepare(spark: SparkSession) -> None:
    """Called by operators that run Python on executors."""
    ship_package(spark)


def let(value: Column, body) -> Column:
    """Evaluate ``value`` once and hand it to ``body`` (a one-element transform binds it)."""
    return F.element_at(F.transform(F.array(value), body), 1)


def unsigned32(c: Column) -> Column:
    return c.cast("long")


def held_out(doc_id: Column) -> Column:
    """The fold that is never learnt from: crc32 of the id as text, modulo 3, is 1.
    A null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 3 == 1
