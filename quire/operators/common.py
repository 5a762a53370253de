"""Shared plan helpers: bounded broadcast and skew-safe top-k."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.session import ensure_checkpoint_dir, scratch_path

# Bytes a side may hold to be broadcast; beyond it the join shuffles.
BROADCAST_MAX_BYTES = 64 << 20
ROW_OVERHEAD = 64              # bytes a row costs besides its values


def bounded_broadcast(df: DataFrame, max_bytes: int = BROADCAST_MAX_BYTES) -> DataFrame:
    """Materialise a (supposedly small) derived side and broadcast it only if its bytes
    are within ``max_bytes``; otherwise return it for a shuffle join.

    The side is written to the shared checkpoint folder (reliable checkpoint), so
    measuring it does not recompute it and executor loss does not lose it.
    """
    return bounded_side(df, max_bytes)[0]


def bounded_side(df: DataFrame, max_bytes: int = BROADCAST_MAX_BYTES) -> tuple[DataFrame, bool]:
    """As ``bounded_broadcast``, and whether the side is broadcast."""
    side = persist(df)
    few = row_bytes(side) <= max_bytes
    return (F.broadcast(side) if few else side), few


MAP_BITS = 32768               # bits of one bitmap row
BITS_PER_KEY = 16


def likely_in(rows: DataFrame, keys: DataFrame, column: str, max_bytes: int = BROADCAST_MAX_BYTES) -> DataFrame:
    """``rows`` whose ``column`` is in stored ``keys``, and about one in two hundred of the others: a
    Bloom filter. A key's hash chooses a bitmap row and three bits there; the rows are built by an aggregate
    and broadcast as arrays of integers, two bytes a key; where even those are over ``max_bytes``, all rows stay."""
    n_rows = max(1, -(-keys.count() * BITS_PER_KEY // MAP_BITS))
    if n_rows * (MAP_BITS // 8 + ROW_OVERHEAD) > max_bytes:
        return rows
    at = F.xxhash64(column)
    row = F.pmod(F.shiftright(at, 30), F.lit(n_rows))
    places = [F.shiftright(at, n).bitwiseAND(F.lit(MAP_BITS - 1)) for n in (0, 15, 49)]
    maps = (keys.select(row.alias("__map_row"), F.explode(F.array(*places)).alias("__bit")).groupBy("__map_row")
            .agg(F.bitmap_construct_agg("__bit").alias("__map")))
    word = lambda i: F.conv(F.hex(F.substring("__map", i * 4 + 1, F.lit(4))), 16, 10).cast("bigint")
    signed = lambda w: (w - F.shiftright(w, 31) * (1 << 32)).cast("int")
    words = F.transform(F.sequence(F.lit(0), F.lit(MAP_BITS // 32 - 1)), lambda i: signed(word(i)))
    maps = maps.select("__map_row", words.alias("__map"))

    def held(place: Column) -> Column:
        bit = place.cast("int")        # bytes of a word are in order, bits of a byte from the right
        shift = F.lit(24) - bit.bitwiseAND(24) + bit.bitwiseAND(7)
        return F.call_function("shiftright", F.get("__map", F.shiftright(bit, 5)), shift).bitwiseAND(1) == 1

    return (rows.withColumn("__map_row", row).join(F.broadcast(maps), "__map_row")
            .where(held(places[0]) & held(places[1]) & held(places[2])).drop("__map_row", "__map"))


def row_bytes(df: DataFrame) -> int:
    """The bytes of a stored table's rows."""
    row = F.coalesce(F.octet_length(F.to_json(F.struct(*df.columns))), F.lit(0)) + ROW_OVERHEAD
    return df.agg(F.sum(row.cast("long"))).first()[0] or 0


def persist(df: DataFrame) -> DataFrame:
    """Cut lineage by a reliable checkpoint in the shared folder."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame) -> DataFrame:
    """Write a table in the shared folder and read it back. Unlike a checkpoint, whose estimated size
    is that of its plan, it has the size of its files, so steps of a loop may build on one another."""
    path = scratch_path(df.sparkSession, f"step-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def top_k(df: DataFrame, keys: list[str], order: list[Column], k: int,
          salt_col: str | None = None, salt_buckets: int = 64) -> DataFrame:
    """First ``k`` rows per ``keys`` by ``order`` (row_number <= k).

    Spark plans each ``row_number() <= k`` as a map-side partial WindowGroupLimit
    plus a final one. With ``salt_col`` a first round ranks within
    ``(keys, hash(salt) % salt_buckets)`` so a hot key (a third of all rows) is cut
    to ``k * salt_buckets`` rows before the single final group sees it.
    """
    rn = "__rn"
    if salt_col is not None and salt_buckets > 1:
        salt = F.pmod(F.xxhash64(F.col(salt_col)), F.lit(salt_buckets))
        w1 = Window.partitionBy(*keys, salt).orderBy(*order)
        df = df.withColumn(rn, F.row_number().over(w1)).filter(F.col(rn) <= k).drop(rn)
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rn, F.row_number().over(w)).filter(F.col(rn) <= k).drop(rn)


def number_rows(df: DataFrame, keys: list[str], order: list[str], name: str) -> DataFrame:
    """``df`` with ``name``, the number from 1 of each row within ``keys`` by ``order``. Rows are
    sorted over all partitions by range, and written; a partition's rows of a key are counted, and
    only those counts meet in a window, so no key has to fit one task."""
    rows = persist(df.repartitionByRange(*keys, *order).sortWithinPartitions(*keys, *order)
                   .withColumn("__at", F.monotonically_increasing_id())
                   .withColumn("__part", F.shiftright("__at", 33)))
    counts = rows.groupBy("__part", *keys).agg(F.count(F.lit(1)).alias("__n"), F.min("__at").alias("__first"))
    before = F.sum("__n").over(Window.partitionBy(*keys).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1))
    offsets = bounded_broadcast(counts.select(
        F.col("__part").alias("__of"), *[F.col(k).alias(f"__{k}") for k in keys],
        (F.coalesce(before, F.lit(0)) - F.col("__first") + 1).alias("__add")))
    same = [F.col("__part") == F.col("__of"), *[F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys]]
    return rows.join(offsets, same).withColumn(name, F.col("__at") + F.col("__add")).select(*df.columns, name)
