"""Exact greedy chunk packing for days of any size (W3 without a per-day limit).

The greedy rule is sequential: a chunk starting at item ``s`` takes the following
items while ``overhead + tokens`` stays within the budget. With global prefix sums
``P`` the next chunk start depends only on ``s``:
``next(s) = 1 + max{j : P_j - P_{s-1} <= budget - overhead}`` (at least ``s + 1``),
and since every message has at least ``message_overhead`` tokens, ``next(s) - s <= K``
with ``K = (budget - overhead) // message_overhead + 1``. The chunk starts are the
chain ``1 -> next(1) -> ...``. Everything below runs on groups bounded by
configuration, never on a whole day:

1. global rank and prefix per day: range partitioning, a per-partition scan, and
   per-segment offsets (a window over at most ``partitions`` rows per day);
2. ``next`` per item: buckets of ``M >= K`` ranks, each seeing the following bucket
   as halo (groups of at most ``2M`` rows);
3. per bucket, the transfer function entry offset -> (exit offset, starts) over the
   ``K`` possible entries; composed by an up-sweep / down-sweep tree over buckets
   (log2(#buckets) levels of small aggregates), giving every bucket its entry;
4. chunk ids per bucket by walking its chain from that entry.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.functions.text import token_estimate
from quire.operators.common import persist
from quire.params import DEFAULT, Params
from quire.session import ship_package


def chunk_assign_scan(nl: DataFrame, p: Params = DEFAULT, keys: list[str] | None = None,
                      bucket: int = 4096, partitions: int | None = None) -> DataFrame:
    """Same output as ``chunking.chunk_assign`` (keys, message_id, list_pos, chunk_id,
    nl_tokens), for days of unbounded size."""
    keys = keys or ["digest_date", "label"]
    if p.message_overhead <= 0:
        raise ValueError("the distributed packer needs message_overhead > 0 (bounded chunk length)")
    spark = nl.sparkSession
    ship_package(spark)
    D = p.max_input_tokens - p.prompt_overhead
    K = max(D // p.message_overhead + 1, 1)
    M = max(bucket, 2 * K)
    parts = partitions or int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    t = (token_estimate(F.col("body"), p.chars_per_token) + F.lit(p.message_overhead)).cast("long")
    items = nl.select(*[F.col(k) for k in keys], "list_pos", "message_id", t.alias("t"))
    key_fields = [items.schema[k] for k in keys]
    pos_t, id_t = items.schema["list_pos"].dataType, items.schema["message_id"].dataType
    nested = isinstance(pos_t, T.StructType)         # sorted as it is, carried through Python as JSON

    # 1. rank and prefix within each partition segment, then segment offsets -------------
    items = persist(items)              # range partitioning samples its input: do not join the bodies twice
    x = (items.repartitionByRange(parts, *keys, "list_pos").sortWithinPartitions(*keys, "list_pos")
              .withColumn("pid", F.spark_partition_id()))
    if nested:
        x = x.withColumn("list_pos", F.to_json("list_pos"))
    carried = x.schema["list_pos"]
    scan_t = T.StructType(x.schema.fields + [T.StructField("lr", T.LongType()), T.StructField("lp", T.LongType())])

    def local_scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last: tuple | None = None                     # key, rows and tokens so far of the batch before's last day
        for pdf in batches:
            if not len(pdf):
                continue
            day = pdf.groupby(keys, sort=False, dropna=False)
            lr = day.cumcount().to_numpy() + 1
            lp = day["t"].cumsum().to_numpy()
            if last is not None:
                same = np.logical_and.reduce([(pdf[k] == v) | (pdf[k].isna() & pd.isna(v))
                                              for k, v in zip(keys, last[0])])
                lr, lp = lr + last[1] * same, lp + last[2] * same
            last = (tuple(pdf[k].iloc[-1] for k in keys), int(lr[-1]), int(lp[-1]))
            yield pdf.assign(lr=lr, lp=lp)

    local = persist(x.mapInPandas(local_scan, scan_t))
    seg = local.groupBy(*keys, "pid").agg(F.max("lr").alias("n"), F.max("lp").alias("s"))
    w = Window.partitionBy(*keys).orderBy("pid").rowsBetween(Window.unboundedPreceding, -1)
    off = seg.select(*keys, "pid", F.coalesce(F.sum("n").over(w), F.lit(0)).alias("roff"),
                     F.coalesce(F.sum("s").over(w), F.lit(0)).alias("soff"))
    ranked = local.join(off, [*keys, "pid"]).select(
        *keys, "list_pos", "message_id", "t", (F.col("lr") + F.col("roff")).alias("r"),
        (F.col("lp") + F.col("soff")).alias("P"))
    ranked = ranked.withColumn("b", F.floor((F.col("r") - 1) / M).cast("long"))

    # 2. next() and per-item (exit, count) inside each bucket, with the next bucket as halo -
    own = ranked.withColumn("own", F.lit(True))
    halo = ranked.filter(F.col("b") > 0).withColumn("b", F.col("b") - 1).withColumn("own", F.lit(False))
    step_t = T.StructType(key_fields + [
        carried, T.StructField("message_id", id_t), T.StructField("t", T.LongType()), T.StructField("r", T.LongType()), T.StructField("b", T.LongType()),
        T.StructField("nxt", T.LongType()), T.StructField("ex", T.LongType()), T.StructField("cnt", T.LongType())])

    def bucket_step(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("r")
        r = pdf["r"].to_numpy(np.int64)
        P = pdf["P"].to_numpy(np.int64)
        tok = pdf["t"].to_numpy(np.int64)
        is_own = pdf["own"].to_numpy(bool)
        b = int(pdf["b"].iloc[0])
        r0 = r[0]                                   # ranks are contiguous from r0
        X = P - tok + D
        c = np.searchsorted(P, X, side="right")     # visible items with P <= X
        nxt = np.maximum(r + 1, r0 + c)             # r0 - 1 earlier items all count
        hi = (b + 1) * M                            # last rank of this bucket
        n_own = int(is_own.sum())
        ex = np.zeros(n_own, dtype=np.int64)
        cnt = np.zeros(n_own, dtype=np.int64)
        last = r[n_own - 1]                         # == hi except in a day's last bucket
        for i in range(n_own - 1, -1, -1):          # walk chains backwards: O(M)
            j = nxt[i]
            if j > last:
                ex[i], cnt[i] = min(max(j - hi - 1, 0), K - 1), 1
            else:
                k = int(j - r0)
                ex[i], cnt[i] = ex[k], cnt[k] + 1
        o = pdf[is_own]
        return pd.DataFrame({**{k: o[k].to_numpy() for k in keys}, "list_pos": o["list_pos"].to_numpy(),
                             "message_id": o["message_id"].to_numpy(), "t": o["t"].to_numpy(),
                             "r": r[:n_own], "b": b, "nxt": nxt[:n_own], "ex": ex, "cnt": cnt})

    stepped = persist(own.unionByName(halo).groupBy(*keys, "b").applyInPandas(bucket_step, step_t))

    # 3. transfer functions per bucket, composed by an up-sweep / down-sweep tree ---------
    fn = (stepped.filter(F.col("r") - F.col("b") * M - 1 < K)
                 .groupBy(*keys, "b")
                 .agg(F.array_sort(F.collect_list(F.struct("r", "ex", "cnt"))).alias("z"))
                 .select(*keys, F.col("b").alias("node"),
                         F.transform("z", lambda s: s["ex"]).alias("ex"),
                         F.transform("z", lambda s: s["cnt"]).alias("cnt")))
    levels = [persist(fn)]
    n_buckets = levels[0].groupBy(*keys).count().agg(F.max("count")).collect()[0][0] or 1
    while n_buckets > 1:
        cur = levels[-1]
        g = (cur.groupBy(*keys, F.floor(F.col("node") / 2).cast("long").alias("parent"))
                .agg(F.array_sort(F.collect_list(F.struct("node", "ex", "cnt"))).alias("c")))
        left, right = F.col("c")[0], F.col("c")[1]
        ex = F.when(F.size("c") == 1, left["ex"]).otherwise(
            F.transform(left["ex"], lambda e: F.get(right["ex"], e.cast("int"))))
        cnt = F.when(F.size("c") == 1, left["cnt"]).otherwise(
            F.transform(left["ex"], lambda e, i: F.get(left["cnt"], i) + F.get(right["cnt"], e.cast("int"))))
        levels.append(persist(g.select(*keys, F.col("parent").alias("node"), ex.alias("ex"), cnt.alias("cnt"))))
        n_buckets = (n_buckets + 1) // 2
    # entry offset and number of earlier chunk starts, from the root down
    entry = levels[-1].select(*keys, "node", F.lit(0).cast("long").alias("e"), F.lit(0).cast("long").alias("co"))
    for lvl in reversed(levels[:-1]):
        lc = lvl.filter(F.col("node") % 2 == 0).select(
            *keys, F.floor(F.col("node") / 2).cast("long").alias("parent"), F.col("node").alias("lnode"),
            F.col("ex").alias("lex"), F.col("cnt").alias("lcnt"))
        j = entry.withColumnRenamed("node", "parent").join(lc, [*keys, "parent"])
        kids = F.array(
            F.struct(F.col("lnode").alias("node"), F.col("e").alias("e"), F.col("co").alias("co")),
            F.struct((F.col("lnode") + 1).alias("node"), F.get("lex", F.col("e").cast("int")).alias("e"),
                     (F.col("co") + F.get("lcnt", F.col("e").cast("int"))).alias("co")))
        entry = persist(j.select(*keys, F.inline(kids)).join(lvl.select(*keys, "node"), [*keys, "node"]))

    # 4. walk each bucket's chain from its entry ------------------------------------------
    walk_in = stepped.join(entry.withColumnRenamed("node", "b"), [*keys, "b"])
    out_t = T.StructType(key_fields + [T.StructField("message_id", id_t), carried,
                                       T.StructField("chunk_id", T.LongType()),
                                       T.StructField("nl_tokens", T.LongType())])

    def bucket_walk(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("r")
        r = pdf["r"].to_numpy(np.int64)
        nxt = pdf["nxt"].to_numpy(np.int64)
        r0 = r[0]
        start = np.zeros(len(pdf), dtype=np.int64)
        node = r0 + int(pdf["e"].iloc[0])
        while node <= r[-1]:
            start[node - r0] = 1
            node = nxt[node - r0]
        cid = int(pdf["co"].iloc[0]) + np.cumsum(start)
        return pd.DataFrame({**{k: pdf[k].to_numpy() for k in keys}, "message_id": pdf["message_id"].to_numpy(),
                             "list_pos": pdf["list_pos"].to_numpy(), "chunk_id": cid,
                             "nl_tokens": pdf["t"].to_numpy()})

    out = walk_in.groupBy(*keys, "b").applyInPandas(bucket_walk, out_t)
    return out.withColumn("list_pos", F.from_json("list_pos", pos_t)) if nested else out
