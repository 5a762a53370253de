"""Prompt assembly and size routing.

Inputs are the selected newsletters: at most ``max_messages`` rows per
(digest_date, label), so per-day arrays below are bounded by that parameter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.functions.text import token_estimate
from quire.operators.common import persist
from quire.operators.select import DAY_KEYS
from quire.params import DEFAULT, Params

# Message block layout inside a prompt, and the block separator.
BLOCK_SEP = "\n\n"


def message_block(n: Column, sender: Column, subject: Column, date: Column, body: Column) -> Column:
    """One numbered message block; a missing date prints as ``None``."""
    return F.format_string("=== NEWSLETTER %d ===\nFrom: %s\nSubject: %s\nDate: %s\n---\n%s\n",
                           n, sender, subject, F.coalesce(date, F.lit("None")), body)


def with_blocks(nl: DataFrame, keys: list[str]) -> DataFrame:
    """Number messages from 1 within ``keys`` in list order (W1) and render blocks."""
    w = Window.partitionBy(*keys).orderBy("list_pos")
    return (nl.withColumn("pos", F.row_number().over(w))
              .withColumn("block", message_block(F.col("pos"), F.col("sender"), F.col("subject"),
                                                 F.col("date"), F.col("body"))))


def digits_1_to_n(n: Column) -> Column:
    """Total number of decimal digits of 1, 2, ..., n (closed form, no numbering)."""
    return sum((F.greatest(n - F.lit(10 ** (d - 1)) + 1, F.lit(0)) for d in range(1, 19)), F.lit(0))


def daily_tokens(nl: DataFrame, p: Params = DEFAULT, keys: list[str] = DAY_KEYS) -> DataFrame:
    """Estimate of the whole day's prompt block + overhead (G3), without building it:
    block lengths without their running number, plus the digits of 1..n, plus the
    separators, then one integer division. A plain aggregate (combined map-side): no
    per-day numbering, so a day of any size never lands in one task."""
    unnumbered = F.length(message_block(F.lit(0), F.col("sender"), F.col("subject"), F.col("date"),
                                        F.col("body"))) - 1
    n = F.col("n_messages")
    return (nl.groupBy(*keys)
              .agg(F.count(F.lit(1)).alias("n_messages"), F.sum(unnumbered).alias("__chars"))
              .select(*keys, "n_messages",
                      (F.floor((F.col("__chars") + digits_1_to_n(n) + F.lit(len(BLOCK_SEP)) * (n - 1))
                               / F.lit(p.chars_per_token)) + F.lit(p.prompt_overhead))
                      .cast("bigint").alias("total_tokens")))


def chunk_assign(nl: DataFrame, p: Params = DEFAULT, keys: list[str] = DAY_KEYS) -> DataFrame:
    """Greedy packing of a day's messages into chunks.

    Running sum from ``prompt_overhead``; a message whose ``len(body)//4 + 200`` would
    push a non-empty chunk past the budget starts a new chunk; an oversize first
    message is accepted alone. The running sum resets, so it is a fold, not a window:
    only (list_pos, message_id, tokens) of each day are folded, never bodies.
    """
    if p.max_messages is None:
        # days of unbounded size: exact distributed scan instead of a per-day fold
        from quire.operators.packing import chunk_assign_scan
        return chunk_assign_scan(nl, p, keys).withColumn("chunk_id", F.col("chunk_id").cast("int"))
    t = (token_estimate(F.col("body"), p.chars_per_token) + F.lit(p.message_overhead)).alias("t")
    items = F.array_sort(F.collect_list(F.struct(F.col("list_pos"), F.col("message_id"), t)))
    init = F.struct(F.lit(0).cast("bigint").alias("cur"), F.lit(0).alias("cid"),
                    F.array().cast("array<int>").alias("ids"))

    def step(acc, x):
        new = (acc["cid"] == 0) | (acc["cur"] + x["t"] > F.lit(p.max_input_tokens))
        cid = F.when(new, acc["cid"] + 1).otherwise(acc["cid"])
        cur = F.when(new, F.lit(p.prompt_overhead) + x["t"]).otherwise(acc["cur"] + x["t"])
        return F.struct(cur.alias("cur"), cid.alias("cid"),
                        F.concat(acc["ids"], F.array(cid)).alias("ids"))

    g = nl.groupBy(*keys).agg(items.alias("items"))
    folded = g.select(*keys, F.arrays_zip(F.col("items"),
                                          F.aggregate("items", init, step)["ids"]).alias("z"))
    return folded.select(*keys, F.inline("z")).select(
        *keys, F.col("items.message_id").alias("message_id"), F.col("items.list_pos").alias("list_pos"),
        F.col("ids").alias("chunk_id"), F.col("items.t").alias("nl_tokens"))


def route_days(nl: DataFrame, p: Params = DEFAULT, keys: list[str] = DAY_KEYS) -> DataFrame:
    """Per day: one call if the whole block fits the budget, else chunked."""
    tot = daily_tokens(nl, p, keys)
    return tot.withColumn("mode", F.when(F.col("total_tokens") <= p.max_input_tokens, F.lit("single"))
                          .otherwise(F.lit("chunked")))


def assign_calls(nl: DataFrame, p: Params = DEFAULT, keys: list[str] = DAY_KEYS) -> DataFrame:
    """Each message with the model call it belongs to: chunk 0 for single-call days,
    the packed chunk (1, 2, ...) for chunked days. The route is joined to the narrow list
    of chunks, so bodies meet nothing but their own message's chunk. The messages are
    written once: three parts of the plan read them."""
    nl = persist(nl)
    route = route_days(nl, p, keys).select(*keys, "mode")
    chunks = (chunk_assign(nl, p, keys).select(*keys, "message_id", "chunk_id").join(route, keys)
              .withColumn("chunk_id", F.when(F.col("mode") == "single", F.lit(0)).otherwise(F.col("chunk_id"))))
    return nl.join(chunks, [*keys, "message_id"])


def prompt_blocks(calls: DataFrame, p: Params = DEFAULT, keys: list[str] = DAY_KEYS) -> DataFrame:
    """Ordered, blank-line separated message blocks per call (G4), numbering
    restarting per chunk (W1). Bounded: at most max_messages x body_cap chars."""
    ck = [*keys, "chunk_id"]
    b = with_blocks(calls, ck)
    blocks = F.array_sort(F.collect_list(F.struct("pos", "block")))
    return (b.groupBy(*ck)
             .agg(F.count(F.lit(1)).alias("n_messages"), blocks.alias("__b"))
             .select(*ck, "n_messages",
                     F.array_join(F.transform("__b", lambda x: x["block"]), BLOCK_SEP).alias("block"))
             .withColumn("est_tokens", (F.floor(F.length("block") / p.chars_per_token)
                                        + F.lit(p.prompt_overhead)).cast("bigint")))
