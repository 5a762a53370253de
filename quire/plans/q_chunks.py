"""Queries for token estimates, greedy chunk packing, routing and prompts (step 3)."""

from __future__ import annotations

from pyspark.sql import functions as F

from quire.functions import taxonomy as TX
from quire.operators import chunking as K
from quire.operators.prompts import EXTRACT_TEMPLATE, render_prompts
from quire.params import DEFAULT
from quire.plans import sql as Q
from quire.plans.q_select import newsletters
from quire.plans.registry import query

P = DEFAULT
# The fixture days stay far below 75,000 tokens, so the chunk queries use an 8,000
# token budget to exercise multi-chunk days (the default route is checked too).
PC = DEFAULT.with_(max_input_tokens=8000)
DD = "CAST(digest_date AS VARCHAR) AS digest_date"


def block_sql(pos: str) -> str:
    return (f"'=== NEWSLETTER ' || {pos} || ' ===' || chr(10) || 'From: ' || sender || chr(10) || "
            f"'Subject: ' || subject || chr(10) || 'Date: ' || coalesce(date, 'None') || chr(10) || "
            f"'---' || chr(10) || body || chr(10)")


def packed_sql(p) -> str:
    """CTE ``pack``: greedy chunk ids per message by a recursive walk in list order."""
    return f"""items AS (
  SELECT digest_date, label, message_id, list_pos,
         row_number() OVER (PARTITION BY digest_date, label ORDER BY list_pos) AS rn,
         {Q.tokens('body', p)} + {p.message_overhead} AS t
  FROM nl),
pack AS (
  SELECT digest_date, label, rn, message_id, list_pos, t, 1 AS chunk_id, {p.prompt_overhead} + t AS cur
  FROM items WHERE rn = 1
  UNION ALL
  SELECT i.digest_date, i.label, i.rn, i.message_id, i.list_pos, i.t,
         CASE WHEN p.cur + i.t > {p.max_input_tokens} THEN p.chunk_id + 1 ELSE p.chunk_id END,
         CASE WHEN p.cur + i.t > {p.max_input_tokens} THEN {p.prompt_overhead} + i.t ELSE p.cur + i.t END
  FROM pack p JOIN items i
    ON i.digest_date = p.digest_date AND i.label = p.label AND i.rn = p.rn + 1)"""


def day_total_sql(p) -> str:
    return f"""whole AS (
  SELECT digest_date, label, count(*) AS n_messages,
         string_agg({block_sql('pos')}, chr(10) || chr(10) ORDER BY pos) AS all_text
  FROM (SELECT *, row_number() OVER (PARTITION BY digest_date, label ORDER BY list_pos) AS pos FROM nl)
  GROUP BY digest_date, label),
tot AS (SELECT digest_date, label, n_messages,
               CAST(length(all_text) // {p.chars_per_token} + {p.prompt_overhead} AS BIGINT) AS total_tokens,
               CASE WHEN length(all_text) // {p.chars_per_token} + {p.prompt_overhead} <= {p.max_input_tokens}
                    THEN 'single' ELSE 'chunked' END AS mode
        FROM whole)"""


def calls_sql(p) -> str:
    return f"""{day_total_sql(p)},
{packed_sql(p)},
calls AS (SELECT nl.*, CASE WHEN tot.mode = 'single' THEN 0 ELSE pack.chunk_id END AS chunk_id
          FROM nl JOIN tot USING (digest_date, label) JOIN pack USING (digest_date, label, message_id)),
blocks AS (
  SELECT digest_date, label, chunk_id, count(*) AS n_messages,
         string_agg({block_sql('pos')}, chr(10) || chr(10) ORDER BY pos) AS block
  FROM (SELECT *, row_number() OVER (PARTITION BY digest_date, label, chunk_id ORDER BY list_pos) AS pos
        FROM calls)
  GROUP BY digest_date, label, chunk_id)"""


def calls(spark, sf_dir, p):
    return K.assign_calls(newsletters(spark, sf_dir), p)


@query("daily_tokens", f"""
WITH RECURSIVE {Q.newsletters_cte(P)}, {day_total_sql(P)}
SELECT {DD}, label, n_messages, total_tokens FROM tot""")
def q_daily_tokens(spark, sf_dir):
    return K.daily_tokens(newsletters(spark, sf_dir), P)


@query("route_days", f"""
WITH RECURSIVE {Q.newsletters_cte(P)}, {day_total_sql(PC)}
SELECT {DD}, label, n_messages, total_tokens, mode FROM tot""")
def q_route_days(spark, sf_dir):
    return K.route_days(newsletters(spark, sf_dir), PC)


@query("chunk_assign", f"""
WITH RECURSIVE {Q.newsletters_cte(P)}, {packed_sql(PC)}
SELECT {DD}, label, message_id, list_pos, chunk_id, CAST(t AS BIGINT) AS nl_tokens FROM pack""")
def q_chunk_assign(spark, sf_dir):
    return K.chunk_assign(newsletters(spark, sf_dir), PC).withColumn("nl_tokens", F.col("nl_tokens").cast("bigint"))


@query("prompt_blocks", f"""
WITH RECURSIVE {Q.newsletters_cte(P)}, {calls_sql(PC)}
SELECT {DD}, label, chunk_id, n_messages, block,
       CAST(length(block) // {PC.chars_per_token} + {PC.prompt_overhead} AS BIGINT) AS est_tokens
FROM blocks""")
def q_prompt_blocks(spark, sf_dir):
    return K.prompt_blocks(calls(spark, sf_dir, PC), PC)


@query("prompt_render", f"""
WITH RECURSIVE {Q.newsletters_cte(P)}, {calls_sql(PC)}
SELECT {DD}, label, chunk_id, n_messages,
       printf({Q.lit(EXTRACT_TEMPLATE)}, strftime(digest_date, '%B %d, %Y'), n_messages,
              {Q.lit(TX.DEFAULT.bullets_text())}, block) AS prompt
FROM blocks""")
def q_prompt_render(spark, sf_dir):
    return render_prompts(K.prompt_blocks(calls(spark, sf_dir, PC), PC)).select(
        "digest_date", "label", "chunk_id", "n_messages", "prompt")


# Whole days, no per-day message limit: the exact distributed packer.
PCA = PC.with_(max_messages=None)


@query("chunk_assign_all", f"""
WITH RECURSIVE {Q.newsletters_cte(PCA)}, {packed_sql(PCA)}
SELECT {DD}, label, 'm' || CAST(message_id AS VARCHAR) AS message_id, -list_pos AS age, chunk_id,
       CAST(t AS BIGINT) AS nl_tokens FROM pack""")
def q_chunk_assign_all(spark, sf_dir):
    """Days of any size, with the ids and list order that stored mail has: text, and a
    (time, id) pair."""
    nl = newsletters(spark, sf_dir, PCA)
    ident = F.concat(F.lit("m"), F.col("message_id").cast("string"))
    nl = nl.withColumn("list_pos", F.struct(F.col("list_pos").alias("age"), ident.alias("id"))).withColumn(
        "message_id", ident)
    return K.chunk_assign(nl, PCA).select("digest_date", "label", "message_id", (-F.col("list_pos.age")).alias("age"),
                                          "chunk_id", F.col("nl_tokens").cast("bigint").alias("nl_tokens"))
