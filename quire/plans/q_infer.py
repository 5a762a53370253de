"""Queries for model inference, the chunk merge, sinks and streaming (steps 7-8)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from quire.functions import taxonomy as TX
from quire.operators import chunking as K
from quire.operators import digest as D
from quire.operators import inference as I
from quire.operators import layout as L
from quire.operators import select as S
from quire.operators.prompts import EXTRACT_TEMPLATE, render_prompts
from quire.params import DEFAULT
from quire.plans import sql as Q
from quire.plans.q_chunks import PC, calls, calls_sql
from quire.plans.q_digest import digests, page_ctes
from quire.plans.job import run_mail
from quire.plans.offline import failing_model, offline_model
from quire.plans.q_mail import DOCS
from quire.plans.registry import query
from quire.session import scratch_path
from quire.sinks.tables import RUN_LOG, read_published, write_digests_json, write_pages
from quire.sources import catalog as C
from quire.sources import fixtures as FX
from quire.sources import mail as M
from quire.streaming import ingest as R

P = DEFAULT
DD = "CAST(digest_date AS VARCHAR) AS digest_date"


def prompts(spark, sf_dir):
    return render_prompts(K.prompt_blocks(calls(spark, sf_dir, PC), PC))


def scratch(spark, name):
    return scratch_path(spark, f"{name}-{uuid.uuid4().hex[:12]}")


# The offline model is deterministic: it names how many messages (or, in a merge,
# partial answers) its prompt holds, so the model path has an exact SQL oracle.
OFFLINE = "'Offline briefing covering ' || CAST({n} AS VARCHAR) || ' item(s).'"
PROMPT_SQL = (f"printf({Q.lit(EXTRACT_TEMPLATE)}, strftime(digest_date, '%B %d, %Y'), n_messages, "
              f"{Q.lit(TX.DEFAULT.bullets_text())}, block)")


@query("infer", f"""
WITH RECURSIVE {Q.newsletters_cte(PC)}, {calls_sql(PC)}
SELECT {DD}, label, chunk_id, sha256({PROMPT_SQL}) AS prompt_hash,
       {OFFLINE.format(n='n_messages')} AS executive_summary, CAST(NULL AS VARCHAR) AS error
FROM blocks""")
def q_infer(spark, sf_dir):
    """Every prompt answered by the (offline) model, in parallel per partition."""
    r = I.infer(prompts(spark, sf_dir), offline_model, PC, partitions=8)
    return r.select("digest_date", "label", "chunk_id", "prompt_hash",
                    F.get_json_object("response", "$.executive_summary").alias("executive_summary"), "error")


@query("chunk_merge", f"""
WITH RECURSIVE {Q.newsletters_cte(PC)}, {calls_sql(PC)}
SELECT {DD}, label,
       CASE WHEN max(chunk_id) = 0 THEN {OFFLINE.format(n='max(n_messages)')}
            ELSE {OFFLINE.format(n='count(*)')} END AS executive_summary,
       CAST(NULL AS VARCHAR) AS parse_error
FROM blocks GROUP BY digest_date, label""")
def q_chunk_merge(spark, sf_dir):
    """Partial answers of chunked days merged (budget-checked, level by level)."""
    r = I.persist(I.infer(prompts(spark, sf_dir), offline_model, PC))
    final, _ = I.merge_partials(r, S.DAY_KEYS, offline_model, PC)
    return D.parse_responses(final).select("digest_date", "label", "executive_summary", "parse_error")


# A refused call in a chunked day: every third day's first chunk names the refusal.
REFUSED = "day(digest_date) % 3 = 0 AND chunk_id = 1"


@query("merge_errors", f"""
WITH RECURSIVE {Q.newsletters_cte(PC)}, {calls_sql(PC)},
parts AS (SELECT digest_date, label, chunk_id, n_messages, {REFUSED} AS refused FROM blocks),
days AS (SELECT digest_date, label, max(chunk_id) AS last, max(n_messages) AS n_messages,
                count(*) FILTER (WHERE NOT refused) AS n_good, bool_or(refused) AS hurt FROM parts GROUP BY ALL)
SELECT {DD}, label, CASE WHEN n_good = 0 THEN 'Failed' WHEN hurt THEN 'Partial' ELSE 'Generated' END AS status,
       CASE WHEN n_good = 0 THEN {Q.lit(D.FALLBACK_SUMMARY)}
            WHEN last = 0 THEN {OFFLINE.format(n='n_messages')} ELSE {OFFLINE.format(n='n_good')} END AS executive_summary,
       CASE WHEN n_good = 0 THEN 'RuntimeError: refused'
            WHEN hurt THEN '1 part(s) of the day failed: RuntimeError: refused' END AS parse_error
FROM days""")
def q_merge_errors(spark, sf_dir):
    """A call that fails costs its own chunk only, and the page says so."""
    asked = prompts(spark, sf_dir).withColumn(
        "prompt", F.when(F.expr(REFUSED), F.concat("prompt", F.lit("call fails"))).otherwise(F.col("prompt")))
    r = I.persist(I.infer(asked, failing_model, PC))
    final, _ = I.merge_partials(r, S.DAY_KEYS, failing_model, PC)
    d = D.parse_responses(final)
    return d.select(*S.DAY_KEYS, D.status(F.col("executive_summary"), F.col("parse_error")).alias("status"),
                    "executive_summary", "parse_error")


@query("answers_rerun", f"""
WITH RECURSIVE {Q.newsletters_cte(PC)}, {calls_sql(PC)}
SELECT {DD}, label, chunk_id, {REFUSED} AS called_again FROM blocks""")
def q_answers_rerun(spark, sf_dir):
    """A second run asks only what has no good stored answer."""
    asked = prompts(spark, sf_dir)
    hashed = asked.withColumn("prompt_hash", F.sha2("prompt", 256))
    done = hashed.select("prompt_hash", F.when(~F.expr(REFUSED), F.lit("{}")).alias("response"),
                         F.when(F.expr(REFUSED), F.lit("refused")).alias("error"))
    again = I.infer_new(asked, done.unionAll(done), offline_model, PC)
    return again.select("digest_date", "label", "chunk_id", F.col("fresh").alias("called_again"))


@query("sink_json", f"""{page_ctes(P)}
SELECT {DD}, d.label, es.executive_summary, coalesce(a.active_categories, '') AS active_categories,
       CAST(coalesce(n.n_flags, 0) AS INTEGER) AS n_flags, CAST(d.newsletter_count AS INTEGER) AS n_sources
FROM days d LEFT JOIN es USING (digest_date, label) LEFT JOIN active a USING (digest_date, label)
LEFT JOIN (SELECT digest_date, label, count(*) AS n_flags FROM fl GROUP BY ALL) n USING (digest_date, label)""")
def q_sink_json(spark, sf_dir):
    """Digests written as JSON by day and label (twice: the re-run replaces, never
    duplicates), all fields read back."""
    _, d = digests(spark, sf_dir)
    path = scratch(spark, "digest-json")
    for _ in range(2):
        write_digests_json(d, path)
    back = spark.read.schema(d.schema).json(path)
    return back.select("digest_date", "label", "executive_summary",
                       F.array_join("active_categories", ", ").alias("active_categories"),
                       F.size("domain_flags").alias("n_flags"), F.size("per_source").alias("n_sources"))


@query("page_sink", f"""{page_ctes(P)}
SELECT {DD}, label, CAST(newsletter_count AS BIGINT) AS newsletter_count,
       coalesce(active_categories, '') AS categories, status
FROM days LEFT JOIN active USING (digest_date, label) JOIN status USING (digest_date, label)""")
def q_page_sink(spark, sf_dir):
    """Labels published one after the other to the same tables: neither run touches the
    other's pages, and a day published again replaces its own."""
    nl, d = digests(spark, sf_dir)
    out = scratch(spark, "pages")
    pages, blocks = D.digest_pages(d, S.daily_counts(nl), P), L.digest_blocks(d, P)
    for label in (C.LABEL_OF_QUALITY, C.LABEL_OF_TOXIC, C.LABEL_OF_QUALITY):
        only = F.col("label") == label
        write_pages(pages.filter(only), blocks.filter(only), out)
    return read_published(spark, out, "digest_pages", pages.schema).select(
        "digest_date", "label", "newsletter_count", F.array_join("categories", ", ").alias("categories"), "status")


@query("mail_to_pages", f"""
WITH {DOCS}, {Q.MESSAGE_LABELS},
mail AS (SELECT CAST(doc_id AS VARCHAR) AS id, doc_id, {Q.day_of('doc_id')} AS digest_date, subj,
                doc_id % 100 // 5 AS ms, bad_b64,
                CASE WHEN shape = 0 THEN text WHEN shape = 1 THEN htext
                     WHEN shape IN (2, 3) THEN (CASE WHEN htext <> '' THEN htext ELSE text END)
                     WHEN shape = 4 THEN (CASE WHEN deep AND htext <> '' THEN htext
                                               WHEN NOT deep AND text <> '' THEN text ELSE {Q.lit(FX.FOOTER)} END)
                     ELSE text END AS body
         FROM docs WHERE NOT bad_json),
listed AS (SELECT mail.*, label FROM mail JOIN ml ON ml.message_id = doc_id WHERE label = {Q.lit(P.label)}
           QUALIFY row_number() OVER (PARTITION BY digest_date ORDER BY ms DESC, id) <= {P.max_messages}),
fetched AS (SELECT * FROM listed WHERE NOT bad_b64 AND length({Q.ustrip('body')}) >= {P.min_body}),
kept AS (SELECT * FROM fetched
         QUALIFY row_number() OVER (PARTITION BY digest_date, lower({Q.ustrip('subj')}) ORDER BY ms DESC, id) = 1)
SELECT {DD}, label, count(*) AS found, (SELECT count(*) FROM fetched f WHERE f.digest_date = l.digest_date) AS fetched,
       (SELECT count(*) FROM kept k WHERE k.digest_date = l.digest_date) AS published,
       count(*) FILTER (WHERE bad_b64) AS undecodable
FROM listed l GROUP BY digest_date, label""")
def q_mail_to_pages(spark, sf_dir):
    """Stored mail to published pages, through every table that the job writes."""
    path, out = scratch(spark, "mail"), scratch(spark, "published")
    FX.stored_mail(spark, sf_dir).write.text(path)
    labels = C.message_labels(spark, sf_dir).withColumn("message_id", F.col("message_id").cast("string"))
    r = run_mail(M.read_raw(spark, path), labels, offline_model, out=out, p=P)
    pages = read_published(spark, out, "digest_pages", r["pages"].schema)
    stats = read_published(spark, out, "run_stats", r["stats"].schema, RUN_LOG)
    lost = (read_published(spark, out, "quarantine", r["quarantine"].schema, RUN_LOG).filter("stage = 'decode'")
            .groupBy(*S.DAY_KEYS).agg(F.count(F.lit(1)).alias("undecodable")))
    return (stats.join(pages.select(*S.DAY_KEYS, F.col("newsletter_count").alias("published")), S.DAY_KEYS, "left")
            .join(lost, S.DAY_KEYS, "left")
            .select(*S.DAY_KEYS, "found", "fetched", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("published", "undecodable")]))


@query("stream_ingest", f"""{page_ctes(P)}
SELECT {DD}, label, CAST(newsletter_count AS BIGINT) AS newsletter_count,
       coalesce(active_categories, '') AS categories, status
FROM days LEFT JOIN active USING (digest_date, label) JOIN status USING (digest_date, label)""")
def q_stream_ingest(spark, sf_dir):
    """Documents streamed in as two batches that share every day: the pages of touched
    days are published again, and equal those of the batch job."""
    path = R.ingest(spark, sf_dir, scratch(spark, "stream-ingest"), P, publish_extractive, batches=2)
    return spark.read.parquet(path).select("digest_date", "label", "newsletter_count",
                                           F.array_join("categories", ", ").alias("categories"), "status")


def publish_extractive(nl):
    """Pages of selected newsletters, with the extractive digest in the model's place."""
    nl = I.persist(nl)
    ed = D.extractive_digests(nl, P)
    d = D.parse_responses(ed.select(*S.DAY_KEYS, D.digest_json(ed).alias("response")))
    return D.digest_pages(d, S.daily_counts(nl), P)


@query("stream_dedup", f"""WITH {Q.MESSAGES}, {Q.MESSAGE_LABELS}
SELECT {DD}, label, lower({Q.ustrip('subject')}) AS key, min_by(message_id, list_pos) AS message_id
FROM msg JOIN ml USING (message_id) GROUP BY ALL""")
def q_stream_dedup(spark, sf_dir):
    """Streaming double-send removal under a watermark: the first message of each day, label
    and subject."""
    return R.dedup_stream(spark, sf_dir, scratch(spark, "stream-dedup")).select(
        "digest_date", "label", "key", "message_id")
