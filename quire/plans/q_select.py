"""Queries for text cleanup and message selection (steps 1-2 of the build plan)."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import functions as F

from quire.functions import text as T
from quire.operators import select as S
from quire.params import DEFAULT
from quire.plans import sql as Q
from quire.plans.registry import query
from quire.sinks.stats import message_previews
from quire.sources import catalog as C

P = DEFAULT
PK = DEFAULT.with_(max_messages=5)     # the fixture's days are small; this limit cuts most of them
DD = "CAST(digest_date AS VARCHAR) AS digest_date"
TARGET_DAY = _dt.date(2024, 1, 3)


def newsletters(spark, sf_dir, p=P):
    kept, _failed = S.newsletters(C.message_keys(spark, sf_dir), C.message_labels(spark, sf_dir),
                                  C.bodies(spark, sf_dir), p)
    return kept


@query("html_to_text", f"""
SELECT page_id, {Q.dedup_join('l')} AS text
FROM (SELECT page_id, {Q.lines_list(Q.strip_markup('html'))} AS l FROM pages)""")
def q_html_to_text(spark, sf_dir):
    return C.pages(spark, sf_dir).select("page_id", T.html_to_text(F.col("html")).alias("text"))


@query("ustrip", f"""
SELECT doc_id, {Q.ustrip('text')} AS stripped FROM documents""")
def q_ustrip(spark, sf_dir):
    d = C.table(spark, sf_dir, "documents")
    return d.select("doc_id", T.ustrip(F.col("text")).alias("stripped"))


@query("dedup_lines", f"""
SELECT doc_id, {Q.dedup_join('l')} AS text
FROM (SELECT doc_id, {Q.lines_list('text')} AS l FROM documents)""")
def q_dedup_lines(spark, sf_dir):
    d = C.table(spark, sf_dir, "documents")
    return d.select("doc_id", T.clean_lines(F.col("text")).alias("text"))


@query("token_estimate", f"""
SELECT doc_id, {Q.tokens('text')} AS tokens FROM documents""")
def q_token_estimate(spark, sf_dir):
    d = C.table(spark, sf_dir, "documents")
    return d.select("doc_id", T.token_estimate(F.col("text"), P.chars_per_token).alias("tokens"))


@query("drop_tiny", f"""
WITH {Q.MESSAGES}
SELECT message_id, CAST(digest_date AS VARCHAR) AS digest_date FROM msg WHERE length({Q.ustrip('body')}) >= {P.min_body}""")
def q_drop_tiny(spark, sf_dir):
    return S.drop_tiny(C.messages(spark, sf_dir), P).select("message_id", "digest_date")


@query("cap_body", f"""
WITH {Q.MESSAGES}
SELECT message_id, substring(body, 1, {P.body_cap}) AS body,
       CAST(length(substring(body, 1, {P.body_cap})) AS BIGINT) AS body_len FROM msg""")
def q_cap_body(spark, sf_dir):
    m = S.cap_body(C.messages(spark, sf_dir), P)
    return m.select("message_id", "body", F.length("body").cast("bigint").alias("body_len"))


@query("day_filter", f"""
SELECT event_id, event_type, value FROM events
WHERE ts >= TIMESTAMP '{TARGET_DAY} 00:00:00' AND ts < TIMESTAMP '{TARGET_DAY + _dt.timedelta(days=1)} 00:00:00'""")
def q_day_filter(spark, sf_dir):
    e = C.events(spark, sf_dir)
    return S.day_filter(e, "ts", TARGET_DAY).select("event_id", "event_type", "value")


@query("label_filter", f"""
WITH {Q.MESSAGES}, {Q.MESSAGE_LABELS}
SELECT m.message_id, CAST(m.digest_date AS VARCHAR) AS digest_date, ml.label FROM msg m JOIN ml USING (message_id)""")
def q_label_filter(spark, sf_dir):
    return S.label_filter(C.message_keys(spark, sf_dir), C.message_labels(spark, sf_dir)) \
        .select("message_id", "digest_date", "label")


@query("daily_topk", f"""
WITH {Q.MESSAGES}, {Q.MESSAGE_LABELS}
SELECT CAST(m.digest_date AS VARCHAR) AS digest_date, ml.label, m.message_id, m.list_pos FROM msg m JOIN ml USING (message_id)
QUALIFY row_number() OVER (PARTITION BY m.digest_date, ml.label ORDER BY m.list_pos) <= {PK.max_messages}""")
def q_daily_topk(spark, sf_dir):
    keyed = S.label_filter(C.message_keys(spark, sf_dir), C.message_labels(spark, sf_dir))
    return S.daily_topk(keyed, PK).select("digest_date", "label", "message_id", "list_pos")


@query("dedup_subject", f"""
WITH {Q.MESSAGES}, {Q.MESSAGE_LABELS}
SELECT CAST(m.digest_date AS VARCHAR) AS digest_date, ml.label, m.message_id FROM msg m JOIN ml USING (message_id)
QUALIFY row_number() OVER (PARTITION BY m.digest_date, ml.label, lower({Q.ustrip('m.subject')})
                           ORDER BY m.list_pos) = 1""")
def q_dedup_subject(spark, sf_dir):
    keyed = S.label_filter(C.messages(spark, sf_dir).select("message_id", "digest_date", "list_pos", "subject"),
                           C.message_labels(spark, sf_dir))
    return S.dedup_subject(keyed).select("digest_date", "label", "message_id")


@query("daily_counts", f"""
WITH {Q.newsletters_cte(P)}
SELECT CAST(digest_date AS VARCHAR) AS digest_date, label, count(*) AS newsletter_count FROM nl GROUP BY ALL""")
def q_daily_counts(spark, sf_dir):
    return S.daily_counts(newsletters(spark, sf_dir))


@query("newsletter_records", f"""
WITH {Q.newsletters_cte(P)}
SELECT CAST(digest_date AS VARCHAR) AS digest_date, label, list_pos, message_id, subject, sender, date, body FROM nl""")
def q_newsletter_records(spark, sf_dir):
    return newsletters(spark, sf_dir).select(
        "digest_date", "label", "list_pos", "message_id", "subject", "sender", "date", "body")


@query("message_previews", f"""
WITH {Q.newsletters_cte(P)}
SELECT {DD}, label, list_pos, message_id, substring(sender, 1, 50) AS sender_preview,
       substring(subject, 1, 60) AS subject_preview FROM nl""")
def q_message_previews(spark, sf_dir):
    return message_previews(newsletters(spark, sf_dir))
