"""Queries over raw mail messages derived from ``documents`` (step 6).

The SQL oracles state the *expected* outcome of each derived message from the
documents table directly (which body wins for each MIME shape, which header form
parses to what), so they check the Spark decoder end to end: JSON parsing,
base64url, UTF-8, the MIME walk, HTML cleanup and header/date handling.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from quire.operators import select as S
from quire.plans import sql as Q
from quire.plans.registry import query
from quire.session import scratch_path
from quire.sources import catalog as C
from quire.sources import fixtures as FX
from quire.sources import mail as M

HTML_SQL = ("'<html><head><title>' || subj || '</title></head><body><p>' || replace(text, chr(10), '</p><p>') "
            "|| '</p></body></html>'")
DOCS = f"""docs0 AS (
  SELECT doc_id, coalesce(text, '') AS text, coalesce(source, '') AS source, {Q.first_line('text')} AS subj,
         doc_id % {FX.N_SHAPES} AS shape, doc_id % 8 AS form,
         doc_id % {FX.MOD_BAD} = {FX.BAD_B64} AS bad_b64, doc_id % {FX.MOD_BAD} = {FX.BAD_JSON} AS bad_json,
         doc_id % {FX.MOD_BAD} IN {FX.DEEP} AS deep, doc_id // {FX.MOD_BAD} % {FX.LEVELS} + {FX.LEAST_LEVELS} AS levels
  FROM documents),
docs1 AS (SELECT *, {HTML_SQL} AS html FROM docs0),
docs2 AS (SELECT *, {Q.lines_list(Q.strip_markup('html'))} AS l FROM docs1),
docs AS (SELECT * EXCLUDE (l), {Q.dedup_join('l')} AS htext FROM docs2)"""


def b64len(x: str) -> str:
    return f"CAST((strlen({x}) + 2) // 3 * 4 AS BIGINT)"


PARTS = f"""parts AS (
  SELECT doc_id, '' AS path, 0 AS depth, 0 AS pos,
         CASE shape WHEN 0 THEN 'text/plain' WHEN 1 THEN 'text/html' WHEN 2 THEN 'multipart/alternative'
              ELSE 'multipart/mixed' END AS mime, CAST(NULL AS VARCHAR) AS filename,
         CASE shape WHEN 0 THEN {b64len('text')} + CASE WHEN bad_b64 THEN 1 ELSE 0 END
                    WHEN 1 THEN {b64len('html')} END AS data_len,
         CASE shape WHEN 0 THEN (CASE WHEN bad_b64 THEN NULL ELSE strlen(text) END)
                    WHEN 1 THEN strlen(html) END AS n_bytes,
         CASE shape WHEN 0 THEN (CASE WHEN bad_b64 THEN NULL ELSE text END) WHEN 1 THEN html END AS content
  FROM docs WHERE NOT bad_json
  UNION ALL SELECT doc_id, '000', 1, 0, 'text/plain', NULL, {b64len('text')}, strlen(text), text
            FROM docs WHERE NOT bad_json AND shape IN (2, 3)
  UNION ALL SELECT doc_id, '001', 1, 1, 'text/html', NULL, {b64len('html')}, strlen(html), html
            FROM docs WHERE NOT bad_json AND shape = 2
  UNION ALL SELECT doc_id, '001', 1, 1, 'multipart/alternative', NULL, NULL, NULL, NULL
            FROM docs WHERE NOT bad_json AND shape = 3
  UNION ALL SELECT doc_id, '001.000', 2, 0, 'text/plain', NULL, {b64len('text')}, strlen(text), text
            FROM docs WHERE NOT bad_json AND shape = 3
  UNION ALL SELECT doc_id, '001.001', 2, 1, 'text/html', NULL, {b64len('html')}, strlen(html), html
            FROM docs WHERE NOT bad_json AND shape = 3
  UNION ALL SELECT doc_id, '002', 1, 2, 'application/pdf', 'brief.pdf', {b64len('subj')}, strlen(subj), subj
            FROM docs WHERE NOT bad_json AND shape = 3
  UNION ALL SELECT doc_id, '000', 1, 0, 'multipart/related', NULL, NULL, NULL, NULL
            FROM docs WHERE NOT bad_json AND shape = 4 AND NOT deep
  UNION ALL SELECT doc_id, '000.000', 2, 0, 'text/plain', NULL, {b64len('text')}, strlen(text), text
            FROM docs WHERE NOT bad_json AND shape = 4 AND NOT deep
  UNION ALL SELECT doc_id, repeat('000.', k - 1) || '000', k, 0, 'multipart/mixed', NULL, NULL, NULL, NULL
            FROM (SELECT doc_id, unnest(range(1, levels + 1)) AS k FROM docs WHERE deep)
  UNION ALL SELECT doc_id, repeat('000.', levels) || '000', levels + 1, 0, 'text/html', NULL, {b64len('html')},
                   strlen(html), html FROM docs WHERE deep
  UNION ALL SELECT doc_id, '001', 1, 1, 'text/plain', NULL, {b64len(Q.lit(FX.FOOTER))}, strlen({Q.lit(FX.FOOTER)}),
                   {Q.lit(FX.FOOTER)} FROM docs WHERE NOT bad_json AND shape = 4
  UNION ALL SELECT doc_id, '000', 1, 0, 'message/rfc822', NULL, NULL, NULL, NULL
            FROM docs WHERE NOT bad_json AND shape = 5
  UNION ALL SELECT doc_id, '001', 1, 1, 'text/plain', NULL, {b64len('text')}, strlen(text), text
            FROM docs WHERE NOT bad_json AND shape = 5)"""


def decoded(spark, sf_dir):
    return M.decode_messages(FX.raw_messages(spark, sf_dir))


def parsed(spark, sf_dir):
    return M.parse_message(FX.raw_messages(spark, sf_dir))


def part_rows(spark, sf_dir):
    m = parsed(spark, sf_dir).filter(F.col("msg").isNotNull())
    return m.select("message_id", F.inline(M.mime_parts(F.col("msg"))))


BROKEN = f"doc_id % {FX.MOD_BAD} = {FX.BAD_JSON}"


@query("scan_messages", f"""
SELECT CASE WHEN NOT {BROKEN} THEN CAST(doc_id AS VARCHAR) END AS message_id,
       CASE WHEN NOT {BROKEN} THEN CAST({Q.day_of('doc_id')} AS VARCHAR) END AS digest_date, {BROKEN} AS broken
FROM documents""")
def q_scan_messages(spark, sf_dir):
    """Stored mail, one message object a line, scanned back whole; a cut line stays a row."""
    path = scratch_path(spark, f"mail-{uuid.uuid4().hex[:12]}")
    FX.stored_mail(spark, sf_dir).write.text(path)
    return M.read_raw(spark, path).select("message_id", "digest_date", (~F.col("raw").endswith("}")).alias("broken"))


@query("parse_message", f"""WITH {DOCS}
SELECT doc_id AS message_id,
       CASE shape WHEN 0 THEN 'text/plain' WHEN 1 THEN 'text/html' WHEN 2 THEN 'multipart/alternative'
            ELSE 'multipart/mixed' END AS mime,
       CAST(2 + CASE WHEN form <> 7 THEN 1 ELSE 0 END + CASE WHEN doc_id % 7 = 0 THEN 1 ELSE 0 END AS INTEGER) AS n_headers,
       CAST(CASE shape WHEN 0 THEN 0 WHEN 1 THEN 0 WHEN 3 THEN 3 ELSE 2 END AS INTEGER) AS n_parts
FROM docs WHERE NOT bad_json""")
def q_parse_message(spark, sf_dir):
    m = parsed(spark, sf_dir).filter(F.col("msg").isNotNull())
    return m.select("message_id", "msg.mime", F.size("msg.headers").alias("n_headers"), "msg.n_parts")


@query("header_lookup", f"""WITH {DOCS}
SELECT doc_id AS message_id, subj AS subject, source AS sender FROM docs WHERE NOT bad_json""")
def q_header_lookup(spark, sf_dir):
    m = parsed(spark, sf_dir).filter(F.col("msg").isNotNull())
    return m.select("message_id", M.header(F.col("msg"), "subject").alias("subject"),
                    M.header(F.col("msg"), "FROM").alias("sender"))


@query("parse_mail_date", f"""WITH {DOCS},
t AS (SELECT doc_id, form, bad_json, bad_b64,
             strftime(CAST({Q.day_of('doc_id')} AS TIMESTAMP) + INTERVAL 8 HOUR + to_minutes(CAST(doc_id % 60 AS BIGINT))
                      + to_seconds(CAST((doc_id * 7) % 60 AS BIGINT)), '%Y-%m-%dT%H:%M:%S') AS iso FROM docs)
SELECT doc_id AS message_id,
       CASE form WHEN 0 THEN iso || '+00:00' WHEN 1 THEN iso || '-05:00' WHEN 2 THEN iso || '+00:00'
                 WHEN 3 THEN iso || '+00:00' WHEN 4 THEN iso WHEN 5 THEN iso || '+01:00' END AS date
FROM t WHERE NOT bad_json AND NOT bad_b64""")
def q_parse_mail_date(spark, sf_dir):
    good, _ = decoded(spark, sf_dir)
    return good.select("message_id", "date")


@query("mime_flatten", f"""WITH {DOCS}, {PARTS}
SELECT doc_id AS message_id, path, CAST(depth AS INTEGER) AS depth, CAST(pos AS INTEGER) AS pos, mime, filename,
       CAST(data_len AS BIGINT) AS data_len FROM parts""")
def q_mime_flatten(spark, sf_dir):
    return part_rows(spark, sf_dir).select("message_id", "path", "depth", "pos", "mime", "filename",
                                           F.length("data").cast("bigint").alias("data_len"))


@query("b64_decode", f"""WITH {DOCS}, {PARTS}
SELECT doc_id AS message_id, path, CAST(n_bytes AS BIGINT) AS n_bytes FROM parts WHERE data_len IS NOT NULL""")
def q_b64_decode(spark, sf_dir):
    from quire.functions.text import b64url_decode
    r = part_rows(spark, sf_dir).filter(F.col("data").isNotNull())
    return r.select("message_id", "path", F.octet_length(b64url_decode(F.col("data"))).cast("bigint").alias("n_bytes"))


@query("utf8_lenient", f"""WITH {DOCS}, {PARTS}
SELECT doc_id AS message_id, path, content AS text FROM parts WHERE data_len IS NOT NULL""")
def q_utf8_lenient(spark, sf_dir):
    from quire.functions.text import decode_body
    r = part_rows(spark, sf_dir).filter(F.col("data").isNotNull())
    return r.select("message_id", "path", decode_body(F.col("data")).alias("text"))


@query("mime_body", f"""WITH {DOCS}
SELECT doc_id AS message_id,
       CASE shape WHEN 0 THEN text
                  WHEN 1 THEN htext
                  WHEN 2 THEN (CASE WHEN htext <> '' THEN htext ELSE text END)
                  WHEN 3 THEN (CASE WHEN htext <> '' THEN htext ELSE text END)
                  WHEN 4 THEN (CASE WHEN deep AND htext <> '' THEN htext WHEN NOT deep AND text <> '' THEN text
                                    ELSE {Q.lit(FX.FOOTER)} END)
                  ELSE text END AS body
FROM docs WHERE NOT bad_json AND NOT bad_b64""")
def q_mime_body(spark, sf_dir):
    good, _ = decoded(spark, sf_dir)
    return good.select("message_id", "body")


@query("quarantine", f"""
SELECT doc_id AS message_id, CASE WHEN doc_id % {FX.MOD_BAD} = {FX.BAD_JSON} THEN 'parse' ELSE 'decode' END AS stage
FROM documents WHERE doc_id % {FX.MOD_BAD} IN ({FX.BAD_JSON}, {FX.BAD_B64})""")
def q_quarantine(spark, sf_dir):
    _, q = decoded(spark, sf_dir)
    return q.select("message_id", "stage")


@query("fetch_bodies", f"""WITH {Q.MESSAGE_LABELS}
SELECT CAST({Q.day_of('d.doc_id')} AS VARCHAR) AS digest_date, ml.message_id, ml.label,
       (d.doc_id % {FX.MOD_BAD} NOT IN ({FX.BAD_JSON}, {FX.BAD_B64})) AS fetched
FROM ml JOIN documents d ON d.doc_id = ml.message_id""")
def q_fetch_bodies(spark, sf_dir):
    good, _ = decoded(spark, sf_dir)
    keyed = S.label_filter(C.message_keys(spark, sf_dir), C.message_labels(spark, sf_dir))
    ok, failed = S.fetch_bodies(keyed, good.select("message_id", "digest_date", "body"))
    cols = [*S.DAY_KEYS, "message_id"]
    return (ok.select(*cols, F.lit(True).alias("fetched"))
              .unionByName(failed.select(*cols, F.lit(False).alias("fetched"))))


@query("label_catalog", f"""WITH {Q.MESSAGE_LABELS}
SELECT label, count(*) AS n_messages, label = {Q.lit(S.DEFAULT.label)} AS is_target
FROM ml GROUP BY label""")
def q_label_catalog(spark, sf_dir):
    return S.label_catalog(C.message_labels(spark, sf_dir))
