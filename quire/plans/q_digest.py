"""Queries for digest parsing, status, page properties and page blocks (step 5-6)."""

from __future__ import annotations

from pyspark.sql import functions as F

from quire.functions import taxonomy as TX
from quire.functions.text import strip_fence
from quire.operators import digest as D
from quire.operators import inference as I
from quire.operators import layout as L
from quire.operators import select as S
from quire.operators.digest import URL
from quire.operators.extract import FACT, LEAD_SENTENCES
from quire.params import DEFAULT
from quire.plans import sql as Q
from quire.plans.q_extract import BULLETS, EXEC, FLAGS, base
from quire.plans.q_select import newsletters
from quire.plans.registry import query
from quire.sinks.stats import run_stats
from quire.sources import catalog as C

P = DEFAULT
# The block-cap query has a lower limit, so that many pages exceed it.
PB = DEFAULT.with_(max_messages=1000, block_limit=25)
DD = "CAST(digest_date AS VARCHAR) AS digest_date"


def digests(spark, sf_dir, p=P):
    """Selected newsletters -> extractive digest -> JSON answer -> parsed digest."""
    nl = I.persist(newsletters(spark, sf_dir, p))   # bounded: <= max_messages per day and label
    ed = D.extractive_digests(nl, p)
    resp = ed.select(*S.DAY_KEYS, D.digest_json(ed).alias("response"))
    return nl, I.persist(D.parse_responses(resp))    # one row per day and label, reused downstream


def pages(spark, sf_dir, p=P):
    nl, d = digests(spark, sf_dir, p)
    return D.digest_pages(d, S.daily_counts(nl), p)


# --------------------------------------------------------------------------- SQL pieces
def icon_case(x: str) -> str:
    whens = " ".join(f"WHEN {Q.lit(n)} THEN {Q.lit(i)}" for n, i in TX.CATEGORIES)
    return f"(CASE {x} {whens} ELSE {Q.lit(TX.DEFAULT_ICON)} END)"


def page_ctes(p) -> str:
    return f"""{base(p)}, {BULLETS}, {EXEC}, {FLAGS},
days AS (SELECT digest_date, label, count(*) AS newsletter_count FROM nl GROUP BY ALL),
lead AS (SELECT digest_date, label, message_id, string_agg(sentence, ' ' ORDER BY sent_pos) AS summary
         FROM sent WHERE sent_pos <= {LEAD_SENTENCES} GROUP BY ALL),
facts AS (SELECT digest_date, label, message_id, fact_pos, fact FROM (
            SELECT *, row_number() OVER (PARTITION BY digest_date, label, message_id ORDER BY sent_pos) AS fact_pos,
                   sentence AS fact FROM sent WHERE regexp_matches(sentence, {Q.lit(FACT)}))),
links AS (SELECT digest_date, label, message_id, link,
                 row_number() OVER (PARTITION BY digest_date, label, message_id ORDER BY min(i)) AS link_pos
          FROM (SELECT digest_date, label, message_id, unnest(l) AS link, generate_subscripts(l, 1) AS i
                FROM (SELECT *, regexp_extract_all(body, {Q.lit(URL)}) AS l FROM nl))
          GROUP BY digest_date, label, message_id, link),
ps AS (SELECT n.digest_date, n.label, n.message_id, n.list_pos, n.sender, coalesce(ld.summary, '') AS summary
       FROM nl n LEFT JOIN lead ld USING (digest_date, label, message_id)),
active AS (SELECT digest_date, label, string_agg(category, ', ' ORDER BY cat_pos) AS active_categories
           FROM (SELECT DISTINCT digest_date, label, category, cat_pos FROM bullets) GROUP BY ALL),
srcs AS (SELECT digest_date, label, substring(string_agg(sender, ', ' ORDER BY list_pos), 1, {p.text_limit}) AS sources
         FROM ps GROUP BY ALL),
status AS (SELECT d.digest_date, d.label,
                  CASE WHEN es.executive_summary IS NULL OR es.executive_summary = ''
                            OR starts_with(es.executive_summary, 'Failed') THEN 'Failed' ELSE 'Generated' END AS status
           FROM days d LEFT JOIN es USING (digest_date, label))"""


def blocks_ctes(p) -> str:
    """Page blocks as rows: (digest_date, label, sec, i, j) orders the top level."""
    fd = "(SELECT DISTINCT digest_date, label FROM fl)"
    bd = "(SELECT DISTINCT digest_date, label FROM bullets)"
    return f"""{page_ctes(p)},
tops AS (
  SELECT digest_date, label, 1 AS sec, 0 AS i, 0 AS j, 'heading' AS type, 2 AS level, CAST(NULL AS VARCHAR) AS icon,
         {Q.lit(L.H_SUMMARY)} AS text, CAST(NULL AS BIGINT) AS message_id FROM days
  UNION ALL SELECT d.digest_date, d.label, 1, 1, 0, 'callout', NULL, {Q.lit(TX.SUMMARY_ICON)},
         coalesce(es.executive_summary, {Q.lit(L.NO_SUMMARY)}), NULL FROM days d LEFT JOIN es USING (digest_date, label)
  UNION ALL SELECT digest_date, label, 1, 2, 0, 'divider', NULL, NULL, NULL, NULL FROM days
  UNION ALL SELECT digest_date, label, 2, 0, 0, 'heading', 2, NULL, {Q.lit(L.flags_heading())}, NULL FROM {fd}
  UNION ALL SELECT digest_date, label, 2, 1, flag_pos, 'callout', NULL, {Q.lit(TX.FLAG_ICON)}, text, NULL FROM fl
  UNION ALL SELECT digest_date, label, 2, 2, 0, 'divider', NULL, NULL, NULL, NULL FROM {fd}
  UNION ALL SELECT digest_date, label, 3, 0, 0, 'heading', 2, NULL, {Q.lit(L.H_CATEGORIES)}, NULL FROM {bd}
  UNION ALL SELECT digest_date, label, 3, cat_pos, 0, 'heading', 3, NULL, {icon_case('category')} || ' ' || category, NULL
         FROM (SELECT DISTINCT digest_date, label, category, cat_pos FROM bullets)
  UNION ALL SELECT digest_date, label, 3, cat_pos, bullet_pos, 'bullet', NULL, NULL, text, NULL FROM bullets
  UNION ALL SELECT digest_date, label, 3, 1000000, 0, 'divider', NULL, NULL, NULL, NULL FROM {bd}
  UNION ALL SELECT digest_date, label, 4, 0, 0, 'heading', 2, NULL, {Q.lit(L.H_SOURCES)}, NULL FROM days
  UNION ALL SELECT digest_date, label, 4, list_pos + 1, 0, 'toggle', NULL, NULL,
         {Q.lit(TX.SOURCE_ICON + ' ')} || sender, message_id FROM ps),
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY digest_date, label ORDER BY sec, i, j) AS block_pos,
         count(*) OVER (PARTITION BY digest_date, label) AS n_top FROM tops),
kids0 AS (
  SELECT digest_date, label, message_id, 1 AS k, 0 AS kp, 'paragraph' AS type, summary AS text FROM ps WHERE summary <> ''
  UNION ALL SELECT digest_date, label, message_id, 2, fact_pos, 'bullet', {Q.lit(TX.FACT_ICON + ' ')} || fact FROM facts
  UNION ALL SELECT digest_date, label, message_id, 3, link_pos, 'bullet', {Q.lit(TX.LINK_ICON + ' ')} || link FROM links),
kids AS (
  SELECT * FROM kids0
  UNION ALL SELECT digest_date, label, message_id, 4, 0, 'paragraph', {Q.lit(L.NO_DETAILS)} FROM ps
  WHERE NOT EXISTS (SELECT 1 FROM kids0 k WHERE k.digest_date = ps.digest_date AND k.label = ps.label
                    AND k.message_id = ps.message_id)),
kept_blocks AS (
  SELECT digest_date, label, block_pos, 0 AS child_pos, type, level, icon, text, message_id FROM numbered
  WHERE n_top <= {p.block_limit} OR block_pos <= {p.block_limit - 1}
  UNION ALL SELECT digest_date, label, {p.block_limit}, 0, 'paragraph', NULL, NULL, {Q.lit(L.TRUNCATED)},
         CAST(NULL AS BIGINT)
  FROM (SELECT DISTINCT digest_date, label FROM numbered WHERE n_top > {p.block_limit})),
blocks AS (
  SELECT digest_date, label, block_pos, child_pos, type, level, icon, text FROM kept_blocks
  UNION ALL
  SELECT c.digest_date, c.label, c.block_pos,
         row_number() OVER (PARTITION BY c.digest_date, c.label, c.block_pos ORDER BY k.k, k.kp) AS child_pos,
         k.type, NULL, NULL, k.text
  FROM kept_blocks c JOIN kids k USING (digest_date, label, message_id)
  WHERE c.type = 'toggle')"""


# --------------------------------------------------------------------------- page queries
@query("digest_pages", f"""{page_ctes(P)}
SELECT {DD}, label, printf({Q.lit(D.TITLE_FORMAT)}, strftime(digest_date, '%B %d, %Y')) AS title,
       CAST(newsletter_count AS BIGINT) AS newsletter_count,
       coalesce(active_categories, '') AS categories, status, sources
FROM days LEFT JOIN active USING (digest_date, label) JOIN srcs USING (digest_date, label)
JOIN status USING (digest_date, label)""")
def q_digest_pages(spark, sf_dir):
    return pages(spark, sf_dir).withColumn("categories", F.array_join("categories", ", "))


@query("digest_blocks", f"""{blocks_ctes(P)}
SELECT {DD}, label, CAST(block_pos AS INTEGER) AS block_pos, CAST(child_pos AS INTEGER) AS child_pos,
       type, CAST(level AS INTEGER) AS level, CAST(icon AS VARCHAR) AS icon,
       substring(CAST(text AS VARCHAR), 1, {P.text_limit}) AS text
FROM blocks""")
def q_digest_blocks(spark, sf_dir):
    _, d = digests(spark, sf_dir)
    return L.digest_blocks(d, P)


@query("block_limit", f"""{blocks_ctes(PB)}
SELECT {DD}, label, CAST(any_value(n_top) AS BIGINT) AS n_before,
       CAST(count(*) FILTER (WHERE child_pos = 0) AS BIGINT) AS n_blocks,
       CAST(count(*) AS BIGINT) AS n_rows,
       max(text) FILTER (WHERE child_pos = 0 AND block_pos = {PB.block_limit}) AS last_text
FROM blocks JOIN (SELECT DISTINCT digest_date, label, n_top FROM numbered) USING (digest_date, label)
GROUP BY digest_date, label""")
def q_block_limit(spark, sf_dir):
    _, d = digests(spark, sf_dir, PB)
    n_before = d.select(*S.DAY_KEYS, F.size(L.page_blocks(F.col("executive_summary"), F.col("domain_flags"),
                                                          F.col("categories"), F.col("per_source")))
                        .cast("bigint").alias("n_before"))
    b = L.digest_blocks(d, PB)
    agg = b.groupBy(*S.DAY_KEYS).agg(
        F.count(F.when(F.col("child_pos") == 0, 1)).cast("bigint").alias("n_blocks"),
        F.count(F.lit(1)).cast("bigint").alias("n_rows"),
        F.max(F.when((F.col("child_pos") == 0) & (F.col("block_pos") == PB.block_limit), F.col("text")))
        .alias("last_text"))
    return n_before.join(agg, S.DAY_KEYS)


@query("source_list", f"""{page_ctes(P)}
SELECT {DD}, label, sources FROM srcs""")
def q_source_list(spark, sf_dir):
    _, d = digests(spark, sf_dir)
    return d.select(*S.DAY_KEYS, D.source_list(F.col("per_source"), P).alias("sources"))


@query("run_stats", f"""{page_ctes(P)},
found AS (SELECT digest_date, label, count(*) AS found FROM top GROUP BY ALL),
fetched AS (SELECT digest_date, label, count(*) AS fetched FROM big GROUP BY ALL),
nflags AS (SELECT digest_date, label, count(*) AS n_flags FROM fl GROUP BY ALL)
SELECT {DD}, label, CAST(found AS BIGINT) AS found, CAST(coalesce(fetched, 0) AS BIGINT) AS fetched,
       CAST(coalesce(d.newsletter_count, 0) AS BIGINT) AS unique_count,
       coalesce(a.active_categories, 'None') AS categories, CAST(coalesce(n.n_flags, 0) AS INTEGER) AS n_flags,
       substring(coalesce(es.executive_summary, ''), 1, 100) AS summary_preview
FROM found LEFT JOIN fetched USING (digest_date, label) LEFT JOIN days d USING (digest_date, label)
LEFT JOIN active a USING (digest_date, label)
LEFT JOIN nflags n USING (digest_date, label) LEFT JOIN es USING (digest_date, label)""")
def q_run_stats(spark, sf_dir):
    sel = S.selection(C.message_keys(spark, sf_dir), C.message_labels(spark, sf_dir), C.bodies(spark, sf_dir), P)
    nl, d = digests(spark, sf_dir)
    return run_stats(S.count_days(sel["found"], "found"), S.count_days(sel["fetched"], "fetched"),
                     S.daily_counts(nl), d)


# --------------------------------------------------------------------------- parsing queries
# Model-answer shapes derived from the events table: every event becomes one
# answer, its variant chosen by event_id.
#   0 valid, 1 fenced, 2 fenced without closing, 3 cut, 4 fence without newline,
#   5 model-reported parse error, 6 empty summary, 7 text after the object, 8 single
#   quotes, 9 a list where text belongs, 10 text instead of an object
N_VARIANTS = 11
GOOD, LOST = (0, 1, 2, 5, 6, 9), (3, 7, 8)


def answers(spark, sf_dir):
    e = C.events(spark, sf_dir)
    core = F.format_string('{"executive_summary": "%s %s", "categories": {"%s": ["u=%s"]}, '
                           '"active_categories": ["%s", "%s"]', F.col("event_type"), F.col("user_id"),
                           F.col("event_type"), F.col("user_id"), F.col("event_type"), F.lit(TX.CATEGORIES[0][0]))
    v = F.pmod(F.col("event_id"), F.lit(N_VARIANTS))
    txt = (F.when(v == 0, F.concat(core, F.lit("}")))
            .when(v == 1, F.concat(F.lit("```json\n"), core, F.lit("}\n```")))
            .when(v == 2, F.concat(F.lit("```\n"), core, F.lit("}")))
            .when(v == 3, core)
            .when(v == 4, F.concat(F.lit("```"), core, F.lit("}")))
            .when(v == 5, F.concat(core, F.lit(', "_parse_error": "model could not read one newsletter"}')))
            .when(v == 6, F.format_string('{"executive_summary": "", "per_source": [{"summary": "%s"}]}',
                                          F.col("event_type")))
            .when(v == 7, F.concat(core, F.lit("} Hope this helps!")))
            .when(v == 8, F.concat(F.replace(core, F.lit('"'), F.lit("'")), F.lit("}")))
            .when(v == 9, F.concat(core, F.lit(', "domain_flags": "none"}')))
            .otherwise(F.col("event_type")))
    return e.select("event_id", txt.alias("response"))


ANSWERS_SQL = f"""ans AS (
  SELECT event_id, event_id % {N_VARIANTS} AS v, CASE event_id % {N_VARIANTS}
      WHEN 0 THEN core || '}}'
      WHEN 1 THEN '```json' || chr(10) || core || '}}' || chr(10) || '```'
      WHEN 2 THEN '```' || chr(10) || core || '}}'
      WHEN 3 THEN core
      WHEN 4 THEN '```' || core || '}}'
      WHEN 5 THEN core || ', "_parse_error": "model could not read one newsletter"}}'
      WHEN 6 THEN '{{"executive_summary": "", "per_source": [{{"summary": "' || event_type || '"}}]}}'
      WHEN 7 THEN core || '}} Hope this helps!'
      WHEN 8 THEN replace(core, '"', chr(39)) || '}}'
      WHEN 9 THEN core || ', "domain_flags": "none"}}'
      ELSE event_type END AS response
  FROM (SELECT event_id, event_type,
               '{{"executive_summary": "' || event_type || ' ' || CAST(user_id AS VARCHAR) || '", "categories": {{"'
               || event_type || '": ["u=' || CAST(user_id AS VARCHAR) || '"]}}, "active_categories": ["' || event_type || '", "'
               || {Q.lit(TX.CATEGORIES[0][0])} || '"]' AS core FROM events))"""


@query("strip_fence", f"""WITH {ANSWERS_SQL}
SELECT event_id,
       CASE WHEN starts_with({Q.ustrip('response')}, '```') THEN
         CASE WHEN strpos({Q.ustrip('response')}, chr(10)) > 0 THEN
           {Q.ustrip(f"regexp_replace(regexp_replace({Q.ustrip('response')}, '^[^' || chr(10) || ']*' || chr(10), ''), '```$', '')")}
         ELSE '' END
       ELSE {Q.ustrip('response')} END AS cleaned
FROM ans""")
def q_strip_fence(spark, sf_dir):
    return answers(spark, sf_dir).select("event_id", strip_fence(F.col("response")).alias("cleaned"))


def parsed_answers(spark, sf_dir):
    return answers(spark, sf_dir).select("event_id", "response", D.parse_answer(F.col("response")).alias("d"))


@query("json_parse", f"""WITH {ANSWERS_SQL}
SELECT event_id, CASE WHEN v IN {GOOD} AND v <> 6 THEN trim(split_part(response, '"', 8)) END AS first_category,
       CASE WHEN v IN {GOOD} AND v <> 6 THEN trim(split_part(response, '"', 10)) END AS first_insight,
       CAST(CASE WHEN v = 6 THEN 1 ELSE 0 END AS INTEGER) AS n_sources,
       CASE WHEN v = 6 THEN split_part(response, '"', 10) END AS source_summary
FROM ans""")
def q_json_parse(spark, sf_dir):
    """Answers read into the digest: ordered categories and their lists, sources."""
    d = F.col("d")
    return parsed_answers(spark, sf_dir).select(
        "event_id", F.get(F.map_keys(d["categories"]), 0).alias("first_category"),
        F.get(F.get(F.map_values(d["categories"]), 0), 0).alias("first_insight"),
        F.size(d["per_source"]).alias("n_sources"), F.get(d["per_source"], 0)["summary"].alias("source_summary"))


@query("parse_fallback", f"""WITH {ANSWERS_SQL}
SELECT event_id,
       CASE WHEN v IN {GOOD} THEN NULLIF(split_part(split_part(response, '"executive_summary": "', 2), '"', 1), '')
            ELSE {Q.lit(D.FALLBACK_SUMMARY)} END AS executive_summary,
       CASE WHEN v = 5 THEN 'model could not read one newsletter' WHEN v IN {GOOD} THEN NULL
            WHEN v IN {LOST} THEN {Q.lit(D.NOT_ONE_OBJECT)} WHEN v = 4 THEN {Q.lit(D.NO_ANSWER)}
            ELSE {Q.lit(D.NO_OBJECT)} END AS parse_error,
       CASE WHEN v NOT IN {GOOD} THEN substring(response, 1, 2000) END AS raw_response
FROM ans""")
def q_parse_fallback(spark, sf_dir):
    return parsed_answers(spark, sf_dir).select(
        "event_id", F.nullif(F.col("d.executive_summary"), F.lit("")).alias("executive_summary"),
        "d.parse_error", "d.raw_response")


@query("digest_status", f"""WITH {ANSWERS_SQL}
SELECT event_id, CASE WHEN v NOT IN {GOOD} OR v = 6 THEN 'Failed' WHEN v = 5 THEN 'Partial'
                      ELSE 'Generated' END AS status,
       CAST(CASE WHEN v IN {GOOD} AND v <> 6 THEN 1 ELSE 0 END AS INTEGER) AS n_categories
FROM ans""")
def q_digest_status(spark, sf_dir):
    d = parsed_answers(spark, sf_dir)
    return d.select("event_id", D.status(F.col("d.executive_summary"), F.col("d.parse_error")).alias("status"),
                    F.size(D.whitelist(F.col("d.active_categories"))).cast("int").alias("n_categories"))


@query("category_whitelist", f"""WITH {ANSWERS_SQL}
SELECT event_id, CASE WHEN v IN {GOOD} AND v <> 6 THEN {Q.lit(TX.CATEGORIES[0][0])} ELSE '' END AS categories
FROM ans""")
def q_category_whitelist(spark, sf_dir):
    """Of the categories that answers name, the known ones in order; the others go."""
    return parsed_answers(spark, sf_dir).select(
        "event_id", F.array_join(D.whitelist(F.col("d.active_categories")), ", ").alias("categories"))


@query("category_icons", f"""{page_ctes(P)}, {ANSWERS_SQL}
SELECT DISTINCT {DD}, label, category, {icon_case('category')} AS icon FROM bullets
UNION ALL
SELECT DISTINCT CAST(NULL AS VARCHAR), 'answers', split_part(response, '"', 8), {Q.lit(TX.DEFAULT_ICON)}
FROM ans WHERE v IN {GOOD} AND v <> 6""")
def q_category_icons(spark, sf_dir):
    """Icons of the pages' categories, and the default one of those no taxonomy knows."""
    _, d = digests(spark, sf_dir)
    known = d.select(*S.DAY_KEYS, F.explode(F.map_keys("categories")).alias("category"))
    other = parsed_answers(spark, sf_dir).select(
        F.lit(None).cast("date").alias("digest_date"), F.lit("answers").alias("label"),
        F.explode(F.map_keys("d.categories")).alias("category")).distinct()
    return known.unionByName(other).withColumn("icon", D.icon_of(F.col("category")))
