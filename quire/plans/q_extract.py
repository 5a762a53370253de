"""Queries for the extractive briefing analogues (step 4)."""

from __future__ import annotations

from pyspark.sql import functions as F

from quire.functions import taxonomy as TX
from quire.operators import extract as X
from quire.operators import select as S
from quire.params import DEFAULT
from quire.plans import sql as Q
from quire.plans.q_select import newsletters
from quire.plans.registry import query
from quire.sources import catalog as C

# Extraction runs on every selected message (no per-day limit) and on whole texts; the
# page pipeline applies the reference's limits.
PA = DEFAULT.with_(max_messages=None, body_cap=1 << 30)
DD = "CAST(digest_date AS VARCHAR) AS digest_date"


def kw_values(flags: bool = False) -> str:
    if flags:
        rows = [("flag", 0, k) for k in TX.FLAG_KEYWORDS]
    else:
        rows = [(n, i, k) for i, (n, _) in enumerate(TX.CATEGORIES, 1) for k in TX.KEYWORDS[n]]
    vals = ", ".join(f"({Q.lit(a)}, {b}, {Q.lit(c)})" for a, b, c in rows)
    return f"(SELECT * FROM (VALUES {vals}) t(category, cat_pos, keyword))"


SENT = f"""sent AS (
  SELECT digest_date, label, message_id, list_pos, sender, sentence, CAST(sent_pos AS INTEGER) AS sent_pos FROM (
    SELECT *, unnest(l) AS sentence, generate_subscripts(l, 1) AS sent_pos FROM (
      SELECT digest_date, label, message_id, list_pos, sender,
             list_filter(list_transform(regexp_extract_all(body, {Q.lit(X.SENTENCE)}),
                                        lambda s: {Q.ustrip('s')}), lambda s: s <> '') AS l
      FROM nl)))"""


def hits_cte(name: str, flags: bool = False) -> str:
    return f"""{name} AS (
  SELECT digest_date, label, message_id, sent_pos, category, cat_pos, count(*) AS hits
  FROM (SELECT digest_date, label, message_id, sent_pos,
               unnest(string_split_regex(lower(sentence), {Q.lit(X.TOKEN_SPLIT)})) AS token FROM sent) tk
  JOIN {kw_values(flags)} kw ON tk.token = kw.keyword
  GROUP BY ALL)"""


def base(p) -> str:
    return f"WITH RECURSIVE {Q.newsletters_cte(p)}, {SENT}, {hits_cte('hits')}"


BASE = base(PA)

BULLETS = f"""bullets AS (
  SELECT digest_date, label, category, cat_pos,
         row_number() OVER (PARTITION BY digest_date, label, category
                            ORDER BY s.hits DESC, s.list_pos, s.sent_pos) AS bullet_pos,
         s.sentence || ' (Source: ' || s.sender || ')' AS text,
         regexp_matches(s.sentence, {Q.lit(X.TIME_SENSITIVE)}) AS time_sensitive
  FROM (SELECT *, row_number() OVER (PARTITION BY digest_date, label, category, sentence ORDER BY list_pos, sent_pos) AS nth
        FROM hits JOIN sent USING (digest_date, label, message_id, sent_pos) QUALIFY nth = 1) s
  QUALIFY bullet_pos <= {X.BULLETS_PER_CATEGORY})"""


def sent_hits(spark, sf_dir):
    s = X.sentences(newsletters(spark, sf_dir, PA))
    return s, X.categorize(s)


@query("lead_summary", f"""{BASE}
SELECT {DD}, label, message_id, string_agg(sentence, ' ' ORDER BY sent_pos) AS summary
FROM sent WHERE sent_pos <= {X.LEAD_SENTENCES} GROUP BY ALL""")
def q_lead_summary(spark, sf_dir):
    return X.lead_summary(newsletters(spark, sf_dir, PA))


@query("key_facts", f"""{BASE}
SELECT {DD}, label, message_id, fact_pos, fact FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY digest_date, label, message_id ORDER BY sent_pos) AS INTEGER) AS fact_pos,
         sentence AS fact
  FROM sent WHERE regexp_matches(sentence, {Q.lit(X.FACT)}))""")
def q_key_facts(spark, sf_dir):
    return X.key_facts(newsletters(spark, sf_dir, PA))


# The target within an opening tag: whichever of the three ways of quoting is used.
HREF = "coalesce(" + ", ".join(f"nullif(regexp_extract(a, {Q.lit(r)}, 1), '')" for r in (
    r'(?i)\shref\s*=\s*"([^"]*)"', r"(?i)\shref\s*=\s*'([^']*)'", r"(?i)\shref\s*=\s*([^\s\"'<>]+)")) + ", '')"


@query("extract_links", f"""
SELECT page_id, CAST(row_number() OVER (PARTITION BY page_id ORDER BY first_pos) AS INTEGER) AS link_pos, link
FROM (SELECT page_id, link, min(i) AS first_pos FROM (
        SELECT page_id, unnest(l) AS link, generate_subscripts(l, 1) AS i
        FROM (SELECT page_id, list_filter(list_transform(
                       regexp_extract_all(html, '(?i)<a(?:rea)?\\s[^<>]*'), lambda a: {Q.ustrip(Q.decode_entities(HREF))}),
                     lambda h: h <> '') AS l FROM pages))
      GROUP BY ALL)""")
def q_extract_links(spark, sf_dir):
    return X.extract_links(C.pages(spark, sf_dir), "page_id", "html")


# The first words of every document's text, one to three of them, as phrases of its source.
PHRASES = f"""SELECT DISTINCT source AS category, array_to_string(w[1:n], ' ') AS gram FROM (
  SELECT source, unnest([1, 2, 3]) AS n,
         list_filter(string_split_regex(lower(coalesce(text, '')), {Q.lit(X.TOKEN_SPLIT)}), lambda t: t <> '') AS w
  FROM documents WHERE source IS NOT NULL) WHERE len(w) >= n"""


@query("categorize_phrases", f"""{BASE}, phrases AS ({PHRASES}),
toks AS (SELECT digest_date, label, message_id, sent_pos,
                list_filter(string_split_regex(lower(sentence), {Q.lit(X.TOKEN_SPLIT)}), lambda t: t <> '') AS w FROM sent),
grams AS (SELECT digest_date, label, message_id, sent_pos, array_to_string(w[i:i + n - 1], ' ') AS gram
          FROM (SELECT *, unnest(range(1, len(w) - n + 2)) AS i FROM toks, (VALUES (1), (2), (3)) s(n)))
SELECT {DD}, label, message_id, sent_pos, category, count(*) AS hits FROM grams JOIN phrases USING (gram) GROUP BY ALL""")
def q_categorize_phrases(spark, sf_dir):
    """Sentences by a taxonomy that is a table of phrases: the beginnings of documents."""
    first = F.slice(F.split(F.lower(F.coalesce("text", F.lit(""))), X.TOKEN_SPLIT, 5), 1, 4)   # the rest of a text is not split
    docs = C.table(spark, sf_dir, "documents").filter("source is not null").select(
        F.col("source").alias("category"), F.array_remove(first, "").alias("w"))
    docs = docs.select("category", "w", F.explode(F.array(F.lit(1), F.lit(2), F.lit(3))).alias("n")).filter(F.size("w") >= F.col("n"))
    phrases = docs.select("category", F.array_join(F.slice("w", 1, F.col("n")), " ").alias("phrase"))
    sent = X.sentences(newsletters(spark, sf_dir, PA))
    return X.phrase_hits(sent, phrases).select(*S.DAY_KEYS, "message_id", "sent_pos", "category", "hits")


@query("categorize", f"""{BASE}
SELECT {DD}, label, message_id, sent_pos, category, hits FROM hits""")
def q_categorize(spark, sf_dir):
    _, h = sent_hits(spark, sf_dir)
    return h.select("digest_date", "label", "message_id", "sent_pos", "category", "hits")


@query("category_bullets", f"""{BASE}, {BULLETS}
SELECT {DD}, label, category, CAST(bullet_pos AS INTEGER) AS bullet_pos, text, time_sensitive FROM bullets""")
def q_category_bullets(spark, sf_dir):
    s, h = sent_hits(spark, sf_dir)
    return X.category_bullets(h).select("digest_date", "label", "category",
                                           F.col("bullet_pos").cast("int").alias("bullet_pos"),
                                           "text", "time_sensitive")


EXEC = f"""scored AS (
  SELECT s.*, coalesce(sc.score, 0) AS score FROM sent s
  LEFT JOIN (SELECT digest_date, label, message_id, sent_pos, sum(hits) AS score FROM hits GROUP BY ALL) sc
  USING (digest_date, label, message_id, sent_pos)),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY digest_date, label ORDER BY score DESC, list_pos, sent_pos) AS r
  FROM (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY digest_date, label, sentence
                                                        ORDER BY list_pos, sent_pos) = 1)
  QUALIFY r <= {X.EXEC_SENTENCES}),
es AS (SELECT digest_date, label, string_agg(sentence, ' ' ORDER BY r) AS executive_summary
       FROM ranked GROUP BY ALL)"""


@query("exec_summary", f"""{BASE}, {EXEC}
SELECT {DD}, label, executive_summary FROM es""")
def q_exec_summary(spark, sf_dir):
    return X.exec_summary(newsletters(spark, sf_dir, PA))


FLAGS = f"""{hits_cte('fh', flags=True)},
fl AS (
  SELECT digest_date, label, s.sentence AS text,
         row_number() OVER (PARTITION BY digest_date, label ORDER BY fh.hits DESC, s.list_pos, s.sent_pos) AS flag_pos
  FROM fh JOIN sent s USING (digest_date, label, message_id, sent_pos))"""


@query("domain_flags", f"""{BASE}, {FLAGS}
SELECT {DD}, label, CAST(flag_pos AS INTEGER) AS flag_pos, text FROM fl""")
def q_domain_flags(spark, sf_dir):
    s = X.sentences(newsletters(spark, sf_dir, PA))
    return X.domain_flags(s).withColumn("flag_pos", F.col("flag_pos").cast("int"))


@query("active_categories", f"""{BASE}, {BULLETS}
SELECT {DD}, label, string_agg(category, ', ' ORDER BY cat_pos) AS active_categories,
       CAST(count(*) AS INTEGER) AS n_active
FROM (SELECT DISTINCT digest_date, label, category, cat_pos FROM bullets) GROUP BY ALL""")
def q_active_categories(spark, sf_dir):
    s, h = sent_hits(spark, sf_dir)
    a = X.active_categories(X.category_bullets(h))
    return a.select("digest_date", "label", F.array_join("active_categories", ", ").alias("active_categories"),
                    F.size("active_categories").alias("n_active"))


@query("insight_merge", f"""{BASE},
h AS (SELECT h.*, s.sentence, s.sender, s.list_pos,
             lower(regexp_replace(s.sentence, '[\\t ]+', ' ', 'g')) AS norm
      FROM hits h JOIN sent s USING (digest_date, label, message_id, sent_pos)),
first AS (SELECT digest_date, label, category, norm, first(sentence ORDER BY list_pos, sent_pos) AS text,
                 count(*) AS n_mentions FROM h GROUP BY ALL),
src AS (SELECT DISTINCT digest_date, label, category, norm, sender FROM h),
nsrc AS (SELECT digest_date, label, category, norm, count(*) AS n_sources,
                string_agg(sender, ', ' ORDER BY sender) AS sources FROM src GROUP BY ALL)
SELECT {DD}, label, category, norm, text, n_mentions, n_sources, sources
FROM first JOIN nsrc USING (digest_date, label, category, norm)""")
def q_insight_merge(spark, sf_dir):
    s, h = sent_hits(spark, sf_dir)
    return X.insight_merge(h).select("digest_date", "label", "category", "norm", "text",
                                        "n_mentions", "n_sources", "sources")


@query("insight_groups", f"""{BASE},
h AS (SELECT h.*, s.sentence, s.sender, s.list_pos,
             lower(regexp_replace(s.sentence, '[\\t ]+', ' ', 'g')) AS norm
      FROM hits h JOIN sent s USING (digest_date, label, message_id, sent_pos)),
w AS (SELECT DISTINCT digest_date, label, category, norm,
             list_filter(string_split_regex(lower(norm), {Q.lit(X.TOKEN_SPLIT)}), lambda t: t <> '') AS w FROM h),
sh AS (SELECT DISTINCT digest_date, label, category, norm, array_to_string(w[i:i + 4], ' ') AS s
       FROM (SELECT *, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM w)),
sz AS (SELECT digest_date, label, category, norm, count(*) AS n FROM sh GROUP BY ALL),
common AS (SELECT a.digest_date, a.label, a.category, a.norm AS x, b.norm AS y, count(*) AS c
           FROM sh a JOIN sh b USING (digest_date, label, category, s) GROUP BY ALL),
pr AS (SELECT digest_date, label, category, x, y FROM common
       JOIN (SELECT digest_date, label, category, norm AS x, n AS nx FROM sz) USING (digest_date, label, category, x)
       JOIN (SELECT digest_date, label, category, norm AS y, n AS ny FROM sz) USING (digest_date, label, category, y)
       WHERE 100 * c >= 80 * (nx + ny - c)),
reach AS (SELECT digest_date, label, category, x, y FROM pr
          UNION SELECT r.digest_date, r.label, r.category, r.x, p.y FROM reach r
          JOIN pr p ON p.digest_date = r.digest_date AND p.label = r.label AND p.category = r.category AND p.x = r.y),
grp AS (SELECT digest_date, label, category, x AS norm, min(y) AS root FROM reach GROUP BY ALL)
SELECT {DD}, label, category, first(sentence ORDER BY list_pos, sent_pos) AS text, count(*) AS n_mentions,
       count(DISTINCT sender) AS n_sources, string_agg(DISTINCT sender, ', ' ORDER BY sender) AS sources,
       count(DISTINCT norm) AS n_wordings
FROM h JOIN grp USING (digest_date, label, category, norm) GROUP BY digest_date, label, category, root""")
def q_insight_groups(spark, sf_dir):
    s, h = sent_hits(spark, sf_dir)
    return X.insight_groups(h)
