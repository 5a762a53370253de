"""Digest assembly, model-answer parsing and page properties (T12-T13, I5, I7-I8,
G5, C10, C13, J3, X-assembly).

A digest is one row per (digest_date, label):
  executive_summary STRING, categories MAP<STRING, ARRAY<STRING>> (ordered),
  per_source ARRAY<STRUCT<source, summary, key_facts, links>>, domain_flags ARRAY<STRING>,
  active_categories ARRAY<STRING>, parse_error STRING, raw_response STRING
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.functions import taxonomy as TX
from quire.functions.text import let, strip_fence, ustrip
from quire.operators import extract as X
from quire.operators.prompts import long_date
from quire.operators.select import DAY_KEYS
from quire.params import DEFAULT, Params

# Fallback digest text (its "Failed" prefix drives the status),
# page title format and property defaults.
FALLBACK_SUMMARY = "Failed to parse newsletter digest. Check logs."
NO_ANSWER = "invalid JSON: empty answer"
NO_OBJECT = "invalid JSON: no object at the start"
NOT_ONE_OBJECT = "invalid JSON: malformed, or text after the object"
TITLE_FORMAT = TX.TITLE_ICON + " Newsletter Digest — %s"
UNKNOWN_SOURCE = "Unknown"
URL = r"https?://[^\s<>\"')]+"

SOURCE_T = T.StructType([
    T.StructField("source", T.StringType()), T.StructField("summary", T.StringType()),
    T.StructField("key_facts", T.ArrayType(T.StringType())), T.StructField("links", T.ArrayType(T.StringType())),
])
ANSWER_T = T.StructType([
    T.StructField("executive_summary", T.StringType()),
    T.StructField("categories", T.MapType(T.StringType(), T.ArrayType(T.StringType()))),
    T.StructField("per_source", T.ArrayType(SOURCE_T)),
    T.StructField("domain_flags", T.ArrayType(T.StringType())),
    T.StructField("active_categories", T.ArrayType(T.StringType())),
    T.StructField("_parse_error", T.StringType()),
])


def empty_array(t: str = "string") -> Column:
    return F.array().cast(f"array<{t}>")


def empty_categories() -> Column:
    return F.map_from_arrays(empty_array(), F.array().cast("array<array<string>>"))


# --------------------------------------------------------------------------- assembly
def extractive_digests(nl: DataFrame, p: Params = DEFAULT, tx: TX.Taxonomy = TX.DEFAULT) -> DataFrame:
    """Build each day's digest from its selected newsletters with the extractive
    analogues. Needs bounded days (``max_messages``): per_source has one entry per
    message of the day. Links are those of the message's markup where it came with them
    (``links``), else the addresses in its text."""
    if p.max_messages is None:
        raise ValueError("digest assembly needs a per-day message limit (max_messages)")
    k = DAY_KEYS
    hits, flagged = X.categories_and_flags(X.sentences(nl), tx)
    bullets = X.category_bullets(hits)
    in_text = F.array_distinct(F.regexp_extract_all(F.col("body"), F.lit(URL), 0))
    links = F.coalesce(F.col("links"), in_text) if "links" in nl.columns else in_text
    entry = let(X.sentence_list(F.col("body")), lambda s: F.struct(
        F.col("sender").alias("source"), F.array_join(F.slice(s, 1, X.LEAD_SENTENCES), " ").alias("summary"),
        X.facts_of(s).alias("key_facts"), links.alias("links")))
    per_source = (nl.select(*k, "list_pos", "message_id", entry.alias("e")).groupBy(*k)
                  .agg(F.transform(F.array_sort(F.collect_list(F.struct("list_pos", "message_id", "e"))),
                                   lambda x: x["e"]).alias("per_source")))
    per_cat = (bullets.groupBy(*k, "category", "cat_pos")
               .agg(F.transform(F.array_sort(F.collect_list(F.struct("bullet_pos", "text"))),
                                lambda x: x["text"]).alias("items")))
    cats = (per_cat.groupBy(*k)
            .agg(F.array_sort(F.collect_list(F.struct("cat_pos", "category", "items"))).alias("c"))
            .select(*k, F.map_from_entries(F.transform("c", lambda x: F.struct(x["category"], x["items"])))
                    .alias("categories"),
                    F.transform("c", lambda x: x["category"]).alias("active_categories")))
    flags = (flagged.groupBy(*k)      # of at most max_messages messages
             .agg(F.transform(F.array_sort(F.collect_list(F.struct(*X.FLAG_ORDER, "sentence"))),
                              lambda x: x["sentence"]).alias("domain_flags")))
    es = X.exec_summary(nl, tx)
    d = per_source.join(es, k, "left").join(cats, k, "left").join(flags, k, "left")
    return d.select(*k, "executive_summary",
                    F.coalesce("categories", empty_categories()).alias("categories"),
                    "per_source",
                    F.coalesce("domain_flags", empty_array()).alias("domain_flags"),
                    F.coalesce("active_categories", empty_array()).alias("active_categories"))


# Fixed value: the summary of a day without input.
NO_INPUT_SUMMARY = "No newsletters received today."


def empty_digest() -> Column:
    """The digest of a day without input (I6). Days without messages produce no row,
    as in the reference's command line run; this is the library default."""
    return F.struct(F.lit(NO_INPUT_SUMMARY).alias("executive_summary"), empty_categories().alias("categories"),
                    F.array().cast(T.ArrayType(SOURCE_T)).alias("per_source"),
                    empty_array().alias("domain_flags"), empty_array().alias("active_categories"),
                    F.lit(None).cast("string").alias("parse_error"), F.lit(None).cast("string").alias("raw_response"))


def digest_json(d: DataFrame) -> Column:
    """The digest as the JSON answer a model would give."""
    return F.to_json(F.struct(*[F.col(c) for c in
                                ["executive_summary", "categories", "per_source", "domain_flags",
                                 "active_categories"]]))


# --------------------------------------------------------------------------- parsing
def parse_answer(text: Column, error: Column | None = None) -> Column:
    """Model answer text -> digest struct; malformed JSON (or a failed call) gives
    the fallback digest with the error and the first 2000 chars of the raw text."""
    strict = {"mode": "PERMISSIVE", "allowSingleQuotes": "false"}

    def read(cleaned: Column) -> Column:
        # one JSON value and nothing else: read as the only element of an array
        alone = F.size(F.from_json(F.concat(F.lit("["), cleaned, F.lit("]")), "array<string>", strict)) == 1
        answer = F.from_json(cleaned, ANSWER_T, strict)       # a field of a wrong type is null, the rest stays
        return let(answer, lambda j: judged(cleaned, F.coalesce(alone, F.lit(False)), j))

    def judged(cleaned: Column, alone: Column, j: Column) -> Column:
        why = (F.when(cleaned == "", NO_ANSWER).when(~F.startswith(cleaned, F.lit("{")), NO_OBJECT)
                .when(~alone | j.isNull(), NOT_ONE_OBJECT))
        if error is not None:
            why = F.coalesce(error, why)
        return let(why, lambda w: F.when(w.isNotNull(), fallback(w)).otherwise(parsed(j)))

    def parsed(j: Column) -> Column:
        return F.struct(j["executive_summary"].alias("executive_summary"),
                        F.coalesce(j["categories"], empty_categories()).alias("categories"),
                        F.coalesce(j["per_source"], F.array().cast(T.ArrayType(SOURCE_T))).alias("per_source"),
                        F.coalesce(j["domain_flags"], empty_array()).alias("domain_flags"),
                        F.coalesce(j["active_categories"], empty_array()).alias("active_categories"),
                        j["_parse_error"].alias("parse_error"),
                        F.lit(None).cast("string").alias("raw_response"))

    def fallback(why: Column) -> Column:
        return F.struct(F.lit(FALLBACK_SUMMARY).alias("executive_summary"),
                        empty_categories().alias("categories"),
                        F.array().cast(T.ArrayType(SOURCE_T)).alias("per_source"),
                        empty_array().alias("domain_flags"), empty_array().alias("active_categories"),
                        why.alias("parse_error"), F.substring(text, 1, 2000).alias("raw_response"))

    # each step is bound by ``let``: the text is cleaned once and read once, not once a field
    return let(ustrip(F.coalesce(strip_fence(text), F.lit(""))), read)


def parse_responses(resp: DataFrame, keys: list[str] = DAY_KEYS) -> DataFrame:
    """(keys, response[, error, warning]) -> digests. A warning (parts of the day that
    failed) is kept beside a good digest, whose status then is Partial."""
    err = F.col("error") if "error" in resp.columns else None
    d = resp.select(*keys, *[c for c in ("warning",) if c in resp.columns],
                    parse_answer(F.col("response"), err).alias("d"))
    if "warning" in resp.columns:
        both = F.concat_ws("; ", F.col("d.parse_error"), F.col("warning"))
        d = d.withColumn("d", F.col("d").withField("parse_error", F.nullif(both, F.lit(""))))
    return d.select(*keys, "d.*")


# --------------------------------------------------------------------------- page properties
def status(executive_summary: Column, parse_error: Column) -> Column:
    """Failed (checked last in the reference, so it wins) > Partial > Generated."""
    es = executive_summary
    failed = es.isNull() | (es == "") | F.startswith(es, F.lit("Failed"))
    return (F.when(failed, F.lit("Failed"))
             .when(F.coalesce(parse_error, F.lit("")) != "", F.lit("Partial"))
             .otherwise(F.lit("Generated")))


def whitelist(active: Column, tx: TX.Taxonomy = TX.DEFAULT) -> Column:
    """Keep known category names, in order, duplicates kept."""
    allowed = F.array(*[F.lit(n) for n in tx.names()])
    return F.filter(F.coalesce(active, empty_array()), lambda c: F.array_contains(allowed, c))


def source_list(per_source: Column, p: Params = DEFAULT) -> Column:
    """Comma-joined source names, missing -> Unknown, cut at the text limit."""
    names = F.transform(F.coalesce(per_source, F.array().cast(T.ArrayType(SOURCE_T))),
                        lambda s: F.coalesce(s["source"], F.lit(UNKNOWN_SOURCE)))
    return F.substring(F.array_join(names, ", "), 1, p.text_limit)


def icon_of(category: Column, tx: TX.Taxonomy = TX.DEFAULT) -> Column:
    """Category -> icon, default icon when unknown (J3). The taxonomy is a fixed
    literal map, so this is a lookup inside the projection, not a join."""
    m = F.create_map(*[x for n, i in tx.categories for x in (F.lit(n), F.lit(i))])
    return F.coalesce(F.try_element_at(m, category), F.lit(tx.default_icon))


def digest_pages(digests: DataFrame, counts: DataFrame, p: Params = DEFAULT,
                 tx: TX.Taxonomy = TX.DEFAULT) -> DataFrame:
    """One page-property row per (digest_date, label) (I8)."""
    d = digests.join(counts, DAY_KEYS)
    return d.select(
        *DAY_KEYS,
        F.format_string(TITLE_FORMAT, long_date(F.col("digest_date"))).alias("title"),
        F.col("newsletter_count").cast("bigint").alias("newsletter_count"),
        whitelist(F.col("active_categories"), tx).alias("categories"),
        status(F.col("executive_summary"), F.col("parse_error")).alias("status"),
        source_list(F.col("per_source"), p).alias("sources"),
    )
