"""Deterministic, extractive stand-ins for what the prompt asks the model.

They honour the *shape* of the requested briefing (per-source summaries, facts,
links, categorised bullets, executive summary, domain flags) so the pipeline runs
and can be tested offline. What belongs to one message or sentence is computed inside its
row; only what ranks or merges within a day is shuffled.
"""

from __future__ import annotations

from collections import Counter

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.functions import taxonomy as TX
from quire.functions.text import let, link_targets, ustrip
from quire.operators import near as NEAR
from quire.operators.common import (BROADCAST_MAX_BYTES, ROW_OVERHEAD, bounded_broadcast, bounded_side, likely_in, number_rows,
                                    persist, stored)
from quire.operators.select import DAY_KEYS

# Fixed values of the extractive analogue (ours; shared with the SQL oracle).
SENTENCE = r"[^.!?\n]+[.!?]*"
TOKEN_SPLIT = r"[^\p{L}\p{N}$]+"
FACT = r"[0-9$%\"]"
TIME_SENSITIVE = r"(?i)(deadline|today|tomorrow|this week|register|apply by|due )"
LEAD_SENTENCES = 3
BULLETS_PER_CATEGORY = 5
EXEC_SENTENCES = 4
USE_ONE_IN = 64                # of so many sentences one tells which phrases are used most
SENTENCES_A_TASK = 50_000      # that are looked up in a table of phrases
MAX_PAIRS = 16                 # sums of two categories' counts that stand side by side


def sentence_list(body: Column) -> Column:
    return F.filter(F.transform(F.regexp_extract_all(body, F.lit(SENTENCE), 0), ustrip), lambda s: s != "")


def sentences(nl: DataFrame) -> DataFrame:
    """(keys, message_id, list_pos, sender, sent_pos, sentence), sent_pos from 1."""
    return (nl.select(*DAY_KEYS, "message_id", "list_pos", "sender",
                      F.posexplode(sentence_list(F.col("body"))).alias("p", "sentence"))
              .withColumn("sent_pos", (F.col("p") + 1).cast("int")).drop("p"))


SENT_COLS = [*DAY_KEYS, "message_id", "list_pos", "sender", "sent_pos", "sentence"]


def tokens(sentence: Column) -> Column:
    return F.split(F.lower(sentence), TOKEN_SPLIT)


def known(toks: Column, words: list[str]) -> Column:
    """The tokens that are among ``words``."""
    return F.filter(toks, lambda t: t.isin(sorted(set(words))))


def hits_of(toks: Column, words: list[str]) -> Column:
    return F.size(F.filter(toks, lambda t: t.isin(words))).cast("bigint")


def keyword_hits(sent: DataFrame, groups: list[tuple[str, int, list[str]]]) -> DataFrame:
    """Multi-label keyword matching: one row per (sentence, category) with its hit count.
    The words are configuration and become literals; a sentence is counted inside its
    row, so nothing is shuffled. Of its tokens only those that are some group's word are
    looked at by group."""
    found = F.filter(F.array(*[F.struct(F.lit(name).alias("category"), F.lit(pos).alias("cat_pos"),
                                        hits_of(F.col("__toks"), words).alias("hits"))
                               for name, pos, words in groups]), lambda x: x["hits"] > 0)
    return sent.withColumn("__toks", known(tokens(F.col("sentence")), [w for _, _, words in groups for w in words])).select(*SENT_COLS, F.inline(found))


def lead_summary(nl: DataFrame) -> DataFrame:
    """First sentences of each message as its summary."""
    lead = F.slice(sentence_list(F.col("body")), 1, LEAD_SENTENCES)
    return nl.select(*DAY_KEYS, "message_id", F.array_join(lead, " ").alias("summary")).filter("summary <> ''")


def facts_of(sentences: Column) -> Column:
    return F.filter(sentences, lambda s: s.rlike(FACT))


def fact_list(body: Column) -> Column:
    return facts_of(sentence_list(body))


def key_facts(nl: DataFrame) -> DataFrame:
    """Sentences carrying numbers, currency, percentages or quotes."""
    return (nl.select(*DAY_KEYS, "message_id", F.posexplode(fact_list(F.col("body"))).alias("p", "fact"))
              .select(*DAY_KEYS, "message_id", (F.col("p") + 1).alias("fact_pos"), "fact"))


def extract_links(df: DataFrame, id_col: str, html_col: str) -> DataFrame:
    """Distinct link targets in first-seen order, taken before markup is removed."""
    return (df.select(id_col, F.posexplode(link_targets(F.col(html_col))).alias("p", "link"))
              .select(id_col, (F.col("p") + 1).cast("int").alias("link_pos"), "link"))


def category_words(tx: TX.Taxonomy) -> list[tuple[str, int, list[str]]]:
    return [(n, i, tx.words(n)) for i, n in enumerate(tx.names(), 1)]


def categorize(sent: DataFrame, tx: TX.Taxonomy = TX.DEFAULT) -> DataFrame:
    """Sentence -> categories by keyword hits."""
    return keyword_hits(sent, category_words(tx))


def plain_words(text: Column) -> Column:
    """The words that ``tokens`` gives, joined by single blanks."""
    return F.trim(F.regexp_replace(F.lower(text), TOKEN_SPLIT, " "))


def phrase_table(phrases: DataFrame) -> DataFrame:
    """A taxonomy table (category, phrase) as (category, gram, n_words): a phrase's words, split
    and lowered as those of sentences are."""
    return (phrases.select("category", plain_words(F.col("phrase")).alias("gram")).filter("gram <> ''")
            .withColumn("n_words", F.size(F.split("gram", " "))).distinct())


def sides_by_use(side: DataFrame, runs: DataFrame, max_bytes: int) -> tuple[DataFrame, DataFrame]:
    """Stored phrases as (those that sentences use most, up to ``max_bytes``; the others). How often they
    are used is counted in ``runs``, a part of the sentences' runs: it decides how a phrase is
    joined, never whether."""
    used = runs.groupBy("gram").agg(F.count(F.lit(1)).alias("times"))
    columns = side.columns
    side = persist(side.join(used, "gram", "left").withColumn("times", F.coalesce("times", F.lit(0))))
    by_times = side.groupBy(F.least("times", F.lit(10000)).alias("times")).agg(
        F.sum(F.octet_length(F.to_json(F.struct(*columns))) + 2 * ROW_OVERHEAD).alias("bytes"))
    least, held = 1 << 62, 0
    for r in by_times.sort(F.desc("times")).collect():
        held += r.bytes
        if held > max_bytes or r.times == 0:
            break
        least = r.times
    hot = F.col("times") >= least
    return side.filter(hot).drop("times"), side.filter(~hot).drop("times")


def category_codes(side: DataFrame) -> DataFrame:
    """(category, code): the categories of stored phrases, numbered from 0, those of most phrases first."""
    sizes = side.groupBy("category").agg((-F.count(F.lit(1))).alias("fewer"))
    return number_rows(sizes, [], ["fewer", "category"], "code").select("category", (F.col("code") - 1).alias("code"))


def packed_phrases(side: DataFrame, codes: DataFrame, pairs: int) -> DataFrame:
    """(gram, block, mask): a phrase's categories as bits, a row for each block of ``2 * pairs`` codes
    that has any. Category i of a block is bit i, or bit 32 + i - pairs from the middle on."""
    lane = (F.col("code") % (2 * pairs)).cast("int")
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.when(lane < pairs, lane).otherwise(lane + (32 - pairs)))
    coded = side.join(codes, side["category"].eqNullSafe(codes["category"]))
    return coded.groupBy("gram", F.floor(F.col("code") / (2 * pairs)).alias("block")).agg(F.bit_or(bit).alias("mask"))


def phrase_hits(sent: DataFrame, phrases: DataFrame, max_bytes: int = BROADCAST_MAX_BYTES) -> DataFrame:
    """Categories of sentences by a taxonomy table of phrases (X4): one row per (sentence,
    category) with how often its phrases occur. A sentence's runs of as many words as some
    phrase has are looked up in the table, which is broadcast while it has few bytes; so the
    table may hold any number of phrases, and plans do not grow with it. A sentence's rows stay in
    one task from its words to its counts, so its runs are not shuffled. Of a larger table the
    phrases used most are broadcast all the same; of the runs left only those that are likely
    phrases by a bitmap of these are shuffled. Runs are looked up by a hash of their words, and compared.
    A run found is one row for up to ``2 * MAX_PAIRS`` categories, not one for each: they are counted side by side,
    two in a sum, as no sentence has 2^31 runs. A task has a bounded number of sentences."""
    key = [*DAY_KEYS, "message_id", "list_pos", "sender", "sent_pos"]
    side = persist(phrase_table(phrases))
    lengths = [r[0] for r in side.select("n_words").distinct().sort("n_words").collect()]
    codes = bounded_broadcast(category_codes(side), max_bytes)
    pairs = min(MAX_PAIRS, max(1, -(-codes.count() // 2)))
    packed, few = bounded_side(packed_phrases(side, codes, pairs), max_bytes)
    sent = stored(sent.select(*key, plain_words(F.col("sentence")).alias("__words")).filter("__words <> ''"))

    run = F.slice("__toks", F.col("__at") + 1, F.col("__n"))
    gram = F.array_join(run, " ")

    def runs_of(rows: DataFrame) -> DataFrame:
        rows = rows.select(*key, F.split("__words", " ").alias("__toks"))
        rows = rows.select(*key, "__toks", F.posexplode_outer("__toks").alias("__at", "__word"))   # none is empty; no filter splits them twice
        rows = rows.select(*key, "__toks", "__at", F.explode(F.array(*map(F.lit, lengths)).cast("array<int>")).alias("__n"))
        return rows.filter(F.col("__at") + F.col("__n") <= F.size("__toks")).withColumn("__hash", F.xxhash64(run))

    def hashed(rows: DataFrame) -> DataFrame:
        return rows.withColumn("__hash", F.xxhash64(F.split("gram", " ")))

    def found_in(rows: DataFrame, side: DataFrame) -> DataFrame:
        """Not by a second key of text: that would be built of every run, found or not."""
        side = hashed(side).withColumnRenamed("__hash", "__key")
        same = (F.col("__hash") == F.col("__key")) & F.coalesce(gram == F.col("gram"), F.lit(False))
        return rows.join(F.broadcast(side), same).select(*key, "block", "mask")

    tasks = max(sent.sparkSession.sparkContext.defaultParallelism, -(-sent.count() // SENTENCES_A_TASK))
    dealt = sent.repartition(tasks, "message_id", "sent_pos")
    if few:
        found = found_in(runs_of(dealt), packed)
    else:
        some = sent.filter(F.pmod(F.xxhash64("message_id", "sent_pos"), F.lit(USE_ONE_IN)) == 0)
        often, seldom = sides_by_use(packed, runs_of(some).select(gram.alias("gram")), max_bytes)
        seldom = persist(seldom)
        rest = likely_in(runs_of(sent), hashed(seldom).select("__hash"), "__hash", max_bytes)
        rest = rest.select(*key, gram.alias("gram")).join(seldom, "gram").select(*key, "block", "mask")
        found = found_in(runs_of(dealt), often).unionByName(rest)

    both = F.lit((1 << 32) + 1)
    sums = [F.sum(F.shiftright("mask", i).bitwiseAND(both)).alias(f"__sum{i}") for i in range(pairs)]
    counted = found.groupBy(*key, "block").agg(*sums)
    lanes = [F.col(f"__sum{i}").bitwiseAND(F.lit((1 << 32) - 1)) for i in range(pairs)] + [
        F.shiftright(f"__sum{i}", 32) for i in range(pairs)]
    hits = counted.select(*key, "block", F.posexplode(F.array(*lanes)).alias("__lane", "hits")).filter("hits > 0")
    return (hits.withColumn("code", F.col("block") * (2 * pairs) + F.col("__lane")).join(codes, "code")
            .select(*key, "category", "hits"))


def category_bullets(hits: DataFrame) -> DataFrame:
    """Top sentences per (day, label, category) by hits, then list order (X5), with
    their source and a time-sensitivity flag (X9). A sentence that comes again stands once,
    where it comes first. Top-k is planned map-side."""
    first = hits.groupBy(*DAY_KEYS, "category", "cat_pos", "sentence").agg(
        F.max("hits").alias("hits"), F.min(F.struct("list_pos", "sent_pos", "sender")).alias("at"))
    first = first.select("*", "at.*").drop("at")
    w = Window.partitionBy(*DAY_KEYS, "category").orderBy(F.desc("hits"), "list_pos", "sent_pos")
    top = first.withColumn("bullet_pos", F.row_number().over(w)).filter(F.col("bullet_pos") <= BULLETS_PER_CATEGORY)
    return top.select(*DAY_KEYS, "category", "cat_pos", "bullet_pos",
                      F.format_string("%s (Source: %s)", F.col("sentence"), F.col("sender")).alias("text"),
                      F.col("sentence").rlike(TIME_SENSITIVE).alias("time_sensitive"))


def exec_summary(nl: DataFrame, tx: TX.Taxonomy = TX.DEFAULT) -> DataFrame:
    """The day's best different sentences by total keyword hits, ties by position (X6). A
    message gives at most its own best few, chosen inside its row: what is behind them
    there is behind them in the day. Only those are shuffled."""
    times = Counter(w for _, _, words in category_words(tx) for w in words)    # a word of two categories counts twice
    equal = {n: [w for w, k in times.items() if k == n] for n in sorted(set(times.values()))}

    def ranked(s: Column, i: Column) -> Column:
        score = let(known(tokens(s), list(times)), lambda toks: sum((hits_of(toks, words) * n for n, words in equal.items()),
                                                F.lit(0).cast("bigint")))
        return F.struct((-score).alias("worse"), i.alias("sent_pos"), s.alias("sentence"))

    best = F.slice(F.array_sort(F.transform(F.array_distinct(sentence_list(F.col("body"))), ranked)), 1, EXEC_SENTENCES)
    rows = nl.select(*DAY_KEYS, "list_pos", F.inline(best))
    first = rows.groupBy(*DAY_KEYS, "sentence").agg(F.min(F.struct("worse", "list_pos", "sent_pos")).alias("at"))
    w = Window.partitionBy(*DAY_KEYS).orderBy("at")
    top = first.withColumn("r", F.row_number().over(w)).filter(F.col("r") <= EXEC_SENTENCES)
    return (top.groupBy(*DAY_KEYS)
               .agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("r", "sentence"))),
                                             lambda x: x["sentence"]), " ").alias("executive_summary")))


FLAG_ORDER = ["fewer", "list_pos", "sent_pos", "message_id"]


def flag_words(tx: TX.Taxonomy) -> tuple[str, int, list[str]]:
    """The domain flags as one more group, in front of the categories (whose positions are from 1)."""
    return "flag", 0, list(tx.flag_keywords)


def as_flags(hits: DataFrame) -> DataFrame:
    """Hits of the domain-flag keywords, with the columns of their order."""
    return hits.withColumn("fewer", -F.col("hits")).select(*DAY_KEYS, *FLAG_ORDER, "sentence")


def flag_hits(sent: DataFrame, tx: TX.Taxonomy = TX.DEFAULT) -> DataFrame:
    """Sentences touching the domain-flag keywords, with the columns of their order."""
    return as_flags(keyword_hits(sent, [flag_words(tx)]))


def categories_and_flags(sent: DataFrame, tx: TX.Taxonomy = TX.DEFAULT) -> tuple[DataFrame, DataFrame]:
    """(``categorize``, ``flag_hits``) of the sentences, which are split and looked up once; their
    hits are written."""
    hits = stored(keyword_hits(sent, [flag_words(tx), *category_words(tx)]))
    return hits.filter("cat_pos > 0"), as_flags(hits.filter("cat_pos = 0"))


def domain_flags(sent: DataFrame, tx: TX.Taxonomy = TX.DEFAULT) -> DataFrame:
    """All sentences touching the domain-flag keywords, best first (X7). They are numbered by
    a range sort, so a day may have any number of them."""
    numbered = number_rows(flag_hits(sent, tx), DAY_KEYS, FLAG_ORDER, "flag_pos")
    return numbered.select(*DAY_KEYS, "flag_pos", F.col("sentence").alias("text"))


def active_categories(bullets: DataFrame) -> DataFrame:
    """Categories that have content, in taxonomy order."""
    c = bullets.select(*DAY_KEYS, "category", "cat_pos").distinct()
    return (c.groupBy(*DAY_KEYS)
             .agg(F.transform(F.array_sort(F.collect_list(F.struct("cat_pos", "category"))),
                              lambda x: x["category"]).alias("active_categories")))


INSIGHT = [*DAY_KEYS, "category", "norm"]


def said_by(hits: DataFrame) -> DataFrame:
    """(day, label, category, normalised text, sender, first wording with its place, n): one row a source."""
    said = F.struct("list_pos", "sent_pos", F.col("sentence").alias("text"))
    return (hits.withColumn("norm", F.lower(F.regexp_replace(F.col("sentence"), r"[\t ]+", " ")))
            .groupBy(*INSIGHT, "sender").agg(F.min(said).alias("first"), F.count(F.lit(1)).alias("n")))


def merged(per_source: DataFrame, keys: list[str], *more: Column) -> DataFrame:
    return per_source.groupBy(*keys).agg(
        F.min("first")["text"].alias("text"), F.sum("n").alias("n_mentions"),
        F.count(F.lit(1)).alias("n_sources"),
        F.array_join(F.array_sort(F.collect_list("sender")), ", ").alias("sources"), *more)


def insight_merge(hits: DataFrame) -> DataFrame:
    """Combine and deduplicate insights of a day across messages/chunks (G8): one row per
    (day, label, category, normalised text) with the first wording, how often it comes, and
    its sources in alphabetical order. One row a source first, combined map-side, so no
    group gathers all mentions."""
    return merged(said_by(hits), INSIGHT)


def insight_groups(hits: DataFrame, percent: int = NEAR.PERCENT, shingle: int = NEAR.SHINGLE) -> DataFrame:
    """As ``insight_merge``, but insights of nearly equal wording are one, too (G8): those whose runs of
    ``shingle`` words overlap by at least ``percent``, directly or through others. ``n_wordings`` is the
    number of different normalised texts. The first wording is the text."""
    keys = [*DAY_KEYS, "category"]
    per_source = stored(said_by(hits))
    norms = per_source.select(*INSIGHT).distinct()
    words = F.filter(tokens(F.col("norm")), lambda t: t != "")
    near = stored(NEAR.near_groups(norms, keys, words, percent, shingle))
    wordings = near.groupBy(*keys, "near_id").agg(F.count(F.lit(1)).alias("n_wordings"))
    once = (per_source.join(near, INSIGHT).groupBy(*keys, "near_id", "sender")
            .agg(F.min("first").alias("first"), F.sum("n").alias("n")))
    return merged(once, [*keys, "near_id"]).join(wordings, [*keys, "near_id"]).drop("near_id")
