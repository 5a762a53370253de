"""Benchmark decontamination with a distributed positional inverted index.

The postings (document, term, position) of every training token whose term occurs in a
benchmark are written as a table, each input partition a segment of its own; no shuffle
is needed for that. The terms' counts over all documents come from the same table.

A window is a run of item words (13, or the whole of a shorter item). Its ``RAREST``
rarest terms are its anchors. Their posting lists, each position less the term's place in
the item, are intersected: an item's words lie on one diagonal of a document, and a window
whose anchors stand on diagonals at most ``SLOP`` apart is a candidate. Candidates are then
compared with the document's text. An exact match has all words of the window in a row. A
proximity match has at least three quarters of them in place: within ``SLOP`` words of where
the rarest anchor puts them. Every exact match is one of proximity too. Only documents with
candidates are shuffled (by a bitmap of their hashes, about one in sixteen of the others).

Broadcasts: the benchmark's terms and anchors, and the bitmap, while their bytes are under
the library's bound; beyond that the joins shuffle. Everything else is aggregated before it
is shuffled, or left to Spark's own choice by size.

Nulls: a null text has no words, no hits, and no items; a null item text has no window; an
item without id makes hits but is not listed. Repeated rows get the same result each.
Items that repeat an id are windows of one item. An empty table gives no rows, an empty
benchmark no hits. Columns besides doc_id and text are kept by ``keep_clean`` only.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.llm.common import let, materialise, small_side
from quire.operators.common import BROADCAST_MAX_BYTES, likely_in

WINDOW = 13
RAREST = 2
SLOP = 3
NEAR_PARTS = (3, 4)            # the share of a window's words that a proximity match has in place
# What separates words once A to Z count as letters, and the end of a text.
SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
END = "\x00"
END_TERM = -1


def lowered(word: Column) -> Column:
    """A to Z in lower case, other letters as they are; most words need nothing."""
    return F.when(F.lower(word) == word, word).otherwise(
        F.translate(word, string.ascii_uppercase, string.ascii_lowercase))


def raw_words(text: Column) -> Column:
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SEPARATORS), "")


def words(text: Column) -> Column:
    return F.transform(raw_words(text), lowered)


def row_key() -> list[Column]:
    """Names a row by id and text; rows that share it have the same words."""
    return [F.coalesce(F.col("doc_id").cast("long"), F.lit(-1)).alias("k1"), F.xxhash64("text").alias("k2")]


def benchmark_items(benchmark: DataFrame) -> DataFrame:
    """(item, item_id, words, size): one row a distinct item; size: words of a window."""
    items = (benchmark.select(F.col("item_id"), words(F.col("text")).alias("words")).distinct()
             .where(F.size("words") > 0))
    return items.select(F.xxhash64("item_id", "words").alias("item"), "item_id", "words",
                        F.least(F.size("words"), F.lit(WINDOW)).alias("size"))


def vocabulary(items: DataFrame) -> DataFrame:
    """(word, term): the benchmark's distinct words, numbered, and the end mark."""
    distinct = items.select(F.explode("words").alias("word")).distinct()
    numbered = distinct.withColumn("term", F.monotonically_increasing_id())
    return numbered.unionAll(items.sparkSession.sql(f"SELECT '\\u0000' AS word, {END_TERM}L AS term"))


def build_index(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """(k1, k2, doc_id, term, pos): the postings of all documents for ``terms`` (word, term).
    A document's end mark stands after its last word."""
    tokens = docs.select(
        *row_key(), F.col("doc_id").cast("long").alias("doc_id"),
        F.posexplode(F.concat(raw_words(F.col("text")), F.array(F.lit(END)))).alias("pos", "raw"))
    tokens = tokens.select("k1", "k2", "doc_id", "pos", lowered(F.col("raw")).alias("word"))
    found = tokens.join(small_side(terms, "index-terms"), "word").select("k1", "k2", "doc_id", "term", "pos")
    return materialise(found, "postings")


def window_anchors(items: DataFrame, terms: DataFrame, index: DataFrame, rarest: int = RAREST) -> DataFrame:
    """(item, start, place, term, rank): of every window the places of its rarest terms,
    rarest first by their counts over all documents, equal counts by word and place."""
    counts = index.where(F.col("term") != END_TERM).groupBy("term").agg(F.count(F.lit(1)).alias("n"))
    at = (items.select("item", "size", F.size("words").alias("length"), F.posexplode("words").alias("place", "word"))
          .join(terms, "word").join(counts, "term", "left"))
    first = F.greatest(F.col("place") - F.col("size") + 1, F.lit(0))
    last = F.least(F.col("place"), F.col("length") - F.col("size"))
    within = at.select("item", "place", "term", "word", F.coalesce("n", F.lit(0)).alias("n"),
                       F.explode(F.sequence(first, last)).alias("start"))
    order = Window.partitionBy("item", "start").orderBy("n", "word", "place")
    ranked = within.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= rarest)
    return materialise(ranked.select("item", "start", "place", "term", "rank"), "anchors")


def aligned_postings(index: DataFrame, anchors: DataFrame) -> DataFrame:
    """(k1, k2, item, place, diagonal): postings of anchor terms less their place."""
    places = small_side(anchors.select("term", "item", "place").distinct(), "anchor-places")
    return (index.select("k1", "k2", "term", "pos").join(places, "term")
            .select("k1", "k2", "item", "place", (F.col("pos") - F.col("place")).alias("diagonal")))


def candidates(index: DataFrame, anchors: DataFrame, slop: int = SLOP) -> DataFrame:
    """(k1, k2, item, hits): windows all of whose anchors stand on diagonals at most ``slop``
    from that of the rarest one, as hits (start: the window's place in the item, diagonal).
    Diagonals are dealt to overlapping bands, each two blocks of slop + 1 wide, so that near
    ones share a band; a hit may come from two bands."""
    windows = (anchors.groupBy("item", "start").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("rank", "place"))), lambda a: a["place"]).alias("places"))
               .groupBy("item").agg(F.collect_list(F.struct("start", "places")).alias("windows"),
                                    F.min(F.size("places")).alias("least")))
    block = F.floor(F.col("diagonal") / (slop + 1))
    bands = F.array(block, block + 1) if slop else F.array(block)
    met = (aligned_postings(index, anchors).withColumn("band", F.explode(bands))
           .groupBy("k1", "k2", "item", "band").agg(F.collect_set(F.struct("place", "diagonal")).alias("met")))

    def near(w: Column, m: Column) -> Column:
        return F.forall(w["places"], lambda p: F.exists(
            "met", lambda o: (o["place"] == p) & (F.abs(o["diagonal"] - m["diagonal"]) <= slop)))

    hits = F.flatten(F.transform("windows", lambda w: F.transform(
        F.filter("met", lambda m: (m["place"] == w["places"][0]) & near(w, m)),
        lambda m: F.struct(w["start"].alias("start"), m["diagonal"].alias("diagonal")))))
    # a band with one anchor alone can only hold windows of a single anchor
    return (met.join(windows, "item").where(F.size("met") >= F.col("least"))
            .select("k1", "k2", "item", F.array_sort(hits).alias("hits")).where(F.size("hits") > 0))


def text_matches(docs: DataFrame, items: DataFrame, found: DataFrame, slop: int = SLOP,
                 max_bytes: int = BROADCAST_MAX_BYTES) -> DataFrame:
    """(k1, k2, spans): of each document with a match the spans (start, size, item_id, exact,
    in_place) where an item's window occurs word by word (exact), or has ``in_place`` words, at
    least three quarters, within ``slop`` of their places. Spans are sorted and may repeat."""
    low = F.element_at("hits", 1)["start"]
    line = F.slice("words", low + 1, F.element_at("hits", -1)["start"] + F.col("size") - low)
    lists = found.join(items, "item").select("k1", "k2", F.struct(
        "size", "item_id", line.alias("line"), F.transform("hits", lambda h: F.struct(
            (h["diagonal"] + h["start"]).alias("at"), (h["start"] - low).alias("skip"))).alias("hits")).alias("c"))
    lists = materialise(lists.groupBy("k1", "k2").agg(F.collect_list("c").alias("cands")), "candidates")
    need_of, parts = NEAR_PARTS

    def in_place(text_words: Column, at: Column, line: Column, size: Column) -> Column:
        def there(i: Column) -> Column:
            first, last = F.greatest(at + i - slop, F.lit(0)), at + i + slop
            return (last >= 0) & F.array_contains(
                F.slice(text_words, first + 1, F.greatest(last - first + 1, F.lit(0))), F.get(line, i))
        return F.size(F.filter(F.sequence(F.lit(0), size - 1), there))

    def spans(text_words: Column) -> Column:
        def of(c: Column) -> Column:
            def judged(h: Column) -> Column:
                same = (h["at"] >= 0) & (F.slice(text_words, F.greatest(h["at"], F.lit(0)) + 1, c["size"])
                                         == F.slice(c["line"], h["skip"] + 1, c["size"]))
                n = F.when(same, c["size"]).otherwise(in_place(
                    text_words, h["at"], F.slice(c["line"], h["skip"] + 1, c["size"]), c["size"]))
                return F.struct(h["at"].alias("start"), c["size"].alias("size"), c["item_id"].alias("item_id"),
                                same.alias("exact"), n.alias("in_place"))
            return F.filter(F.transform(c["hits"], judged), lambda x: x["in_place"] * parts >= x["size"] * need_of)
        return F.sort_array(F.flatten(F.transform("cands", of)))

    rows = docs.select(*row_key(), F.col("text").alias("body"))
    rows = likely_in(rows, lists, "k2", max_bytes).join(lists, ["k1", "k2"])
    return rows.select("k1", "k2", let(words(F.col("body")), spans).alias("spans")).where(F.size("spans") > 0)


def covered(spans: Column) -> Column:
    """How many words lie in the spans, which are sorted by their starts."""
    def step(s: Column, x: Column) -> Column:
        end = x["start"] + x["size"]
        return F.struct((s["n"] + F.greatest(F.lit(0), end - F.greatest(x["start"], s["end"]))).alias("n"),
                        F.greatest(s["end"], end).alias("end"))
    return F.aggregate(spans, F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")), step, lambda s: s["n"])


def contamination(docs: DataFrame, benchmark: DataFrame, slop: int = SLOP) -> DataFrame:
    """(k1, k2, doc_id, n_words, n_hit, n_items, items, contaminated, n_near, near_items) of every
    row of ``docs``: hits, items and the verdict by exact matches, near_items by proximity ones."""
    items = materialise(benchmark_items(benchmark), "benchmark-items")
    terms = materialise(vocabulary(items), "benchmark-terms")
    index = build_index(docs, terms)
    anchors = window_anchors(items, terms, index)
    matches = text_matches(docs, items, candidates(index, anchors, slop), slop)
    exact = F.filter("spans", lambda s: s["exact"])

    def ids(spans: Column) -> Column:
        named = F.filter(F.transform(spans, lambda s: s["item_id"].cast("string")), lambda i: i.isNotNull())
        return F.array_sort(F.array_distinct(named))

    hits = materialise(matches.select("k1", "k2", covered(exact).alias("hit"), ids(exact).alias("ids"),
                                      ids(F.col("spans")).alias("near")).dropDuplicates(["k1", "k2"]), "hits")
    rows = index.where(F.col("term") == END_TERM).select("k1", "k2", "doc_id", F.col("pos").cast("long").alias("n_words"))
    none = F.array().cast("array<string>")
    out = rows.join(hits, ["k1", "k2"], "left").withColumns({
        "n_hit": F.coalesce("hit", F.lit(0)).cast("long"),
        "items": F.coalesce("ids", none), "near_items": F.coalesce("near", none)})
    return out.select("k1", "k2", "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), "items",
                      ((F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"),
                      F.size("near_items").cast("long").alias("n_near"), "near_items")


def keep_clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, columns as they were."""
    bad = contamination(docs, benchmark, slop=0).where("contaminated").select(
        F.col("k1").alias("__decontam_k1"), F.col("k2").alias("__decontam_k2")).distinct()
    bad = materialise(bad, "contaminated")
    k1, k2 = row_key()
    rows = docs.withColumns({"__decontam_k1": k1, "__decontam_k2": k2})
    return rows.join(bad, ["__decontam_k1", "__decontam_k2"], "left_anti").select(docs.columns)
