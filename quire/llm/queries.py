"""Registered queries of the training-data operators, with their SQL where SQL can
express them. The contracts' digest columns are derived here from the operators' output."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm import (decontam, langid, merkle, packing, pii, quality, robust, sharding, simhash, tokenstore,
                       toxicity, trie, warc)
from quire.llm.common import held_out, prepare, table
from quire.llm.oracles import merkle_sql, trie_sql
from quire.llm.tokens import vocabulary_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            prepare(spark)
            return fn(spark, sf_dir)

        run.__name__ = run.__qualname__ = f"query_{name}"
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return deco


@query("op1_warc", oracle="""
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
d AS (SELECT page_id, octet_length(b)::BIGINT AS payload_bytes, sha1(b) AS payload_digest FROM p),
f AS (SELECT payload_digest, max(page_id) AS first FROM d WHERE payload_bytes >= 1000 GROUP BY 1)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN first <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN first <> page_id THEN first END AS refers_to
FROM d LEFT JOIN f USING (payload_digest)""")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archives of all pages, written and read back."""
    return warc.archive_pages(table(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query("op5_packing")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of at most 2048 ids."""
    return packing.pack_documents(table(spark, sf_dir, "documents"), vocabulary_path())


@query("op7_token_files")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token files of all documents, written and read back."""
    return tokenstore.store_documents(table(spark, sf_dir, "documents"), vocabulary_path())


@query("op8_simhash")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


SHARDS = 24


@query("op10_sharding")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard and slot of every document, and its shard with one more."""
    tree = sharding.hash_tree(SHARDS)
    placed = sharding.place_documents(table(spark, sf_dir, "documents"), tree,
                                      sharding.with_own_subtree(tree, SHARDS))
    return placed.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard",
                         F.col("slot").cast("long"), "grown_shard")


@query("op2_quality")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    return quality.with_scores(docs, model).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


@query("op3_language")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document."""
    docs = table(spark, sf_dir, "documents")
    net = langid.train(docs)
    return langid.with_language(docs.select("doc_id", "text"), net).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


PII_KEY = "corpus"         # a run on real data passes its own


@query("op4_pseudonyms")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's text with its personal numbers pseudonymised, and their counts."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pii.pseudonymise(docs, PII_KEY).select(
        "doc_id", "text", *[F.col("pii_counts")[k].cast("long").alias(f"n_{k}") for k in pii.KINDS])


@query("op6_decontamination", oracle=r"""
WITH letters AS (SELECT 'ABCDEFGHIJKLMNOPQRSTUVWXYZ' AS up, 'abcdefghijklmnopqrstuvwxyz' AS low),
d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), up, low),
             '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents, letters),
i AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), up, low),
             '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark, letters),
iw AS (SELECT item_id, w, least(13, len(w)) AS n, unnest(range(0, len(w) - least(13, len(w)) + 1)) AS s
       FROM i WHERE len(w) > 0),
ig AS (SELECT DISTINCT item_id, n, array_to_string(w[s + 1:s + n], ' ') AS g FROM iw),
sizes AS (SELECT DISTINCT n FROM ig),
dw AS (SELECT doc_id, w, n, unnest(range(0, len(w) - n + 1)) AS p FROM d, sizes WHERE len(w) >= n),
m AS (SELECT DISTINCT doc_id, p, n, item_id
      FROM (SELECT doc_id, p, n, array_to_string(w[p + 1:p + n], ' ') AS g FROM dw) JOIN ig USING (n, g)),
hit AS (SELECT doc_id, count(DISTINCT q) AS n_hit
        FROM (SELECT doc_id, unnest(range(p, p + n)) AS q FROM m) GROUP BY 1),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(v, ',' ORDER BY v) AS ids
          FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS v FROM m) GROUP BY 1),
tokens AS (SELECT doc_id, unnest(w) AS word, unnest(range(0, len(w))) AS pos FROM d),
counts AS (SELECT word, count(*) AS c FROM tokens GROUP BY 1),
places AS (SELECT g, item_id, n, unnest(gw) AS word, unnest(range(0, n)) AS place
           FROM (SELECT DISTINCT item_id, n, w[s + 1:s + n] AS gw, array_to_string(w[s + 1:s + n], ' ') AS g FROM iw)),
ranked AS (SELECT places.*, row_number() OVER (PARTITION BY item_id, n, g ORDER BY coalesce(c, 0), word, place) AS r
           FROM places LEFT JOIN counts USING (word)),
one AS (SELECT item_id, n, g, doc_id, pos - place AS at FROM ranked JOIN tokens USING (word) WHERE r = 1),
two AS (SELECT DISTINCT one.* FROM one LEFT JOIN ranked b ON b.r = 2 AND b.n = one.n AND b.g = one.g
            AND b.item_id IS NOT DISTINCT FROM one.item_id
        LEFT JOIN tokens t ON t.doc_id = one.doc_id AND t.word = b.word AND abs(t.pos - b.place - one.at) <= 3
        WHERE b.word IS NULL OR t.word IS NOT NULL),
near AS (SELECT two.doc_id, two.item_id, two.n, two.g, two.at
         FROM two JOIN places p ON p.n = two.n AND p.g = two.g AND p.item_id IS NOT DISTINCT FROM two.item_id
         JOIN tokens t ON t.doc_id = two.doc_id AND t.word = p.word AND abs(t.pos - p.place - two.at) <= 3
         GROUP BY ALL HAVING 4 * count(DISTINCT p.place) >= 3 * two.n),
near_items AS (SELECT doc_id, count(DISTINCT item_id) AS n_near FROM near GROUP BY 1)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
       coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       (coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w)) AS contaminated,
       coalesce(n_near, 0)::BIGINT AS n_near
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id) LEFT JOIN near_items USING (doc_id)""")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark phrases in every document; ``n_near``: items with a proximity match."""
    found = decontam.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items",
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated", "n_near")


@query("op9_quality_rules")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics of every document, the base rules, and the outliers' verdict."""
    return robust.judge(table(spark, sf_dir, "documents"), ["doc_id"]).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


@query("op11_toxicity")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return toxicity.with_toxicity(docs, model, passages=False).select(
        "doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


@query("op12_merkle", oracle=merkle_sql())
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf, proof and verification of every document."""
    return merkle.manifest(table(spark, sf_dir, "documents"))


@query("op13_trie", oracle=trie_sql())
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nodes of the trie over all rebuilt conversations, with the totals of their subtrees."""
    return trie.prefix_trie(table(spark, sf_dir, "conversations")).select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
