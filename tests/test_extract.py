"""Links, references, phrases, and sentences that come again."""

import datetime as dt
import html

from pyspark.sql import functions as F

from quire.functions.text import decode_entities, link_targets
from quire.operators import extract as X
from quire.operators.common import likely_in, number_rows, persist

DAY = dt.date(2024, 1, 1)


def test_link_forms(spark):
    page = """<a href="http://a/?x=1&amp;y=2">1</a><A class=k HREF='b.html'>2</A><a href=c>3</a><a
      href = "d" >4</a><area href="e"><a href="">none</a><a href="c">again</a><link href="style.css"><a name=x>no</a>
      <abbr href="no">5</abbr><a data-x="1" href=' f '>6</a> href="g" <a <a href=h>7</a><a href="mailto:i&copy;">8</a>"""
    got = spark.createDataFrame([(page,), (None,), ("",)], "h string").select(link_targets(F.col("h")).alias("l")).collect()
    assert got[0].l == ["http://a/?x=1&y=2", "b.html", "c", "d", "e", "f", "h", "mailto:i©"]
    assert not got[1].l and got[2].l == []


def test_many_open_anchors_are_linear(spark):
    page = "<a x " * 200_000
    assert spark.createDataFrame([(page,)], "h string").select(F.size(link_targets(F.col("h"))).alias("n")).first().n == 0


def test_references_without_semicolon(spark):
    texts = ["AT&ampT", "&copy 2024", "&notit;", "&notin;", "&amp;lt;", "&ltb&gt", "a & b", "&unknown;", "&unknown",
             "&#38lt;", "&#x41 b", "&#65;", "&#65", "&eacutecole", "&Eacute", "x &AMP", "&ampamp;", "&frac12x", "&;", "&#;"]
    got = spark.createDataFrame([(t,) for t in texts], "t string").select("t", decode_entities(F.col("t")).alias("d")).collect()
    assert {r.t: r.d for r in got} == {t: html.unescape(t) for t in texts}


def _sentences(spark, texts, sender="s"):
    rows = [(DAY, "L", i, i, sender, t) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "digest_date date, label string, message_id long, list_pos long, sender string, body string")


def test_phrases_from_a_large_table(spark):
    phrases = spark.range(100_000).select(F.concat(F.lit("c"), F.col("id") % 7).alias("category"),
                                          F.concat(F.lit("Word"), "id", F.lit("  of "), F.col("id") % 3).alias("phrase"))
    few = spark.createDataFrame([("x", "new  York-City"), ("x", "york"), ("y", "city"), ("y", ""), ("y", None), ("z", "no such")],
                                "category string, phrase string")
    sent = X.sentences(_sentences(spark, ["New York city, york.", "word5 of 2 Word99999 of 0", "word5 of 1", ""]))
    got = {(r.message_id, r.category): r.hits for r in X.phrase_hits(sent, phrases.unionByName(few)).collect()}
    assert got == {(0, "x"): 3, (0, "y"): 1, (1, f"c{5 % 7}"): 1, (1, f"c{99999 % 7}"): 1}
    assert X.phrase_hits(sent, few.limit(0)).collect() == []


def test_no_sentence_stands_twice(spark):
    nl = _sentences(spark, ["AI model wins. AI model wins. Plain one.", "AI model wins. AI alone.", "Plain one. Other."])
    es = X.exec_summary(nl).first().executive_summary
    assert es == "AI model wins. AI alone. Plain one. Other."
    bullets = X.category_bullets(X.categorize(X.sentences(nl))).collect()
    texts = [(r.category, r.text) for r in bullets]
    assert len(texts) == len(set(texts)) and any("AI model wins." in t for _, t in texts)


def test_numbers_of_a_hot_key(spark):
    rows = spark.range(6000).select(F.when(F.col("id") % 3 > 0, F.lit("hot")).alias("k"), (F.col("id") * 7919 % 6007).alias("o"))
    got = number_rows(rows.repartition(12), ["k"], ["o"], "n").toPandas()
    for _, part in got.groupby("k", dropna=False):
        part = part.sort_values("o")
        assert part["n"].tolist() == list(range(1, len(part) + 1))


def test_phrases_beyond_the_broadcast_bound(spark):
    """A table too large to broadcast gives the same counts, and its most used phrases are broadcast."""
    texts = [" ".join(["the"] * (1 + i % 3) + [f"word{i % 50}", "of", str(i % 7), f"rare{i}"]) + "." for i in range(1500)]
    sent = X.sentences(_sentences(spark, texts)).persist()
    rows = ([("a", "the"), ("b", "the"), (None, "of"), ("a", "the word3"), ("c", "Of 5")]
            + [(f"k{i % 4}", f"word{i} of") for i in range(50)] + [("r", f"rare{i}") for i in range(0, 1500, 3)]
            + [("x", f"none{i} is here") for i in range(2000)])
    phrases = spark.createDataFrame(rows, "category string, phrase string")
    get = lambda max_bytes: sorted(map(tuple, X.phrase_hits(sent, phrases, max_bytes).collect()), key=repr)
    few = get(1 << 26)
    assert few and get(1 << 14) == few == get(1)
    assert sum(r[-1] for r in few if r[-2] == "a") == sum(1 + i % 3 for i in range(1500)) + 30
    often, seldom = X.sides_by_use(X.phrase_table(phrases).select("category", "gram"),
                                   sent.selectExpr("explode(split(lower(sentence), '[^a-z0-9]+')) gram"), 1 << 14)
    assert {("a", "the"), ("b", "the")} <= {(r.category, r.gram) for r in often.collect()}
    assert often.count() + seldom.count() == X.phrase_table(phrases).count() and often.count() < 300


def test_counts_of_phrases_are_not_shuffled(spark):
    """While the table is broadcast, sentences are dealt once, and neither their runs nor their counts are."""
    sent = X.sentences(_sentences(spark, ["New York city, york."]))
    phrases = spark.createDataFrame([("x", "york")], "category string, phrase string")
    plan = X.phrase_hits(sent, phrases)._jdf.queryExecution().executedPlan().toString()
    dealt = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert len(dealt) == 1 and "category" not in dealt[0]


def test_a_run_found_is_one_row_for_many_categories(spark):
    """Categories of several blocks, none at all among them, are counted side by side, within and beyond the
    bound; sentences of equal keys count together, and a long one has many runs."""
    texts = ["the cat The", "of the cat and of the dog", "---", "", "the " * 70_000, "no such", "the cat The"]
    rows = [(DAY, "L", min(i, 5), min(i, 5), None if i % 2 else "s", 1, t) for i, t in enumerate(texts)]
    sent = spark.createDataFrame(rows, "digest_date date, label string, message_id long, list_pos long, sender string, sent_pos int, sentence string")
    table = {"the": [None, *(f"c{i:02}" for i in range(75))], "the cat": [None, "c03", "c74"], "of the dog": ["c40", "d"], "cat": ["d"],
             "the the the": ["c74"], "nowhere": ["e"]}
    phrases = spark.createDataFrame([(c, g) for g, cs in table.items() for c in cs], "category string, phrase string")
    want = {}
    for day, label, message_id, pos, sender, sent_pos, text in rows:
        words = text.lower().split()
        for n in (1, 2, 3):
            for i in range(len(words) - n + 1):
                for c in table.get(" ".join(words[i:i + n]), ()):
                    k = (day, label, message_id, pos, sender, sent_pos, c)
                    want[k] = want.get(k, 0) + 1
    got = {max_bytes: X.phrase_hits(sent, phrases, max_bytes) for max_bytes in (1 << 26, 1 << 12, 1)}
    for hits in got.values():
        found = [tuple(r) for r in hits.collect()]
        assert len(found) == len(want) and {r[:-1]: r[-1] for r in found} == want
    plan = got[1 << 26]._jdf.queryExecution().executedPlan().toString()
    dealt = [line for line in plan.splitlines() if "Aggregate(keys=[digest_date" in line]
    assert dealt and not any("category" in line for line in dealt)


def test_a_bitmap_lets_few_others_through(spark):
    rows = spark.range(40000).select("id", F.concat(F.lit("k"), "id").alias("k")).unionByName(
        spark.createDataFrame([(-1, None)], "id long, k string"))
    keys = persist(rows.filter("id % 4 = 0 or k is null").select("k"))
    likely = {r.id for r in likely_in(rows, keys, "k").collect()}
    assert {-1, *range(0, 40000, 4)} <= likely and len(likely) - 10001 < 30000 // 50


def test_digest_reads_sentences_and_answers_once(spark):
    """Words of two groups count for both; a digest's sentences are looked up in one pass, an answer's JSON is
    parsed once, not once a field."""
    from quire.functions import taxonomy as TX
    from quire.operators import digest as D
    tx = TX.Taxonomy((("A", "a"), ("B", "b")), (("A", ("one", "two")), ("B", ("two",))), ("two", "flag"), "B", "?")
    nl = _sentences(spark, ["One two. Two two flag. Flag. None."])
    hits, flags = X.categories_and_flags(X.sentences(nl), tx)
    assert sorted((r.sentence, r.category, r.cat_pos, r.hits) for r in hits.collect()) == sorted(
        (r.sentence, r.category, r.cat_pos, r.hits) for r in X.categorize(X.sentences(nl), tx).collect()) == [
        ("One two.", "A", 1, 2), ("One two.", "B", 2, 1), ("Two two flag.", "A", 1, 2), ("Two two flag.", "B", 2, 2)]
    assert sorted(map(tuple, flags.collect())) == sorted(map(tuple, X.flag_hits(X.sentences(nl), tx).collect()))
    assert len(flags.collect()) == 3
    answers = spark.createDataFrame([(DAY, "L", '{"executive_summary": "x"}')], "digest_date date, label string, response string")
    plan = D.parse_responses(answers.repartition(1))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json(") == 2
