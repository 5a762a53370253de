"""Properties and an independent plain-Python check (written from the rules, not
from the Spark code) on the smallest fixture."""

import pandas as pd
from pyspark.sql import functions as F

from conftest import SF_SMALL
from quire.functions import text as T
from quire.operators import chunking as K
from quire.operators import layout as L
from quire.operators import select as S
from quire.params import DEFAULT
from quire.plans.q_digest import digests
from quire.plans.q_select import newsletters
from quire.sources import catalog as C


def python_newsletters(limit=30):
    docs = pd.read_parquet(f"{SF_SMALL}/documents.parquet")
    labels = pd.read_parquet(f"{SF_SMALL}/labels.parquet")
    out = {}
    lab = [(r.doc_id, "Newsletter") for r in labels.itertuples() if r.quality == 1] + \
          [(r.doc_id, "Flagged") for r in labels.itertuples() if r.toxic == 1]
    text = dict(zip(docs.doc_id, docs.text.fillna("")))
    days = {}
    for doc_id, label in lab:
        if doc_id in text:
            days.setdefault((doc_id // C.DOCS_PER_DAY, label), []).append(doc_id)
    for key, ids in days.items():
        ids = sorted(ids)[:limit]                              # limit first
        kept, seen = [], set()
        for i in ids:
            body = text[i]
            if not body or len(body.strip()) < 50:             # tiny
                continue
            subject = body.split("\n", 1)[0]
            k = subject.lower().strip()
            if k not in seen:                                  # dedup by subject only
                seen.add(k)
                kept.append((i, body[:15000]))
        out[key] = kept
    return out


def test_newsletters_match_plain_python(spark):
    want = python_newsletters()
    got = {}
    for r in newsletters(spark, SF_SMALL).orderBy("list_pos").collect():
        key = ((r["digest_date"] - C.FIRST_DAY).days, r["label"])
        got.setdefault(key, []).append((r["message_id"], r["body"]))
    assert got == {k: v for k, v in want.items() if v}


def test_order_invariance(spark):
    keys = C.message_keys(spark, SF_SMALL).repartition(17)
    bodies = C.bodies(spark, SF_SMALL).repartition(13)
    a, _ = S.newsletters(keys, C.message_labels(spark, SF_SMALL).repartition(5), bodies)
    b = newsletters(spark, SF_SMALL)
    cols = ["digest_date", "label", "message_id"]
    assert sorted(a.select(*cols).collect()) == sorted(b.select(*cols).collect())


def test_chunks_cover_and_fit(spark):
    p = DEFAULT.with_(max_input_tokens=6000)
    nl = newsletters(spark, SF_SMALL)
    ch = K.chunk_assign(nl, p)
    assert ch.count() == nl.count()
    assert ch.select("digest_date", "label", "message_id").distinct().count() == nl.count()
    per = ch.groupBy("digest_date", "label", "chunk_id").agg(F.sum("nl_tokens").alias("t"), F.count("*").alias("n"))
    bad = per.filter((F.col("t") + p.prompt_overhead > p.max_input_tokens) & (F.col("n") > 1)).count()
    assert bad == 0
    # chunk ids are 1..k without gaps, in list order
    for r in ch.groupBy("digest_date", "label").agg(F.max("chunk_id").alias("m"),
                                                   F.countDistinct("chunk_id").alias("d")).collect():
        assert r["m"] == r["d"]


def test_dedup_idempotent(spark):
    nl = newsletters(spark, SF_SMALL)
    once = S.dedup_subject(nl)
    assert sorted(once.select("message_id").collect()) == sorted(S.dedup_subject(once).select("message_id").collect())


def test_html_no_equal_neighbours(spark):
    t = C.pages(spark, SF_SMALL).select(T.html_to_text(F.col("html")).alias("t"))
    for r in t.collect():
        lines = r["t"].split("\n")
        assert all(a != b for a, b in zip(lines, lines[1:]))
        assert all(x == x.strip() and x for x in lines) or r["t"] == ""


def test_blocks_per_page_bounded(spark):
    _, d = digests(spark, SF_SMALL, DEFAULT.with_(max_messages=1000))
    b = L.digest_blocks(d).filter("child_pos = 0").groupBy("digest_date", "label").count()
    assert b.agg(F.max("count")).collect()[0][0] <= DEFAULT.block_limit


def test_line_cleanup_equals_python_on_random_text(spark):
    """clean_lines == Python's splitlines/strip/drop-empty/drop-repeat on random text
    built from every line-break and white-space class, and ustrip == str.strip."""
    import random
    rnd = random.Random(7)
    chars = ["a", "b", " ", "\n", "\r", "\r\n", "\t", "\x0b", "\x0c", "\x1c", "\x1d", "\x1e", "\x1f",
             "\x85", " ", " ", " ", "\xa0", "　", "x", "é"]
    rows = [("".join(rnd.choice(chars) for _ in range(rnd.randint(0, 40))),) for _ in range(20000)]
    df = spark.createDataFrame(rows, "text string")

    def py(s):
        out = []
        for line in (x.strip() for x in s.splitlines()):
            if line and (not out or out[-1] != line):
                out.append(line)
        return "\n".join(out)

    got = df.select("text", T.clean_lines(F.col("text")).alias("c"), T.ustrip(F.col("text")).alias("s")).collect()
    assert all(r["c"] == py(r["text"]) for r in got)
    assert all(r["s"] == r["text"].strip() for r in got)


def test_markup_search_is_linear(spark):
    """Broken markup of every kind, repeated: quadratic search would take minutes."""
    import time
    n = 40_000
    bodies = ["<p>" + "x" * 1_000_000 + "</p>" + "<script>" * n, "<a " * n, '<a "' * n, "<!--" * n, "<style>a" * n + "</styl",
              "<a href='" * n, "<" * n, "&" * n, "&#1" * n, "</" * n, '<a x="' + "y>" * n]
    df = spark.createDataFrame([(b,) for b in bodies], "h string").repartition(4)
    t = time.time()
    got = df.select(F.length(T.html_to_text(F.col("h"))).alias("n")).collect()
    assert len(got) == len(bodies) and time.time() - t < 90
