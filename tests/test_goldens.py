"""Hand-written golden rows for cases the fixture tables cannot reach."""

import base64
import json

from pyspark.sql import functions as F

from quire.functions import text as T
from quire.operators import chunking as K
from quire.operators import digest as D
from quire.operators import layout as L
from quire.operators import select as S
from quire.params import DEFAULT
from quire.sources import mail as M


def b64(s: str, pad: bool = True) -> str:
    e = base64.urlsafe_b64encode(s.encode()).decode()
    return e if pad else e.rstrip("=")


def one(spark, col, value, schema="v string"):
    return spark.createDataFrame([(value,)], schema).select(col.alias("r")).collect()[0]["r"]


def bodies(spark, payloads):
    rows = [(i, json.dumps({"id": str(i), "payload": p})) for i, p in enumerate(payloads)]
    df = spark.createDataFrame(rows, "message_id long, raw string")
    good, q = M.decode_messages(df)
    got = {r["message_id"]: r["body"] for r in good.collect()}
    return [got.get(i) for i in range(len(payloads))], q.collect()


def leaf(mime, text=None, data=None, parts=None):
    n = {"mimeType": mime, "body": {}}
    if text is not None:
        n["body"]["data"] = b64(text)
    if data is not None:
        n["body"]["data"] = data
    if parts is not None:
        n["parts"] = parts
    return n


def test_mime_body_choice(spark):
    cases = [
        (leaf("text/html", "<p>Hello</p><p>World</p>"), "Hello\nWorld"),                        # root HTML
        (leaf("text/plain", " plain body "), " plain body "),                                  # root plain
        (leaf("multipart/alternative", parts=[leaf("text/plain", "P"), leaf("text/html", "<b>H</b>")]), "H"),
        (leaf("multipart/mixed", parts=[leaf("text/html", "<i>one</i>"), leaf("text/html", "<i>two</i>")]), "two"),
        (leaf("multipart/mixed", parts=[leaf("multipart/alternative", parts=[leaf("text/html", "N")]),
                                        leaf("text/html", "<p>direct</p>")]), "direct"),        # nested before HTML
        (leaf("multipart/mixed", parts=[leaf("text/html", "<p> </p>"),
                                        leaf("multipart/related", parts=[leaf("text/html", "late")])]), "late"),
        (leaf("multipart/mixed", parts=[leaf("text/plain", "top"),
                                        leaf("multipart/related", parts=[leaf("text/plain", "inner")])]), "inner"),
        (leaf("multipart/mixed", parts=[leaf("application/pdf", "xx"), leaf("text/plain", "body")]), "body"),
        (leaf("multipart/mixed", parts=[leaf("message/rfc822", parts=[leaf("text/html", "fwd")])]), ""),
        (leaf("TEXT/HTML", "<p>upper</p>"), ""),                                                # case-sensitive
    ]
    got, _ = bodies(spark, [c[0] for c in cases])
    assert got == [c[1] for c in cases]


def test_base64url_and_utf8(spark):
    assert one(spark, T.decode_body(F.col("v")), b64("a?>b~")) == "a?>b~"                  # '-' and '_'
    assert one(spark, T.decode_body(F.col("v")), b64("hello!", pad=False)) == "hello!"     # no padding
    assert one(spark, T.decode_body(F.col("v")), "a") is None                              # lone char
    bad = base64.urlsafe_b64encode(b"h\xc3\xa9\xffA").decode()
    assert one(spark, T.decode_body(F.col("v")), bad) == "hé�A"                       # bad bytes


def test_html_cases(spark):
    h = T.html_to_text(F.col("v"))
    assert one(spark, h, "<p>a <b>bold</b> word</p>") == "a\nbold\nword"                       # inline tag splits
    assert one(spark, h, "<p>x</p><p>x</p><p>y</p><p>x</p>") == "x\ny\nx"                    # repeated lines
    assert one(spark, h, '<script>var t="</p>";</script><p>after</p>') == "after"
    assert one(spark, h, "<!-- hidden <p>no</p> --><p>shown</p>") == "shown"
    assert one(spark, h, "<p>&nbsp;a&nbsp;</p><p> </p>") == "a"                         # no-break space
    assert one(spark, h, "<title>T &amp; C</title><p>&amp;lt;</p>") == "T & C\n&lt;"
    e = T.decode_entities(F.col("v"))                                         # one pass, like a parser
    assert one(spark, e, "&#8217;s &#x2019; &#X1F600; &rsquo;&ldquo;") == "’s ’ 😀 ’“"
    assert one(spark, e, "&#38;lt; &#0; &#xD800; &unknown; &amp") == "&lt; � � &unknown; &"   # old names need no semicolon


def test_headers_and_dates(spark):
    df = spark.createDataFrame(
        [(1, [("SUBJECT", "first"), ("subject", "second")]), (2, [("From", "x")]), (3, [])],
        "id int, h array<struct<name:string,value:string>>")
    msg = F.struct(F.col("h").alias("headers"))
    got = {r["id"]: r["s"] for r in df.select("id", M.header(msg, "Subject").alias("s")).collect()}
    assert got == {1: "first", 2: "", 3: ""}
    cases = {
        "Mon, 01 Jan 2024 08:15:30 +0000": "2024-01-01T08:15:30+00:00",
        "1 Jan 2024 08:15:30 -0500": "2024-01-01T08:15:30-05:00",
        "Mon, 01 Jan 2024 08:15:30 +0000 (UTC)": "2024-01-01T08:15:30+00:00",
        "Mon, 01 Jan 2024 08:15:30 GMT": "2024-01-01T08:15:30+00:00",
        "Mon, 01 Jan 2024 08:15:30 -0000": "2024-01-01T08:15:30",
        "Mon, 01 Jan 24 08:15 +0100": "2024-01-01T08:15:00+01:00",
        "Fri, 31 Dec 99 23:59:59 EST": "1999-12-31T23:59:59-05:00",
        "31 Feb 2024 10:00:00 +0000": None,
        "garbage": None,
        None: None,
    }
    df = spark.createDataFrame([(k,) for k in cases], "v string")
    got = {r["v"]: r["d"] for r in df.select("v", M.parse_mail_date(F.col("v")).alias("d")).collect()}
    assert got == cases


def test_mail_dates_as_the_standard_parser_reads_them(spark):
    from email.utils import parsedate_to_datetime

    def standard(text):
        try:
            return parsedate_to_datetime(text).isoformat()
        except Exception:
            return None

    values = ["Mon 5 Feb 2024 10:00:00 +0000", "Mon, 5-Feb-2024 10:00:00 +0000", "5 Feb 2024 10:00:00 +02:00",
              "Mon, 05 Feb 2024 10:00:00 +0000 (a (nested) comment)", "Mon Feb  5 10:00:00 2024", "5 February 2024 10:00",
              "Mon, 5 Feb 2024 10.30.15 -0330", "Feb 5, 2024 10:00:00", "Mon,5 Feb 2024 10:00:00 PST", "5 Feb 24 10:00 CEST",
              "Mon, 5 Feb 2024", "", "   ", "Mon, 5 Foo 2024 10:00:00 +0000", "2024-02-05T10:00:00Z", "Mon, 5 Feb 2024 25:00:00 +0000",
              "Mon, 5 Feb 2024 10:00:00 +9999", "Mon, 5 Feb 2024 10:00:00 Z", "\u00e9", "5 Feb 2024 10:00:00 -0000"]
    df = spark.createDataFrame([(v,) for v in values], "v string")
    got = {r["v"]: r["d"] for r in df.select("v", M.parse_mail_date(F.col("v")).alias("d")).collect()}
    assert got == {v: standard(v) for v in values}


def test_size_bounds(spark):
    rows = [(1, "x" * 49 + "   "), (2, " " + "y" * 50), (3, "z" * 15001)]
    df = spark.createDataFrame(rows, "message_id long, body string")
    kept = {r["message_id"]: r["body"] for r in S.cap_body(S.drop_tiny(df)).collect()}
    assert set(kept) == {2, 3}
    assert kept[2] == " " + "y" * 50 and len(kept[3]) == 15000


def test_dedup_subject(spark):
    rows = [("d", "L", 1, 1, "News", "a"), ("d", "L", 2, 2, "news ", "b"), ("d", "L", 3, 3, "  NEWS", "c"),
            ("d", "L", 4, 4, "", "a"), ("d", "L", 5, 5, None, "b"), ("d", "L", 6, 6, "Other", "a")]
    df = spark.createDataFrame(rows, "digest_date string, label string, message_id long, list_pos long, "
                                     "subject string, sender string")
    got = sorted(r["message_id"] for r in S.dedup_subject(df).collect())
    assert got == [1, 4, 6]


def test_daily_limit(spark):
    for n, want in [(29, 29), (30, 30), (31, 30)]:
        rows = [("d", "L", i, 100 - i) for i in range(n)]
        df = spark.createDataFrame(rows, "digest_date string, label string, message_id long, list_pos long")
        got = S.daily_topk(df).collect()
        assert len(got) == want
        assert sorted(r["list_pos"] for r in got) == sorted(100 - i for i in range(n))[:want]


def greedy(tokens, budget, overhead=2000):
    out, cur, cid = [], overhead, 0
    for t in tokens:
        if cid == 0 or cur + t > budget:
            cid, cur = cid + 1, overhead
        cur += t
        out.append(cid)
    return out


def test_chunk_cases(spark):
    p = DEFAULT.with_(max_input_tokens=3000)
    # body lengths give tokens len//4 + 200
    cases = {
        "exact": [400 * 4, 400 * 4],          # 2000 + 600 + 600 = 3200 > 3000 -> second chunk
        "fit": [200 * 4, 200 * 4],            # 2000 + 400 + 400 = 2800
        "edge": [300 * 4, 300 * 4],           # 2000 + 500 + 500 = 3000 == budget -> one chunk
        "oversize_first": [8000, 40],
        "all_one": [40, 40, 40],
    }
    rows = [(k, "L", i, i, "x" * n) for k, v in cases.items() for i, n in enumerate(v)]
    df = spark.createDataFrame(rows, "digest_date string, label string, message_id long, list_pos long, body string")
    got = {}
    for r in K.chunk_assign(df, p).collect():
        got.setdefault(r["digest_date"], {})[r["list_pos"]] = r["chunk_id"]
    for k, v in cases.items():
        want = greedy([n // 4 + 200 for n in v], 3000)
        assert [got[k][i] for i in range(len(v))] == want, k


def test_route_exact_budget(spark):
    def block_len(body):
        return len(f"=== NEWSLETTER 1 ===\nFrom: s\nSubject: t\nDate: None\n---\n{body}\n")
    base = block_len("")
    rows = []
    for name, chars in [("at", (75000 - 2000) * 4), ("over", (75000 - 2000) * 4 + 4)]:
        rows.append((name, "L", 1, 1, "s", "t", None, "b" * (chars - base)))
    df = spark.createDataFrame(rows, "digest_date string, label string, message_id long, list_pos long, "
                                     "sender string, subject string, date string, body string")
    got = {r["digest_date"]: (r["total_tokens"], r["mode"]) for r in K.route_days(df).collect()}
    assert got == {"at": (75000, "single"), "over": (75001, "chunked")}


def test_json_and_status(spark):
    good = '{"executive_summary": "ok", "categories": {"Zed": ["a"], "AI & ML": ["b"]}, "active_categories": ["Zed", "AI & ML"]}'
    cases = [
        (good, "Generated", ["Zed", "AI & ML"]),
        ("```json\n" + good + "\n```", "Generated", ["Zed", "AI & ML"]),
        ("```\n" + good, "Generated", ["Zed", "AI & ML"]),
        ("```" + good, "Failed", []),                    # fence without newline -> fallback
        (good[:-5], "Failed", []),                       # truncated
        ('{"executive_summary": "fine", "_parse_error": "x"}', "Partial", []),
        ('{"executive_summary": ""}', "Failed", []),
        (good + " Hope this helps!", "Failed", []),      # text after the object
        (good.replace('"', "'"), "Failed", []),          # single quotes
        (good[:-1] + ', "domain_flags": 7}', "Generated", ["Zed", "AI & ML"]),   # one field of a wrong type
        ("not JSON", "Failed", []), (None, "Failed", []),
    ]
    df = spark.createDataFrame([(i, c[0]) for i, c in enumerate(cases)], "i int, response string")
    d = df.select("i", D.parse_answer(F.col("response")).alias("d"))
    rows = d.select("i", D.status(F.col("d.executive_summary"), F.col("d.parse_error")).alias("s"),
                    F.map_keys("d.categories").alias("k"), "d.raw_response").collect()
    for r in rows:
        assert r["s"] == cases[r["i"]][1], r
        assert r["k"] == cases[r["i"]][2], r                                # map keeps answer order
    assert rows[4]["raw_response"] == cases[4][0][:2000]


def _digest_df(spark, n_sources, cats, flags=()):
    per_source = [{"source": f"s{i}", "summary": "", "key_facts": [], "links": []} for i in range(n_sources)]
    row = {"executive_summary": "sum", "categories": cats, "per_source": per_source,
           "domain_flags": list(flags), "active_categories": list(cats)}
    df = spark.createDataFrame([("2024-01-01", "L", json.dumps(row))], "digest_date string, label string, response string")
    return D.parse_responses(df.withColumn("digest_date", F.to_date("digest_date")))


def test_block_cap(spark):
    for n_src, n_top, capped in [(95, 99, False), (96, 100, False), (97, 101, True)]:
        # 3 summary blocks + 1 sources heading + one toggle per source
        d = _digest_df(spark, n_src, {})
        b = L.digest_blocks(d).filter("child_pos = 0").orderBy("block_pos").collect()
        assert len(b) == min(n_top, 100)
        assert (b[-1]["text"] == L.TRUNCATED) == capped


def test_categories_icons_and_details(spark):
    d = _digest_df(spark, 1, {"Unknown Cat": ["x"], "AI & ML": ["y"], "Empty": []})
    b = L.digest_blocks(d).orderBy("block_pos", "child_pos").collect()
    texts = [(r["type"], r["text"]) for r in b]
    assert ("heading", "📌 Unknown Cat") in texts and ("heading", "🤖 AI & ML") in texts
    assert not any(t == "heading" and "Empty" in (x or "") for t, x in texts)
    assert ("paragraph", L.NO_DETAILS) in texts
    counts = spark.createDataFrame([("2024-01-01", "L", 1)], "digest_date string, label string, newsletter_count long")
    pages = D.digest_pages(d, counts.withColumn("digest_date", F.to_date("digest_date")))
    assert pages.collect()[0]["categories"] == ["AI & ML"]           # whitelist keeps known names only
    d2 = _digest_df(spark, 0, {"A": [], "B": []})
    t2 = [r["text"] for r in L.digest_blocks(d2).orderBy("block_pos").collect()]
    assert L.H_CATEGORIES in t2                                       # heading even if every list is empty


def test_quarantine_reasons(spark):
    deep = leaf("text/html", "<p>deep</p>")
    for _ in range(60):
        deep = leaf("multipart/mixed", parts=[deep])
    fwd = leaf("text/plain", "x")
    for _ in range(10):
        fwd = leaf("message/rfc822", parts=[fwd])
    cases = [
        leaf("multipart/mixed", parts=[leaf("application/pdf", data="%%%"), leaf("text/plain", "ok body")]),
        leaf("multipart/mixed", parts=[leaf("text/plain", data="a")]),          # lone char: undecodable
        leaf("multipart/mixed", parts=[deep, leaf("text/plain", "footer")]),    # any depth is read
        leaf("multipart/mixed", parts=[fwd, leaf("text/plain", "fine")]),      # never entered
        leaf("multipart/mixed", parts=[leaf("text/html", data="a"), leaf("text/plain", "other part")]),
    ]
    got, q = bodies(spark, cases)
    stages = sorted((r["message_id"], r["stage"]) for r in q)
    assert got == ["ok body", None, "deep", "fine", "other part"]
    assert stages == [(1, "decode")]


def walk(n):
    """The body walk as plainly as it can be said (an independent version of body_order)."""
    def text(x):
        raw = base64.urlsafe_b64decode(x["body"]["data"]).decode()
        if x["mimeType"] == "text/html":
            raw = raw.replace("<p>", "").replace("</p>", "").strip()
        return raw
    if n["body"].get("data") and n["mimeType"] in ("text/html", "text/plain"):
        return text(n)
    html, plain = "", ""
    for c in n.get("parts", []):
        if c["mimeType"] == "text/html" and c["body"].get("data"):
            html = text(c)
        elif c["mimeType"] == "text/plain" and c["body"].get("data"):
            plain = text(c)
        elif c["mimeType"].startswith("multipart/") and not html:
            html = walk(c) or html
    return html or plain


def test_body_walk_on_random_trees(spark):
    import random
    rnd = random.Random(4)

    def tree(depth):
        kind = rnd.choice(["multipart/mixed", "multipart/alternative", "text/html", "text/plain", "image/png",
                           "message/rfc822"] if depth else ["multipart/mixed"])
        if kind.startswith("text/"):
            body = rnd.choice(["", " ", f"t{rnd.randint(0, 999)}"])
            return leaf(kind, f"<p>{body}</p>" if kind == "text/html" else body)
        if kind == "image/png" or depth > 5:
            return leaf(kind, "zz" if kind == "image/png" else None)
        return leaf(kind, parts=[tree(depth + 1) for _ in range(rnd.randint(0, 4))])
    trees = [tree(0) for _ in range(400)]
    got, q = bodies(spark, trees)
    assert got == [walk(t) for t in trees] and not q


def test_links_come_from_markup(spark):
    page = '<p>see <a class="x" href="https://a.example/1?q=2">one</a> <A HREF=\'http://b.example/\'>two</A> <a href="#top">x</a></p>'
    rows = [(1, json.dumps({"id": "1", "payload": leaf("text/html", page)})),
            (2, json.dumps({"id": "2", "payload": leaf("text/plain", "plain https://c.example/ text")}))]
    good, _ = M.decode_messages(spark.createDataFrame(rows, "message_id long, raw string"))
    assert {r["message_id"]: r["links"] for r in good.collect()} == {
        1: ["https://a.example/1?q=2", "http://b.example/"], 2: None}


class Reader(__import__("html.parser", fromlist=["HTMLParser"]).HTMLParser):
    """Text nodes by the standard library's parser, without scripts and the like."""
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.nodes, self.inside = [], None

    def handle_starttag(self, tag, attrs):
        self.nodes.append("\n")
        if tag in ("script", "style", "noscript") and not self.inside:
            self.inside = tag

    def handle_endtag(self, tag):
        self.nodes.append("\n")
        if tag == self.inside:
            self.inside = None

    def handle_comment(self, data):
        self.nodes.append("\n")

    def handle_data(self, data):
        if not self.inside:
            self.nodes.append(data)


def test_html_against_a_parser(spark):
    cases = [
        '<img alt="a > b" src="x"><p>t</p>', "<a title='1>2' href=\"y\">link</a> rest", "caf&eacute; &rarr; &uuml;ber &hearts;",
        "<p>one</p><script>if (a < b) { x = '</p>'; }", "<style>p{}</style>text<style>q{", "<p>a<br/>b<hr>c</p>",
        "x &#0000000065; &#x000041; &amp;amp;", "<div><noscript><img src=1></noscript>kept</div>", "<p>5 < 6 and 7 > 6</p>",
        "<!-- c1 --><p>p</p><!-- c2 > --><p>q</p>", "<P CLASS=x>Upper</P><SCRIPT>no</SCRIPT >yes",
    ]
    df = spark.createDataFrame([(c,) for c in cases], "v string")
    got = {r["v"]: r["t"] for r in df.select("v", T.html_to_text(F.col("v")).alias("t")).collect()}
    for c in cases:
        reader = Reader()
        reader.feed(c)
        reader.close()
        lines = [x.strip() for x in "".join(reader.nodes).splitlines()]
        lines = [x for i, x in enumerate(y for y in lines if y)]
        want = [x for i, x in enumerate(lines) if i == 0 or x != lines[i - 1]]
        assert got[c].split("\n") == want, c


def test_list_order_taxonomy_and_empty_day(spark):
    import datetime as dt
    from quire.functions.taxonomy import DEFAULT as TAXONOMY
    rows = [("d", "L", 1, dt.datetime(2024, 1, 1, 9)), ("d", "L", 2, dt.datetime(2024, 1, 1, 10)),
            ("d", "L", 3, dt.datetime(2024, 1, 1, 10))]
    df = spark.createDataFrame(rows, "digest_date string, label string, message_id long, received_ts timestamp")
    top = S.daily_topk(S.with_list_pos(df), DEFAULT.with_(max_messages=2))
    assert sorted(r.message_id for r in top.collect()) == [2, 3]            # newest first, then id
    cats = TAXONOMY.table(spark).orderBy("cat_pos").collect()
    assert [c.name for c in cats][0] == "AI & ML" and len(cats) == 7
    e = spark.range(1).select(D.empty_digest().alias("d")).collect()[0].d
    assert e.executive_summary == D.NO_INPUT_SUMMARY and e.per_source == []
