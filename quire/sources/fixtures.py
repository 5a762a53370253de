"""Raw mail messages derived from the ``documents`` table (test fixture view).

Every document becomes one full-format message JSON object; its MIME shape,
Date header form and a few malformed variants are chosen from ``doc_id`` so all
branches of the decoder are exercised on whole-table data:

shape = doc_id % 6
  0  text/plain root body
  1  text/html root body
  2  multipart/alternative [text/plain, text/html]
  3  multipart/mixed [text/plain, multipart/alternative [text/plain, text/html], application/pdf]
  4  multipart/mixed [multipart/related [text/plain], text/plain footer]
  5  multipart/mixed [message/rfc822 [text/html], text/plain]
and, of shape 4, doc_id % 60 in DEEP: multipart/mixed [multipart/mixed [... [text/html]], text/plain footer],
  the HTML inside 2 to 12 nested multiparts (2 + doc_id div 60 mod 11)
date form = doc_id % 8 (see DATE_FORMS); doc_id % 7 == 0 adds a second, lower-case
"subject" header; doc_id % 60 == 6 has a malformed base64 body; doc_id % 60 == 18
has truncated JSON.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.functions.text import b64url_encode, first_line
from quire.sources.catalog import day_of, table

FOOTER = "You are receiving this newsletter because you subscribed to it."
N_SHAPES = 6
BAD_B64, BAD_JSON, MOD_BAD = 6, 18, 60
DEEP = (10, 22, 34, 46)
LEVELS, LEAST_LEVELS = 11, 2
# Date header forms: (spark pattern, zone text); index = doc_id % 8, 6 = garbage, 7 = absent.
DATE_FORMS = [
    ("EEE, dd MMM yyyy HH:mm:ss", " +0000"),
    ("d MMM yyyy HH:mm:ss", " -0500"),
    ("EEE, dd MMM yyyy HH:mm:ss", " +0000 (UTC)"),
    ("EEE, dd MMM yyyy HH:mm:ss", " GMT"),
    ("EEE, dd MMM yyyy HH:mm:ss", " -0000"),
    ("EEE, dd MMM yy HH:mm:ss", " +0100"),
]
GARBAGE_DATE = "sometime last week"

L2 = "struct<mimeType:string,filename:string,body:struct<data:string>>"
L1 = f"struct<mimeType:string,filename:string,body:struct<data:string>,parts:array<{L2}>>"


def html_of(text: Column, subject: Column) -> Column:
    return F.concat(F.lit("<html><head><title>"), subject, F.lit("</title></head><body><p>"),
                    F.replace(text, F.lit("\n"), F.lit("</p><p>")), F.lit("</p></body></html>"))


def sent_at(doc_id: Column) -> Column:
    return F.make_timestamp_ntz(F.year(day_of(doc_id)), F.month(day_of(doc_id)), F.dayofmonth(day_of(doc_id)),
                                F.lit(8), F.pmod(doc_id, F.lit(60)).cast("int"),
                                F.pmod(doc_id * 7, F.lit(60)).cast("int"))


def _leaf(mime: str, data: Column | None, filename: str | None = None) -> Column:
    return F.struct(F.lit(mime).alias("mimeType"), F.lit(filename).cast("string").alias("filename"),
                    F.struct((data if data is not None else F.lit(None)).cast("string").alias("data")).alias("body")
                    ).cast(L2)


def _mid(mime: str, data: Column | None, parts: list[Column] | None) -> Column:
    return F.struct(F.lit(mime).alias("mimeType"), F.lit(None).cast("string").alias("filename"),
                    F.struct((data if data is not None else F.lit(None)).cast("string").alias("data")).alias("body"),
                    (F.array(*parts) if parts else F.lit(None)).cast(f"array<{L2}>").alias("parts")).cast(L1)


def raw_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    d0 = table(spark, sf_dir, "documents")
    doc = F.col("doc_id")
    text = F.coalesce(F.col("text"), F.lit(""))
    subj0 = first_line(F.col("text"))
    enc = b64url_encode(text)
    # encode once per row in its own projection; the JSON below refers to it several times
    d = d0.select("doc_id", "source", subj0.alias("subj"),
                  F.when(F.pmod(doc, F.lit(MOD_BAD)) == BAD_B64, F.concat(enc, F.lit("A"))).otherwise(enc)
                  .alias("b_text"),
                  b64url_encode(html_of(text, subj0)).alias("b_html"))
    subj, b_text, b_html = F.col("subj"), F.col("b_text"), F.col("b_html")
    shape = F.pmod(doc, F.lit(N_SHAPES))
    root_mime = (F.when(shape == 0, "text/plain").when(shape == 1, "text/html")
                  .when(shape == 2, "multipart/alternative").otherwise("multipart/mixed"))
    root_data = F.when(shape == 0, b_text).when(shape == 1, b_html)
    parts = (F.when(shape == 2, F.array(_mid("text/plain", b_text, None), _mid("text/html", b_html, None)))
              .when(shape == 3, F.array(_mid("text/plain", b_text, None),
                                        _mid("multipart/alternative", None,
                                             [_leaf("text/plain", b_text), _leaf("text/html", b_html)]),
                                        _mid("application/pdf", b64url_encode(subj), None)
                                        .withField("filename", F.lit("brief.pdf"))))
              .when(shape == 4, F.array(_mid("multipart/related", None, [_leaf("text/plain", b_text)]),
                                        _mid("text/plain", b64url_encode(F.lit(FOOTER)), None)))
              .when(shape == 5, F.array(_mid("message/rfc822", None, [_leaf("text/html", b_html)]),
                                        _mid("text/plain", b_text, None))))
    form = F.pmod(doc, F.lit(8))
    ts = sent_at(doc)
    date_val = F.lit(None).cast("string")
    for i, (pat, zone) in enumerate(DATE_FORMS):
        date_val = F.when(form == i, F.concat(F.date_format(ts, pat), F.lit(zone))).otherwise(date_val)
    date_val = F.when(form == 6, F.lit(GARBAGE_DATE)).otherwise(date_val)

    def hdr(name: str, value: Column) -> Column:
        return F.struct(F.lit(name).alias("name"), value.alias("value"))

    headers = F.filter(F.array(
        hdr("From", F.coalesce(F.col("source"), F.lit(""))),
        hdr("Subject", subj),
        F.when(date_val.isNotNull(), hdr("Date", date_val)),
        F.when(F.pmod(doc, F.lit(7)) == 0, hdr("subject", F.lit("second subject header"))),
    ), lambda h: h.isNotNull())
    payload = F.struct(root_mime.alias("mimeType"), headers.alias("headers"),
                       F.struct(root_data.alias("data")).alias("body"), parts.alias("parts"))
    js = F.to_json(F.struct(doc.cast("string").alias("id"), payload.alias("payload")))
    levels = (F.pmod(F.floor(doc / MOD_BAD), F.lit(LEVELS)) + LEAST_LEVELS).cast("int")

    def node(mime: str, data: Column) -> Column:
        return F.concat(F.lit(f'{{"mimeType":"{mime}","body":{{"data":"'), data, F.lit('"}}'))

    deep = F.concat(
        F.lit('{"id":"'), doc.cast("string"), F.lit('","payload":{"mimeType":"multipart/mixed","headers":'),
        F.to_json(headers), F.lit(',"parts":['), F.repeat(F.lit('{"mimeType":"multipart/mixed","parts":['), levels),
        node("text/html", b_html), F.repeat(F.lit("]}"), levels), F.lit(","),
        node("text/plain", b64url_encode(F.lit(FOOTER))), F.lit("]}}"))
    js = F.when(F.pmod(doc, F.lit(MOD_BAD)).isin(*DEEP), deep).otherwise(js)
    js = F.when(F.pmod(doc, F.lit(MOD_BAD)) == BAD_JSON, F.substring(js, 1, 40)).otherwise(js)
    return d.select(doc.alias("message_id"), day_of(doc).alias("digest_date"), doc.alias("list_pos"),
                    js.alias("raw"))


def stamp(age: Column) -> Column:
    """What a stored message begins with: its time, here from its place in the listing."""
    return F.concat(F.lit('{"internalDate":"'), (-age).cast("string"), F.lit('",'))


def stored_mail(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``raw_messages`` as a mail export has them: one object a line, with its time. Every
    five messages share a millisecond, so that list order needs the id too."""
    ms = F.unix_millis(F.to_timestamp("digest_date")) + F.floor(F.pmod(F.col("message_id"), F.lit(100)) / 5)
    return raw_messages(spark, sf_dir).select(
        F.concat(stamp(-ms), F.expr("substr(raw, 2)")).alias("value"))
