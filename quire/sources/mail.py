"""Raw mail messages -> records.

``messages_raw(message_id, digest_date, list_pos, raw)``: ``raw`` is the mail
service's full-format JSON object ``{id, payload{mimeType, headers[], body{data},
parts[]}}``. ``parts`` is recursive to any depth, which no schema can say, so one Arrow
function parses each message once and lists the nodes of its tree; everything after that
(base64, UTF-8, HTML cleanup, headers, dates) is column expressions on that list.

Everything is row-local: one message is one row, so decoding never shuffles.
"""

from __future__ import annotations

import json
from email.utils import parsedate_to_datetime

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.functions.text import b64url_decode, html_to_text, let, link_targets, utf8_lenient
from quire.params import DEFAULT, Params
from quire.session import ship_package, small_batches

HEADER_T = T.ArrayType(T.StructType([T.StructField("name", T.StringType()),
                                     T.StructField("value", T.StringType())]))
# The two body types that are read, and month names of mail dates.
HTML, PLAIN = "text/html", "text/plain"
MONTHS = ["jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec"]
# Zone names that mail dates may carry, as numeric offsets.
ZONES = {"UT": "+0000", "UTC": "+0000", "GMT": "+0000", "Z": "+0000",
         "EST": "-0500", "EDT": "-0400", "CST": "-0600", "CDT": "-0500",
         "MST": "-0700", "MDT": "-0600", "PST": "-0800", "PDT": "-0700"}


NODE_T = pa.struct([("path", pa.string()), ("depth", pa.int32()), ("pos", pa.int32()), ("mime", pa.string()),
                    ("filename", pa.string()), ("data", pa.string())])
MESSAGE_T = pa.struct([
    ("mime", pa.string()), ("n_parts", pa.int32()),
    ("headers", pa.list_(pa.struct([("name", pa.string()), ("value", pa.string())]))),
    ("nodes", pa.list_(NODE_T)), ("order", pa.list_(pa.int32()))])
MESSAGE_SCHEMA = ("mime string, n_parts int, headers array<struct<name: string, value: string>>, "
                  "nodes array<struct<path: string, depth: int, pos: int, mime: string, filename: string, "
                  "data: string>>, order array<int>")


RAW_SCHEMA = T.StructType([T.StructField("message_id", T.StringType()), T.StructField("digest_date", T.DateType()),
                           T.StructField("list_pos", T.LongType()), T.StructField("raw", T.StringType())])


def read_raw(spark, path: str, fmt: str = "jsonl") -> DataFrame:
    """Scan stored messages (A1) into ``messages_raw``.

    * ``parquet``: a table with ``RAW_SCHEMA`` (explicit schema, no inference).
    * ``jsonl``: one full-format message object per line, as the mail service returns
      it. Lines are read as text, so a malformed one is kept (and quarantined when
      decoded), not dropped by a JSON reader. The day is the local date of
      ``internalDate`` (epoch ms); list order is newest first, then id: a struct, which
      sorts like the pair.
    """
    if fmt == "parquet":
        return spark.read.schema(RAW_SCHEMA).parquet(path)
    if fmt != "jsonl":
        raise ValueError(f"unknown format {fmt!r}")
    lines = spark.read.text(path).select(F.col("value").alias("raw"))
    ms = F.get_json_object("raw", "$.internalDate").try_cast("long")
    ts = F.timestamp_millis(ms)
    ident = F.get_json_object("raw", "$.id")
    return lines.select(ident.alias("message_id"), F.to_date(ts).alias("digest_date"),
                        F.struct((-ms).alias("age"), ident.alias("id")).alias("list_pos"), "raw")


def _text(x) -> str | None:
    return x if isinstance(x, str) else None


def message_tree(raw: str | None) -> dict | None:
    """A message's headers, the nodes that the body walk looks at (the root, its children
    and the children of multipart nodes below it, in order; ``path`` sorts), and the order
    in which nodes are tried for the body. None where ``raw`` is not a message's JSON.

    The order restates the walk: a direct text body of the root is all there is; else the
    last HTML child comes first, then, for as long as nothing has been found, what the
    multipart children after it hold, and last the last plain child. The tree is walked
    with a stack of its own, so its depth is limited by the JSON parser alone."""
    try:
        payload = json.loads(raw)["payload"]
        nodes, of = [], {}
        stack = [(payload, "", 0, 0)]
        while stack:
            n, path, depth, pos = stack.pop()
            data = _text((n.get("body") or {}).get("data"))
            mime = _text(n.get("mimeType")) or ""
            of[path] = len(nodes)
            nodes.append({"path": path, "depth": depth, "pos": pos, "mime": mime,
                          "filename": _text(n.get("filename")), "data": data})
            if not path or mime.startswith("multipart/"):
                below = [(c, f"{path}.{i:03d}" if path else f"{i:03d}", depth + 1, i)
                         for i, c in enumerate(n.get("parts") or [])]
                stack += reversed(below)
        children: dict[str, list[int]] = {}
        for i, n in enumerate(nodes[1:], 1):
            children.setdefault(n["path"].rpartition(".")[0], []).append(i)
        headers = [{"name": _text(h.get("name")), "value": _text(h.get("value"))}
                   for h in payload.get("headers") or []]
        return {"mime": nodes[0]["mime"], "n_parts": len(payload.get("parts") or []), "headers": headers,
                "nodes": nodes, "order": body_order(nodes, children)}
    except (ValueError, TypeError, KeyError, AttributeError, RecursionError):
        return None


def body_order(nodes: list[dict], children: dict[str, list[int]]) -> list[int]:
    root = nodes[0]
    if root["data"] and root["mime"] in (HTML, PLAIN):
        return [0]
    out: list[int] = []
    todo: list[tuple[str, int]] = [("node", 0)]
    while todo:
        what, i = todo.pop()
        if what == "leaf":
            out.append(i)
            continue
        kids = children.get(nodes[i]["path"], [])
        html = [k for k in kids if nodes[k]["mime"] == HTML and nodes[k]["data"]]
        plain = [k for k in kids if nodes[k]["mime"] == PLAIN and nodes[k]["data"]]
        after = [k for k in kids if nodes[k]["mime"].startswith("multipart/") and (not html or k > html[-1])]
        todo += reversed([("leaf", k) for k in html[-1:]] + [("node", k) for k in after]
                         + [("leaf", k) for k in plain[-1:]])
    return out


def parse_message(raw: DataFrame) -> DataFrame:
    """Add ``msg``: the message's tree, NULL on malformed JSON."""
    ship_package(raw.sparkSession)
    small_batches(raw.sparkSession)

    @F.arrow_udf(MESSAGE_SCHEMA)
    def parse(texts: pa.Array) -> pa.Array:
        return pa.array([message_tree(t.as_py()) for t in texts], MESSAGE_T)

    # not deterministic to the optimiser: a filter on what comes of it would parse again
    return raw.withColumn("msg", parse.asNondeterministic()("raw"))


# --------------------------------------------------------------------------- headers and dates
def header(msg: Column, name: str) -> Column:
    """First header named ``name`` (case-insensitive), '' if none."""
    hs = F.coalesce(msg["headers"], F.array().cast(HEADER_T))
    hit = F.filter(hs, lambda h: F.lower(F.coalesce(h["name"], F.lit(""))) == F.lit(name.lower()))
    return F.coalesce(F.get(hit, 0)["value"], F.lit(""))


DATE_RE = (r"^\s*(?:[A-Za-z]{3},\s*)?(\d{1,2})\s+([A-Za-z]{3})[a-z]*\s+(\d{2,4})\s+"
           r"(\d{1,2}):(\d{2})(?::(\d{2}))?\s*([+-](?:[01]\d|2[0-3])[0-5]\d|[A-Za-z]{1,3})?\s*(?:\([^)]*\))?\s*$")


def other_dates(text: Column) -> Column:
    """Dates of unusual form, null where there is none to read."""
    @F.pandas_udf("string")
    def read(values: pd.Series) -> pd.Series:
        def one(value: str | None) -> str | None:
            try:
                return parsedate_to_datetime(value).isoformat() if value else None
            except (ValueError, TypeError, IndexError, OverflowError):
                return None
        return values.map(one, na_action="ignore")
    return read(text)


def parse_mail_date(s: Column) -> Column:
    """RFC 2822 date header -> ISO 8601 text with the header's own offset, NULL on
    any failure (T9). ``-0000``, no zone or an unknown zone name give a naive time;
    two-digit years follow the mail convention (<= 68 -> 20xx, else 19xx). The common form
    is read by a pattern; whatever has another is left to the standard library's parser."""
    g = [F.regexp_extract(s, DATE_RE, i) for i in range(8)]
    ok = F.coalesce(s.rlike(DATE_RE), F.lit(False))
    mon = F.array_position(F.array(*[F.lit(m) for m in MONTHS]), F.lower(g[2])).cast("int")
    y = g[3].try_cast("int")
    y = F.when(F.length(g[3]) <= 2, F.when(y > 68, y + 1900).otherwise(y + 2000)).otherwise(y)
    sec = F.when(g[6] == "", F.lit(0)).otherwise(g[6].try_cast("int"))
    ts = F.try_make_timestamp_ntz(y, mon, g[1].try_cast("int"), g[4].try_cast("int"), g[5].try_cast("int"), sec)
    zone = F.upper(g[7])
    named = F.create_map(*[x for k, v in ZONES.items() for x in (F.lit(k), F.lit(v))])
    num = F.when(zone.rlike(r"^[+-]\d{4}$"), zone).otherwise(F.try_element_at(named, zone))
    off = (F.when(F.isnull(num) | (num == "-0000"), F.lit(""))
            .otherwise(F.concat(F.substring(num, 1, 3), F.lit(":"), F.substring(num, 4, 2))))
    usual = F.when(ts.isNotNull(), F.concat(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"), off))
    return F.when(ok, usual).otherwise(other_dates(F.when(~ok & (s != ""), s)))


# --------------------------------------------------------------------------- MIME
def mime_parts(msg: Column) -> Column:
    """One entry per node the body walk looks at, root first."""
    return msg["nodes"]


WEB_ADDRESS = "(?i)^https?://."


def chosen_body(msg: Column) -> Column:
    """(body, links, undecodable) of a message (T8): the first node in body order whose decoded,
    cleaned text is not empty; later nodes are not even decoded. Links are taken from its
    markup before that is removed; a plain part has none (null). A part whose base64 is
    broken counts as empty, and ``undecodable`` tells that one was met on the way."""
    def step(acc: Column, i: Column) -> Column:
        node = F.get(msg["nodes"], i)
        raw = b64url_decode(node["data"])

        def text(parts: Column) -> Column:
            return F.when(node["mime"] == HTML, html_to_text(parts)).otherwise(parts)

        def tried(data: Column) -> Column:
            def read(parts: Column) -> Column:
                links = F.when(node["mime"] == HTML, F.filter(link_targets(parts), lambda x: x.rlike(WEB_ADDRESS)))
                return F.struct(F.coalesce(text(parts), F.lit("")).alias("body"), links.alias("links"),
                                (acc["undecodable"] | data.isNull()).alias("undecodable"))
            return F.get(F.transform(F.array(utf8_lenient(data)), read), 0)
        return F.when(acc["body"] != "", acc).otherwise(F.get(F.transform(F.array(raw), tried), 0))

    start = F.struct(F.lit("").alias("body"), F.lit(None).cast("array<string>").alias("links"),
                     F.lit(False).alias("undecodable"))
    return F.aggregate(F.coalesce(msg["order"], F.array().cast("array<int>")), start, step)


# --------------------------------------------------------------------------- records
def decode_messages(raw: DataFrame, p: Params = DEFAULT) -> tuple[DataFrame, DataFrame]:
    """messages_raw -> (records, quarantine). Records carry subject, sender, ISO date and
    the chosen body. Quarantine(message_id, stage, error) holds malformed JSON, and
    messages left without a body because a part of theirs could not be decoded; neither
    is a record."""
    msg = F.col("msg")

    def outcome(c: Column) -> Column:
        lost = c["undecodable"] & (c["body"] == "")
        stage = F.when(msg.isNull(), "parse").when(lost, "decode")
        return F.struct(stage.alias("_stage"), c["body"].alias("body"), c["links"].alias("links"))

    # a generator, so that no filter on the outcome is moved below it and decodes again
    rec = parse_message(raw).select(
        *[c for c in raw.columns if c != "raw"],
        header(msg, "Subject").alias("subject"), header(msg, "From").alias("sender"),
        parse_mail_date(F.nullif(header(msg, "Date"), F.lit(""))).alias("date"),
        F.inline(F.array(let(chosen_body(msg), outcome))))
    why = F.when(F.col("_stage") == "parse", "malformed message JSON").otherwise("malformed base64 body")
    bad = rec.filter(F.col("_stage").isNotNull()).select("message_id", F.col("_stage").alias("stage"), why.alias("error"))
    return rec.filter(F.col("_stage").isNull()).drop("_stage"), bad
