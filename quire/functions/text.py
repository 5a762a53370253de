"""Column -> Column text functions.

They stay inside Catalyst (regex, higher-order array functions, built-ins), so they
run in whole-stage code generation next to the scan; no Python UDF is involved.
"""

from __future__ import annotations

import html.entities
import json

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values (must equal the reference's behaviour for identical results).
# Characters that Python's str.strip() / str.isspace() treat as white space.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
# Line boundaries of Python's str.splitlines().
LINE_BREAK = r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x{85}\x{2028}\x{2029}]"
# Runs of line-boundary characters: splitting on them yields the same non-empty
# lines (empty lines are dropped anyway) and is cheaper than the alternation.
LINE_BREAKS = r"[\n\r\x0b\x0c\x1c-\x1e\x{85}\x{2028}\x{2029}]+"
# Markup removed from HTML: comments, script/style/noscript with their content, and every
# other tag (replaced by a line break so each text node is its own line). What is not
# closed runs to the end of the text, as in a parser; so every branch that starts to match
# ends with a match, and the search is linear however broken the markup is. Quoted
# attribute values may hold ">".
MARKUP = (
    r"(?is)<(?:!--.*?(?:-->|\z)|script\b.*?(?:</script\s*>|\z)|style\b.*?(?:</style\s*>|\z)"
    r"|noscript\b.*?(?:</noscript\s*>|\z)"
    r"|[a-z/!?](?:[^>\"'<]++|\"[^\"<]*+\"|'[^'<]*+')*+>|[a-z/!?][^>]*+(?:>|\z))"
)
# Character references at the start of a piece that follows an "&": the standard's names
# with their semicolon, numbers of any length, and the old names that need no semicolon.
NAMED_REF = r"^([A-Za-z][A-Za-z0-9]{1,31});"
NUMERIC_REF = (r"^#(?:[xX]0*+([0-9A-Fa-f]{1,6})(?![0-9A-Fa-f])|0*+([0-9]{1,7})(?![0-9])"
               r"|[xX]([0-9A-Fa-f]++)|([0-9]++));?")
OLD_REF = "^(" + "|".join(sorted((k for k in html.entities.html5 if not k.endswith(";")), key=lambda k: (-len(k), k))) + ")"
# Code fence that may wrap a model's JSON answer.
FENCE = "```"
# ---------------------------------------------------------------------------


def let(x: Column, body) -> Column:
    """``body(x)`` with ``x`` evaluated once, even inside lambdas, where Spark does not
    eliminate common subexpressions (a one-element ``transform`` binds it)."""
    return F.get(F.transform(F.array(x), body), 0)


def ustrip(c: Column) -> Column:
    """Python ``str.strip()``: remove Unicode white space at both ends."""
    return F.trim(c, F.lit(WHITESPACE))


def first_line(c: Column) -> Column:
    return F.substring_index(F.coalesce(c, F.lit("")), "\n", 1)


def entity_table() -> Column:
    """name -> characters for every named reference of the standard, as one literal."""
    names = {k[:-1]: v for k, v in html.entities.html5.items() if k.endswith(";")}
    return F.from_json(F.lit(json.dumps(names)), "map<string,string>")


def decode_entities(c: Column) -> Column:
    """Decode character references in one left-to-right pass, as an HTML parser
    does ("&amp;lt;" -> "&lt;", "&#38;lt;" -> "&lt;"): split on "&", decode the
    reference a piece starts with, keep unknown ones as text. Of a name that is not known
    with its semicolon, the longest old name it starts with counts ("&notit;" -> "\u00acit;").
    Invalid code points give U+FFFD. Text without "&" is returned as is."""
    named = entity_table()

    def piece(x, i):
        ch = F.try_element_at(named, F.regexp_extract(x, NAMED_REF, 1))
        hx, dc = F.regexp_extract(x, NUMERIC_REF, 1), F.regexp_extract(x, NUMERIC_REF, 2)
        code = F.when(hx != "", F.conv(hx, 16, 10).cast("long")).when(dc != "", dc.cast("long"))
        ok = code.between(1, 0xD7FF) | code.between(0xE000, 0x10FFFF)
        num = F.when(ok, F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "utf-32")).otherwise(F.lit("\ufffd"))
        return (F.when(i == 0, x)
                 .when(~x.rlike("^[A-Za-z#]"), F.concat(F.lit("&"), x))      # cannot start a reference
                 .when(ch.isNotNull(), F.concat(ch, F.regexp_replace(x, NAMED_REF, "")))
                 .when(x.rlike(NUMERIC_REF), F.concat(num, F.regexp_replace(x, NUMERIC_REF, "")))
                 .when(x.rlike(OLD_REF), F.concat(F.try_element_at(named, F.regexp_extract(x, OLD_REF, 1)),
                                                  F.regexp_replace(x, OLD_REF, "")))
                 .otherwise(F.concat(F.lit("&"), x)))

    return let(c, lambda v: F.when(F.instr(v, "&") > 0, F.array_join(F.transform(F.split(v, "&"), piece), ""))
               .otherwise(v))


# Collapses a run of equal consecutive lines (of a newline-joined text) to one. The
# group is possessive: it can only ever match a whole line, so giving back characters
# could never produce a match, and not trying halves the cost.
REPEATED_LINE = r"(?md)^(.*+)(?:\n\1)+$"


# Links of a page: the target of an anchor, quoted either way or not at all.
LINK = r"(?i)<a(?:rea)?\b[^<>]*?\bhref\s*=\s*(?:\"[^\"]*\"|'[^']*'|[^\s\"'<>]+)"
BEFORE_TARGET = r"(?is)^.*?\bhref\s*=\s*"


def link_targets(html_text: Column) -> Column:
    """Distinct targets of a page's links, decoded, in first-seen order."""
    def target(tag: Column) -> Column:
        return ustrip(decode_entities(F.regexp_replace(F.regexp_replace(tag, BEFORE_TARGET, ""), "^[\"']|[\"']$", "")))

    found = F.transform(F.regexp_extract_all(html_text, F.lit(LINK), 0), target)
    return F.array_distinct(F.filter(found, lambda x: x != ""))


def clean_lines(c: Column) -> Column:
    """Split into lines, strip each, drop empty ones, drop a line equal to the
    previous kept one, and join with a newline (W2 + T5). The input appears once
    in the expression, so nesting it (MIME walk) does not multiply the work."""
    lines = F.filter(F.transform(F.split(c, LINE_BREAKS), ustrip), lambda x: x != "")
    return F.regexp_replace(F.array_join(lines, "\n"), REPEATED_LINE, "$1")


def strip_markup(html_text: Column) -> Column:
    return decode_entities(F.regexp_replace(html_text, MARKUP, "\n"))


def html_to_text(html_text: Column) -> Column:
    """HTML -> clean text (T3-T5): every text node on its own line, no repeats."""
    return clean_lines(strip_markup(html_text))


def token_estimate(c: Column, chars_per_token: int = 4) -> Column:
    """``len(text) // 4`` as BIGINT; no text counts nothing."""
    return F.floor(F.coalesce(F.length(c), F.lit(0)) / F.lit(chars_per_token)).cast("bigint")


def _swap(c: Column, pairs: list[tuple[str, str]]) -> Column:
    for a, b in pairs:                     # plain replace beats translate() here
        c = F.replace(c, F.lit(a), F.lit(b))
    return c


def b64url_encode(s: Column) -> Column:
    """UTF-8 text -> padded, unwrapped base64url (used to derive MIME fixtures)."""
    return _swap(F.base64(F.encode(s, "UTF-8")), [("\r\n", ""), ("+", "-"), ("/", "_")])


def b64url_decode(c: Column) -> Column:
    """base64url -> BINARY, NULL on malformed input instead of failing the job."""
    return F.try_to_binary(_swap(c, [("-", "+"), ("_", "/")]), F.lit("base64"))


def utf8_lenient(b: Column) -> Column:
    """BINARY -> STRING, invalid byte sequences become U+FFFD."""
    return F.make_valid_utf8(b.cast("string"))


def decode_body(data: Column) -> Column:
    return utf8_lenient(b64url_decode(data))


def strip_fence(text: Column) -> Column:
    """Remove a Markdown code fence around a JSON answer.

    Only when the stripped text starts with a fence: drop the first line, then a
    closing fence at the very end, then strip. A fence with no newline gives ''
    (which then takes the parse-failure path instead of aborting the run).
    """
    t = ustrip(text)
    rest = F.regexp_replace(t, r"^[^\n]*\n", "")
    rest = ustrip(F.regexp_replace(rest, r"```\z", ""))
    fenced = F.when(F.instr(t, "\n") > 0, rest).otherwise(F.lit(""))
    return F.when(F.startswith(t, F.lit(FENCE)), fenced).otherwise(t)
