"""DuckDB SQL fragments for the oracle queries.

They restate the same semantics in another engine's dialect (RE2 regexes, 1-based list
lambdas) and share no pattern with the engine, so a match is evidence, not tautology.
"""

from __future__ import annotations

import html.entities

from quire.params import DEFAULT, Params
from quire.sources import catalog

# White space as Unicode and Python have it, by code point.
SPACES = [*range(9, 14), *range(28, 33), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F,
          0x205F, 0x3000]
WS = "||".join(f"chr({c})" for c in SPACES)
LINE_END = r"[\x0A-\x0D\x1C-\x1E\x{85}\x{2028}\x{2029}]"
TAGS = "(?is)" + "|".join([r"<!--.*?(?:-->|\z)", *(rf"<{e}\b.*?(?:</{e}\s*>|\z)" for e in ("script", "style", "noscript")),
                          r"""<[a-z/!?](?:[^<>"']|"[^<"]*"|'[^<']*')*>""", r"<[a-z/!?][^>]*(?:>|\z)"])
NL = "chr(10)"


def lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def ustrip(x: str) -> str:
    return f"trim({x}, {WS})"


def first_line(x: str) -> str:
    return f"split_part(coalesce({x}, ''), {NL}, 1)"


def entity_map() -> str:
    rows = ((k[:-1], v) for k, v in html.entities.html5.items() if k.endswith(";"))
    return "MAP {" + ", ".join(f"{lit(k)}: {'||'.join(f'chr({ord(c)})' for c in v)}" for k, v in rows) + "}"


def decode_entities(x: str) -> str:
    """Single pass over the pieces after each '&' (DuckDB lists are 1-based)."""
    ref, hexa, deca = "'^([A-Za-z][A-Za-z0-9]+);'", "'^#[xX]([0-9A-Fa-f]+);'", "'^#([0-9]+);'"
    name = f"({entity_map()})[regexp_extract(p, {ref}, 1)]"
    digits = (f"(CASE WHEN regexp_matches(p, {hexa}) THEN ltrim(regexp_extract(p, {hexa}, 1), '0') "
              f"ELSE ltrim(regexp_extract(p, {deca}, 1), '0') END)")
    code = (f"(CASE WHEN length({digits}) BETWEEN 1 AND 7 THEN "
            f"CAST((CASE WHEN regexp_matches(p, {hexa}) THEN '0x' ELSE '' END) || {digits} AS BIGINT) ELSE 0 END)")
    char = (f"(CASE WHEN {code} BETWEEN 1 AND 55295 OR {code} BETWEEN 57344 AND 1114111 "
            f"THEN chr(CAST({code} AS INTEGER)) ELSE chr(65533) END)")
    body = (f"CASE WHEN i = 1 THEN p WHEN {name} IS NOT NULL THEN {name} || regexp_replace(p, {ref}, '') "
            f"WHEN regexp_matches(p, {hexa}) THEN {char} || regexp_replace(p, {hexa}, '') "
            f"WHEN regexp_matches(p, {deca}) THEN {char} || regexp_replace(p, {deca}, '') ELSE '&' || p END")
    return (f"(CASE WHEN strpos({x}, '&') > 0 THEN "
            f"array_to_string(list_transform(string_split({x}, '&'), lambda p, i: {body}), '') ELSE {x} END)")


def strip_markup(x: str) -> str:
    return decode_entities(f"regexp_replace({x}, {lit(TAGS)}, {NL}, 'g')")


def lines_list(x: str) -> str:
    """Stripped, non-empty lines of ``x`` as a list."""
    return (f"list_filter(list_transform(string_split_regex({x}, {lit(LINE_END)}), "
            f"lambda s: {ustrip('s')}), lambda s: s <> '')")


def dedup_join(list_col: str) -> str:
    """Drop a line equal to the previous one and join by newline (``list_col`` is a column)."""
    return (f"array_to_string(list_filter({list_col}, lambda s, i: i = 1 OR s <> {list_col}[i - 1]), "
            f"{NL})")


def tokens(x: str, p: Params = DEFAULT) -> str:
    return f"CAST(length({x}) // {p.chars_per_token} AS BIGINT)"


def day_of(doc_id: str) -> str:
    return f"(DATE '{catalog.FIRST_DAY.isoformat()}' + CAST({doc_id} // {catalog.DOCS_PER_DAY} AS INTEGER))"


MESSAGES = f"""msg AS (
  SELECT doc_id AS message_id, {day_of('doc_id')} AS digest_date, doc_id AS list_pos,
         coalesce(source, '') AS sender, {first_line('text')} AS subject,
         coalesce(text, '') AS body
  FROM documents)"""

MESSAGE_LABELS = f"""ml AS (
  SELECT doc_id AS message_id, {lit(catalog.LABEL_OF_QUALITY)} AS label FROM labels WHERE quality = 1
  UNION ALL
  SELECT doc_id AS message_id, {lit(catalog.LABEL_OF_TOXIC)} AS label FROM labels WHERE toxic = 1)"""


def newsletters_cte(p: Params = DEFAULT) -> str:
    """CTEs ending in ``nl`` (the selected newsletters), the reference's order:
    limit -> drop tiny -> cap body -> dedup by subject."""
    limit = "" if p.max_messages is None else (
        f"QUALIFY row_number() OVER (PARTITION BY digest_date, label ORDER BY list_pos) <= {p.max_messages}")
    return f"""{MESSAGES},
{MESSAGE_LABELS},
keyed AS (SELECT m.*, ml.label FROM msg m JOIN ml USING (message_id)),
top AS (SELECT * FROM keyed {limit}),
big AS (SELECT * FROM top WHERE length({ustrip('body')}) >= {p.min_body}),
capped AS (SELECT * REPLACE (substring(body, 1, {p.body_cap}) AS body) FROM big),
nl AS (SELECT *, CAST(digest_date AS VARCHAR) || {lit(catalog.DATE_SUFFIX)} AS date FROM capped
       QUALIFY row_number() OVER (PARTITION BY digest_date, label, lower({ustrip('subject')})
                                  ORDER BY list_pos) = 1)"""
