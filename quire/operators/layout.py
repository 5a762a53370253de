"""Page layout (K1-K11, S3, C11, C13): a digest row -> ordered page blocks.

Each digest row already holds its whole page, so the layout is row-local: the four
sections are built as arrays with higher-order functions, concatenated, capped and
exploded. No shuffle, and a page is never split across tasks.

Output: (digest_date, label, block_pos, child_pos, type, level, icon, text);
toggle children carry their parent's ``block_pos`` and ``child_pos >= 1``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.functions import taxonomy as TX
from quire.operators.digest import SOURCE_T, empty_array, empty_categories, icon_of
from quire.operators.select import DAY_KEYS
from quire.params import DEFAULT, Params

# Section headings and default texts.
H_SUMMARY = "Executive Summary"
H_CATEGORIES = "Categorized Insights"
H_SOURCES = "Source Details"
NO_SUMMARY = "No summary available."
NO_DETAILS = "No details extracted."
TRUNCATED = f"{TX.NOTICE_ICON} Content truncated at the page block limit."

CHILD_T = "struct<type:string,level:int,icon:string,text:string>"


def _child(type_: str, text: Column, level: int | None = None, icon: str | None = None) -> Column:
    return F.struct(F.lit(type_).alias("type"), F.lit(level).cast("int").alias("level"),
                    F.lit(icon).cast("string").alias("icon"), text.cast("string").alias("text"))


def _block(type_: str, text: Column | None = None, level: int | None = None, icon: str | None = None,
           children: Column | None = None) -> Column:
    return F.struct(F.lit(type_).alias("type"), F.lit(level).cast("int").alias("level"),
                    F.lit(icon).cast("string").alias("icon"),
                    (text if text is not None else F.lit(None)).cast("string").alias("text"),
                    (children if children is not None else F.array().cast(f"array<{CHILD_T}>")).alias("children"))


def _heading(text: str | Column, level: int = 2) -> Column:
    return _block("heading", text if isinstance(text, Column) else F.lit(text), level=level)


def _empty_blocks() -> Column:
    return F.array().cast(f"array<struct<type:string,level:int,icon:string,text:string,children:array<{CHILD_T}>>>")


def flags_heading(tx: TX.Taxonomy = TX.DEFAULT) -> str:
    return f"{tx.icon(tx.domain_category)} {tx.domain_category}"


def page_blocks(es: Column, flags: Column, categories: Column, per_source: Column,
                tx: TX.Taxonomy = TX.DEFAULT) -> Column:
    """All top-level blocks of a page, in order."""
    summary = F.array(_heading(H_SUMMARY),
                      _block("callout", F.coalesce(es, F.lit(NO_SUMMARY)), icon=TX.SUMMARY_ICON),
                      _block("divider"))
    flags = F.coalesce(flags, empty_array())
    flag_sec = F.when(F.size(flags) > 0, F.concat(
        F.array(_heading(flags_heading(tx))),
        F.transform(flags, lambda f: _block("callout", f, icon=TX.FLAG_ICON)),
        F.array(_block("divider")))).otherwise(_empty_blocks())
    cats = F.coalesce(categories, empty_categories())

    def one_category(e):
        items = F.coalesce(e["value"], empty_array())
        return F.when(F.size(items) > 0, F.concat(
            F.array(_heading(F.concat(icon_of(e["key"], tx), F.lit(" "), e["key"]), level=3)),
            F.transform(items, lambda v: _block("bullet", v)))).otherwise(_empty_blocks())

    cat_sec = F.when(F.cardinality(cats) > 0, F.concat(
        F.array(_heading(H_CATEGORIES)),
        F.flatten(F.transform(F.map_entries(cats), one_category)),
        F.array(_block("divider")))).otherwise(_empty_blocks())
    ps = F.coalesce(per_source, F.array().cast(T.ArrayType(SOURCE_T)))

    def toggle(s):
        summ = F.coalesce(s["summary"], F.lit(""))
        kids = F.concat(
            F.when(summ != "", F.array(_child("paragraph", summ))).otherwise(F.array().cast(f"array<{CHILD_T}>")),
            F.transform(F.coalesce(s["key_facts"], empty_array()),
                        lambda x: _child("bullet", F.concat(F.lit(TX.FACT_ICON + " "), x))),
            F.transform(F.coalesce(s["links"], empty_array()),
                        lambda x: _child("bullet", F.concat(F.lit(TX.LINK_ICON + " "), x))))
        kids = F.when(F.size(kids) > 0, kids).otherwise(F.array(_child("paragraph", F.lit(NO_DETAILS))))
        title = F.concat(F.lit(TX.SOURCE_ICON + " "), F.coalesce(s["source"], F.lit("Unknown")))
        return _block("toggle", title, children=kids)

    src_sec = F.when(F.size(ps) > 0, F.concat(F.array(_heading(H_SOURCES)), F.transform(ps, toggle))) \
        .otherwise(_empty_blocks())
    return F.concat(summary, flag_sec, cat_sec, src_sec)


def cap_blocks(blocks: Column, p: Params = DEFAULT) -> Column:
    """Over ``block_limit`` top-level blocks: keep the first limit-1 and add a notice
    (exactly ``block_limit`` is left alone). Children are not counted (S3, F11)."""
    n = p.block_limit
    return F.when(F.size(blocks) > n,
                  F.concat(F.slice(blocks, 1, n - 1), F.array(_block("paragraph", F.lit(TRUNCATED))))) \
        .otherwise(blocks)


def digest_blocks(digests: DataFrame, p: Params = DEFAULT, keys: list[str] = DAY_KEYS,
                  tx: TX.Taxonomy = TX.DEFAULT) -> DataFrame:
    """Flatten each page to one row per block and toggle child, in one generator."""
    blocks = cap_blocks(page_blocks(F.col("executive_summary"), F.col("domain_flags"),
                                    F.col("categories"), F.col("per_source"), tx), p)

    def row(pos, child_pos, b):
        return F.struct(pos.cast("int").alias("block_pos"), child_pos.cast("int").alias("child_pos"),
                        b["type"].alias("type"), b["level"].alias("level"), b["icon"].alias("icon"),
                        F.substring(b["text"], 1, p.text_limit).alias("text"))

    flat = F.flatten(F.transform(blocks, lambda b, i: F.concat(
        F.array(row(i + 1, F.lit(0), b)),
        F.transform(b["children"], lambda c, j: row(i + 1, j + 1, c)))))
    return digests.select(*keys, F.inline(flat))
