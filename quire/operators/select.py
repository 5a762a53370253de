"""Message selection (C1-C9, W4, G1): which messages make a day's briefing.

Order is the reference's: limit -> drop failed -> drop tiny -> cap body -> dedup.
The limit runs on the narrow listing (no bodies); bodies are joined back only
for the at most ``max_messages`` survivors of each (digest_date, label).
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.functions.text import ustrip
from quire.operators.common import BROADCAST_MAX_BYTES, bounded_side, likely_in, persist, top_k
from quire.params import DEFAULT, Params

DAY_KEYS = ["digest_date", "label"]


def with_list_pos(listing: DataFrame) -> DataFrame:
    """List order when the source gives none (S4): newest first, then message id.
    A struct sorts like the pair and needs no per-day window (no one-task day)."""
    if "list_pos" in listing.columns:
        return listing
    return listing.withColumn("list_pos", F.struct((-F.unix_micros(F.col("received_ts"))).alias("age"),
                                                  F.col("message_id").alias("id")))


def label_catalog(message_labels: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """Label names with message counts, sorted, and whether the configured label
    exists (A4)."""
    return (message_labels.groupBy("label").agg(F.count(F.lit(1)).alias("n_messages"))
            .withColumn("is_target", F.col("label") == F.lit(p.label)).orderBy("label"))


def day_filter(df: DataFrame, ts_col: str, day: _dt.date) -> DataFrame:
    """Half-open local day [day 00:00, next day 00:00) on a timestamp column.

    Written as a range on the raw column so Parquet can skip row groups.
    """
    t = df.schema[ts_col].dataType       # text literals: no driver time zone involved
    lo = F.lit(f"{day.isoformat()} 00:00:00").cast(t)
    hi = F.lit(f"{(day + _dt.timedelta(days=1)).isoformat()} 00:00:00").cast(t)
    ts = F.col(ts_col)
    return df.filter((ts >= lo) & (ts < hi))


def label_filter(listing: DataFrame, message_labels: DataFrame,
                 labels: list[str] | None = None) -> DataFrame:
    """Messages carrying a label (C2). One output row per (message, label), so
    many labels are processed in one pass; ``labels`` restricts the set."""
    ml = message_labels
    if labels is not None:
        ml = ml.filter(F.col("label").isin(labels))
    return listing.join(ml, "message_id", "inner")


def daily_topk(listing: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """First ``max_messages`` per (digest_date, label) in list order (C4)."""
    if p.max_messages is None:
        return listing
    return top_k(listing, DAY_KEYS, [F.col("list_pos")], p.max_messages,
                 salt_col="message_id")


def fetch_bodies(keys: DataFrame, bodies: DataFrame,
                 max_bytes: int = BROADCAST_MAX_BYTES) -> tuple[DataFrame, DataFrame]:
    """Join listed ids to their bodies (A2/J1). Returns (fetched, failed): a listed id
    without a body row is a failed fetch and goes to quarantine with its day and label
    (C9). Bodies that carry their day are joined on it too, so a partitioned body table
    is read for the listed days only. The ids are broadcast while they have few bytes; beyond
    that a bitmap of their hashes, far smaller, is, so only bodies that are likely listed are
    shuffled."""
    on = ["message_id", "digest_date"] if "digest_date" in bodies.columns else ["message_id"]
    small, few = bounded_side(keys, max_bytes)
    found = bodies.filter(F.col("body").isNotNull())
    ok = (found if few else likely_in(found, small, "message_id", max_bytes)).join(small, on)
    failed = keys.join(ok.select(*on), on, "left_anti").select(
        *[c for c in DAY_KEYS if c in keys.columns], "message_id", F.lit("fetch").alias("stage"),
        F.lit("message body not found").alias("error"))
    return ok, failed


def drop_tiny(df: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """Drop empty bodies and bodies whose stripped length is < ``min_body``."""
    return df.filter(F.col("body").isNotNull() & (F.length(ustrip(F.col("body"))) >= p.min_body))


def cap_body(df: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """Keep the first ``body_cap`` characters of the *unstripped* body."""
    return df.withColumn("body", F.substring(F.col("body"), 1, p.body_cap))


def subject_key(subject: Column) -> Column:
    return F.lower(ustrip(F.coalesce(subject, F.lit(""))))


def dedup_subject(df: DataFrame, keys: list[str] = DAY_KEYS) -> DataFrame:
    """Keep the first message (by list_pos) per lower(strip(subject)).

    An aggregate, not a window: ``min_by`` is combined map-side, so a subject shared
    by a third of all rows is reduced before the shuffle.
    """
    cols = [c for c in df.columns]
    packed = F.struct(*[F.col(c) for c in cols])
    return (df.withColumn("__key", subject_key(F.col("subject")))
              .groupBy(*keys, "__key")
              .agg(F.min_by(packed, F.col("list_pos")).alias("__m"))
              .select("__m.*"))


def daily_counts(df: DataFrame, keys: list[str] = DAY_KEYS) -> DataFrame:
    """Messages per (digest_date, label) after dedup (G1)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("newsletter_count"))


def selection(listing: DataFrame, message_labels: DataFrame, bodies: DataFrame,
              p: Params = DEFAULT, labels: list[str] | None = None) -> dict[str, DataFrame]:
    """The whole selection: ``found`` (listed, within the limit), ``fetched`` (with a
    usable body), ``kept`` (without repeated subjects) and ``failed``. The fetched messages
    are written once: their bodies are neither scanned again nor sorted, as repeated
    subjects are found among (day, label, id, position, subject) alone."""
    top = daily_topk(label_filter(listing, message_labels, labels), p)
    ok, failed = fetch_bodies(top, bodies)
    fetched, kept = usable(ok, p)
    return {"found": top, "fetched": fetched, "kept": kept, "failed": failed}


def usable(ok: DataFrame, p: Params = DEFAULT) -> tuple[DataFrame, DataFrame]:
    """(messages with a usable body, written once; of them, those without repeated subjects)."""
    fetched = persist(cap_body(drop_tiny(ok, p), p))
    first = dedup_subject(fetched.select(*DAY_KEYS, "message_id", "list_pos", "subject"))
    same = [fetched[c].eqNullSafe(first[c]) for c in (*DAY_KEYS, "message_id")]
    return fetched, fetched.join(first, same, "left_semi")


def newsletters(listing: DataFrame, message_labels: DataFrame, bodies: DataFrame,
                p: Params = DEFAULT, labels: list[str] | None = None
                ) -> tuple[DataFrame, DataFrame]:
    """(newsletters, failed fetches)."""
    s = selection(listing, message_labels, bodies, p, labels)
    return s["kept"], s["failed"]


def count_days(df: DataFrame, name: str) -> DataFrame:
    return df.groupBy(*DAY_KEYS).agg(F.count(F.lit(1)).alias(name))
