"""The reference's daily run as one Spark job, for one day or many at once.

listing + labels + bodies -> selection -> calls -> prompts -> model -> merge ->
digests -> pages and blocks -> sinks. Model answers, those of merges included, are stored
in the output's ``answers`` table before anything reads them, keyed by the prompt's hash:
a re-run asks only what has no good answer yet. Failed fetches, undecodable messages and
the run's statistics are tables too.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from quire.functions import taxonomy as TX
from quire.operators import chunking as K
from quire.operators import digest as D
from quire.operators import inference as I
from quire.operators import layout as L
from quire.operators import select as S
from quire.operators.common import bounded_broadcast
from quire.operators.prompts import render_prompts
from quire.params import DEFAULT, Params
from quire.sinks.stats import run_stats
from quire.sinks.tables import add_answers, newest, read_answers, write_digests_json, write_pages, write_run
from quire.sources import mail as M


def on_day(df: DataFrame, day: _dt.date | None) -> DataFrame:
    """``df`` restricted to a day by a literal, where it has days: partitions are pruned."""
    if day is None or "digest_date" not in df.columns:
        return df
    return df.filter(F.col("digest_date") == F.lit(day))


def decided(listing: DataFrame, out: str, day: _dt.date | None, p: Params) -> DataFrame:
    """The published (day, label) pairs that a run decides on again: those of the run's label and
    day, or of all days that the listing has. Where it finds nothing, their pages go."""
    spark = listing.sparkSession
    latest = newest(spark, out)
    if latest is None:
        return spark.createDataFrame([], "digest_date date, label string")
    mine = latest.drop("version") if p.label is None else latest.drop("version").filter(F.col("label") == p.label)
    if day is not None:
        return on_day(mine, day)
    return mine.join(I.persist(listing.select("digest_date").distinct()), "digest_date", "left_semi")


def run_day(listing: DataFrame, labels: DataFrame, bodies: DataFrame, factory: I.ModelFactory,
            day: _dt.date | None = None, out: str | None = None, p: Params = DEFAULT,
            dry_run: bool = False, done: DataFrame | None = None, quarantine: DataFrame | None = None,
            tx: TX.Taxonomy = TX.DEFAULT) -> dict[str, DataFrame]:
    """``done``: answers of earlier runs; by default those stored under ``out``."""
    spark = listing.sparkSession
    if done is None and out:
        done = read_answers(spark, out)
    sel = S.selection(on_day(listing, day), labels, on_day(bodies, day), p, [p.label] if p.label else None)
    found = S.count_days(sel["found"], "found")
    fetched = S.count_days(sel["fetched"], "fetched")
    seen = Observation("selection")          # in-flight counts, gathered by the job itself (B3)
    nl = I.persist(sel["kept"].observe(seen, F.count(F.lit(1)).alias("newsletters"),
                                       F.sum(F.length("body")).alias("body_chars")))
    counts = S.daily_counts(nl)
    prompts = render_prompts(K.prompt_blocks(K.assign_calls(nl, p), p), tx)
    answers = I.persist(I.infer_new(prompts, done, factory, p))
    if out:
        add_answers(I.fresh_answers(answers), out)
    final, merges = I.merge_partials(answers, S.DAY_KEYS, factory, p, done)
    if out:
        add_answers(merges, out)
    digests = I.persist(D.parse_responses(final))
    pages = D.digest_pages(digests, counts, p, tx)
    blocks = L.digest_blocks(digests, p, tx=tx)
    stats = run_stats(found, fetched, counts, digests)
    failed = sel["failed"]
    if quarantine is not None:
        failed = failed.unionByName(quarantine, allowMissingColumns=True)
    if out:
        if dry_run:
            write_digests_json(digests, f"{out}/digests")
        else:
            write_pages(pages, blocks, out, decided(listing, out, day, p))
        write_run(stats, failed, out)
    return {"newsletters": nl, "answers": answers.select(*I.ANSWER_COLS).unionByName(merges), "digests": digests,
            "pages": pages, "blocks": blocks, "quarantine": failed, "stats": stats, "observed": seen}


def run_mail(raw: DataFrame, labels: DataFrame, factory: I.ModelFactory, day: _dt.date | None = None,
             out: str | None = None, p: Params = DEFAULT, **kw) -> dict[str, DataFrame]:
    """From stored mail (``read_raw``) to pages: the listing comes from the messages
    themselves, and only those within the limit are decoded. What cannot be decoded is
    in the quarantine with its day and label; it has no body, so it is a failed fetch."""
    raw = on_day(raw, day)
    listing = raw.select("message_id", "digest_date", "list_pos")
    keyed = S.daily_topk(S.label_filter(listing, labels, [p.label] if p.label else None), p)
    wanted = bounded_broadcast(keyed.select("message_id", "digest_date").distinct())
    good, bad = M.decode_messages(raw.join(wanted, ["message_id", "digest_date"], "left_semi"), p)
    good = I.persist(good.drop("list_pos"))
    bad = keyed.select(*S.DAY_KEYS, "message_id").join(bad, "message_id")
    return run_day(listing, labels, good, factory, day, out, p, quarantine=bad, **kw)
