"""End to end: the daily job with the offline model, idempotent sinks."""

import datetime as dt
import os
import tempfile
import uuid

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import SF_SMALL
from quire.functions import taxonomy as TX
from quire.operators import digest as D
from quire.operators import layout as L
from quire.operators import select as S
from quire.params import DEFAULT, target_day
from quire.plans.job import on_day, run_day
from quire.plans.offline import offline_model
from quire.session import scratch_path
from quire.sinks import tables as ST
from quire.sinks.tables import read_published
from quire.sources import catalog as C


def test_target_day():
    now = dt.datetime(2025, 2, 28, 9, 0)
    assert target_day("2025-02-27") == dt.date(2025, 2, 27)
    assert target_day(today=True, now=now) == dt.date(2025, 2, 28)
    assert target_day(now=now) == dt.date(2025, 2, 27)
    with pytest.raises(ValueError):
        target_day("2025-02-30")


def tables(spark, sf=SF_SMALL):
    return C.message_keys(spark, sf), C.message_labels(spark, sf), C.bodies(spark, sf)


def published(spark, out, run):
    return sorted(map(repr, read_published(spark, out, "digest_pages", run["pages"].schema).collect()))


def test_run_day_end_to_end(spark):
    out = scratch_path(spark, f"t-job-{uuid.uuid4().hex[:8]}")
    args = tables(spark)
    p = DEFAULT.with_(max_input_tokens=8000)          # some days take the chunked route
    calls = tempfile.mkdtemp(prefix="calls-")

    def counted(limit):
        def run(batch):
            for _ in batch:
                open(os.path.join(calls, uuid.uuid4().hex), "w").close()
            return offline_model(limit)(batch)
        return run
    r = run_day(*args, counted, out=out, p=p)
    pages = r["pages"].collect()
    assert r["observed"].get["newsletters"] == r["newsletters"].count()
    assert pages and all(x.status == "Generated" for x in pages)
    assert {x.label for x in pages} == {DEFAULT.label}
    first, n = published(spark, out, r), len(os.listdir(calls))
    assert n == spark.read.parquet(f"{out}/answers").count() > len(pages)
    run_day(*args, counted, out=out, p=p)             # re-run: same tables, no model call, merges included
    assert published(spark, out, r) == first and len(os.listdir(calls)) == n
    day = dt.date(2024, 1, 2)
    one = run_day(*args, offline_model, day=day, p=p)["pages"].collect()
    assert [x.digest_date for x in one] == [day]
    # another label goes to the same tables and leaves these pages alone
    run_day(*args, counted, out=out, p=p.with_(label=C.LABEL_OF_TOXIC))
    now = read_published(spark, out, "digest_pages", r["pages"].schema)
    assert sorted(map(repr, now.filter(F.col("label") == DEFAULT.label).collect())) == first
    assert now.filter(F.col("label") == C.LABEL_OF_TOXIC).count() > 0
    stats = spark.read.parquet(f"{out}/run_stats").filter(F.col("label") == DEFAULT.label).collect()
    assert all(x.found >= x.fetched >= x.unique_count for x in stats) and len(stats) >= len(pages)


def test_one_day_reads_one_partition(spark):
    listing, labels, bodies = tables(spark)
    path = scratch_path(spark, f"t-bodies-{uuid.uuid4().hex[:8]}")
    bodies.write.partitionBy("digest_date").parquet(path)
    day = dt.date(2024, 1, 2)
    stored = on_day(spark.read.parquet(path), day)
    keys = S.label_filter(on_day(listing, day), labels)
    ok, failed = S.fetch_bodies(keys, stored)
    assert "PartitionFilters: [isnotnull(digest_date" in ok._jdf.queryExecution().executedPlan().toString()
    assert ok.count() > 0 and failed.count() == 0


def test_failed_fetches_keep_day_and_label(spark):
    listing, labels, bodies = tables(spark)
    gone = labels.groupBy("message_id").count().filter("count = 2").limit(1).collect()[0].message_id
    sel = S.selection(listing, labels, bodies.filter(F.col("message_id") != gone), DEFAULT.with_(max_messages=None))
    lost = sel["failed"].collect()
    assert sorted(x.label for x in lost) == sorted([C.LABEL_OF_QUALITY, C.LABEL_OF_TOXIC])
    assert {x.message_id for x in lost} == {gone}


def test_dry_run_writes_digests_only(spark):
    out = scratch_path(spark, f"t-dry-{uuid.uuid4().hex[:8]}")
    r = run_day(*tables(spark), offline_model, out=out, dry_run=True)
    assert spark.read.json(f"{out}/digests").count() == r["digests"].count()
    assert not os.path.exists(out.removeprefix("file:") + "/digest_pages")


def test_own_taxonomy(spark):
    own = TX.Taxonomy((("Alpha", "A"), ("Focus", "F")), (("Alpha", ("the",)), ("Focus", ("of",))), ("and",), "Focus", "?")
    seen = []

    r = run_day(*tables(spark), offline_model, tx=own)
    nl = r["newsletters"]
    d = D.extractive_digests(nl, tx=own)
    assert {c for x in d.collect() for c in x.active_categories} <= {"Alpha", "Focus"}
    b = L.digest_blocks(D.parse_responses(d.select(*S.DAY_KEYS, D.digest_json(d).alias("response"))), tx=own)
    seen = {x.text for x in b.filter("type = 'heading'").collect()}
    assert "A Alpha" in seen and "F Focus" in seen and not seen & {"🤖 AI & ML"}


def test_run_day_without_message_limit(spark):
    p = DEFAULT.with_(max_input_tokens=6000, max_messages=None)   # whole days, distributed packing
    r = run_day(*tables(spark), offline_model, p=p)
    pages = r["pages"].collect()
    assert pages and all(x.status == "Generated" for x in pages)
    assert r["digests"].count() == len(pages)


PAGE = "digest_date date, label string, title string"
BLOCK = "digest_date date, label string, pos int"
ONE, TWO = dt.date(2024, 1, 1), dt.date(2024, 1, 2)


def _publish(spark, out, pages, blocks, covered=()):
    ST.write_pages(spark.createDataFrame(pages, PAGE), spark.createDataFrame(blocks, BLOCK), out,
                   spark.createDataFrame(list(covered), "digest_date date, label string"))


def _visible(spark, out):
    get = lambda name, schema: sorted(map(tuple, read_published(
        spark, out, name, spark.createDataFrame([], schema).schema).collect()))
    return get("digest_pages", PAGE), get("digest_blocks", BLOCK)


def test_run_killed_before_its_commit_changes_nothing(spark, monkeypatch):
    out = scratch_path(spark, f"t-commit-{uuid.uuid4().hex[:8]}")
    assert _visible(spark, out) == ([], [])
    _publish(spark, out, [(ONE, "L", "a"), (TWO, "L", "b")], [(ONE, "L", 1), (ONE, "L", 2), (TWO, "L", 1)])
    before = _visible(spark, out)
    assert before == ([(ONE, "L", "a"), (TWO, "L", "b")], [(ONE, "L", 1), (ONE, "L", 2), (TWO, "L", 1)])
    monkeypatch.setattr(ST, "COMMITS", "\x00")           # the last write fails: tables are there, the commit is not
    with pytest.raises(Exception):
        _publish(spark, out, [(ONE, "L", "new")], [(ONE, "L", 9)])
    monkeypatch.undo()
    assert spark.read.parquet(f"{out}/digest_pages").count() == 3 and _visible(spark, out) == before
    _publish(spark, out, [(ONE, "L", "new")], [(ONE, "L", 9)])
    assert _visible(spark, out) == ([(ONE, "L", "new"), (TWO, "L", "b")], [(ONE, "L", 9), (TWO, "L", 1)])
    # a day that is covered and empty has no page any more; other labels are left alone
    _publish(spark, out, [(TWO, "M", "m")], [], [(ONE, "L")])
    assert _visible(spark, out) == ([(TWO, "L", "b"), (TWO, "M", "m")], [(TWO, "L", 1)])


def test_emptied_day_loses_its_page(spark):
    out = scratch_path(spark, f"t-empty-{uuid.uuid4().hex[:8]}")
    listing, labels, bodies = tables(spark)
    r = run_day(listing, labels, bodies, offline_model, out=out)
    days = sorted(x.digest_date for x in r["pages"].collect())
    gone = listing.filter(F.col("digest_date") == days[0]).select("message_id")
    r = run_day(listing, labels.join(gone, "message_id", "left_anti"), bodies, offline_model, day=days[0], out=out)
    pages = read_published(spark, out, "digest_pages", r["pages"].schema)
    assert sorted(x.digest_date for x in pages.collect()) == days[1:]


def test_versions_are_few_files_for_many_days(spark):
    """Pages, statistics and quarantine of many days are not written as a folder for each day."""
    import glob
    out = scratch_path(spark, f"t-files-{uuid.uuid4().hex[:8]}")
    days = [dt.date(2024, 1, 1) + dt.timedelta(days=i) for i in range(120)]
    _publish(spark, out, [(d, "L", "a") for d in days], [(d, "L", i) for d in days for i in range(3)])
    ST.write_run(spark.createDataFrame([(d, "L", 1) for d in days] + [(None, "L", 7)], "digest_date date, label string, found long"),
                 spark.createDataFrame([(d, "L", "x") for d in days[:9]], "digest_date date, label string, stage string"), out)
    files = glob.glob(out.removeprefix("file:") + "/**/*.parquet", recursive=True)
    assert 0 < len(files) < len(days) // 2
    schema = T.StructType.fromDDL("digest_date date, label string, found long")
    get = lambda: sorted(tuple(r) for r in read_published(spark, out, "run_stats", schema, ST.RUN_LOG).collect() if r.digest_date)
    assert get() == [(d, "L", 1) for d in days]
    assert read_published(spark, out, "run_stats", schema, ST.RUN_LOG).count() == len(days) + 1
    ST.write_run(spark.createDataFrame([(days[3], "L", 5)], "digest_date date, label string, found long"),
                 spark.createDataFrame([], "digest_date date, label string, stage string"), out)
    assert get() == [(d, "L", 5 if d == days[3] else 1) for d in days]
    assert len(_visible(spark, out)[0]) == len(days)      # statistics alone hide no page
