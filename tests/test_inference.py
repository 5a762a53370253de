"""Model plumbing: failures become rows, known prompts are skipped, the merge is
budget-checked and ends with one answer per day; streaming re-runs are no-ops."""

import os
import uuid

from pyspark.sql import functions as F

from conftest import SF_SMALL
from quire.operators import digest as D
from quire.operators import inference as I
from quire.params import DEFAULT
from quire.plans.offline import offline_model
from quire.plans.q_infer import publish_extractive
from quire.plans.q_select import newsletters
from quire.session import scratch_path
from quire.streaming import ingest as R


def _prompts(spark, n=6):
    rows = [("2024-01-01", "L", i, f"prompt {i}") for i in range(n)]
    return spark.createDataFrame(rows, "digest_date string, label string, chunk_id int, prompt string") \
        .withColumn("digest_date", F.to_date("digest_date"))


def _asked(spark, name):
    """A counter of model calls that survives worker processes: a file per call."""
    import tempfile
    folder = tempfile.mkdtemp(prefix=f"calls-{name}-")

    def factory(limit):
        def run(batch):
            import os
            import uuid
            for _ in batch:
                open(os.path.join(folder, uuid.uuid4().hex), "w").close()
            return offline_model(limit)(batch)
        return run
    return factory, lambda: len(os.listdir(folder))


def test_model_failure_is_a_row(spark):
    def factory(limit):
        def run(batch):
            raise RuntimeError("service unavailable" + "!" * 600)
        return run
    rdf = I.infer(_prompts(spark), factory)
    r = rdf.collect()
    assert len(r) == 6 and all(x.response is None and x.error.endswith("!" * 600) for x in r)
    d = D.parse_responses(rdf.select("digest_date", "label", "response", "error"))
    s = d.select(D.status(F.col("executive_summary"), F.col("parse_error")).alias("s")).distinct().collect()
    assert [x.s for x in s] == ["Failed"]


class Refusing:
    """Refuses every third call."""

    def __init__(self, error=I.Busy):
        self.calls, self.error = 0, error

    def __call__(self, batch):
        self.calls += 1
        if self.calls % 3 == 0:
            raise self.error("later")
        return [f"answer to {p}" for p in batch]


def test_busy_model_is_asked_again():
    prompts = [f"prompt {i}" for i in range(40)]
    for error in (I.Busy, TimeoutError, ConnectionError):
        model, waits = Refusing(error), []
        answers, errors = I.ask(model, prompts, 4, I.Patience(DEFAULT, waits.append))
        assert answers == [f"answer to {p}" for p in prompts] and errors == [None] * 40
        assert model.calls == 10 + len(waits) and len(waits) == 4      # ten batches, calls 3, 6, 9 and 12 refused
        assert all(0.5 <= w <= 1 for w in waits)


def test_waits_grow_and_are_limited():
    waits, calls = [], []

    def never(batch):
        calls.append(batch)
        raise I.Busy("no", after=5 if len(calls) == 1 else None)
    p = DEFAULT.with_(busy_tries=6, busy_wait_most=8.0, busy_budget=8)
    answers, errors = I.ask(never, list("abcdef"), 3, I.Patience(p, waits.append))
    assert answers == [None] * 6 and errors == ["Busy: no"] * 6
    assert len(calls) == 7 + 3                     # six repeats of the first batch, the budget's last two of the other
    assert waits[0] == 5 and all(min(2 ** i, 8) / 2 <= w <= min(2 ** i, 8) for i, w in enumerate(waits[1:6], 1))


def test_other_failures_are_not_repeated():
    waits, calls = [], []

    def bad(batch):
        calls.append(len(batch))
        raise RuntimeError("bad prompt")
    assert I.ask(bad, ["a", "b"], 2, I.Patience(DEFAULT, waits.append))[0] == [None, None]
    assert calls == [2, 1, 1] and not waits


def test_busy_model_in_a_job(spark):
    def factory(limit):
        calls = []

        def run(batch):
            calls.append(batch)
            if len(calls) % 3 == 0:
                raise I.Busy()
            return [f"answer to {p}" for p in batch]
        return run
    rows = I.infer(_prompts(spark, 60), factory, DEFAULT.with_(busy_wait=0.01), batch_size=1, partitions=2).collect()
    assert len(rows) == 60 and all(r.response == f"answer to {r.prompt}" and r.error is None for r in rows)


def test_one_bad_prompt_costs_no_other(spark):
    def factory(limit):
        assert limit == DEFAULT.output_tokens
        def run(batch):
            if any(p == "prompt 3" for p in batch):
                raise RuntimeError("bad prompt")
            return ["ok"] * len(batch)
        return run
    r = {x.chunk_id: (x.response, x.error) for x in I.infer(_prompts(spark), factory, partitions=1).collect()}
    assert r == {i: ("ok", None) if i != 3 else (None, "RuntimeError: bad prompt") for i in range(6)}


def test_known_prompts_are_skipped_and_failed_ones_retried(spark):
    def factory(limit):
        def run(batch):
            return ["NEW"] * len(batch)
        return run
    p = _prompts(spark)
    done = p.filter("chunk_id < 5").withColumn("prompt_hash", F.sha2("prompt", 256)).select(
        "prompt_hash", F.when(F.col("chunk_id") < 4, F.lit("OLD")).alias("response"),
        F.when(F.col("chunk_id") == 4, F.lit("failed")).alias("error"))
    got = sorted((r.chunk_id, r.response, r.fresh) for r in I.infer_new(p, done.unionAll(done), factory).collect())
    assert got == [(i, "OLD", False) for i in range(4)] + [(4, "NEW", True), (5, "NEW", True)]


PART_T = "digest_date string, label string, chunk_id int, response string, error string"


def _merge(spark, rows, budget, factory=offline_model, done=None):
    parts = spark.createDataFrame(rows, PART_T).withColumn("digest_date", F.to_date("digest_date"))
    out, calls = I.merge_partials(parts, ["digest_date", "label"], factory, DEFAULT.with_(max_input_tokens=budget), done)
    return {str(r.digest_date): r for r in out.collect()}, calls


def test_merge_is_budget_checked(spark):
    long = "x" * 12000                       # 3,000 tokens per partial answer: two fit a merge
    rows = [("2024-01-01", "L", c, long, None) for c in range(1, 20)] + \
        [("2024-01-02", "L", 0, '{"executive_summary": "s"}', None)]
    factory, n_calls = _asked(spark, "merge")
    got, calls = _merge(spark, rows, 8500, factory)
    assert len(got) == 2 and got["2024-01-02"].response == '{"executive_summary": "s"}'
    assert "Offline briefing" in got["2024-01-01"].response and got["2024-01-01"].warning is None
    first = n_calls()
    assert first == 10 + 1 and calls.count() == first        # 19 answers in pairs, then all short answers at once
    again, calls = _merge(spark, rows, 8500, factory, calls)
    assert n_calls() == first and calls.count() == 0         # merge answers are stored too
    assert again["2024-01-01"].response == got["2024-01-01"].response


def test_failed_parts_do_not_vanish(spark):
    good = '{"executive_summary": "s"}'
    rows = [("2024-01-01", "L", 1, good, None), ("2024-01-01", "L", 2, None, "E: no"), ("2024-01-01", "L", 3, good, None),
            ("2024-01-02", "L", 1, None, "E: a"), ("2024-01-02", "L", 2, None, "E: b"),
            ("2024-01-03", "L", 0, None, "E: single")]
    got, _ = _merge(spark, rows, 8000)
    assert got["2024-01-01"].warning == "1 part(s) of the day failed: E: no" and got["2024-01-01"].error is None
    assert "2 item" in got["2024-01-01"].response
    assert got["2024-01-02"].response is None and got["2024-01-02"].error == "E: a; E: b"
    assert got["2024-01-03"].error == "E: single"
    parts = spark.createDataFrame([(k, "L", r.response, r.error, r.warning) for k, r in got.items()],
                                  "digest_date string, label string, response string, error string, warning string")
    d = D.parse_responses(parts).select("digest_date", "parse_error", D.status(
        F.col("executive_summary"), F.col("parse_error")).alias("s")).collect()
    assert {r.digest_date: r.s for r in d} == {"2024-01-01": "Partial", "2024-01-02": "Failed", "2024-01-03": "Failed"}


def test_answers_that_never_fit_fail_their_day(spark):
    long = "x" * 40000                       # 10,000 tokens: no two fit, so no merge can shrink the day
    rows = [("2024-01-01", "L", c, long, None) for c in (1, 2, 3)] + [("2024-01-02", "L", 1, "{}", None)]
    got, _ = _merge(spark, rows, 8000)
    assert got["2024-01-01"].response is None and got["2024-01-01"].error == I.NO_FIT
    assert got["2024-01-02"].error is None


def test_stream_rerun_is_noop(spark):
    out = scratch_path(spark, f"t-stream-{uuid.uuid4().hex[:8]}")
    path = R.ingest(spark, SF_SMALL, out, DEFAULT, publish_extractive)
    first = sorted(map(repr, spark.read.parquet(path).collect()))
    R.ingest(spark, SF_SMALL, out, DEFAULT, publish_extractive)        # same checkpoint: nothing new
    assert sorted(map(repr, spark.read.parquet(path).collect())) == first
    batch = newsletters(spark, SF_SMALL).groupBy("digest_date", "label").count().collect()
    assert sorted((r.digest_date, r.label, r["count"]) for r in batch) == sorted(
        (r.digest_date, r.label, r.newsletter_count) for r in spark.read.parquet(path).collect())


def _message_batches(spark, out, batches):
    """A stream of the given batches of (id, day, position, subject): a file each, in order."""
    import datetime as dt
    import time
    schema = ("message_id long, digest_date date, list_pos long, sender string, subject string, body string, "
              "date string, ts timestamp")
    for k, rows in enumerate(batches):
        full = [(i, d, pos, "s", subject, "body " * 20 + str(i), "", dt.datetime(d.year, d.month, d.day, 9))
                for i, d, pos, subject in rows]
        spark.createDataFrame(full, schema).coalesce(1).write.mode("append").parquet(f"{out}/in{k}")
        time.sleep(1.1)              # files are taken in order of their times
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{out}/in*")


def test_late_messages_change_the_selection(spark):
    import datetime as dt
    out = scratch_path(spark, f"t-late-{uuid.uuid4().hex[:8]}")
    one, two = dt.date(2024, 1, 1), dt.date(2024, 1, 2)
    p = DEFAULT.with_(max_messages=3)
    batches = [[(1, one, 10, "a"), (2, one, 20, "b"), (3, one, 30, "c"), (9, two, 1, "z")],
               [(4, one, 15, "d"), (5, one, 40, "e")], [(6, one, 5, "A"), (1, one, 10, "a")]]
    labels = spark.createDataFrame([(i, "L") for i in range(1, 10)], "message_id long, label string")
    published = []

    def publish(kept):
        published.append(sorted((str(r.digest_date), r.message_id) for r in kept.collect()))
        return kept.select("digest_date", "label", "message_id")

    path = R.ingest_messages(_message_batches(spark, out, batches).drop("ts"), labels, out, p, publish)
    days = ("2024-01-01", "2024-01-02")
    assert published == [[(days[0], 1), (days[0], 2), (days[0], 3), (days[1], 9)],
                         [(days[0], 1), (days[0], 2), (days[0], 4)],          # the second day is left alone
                         [(days[0], 4), (days[0], 6)]]                        # best are 6, 1, 4; "A" and "a" are one subject
    got = sorted((str(r.digest_date), r.message_id) for r in spark.read.parquet(path).collect())
    assert got == [(days[0], 4), (days[0], 6), (days[1], 9)]
    # a batch that runs again after a failure gives the same version
    stored = spark.read.schema("message_id long, list_pos long, sender string, subject string, body string, date string, "
                               "batch_id int, digest_date date").parquet(f"{out}/messages").where("batch_id = 1").drop("batch_id")
    again = R.merge_selection(stored, labels, f"{out}/selection", 1, p)
    assert sorted(r.message_id for r in again.collect()) == [1, 2, 4]


def test_stream_dedup_keeps_the_first_by_position(spark):
    import datetime as dt
    out = scratch_path(spark, f"t-dedup-{uuid.uuid4().hex[:8]}")
    one, two = dt.date(2024, 1, 1), dt.date(2024, 1, 2)
    batches = [[(1, one, 10, "a"), (2, one, 20, "A ")], [(3, one, 5, "a"), (4, two, 7, "a")], [(5, one, 9, "a"), (6, two, 3, "b")]]
    labels = spark.createDataFrame([(i, "L") for i in range(1, 10)], "message_id long, label string")
    path = R.dedup_messages(_message_batches(spark, out, batches), labels, out, "10 days")
    got = {(str(r.digest_date), r.key): r.message_id for r in R.survivors(spark, path).collect()}
    assert got == {("2024-01-01", "a"): 3, ("2024-01-02", "a"): 4, ("2024-01-02", "b"): 6}


def test_many_ids_are_fetched_through_a_bitmap(spark):
    """Beyond the byte bound: the same rows, and only likely bodies reach the shuffle."""
    from pyspark.sql import functions as F

    from quire.operators import common as OC
    from quire.operators import select as S
    bodies = spark.range(40000).select(F.col("id").alias("message_id"), F.concat(F.lit("b"), "id").alias("body"))
    keys = spark.range(0, 80000, 40).select(F.col("id").alias("message_id"), F.lit("L").alias("label"),
                                            F.to_date(F.lit("2024-01-01")).alias("digest_date"))
    ok, failed = S.fetch_bodies(keys, bodies, max_bytes=1 << 14)
    assert {r.message_id for r in ok.collect()} == set(range(0, 40000, 40))
    assert {r.message_id for r in failed.collect()} == set(range(40000, 80000, 40))
    likely = OC.likely_in(bodies, OC.persist(keys), "message_id")
    assert likely.columns == bodies.columns and 1000 <= likely.count() <= 1000 + 40000 // 8
    assert OC.likely_in(bodies, keys, "message_id", max_bytes=100).count() == 40000
    plan = ok._jdf.queryExecution().optimizedPlan().toString()
    assert "bitmap_construct_agg" in plan.lower() or "BitmapConstructAgg" in plan


def _documents(spark, path, files, first=0, n=40):
    """A documents table of ``files`` files, and its labels; every third subject comes twice a day."""
    from pyspark.sql import functions as F
    docs = spark.range(first, first + n, 1, max(files, 1)).select(
        F.col("id").alias("doc_id"), F.concat(F.lit("subject "), F.col("id") % 13, F.lit("\nbody")).alias("text"),
        F.lit("s").alias("source"))
    docs.write.parquet(f"{path}/documents.parquet")
    docs.select("doc_id", F.lit(1).alias("quality"), F.lit(0).alias("toxic")).write.parquet(f"{path}/labels.parquet")


def test_stream_dedup_reads_a_table_of_many_files(spark):
    """A documents table that is a folder of files, and one without rows."""
    import glob
    import os
    path, empty = (scratch_path(spark, f"t-folder-{uuid.uuid4().hex[:8]}") for _ in range(2))
    _documents(spark, path, 3)
    got = sorted(r.message_id for r in R.dedup_stream(spark, path, f"{path}/out").collect())
    assert got == list(range(13))
    one = scratch_path(spark, f"t-file-{uuid.uuid4().hex[:8]}").removeprefix("file:")
    os.makedirs(one)
    for name in ("documents", "labels"):
        spark.read.parquet(f"{path}/{name}.parquet").coalesce(1).write.parquet(f"{one}/{name}")
        os.link(glob.glob(f"{one}/{name}/part-*")[0], f"{one}/{name}.parquet")
    assert sorted(r.message_id for r in R.dedup_stream(spark, one, f"{one}/out").collect()) == got
    _documents(spark, empty, 1, n=0)
    assert R.dedup_stream(spark, empty, f"{empty}/out").collect() == []


def test_a_worker_holds_few_prompts_at_a_time(spark):
    """In a session of any origin: model calls and message parsing get small Arrow batches, and the
    answers come out a call at a time."""
    from pyspark.sql import functions as F

    from quire.sources import mail as M
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    try:
        for use in (lambda df: I.infer(df, offline_model, partitions=1),
                    lambda df: M.parse_message(df.withColumnRenamed("prompt", "raw"))):
            spark.conf.set(key, "10000")
            use(spark.createDataFrame([("p",)], "prompt string"))
            assert 0 < int(spark.conf.get(key)) <= 256
            spark.conf.set(key, "0")                      # no limit at all
            use(spark.createDataFrame([("p",)], "prompt string"))
            assert 0 < int(spark.conf.get(key)) <= 256
            spark.conf.set(key, "64")                     # smaller ones stay
            use(spark.createDataFrame([("p",)], "prompt string"))
            assert spark.conf.get(key) == "64"
        asked = spark.range(0, 600, 1, 1).select("id", F.concat(F.lit("=== NEWSLETTER 1 === "), "id").alias("prompt"))
        got = I.infer(asked, offline_model, partitions=1).collect()
        assert sorted(r.id for r in got) == list(range(600)) and all("1 item" in r.response and r.error is None for r in got)
        assert all(r.prompt.endswith(f" {r.id}") for r in got)
    finally:
        spark.conf.set(key, before)


def test_stream_of_many_days_writes_few_files(spark):
    """Two batches over 120 days: messages, versions and pages are not a folder for each day."""
    import datetime as dt
    import glob
    out = scratch_path(spark, f"t-days-{uuid.uuid4().hex[:8]}")
    days = [dt.date(2024, 1, 1) + dt.timedelta(days=i) for i in range(120)]
    batches = [[(i, d, 10, "a") for i, d in enumerate(days)], [(1000 + i, d, 5, "b") for i, d in enumerate(days[::2])]]
    labels = spark.range(2000).selectExpr("id as message_id", "'L' as label")
    path = R.ingest_messages(_message_batches(spark, out, batches).drop("ts"), labels, out, DEFAULT,
                             lambda nl: nl.groupBy("digest_date", "label").count())
    assert {r.digest_date: r["count"] for r in spark.read.parquet(path).collect()} == {
        d: 2 - i % 2 for i, d in enumerate(days)}
    for name in ("messages", "selection", "published", "digest_pages"):
        files = glob.glob(f"{out.removeprefix('file:')}/{name}/**/*.parquet", recursive=True)
        assert 0 < len(files) < 60, (name, len(files))
