"""Batch model inference.

The model is a plug-in: a factory that gets the output token limit and returns
``fn(list[str]) -> list[str]``. It is built once per partition inside ``mapInArrow``
(clients do not serialise), and prompts go to it in small batches. A failed call becomes
an ``error`` value on its row instead of failing the job; task retries make calls
at-least-once, so callers persist responses (keyed by prompt hash) before use.

A busy model (``Busy``, a timeout or a lost connection) is asked again after a wait that
doubles up to a bound, with a random part so that tasks do not return together. Repeats are
limited per call and per task (``Params.busy_*``); beyond that the prompts are errors, and a
later run asks them again. ``partitions`` of ``infer`` bounds the calls in flight.
"""

from __future__ import annotations

import random
import time
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.operators.common import persist
from quire.operators.prompts import MERGE_TEMPLATE, PARTIAL_SEP, long_date
from quire.params import DEFAULT, Params
from quire.session import ship_package, small_batches

Model = Callable[[list[str]], list[str]]
ModelFactory = Callable[[int], Model]          # called with the output token limit

ANSWER_COLS = ["prompt_hash", "response", "error"]
NO_FIT = "partial answers do not fit a merge prompt within the token budget"


class Busy(Exception):
    """Raised by a model that refuses a call for now; ``after``: seconds it asks to wait."""

    def __init__(self, message: str = "the model is busy", after: float | None = None):
        super().__init__(message)
        self.after = after


class Patience:
    """Repeats calls to a busy model, within the limits of ``p`` for one task."""

    def __init__(self, p: Params = DEFAULT, sleep: Callable[[float], None] = time.sleep):
        self.p, self.sleep, self.left = p, sleep, p.busy_budget

    def call(self, fn: Callable[[], list[str]]) -> list[str]:
        for tries in range(self.p.busy_tries + 1):
            try:
                return fn()
            except (Busy, TimeoutError, ConnectionError) as e:
                if tries == self.p.busy_tries or self.left <= 0:
                    raise
                self.left -= 1
                wait = min(self.p.busy_wait * 2 ** tries, self.p.busy_wait_most) * random.uniform(0.5, 1)
                self.sleep(max(wait, getattr(e, "after", None) or 0))
        raise AssertionError("not reached")


def ask(model: Model, prompts: list[str], batch_size: int,
        patience: Patience | None = None) -> tuple[list[str | None], list[str | None]]:
    """(answers, errors) of the prompts, in batches. A busy model is asked again; a batch that
    fails is asked again prompt by prompt, so that one bad prompt costs no other its answer. A
    batch whose repeats were used up by a busy model is not taken apart."""
    patience = patience or Patience()

    def call(chunk: list[str]) -> list[str]:
        got = patience.call(lambda: model(chunk))
        if len(got) != len(chunk):
            raise ValueError(f"model returned {len(got)} answers for {len(chunk)} prompts")
        return got

    answers: list[str | None] = []
    errors: list[str | None] = []
    for i in range(0, len(prompts), batch_size):
        chunk = prompts[i:i + batch_size]
        try:
            answers += call(chunk)
            errors += [None] * len(chunk)
        except (Busy, TimeoutError, ConnectionError) as e:
            answers += [None] * len(chunk)
            errors += [f"{type(e).__name__}: {e}"] * len(chunk)
        except Exception as e:  # noqa: BLE001 - recorded per row, the job goes on
            for one in chunk:
                try:
                    if len(chunk) == 1:
                        raise e
                    answers += call([one])
                    errors.append(None)
                except Exception as alone:  # noqa: BLE001
                    answers.append(None)
                    errors.append(f"{type(alone).__name__}: {alone}")
    return answers, errors


def infer(prompts: DataFrame, factory: ModelFactory, p: Params = DEFAULT, batch_size: int = 8,
          partitions: int | None = None, prompt_col: str = "prompt") -> DataFrame:
    """prompts -> prompts + (prompt_hash, response, error), one model per partition.

    Model calls, not bytes, dominate this stage, and a few thousand prompts would
    otherwise sit in the few partitions AQE coalesces them into; so prompts are spread
    by hash over ``partitions`` (default: the cluster's default parallelism). A worker holds one
    Arrow batch of few rows, and of its prompts only those of one call as text."""
    ship_package(prompts.sparkSession)
    small_batches(prompts.sparkSession)
    df = prompts.withColumn("prompt_hash", F.sha2(F.col(prompt_col), 256))
    n = partitions or prompts.sparkSession.sparkContext.defaultParallelism
    if n and n > 1:
        df = df.repartition(n, "prompt_hash")
    schema = T.StructType(df.schema.fields + [T.StructField("response", T.StringType()),
                                              T.StructField("error", T.StringType())])
    limit = p.output_tokens

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, patience = factory(limit), Patience(p)
        for batch in batches:
            for i in range(0, batch.num_rows, batch_size):
                part = batch.slice(i, batch_size)
                asked = part.column(prompt_col)
                resp, err = ask(model, asked.to_pylist(), batch_size, patience)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(resp, asked.type), pa.array(err, asked.type)],
                    names=[*part.schema.names, "response", "error"])

    return df.mapInArrow(run, schema)


def stored_answers(done: DataFrame) -> DataFrame:
    """One good answer per prompt hash: failed calls do not count as done."""
    return (done.filter(F.col("error").isNull() & F.col("response").isNotNull())
                .groupBy("prompt_hash").agg(F.min("response").alias("response")))


def infer_new(prompts: DataFrame, done: DataFrame | None, factory: ModelFactory, p: Params = DEFAULT,
              **kw) -> DataFrame:
    """Only prompts without a good stored answer go to the model; ``fresh`` tells
    which rows are new calls."""
    if done is None:
        return infer(prompts, factory, p, **kw).withColumn("fresh", F.lit(True))
    asked = prompts.withColumn("prompt_hash", F.sha2(F.col("prompt"), 256)).join(
        stored_answers(done), "prompt_hash", "left")
    asked = persist(asked)                        # long prompts are selected, rendered and hashed once
    todo = asked.filter(F.col("response").isNull()).drop("prompt_hash", "response")
    new = infer(todo.select(prompts.columns), factory, p, **kw).withColumn("fresh", F.lit(True))
    old = asked.filter(F.col("response").isNotNull()).withColumns(
        {"error": F.lit(None).cast("string"), "fresh": F.lit(False)})
    return new.unionByName(old.select(*new.columns))


def fresh_answers(answered: DataFrame) -> DataFrame:
    """The rows of the answer store that a run adds: one per new call."""
    return answered.filter("fresh").select(*ANSWER_COLS)


def merge_partials(partials: DataFrame, keys: list[str], factory: ModelFactory, p: Params = DEFAULT,
                   done: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Reduce each day's partial answers to one (G7/I4): (final answers, new calls).

    Single-call days (one partial with chunk_id 0) pass through. Chunked days are
    merged by the model; unlike the reference the merge prompt is budget-checked:
    partials are packed greedily into merge calls within the budget, level by level,
    until each day has one answer. A failed call never disappears: a day that still has
    an answer gets the reasons as ``warning``, one without gets them as ``error``. So
    does a day whose answers are too long for a merge to bring them closer together.
    Stored answers (``done``) serve merge prompts too.
    """
    from quire.operators.chunking import chunk_assign   # greedy packing, reused

    level = partials.select(*keys, F.col("chunk_id").alias("part"), "response", "error")
    single = level.filter(F.col("part") == 0).select(*keys, "response", "error",
                                                     F.lit(None).cast("string").alias("warning"))
    level = persist(level.filter(F.col("part") != 0))
    failures = level.filter(F.col("error").isNotNull()).select(*keys, "error")
    level = level.filter(F.col("error").isNull()).drop("error")
    finished: list[DataFrame] = []
    calls: list[DataFrame] = []
    while True:
        # each partial answer counts at least one token, so chunks of answers are bounded
        items = level.select(*keys, F.col("part").alias("list_pos"), F.col("part").alias("message_id"),
                             F.col("response").alias("body"))
        groups = chunk_assign(items, p.with_(message_overhead=1), keys)
        g = level.join(groups.select(*keys, F.col("message_id").alias("part"), F.col("chunk_id").alias("grp")),
                       [*keys, "part"])
        sizes = g.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_parts"), F.max("grp").alias("n_groups"))
        stuck = persist(sizes.filter((F.col("n_groups") == F.col("n_parts")) & (F.col("n_parts") > 1)).select(*keys))
        g = g.join(stuck, keys, "left_anti")
        failures = failures.unionByName(stuck.withColumn("error", F.lit(NO_FIT)))
        merged_text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("part", "response"))),
                                               lambda x: x["response"]), PARTIAL_SEP)
        prompts = (g.groupBy(*keys, "grp").agg(merged_text.alias("__m"))
                    .withColumn("prompt", F.format_string(MERGE_TEMPLATE, long_date(F.col("digest_date")),
                                                          F.col("__m")))
                    .drop("__m"))
        answered = persist(infer_new(prompts, done, factory, p).select(*keys, F.col("grp").alias("part"),
                                                                       *ANSWER_COLS, "fresh"))
        calls.append(fresh_answers(answered))
        failures = failures.unionByName(answered.filter(F.col("error").isNotNull()).select(*keys, "error"))
        good = answered.filter(F.col("error").isNull()).select(*keys, "part", "response")
        groups_left = answered.groupBy(*keys).agg(F.max("part").alias("n"))
        finished.append(good.join(groups_left.filter("n = 1").select(*keys), keys, "left_semi").drop("part"))
        level = good.join(groups_left.filter("n > 1").select(*keys), keys, "left_semi")
        if not level.limit(1).count():
            break
        level = persist(level)
    merged = finished[0]
    for df in finished[1:]:
        merged = merged.unionByName(df)
    why = failures.groupBy(*keys).agg(F.array_join(F.array_sort(F.collect_set("error")), "; ").alias("reasons"),
                                      F.count(F.lit(1)).alias("n"))
    chunked = merged.join(why, keys, "full_outer").select(
        *keys, "response", F.when(F.col("response").isNull(), F.col("reasons")).alias("error"),
        F.when(F.col("response").isNotNull() & F.col("reasons").isNotNull(),
               F.format_string("%d part(s) of the day failed: %s", F.col("n"), F.col("reasons"))).alias("warning"))
    new = calls[0]
    for df in calls[1:]:
        new = new.unionByName(df)
    return single.unionByName(chunked), new
