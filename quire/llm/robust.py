"""Quality rules by robust multivariate outliers.

Of every text five numbers are taken: its words, the characters in them, symbols, repeated
lines, and words inside repeated three-word windows. Logarithms of their ratios make a
vector; per language and source the minimum-covariance-determinant estimate of centre
and scatter is found, and vectors far from it in Mahalanobis distance are rejected.

The estimate has three starts, of medians and of drawn-in rows, and improves by concentration
steps: the ``SUBSET`` share of rows nearest to the present estimate gives the next centre
and covariance, until no determinant falls; the start of the smallest counts. Quantiles and
moments are group aggregates that are combined before any shuffle, so a source with a third of
all rows costs no more than others; one small row a group is joined back, by broadcast while
they have few bytes. Covariances are inverted by sweeps over arrays. A least spread for
each coordinate keeps constant statistics from making a scatter singular.

The cutoff is a group's own: the cube root makes squared distances nearly symmetric, and what
lies over the upper quartile of its group by more than ``FENCE`` interquartile ranges (the usual
outer fence) is rejected. The quartiles are those of rows within twice that fence as drawn from
the median and the lower quartile, so nearly half of a group's rows may be junk.

A group of fewer than ``LEAST_ROWS`` usable rows has the estimate of all usable rows of its
language, or of all; where even those are too few, nothing is rejected by distance.

Nulls: a null text has no words and fails the base rules; null languages and sources are
groups of their own. Repeated rows count as often as they come. An empty table gives no
rows. Further columns are ignored by ``judge`` and kept by ``keep_good``.
"""

from __future__ import annotations

from itertools import combinations_with_replacement

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.llm.common import let, materialise, small_side
from quire.operators.common import BROADCAST_MAX_BYTES, row_bytes

SPACE = r"[\x20\x09-\x0D]+"
NOT_SPACE = r"[^\x20\x09-\x0D]"
SYMBOLS = r"[#*$%&|<>]"

LEAST_WORDS = 50
SUBSET = 0.5
FALL = 1e-4                # of the logarithm of a determinant; less is no fall
LEAST_ROWS = 60
ACCURACY = 2000
FENCE = 3.0                # interquartile ranges over the upper quartile: the outer fence
LEAST_RANGE = 0.491        # interquartile range of the cube root of a chi-square of five degrees
COORDINATES = ("x0", "x1", "x2", "x3", "x4")
LEAST_SPREAD = (0.06, 0.25, 0.5, 0.5, 0.3)


def text_statistics(docs: DataFrame, keep: list[str]) -> DataFrame:
    """``keep`` and n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines."""
    body = F.coalesce(F.col("text"), F.lit(""))
    lines = F.filter(F.split(body, "\n"), lambda x: x.rlike(NOT_SPACE))
    rows = docs.select(
        *keep, F.regexp_count(body, F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        F.array_remove(F.split(body, SPACE), "").alias("__words"), lines.alias("__lines"))
    rows = rows.select(
        *keep, "n_symbols", F.size("__lines").cast("long").alias("n_lines"),
        (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long").alias("n_dup_lines"),
        F.size("__words").cast("long").alias("n_words"),
        F.char_length(F.array_join("__words", "")).cast("long").alias("word_chars"),
        window_hashes(F.col("__words")).alias("__windows"))
    return rows.withColumn("n_repeat_words", repeated_cover(F.col("__windows"))).drop("__windows")


def window_hashes(words: Column) -> Column:
    """A hash of each three-word window; empty where there are fewer words."""
    hashed = F.transform(words, lambda w, i: F.xxhash64(w, F.get(words, i + 1), F.get(words, i + 2)))
    return F.slice(hashed, 1, F.greatest(F.size(words) - 2, F.lit(0)))


def repeated_cover(windows: Column) -> Column:
    """How many words lie in windows that occur twice or more. Equal windows stand next to
    each other after a sort; the places of those are sorted back and their spans of three
    words added up without overlaps. Texts without a repeated window skip all of it."""
    def places(s: Column) -> Column:
        same = F.transform(s, lambda e, i: F.when(
            (F.get(s, i - 1)["h"] == e["h"]) | (F.get(s, i + 1)["h"] == e["h"]), e["p"]))
        return F.sort_array(F.filter(same, lambda p: p.isNotNull()))

    def cover(q: Column) -> Column:
        parts = F.transform(q, lambda p, i: F.least(F.lit(3), F.coalesce(F.get(q, i + 1) - p, F.lit(3))))
        return F.aggregate(parts, F.lit(0).cast("long"), lambda a, x: a + x)

    placed = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("p"))))
    return F.when(F.size(F.array_distinct(windows)) == F.size(windows), F.lit(0).cast("long")).otherwise(
        let(let(placed, places), cover))


def base_failed() -> Column:
    return (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def with_vectors(rows: DataFrame) -> DataFrame:
    """The transformed statistics; only for rows that pass the base rules."""
    n = F.col("n_words").cast("double")

    def share(part: str, of: Column) -> Column:
        return F.log1p(100 * F.col(part) / of)

    usable = ~F.col("base_failed")
    values = (F.log(F.col("word_chars") / n), share("n_symbols", n),
              share("n_dup_lines", F.col("n_lines").cast("double")), share("n_repeat_words", n), F.log(n))
    return rows.withColumns({c: F.when(usable, v) for c, v in zip(COORDINATES, values)})


LEVELS = ("source", "lang", "all")


def with_levels(rows: DataFrame) -> DataFrame:
    """A key for each level that a row belongs to."""
    return rows.withColumns({"source_key": F.to_json(F.struct(F.lit(0).alias("level"), "lang", "source")),
                             "lang_key": F.to_json(F.struct(F.lit(1).alias("level"), "lang")),
                             "all_key": F.lit("all")})


def groups_of(rows: DataFrame) -> DataFrame:
    """One row a language and source: ``grp``, the nearest level with ``LEAST_ROWS`` usable
    rows (null where none has), and ``counted``, the groups its rows are to be counted in:
    every level that it, or a smaller group of that language or of all, takes its estimate from."""
    keys = [f"{level}_key" for level in LEVELS]
    sources = materialise(rows.groupBy(*keys).agg(F.count_if(F.col("x0").isNotNull()).alias("n_source")), "robust-counts")
    found = sources
    for key, n in zip(keys[1:], ("n_lang", "n_all")):
        found = found.join(small_side(sources.groupBy(key).agg(F.sum("n_source").alias(n)), "robust-large"), key)
    grp = F.when(F.col("n_source") >= LEAST_ROWS, F.col("source_key")).when(
        F.col("n_lang") >= LEAST_ROWS, F.col("lang_key")).when(F.col("n_all") >= LEAST_ROWS, F.col("all_key"))
    found = materialise(found.withColumn("grp", grp), "robust-levels")
    used = small_side(found.where("grp is not null").select("grp").distinct(), "robust-used")
    for key in keys:
        found = found.join(used.select(F.col("grp").alias(key), F.lit(True).alias(f"{key}_used")), key, "left")
    counted = F.array_compact(F.array(*[F.when(F.col(f"{k}_used"), F.col(k)) for k in keys]))
    return found.select("source_key", "grp", counted.alias("counted"))


N = range(len(COORDINATES))
PAIRS = list(combinations_with_replacement(N, 2))


def moments(rows: DataFrame) -> DataFrame:
    """Means and mean products of each group's rows, by start."""
    return rows.groupBy("grp", "start").agg(
        *[F.avg(c).alias(f"m{i}") for i, c in enumerate(COORDINATES)],
        *[F.avg(F.col(COORDINATES[i]) * F.col(COORDINATES[j])).alias(f"s{i}{j}") for i, j in PAIRS])


def solved(got: DataFrame) -> DataFrame:
    """Centres, inverse covariances (``p``) and logarithms of the determinants from stored
    moments. One sweep a coordinate turns the matrix, an array, into its inverse; the pivots'
    product is the determinant."""
    n = len(N)

    def covariance(i: int, j: int) -> Column:
        c = F.col(f"s{min(i, j)}{max(i, j)}") - F.col(f"m{i}") * F.col(f"m{j}")
        return F.greatest(c, F.lit(0.0)) + LEAST_SPREAD[i] ** 2 if i == j else c

    floors = F.array(*[F.lit(x * x / 100) for x in LEAST_SPREAD])

    def sweep(state: Column, k: Column) -> Column:
        def at(i: Column, j: Column) -> Column:
            return F.get(state["a"], (i * n + j).cast("int"))
        pivot = F.greatest(at(k, k), F.get(floors, k))

        def new(t: Column) -> Column:
            i, j = F.floor(t / n), t % n
            return F.when((i == k) & (j == k), 1 / pivot).when(i == k, at(k, j) / pivot).when(
                j == k, -at(i, k) / pivot).otherwise(at(i, j) - at(i, k) * at(k, j) / pivot)
        return F.struct(F.transform(F.sequence(F.lit(0), F.lit(n * n - 1)), new).alias("a"),
                        (state["log_det"] + F.log(pivot)).alias("log_det"))

    start = F.struct(F.array(*[covariance(i, j) for i in N for j in N]).alias("a"), F.lit(0.0).alias("log_det"))
    swept = got.withColumn("__swept", F.aggregate(F.array(*[F.lit(k) for k in N]), start, sweep))
    return swept.select("grp", "start", *[f"m{i}" for i in N],
                        *[F.get("__swept.a", F.lit(i * n + j)).alias(f"p{i}{j}") for i, j in PAIRS],
                        F.col("__swept.log_det").alias("log_det"))


ESTIMATE = [*[f"m{i}" for i in N], *[f"p{i}{j}" for i, j in PAIRS]]


def distances(rows: DataFrame, estimate: DataFrame) -> DataFrame:
    """``rows`` with the squared Mahalanobis distance ``d2`` to their group's estimate, or to
    that of each start."""
    got = rows.join(estimate, "grp", "left")
    y = [F.col(c) - F.col(f"m{i}") for i, c in enumerate(COORDINATES)]
    parts = [F.col(f"p{i}{j}") * y[i] * y[j] * (1.0 if i == j else 2.0) for i, j in PAIRS]
    return got.withColumn("d2", F.greatest(sum(parts[1:], parts[0]), F.lit(0.0))).drop(*ESTIMATE, "log_det", "falls")


def quantile(column: str | Column, share: float) -> Column:
    return F.percentile_approx(column, share, F.lit(ACCURACY))


def stored(df: DataFrame, name: str) -> tuple[DataFrame, bool]:
    """``df`` written, and whether its bytes are few enough to broadcast what has its rows."""
    df = materialise(df, name)
    return df, row_bytes(df) <= BROADCAST_MAX_BYTES


def starts(rows: DataFrame) -> DataFrame:
    """Estimates to start from, three a group: medians with median deviations, and the moments
    of rows standardised by them and drawn in, on a sphere (signs) or by hyperbolic tangents."""
    centre = small_side(rows.groupBy("grp").agg(
        *[quantile(c, 0.5).alias(f"c{i}") for i, c in enumerate(COORDINATES)]), "robust-centre")
    off = rows.join(centre, "grp").select("grp", *[F.abs(F.col(c) - F.col(f"c{i}")).alias(f"a{i}")
                                                    for i, c in enumerate(COORDINATES)])
    spread = off.groupBy("grp").agg(*[F.greatest(1.4826 * quantile(f"a{i}", 0.5), F.lit(LEAST_SPREAD[i])).alias(f"a{i}")
                                      for i in N])
    first = small_side(centre.join(spread, "grp"), "robust-start")
    z = [(F.col(c) - F.col(f"c{i}")) / F.col(f"a{i}") for i, c in enumerate(COORDINATES)]
    length = F.sqrt(sum((x * x for x in z[1:]), z[0] * z[0]))

    def drawn(start: str, of) -> Column:
        return F.struct(F.lit(start).alias("start"), *[
            (F.col(f"c{i}") + F.col(f"a{i}") * of(z[i])).alias(c) for i, c in enumerate(COORDINATES)])

    kinds = F.array(drawn("signs", lambda x: F.when(length > 0, x / length).otherwise(F.lit(0.0))),
                    drawn("tanh", F.tanh))
    moved = solved(materialise(moments(rows.join(first, "grp").select("grp", F.inline(kinds))), "robust-drawn"))
    plain = first.select("grp", F.lit("medians").alias("start"), *[F.col(f"c{i}").alias(f"m{i}") for i in N], *[
        (1 / (F.col(f"a{i}") * F.col(f"a{i}")) if i == j else F.lit(0.0)).alias(f"p{i}{j}") for i, j in PAIRS])
    return moved.drop("log_det").unionByName(plain)


def concentrated(rows: DataFrame, estimate: DataFrame, small: bool) -> DataFrame:
    """Moments of the ``SUBSET`` share of each group and start nearest to ``estimate``."""
    def hint(df: DataFrame) -> DataFrame:
        return F.broadcast(df) if small else df
    far = distances(rows, hint(estimate)).where("start is not null")
    cut = far.groupBy("grp", "start").agg(quantile("d2", SUBSET).alias("__cut"))
    return moments(far.join(hint(cut), ["grp", "start"]).where(F.col("d2") <= F.col("__cut")))


def robust_estimate(rows: DataFrame) -> DataFrame:
    """One row a group: centre, inverse covariance, and ``fence2``, the squared distance beyond
    which rows are outliers. ``rows`` has grp and the coordinates, without nulls. Each start takes concentration steps until
    its determinant falls by less than ``FALL``, which it does: the least spreads bound it from
    below. The start of the smallest determinant counts; of equal ones the first by name."""
    keys = ["grp", "start"]
    estimate, small = stored(starts(rows), "robust-starts")
    best, step = None, 0
    while True:
        got = solved(materialise(concentrated(rows, estimate, small), f"robust-moments{step}"))
        if best is None:
            best = materialise(got.withColumn("falls", F.lit(True)), f"robust-step{step}")
        else:
            before = best.select(*keys, F.struct(*ESTIMATE, "log_det").alias("__old"))
            new = got.select(*keys, F.struct(*ESTIMATE, "log_det").alias("__new"))
            falls = F.coalesce(F.col("__new.log_det") < F.col("__old.log_det") - FALL, F.lit(False))
            both = before.join(new, keys, "left").withColumn("falls", falls)
            best = materialise(both.select(*keys, "falls", F.when(F.col("falls"), F.col("__new"))
                                           .otherwise(F.col("__old")).alias("__best"))
                               .select(*keys, "falls", "__best.*"), f"robust-step{step}")
        estimate, step = best.where("falls"), step + 1
        if estimate.isEmpty():
            break
    least = best.groupBy("grp").agg(F.min_by(F.struct(*ESTIMATE), F.struct("log_det", "start")).alias("__least"))
    least, small = stored(least.select("grp", "__least.*"), "robust-least")
    def hint(df: DataFrame) -> DataFrame:
        return F.broadcast(df) if small else df
    far = distances(rows, hint(least)).select("grp", F.cbrt("d2").alias("d"))
    middle = quartiles(far, 0.25, 0.5)
    lower_half = F.greatest(F.col("high") - F.col("low"), F.lit(LEAST_RANGE / 2))
    gates = middle.select("grp", (F.col("high") + 4 * FENCE * lower_half + lower_half).alias("gate"))
    inside = quartiles(far.join(hint(gates), "grp").where(F.col("d") <= F.col("gate")), 0.25, 0.75)
    fence = F.col("high") + FENCE * F.greatest(F.col("high") - F.col("low"), F.lit(LEAST_RANGE))
    return least.join(inside.select("grp", (fence * fence * fence).alias("fence2")), "grp")


def quartiles(rows: DataFrame, low: float, high: float) -> DataFrame:
    """Two quantiles of ``d`` in each group."""
    got = rows.groupBy("grp").agg(F.percentile_approx("d", [low, high], F.lit(ACCURACY)).alias("q"))
    return got.select("grp", F.get("q", F.lit(0)).alias("low"), F.get("q", F.lit(1)).alias("high"))


def judge(docs: DataFrame, keep: list[str]) -> DataFrame:
    """``keep``, the statistics, base_failed, distance2 (null without a verdict) and kept."""
    extra = [c for c in ("lang", "source") if c not in keep]
    rows = text_statistics(docs, [*keep, *extra]).withColumn("base_failed", base_failed())
    rows = materialise(with_vectors(rows), "robust-rows")
    rows = with_levels(rows)
    groups = small_side(groups_of(rows), "robust-groups")
    rows = rows.join(groups, "source_key", "left")
    usable = materialise(rows.where("x0 is not null").select(F.explode("counted").alias("grp"), *COORDINATES),
                         "robust-vectors")
    estimate = small_side(robust_estimate(usable), "robust-estimate")
    found = distances(rows, estimate)
    return (found.withColumn("distance2", F.when(~F.col("base_failed"), F.col("d2")))
            .withColumn("kept", ~F.col("base_failed") & F.coalesce(F.col("d2") <= F.col("fence2"), F.lit(True)))
            .select(*keep, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                    "base_failed", "distance2", "fence2", "kept"))
