"""Groups of nearly equal texts against brute force."""

import random

from pyspark.sql import functions as F

from quire.operators import near


def plain_groups(rows, k=near.SHINGLE, percent=near.PERCENT):
    """For each (key, text), the texts of its group."""
    def runs(t):
        w = t.split()
        return {tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()
    sets = [runs(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if rows[i][0] == rows[j][0] and both * 100 >= percent * (len(sets[i]) + len(sets[j]) - both):
                root[find(i)] = find(j)
    groups = {}
    for i, r in enumerate(rows):
        groups.setdefault(find(i), []).append(r)
    return sorted(sorted(g) for g in groups.values())


def spark_groups(spark, rows, parts=4):
    df = spark.createDataFrame(rows, "key string, text string").repartition(parts)
    words = F.filter(F.split("text", " +"), lambda w: w != "")
    groups = {}
    for r in near.near_groups(df, ["key"], words).collect():
        groups.setdefault(r["near_id"], []).append((r["key"], r["text"]))
    return sorted(sorted(g) for g in groups.values())


def test_groups_as_brute_force(spark):
    rng = random.Random(5)
    rows = [("a", ""), ("a", "   "), ("b", ""), ("a", "one two"), ("a", "one  two"), ("b", "one two"), ("a", "x")]
    for g in range(25):
        text = [rng.choice("red blue green up down in out".split()) + str(rng.randrange(9)) for _ in range(rng.choice([3, 6, 20, 45]))]
        for _ in range(rng.randrange(1, 7)):           # each a change further from the one before
            rows.append((rng.choice("ab"), " ".join(text)))
            at = rng.choice([0, len(text) - 1, rng.randrange(len(text))])
            text = [*text[:at], f"new{rng.randrange(1000)}", *text[at + rng.randrange(2):]]
    want = plain_groups(rows)
    assert any(len({t for _, t in g}) > 2 for g in want) and spark_groups(spark, rows) == want


def test_a_shingle_of_a_third_of_the_texts(spark):
    common = "to read this in a browser follow the link"
    rows = [("a", f"{common} w{i} x{i} y{i} z{i} v{i} u{i}" if i % 3 == 0 else f"p{i} q{i} r{i} s{i} t{i} o{i} n{i}")
            for i in range(600)]
    rows += [("a", f"{r[1]} m") for r in rows[:30]]
    want = plain_groups(rows)
    assert sum(len(g) == 2 for g in want) > 5 and spark_groups(spark, rows) == want


def test_long_chain_and_no_rows(spark):
    links = [(i, i + 1) for i in range(200)] + [(1000, 2000 + i) for i in range(3000)]
    got = {r["id"]: r["root"] for r in near.connected(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(1, 201)}, **{2000 + i: 1000 for i in range(3000)}}
    assert near.near_groups(spark.createDataFrame([], "key string, text string"), ["key"], F.split("text", " ")).count() == 0
