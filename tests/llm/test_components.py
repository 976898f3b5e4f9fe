"""Distributed union-find and links within buckets against plain union-find."""

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from quotewright.llm.components import _ENTRIES, bucket_components, carried_components, components, shared_keys


def roots_of(edges):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {x: find(x) for x in parent}


@pytest.mark.parametrize("kind", ["random", "chain", "star", "loops"])
def test_components(spark, kind):
    rng = random.Random(5)
    edges = {
        "random": [(rng.randrange(300), rng.randrange(300)) for _ in range(220)],
        "chain": [(i, i + 1) for i in rng.sample(range(200), 190)],
        "star": [(-7, i) for i in range(200)] + [(500, 501), (501, 499)],
        "loops": [(1, 1), (2, 2)],
    }[kind]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    expected = {k: v for k, v in roots_of([e for e in edges if e[0] != e[1]]).items()}
    assert got == expected


def test_bucket_components_lose_no_link(spark):
    """Nodes link when their values differ by at most 2; one bucket holds half of all
    members, whose heaviest node is linked to few of them."""
    rng = random.Random(8)
    nodes = rng.sample(range(3000), 240)
    index = [(n, rng.randrange(1, 4), sorted({0 if i % 2 else 1 + n // 40, 1 + n // 40})) for i, n in enumerate(nodes)]
    edges = {(a, b) for a, _, j in index for b, _, k in index if set(j) & set(k) and a < b and b - a <= 2}
    df = spark.createDataFrame(index, "node long, weight long, keys array<long>")
    got = bucket_components(df, lambda a, b: F.abs(a - b) <= 2, salt=16)
    assert {r.node: r.root for r in got.collect()} == roots_of(edges)


def test_carried_components_lose_no_link(spark):
    """Three indexes one after the other; nodes link when their values differ by at most 2."""
    rng = random.Random(12)
    nodes = rng.sample(range(3000), 260)
    rows = [(n, rng.randrange(1, 4), k, n // 40 if k else n % 2) for n in nodes for k in range(3)]
    edges = {(a, b) for a, _, i, j in rows for b, _, k, m in rows if (i, j) == (k, m) and a < b and b - a <= 2}
    df = spark.createDataFrame(rows, "node long, weight long, i int, key long")
    calls = []

    def prepare(live):
        calls.append(live.count())
        return lambda pairs: pairs.where("abs(a - b) <= 2"), live.withColumn("x", F.col("node"))

    indexes = (df.where(F.col("i") == k).select("node", "weight", "key") for k in range(3))
    got = carried_components(indexes, prepare, lambda a, b: F.abs(a[0] - b[0]) <= 2, spark, salt=16)
    assert {r.node: r.root for r in got.collect()} == roots_of(edges)
    assert len(calls) == 3
    nothing = carried_components([df.where("i = 5").select("node", "weight", "key")], prepare, lambda a, b: F.lit(True), spark)
    assert nothing.count() == 0 and len(calls) == 3


def test_shared_keys_are_those_of_two_nodes_or_more(spark):
    """Keys in three columns, one of them in every row, rows that come twice, extreme values."""
    rng = random.Random(21)
    ends = [-(1 << 63), (1 << 63) - 1, 0, -1]
    rows = [(rng.choice(ends) if i % 50 == 0 else rng.randrange(-900, 900), *(rng.choice([*ends, *range(2000)]) for _ in range(2)), 77) for i in range(1500)]
    rows += rows[:400] + [(5, 1 << 40, 1 << 41, 77)] * 3
    nodes = defaultdict(set)
    for node, *keys in rows:
        for k in keys:
            nodes[k].add(node)
    df = spark.createDataFrame(rows, "node long, a long, b long, c long").repartition(3)
    found = sorted(r.key for r in shared_keys(df).collect())
    assert found == sorted(k for k, v in nodes.items() if len(v) > 1)
    assert 1 << 40 not in found and len(found) > 100
    assert shared_keys(df.limit(0)).collect() == [] and _ENTRIES > 3 * len(rows)
    many = spark.range(1_000_000).select(F.col("id").alias("node"), F.floor(F.col("id") / 2 + 0.5).alias("key"))
    assert shared_keys(many).select(F.count("*"), F.min("key"), F.max("key"), F.countDistinct("key")).first() == (499_999, 1, 499_999, 499_999)


def test_entries_that_repeat_add_their_weights(spark):
    """The heaviest node of a bucket is that of the greatest sum."""
    rows = [(1, 3, 0), (2, 2, 0), (2, 2, 0), (3, 1, 0), (8, 9, 1), (8, 9, 1)]
    stars = []

    def prepare(live):
        def verify(pairs):
            stars.append(sorted((r.a, r.b) for r in pairs.collect()))
            return pairs

        return verify, None

    df = spark.createDataFrame(rows, "node long, weight long, key long")
    got = carried_components([df], prepare, lambda a, b: F.lit(True), spark)
    assert {r.node: r.root for r in got.collect()} == {1: 1, 2: 1, 3: 1}
    assert stars[0] == [(1, 2), (3, 2)]
