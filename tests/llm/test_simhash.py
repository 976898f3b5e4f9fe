"""Fingerprints and components against brute force over all pairs."""

import random
import re

import pytest
import xxhash

from pyspark.sql import functions as F

from quotewright.llm import simhash
from quotewright.llm.simhash import near_duplicates, one_per_group


def reference_print(text):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not w:
        return 0
    grams = [" ".join(w[i : i + 4]) for i in range(len(w) - 3)] or [" ".join(w)]
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def components_of(rows):
    prints = [reference_print(t) for _, t in rows]
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 4 and group[i] != group[j]:
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    return prints, group


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(2)
    words = ["".join(rng.choices("abcdefgh", k=5)) for _ in range(400)]
    rows = [(1, None), (2, ""), (3, " \n"), (None, "one"), (5, "One"), (6, "one two three"), (None, None), (None, "lonely row without id")]
    base = [rng.choice(words) for _ in range(900)]
    for i in range(60):  # near copies, and copies of them
        own = list(base)
        for _ in range(i % 6):
            own[rng.randrange(len(own))] = rng.choice(words)
        rows.append((100 + i, " ".join(own)))
    rows += [(300 + i, " ".join(base)) for i in range(40)]
    rows += [(400 + i, " ".join(rng.choices(words, k=rng.randrange(1, 60)))) for i in range(100)]
    rows += [(600, "É Ünïcode\x0btext\x85here and more words"), (601, " ".join(words) * 300), (602, "same row"), (602, "same row"), (602, "other row of that id")]
    return rows


def test_components_and_fingerprints(frame, rows):
    prints, group = components_of(rows)
    least = {}
    for (i, _), g in zip(rows, group):
        if i is not None:
            least[g] = min(least.get(g, i), i)
    expected = sorted((str(i), format(p, "016x"), str(least.get(g))) for (i, _), p, g in zip(rows, prints, group))
    got = near_duplicates(frame([(*r, "en", "s") for r in rows])).collect()
    assert sorted((str(r.doc_id), r.fingerprint, str(r.component_id)) for r in got) == expected
    assert len({g for g in group}) < len(rows) - 60


def test_one_row_of_each_component_stays(frame, rows):
    docs = frame([(*r, "en", "s") for r in rows])
    _, group = components_of(rows)
    kept = one_per_group(docs)
    assert kept.columns == docs.columns
    kept = kept.collect()
    assert len(kept) == len(set(group))
    by_row = {(i, t): g for (i, t), g in zip(rows, group)}
    assert {by_row[r.doc_id, r.text] for r in kept} == set(group)
    for r in kept:
        ids = [i for (i, _), g in zip(rows, group) if g == by_row[r.doc_id, r.text] and i is not None]
        assert r.doc_id == (min(ids) if ids else None)


def test_empty_table(frame, rows):
    docs = frame([(*r, "en", "s") for r in rows[:2]]).limit(0)
    assert near_duplicates(docs).collect() == [] and one_per_group(docs).collect() == []


def test_deep_variants_share_a_key_within_the_distance(spark):
    """Pairs that differ by up to the distance share a key of some segment, in every way the
    bits may fall; and the deep way gives the components of the other."""
    rng = random.Random(6)
    for distance in (2, 4, 5):
        pairs = []
        for _ in range(700):
            a = rng.getrandbits(64)
            b = a
            for bit in rng.sample(range(64), rng.randrange(distance + 1)):
                b ^= 1 << bit
            pairs.append([x - (1 << 64) if x >> 63 else x for x in (a, b)])
        df = spark.createDataFrame(pairs, "a long, b long")
        shared = [
            F.arrays_overlap(*(simhash.deep_variants(F.col(c), low, high, distance) for c in "ab")) for low, high in simhash.segments(distance)
        ]
        assert df.where(F.array_contains(F.array(*shared), True)).count() == len(pairs)
        apart = spark.createDataFrame([(a, (a ^ rng.getrandbits(63))) for a, _ in pairs], "a long, b long")
        assert apart.where(F.array_contains(F.array(*shared), True)).count() < 40


def test_deep_way_gives_the_same_components(spark):
    rng = random.Random(7)
    prints = []
    for _ in range(30):
        a = rng.getrandbits(64)
        for _ in range(rng.randrange(1, 25)):  # chains of near prints, some out of reach
            prints += [a] * rng.randrange(1, 3)
            for bit in rng.sample(range(64), rng.randrange(1, 7)):
                a ^= 1 << bit
    prints = [x - (1 << 64) if x >> 63 else x for x in prints + [0, 1, (1 << 64) - 1]]
    df = spark.createDataFrame([(x,) for x in prints], "fp long")
    deep, flat = ({r.fp: r.root for r in simhash.linked(df, deep=n).collect()} for n in (0, 1 << 40))
    assert len(flat) == len(set(prints)) and len(set(flat.values())) < len(flat) - 50

    group = {x: x for x in prints}
    for a in group:
        for b in group:
            if ((a ^ b) & ((1 << 64) - 1)).bit_count() <= 4 and group[a] != group[b]:
                old, new = sorted((group[a], group[b]), reverse=True)
                group = {k: new if g == old else g for k, g in group.items()}
    assert deep == flat == group


def test_whole_operator_the_deep_way(frame, rows, monkeypatch):
    docs = frame([(*r, "en", "s") for r in rows])
    flat = sorted(map(str, near_duplicates(docs).collect()))
    monkeypatch.setattr(simhash.linked, "__defaults__", (4, 0))
    assert sorted(map(str, near_duplicates(docs).collect())) == flat
    assert near_duplicates(docs.limit(0)).collect() == []
