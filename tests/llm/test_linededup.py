"""Line dedup against exact comparison of all lines."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quotewright.llm import linededup as L
from quotewright.llm.components import carried_components
from tests.llm.test_components import roots_of


def expected_texts(rows):
    place = {}
    for i, t in rows:
        for k, x in enumerate((t or "").split("\n")):
            if L.normal(x):
                place.setdefault(L.normal(x), []).append((i is None, i or 0, k))
    lines = sorted(place)
    sets = [L.shingles(x) for x in lines]
    links = [(i, j) for i in range(len(lines)) for j in range(i, len(lines)) if L.similarity(sets[i], sets[j]) >= 0.8]
    root = roots_of(links)
    first = {}
    for i, x in enumerate(lines):
        first[root[i]] = min([first.get(root[i], (2, 0, 0)), *place[x]])
    keep = set(first.values())
    out = []
    for i, t in rows:
        text = t
        if t is not None:
            text = "\n".join(x for k, x in enumerate(t.split("\n")) if not L.normal(x) or (i is None, i or 0, k) in keep)
        out.append((i, text))
    return out


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(6)
    words = ["".join(rng.choices("abcdefghij", k=6)) for _ in range(500)]

    def line(n):
        return " ".join(rng.choices(words, k=n))

    base = [line(30) for _ in range(6)]

    def edited(x):
        w = x.split()
        w[rng.randrange(len(w))] = rng.choice(words)
        return " ".join(w)

    rows = [(1, None), (2, ""), (3, "\n \n\t\n"), (4, "a"), (5, "A \n a\n\nab"), (6, "é\x85ü line\r\nsame line here\r\nsame  LINE here")]
    rows += [(10 + i, "\n".join([base[i % 6], edited(base[(i + 1) % 6]), line(8)])) for i in range(30)]
    rows += [(50, "\n".join(base * 40)), (51, "\n".join(["tie line of words", "Tie line  of words"]))]
    rows += [(60, "repeated row with a line"), (60, "repeated row with a line"), (61, "x" * 30_000 + "\n" + "x" * 29_999 + "y")]
    # lines of one id after the other of no id
    rows += [(None, base[0] + "\nonly here without an id")]
    return rows


def test_texts_and_counts(frame, rows):
    found = L.dedup_lines(frame([(*r, "en", "s") for r in rows])).collect()
    assert sorted((str(r.row.doc_id), str(r.clean)) for r in found) == sorted((str(i), str(t)) for i, t in expected_texts(rows))
    for r in found:
        lines = [x for x in (r.row.text or "").split("\n") if L.normal(x)]
        left = [x for x in (r.clean or "").split("\n") if L.normal(x)]
        assert r.n_lines == len(lines) and r.n_removed == len(lines) - len(left)


def test_empty_table_and_blank_texts(frame):
    docs = frame([(1, None, None, None), (2, "", None, None)])
    assert L.dedup_lines(docs.limit(0)).collect() == []
    assert sorted((r.row.doc_id, r.clean) for r in L.dedup_lines(docs).collect()) == [(1, None), (2, "")]


@pytest.mark.parametrize("least,most,edits", [(8, 16, 2), (16, 60, 3), (60, 400, 6)])
def test_bands_find_nearly_all_similar_lines(least, most, edits):
    """Of pairs at similarity 0.8 to 0.85, at most one in a hundred is missed. The shortest
    lines differ at an end, as any other edit takes them below."""
    rng = random.Random(9)
    pairs = []
    while len(pairs) < 1500:
        a = "".join(rng.choices("abcdefghijklmnop ", k=rng.randrange(least, most))).strip()
        b = list(a)
        for _ in range(rng.randrange(1, edits) if edits > 2 else 0):
            b[rng.randrange(len(b))] = rng.choice("qrstuv")
        b = "".join(b) + "z" * rng.randrange(3) * (edits < 6)
        if a and 0.8 <= L.similarity(L.shingles(a), L.shingles(b)) <= 0.85:
            pairs.append((a, b))
    x, y = (L.signatures([p[k] for p in pairs]) for k in (0, 1))
    assert (L.bands(x) == L.bands(y)).any(axis=1).mean() >= 0.99


def test_signature_of_a_line_is_its_own(monkeypatch):
    lines = ["a", "abcdefgh", "ab cd ef gh ij kl", "é" * 50, "xyzzy" * 1000, "\U0001f600 end", "".join(map(chr, range(500, 900)))]
    bins = L.signatures(lines)
    for i, x in enumerate(lines):
        assert (L.signatures([x])[0] == bins[i]).all()
    assert (bins != np.uint64(0xFFFFFFFFFFFFFFFF)).all()
    monkeypatch.setattr(L, "_AT_ONCE", 50)  # long lines in pieces
    assert (L.signatures(lines) == bins).all()


def test_parities_rule_out_no_similar_pair(spark):
    rng = random.Random(3)
    rows = []
    while len(rows) < 400:
        a = "".join(rng.choices("abcdef ", k=rng.randrange(8, 200))).strip() or "a"
        b = list(a)
        b[rng.randrange(len(b))] = rng.choice("qrstuv")
        b = "".join(b)
        rows.append((L.similarity(L.shingles(a), L.shingles(b)), L.parities(a), L.parities(b)))
    df = spark.createDataFrame(rows, "s double, a array<long>, b array<long>")
    cells = lambda c: [F.get(c, F.lit(i)) for i in range(1 + L.SKETCH_WORDS)]
    found = df.select("s", L.sketch_alike(cells("a"), cells("b")).alias("alike")).collect()
    assert all(r.alike for r in found if r.s >= 0.8) and not all(r.alike for r in found)


def test_odd_blanks_make_no_word(frame):
    rows = [(1, "\u00a0\n\x1c\n\u2003 \nword\n\u200b"), (2, "\x1fword")]
    found = {r.row.doc_id: (r.n_lines, r.n_removed) for r in L.dedup_lines(frame([(*r, "en", "s") for r in rows])).collect()}
    assert found == {1: (2, 0), 2: (1, 1)}


def test_no_short_link_is_lost_in_a_crowded_bucket(frame):
    """Lines of 8 to 30 characters, all in one bucket whose heaviest line is like none."""
    rng = random.Random(14)
    lines = {"a heavy line that no other one is like"}
    for _ in range(400):
        a = "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=rng.randrange(8, 31)))
        # at 12 characters, one more or less is a similarity of exactly 0.8 or just above
        lines |= {a, a + rng.choice("0123456789"), a[:12], a[:11], a[:16] + "#", a[:16]}
    lines = sorted(lines)
    sets = [L.shingles(x) for x in lines]
    near = [(i, j) for i in range(len(lines)) for j in range(i) if L.similarity(sets[i], sets[j]) >= 0.8]
    assert len(near) > 500
    docs = frame([(i, x, "en", "s") for i, x in enumerate(lines)]).withColumn("h", F.xxhash64("text"))
    seen = L.keep(L.occurrences(docs))
    weight = F.when(F.col("normal").startswith("a heavy"), 9).otherwise(1)
    index = seen.select(F.col("line").alias("node"), weight.alias("weight"), F.lit(0).cast("long").alias("key"))
    roots = carried_components([index, index], L.prepared(seen), L.sketch_alike, docs.sparkSession, salt=256)
    node = {r.normal: r.line for r in seen.select("normal", "line").collect()}
    assert {r.node: r.root for r in roots.collect()} == roots_of([(node[lines[i]], node[lines[j]]) for i, j in near])


def test_candidates_texts_are_fetched_once(frame, rows, monkeypatch):
    """All bands are one index: the texts of all lines are read once, not once a round."""
    fetched, line_texts = [], L.line_texts
    monkeypatch.setattr(L, "line_texts", lambda seen, wanted: fetched.append(1) or line_texts(seen, wanted))
    assert L.dedup_lines(frame([(*r, "en", "s") for r in rows])).count() == len(rows)
    assert len(fetched) == 1


def test_packed_similarity_is_that_of_the_sets():
    rng = random.Random(17)
    lines = ["a", "abcdefg", "abcdefgh", "abcdefghi", "aaaaaaaaaaaa", "é" * 20, "\0" * 9, "ab\0" * 5, "中文字符测试一二三四", "é中" * 9]
    for _ in range(150):
        a = "".join(rng.choices("abé\xff ", k=rng.randrange(8, 60)))
        at = rng.randrange(len(a))
        lines += [a, a[:at] + rng.choice("abz中") + a[at + 1 :]]
    assert sum(L._packed(x) is None for x in lines) < len(lines) / 3
    pairs = list(zip(lines, lines[1:])) + [(x, x) for x in lines]
    for x, y in pairs:
        a, b = L._packed(x), L._packed(y)
        if a is not None and b is not None:
            assert L._packed_similarity(a, b) == L.similarity(L.shingles(x), L.shingles(y))
    batch = pa.record_batch({c: list(range(len(pairs))) for c in ("a", "b", "ra", "rb")} | {"x": [x for x, _ in pairs], "y": [y for _, y in pairs]})
    kept = [i for b in L._similar(iter([batch])) for i in b.column("a").to_pylist()]
    assert kept == [i for i, (x, y) in enumerate(pairs) if L.similarity(L.shingles(x), L.shingles(y)) >= 0.8]


@pytest.mark.parametrize("size", [1, 2, 3, 5, 8])
def test_hashes_and_parities_of_many_lines_are_those_of_each(size):
    """Shingles' hashes by the plain polynomial; classes of different shingles by counting."""
    rng = random.Random(size)
    lines = ["a", "ab", "é\U0001f600", "x" * 300] + ["".join(rng.choices("abcdé中 ", k=rng.randrange(1, 90))) for _ in range(80)]
    ones = 0xFFFFFFFFFFFFFFFF
    h, count = L._hashes(lines, size)
    together = L.parities_of(lines, size)
    start = 0
    for x, n, own in zip(lines, count.tolist(), together.tolist()):
        expected = []
        padded = x + "\0" * (size - len(x))
        for i in range(len(padded) - size + 1):
            v = 0
            for c in padded[i : i + size]:
                v = v * 0x100000001B3 + ord(c) & ones
            v = (v ^ v >> 31) * 0x9E3779B97F4A7C15 & ones
            expected.append((v ^ v >> 29) * 0xBF58476D1CE4E5B9 & ones)
        assert h[start : start + n].tolist() == expected
        start += n
        odd = np.bincount([(v >> 40) % 1024 for v in set(expected)], minlength=1024) & 1
        assert own == [len(set(expected)), *np.packbits(odd.astype(np.uint8)).view(np.int64).tolist()] == L.parities(x, size)
    assert start == len(h)
