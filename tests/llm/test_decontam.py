"""Tiling against a direct greedy tiling, and whole queries on a fixture."""

import random

import numpy as np
import pytest

from quotewright.llm import decontam as D


def plain_tiles(item, text, least=5):
    """Greedy string tiling by its definition: mark a longest common run of unmarked
    tokens, as long as there is one of ``least``."""
    item, text, out = list(item), list(text), []
    while True:
        best = (0, 0, 0)
        for i in range(len(item)):
            for j in range(len(text)):
                n = 0
                while i + n < len(item) and j + n < len(text) and item[i + n] == text[j + n]:
                    n += 1
                best = max(best, (n, -i, -j))
        n, i, j = best[0], -best[1], -best[2]
        if n < least:
            return out
        item[i : i + n] = [("a", i, k) for k in range(n)]
        text[j : j + n] = [("b", j, k) for k in range(n)]
        out.append(n)


@pytest.mark.parametrize("alphabet", [3, 12, 200])
def test_tiles_as_long_as_the_greedy_ones(alphabet):
    rng = random.Random(alphabet)
    for _ in range(60):
        item = [rng.randrange(alphabet) for _ in range(rng.randrange(5, 45))]
        text = [rng.randrange(alphabet) for _ in range(rng.randrange(60))]
        cut = rng.randrange(len(item))
        text[3:3] = item[cut:] + [9999] + item[:cut]
        got, expected = D.tile(item, [text]), plain_tiles(item, text)
        assert all(n >= 5 for n in got) and sum(got) <= len(item)
        # where several runs are equally long, either may be marked first
        assert got[:1] == expected[:1] and abs(sum(got) - sum(expected)) <= 5


def test_windows_and_segments():
    t = np.arange(1, 12, dtype=np.uint64)
    assert len(D.windows(t)) == 7 and len(D.windows(t[:4])) == 0
    own = [t[k : k + 5].tolist() for k in range(7)]
    assert D._segments([2, 0, 6], [own[2], own[0], own[6]]) == [[1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11]]
    assert D._segments([0, 6], [own[0], own[6]]) == [own[0], own[6]]


def test_reordered_and_partial_passages(spark, frame):
    rng = random.Random(1)
    words = ["".join(rng.choices("abcdefghijkl", k=5)) for _ in range(900)]
    items = [" ".join(rng.sample(words, 24)) for _ in range(12)]
    bench = spark.createDataFrame([*enumerate(items), (90, None), (91, ""), (92, "only four small words"), (93, items[0])], "item_id long, text string")

    def noise(n):
        return " ".join(rng.choices(words, k=n))

    half = items[2].split()
    rows = [
        (1, f"{noise(40)} {items[0]}. {noise(40)}"),
        (2, f"{noise(10)}\n{items[1].upper()}!"),
        (3, " ".join(half[12:]) + f" {noise(9)} " + " ".join(half[:12])),  # the halves changed round
        (4, noise(300)),
        (5, " ".join(items[3].split()[:8]) + " " + noise(80)),  # a third of an item
        (6, None),
        (7, ""),
        (None, items[4]),
        (8, f"{noise(60_000)} {items[5]} {noise(2000)}"),
        (9, items[6]),
        (9, items[6]),
        (9, "another text of that id " + noise(30)),
        (10, (items[7] + " ") * 200),
        (11, "only four small words"),
    ]
    docs = frame([(*r, "en", "s") for r in rows])
    got = {(r.doc_id, r.item_id, r.covered, r.coverage) for r in D.contaminated(docs, bench).collect()}
    whole = {(i, k, 24, 1.0) for i, k in [(1, 0), (1, 93), (2, 1), (3, 2), (None, 4), (8, 5), (9, 6), (10, 7)]}
    assert got == whole | {(11, 92, 4, 1.0)}
    left = D.decontaminate(docs, bench)
    assert left.columns == docs.columns
    left = left.collect()
    assert sorted(str(r.doc_id) for r in left) == sorted(map(str, [4, 5, 6, 7, 9]))
    assert D.contaminated(docs, bench.limit(0)).collect() == []
    assert D.contaminated(docs.limit(0), bench).collect() == []
    assert len(D.decontaminate(docs, bench.limit(0)).collect()) == len(rows)


def test_bitmap_holds_exactly_the_seeds(spark):
    seeds = spark.range(0, 5000, 7).selectExpr("(id - 1000) * 104729 as seed")
    bits = np.unpackbits(D.bitmap(seeds, "seed", 1 << 16), bitorder="little")
    expected = {((i - 1000) * 104729) % (1 << 16) for i in range(0, 5000, 7)}
    assert set(np.flatnonzero(bits).tolist()) == expected


def test_items_without_an_id(spark, frame):
    """Passages with a NULL id, and two of one id, are each found on their own."""
    rng = random.Random(3)
    words = ["".join(rng.choices("abcdefghijkl", k=5)) for _ in range(400)]
    items = [" ".join(rng.sample(words, 20)) for _ in range(4)]
    bench = spark.createDataFrame([(None, items[0]), (None, items[1]), (7, items[2]), (7, items[3]), (None, None)], "item_id long, text string")
    docs = frame([(i, f"start {t} end", "en", "s") for i, t in enumerate([*items, "no item in this text"])] + [(None, items[0], "en", "s")])
    got = sorted(((r.doc_id, r.item_id, r.covered, r.coverage) for r in D.contaminated(docs, bench).collect()), key=str)
    assert got == sorted([(0, None, 20, 1.0), (1, None, 20, 1.0), (2, 7, 20, 1.0), (3, 7, 20, 1.0), (None, None, 20, 1.0)], key=str)
    assert [r.doc_id for r in D.decontaminate(docs, bench).collect()] == [4]


def test_items_of_few_tokens(spark, frame):
    """An item of one to four tokens is where all of them stand together, by brute force."""
    rng = random.Random(9)
    items = [[rng.choice("abcd") for _ in range(1 + i % 6)] for i in range(18)]
    bench = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(items)] + [(50, " . "), (51, "")], "item_id long, text string")
    texts = [[rng.choice("abcdefgh") for _ in range(rng.randrange(14))] for _ in range(60)]
    docs = frame([(i, ", ".join(t), "en", "s") for i, t in enumerate(texts)])
    got = {(r.doc_id, r.item_id): (r.covered, r.tiles) for r in D.contaminated(docs, bench).collect() if r.item_tokens < 5}
    holds = lambda t, x: any(t[k : k + len(x)] == x for k in range(len(t)))
    assert got == {(i, k): (len(x), 1) for i, t in enumerate(texts) for k, x in enumerate(items) if len(x) < 5 and holds(t, x)}
    assert got and len({k for _, k in got}) > 5
    bad = {i for i, _ in got}
    left = {r.doc_id for r in D.decontaminate(docs, bench.where("item_id < 5 and item_id % 6 < 4")).collect()}
    assert left == {i for i, t in enumerate(texts) if not any(holds(t, items[k]) for k in range(4))} and bad >= set(range(60)) - left
