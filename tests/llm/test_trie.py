import random
from collections import defaultdict
from hashlib import md5, sha256
from zlib import crc32

import pytest

from quotewright.llm.trie import chains, conversation_trie, subtree_sums

SCHEMA = "conv_id long, turn long, role string, text string, conv string, n string, at string, node string, depth string"


def rebuilt(rows, every=5, folds=9):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            r, x = role or "", text or ""
            own[c].append((turn is not None, turn or 0, md5(f"{len(r)}:{r}{x}".encode()).hexdigest(), r, x))
    own = {c: [t[3:] for t in sorted(turns)] for c, turns in own.items()}
    out = {}
    for c, turns in own.items():
        h = crc32(str(c).encode()) % folds
        base = c - (abs(c) % every) * (1 if c >= 0 else -1)
        out[c] = own.get(base, [])[:h] + turns[h:]
    return out


def brute(rows):
    convs = rebuilt(rows)
    members, ends = defaultdict(list), defaultdict(list)
    for c, turns in convs.items():
        ends[tuple(turns)].append(c)
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    children, leaves, saved = defaultdict(int), defaultdict(int), defaultdict(int)
    for path in members:
        if path:
            children[path[:-1]] += 1
    for path, m in members.items():
        mine = (len(m) - 1) * len(path[-1][1].encode()) if path else 0
        for d in range(len(path) + 1):
            leaves[path[:d]] += not children[path]
            saved[path[:d]] += mine
    return sorted(
        (min(m), len(p), min(members[p[:-1]]) if p else -1, len(m), children[p], leaves[p], saved[p],
         sha256(",".join(map(str, sorted(ends[p]))).encode()).hexdigest())
        for p, m in members.items()
    )


def found(df):
    return sorted((r.conv_id, r.depth, -1 if r.parent_conv_id is None else r.parent_conv_id, *r[3:]) for r in df.collect())


def frame(spark, rows, parts=5):
    return spark.createDataFrame([(*r, *["x"] * 5) for r in rows], SCHEMA).repartition(parts)


def made(seed, n=120):
    r = random.Random(seed)
    rows = []
    for c in r.sample(range(-30, 200), n):
        for t in range(r.randrange(0, 14)):
            text = r.choice(["a", "b", "", None, "é", "long " * 5]) if r.random() < 0.7 else "same"
            rows.append((c, r.choice([t, t, None, 3]), r.choice(["user", "user", None, "assistant"]), text))
    return rows + rows[: len(rows) // 10]


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("block", [1, 4])
def test_random_conversations(spark, seed, block):
    rows = made(seed)
    assert found(conversation_trie(frame(spark, rows), block=block)) == brute(rows)


def test_copies_common_turns_and_null_ids(spark):
    rows = [(c, t, "user", f"turn {t}") for c in range(400) for t in range(6)]
    rows += [(1000 + c, t, "user", "turn 0" if t == 0 else f"own {c} {t}") for c in range(40) for t in range(3)]
    rows += [(None, 0, "user", "nobody"), (None, None, None, None)]
    assert found(conversation_trie(frame(spark, rows))) == brute(rows)
    assert conversation_trie(frame(spark, [])).count() == 0
    assert conversation_trie(frame(spark, rows[-2:])).count() == 0


def test_one_conversation_of_many_ranges(spark):
    rows = [(10, t, "user", f"turn {t % 7}") for t in range(700)] + [(11, t, "user", f"turn {t % 7}") for t in range(500)]
    rows += [(12, None, "user", "same")] * 300 + [(c, 0, "user", "short") for c in range(20, 40)]
    df = frame(spark, rows, 8)
    got = chains(df).groupBy("conv").agg({"at": "max", "*": "count"}).collect()
    assert {r.conv: (r["max(at)"], r["count(1)"]) for r in got if r.conv < 13} == {10: (700,) * 2, 11: (500,) * 2, 12: (300,) * 2}
    assert len([1 for r in chains(df).where("conv = 10").select("at").distinct().collect()]) == 700
    r = {x.conv_id: x for x in conversation_trie(df).where("n_children = 0").collect()}
    want = {t[0]: t for t in brute_leaves(rows)}
    assert {c: (x.depth, x.n_convs, x.saved_tokens) for c, x in r.items()} == {c: t[1:] for c, t in want.items()}


def brute_leaves(rows):
    convs = {c: tuple(t) for c, t in rebuilt(rows).items()}
    for path in set(convs.values()):
        if not any(o[: len(path)] == path and o != path for o in convs.values()):
            m = [c for c, t in convs.items() if t == path]
            yield min(m), len(path), len(m), (len(m) - 1) * len(path[-1][1].encode())


def test_subtree_sums_of_a_chain(spark):
    rows = [(i, i - 1 if i else None, i) for i in range(37)]
    nodes = spark.createDataFrame(rows, "node long, up long, x long")
    assert {r.node: r.x for r in subtree_sums(nodes, "x").collect()} == {i: sum(range(i, 37)) for i in range(37)}
