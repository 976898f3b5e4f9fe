"""Quality rules, URL filter and mixing against SQL and brute force."""

import math
import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from quotewright.llm import mixing, urls
from quotewright.llm.oracle import SQL
from quotewright.llm.quality import quality
from quotewright.llm.queries import QUERIES
from tests.oracle_check import connect, differences

WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.mark.parametrize("name", list(SQL))
def test_query_equals_sql(spark, sf, name):
    assert differences(spark, connect(sf), sf, QUERIES[name], SQL[name]) == ""


def test_no_python_on_the_native_paths(spark, sf):
    for name in ("op2_mix_sources", "op4_url_filter", "op5_quality_rules"):
        plan = QUERIES[name](spark, sf)._jdf.queryExecution().executedPlan().toString()
        assert not re.search("Python|Arrow|Pandas|Cartesian|BroadcastNestedLoop", plan)


# ---- quality


def plain_quality(rows, most):
    lines = [[" ".join(WORD.findall(x)).lower() for x in (t or "").split("\n") if WORD.search(x)] for _, t, _, _ in rows]
    held = defaultdict(int)
    for (_, _, _, host), own in zip(rows, lines):
        for x in set(own):
            held[host, x] += 1
    out = []
    for (i, t, _, host), own in zip(rows, lines):
        t = t or ""
        w = WORD.findall(t)
        grams = Counter(zip(w, w[1:], w[2:]))
        repeat = {k + j for k in range(len(w) - 2) if grams[w[k], w[k + 1], w[k + 2]] > 1 for j in range(3)}
        raw = [x for x in t.split("\n") if WORD.search(x)]
        gone = sum(len(x.split(" ")) for x in own if held[host, x] > most)
        failed = len(w) < 50 or 100 * len(repeat) > 50 * len(w)
        symbols = sum(t.count(c) for c in "#*$%&|<>")
        out.append((i, len(w), sum(map(len, w)), symbols, len(raw) - len(set(raw)), len(repeat), failed, not failed and 2 * gone <= len(w), gone))
    return out


def test_quality_of_every_row(frame):
    rng = random.Random(3)
    words = ["".join(rng.choices("abcdefé#|", k=4)) for _ in range(600)]

    def text(n, m=7):
        return "\n".join(" ".join(rng.choices(words, k=m)) for _ in range(n))

    menu = "\n".join(text(1, 9) for _ in range(5))
    rows = [(None, None, None, None), (1, "", "en", "a"), (2, " \n\t ", "en", "a"), (3, "a b\x0bc " * 40, "en", "a"), (3, "a b\x0bc " * 40, "en", "a")]
    rows += [(10 + i, f"{menu}\n{text(8 if i % 2 else 2)}", "en", "a" if i < 30 else None) for i in range(50)]
    rows += [(70 + i, f"{menu}\n{text(4)}", "en", "b") for i in range(3)]
    rows += [(80 + i, "All  Rights\treserved\n" + text(12), "en", "a") for i in range(20)]
    rows += [(120, text(4000), "en", "c"), (121, (text(3) + "\n") * 60, "en", "c"), (122, "x " * 20_000, "en", "c"), (123, "Ü\x85ü " * 60, "en", "c")]
    got = quality(frame(rows), most_documents=15).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, plain_quality(rows, 15)))
    assert len({r.kept for r in got}) == 2 and any(not r.kept and not r.base_failed for r in got)
    assert quality(frame(rows).limit(0)).collect() == []


# ---- URLs


def test_hosts_paths_and_rules(spark):
    cases = {
        "http://WWW.Example.COM/en/x?q": ("www.example.com", "/en/x", "www.example.com/en/"),
        "http://example.com/en/": ("example.com", "/en/", "example.com/en/"),
        "https://a.example.com/en": ("a.example.com", "/en", "com/"),
        "x://com/": ("com", "/", "com/"),
        "x://com": ("com", "", None),
        "x://telecom/": ("telecom", "/", None),
        "x://b.net/fr/a#f": ("b.net", "/fr/a", "net/fr/"),
        "x://b.net/FR/": ("b.net", "/FR/", None),
        "a?u=http://c.com/p": ("c.com", "/p", "com/"),
        "http://e.org?/en/": ("e.org", "", None),
        "no scheme": ("", "", None),
        "": ("", "", None),
        None: ("", "", None),
        "://": ("", "", None),
        "http://é.com/ü\n/": ("é.com", "/ü\n/", "com/"),
    }
    df = spark.createDataFrame([(i, u, "x", "y") for i, u in enumerate([*cases, "x://com"])], "page_id long, url string, label string, bin string")
    got = {r.page_id: r for r in urls.judge(df).collect()}
    assert len(got) == len(cases) + 1
    for i, u in enumerate([*cases, "x://com"]):
        assert (got[i].host, got[i].path, got[i].rule) == cases[u]
        assert got[i].verdict == {"net/fr/": "block", "example.com/en/": "block"}.get(got[i].rule, "allow" if got[i].rule else got[i].verdict)
    assert urls.judge(df.limit(0)).collect() == []
    # without labelled URLs of both kinds there is nothing to tell them by
    assert {r.verdict for r in urls.judge(df.where("page_id in (3, 4, 5, 12)")).collect()} == {"allow"}


def test_the_model_tells_kinds_of_urls_apart(spark):
    rng = random.Random(7)

    def word(letters):
        return "".join(rng.choices(letters, k=8))

    rows = []
    for i in range(900):
        good = i % 2 == 0
        end = rng.choice([".com/" if good else ".net/fr/", ".org/", ".org/"])
        rows.append((i, f"http://{word('abcd' if good else 'wxyz')}{end}{word('efgh' if good else 'stuv')}"))
    rows += [(None, None), (2000, "http://" + "wxyz" * 4000 + ".org/"), (5, rows[5][1])]
    found = urls.judge(spark.createDataFrame(rows, "page_id long, url string")).collect()
    assert len(found) == len(rows)
    free = [r for r in found if r.rule is None and r.page_id is not None and r.page_id < 900]
    right = [(r.verdict == "allow") == (r.page_id % 2 == 0) for r in free]
    assert len(free) > 400 and sum(right) / len(right) > 0.98
    assert next(r for r in found if r.page_id == 2000).verdict == "block"


# ---- mixing


def plain_targets(sizes):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    target = {s: 0.0 for s in order}
    left, free = 1.5 * sum(sizes.values()), list(order)
    while left > 1e-9 and free:
        total = sum(weight[s] for s in free)
        for s in free:
            target[s] += left * weight[s] / total
        left = sum(max(0.0, target[s] - 2 * sizes[s]) for s in free)
        for s in free:
            target[s] = min(target[s], 2.0 * sizes[s])
        free = [s for s in free if target[s] < 2 * sizes[s]]
    return target


@pytest.fixture(scope="module")
def mixed():
    rng = random.Random(11)
    rows = [(None, None, "en", None), (1, "", "en", "b"), (2, " \n", "en", "z"), (3, "one two", "en", None), (4, "a " * 30_000, "en", "big"), (5, "tie x", "en", "ä"), (5, "tie x", "en", "ä")]
    for i in range(900):
        rows.append((10 + i, " ".join(["w"] * rng.randrange(120)), "en", rng.choice("aaaaaabBcd")))
    return rows


def test_taken_words_meet_the_targets(frame, mixed):
    docs = frame(mixed)
    got = mixing.mix_counts(docs).collect()
    size = defaultdict(int)
    for _, t, _, s in mixed:
        size[s] += len(WORD.findall(t or ""))
    target = plain_targets(size)
    source = {(i, len(WORD.findall(t or ""))): s for i, t, _, s in mixed}
    taken = Counter()
    assert len(got) == len(mixed)
    for r in got:
        s = source[r.doc_id, r.size]
        taken[s] += r.taken
        assert 0 <= r.taken <= 2 * r.size and r.source_size == size[s] and r.target == pytest.approx(target[s])
    # half of the longest document that the target may end in
    largest = {s: max(len(WORD.findall(t or "")) for _, t, _, x in mixed if x == s) for s in size}
    assert all(abs(taken[s] - target[s]) <= largest[s] / 2 + 0.51 for s in size)
    assert all(r.taken in (0, r.size, 2 * r.size) for r in got)
    again = mixing.mix_counts(docs.repartition(7)).collect()
    assert sorted(map(str, again)) == sorted(map(str, got))
    assert mixing.mix_counts(docs.limit(0)).collect() == []


def test_the_mix_itself(frame, mixed):
    docs = frame(mixed)
    counts = mixing.mix_counts(docs, shards=5).collect()
    rows = mixing.mix(docs, shards=5)
    order = [(r.part, r.mix_shard, r.mix_place) for r in rows.withColumn("part", F.spark_partition_id()).collect()]
    assert order == sorted(order) and len({p for p, _, _ in order}) == 20
    assert len({(p, s) for p, s, _ in order}) == 20
    texts = {(i, t) for i, t, _, _ in mixed}
    assert all((r.doc_id, r.text) in texts for r in rows.select("doc_id", "text").collect())
    assert rows.columns == [*docs.columns, "mix_shard", "mix_place", "mix_pass", "mix_words"]
    rows = rows.collect()
    assert all(len(WORD.findall(r.text)) == r.mix_words for r in rows)
    per_doc = Counter()
    for r in rows:
        per_doc[r.doc_id] += r.mix_words
    whole = Counter()
    for r in counts:
        whole[r.doc_id] += r.taken
    assert {k: v for k, v in per_doc.items() if v} == {k: v for k, v in whole.items() if v}
    assert {r.mix_shard for r in rows} == set(range(5))


def test_many_shards_spread_over_tasks(frame, mixed):
    rows = mixing.mix(frame(mixed), shards=64)
    tasks = rows.groupBy(F.spark_partition_id().alias("p")).agg(F.countDistinct("mix_shard").alias("n")).collect()
    assert len(tasks) >= 48 * mixing.PIECES * 0.8 and {r.n for r in tasks} == {1}


def test_mix_replaces_columns_of_its_own_names(frame, mixed):
    docs = frame(mixed)
    plain = sorted(map(str, mixing.mix(docs, shards=3).collect()))
    clashing = docs.withColumns({c: F.lit("x") for c in (*mixing.ADDED, "shard", "at", "pass", "doc", "takes", "place", "size")})
    again = mixing.mix(clashing, shards=3).drop("shard", "at", "pass", "doc", "takes", "place", "size").collect()
    assert len(again) == len(plain) and {r.mix_shard for r in again} == {0, 1, 2}
    assert mixing.mix(docs.limit(0)).collect() == []


def test_quotas_split_exactly(spark):
    quota = {1: 1000, 2: 17, 3: 0, 4: 260, 5: 1}
    df = spark.createDataFrame([*quota.items()], "rank int, quota long")
    for shards in (1, 2, 7, 16):
        ends = {r.rank: list(r.ends) for r in mixing.split_quotas(df, shards, seed=3).collect()}
        parts = {k: [b - a for a, b in zip([0, *e], e)] for k, e in ends.items()}
        assert all(sum(p) == quota[k] and min(p) >= 0 and len(p) == shards for k, p in parts.items())
        total = [sum(p[i] for p in parts.values()) for i in range(shards)]
        assert sum(total) == 1278 and max(total) - min(total) <= math.ceil(math.log2(max(2, shards)))


def test_a_draw_stands_once_in_the_plan(spark):
    """Terms that mention each other are named: with 16 shards the driver's plan stays small."""
    df = spark.createDataFrame([(1, 40), (2, 900)], "rank int, quota long")
    plan = mixing.split_quotas(df, 16, seed=3)._jdf.queryExecution().optimizedPlan().toString()
    assert len(plan) < 40_000


def test_hypergeometric_draws_follow_the_distribution(spark):
    total, good, drawn, n = 40, 13, 17, 20_000
    u = (F.col("id") + 0.5) / n
    got = spark.range(n).select(mixing.hypergeometric(F.lit(total), F.lit(good), F.lit(drawn), u).alias("k")).groupBy("k").count()
    got = {r.k: r["count"] / n for r in got.collect()}
    for k in range(14):
        p = math.comb(good, k) * math.comb(total - good, drawn - k) / math.comb(total, drawn)
        assert got.get(k, 0) == pytest.approx(p, abs=1.1 / n)
    for case in ((10, 0, 4), (10, 10, 4), (10, 4, 0), (10, 4, 10), (1, 1, 1), (0, 0, 0)):
        r = spark.range(1).select(mixing.hypergeometric(*map(F.lit, case), F.lit(0.37)).alias("k")).first()
        assert r.k == {(10, 10, 4): 4, (10, 4, 10): 4, (1, 1, 1): 1}.get(case, 0)
