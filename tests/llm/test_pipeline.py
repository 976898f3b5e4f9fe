"""The pipeline's stages, each on what the one before it kept, against brute force."""

import random
from collections import Counter

import pytest

import corpus_pipeline as P
from quotewright.session import keep
from tests.llm.test_linededup import expected_texts
from tests.llm.test_native import WORD, plain_targets
from tests.llm.test_simhash import components_of


@pytest.fixture(scope="module")
def folder(spark, frame, tmp_path_factory):
    rng = random.Random(21)
    words = ["".join(rng.choices("abcdefghijk", k=6)) for _ in range(1500)]
    bad = ["vilevile", "grimgrim", "nastyish"]

    def text(n):
        return "\n".join(" ".join(rng.choices(words, k=12)) for _ in range(n))

    items = [" ".join(rng.sample(words, 30)) for _ in range(5)]
    labels: list = []
    rows = [(None, None, None, None), (None, "a lonely row", None, None), (900, "", "en", "s1"), (901, "copy\nof", "en", "s1"), (901, "copy\nof", "en", "s1")]
    for i in range(260):
        t = text(rng.randrange(3, 9))
        if i % 5 == 0:
            t += " " + " ".join(rng.choices(bad, k=3))
        labels.append((i, 1, int(i % 5 == 0)))
        if i % 13 == 1:
            t += "\n" + items[i % 5]
        rows.append((i, t, rng.choice(["en", "de"]), rng.choice(["s1", "s1", "s1", "s2", "s3"])))
    rows += [(1000 + i, rows[20][1], "en", "s1") for i in range(12)]
    rows += [(1100 + i, rows[30][1].replace(rows[30][1].split()[4], "changed", 1), "en", "s2") for i in range(3)]
    path = str(tmp_path_factory.mktemp("given"))
    frame(rows).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame([*enumerate(items)], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path, rows, items


def test_stages(spark, folder, monkeypatch):
    path, rows, items = folder
    seen = []
    for name, stage in P.STAGES:
        docs = keep(stage(spark, seen[-1] if seen else spark.read.parquet(f"{path}/documents.parquet"), path))
        seen.append(docs)
    columns = spark.read.parquet(f"{path}/documents.parquet").columns
    assert [d.columns for d in seen[:-1]] == [columns] * 4
    kept, lines, unique, clean, mix = ([(r.doc_id, r.text) for r in d.collect()] for d in seen)

    toxic = {i for i, t, _, _ in rows if t and any(b in t for b in ("vilevile", "grimgrim", "nastyish"))}
    gone = Counter((i, t) for i, t, _, _ in rows) - Counter(kept)
    assert not Counter(kept) - Counter((i, t) for i, t, _, _ in rows)
    assert len({i for i, _ in gone} & toxic) >= 0.9 * len(toxic) and len({i for i, _ in gone} - toxic) <= 3

    assert Counter(lines) == Counter(expected_texts(kept))
    _, group = components_of(lines)
    assert len(unique) == len(set(group)) and not Counter(unique) - Counter(lines)
    leak = [(i, t) for i, t in unique if t and any(x in t for x in items)]
    assert leak and Counter(unique) - Counter(clean) == Counter(leak)

    size = Counter()
    for r in seen[3].collect():
        size[r.source] += len(WORD.findall(r.text or ""))
    taken = Counter()
    for r in seen[4].collect():
        taken[r.source] += r.mix_words
        assert len(WORD.findall(r.text)) == r.mix_words
    target = plain_targets(dict(size))
    longest = max(len(WORD.findall(t or "")) for _, t in clean)
    assert all(abs(taken[s] - target[s]) <= longest / 2 + 0.51 for s in size)


def test_stages_of_an_empty_table(spark, folder):
    path, _, _ = folder
    docs = spark.read.parquet(f"{path}/documents.parquet").limit(0)
    for _, stage in P.STAGES:
        docs = keep(stage(spark, docs, path))
        assert docs.count() == 0


def test_mixed_texts_are_whole(spark, folder):
    path, rows, _ = folder
    texts = {(i, t, None if t is None else len(t)) for i, t, _, _ in rows}
    mixed = P.mix_sources(spark, spark.read.parquet(f"{path}/documents.parquet"), path).collect()
    assert mixed and all((r.doc_id, r.text, r.n_chars) in texts for r in mixed)
