"""Language and toxicity models: held-out accuracy and odd rows."""

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from quotewright.llm import langid, toxicity
from quotewright.llm.arrow import bucket_of

ODD = [None, "", " \n", "123 !!", "é", "ok", "x" * 50_000, "wort " * 30_000]


@pytest.fixture(scope="module")
def given(spark):
    folder = "/root/testdata/sf0.01"
    return spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")


def test_language_of_held_out_texts(given):
    docs, _ = given
    learn = bucket_of(F.col("doc_id"), 3) != 1
    model = langid.fit(docs, learn, per_language=60)
    found = langid.predict(docs, model).join(docs.select("doc_id", "lang"), "doc_id").where(~learn).collect()
    right = np.mean([r.lang == r.lang_pred for r in found])
    assert len(found) > 250 and right >= 0.97
    assert all(0 <= r.score <= 1 for r in found) and np.mean([r.accepted for r in found]) > 0.9
    # the same text gets the same answer whatever its other columns
    swapped = langid.predict(docs.withColumn("lang", F.lit("xx")), model).collect()
    assert {(r.doc_id, r.lang_pred, r.score) for r in found} <= {(r.doc_id, r.lang_pred, r.score) for r in swapped}


def test_language_of_odd_rows(frame, given):
    docs, _ = given
    model = langid.fit(docs, F.lit(True), per_language=40)
    rows = frame([(i or None, t, "en", "s") for i, t in enumerate([*ODD, "ok"])])
    found = langid.predict(rows, model).collect()
    by_id = {r.doc_id: r for r in found}
    assert len(found) == len(ODD) + 1 and by_id[None].lang_pred == "und"
    for i, t in enumerate(ODD):
        r = by_id[i or None]
        assert (r.lang_pred == "und") == (t is None or not any(map(str.isalpha, t)))
        assert r.lang_pred != "und" or (r.score == 0 and not r.accepted)
    assert by_id[ODD.index("ok")].score == by_id[len(ODD)].score
    untaught = langid.fit(rows.where("false"), F.lit(True))
    assert {(r.lang_pred, r.score) for r in langid.predict(rows, untaught).collect()} == {("und", 0.0)}
    assert langid.predict(rows.limit(0), model).collect() == []


def test_grams_of_slices_are_those_of_the_text(monkeypatch):
    text = "Some words, ünd mehr; " * 40
    whole = sorted(np.concatenate(list(langid.grams(text, 1 << 12))).tolist())
    monkeypatch.setattr(langid, "_SLICE", 64)
    assert sorted(np.concatenate(list(langid.grams(text, 1 << 12))).tolist()) == whole


def test_rejection_is_calibrated():
    rng = np.random.default_rng(3)
    sure = rng.random(4000)
    y = (rng.random(4000) > 0.5 + sure / 2).astype(int)  # class 0 with probability 0.5 to 1
    z = np.stack([np.log((0.5 + sure / 2) / (0.5 - sure / 2 + 1e-9)), np.zeros(4000)], axis=1)
    temperature, accept = langid.calibrate(3 * z, y, 0.9)
    assert 2 < temperature < 4.5
    p = langid._softmax(3 * z / temperature).max(axis=1)
    kept = p >= accept
    assert 0 < kept.mean() < 1 and (y[kept] == 0).mean() >= 0.9


@pytest.fixture(scope="module")
def toxic(spark):
    rng = random.Random(12)
    words = {k: ["".join(rng.choices(a, k=rng.randrange(3, 9))) for _ in range(900)] for k, a in (("en", "abcdefghi"), ("de", "klmnopqrs"))}
    bad = {"en": ["vilea", "vileb", "nasty", "grim"], "de": ["boesex", "boesey", "uebel", "schlimm"]}
    rows, labels = [], []
    for i in range(900):
        lang = rng.choice(["en", "de"])
        text = rng.choices(words[lang], k=rng.randrange(20, 300))
        y = int(rng.random() < 0.25)
        for _ in range(rng.randrange(1, 4) * y):
            text.insert(rng.randrange(len(text)), rng.choice(bad[lang]))
        rows.append((i, " ".join(text), lang, "s"))
        labels.append((i, y, f"x{i}"))
    return rows, labels


def test_toxicity_of_held_out_texts(spark, frame, toxic):
    rows, labels = toxic
    odd = [(2000 + i if i else None, t, None, "s") for i, t in enumerate(ODD)] + [(5, rows[5][1], "en", "s")]
    docs = frame(rows + odd)
    marked = spark.createDataFrame([*labels, (3000, 1, "no such document"), (3001, None, ""), (None, 1, "")], "doc_id long, toxic int, text string")
    learn = bucket_of(F.col("doc_id"), 4) != 2
    model = toxicity.fit(docs, marked, learn, per_label=400, buckets=1 << 14)
    found = toxicity.score(docs, model).select("row.doc_id", "row.text", "score", "rejected").collect()
    assert len(found) == len(rows) + len(odd)
    y = dict((i, t) for i, t, _ in labels)
    held = [r for r in found if r.doc_id in y and zlib.crc32(str(r.doc_id).encode()) % 4 == 2]
    assert len(held) > 150
    hit = [r.score >= 0.3 for r in held]
    truth = [y[r.doc_id] == 1 for r in held]
    assert np.mean([a == b for a, b in zip(hit, truth)]) > 0.93
    assert np.mean([r.rejected == t for r, t in zip(held, truth)]) > 0.93
    assert all(0 <= r.score <= 1 for r in found)
    blank = {r.score for r in found if not any(map(str.isalpha, r.text or ""))}
    assert len(blank) == 1 and blank.pop() < 0.3
    assert len({r.score for r in found if r.doc_id == 5}) == 1
    assert set(model.thresholds) == {"en", "de"}
    assert toxicity.score(docs.limit(0), model).collect() == []
    # labels of one class, or none at all, teach nothing
    for label, score in ((0, 0.0), (1, 1.0)):
        one = toxicity.fit(docs, marked.where(f"toxic = {label}"), learn, buckets=1 << 10)
        assert {round(r.score, 6) for r in toxicity.score(docs.limit(5), one).collect()} == {score}
    none = toxicity.fit(docs, marked.limit(0), learn, buckets=1 << 10)
    assert {round(r.score, 6) for r in toxicity.score(docs.limit(5), none).collect()} == {0.0}


def test_scoring_once_is_fitting_and_scoring(spark, frame, toxic):
    """``judged`` gives the rows, scores and verdicts of ``fit`` and ``score``."""
    rows, labels = toxic
    odd = [(2000 + i if i else None, t, [None, "en", "fr"][i % 3], "s") for i, t in enumerate(ODD)] + [(5, rows[5][1], "en", "s")] * 2
    docs = frame(rows + odd)
    marked = spark.createDataFrame(labels, "doc_id long, toxic int, text string")
    learn = bucket_of(F.col("doc_id"), 4) != 2
    settings = {"per_label": 200, "buckets": 1 << 12}
    expected = toxicity.score(docs, toxicity.fit(docs, marked, learn, **settings))
    found = toxicity.judged(docs, marked, learn, **settings)
    assert found.select("row.*").columns == docs.columns
    assert sorted(map(str, found.collect())) == sorted(map(str, expected.collect()))
    ids = toxicity.judged(docs, marked, learn, ["doc_id"], **settings)
    assert ids.select("row.*").columns == ["doc_id"]
    assert sorted(map(str, ids.select("row.doc_id", "score", "rejected").collect())) == sorted(
        map(str, expected.select("row.doc_id", "score", "rejected").collect())
    )
    for labelled, score in ((marked.limit(0), 0.0), (marked.where("toxic = 1"), 1.0)):
        flat = toxicity.judged(docs, labelled, learn, **settings).select("score", "rejected").distinct().collect()
        assert [(round(r.score, 6), r.rejected) for r in flat] == [(score, score > 0.5)]
    assert toxicity.judged(docs.limit(0), marked, learn, **settings).collect() == []


def test_bytes_of_a_sample_are_bounded(spark, frame, toxic):
    rows, labels = toxic
    huge = [(5000, "word " * 60_000, "en", "s")]
    docs = frame(rows + huge)
    marked = spark.createDataFrame([*labels, (5000, 1, "")], "doc_id long, toxic int, text string")
    size = {i: len(t) for i, t, *_ in rows + huge}
    for most in (20_000, 200_000, 64 << 20):
        data, _ = toxicity.sample_words(docs, marked, F.lit(True), 5000, {"buckets": 1 << 12, "stem": 5}, most)
        # words are three letters and a blank at least
        for label in (0, 1):
            words = sum(len(x) for x, y in zip(data.column("ids").to_pylist(), data.column("label").to_pylist()) if y == label)
            own = [size[i] for i, y, _ in [*labels, (5000, 1, "")] if y == label and size[i] * 20 <= most]
            assert 0 < words * 2 <= most
            assert sum(own) > most or data.column("label").to_pylist().count(label) == len(own)


def test_long_texts_score_in_slices_as_whole(monkeypatch):
    rng = np.random.default_rng(1)
    model = toxicity.ToxicityModel(
        rng.normal(size=(64, 8)).astype(np.float32),
        rng.normal(size=(64, 8)).astype(np.float32),
        [rng.normal(size=(w, 8, 4)).astype(np.float32) for w in (1, 2, 3)],
        [np.zeros(4, np.float32)] * 3,
        np.ones(12, np.float32),
        0.0,
        5,
    )
    ids = toxicity.Words(64, 5).of("some words that follow one another " * 60)
    whole = model.logit(ids)
    monkeypatch.setattr(toxicity, "_SLICE", 17)
    assert model.logit(ids) == pytest.approx(whole, rel=1e-5)


def test_thresholds():
    s, one = np.array([0.1, 0.2, 0.6, 0.7]), np.ones(4)
    assert toxicity.best_threshold(s, np.array([0, 0, 1, 1]), one) == 0.3
    assert toxicity.best_threshold(s, np.array([0, 1, 1, 1]), one) == 0.2
    assert toxicity.best_threshold(s, np.zeros(4, int), one) == toxicity.THRESHOLD


def test_thresholds_cover_all_labelled_rows(spark, frame, toxic):
    """A rare language has few rows in the sample; its threshold is the best on all of its
    rows that did not train."""
    rows, labels = toxic
    rng = random.Random(4)
    words = ["".join(rng.choices("tuvwxyz", k=5)) for _ in range(300)]
    extra, marks = [], []
    for i in range(5000, 5300):
        y = int(i % 3 == 0)
        # the rare language has mild words in half of its bad texts and a few good ones
        text = rng.choices(words, k=30) + (["vilea"] if y and i % 2 else ["grim"] * int(rng.random() < 0.1))
        extra.append((i, " ".join(text), "xx", "s"))
        marks.append((i, y, ""))
    docs = frame(rows + extra)
    marked = spark.createDataFrame([*labels, *marks], "doc_id long, toxic int, text string")
    learn = F.lit(True)
    columns = {"per_label": 60, "buckets": 1 << 12}
    model = toxicity.fit(docs, marked, learn, **columns)
    data, _ = toxicity.sample_words(docs, marked, learn, 60, {"buckets": 1 << 12, "stem": 5})
    order = data.column("_order").to_numpy()
    counts = toxicity.score_counts(docs, marked, learn, model, order[np.arange(len(order)) % 5 != 4])
    assert sum(r.n for r in counts) == len(rows) + len(extra)
    assert sum(r.n for r in counts if r.trained) == (np.arange(len(order)) % 5 != 4).sum()
    y = {i: t for i, t, _ in [*labels, *marks]}
    scored = toxicity.score(docs, model).select("row.doc_id", "row.lang", "score", F.xxhash64(F.col("row.doc_id").cast("string")).alias("o")).collect()
    trained = set(order[np.arange(len(order)) % 5 != 4].tolist())
    for lang in ("en", "de", "xx"):
        own = [r for r in scored if r.lang == lang]
        free = [r for r in own if r.o not in trained]
        total = [sum(y[r.doc_id] == c for r in own) for c in (0, 1)]
        left = [sum(y[r.doc_id] == c for r in free) for c in (0, 1)]
        assert min(left) > 20
        label = np.array([y[r.doc_id] for r in free])
        weight = np.array([total[c] / left[c] for c in label])
        assert model.thresholds[lang] == toxicity.best_threshold(np.array([r.score for r in free]), label, weight)


def test_threshold_where_all_rows_of_a_class_trained():
    counts = [("a", 0, False, 4, 50), ("a", 1, True, 12, 3), ("b", 0, False, 2, 9), ("c", 0, False, 1, 80), ("c", 0, False, 9, 20), ("c", 1, False, 12, 5)]
    assert toxicity.thresholds(counts) == {"a": 0.3, "b": 0.3, "c": 0.5}
