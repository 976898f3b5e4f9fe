"""Predictions row by row against the models written out in plain Python: no luck of a
fitted model is needed for them to agree."""

import math
import random
from zlib import crc32

import numpy as np
import pytest

from quotewright.llm import langid, toxicity

MASK = (1 << 32) - 1
TEXTS = [
    None, "", " \n\t", "123 -- 4!", "a", "Ä", "ß ẞ", "it's  ONE\ntext, twice; twice", "日本語 の text", "x" * 3000,
    "no break   line", "tail  ", *(" ".join(random.Random(i).choices(["ab", "Bc,", "c-d", "éa", "7", "\n"], k=3 * i)) for i in range(1, 25)),
]


def rows():
    return [(i if i % 7 else None, t, ["en", "de", None][i % 3], "s") for i, t in enumerate(TEXTS + TEXTS[5:9])]


def plain_buckets(text, buckets):
    letters = ""
    for c in f" {text} ".lower():
        c = c if ord(c) > 127 or "a" <= c <= "z" else " "
        letters += "" if c == " " and letters.endswith(" ") else c
    code = [ord(c) * 0x9E3779B1 & MASK for c in letters]
    found = list(code)
    found += [a * 0x85EBCA6B + b & MASK for a, b in zip(code, code[1:])]
    found += [a * 0xC2B2AE35 + b * 0x27D4EB2F + c & MASK for a, b, c in zip(code, code[1:], code[2:])]
    return [((g ^ (g >> 15)) * 0x2C1B3C6D & MASK) >> (33 - buckets.bit_length()) for g in found]


def test_language_scores_are_those_of_the_model(frame):
    rng = np.random.default_rng(5)
    names, buckets = ["aa", "bb", "cc"], 1 << 10
    model = langid.LanguageModel(names, rng.normal(size=(buckets, 3)).astype(np.float32), rng.normal(size=3), 0.3, 0.6)
    got = {}
    for r in langid.predict(frame(rows()), model).collect():
        got.setdefault(r.doc_id, []).append((r.lang_pred, r.score, r.accepted))
    expected = {}
    for doc_id, text, *_ in rows():
        if not any(c.isalpha() for c in text or ""):
            answer = ("und", 0.0, False)
        else:
            at = plain_buckets(text, buckets)
            z = [(math.fsum(float(model.logits[b][k]) for b in at) / len(at) + model.bias[k]) / 0.3 for k in range(3)]
            e = [math.exp(v - max(z)) for v in z]
            p = max(e) / sum(e)
            answer = (names[e.index(max(e))], p, p >= 0.6)
        expected.setdefault(doc_id, []).append(answer)
    assert {len({a for a, *_ in x}) for x in expected.values()} != {1}
    for doc_id, answers in expected.items():
        for a, b in zip(sorted(answers), sorted(got[doc_id]), strict=True):
            assert a[0] == b[0] and a[2] == b[2] and a[1] == pytest.approx(b[1], rel=1e-9)


def plain_score(model, text):
    words = [w for piece in (text or "").lower().split() for w in "".join(c if c.isalpha() else " " for c in piece).split()]
    mask = len(model.word) - 1
    x = [model.word[crc32(w.encode()) & mask].astype(float) + model.stem[crc32(w[: model.prefix].encode(), 1) & mask] for w in words]
    logit, k = model.base, 0
    for f, b in zip(model.filters, model.biases):
        for c in range(f.shape[2]):
            best = 0.0
            for t in range(len(x)):
                z = sum(float(x[t + j] @ f[j][:, c]) for j in range(len(f)) if t + j < len(x)) + float(b[c])
                best = max(best, z)
            logit += best * float(model.out[k])
            k += 1
    return 1 / (1 + math.exp(-(model.scale * logit + model.shift)))


def test_toxicity_scores_are_those_of_the_model(frame):
    rng = np.random.default_rng(6)
    draw = lambda *shape: rng.normal(0, 0.4, shape).astype(np.float32)
    filters, biases = [draw(w, 8, 2) for w in (1, 2, 3)], [draw(2) for _ in range(3)]
    model = toxicity.ToxicityModel(draw(64, 8), draw(64, 8), filters, biases, draw(6), 0.1, 3, 0.7, -0.2, {"en": 0.5})
    got = {}
    for r in toxicity.score(frame(rows()), model).select("row.doc_id", "row.lang", "score", "rejected").collect():
        got.setdefault((r.doc_id, r.lang), []).append((r.score, r.rejected))
    expected = {}
    for doc_id, text, lang, _ in rows():
        s = plain_score(model, text)
        expected.setdefault((doc_id, lang), []).append((s, s >= (0.5 if lang == "en" else 0.3)))
    assert got.keys() == expected.keys()
    assert len({r for x in expected.values() for _, r in x}) == 2
    for key, answers in expected.items():
        for a, b in zip(sorted(answers), sorted(got[key]), strict=True):
            assert a[0] == pytest.approx(b[0], rel=1e-4) and a[1] == b[1]
