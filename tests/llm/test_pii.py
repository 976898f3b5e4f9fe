"""Base spans against the plain patterns; votes, aggregation and odd rows."""

import hashlib
import random
import re

import numpy as np
import pytest

from quotewright.llm import pii


def plain_luhn(d):
    s = 0
    for i, c in enumerate(d[::-1]):
        x = int(c) * (1 + i % 2)
        s += x - 9 if x > 9 else x
    return s % 10 == 0


def plain_spans(t):
    out = [(m.start(), 0, m.end(), "email") for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t):
        if all(int(x) <= 255 for x in m[0].split(".")):
            out.append((m.start(), 1, m.end(), "ip"))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        d = re.sub("[^0-9]", "", m[0])
        if 12 <= len(d) <= 19 and plain_luhn(d):
            out.append((m.start(), 2, m.end(), "card"))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t):
        if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            out.append((m.start(), 3, m.end(), "phone"))
    return [(k, a, b) for a, _, b, k in sorted(out)]


@pytest.mark.parametrize("letters", ["a1@.+- 25()x٣", "0123456789. -+", "ab@.-"])
def test_base_spans_are_those_of_the_patterns(letters):
    rng = random.Random(letters)
    for _ in range(8000):
        t = "".join(rng.choices(letters, k=rng.randrange(45)))
        assert pii.base_spans(t) == plain_spans(t)


def test_long_runs_take_linear_time():
    for t in ("a" * 300_000, "1" * 300_000, "1." * 150_000, "@a.b" * 70_000, "+1 " * 100_000, "a@" * 100_000, "1-" * 150_000):
        spans = pii.base_spans(t)
        pii.candidates(t, spans)


def test_candidates_do_not_touch_base_spans():
    rng = random.Random(1)
    pieces = ["call 555-234-5678", "+49 30 1234567 ", "a.b@c.org", "x (at) y (dot) de ", "DE89 3704 0044 0532 0130 00", "4111 1111 1111 1111", "Frau Anna Schmidt", " 10.0.0.1 ", "v1.2.3.4.5", "\n"]
    for _ in range(400):
        t = "".join(rng.choices(pieces, k=6))
        base = pii.base_spans(t)
        for k, a, b in set(pii.candidates(t, base)) - set(base):
            assert all(b <= x or y <= a for _, x, y in base) and k in pii.KINDS


def test_em_finds_reliable_labelers():
    """Of 4,000 candidates a third are personal; two labelers are right nine times in
    ten, one guesses, the others abstain."""
    rng = np.random.default_rng(5)
    y = rng.random(4000) < 0.35
    vote = np.zeros((4000, 6), int)
    for k, right in ((0, 0.9), (1, 0.92), (2, 0.5)):
        vote[:, k] = 1 + np.where(rng.random(4000) < right, y, ~y)
    rows, count = np.unique(vote, axis=0, return_counts=True)
    p, table = pii.em(rows, count.astype(float))
    assert abs((p * count).sum() / 4000 - 0.35) < 0.08
    assert table[0, 1, 2] > 0.8 and table[1, 0, 1] > 0.8 and abs(table[2, 1, 2] - 0.5) < 0.1


def test_spans_of_every_row(frame):
    rng = random.Random(3)
    number = "7536784127813050 4845168114407329"  # two numbers that the base rule takes for one
    texts = [None, "", "no data", "mail a.b@c.org and 10.0.0.1.", f"cards {number} here", "é +1 (988) 555-2485 ü", "x" * 200_000 + " q@r.de"]
    for i in range(60):
        texts.append(f"call +49 30 12345{i:03d} or write to n{i}@example.com; card 4111 1111 1111 1111; version 1.2.3.{i} page 123456{i}")
    texts += [texts[3]]
    docs = frame([(i or None, t, "en", "s") for i, t in enumerate(texts)])
    found, model = pii.personal_data(docs)
    rows = {r.doc_id: r for r in found.collect()}
    assert len(rows) == len(texts)
    for i, t in enumerate(texts):
        base, r = plain_spans(t or ""), rows[i or None]
        said = pii.written(base)
        assert r.base_sha256 == hashlib.sha256(said.encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s[0] == k for s in base) for k in pii.BASE]
        assert set(filter(None, said.split(","))) <= set(r.spans.split(","))
        starts = [(int(x.split(":")[1]), pii.KINDS.index(x.split(":")[0])) for x in r.spans.split(",") if x]
        assert starts == sorted(starts)
    assert "card:6:22" in rows[4].spans or "card:23:39" in rows[4].spans
    assert model.reliability.shape == (6, 2, 3)
    assert pii.personal_data(docs.limit(0))[0].collect() == []
    assert [r.spans for r in pii.personal_data(docs.where("doc_id = 2"))[0].collect()] == [""]
