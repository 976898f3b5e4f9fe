import math
from collections import defaultdict

import numpy as np
import pytest

from quotewright.llm.whitening import eigenvalues_below, householder, leading_components, whiten


def brute(vectors, most=16):
    """n, sums, covariance by plain Python over the distinct usable vectors."""
    usable = [v for v in vectors if v and all(c is not None and math.isfinite(c) for c in v)]
    distinct = {tuple(math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v) for v in usable}
    n, sums = len(distinct), [sum(c) for c in zip(*distinct)]
    centred = np.array([[float(e * n - s) / n for e, s in zip(v, sums)] for v in distinct])
    return n, sums, centred.T @ centred / n


@pytest.mark.parametrize("spectrum", ["spread", "clustered", "equal", "low rank", "diagonal"])
@pytest.mark.parametrize("d", [1, 2, 3, 17, 64])
def test_components_of_known_matrices(spectrum, d):
    rng = np.random.default_rng(d)
    q = np.linalg.qr(rng.standard_normal((d, d)))[0]
    values = {
        "spread": np.linspace(100, 1, d),
        "clustered": 50 + 1e-9 * np.arange(d) + (np.arange(d) > d // 2),
        "equal": np.full(d, 7.0),
        "low rank": np.where(np.arange(d) < 3, 5.0 + np.arange(d), 0.0),
        "diagonal": np.arange(d) + 1.0,
    }[spectrum]
    a = np.diag(values) if spectrum == "diagonal" else q @ np.diag(values) @ q.T
    a = (a + a.T) / 2
    found, vectors = leading_components(a, 16)
    want = np.sort(np.linalg.eigvalsh(a))[::-1][:16]
    scale = np.max(np.abs(values))
    assert np.allclose(found, want, rtol=0, atol=1e-13 * scale * d)
    assert np.allclose(vectors.T @ vectors, np.eye(len(found)), atol=1e-12)
    assert np.allclose(a @ vectors, vectors * found, atol=1e-12 * scale * d)


def test_tridiagonal_is_similar_and_counts_are_right():
    rng = np.random.default_rng(4)
    a = rng.standard_normal((20, 20))
    a = a + a.T
    diagonal, off, _ = householder(a)
    t = np.diag(diagonal) + np.diag(off, 1) + np.diag(off, -1)
    values = np.linalg.eigvalsh(a)
    assert np.allclose(np.linalg.eigvalsh(t), values, atol=1e-12)
    at = np.array([values[0] - 1, values[3] + 1e-9, values[10] - 1e-9, values[-1] + 1])
    assert eigenvalues_below(diagonal, off, at).tolist() == [0, 4, 10, 20]


def test_given_embeddings_against_numpy(spark, sf):
    table = spark.read.parquet(f"{sf}/embeddings.parquet")
    rows = {r.vec_id: [float(c) for c in r.embedding] for r in table.collect()}
    n, sums, covariance = brute(rows.values())
    values, vectors = np.linalg.eigh(covariance)
    values, vectors = values[::-1][:16], vectors[:, ::-1][:, :16]
    got = defaultdict(dict)
    for r in whiten(table).collect():
        got[r.vec_id][r.component] = r
    assert set(got) == set(rows) and all(sorted(g) == list(range(1, 17)) for g in got.values())
    signs = None
    for vec_id, parts in got.items():
        x = [math.floor(64 * c) + 1_000_000 for c in rows[vec_id]]
        want = (np.array([float(e * n - s) / n for e, s in zip(x, sums)]) @ vectors) / np.sqrt(values)
        mine = np.array([parts[k].whitened for k in range(1, 17)])
        signs = np.sign(want * mine) if signs is None else signs
        assert np.allclose(mine * signs, want, atol=1e-9)
        assert {p.deviation for p in parts.values()} == {sum((n * e - s) ** 2 for e, s in zip(x, sums))}
        assert {p.n for p in parts.values()} == {n}
        assert parts[1].identity_error < 1e-9
        assert np.allclose([parts[k].explained for k in range(1, 17)], values / np.trace(covariance), rtol=1e-10)


def frame(spark, rows):
    schema = "vec_id long, embedding array<float>, label int, x string, n string, component string, d string"
    return spark.createDataFrame([(i, v, 0, "x", "x", "x", "x") for i, v in rows], schema)


def test_unusable_repeated_and_odd_rows(spark):
    rng = np.random.default_rng(1)
    good = [(i, rng.standard_normal(3).tolist()) for i in range(40)]
    odd = [(100, None), (101, []), (102, [1.0, None, 2.0]), (103, [float("nan"), 1.0, 1.0]), (104, [float("inf"), 0.0, 0.0]), (105, [1.0, 2.0])]
    rows = good + odd + [(None, good[0][1]), (0, good[0][1])] * 30
    found = whiten(frame(spark, rows)).collect()
    assert len(found) == 3 * (40 + 60) and {r.n for r in found} == {40}
    assert {r.vec_id for r in found} == {None, *range(40)}
    n, _, covariance = brute([v for _, v in good])
    assert n == 40 and found[0].explained == pytest.approx(np.linalg.eigvalsh(covariance)[-1] / np.trace(covariance))
    assert whiten(frame(spark, [])).count() == 0
    assert whiten(frame(spark, odd[:5])).count() == 0
    assert whiten(frame(spark, [(1, [1.0, 2.0])] * 5)).count() == 0


def test_flat_dimensions_and_huge_entries(spark):
    rows = [(i, [float(i % 7), 5.0, float(i % 7) * 2]) for i in range(30)]
    found = whiten(frame(spark, rows)).collect()
    assert {r.component for r in found} == {1} and found[0].explained == pytest.approx(1.0)
    huge = [(1, [1e30, 0.0]), (2, [-1e30, 1.0]), (3, [5.0, 2.0])]
    found = whiten(frame(spark, huge)).collect()
    assert found and all(r.deviation is None for r in found if r.vec_id < 3)
    assert all(math.isfinite(r.whitened) for r in found)
