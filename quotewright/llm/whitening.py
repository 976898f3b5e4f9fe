"""Whitening of embeddings by their leading components.

An entry c becomes the whole number x = floor(64 c) + 1000000. The fit list has each
distinct x vector once. Spark sums it exactly, then its centred products; the driver gets
the covariance only (as many numbers as the square of the dimension). There Householder
reflections make it tridiagonal, Sturm counts and bisection find the leading eigenvalues,
and inverse iteration finds their vectors, orthogonal to those of close eigenvalues; the
reflections carry them back. The projection goes to all tasks as a broadcast and every
row passes it once.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quotewright.llm.arrow import map_batches, narrow, parts
from quotewright.session import keep

SCALE, SHIFT, COMPONENTS = 64, 1_000_000, 16
_LARGEST = float(1 << 53)
_ROWS = 2048
_LONG = (1 << 63) - 1


def whole_numbers(vector: Column) -> Column:
    """x of each entry; NULL for a vector that is NULL or empty or holds NULL or an entry
    that is not finite. Entries beyond 2^53 / 64 stay at that bound."""

    def finite(c: Column) -> Column:
        return c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))

    doubles = vector.cast("array<double>")
    near = lambda c: F.greatest(F.lit(-_LARGEST), F.least(F.lit(_LARGEST), c * SCALE))
    x = F.transform(doubles, lambda c: (F.floor(near(c)) + SHIFT).cast("long"))
    return F.when((F.size(vector) > 0) & F.forall(doubles, finite), x)


def householder(a: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Diagonal and off-diagonal of a tridiagonal matrix similar to the symmetric ``a``,
    and the unit vectors of the reflections (each acts on the coordinates after its own)."""
    a = a.copy()
    n = len(a)
    reflections = []
    for k in range(n - 2):
        x = a[k + 1 :, k].copy()
        x[0] += np.copysign(np.linalg.norm(x), x[0])
        length = np.linalg.norm(x)
        v = x / length if length > 0 else x
        rest = a[k + 1 :, k + 1 :]
        p = rest @ v
        p -= (v @ p) * v
        rest -= 2 * (np.outer(v, p) + np.outer(p, v))
        column = a[k + 1 :, k]
        column -= 2 * (v @ column) * v
        reflections.append(v)
    return np.diag(a).copy(), np.diag(a, -1).copy(), reflections


def eigenvalues_below(diagonal: np.ndarray, off: np.ndarray, at: np.ndarray) -> np.ndarray:
    """How many eigenvalues are below each of ``at``: the negative terms of its Sturm sequence."""
    least = np.finfo(float).tiny / np.finfo(float).eps
    square = off**2
    q = diagonal[0] - at
    count = (q < 0).astype(int)
    with np.errstate(over="ignore"):  # an infinite term has the right sign and leaves the next alone
        for i in range(1, len(diagonal)):
            q = np.where(np.abs(q) < least, -least, q)
            q = diagonal[i] - at - square[i - 1] / q
            count += q < 0
    return count


def leading_eigenvalues(diagonal: np.ndarray, off: np.ndarray, most: int) -> np.ndarray:
    """The ``most`` largest eigenvalues, falling, by bisection to the last bit."""
    n = len(diagonal)
    around = np.abs(np.concatenate([[0.0], off])) + np.abs(np.concatenate([off, [0.0]]))
    edge = np.max(np.abs(diagonal) + around) * (1 + 1e-12) + np.finfo(float).tiny
    place = n - 1 - np.arange(min(most, n))  # its number among all, rising
    low, high = np.full(len(place), -edge), np.full(len(place), edge)
    for _ in range(1100):
        middle = low + (high - low) / 2
        if np.all((middle <= low) | (middle >= high)):
            break
        above = eigenvalues_below(diagonal, off, middle) <= place
        low, high = np.where(above, middle, low), np.where(above, high, middle)
    return low + (high - low) / 2


def _solve(diagonal: np.ndarray, off: np.ndarray, shift: float, b: np.ndarray, least: float) -> np.ndarray:
    """(T - shift) y = b by elimination with row exchanges; pivots of at least ``least``."""
    n = len(diagonal)
    d, upper, upper2 = diagonal - shift, np.append(off, 0.0), np.zeros(n)
    y = b.copy()
    for i in range(n - 1):
        low = off[i]
        if abs(low) > abs(d[i]):
            factor = d[i] / low
            d[i], upper[i], upper2[i], d[i + 1], upper[i + 1] = (
                low, d[i + 1], upper[i + 1], upper[i] - factor * d[i + 1], -factor * upper[i + 1],
            )
            y[i], y[i + 1] = y[i + 1], y[i] - factor * y[i + 1]
        else:
            if abs(d[i]) < least:
                d[i] = least
            factor = low / d[i]
            d[i + 1] -= factor * upper[i]
            y[i + 1] -= factor * y[i]
    if abs(d[-1]) < least:
        d[-1] = least
    for i in range(n - 1, -1, -1):
        if i + 1 < n:
            y[i] -= upper[i] * y[i + 1]
        if i + 2 < n:
            y[i] -= upper2[i] * y[i + 2]
        y[i] /= d[i]
        if abs(y[i]) > 1e250:  # growth is what the iteration is after, not its size
            y /= abs(y[i])
    return y


def tridiagonal_vectors(diagonal: np.ndarray, off: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Unit eigenvectors of the falling ``values``, a column each, by inverse iteration.
    Vectors of a cluster (values closer than a thousandth of the norm) are made orthogonal
    to each other in every step."""
    norm = np.max(np.abs(diagonal)) + 2 * np.max(np.abs(off), initial=0.0)
    least = max(np.finfo(float).eps * norm, np.finfo(float).tiny)
    rng = np.random.default_rng(7)
    out = np.zeros((len(diagonal), len(values)))
    start = 0
    shift = np.inf
    for k, value in enumerate(values):
        if k and values[k - 1] - value > 1e-3 * norm:
            start = k
        # equal values get shifts of their own, or all would find the same vector
        shift = min(value, shift - 4 * least) if k > start else value
        y = rng.standard_normal(len(diagonal))
        for _ in range(6):
            for _ in range(2):
                y -= out[:, start:k] @ (out[:, start:k].T @ y)
            y /= np.linalg.norm(y)
            y = _solve(diagonal, off, shift, y, least)
            y /= np.max(np.abs(y))
        for _ in range(2):
            y -= out[:, start:k] @ (out[:, start:k].T @ y)
            y /= np.linalg.norm(y)
        out[:, k] = y
    return out


def leading_components(covariance: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """The largest eigenvalues, falling, and their unit vectors as columns; the largest entry
    of each vector is positive."""
    diagonal, off, reflections = householder(covariance)
    values = leading_eigenvalues(diagonal, off, most)
    vectors = tridiagonal_vectors(diagonal, off, values)
    for k in range(len(reflections) - 1, -1, -1):
        v = reflections[k]
        vectors[k + 1 :] -= 2 * np.outer(v, v @ vectors[k + 1 :])
    signs = np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(len(values))])
    return values, vectors * signs


class Whitening(NamedTuple):
    """n and the sums of the fit list, and of each component the vector over the root of its
    eigenvalue (a column), its share of the variance, and the check of the whole."""

    n: int
    sums: list[int]
    weights: np.ndarray
    explained: np.ndarray
    identity_error: float

    def centred(self, x: np.ndarray) -> np.ndarray:
        return _centred(x, self.n, self.sums)

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ self.weights

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sums over the dimensions of (n x - S)^2, exactly; None beyond a long."""
        near = max((abs(self.n * int(e) - s) for row in (x.max(axis=0), x.min(axis=0)) for e, s in zip(row, self.sums)), default=0)
        if near * near * len(self.sums) <= _LONG and self.n * (abs(int(x.max())) + abs(int(x.min()))) <= _LONG:
            d = self.n * x - np.array(self.sums, np.int64)
            return (d * d).sum(axis=1).tolist()
        exact = [sum((self.n * e - s) ** 2 for e, s in zip(row, self.sums)) for row in x.tolist()]
        return [e if e <= _LONG else None for e in exact]


def _centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """x - S / n in doubles: whole numbers are subtracted first, so nothing cancels."""
    whole = [s // n for s in sums]
    rest = np.array([(s - w * n) / n for s, w in zip(sums, whole)])
    return (x - np.array(whole, np.int64)).astype(np.float64) - rest


def _matrix(batch: pa.RecordBatch, dimension: int) -> np.ndarray:
    return batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, dimension)


def _sums(fit: DataFrame, dimension: int) -> list[int]:
    """Exact sums of each dimension. Tasks add the upper and the lower half of the numbers
    apart, which no number of rows that a batch can hold overflows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = [0] * dimension
        for batch in parts(batches, "x", _ROWS):
            x = _matrix(batch, dimension)
            high, low = (x >> 32).sum(axis=0).tolist(), (x & 0xFFFFFFFF).sum(axis=0).tolist()
            total = [t + (h << 32) + v for t, h, v in zip(total, high, low)]
        names = ["dim", "high", "low"]
        columns = [list(range(dimension)), [t >> 32 for t in total], [t & 0xFFFFFFFF for t in total]]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=names)

    parted = map_batches(fit, run, "dim bigint, high bigint, low bigint")
    rows = parted.groupBy("dim").agg(F.sum("high").alias("high"), F.sum("low").alias("low")).collect()
    return [(r.high << 32) + r.low for r in sorted(rows)]


def _products(fit: DataFrame, dimension: int, size: int, make) -> np.ndarray:
    """The sum over the fit list of the products of the columns that ``make`` gives, as a
    matrix of ``size``; a task's own sum leaves it once."""
    row, column = np.triu_indices(size)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size, size))
        for batch in parts(batches, "x", _ROWS):
            y = make(_matrix(batch, dimension))
            total += y.T @ y
        yield pa.RecordBatch.from_arrays(
            [pa.array(row * size + column), pa.array(total[row, column])], names=["cell", "sum"]
        )

    cells = map_batches(fit, run, "cell bigint, sum double").groupBy("cell").agg(F.sum("sum").alias("sum")).toArrow()
    out = np.zeros(size * size)
    out[cells.column("cell").to_numpy()] = cells.column("sum").to_numpy()
    out = out.reshape(size, size)
    return out + np.triu(out, 1).T


def fit_whitening(vectors: DataFrame, most: int = COMPONENTS, vector_col: str = "embedding") -> Whitening | None:
    """The whitening of the fit list of a column of vectors; None without usable vectors.

    The dimension is the most frequent length among distinct vectors (of several the
    largest); vectors of another length are not part of the list. Components whose
    eigenvalue is zero but for rounding cannot be scaled to variance one and are left out.
    """
    x = vectors.select(whole_numbers(F.col(f"`{vector_col}`")).alias("x")).where("x is not null")
    distinct = keep(x.distinct())
    sizes = distinct.groupBy(F.size("x").alias("d")).count().collect()
    if not sizes:
        return None
    n, dimension = max((r["count"], r.d) for r in sizes)
    fit = distinct.where(F.size("x") == dimension) if len(sizes) > 1 else distinct
    sums = _sums(fit, dimension)
    covariance = _products(fit, dimension, dimension, lambda x: _centred(x, n, sums)) / n
    trace = float(np.trace(covariance))
    values, components = leading_components(covariance, most)
    real = values > trace * dimension * np.finfo(float).eps
    values, components = values[real], components[:, real]
    weights = components / np.sqrt(values)
    if not len(values):
        return Whitening(n, sums, weights, values, 0.0)
    again = _products(fit, dimension, len(values), lambda x: _centred(x, n, sums) @ weights) / n
    error = float(np.max(np.abs(again - np.eye(len(values)))))
    return Whitening(n, sums, weights, values / trace, error)


def whiten(rows: DataFrame, most: int = COMPONENTS, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error: a row for each
    usable row and component of the whitening fitted on all of them.

    Rows whose vector is NULL or empty, holds NULL or an entry that is not finite, or is of
    another length than the most frequent one give none; NULL ids and repeated rows stay;
    other columns are not read. One distinct vector has no variance and gives no rows, as
    does an empty table. A deviation beyond a long is NULL.
    """
    narrowed = narrow(rows, vec_id=id_col, embedding=vector_col)
    fitted = fit_whitening(narrowed, most)
    rest = "component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
    schema = T.StructType([narrowed.schema["vec_id"], *T.StructType.fromDDL(rest)])
    if fitted is None or not len(fitted.explained):
        return rows.sparkSession.createDataFrame([], schema)
    model = rows.sparkSession.sparkContext.broadcast(fitted)
    dimension, count = fitted.weights.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model.value
        for batch in parts(batches, "x", _ROWS):
            x = _matrix(batch, dimension)
            if not len(x):
                continue
            every = pa.array(np.repeat(np.arange(len(x)), count))
            columns = [
                batch.column("vec_id").take(every),
                pa.array(np.tile(np.arange(1, count + 1, dtype=np.int32), len(x))),
                pa.array(np.full(len(every), m.n)),
                pa.array(m.deviations(x), pa.int64()).take(every),
                pa.array(m.whitened(x).ravel()),
                pa.array(np.tile(m.explained, len(x))),
                pa.array(np.full(len(every), m.identity_error)),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    usable = narrowed.select("vec_id", whole_numbers(F.col("embedding")).alias("x")).where(F.size("x") == dimension)
    return map_batches(usable, run, schema)
