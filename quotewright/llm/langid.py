"""Language identification: averaged hashed subword embeddings under a linear softmax.

A text is the mean of the embeddings of its character 1- to 3-grams, hashed to buckets;
a linear softmax over that mean gives the language. Both are trained by stochastic
gradient descent in numpy on a bounded sample. As mean and softmax are linear up to the
last step, a prediction adds up one row of logits for every gram, so whole texts of any
length are read once, in slices.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quotewright.llm.arrow import map_batches, narrow, parts, with_columns
from quotewright.llm.sampling import per_class

UNKNOWN = "und"
_SLICE = 1 << 19
_KEEP = np.full(128, 32, np.uint32)
_KEEP[97:123] = np.arange(97, 123)


def _letters(text: str) -> np.ndarray:
    """Code points of the lower-cased text; runs of ASCII non-letters are one blank."""
    a = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    a = np.where(a < 128, _KEEP[np.minimum(a, 127)], a)
    blank = a == 32
    return np.concatenate([a[:1], a[1:][~(blank[1:] & blank[:-1])]])


def grams(text: str, buckets: int) -> Iterator[np.ndarray]:
    """Bucket numbers of all character 1- to 3-grams, slice by slice (a power of two buckets)."""
    shift = np.uint32(32 - buckets.bit_length() + 1)
    a = _letters(f" {text} ") * np.uint32(0x9E3779B1)
    for start in range(0, len(a), _SLICE):
        c = a[start : start + _SLICE + 2]
        one = c[:_SLICE]
        two = (c[:-1] * np.uint32(0x85EBCA6B) + c[1:])[:_SLICE]
        three = (c[:-2] * np.uint32(0xC2B2AE35) + c[1:-1] * np.uint32(0x27D4EB2F) + c[2:])[:_SLICE]
        for g in (one, two, three):
            yield ((g ^ (g >> np.uint32(15))) * np.uint32(0x2C1B3C6D)) >> shift


@dataclass
class LanguageModel:
    """``logits``: a row of logits for each bucket; ``temperature`` divides their mean;
    below ``accept`` a prediction is rejected."""

    languages: list[str]
    logits: np.ndarray
    bias: np.ndarray
    temperature: float = 1.0
    accept: float = 0.0

    def probabilities(self, text: str) -> np.ndarray:
        total, n = np.zeros(len(self.languages)), 0
        for b in grams(text, len(self.logits)):
            total += self.logits[b].sum(axis=0, dtype=np.float64)
            n += len(b)
        return _softmax((total / max(n, 1) + self.bias) / self.temperature)

    def predict(self, text: str | None) -> tuple[str, float]:
        if text is None or not self.languages or not any(map(str.isalpha, text)):
            return UNKNOWN, 0.0
        p = self.probabilities(text)
        k = int(p.argmax())
        return self.languages[k], float(min(1.0, p[k]))


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def sample_bags(docs: DataFrame, learn: Column, per_language: int, buckets: int, id_col="doc_id", text_col="text", lang_col="lang") -> pa.Table:
    """lang, buckets and their shares of about ``per_language`` learnable rows a language."""
    rows = narrow(docs.where(learn & F.col(text_col).isNotNull() & F.col(lang_col).isNotNull()), doc_id=id_col, text=text_col, lang=lang_col)
    sample, _ = per_class(rows, "lang", per_language, "doc_id", "text")

    def bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts(batches, "text", 64):
            index, share = [], []
            for t in batch.column("text"):
                n = sum(np.bincount(b, minlength=buckets) for b in grams(t.as_py(), buckets))
                at = np.flatnonzero(n)
                index.append(at.astype(np.int32))
                share.append((n[at] / n.sum()).astype(np.float32))
            yield with_columns(batch, ["_order", "lang"], at=pa.array(index, pa.list_(pa.int32())), share=pa.array(share, pa.list_(pa.float32())))

    out = map_batches(sample.select("_order", "lang", "text"), bags, "_order bigint, lang string, at array<int>, share array<float>")
    return out.toArrow().sort_by([("_order", "ascending"), ("lang", "ascending")])


def fit(
    docs: DataFrame,
    learn: Column,
    per_language: int = 400,
    buckets: int = 1 << 15,
    width: int = 16,
    epochs: int = 5,
    rate: float = 0.5,
    precision: float = 0.99,
    **columns: str,
) -> LanguageModel:
    """Train on about ``per_language`` rows of each language among those that ``learn``
    selects (the bound of the sample). A fifth of them only calibrates: the temperature
    minimises their log loss, and ``accept`` is the lowest probability from which on
    accepted rows reach ``precision``. Without rows the model knows no language."""
    data = sample_bags(docs, learn, per_language, buckets, **columns)
    names = sorted(set(data.column("lang").to_pylist()))
    if not names:
        return LanguageModel([], np.zeros((buckets, 0), np.float32), np.zeros(0))
    y = np.array([names.index(x) for x in data.column("lang").to_pylist()])
    at = [np.asarray(x.values) for x in data.column("at")]
    share = [np.asarray(x.values) for x in data.column("share")]
    held = np.arange(len(y)) % 5 == 4 if len(y) >= 20 else np.zeros(len(y), bool)
    rng = np.random.default_rng(7)
    embed = rng.normal(0, 0.1, (buckets, width)).astype(np.float32)
    out = np.zeros((width, len(names)), np.float32)
    out += rng.normal(0, 0.1, out.shape)
    bias = np.zeros(len(names), np.float32)
    seen_e, seen_o, seen_b = np.full(buckets, 1e-8, np.float32), np.full(out.shape, 1e-8, np.float32), np.full(bias.shape, 1e-8, np.float32)
    train = np.flatnonzero(~held)
    for _ in range(epochs):
        for i in rng.permutation(train):  # plain SGD with Adagrad's step sizes
            x = share[i] @ embed[at[i]]
            d = _softmax(x @ out + bias)
            d[y[i]] -= 1
            g_out, g_x = np.outer(x, d), out @ d
            seen_o += g_out**2
            seen_b += d**2
            out -= rate * g_out / np.sqrt(seen_o)
            bias -= 0.1 * rate * d / np.sqrt(seen_b)
            seen_e[at[i]] += share[i] ** 2 * (g_x @ g_x) / width
            embed[at[i]] -= rate * 0.1 * (share[i] / np.sqrt(seen_e[at[i]]))[:, None] * g_x
    model = LanguageModel(names, (embed @ out).astype(np.float32), bias.astype(np.float64))
    check = np.flatnonzero(held) if held.any() else train
    z = np.array([share[i] @ model.logits[at[i]] for i in check]) + bias
    model.temperature, model.accept = calibrate(z, y[check], precision)
    return model


def calibrate(z: np.ndarray, y: np.ndarray, precision: float) -> tuple[float, float]:
    grid = np.geomspace(0.05, 20, 60)
    loss = [-np.log(np.maximum(_softmax(z / t)[np.arange(len(y)), y], 1e-12)).mean() for t in grid]
    t = float(grid[int(np.argmin(loss))])
    p = _softmax(z / t)
    top, right = p.max(axis=1), p.argmax(axis=1) == y
    order = np.argsort(-top)
    good = np.cumsum(right[order]) / np.arange(1, len(y) + 1) >= precision
    if good.all() or not good.any():
        return t, 0.0 if good.all() else 1.0
    return t, float(top[order][np.flatnonzero(good)[-1]])


def predict(docs: DataFrame, model: LanguageModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, lang_pred, score, accepted of every row, in one narrow pass over whole texts.

    NULL texts and texts without a letter are ``und`` with score 0, not accepted; so is
    every text when the model has learned nothing. ``accepted`` is false where the
    calibrated probability is below the model's ``accept``. Reads only the text; NULL ids
    and repeated rows stay.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m: LanguageModel = shared.value
        for batch in parts(batches, "text"):
            found = [m.predict(t.as_py()) for t in batch.column("text")]
            scores = [s for _, s in found]
            yield with_columns(
                batch,
                ["doc_id"],
                lang_pred=pa.array([k for k, _ in found], pa.string()),
                score=pa.array(scores, pa.float64()),
                accepted=pa.array([k != UNKNOWN and s >= m.accept for k, s in found], pa.bool_()),
            )

    rows = narrow(docs, doc_id=id_col, text=text_col)
    id_type = rows.schema["doc_id"].dataType.simpleString()
    return map_batches(rows, run, f"doc_id {id_type}, lang_pred string, score double, accepted boolean")
