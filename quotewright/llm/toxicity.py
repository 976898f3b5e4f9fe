"""Toxicity: a convolutional text classifier trained in numpy.

Words are embedded by two hashes (the word, and its first letters, so that inflected
forms share), filters of several widths slide over the whole text, each keeps its
maximum, and a linear layer scores the maxima. Three fifths of the sample give the first
coordinates of the embeddings (log-odds of the buckets), four fifths train everything by
stochastic gradient descent, the last fifth calibrates the scores to probabilities. One
threshold for each language follows from counts of the scores of all labelled rows that did
not train. The language chooses a threshold; it never enters a score.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from itertools import chain
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quotewright.llm.arrow import WordCache, map_batches, narrow, parts, with_columns
from quotewright.llm.components import sized
from quotewright.llm.sampling import order_of, per_class
from quotewright.session import keep

THRESHOLD = 0.3
GRID = np.round(np.arange(0.05, 0.951, 0.05), 2)
_SLICE = 1 << 15


class Words:
    """Bucket pairs of the words of a text, packed as word << 32 | stem."""

    def __init__(self, buckets: int, stem: int) -> None:
        self.mask, self.stem = buckets - 1, stem
        self.cache = WordCache(self._pairs)

    def _pairs(self, piece: str) -> tuple[int, ...]:
        words = "".join(c if c.isalpha() else " " for c in piece).split()
        m = self.mask
        return tuple((crc32(w.encode()) & m) << 32 | crc32(w[: self.stem].encode(), 1) & m for w in words)

    def of(self, text: str | None) -> np.ndarray:
        pieces = (text or "").lower().split()
        return np.fromiter(chain.from_iterable(map(self.cache.__getitem__, pieces)), np.int64)


@dataclass
class ToxicityModel:
    """``word``, ``stem``: embeddings by bucket; ``filters``: by width, shape (width,
    size, number); ``scale``, ``shift``: calibration of the logit; ``thresholds``: by
    language, ``THRESHOLD`` for others."""

    word: np.ndarray
    stem: np.ndarray
    filters: list[np.ndarray]
    biases: list[np.ndarray]
    out: np.ndarray
    base: float
    prefix: int
    scale: float = 1.0
    shift: float = 0.0
    thresholds: dict[str, float] = field(default_factory=dict)

    def embed(self, ids: np.ndarray) -> np.ndarray:
        """Embeddings with blanks behind, so that every width fits the shortest text."""
        x = np.zeros((len(ids) + len(self.filters) - 1, self.word.shape[1]), np.float32)
        x[: len(ids)] = self.word[ids >> 32]
        x[: len(ids)] += self.stem[ids & 0xFFFFFFFF]
        return x

    def convolve(self, x: np.ndarray) -> list[np.ndarray]:
        n = len(x) - len(self.filters) + 1
        return [sum(x[j : j + n] @ k[j] for j in range(len(k))) + b for k, b in zip(self.filters, self.biases)]

    def logit(self, ids: np.ndarray) -> float:
        """Over all words, in slices that overlap by the widest filter."""
        most = np.zeros(len(self.out), np.float32)
        reach = len(self.filters) - 1
        for start in range(0, len(ids), _SLICE):
            x = self.embed(ids[start : start + _SLICE + reach])
            most = np.maximum(most, np.concatenate([z[:_SLICE].max(axis=0) for z in self.convolve(x)]))
        return float(most @ self.out + self.base)

    def score(self, ids: np.ndarray) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.scale * self.logit(ids) + self.shift, -30, 30))))


def _marked(labels: DataFrame, id_col: str, label_col: str) -> DataFrame:
    """doc_id, label: NULL labels teach nothing, and of several of one id the largest counts."""
    marked = narrow(labels, doc_id=id_col, label=label_col).where("label is not null and doc_id is not null")
    return marked.groupBy("doc_id").agg((F.max("label") > 0).cast("int").alias("label"))


def sample_words(docs: DataFrame, labels: DataFrame, learn: Column, per_label: int, words: dict, bytes_per_label: int = 64 << 20, id_col="doc_id", text_col="text", lang_col="lang", label_col="toxic"):
    """Order, words, label and language of about ``per_label`` labelled rows a class,
    one row an id, and of at most ``bytes_per_label`` of texts a class; a text of over a
    twentieth of that is not learned from."""
    marked = _marked(labels, id_col, label_col)
    rows = narrow(docs.where(learn), doc_id=id_col, text=text_col, lang=lang_col)
    chosen, counts = per_class(marked.join(rows.select("doc_id"), "doc_id"), "label", per_label, "doc_id")
    chosen = chosen.select("doc_id", "label", "_order").distinct()  # ids only; texts join once, for the sample

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split = Words(**words)
        for batch in parts(batches, "text", 64):
            ids = [split.of(t.as_py()) for t in batch.column("text")]
            yield with_columns(batch, ["_order", "label", "lang"], ids=pa.array(ids, pa.list_(pa.int64())))

    # the sample is small: it is broadcast to the texts, which are not shuffled for it
    sample = rows.join(sized(keep(chosen)), "doc_id").dropDuplicates(["doc_id"])
    sample = keep(sample.withColumn("bytes", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")))
    so_far = F.sum("bytes").over(W.partitionBy("label").orderBy("_order", "doc_id").rowsBetween(W.unboundedPreceding, 0))
    fit = sample.select("doc_id", "label", "_order", "bytes").where(F.col("bytes") * 20 <= bytes_per_label)
    fit = fit.withColumn("so_far", so_far).where(F.col("so_far") <= bytes_per_label).select("doc_id")
    sample = sample.join(fit, "doc_id", "left_semi").select("_order", "label", "lang", "text")
    out = map_batches(sample, cut, "_order bigint, label int, lang string, ids array<bigint>")
    return out.toArrow().sort_by([("_order", "ascending"), ("label", "ascending")]), counts


def train(
    docs: DataFrame,
    labels: DataFrame,
    learn: Column,
    per_label: int = 1500,
    buckets: int = 1 << 18,
    size: int = 8,
    number: int = 6,
    widths: int = 3,
    stem: int = 5,
    epochs: int = 4,
    rate: float = 0.05,
    **columns: str,
) -> tuple[ToxicityModel, np.ndarray | None]:
    """A model without thresholds from about ``per_label`` rows of each class (the bound of
    the sample), and the hashes of the ids that trained. With no labelled rows of one class
    there are none, and the score is the same for all texts: 0 without any positive row,
    and 1 without any negative one."""
    data, counts = sample_words(docs, labels, learn, per_label, {"buckets": buckets, "stem": stem}, **columns)
    y = np.array(data.column("label").to_pylist(), np.int64)
    ids = [np.asarray(x.values) for x in data.column("ids")]
    rng = np.random.default_rng(11)
    model = ToxicityModel(
        rng.normal(0, 0.05, (buckets, size)).astype(np.float32),
        rng.normal(0, 0.05, (buckets, size)).astype(np.float32),
        [rng.normal(0, 0.3, (w, size, number)).astype(np.float32) for w in range(1, widths + 1)],
        [np.zeros(number, np.float32) for _ in range(widths)],
        np.abs(rng.normal(0, 0.3, number * widths)).astype(np.float32),
        0.0,
        stem,
    )
    if len(set(y.tolist())) < 2:
        model.scale, model.shift = 0.0, 30.0 if len(y) and y[0] else -30.0
        return model, None
    part = np.arange(len(y)) % 5
    first = part < 3 if len({*y[part < 3].tolist()}) > 1 else part < 5
    _log_odds(model, [ids[i] for i in np.flatnonzero(first)], y[first])
    _train(model, ids, y, np.flatnonzero(part != 4), epochs, rate, rng)
    check = np.flatnonzero(part == 4) if len({*y[part == 4].tolist()}) > 1 else np.arange(len(y))
    logits = np.array([model.logit(ids[i]) for i in check])
    # rows of a class stand for as many rows as the class has
    weight = np.array([counts.get(int(c), 1) / max(1, (y == c).sum()) for c in (0, 1)])[y[check]]
    model.scale, model.shift = _platt(logits, y[check], weight)
    return model, data.column("_order").to_numpy()[part != 4]


def fit(docs: DataFrame, labels: DataFrame, learn: Column, id_col="doc_id", text_col="text", lang_col="lang", label_col="toxic", **settings) -> ToxicityModel:
    """``train``, with thresholds from the scores of all labelled rows (``score_counts``,
    ``thresholds``): a model for other documents. ``judged`` scores those it learns from
    once only."""
    columns = {"id_col": id_col, "text_col": text_col, "lang_col": lang_col, "label_col": label_col}
    model, trained = train(docs, labels, learn, **columns, **settings)
    if trained is not None:
        model.thresholds = thresholds(score_counts(docs, labels, learn, model, trained, **columns))
    return model


def score_counts(docs: DataFrame, labels: DataFrame, learn: Column, model: ToxicityModel, trained: np.ndarray, id_col="doc_id", text_col="text", lang_col="lang", label_col="toxic") -> list:
    """Rows (lang, label, trained, step, n) over all labelled rows with a language: how many
    scores reach so many steps of ``GRID``. ``trained``: hashes of the ids that trained.
    Texts are scored where they lie; only ids and steps meet the labels."""
    known = docs.where(learn & F.col(f"`{id_col}`").isNotNull() & F.col(f"`{lang_col}`").isNotNull())
    return step_counts(scores(known, F.lit(True), model, trained, [], id_col, text_col, lang_col), labels, id_col, label_col)


def step_counts(scored: DataFrame, labels: DataFrame, id_col="doc_id", label_col="toxic") -> list:
    """The counts of ``score_counts`` over ``scores``: a row for each language, label and step."""
    rows = scored.where("learnable and doc_id is not null and lang is not null").select("doc_id", "lang", "trained", "step")
    joined = rows.join(_marked(labels, id_col, label_col), "doc_id")
    return joined.groupBy("lang", "label", "trained", "step").agg(F.count("*").alias("n")).collect()


def scores(docs: DataFrame, learn: Column, model: ToxicityModel, trained: np.ndarray, columns: Sequence[str], id_col="doc_id", text_col="text", lang_col="lang") -> DataFrame:
    """row (a struct of ``columns``, left out if there are none), doc_id, lang, learnable,
    trained, step (how many steps of ``GRID`` the score reaches), score: one narrow pass over
    whole texts. ``trained``: hashes of the ids that trained."""
    shared = docs.sparkSession.sparkContext.broadcast((model, np.unique(trained)))
    whole = text_col in columns  # then the text is in the row and not sent twice

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, known = shared.value
        split = Words(len(m.word), m.prefix)
        for batch in parts(batches, "row" if whole else "text"):
            texts = batch.column("row").field(text_col) if whole else batch.column("text")
            found = np.array([m.score(split.of(t.as_py())) for t in texts])
            step = pa.array(np.searchsorted(GRID, found, side="right").astype(np.int32))
            own = pa.array(np.isin(batch.column("_order").to_numpy(), known))
            yield with_columns(batch, kept, trained=own, step=step, score=pa.array(found, pa.float64()))

    rows = docs.select(
        *([F.struct(*(F.col(f"`{c}`") for c in columns)).alias("row")] if columns else []),
        F.col(f"`{id_col}`").alias("doc_id"),
        F.col(f"`{lang_col}`").alias("lang"),
        F.coalesce(learn, F.lit(False)).alias("learnable"),
        *([] if whole else [F.col(f"`{text_col}`").alias("text")]),
    ).withColumn("_order", order_of("doc_id"))
    kept = [c for c in rows.columns if c not in ("text", "_order")]
    schema = T.StructType([*(rows.schema[c] for c in kept), *T.StructType.fromDDL("trained boolean, step int, score double")])
    return map_batches(rows, run, schema)


def judged(docs: DataFrame, labels: DataFrame, learn: Column, columns: Sequence[str] | None = None, id_col="doc_id", text_col="text", lang_col="lang", label_col="toxic", **settings) -> DataFrame:
    """``columns`` of ``docs`` (all if None) as a struct ``row``, with ``score`` (0 to 1) and
    ``rejected`` (score at or above its language's threshold), by a model that learns from
    those rows of ``docs`` that ``learn`` selects.

    Every text is scored once: the rows and their scores are written, the thresholds are
    counted from the scores, and then decide. NULL and empty texts score what a text
    without words scores; rows of no language, or one without labels, have the threshold
    ``THRESHOLD``; repeated rows stay; an empty table gives no rows; other columns may
    have any name.
    """
    names = {"id_col": id_col, "text_col": text_col, "lang_col": lang_col}
    model, trained = train(docs, labels, learn, **names, label_col=label_col, **settings)
    wanted = docs.columns if columns is None else list(columns)
    scored = keep(scores(docs, learn, model, np.zeros(0, np.int64) if trained is None else trained, wanted, **names))
    limits = {} if trained is None else thresholds(step_counts(scored, labels, id_col, label_col))
    limit = F.lit(THRESHOLD)
    if limits:
        by_language = F.create_map(*chain.from_iterable((F.lit(k), F.lit(v)) for k, v in limits.items()))
        limit = F.coalesce(F.try_element_at(by_language, F.col("lang")), limit)
    return scored.select("row", "score", (F.col("score") >= limit).alias("rejected"))


def thresholds(counts: list) -> dict[str, float]:
    """By language, from ``score_counts``: the rows that did not train, standing for all of
    their class and language. Where all rows of a class trained, they have to serve."""
    tables: dict[str, np.ndarray] = {}
    for lang, label, trained, step, n in counts:
        tables.setdefault(lang, np.zeros((2, 2, len(GRID) + 1)))[int(trained), label, step] += n
    out = {}
    y = np.repeat([0, 1], len(GRID) + 1)
    scores = np.tile([0.0, *GRID], 2)
    for lang in sorted(tables):
        every, free = tables[lang].sum(axis=0), tables[lang][0]
        rows = free.sum(axis=1, keepdims=True)
        weight = np.where(rows > 0, free * every.sum(axis=1, keepdims=True) / np.maximum(rows, 1), every).ravel()
        out[lang] = best_threshold(scores[weight > 0], y[weight > 0], weight[weight > 0])
    return out


def _log_odds(model: ToxicityModel, ids: list[np.ndarray], y: np.ndarray, least: int = 3) -> None:
    """First coordinates: half the log-odds of the buckets that at least ``least`` texts have."""
    for k, (table, part) in enumerate(((model.word, lambda a: a >> 32), (model.stem, lambda a: a & 0xFFFFFFFF))):
        seen = np.zeros((2, len(table)))
        for a, c in zip(ids, y):
            seen[c, np.unique(part(a))] += 1
            # two texts at the odds of the sample are added, which pulls rare buckets to zero
        rows = np.bincount(y, minlength=2)
        odds = np.log((seen[1] + 2 * rows[1] / len(y)) / (seen[0] + 2 * rows[0] / len(y)) * rows[0] / rows[1])
        table[:, k] = np.where(seen.sum(axis=0) >= least, np.clip(odds, -4, 4) / 2, 0)
    for f in model.filters:
        f[:, :2] = np.abs(f[:, :2])


def _train(model: ToxicityModel, ids, y, rows, epochs, rate, rng) -> None:
    """One text a step, Adagrad's step sizes; maxima send gradients to their windows only."""
    number = model.filters[0].shape[2]
    tables = {id(a): np.full(a.shape, 1e-4, np.float32) for a in (model.word, model.stem, model.out, *model.filters, *model.biases)}
    base_seen = 1e-4

    def step(a: np.ndarray, at, g: np.ndarray) -> None:
        seen = tables[id(a)]
        seen[at] += g * g
        a[at] -= rate * g / np.sqrt(seen[at])

    for _ in range(epochs):
        for i in rng.permutation(rows):
            x = model.embed(ids[i])
            z = model.convolve(x) if len(ids[i]) else [np.zeros((1, number), np.float32)] * len(model.filters)
            where = [a.argmax(axis=0) for a in z]
            most = np.concatenate([a[w, np.arange(number)] for a, w in zip(z, where)])
            act = np.maximum(most, 0)
            d = 1 / (1 + np.exp(-np.clip(act @ model.out + model.base, -30, 30))) - y[i]
            back = np.where(most > 0, d * model.out, 0).astype(np.float32)
            base_seen += d * d
            model.base -= rate * d / base_seen**0.5
            step(model.out, slice(None), (d * act).astype(np.float32))
            if not len(ids[i]):
                continue
            grad = {}
            for w, (k, b) in enumerate(zip(model.filters, model.biases)):
                g = back[w * number : (w + 1) * number]
                on = np.flatnonzero(g)
                if not len(on):
                    continue
                gk = np.zeros_like(k)
                for j in range(len(k)):
                    gk[j][:, on] = (x[where[w][on] + j] * g[on, None]).T
                    for f in on:
                        at = int(where[w][f]) + j
                        if at < len(ids[i]):
                            grad[at] = grad.get(at, 0) + g[f] * k[j][:, f]
                step(k, slice(None), gk)
                step(b, slice(None), g)
            for at, g in grad.items():
                step(model.word, ids[i][at] >> 32, g)
                step(model.stem, ids[i][at] & 0xFFFFFFFF, g)


def _platt(z: np.ndarray, y: np.ndarray, weight: np.ndarray, rounds: int = 200) -> tuple[float, float]:
    """Weighted logistic regression of the label on the logit; a slight pull to scale 1
    keeps it finite where the classes part, and never below 0: more logit, more score."""
    a, b = 1.0, 0.0
    w = weight / weight.sum()
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(a * z + b, -30, 30)))
        h = w * np.maximum(p * (1 - p), 1e-6)
        ga, gb = (w * (p - y)) @ z + 1e-3 * (a - 1), (w * (p - y)).sum()
        haa, hab, hbb = h @ z**2 + 1e-3, h @ z, h.sum() + 1e-6
        det = haa * hbb - hab**2
        a, b = a - (hbb * ga - hab * gb) / det * 0.5, b - (haa * gb - hab * ga) / det * 0.5
        a = max(a, 1e-3)
    return float(a), float(b)


def best_threshold(scores: np.ndarray, y: np.ndarray, weight: np.ndarray, default: float = THRESHOLD) -> float:
    """The threshold of the best weighted F1 on a grid; the nearest to the default among
    equals, and the default where a class is missing."""
    if len(set(y.tolist())) < 2:
        return default
    best = (-1.0, 0.0, default)
    for t in GRID:
        hit = scores >= t
        right = (weight * (hit & (y == 1))).sum()
        f1 = 2 * right / max(1e-12, (weight * hit).sum() + (weight * (y == 1)).sum())
        best = max(best, (round(float(f1), 6), -abs(float(t) - default), float(t)))
    return best[2]


def score(docs: DataFrame, model: ToxicityModel, id_col="doc_id", text_col="text", lang_col="lang") -> DataFrame:
    """All columns of ``docs`` as a struct ``row``, with ``score`` (0 to 1) and
    ``rejected`` (score at or above its language's threshold), in one narrow pass over
    whole texts. NULL and empty texts score what a text without words scores."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m: ToxicityModel = shared.value
        split = Words(len(m.word), m.prefix)
        for batch in parts(batches, "row"):
            row = batch.column("row")
            found = [m.score(split.of(t.as_py())) for t in row.field(text_col)]
            limits = [m.thresholds.get(k.as_py(), THRESHOLD) for k in row.field(lang_col)]
            rejected = [s >= t for s, t in zip(found, limits)]
            yield with_columns(batch, ["row"], score=pa.array(found, pa.float64()), rejected=pa.array(rejected, pa.bool_()))

    rows = docs.select(F.struct("*").alias("row"))
    schema = T.StructType([*rows.schema, T.StructField("score", T.DoubleType()), T.StructField("rejected", T.BooleanType())])
    return map_batches(rows, run, schema)
