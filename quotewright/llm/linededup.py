"""Fuzzy line deduplication by MinHash.

A line (lower case, words one blank apart) is the set of its 8-character shingles. One
hash a shingle fills 48 bins with minima (one-permutation MinHash; empty bins borrow
from others in a fixed random order), four bins make a band, and lines that share one of
twelve bands are candidates: a pair of similarity 0.8 is missed once in 500 times, one of
0.9 once in 50,000. Candidates are compared exactly, and distributed union-find joins the
linked lines. Of each component the first occurrence stays (by document id, then place);
all others go.

Texts are scanned once. Copies of a line are one row with a count before any join. The
bands follow one another, with the components found so far carried on: each shuffles its
own index only, and lines that are joined meet no more. Within a bucket, groups of near
copies are linked through their most frequent line first, so they do not make all pairs.
Lines of different components in one bucket are compared exactly unless the
sizes or the parities of their shingles in 1,024 classes rule similarity 0.8 out: every
parity that differs takes a shingle that only one of the two has, and of those there may be a ninth of
their shingles at most. So no pair that the bands find is lost, however full its bucket.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from operator import add

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from xxhash import xxh64_intdigest

from quotewright.llm.arrow import WordCache, map_batches, narrow, parts, with_columns
from quotewright.llm.components import carried_components, sized
from quotewright.session import finished, keep

SHINGLE, BANDS, ROWS, SIMILARITY = 8, 12, 4, 0.8
BINS = BANDS * ROWS
SKETCH_WORDS = 16
_BAND_NAMES = [f"b{i}" for i in range(BANDS)]
_SKETCH_NAMES = ["places", *(f"s{i}" for i in range(SKETCH_WORDS))]
_EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)
_ODD = np.uint64(0x9E3779B97F4A7C15)
_BASE = 0x100000001B3
_SKETCH_BINS = 64 * SKETCH_WORDS
_DONORS = np.random.default_rng(23).integers(0, BINS, (4096, BINS))
_AT_ONCE = 1 << 20
# what str.split parts words at
_SPACE = r"\x09-\x0D\x1C-\x20\x85\xA0\u1680\u2000-\u200A\u2028\u2029\u202F\u205F\u3000"


def normal(line: str) -> str:
    return " ".join(line.lower().split())


def shingles(line: str, size: int = SHINGLE) -> set[str]:
    """All runs of ``size`` characters; the line itself if it is shorter."""
    return {line[i : i + size] for i in range(max(1, len(line) - size + 1))}


def similarity(a: set[str], b: set[str]) -> float:
    both = len(a & b)
    return both / (len(a) + len(b) - both)


def _windows(c: np.ndarray, size: int) -> np.ndarray:
    """A polynomial of every run of ``size`` numbers, from those of runs half as long."""
    if size == 1:
        return c
    half = size // 2
    h = _windows(c, half)
    h = h[:-half] * np.uint64(pow(_BASE, half, 1 << 64)) + h[half:]
    return h[:-1] * np.uint64(_BASE) + c[size - 1 :] if size % 2 else h


def _hashes(lines: list[str], size: int) -> tuple[np.ndarray, np.ndarray]:
    """A hash of every shingle of the lines, which must not be empty, and how many a line has."""
    padded = [x if len(x) >= size else x + "\0" * (size - len(x)) for x in lines]
    c = np.frombuffer("".join(padded).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    length = np.array([len(x) for x in padded])
    h = _windows(c, size)
    # runs that begin at a line's last characters would end in the next line
    own = np.ones(len(h), bool)
    own[(np.cumsum(length)[:-1, None] - np.arange(1, size)).ravel()] = False
    h = h[own]
    h ^= h >> np.uint64(31)
    h *= _ODD
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    return h, length - size + 1


def _pieces(lines: list[str], size: int) -> Iterator[tuple[list[str], list[int]]]:
    """The lines in groups of a bounded number of characters, longer ones in pieces that
    overlap so that no shingle is lost; and the number of each piece's line."""
    group, owners, held = [], [], 0
    for i, line in enumerate(lines):
        for start in range(0, max(1, len(line) - size + 1), _AT_ONCE):
            piece = line[start : start + _AT_ONCE + size - 1]
            group.append(piece)
            owners.append(i)
            held += len(piece)
            if held >= _AT_ONCE:
                yield group, owners
                group, owners, held = [], [], 0
    if group:
        yield group, owners


def signatures(lines: list[str], size: int = SHINGLE) -> np.ndarray:
    """The least hash in each bin, shape (lines, BINS). An empty bin takes the value of the
    first filled bin in its own random order."""
    out = np.full(len(lines) * BINS, _EMPTY, np.uint64)
    for pieces, owners in _pieces(lines, size):
        h, count = _hashes(pieces, size)
        at = ((h >> np.uint64(32)) * np.uint64(BINS) >> np.uint64(32)).astype(np.int64)
        at += np.repeat(np.array(owners) * BINS, count)
        np.minimum.at(out, at, h & np.uint64(0xFFFFFFFF))
    out = out.reshape(len(lines), BINS)
    row, col = np.nonzero(out == _EMPTY)
    first = out.copy()
    for donors in _DONORS:
        if not len(row):
            break
        value = first[row, donors[col]]
        out[row, col] = value
        left = value == _EMPTY
        row, col = row[left], col[left]
    return out


def parities_of(lines: list[str], size: int = SHINGLE) -> np.ndarray:
    """For each line the number of its different shingles and, for each class of them (by
    their hashes), whether it has an odd number: shape (lines, 1 + SKETCH_WORDS)."""
    h, count = _hashes(lines, size)
    ends = np.cumsum(count)
    starts = ends - count
    for start, end in zip(starts.tolist(), ends.tolist()):
        h[start:end].sort()
    new = np.ones(len(h), bool)
    new[1:] = h[1:] != h[:-1]
    new[starts] = True
    line = np.repeat(np.arange(len(lines)), count)[new]
    classes = (h[new] >> np.uint64(40)).astype(np.int64) % _SKETCH_BINS
    odd = np.bincount(line * _SKETCH_BINS + classes, minlength=len(lines) * _SKETCH_BINS) & 1
    words = np.packbits(odd.astype(np.uint8)).view(np.int64).reshape(len(lines), SKETCH_WORDS)
    return np.column_stack([np.bincount(line, minlength=len(lines)), words])


def parities(line: str, size: int = SHINGLE) -> list[int]:
    return parities_of([line], size)[0].tolist()


def sketch_alike(a: list[Column], b: list[Column]) -> Column:
    """Holds for all pairs that reach the similarity: at s, of x and y shingles the fewer are
    s times the more at least, and at most (1 - s) / (1 + s) * (x + y) are in one line only.
    In whole numbers, as it must hold at s."""
    tenths = round(10 * SIMILARITY)
    sizes = F.least(a[0], b[0]) * 10 >= F.greatest(a[0], b[0]) * tenths
    differing = reduce(add, (F.bit_count(x.bitwiseXOR(y)) for x, y in zip(a[1:], b[1:])))
    return sizes & (differing * (10 + tenths) <= (a[0] + b[0]) * (10 - tenths))


def bands(signature: np.ndarray) -> np.ndarray:
    """A key for each band, of its number and its bins, shape (lines, BANDS)."""
    s = signature.reshape(len(signature), BANDS, ROWS)
    h = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64) * _ODD, s.shape[:2]).copy()
    for r in range(ROWS):
        h ^= s[:, :, r]
        h *= np.uint64(0xFF51AFD7ED558CCD)
        h ^= h >> np.uint64(32)
    return h.view(np.int64)


def _line_hash(line: str) -> int:
    return xxh64_intdigest(line.encode("utf-8", "surrogatepass"))


def occurrences(docs: DataFrame) -> DataFrame:
    """doc_id, h, at, line, weight, b0, ..., normal: every line with a word; only where it is
    first met in a batch how often the batch has it, the keys of its bands and its text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts(batches, "text", 64):
            rows, at, met, line = [], [], {}, []
            new: list[int] = []
            for i, text in enumerate(batch.column("text")):
                for k, x in enumerate((text.as_py() or "").split("\n")):
                    x = normal(x)
                    if not x:
                        continue
                    rows.append(i)
                    at.append(k)
                    new.append(x not in met)
                    line.append(met[x] if x in met else met.setdefault(x, _line_hash(x)))
            if not rows:
                continue
            texts = pa.array(list(met), pa.string())
            columns = bands(signatures(list(met)))
            # the rank of a new line among the new ones picks its keys; others pick none
            new_ = np.array(new)
            which = pa.array(np.where(new_, np.cumsum(new_) - 1, 0), mask=~new_)
            picked = pa.array(rows, pa.int64())
            first = {x: i for i, x in enumerate(met.values())}
            weight = np.bincount([first[x] for x in line])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").take(picked),
                    batch.column("h").take(picked),
                    pa.array(at, pa.int32()),
                    pa.array(np.array(line, np.uint64).view(np.int64)),
                    pa.array(weight).take(which),
                    *(pa.array(columns[:, b]).take(which) for b in range(columns.shape[1])),
                    texts.take(which),
                ],
                names=["doc_id", "h", "at", "line", "weight", *_BAND_NAMES, "normal"],
            )

    longs = ", ".join(f"{b} bigint" for b in _BAND_NAMES)
    schema = T.StructType([docs.schema["doc_id"], *T.StructType.fromDDL(f"h bigint, at int, line bigint, weight bigint, {longs}, normal string")])
    return map_batches(docs.select("doc_id", "h", "text"), run, schema)


def _sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in parts(batches, "normal", size=1 << 18):
        columns = parities_of(batch.column("normal").to_pylist())
        sketch = {c: pa.array(columns[:, i]) for i, c in enumerate(_SKETCH_NAMES)}
        yield with_columns(batch, ["line", "normal"], **sketch)


def line_texts(seen: DataFrame, wanted: DataFrame) -> DataFrame:
    """line, normal (its text) and its parities, of the wanted lines (column line)."""
    texts = seen.where("normal is not null").select("line", "normal")
    texts = texts.join(sized(keep(wanted)), "line", "left_semi").groupBy("line").agg(F.any_value("normal").alias("normal"))
    return map_batches(texts, _sketched, "line bigint, normal string, " + ", ".join(f"{c} bigint" for c in _SKETCH_NAMES))


def _packed(line: str) -> np.ndarray | None:
    """The different shingles of a line of one-byte characters, each as eight bytes, in order."""
    if len(line) < SHINGLE:
        return None
    try:
        held = line.encode("latin-1")
    except UnicodeEncodeError:
        return None
    runs = np.ndarray(len(held) - SHINGLE + 1, np.uint64, held, strides=(1,)).copy()
    runs.sort()
    new = np.ones(len(runs), bool)
    np.not_equal(runs[1:], runs[:-1], out=new[1:])
    return runs[new]


def _packed_similarity(a: np.ndarray, b: np.ndarray) -> float:
    """``similarity`` of two packed lines: what both have stands twice side by side."""
    every = np.concatenate((a, b))
    every.sort()
    both = int(np.count_nonzero(every[1:] == every[:-1]))
    return both / (len(every) - both)


def _similar(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    packed = WordCache(_packed, 256, 1 << 16)
    plain = WordCache(shingles, 256, 1 << 16)
    for batch in batches:
        linked = []
        for x, y in zip(batch.column("x").to_pylist(), batch.column("y").to_pylist()):
            a, b = packed[x], packed[y]
            s = similarity(plain[x], plain[y]) if a is None or b is None else _packed_similarity(a, b)
            linked.append(s >= SIMILARITY)
        yield batch.select(["a", "b", "ra", "rb"]).filter(pa.array(linked, pa.bool_()))


def prepared(seen: DataFrame):
    """For ``carried_components``: fetches the texts of the lines that may still be joined,
    once for an index, and keeps the pairs (a, b, ra, rb) whose exact similarity reaches
    the threshold."""

    def prepare(live: DataFrame):
        texts = keep(line_texts(seen, live.select(F.col("node").alias("line"))))
        x = texts.select(F.col("line").alias("_x"), F.col("normal").alias("x"))
        y = texts.select(F.col("line").alias("_y"), F.col("normal").alias("y"))

        def verify(pairs: DataFrame) -> DataFrame:
            both = pairs.join(x, pairs["a"] == x["_x"]).join(y, pairs["b"] == y["_y"])
            return map_batches(both.select("a", "b", "ra", "rb", "x", "y"), _similar, "a bigint, b bigint, ra bigint, rb bigint")

        return verify, texts.select(F.col("line").alias("node"), *_SKETCH_NAMES)

    return prepare


def duplicate_lines(docs: DataFrame) -> DataFrame:
    """doc_id, h, gone: for each document (id and hash of its text) the places (from 0,
    between line feeds) of the lines that repeat or resemble an earlier one."""
    # keys and texts hardly repeat
    seen = keep(occurrences(docs), plain=[*_BAND_NAMES, "normal"])
    index = seen.where("normal is not null").select(F.col("line").alias("node"), "weight", *_BAND_NAMES)
    roots = carried_components([index], prepared(seen), sketch_alike, docs.sparkSession)
    # only lines that repeat, or that others resemble, can go
    repeated = seen.groupBy("line").agg(F.count("*").alias("n")).where("n > 1").select(F.col("line").alias("node"), F.col("line").alias("root"))
    several = roots.unionAll(repeated.join(roots, "node", "left_anti")).select(F.col("node").alias("l"), "root")
    several = sized(keep(several))
    places = keep(seen.join(several, seen["line"] == several["l"]).select("doc_id", "h", "at", "root"))
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "h", "at")
    first = places.groupBy("root").agg(F.min(place).alias("first")).withColumnRenamed("root", "r")
    again = places.join(first, places["root"] == first["r"]).where(place != F.col("first"))
    return again.groupBy("doc_id", "h").agg(F.array_sort(F.collect_set("at")).alias("gone"))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All rows and columns of ``docs`` as a struct ``row``, with ``clean`` (the text
    without its repeated lines), n_lines (lines with a word) and n_removed.

    Lines without a word stay. Rows of equal id and text are one document and keep the
    same lines. Equal places cannot occur otherwise. A NULL text stays NULL, an empty one
    empty; a text all of whose lines go is empty. NULL ids come after all others.
    """
    text = F.col(f"`{text_col}`")
    keyed = narrow(docs, doc_id=id_col, text=text_col).withColumn("h", F.xxhash64("text"))
    gone = finished(docs.sparkSession, lambda: duplicate_lines(keyed)).select(F.col("doc_id").alias("g_id"), F.col("h").alias("g_h"), "gone")
    rows = docs.select(F.struct("*").alias("row"), F.col(f"`{id_col}`").alias("k"), F.xxhash64(text).alias("h"))
    # texts pass by the few numbers of their own: no sort
    joined = rows.join(gone.hint("shuffle_hash"), rows["k"].eqNullSafe(gone["g_id"]) & (rows["h"] == gone["g_h"]), "left")
    own = F.col(f"row.`{text_col}`")
    cut = joined.withColumn("_lines", F.split(own, "\n"))
    stay = F.array_except(F.sequence(F.lit(0), F.size("_lines") - 1), "gone")
    left = F.array_join(F.transform(stay, lambda i: F.get(F.col("_lines"), i)), "\n")
    counted = F.size(F.filter("_lines", lambda x: x.rlike(f"[^{_SPACE}]")))
    return cut.select(
        "row",
        F.when(F.col("gone").isNull(), own).otherwise(left).alias("clean"),
        F.greatest(counted, F.lit(0)).cast("long").alias("n_lines"),
        F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_removed"),
    )
