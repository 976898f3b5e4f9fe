"""Benchmark decontamination by greedy string tiling.

Windows of five tokens of the benchmark are the seeds. Documents are scanned once for
windows that a bitmap of the seeds may hold (a fixed number of bits, however large the
benchmark), and an equality join leaves the windows that are seeds. Each pair of a
document and a test item that share a seed is tiled: the longest matches of tokens that
are not yet marked, found by running Karp-Rabin hashes, are marked first, and so on down
to five tokens. The share of the item's tokens under tiles is its coverage; as tiles may
lie in any order, a reordered passage is covered as well. An item of fewer than five tokens
has one seed, all of its tokens, and is covered where they stand together.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from xxhash import xxh64_intdigest

from quotewright.llm.arrow import WordCache, map_batches, narrow, parts
from quotewright.llm.bitmap import bitmap, may_hold
from quotewright.session import keep

LEAST = 5
COVERAGE = 0.5
_BASE = np.uint64(0x9E3779B97F4A7C15)


def _token(piece: str) -> int:
    """A hash of the letters and digits of a piece; 0 where it has none."""
    word = "".join(filter(str.isalnum, piece))
    return xxh64_intdigest(word.encode("utf-8", "surrogatepass")) | 1 if word else 0


class Tokens:
    def __init__(self) -> None:
        self.cache = WordCache(_token)

    def of(self, text: str | None) -> np.ndarray:
        pieces = (text or "").lower().split()
        found = np.fromiter(map(self.cache.__getitem__, pieces), np.uint64, len(pieces))
        return found[found != 0]


def windows(tokens: np.ndarray, size: int = LEAST) -> np.ndarray:
    """A hash of every run of ``size`` tokens."""
    n = len(tokens) - size + 1
    if n < 1:
        return np.zeros(0, np.uint64)
    h = np.zeros(n, np.uint64)
    for j in range(size):
        h = h * _BASE + tokens[j : j + n]
    return h ^ (h >> np.uint64(29))


def tile(item: list[int], segments: list[list[int]], least: int = LEAST) -> list[int]:
    """Lengths of the greedy tiles of an item in a document's segments.

    Runs of a length are compared by a running Karp-Rabin hash and then token by token; a
    match is extended as far as unmarked tokens agree. The longest are marked first, and
    the length halves until ``least``; a match longer than twice the length starts over
    with it.
    """
    text: list[int] = []
    for s in segments:
        text += [*s, -1 - len(text)]  # an end that equals no token
    taken_a, taken_b = [False] * len(item), [False] * len(text)
    tiles: list[int] = []
    size = max(least, min(20, len(item)))
    while True:
        longest, found = _matches(item, text, taken_a, taken_b, size)
        if longest > 2 * size:
            size = longest
            continue
        cut = False
        for length in sorted(found, reverse=True):
            for i, j in found[length]:
                if any(taken_a[i : i + length]) or any(taken_b[j : j + length]):
                    cut = True  # by a tile marked meanwhile: what is left is found again
                    continue
                taken_a[i : i + length] = taken_b[j : j + length] = [True] * length
                tiles.append(length)
        if not cut:
            if size == least:
                return tiles
            size = max(least, size // 2)


def _runs(sequence: list[int], taken: list[bool], size: int) -> Iterator[tuple[int, int]]:
    """Start and running hash of every run of ``size`` unmarked tokens."""
    base, mod = 1_000_003, (1 << 61) - 1
    drop = pow(base, size - 1, mod)
    h = run = 0
    for i, x in enumerate(sequence):
        if taken[i]:
            h = run = 0
            continue
        if run == size:
            h -= sequence[i - size] * drop
            run -= 1
        h = (h * base + x) % mod
        run += 1
        if run == size:
            yield i - size + 1, h


def _matches(a, b, taken_a, taken_b, size) -> tuple[int, dict[int, list[tuple[int, int]]]]:
    places: dict[int, list[int]] = {}
    for start, h in _runs(a, taken_a, size):
        places.setdefault(h, []).append(start)
    found: dict[int, list[tuple[int, int]]] = {}
    longest = 0
    best = [size - 1] * len(a)  # one match a place of the item: its first longest
    for j, h in _runs(b, taken_b, size):
        for i in places.get(h, ()):
            k = best[i]
            # longer than what the place has, or no use
            if i + k >= len(a) or j + k >= len(b) or taken_a[i + k] or taken_b[j + k] or a[i + k] != b[j + k]:
                continue
            n = 0
            while i + n < len(a) and j + n < len(b) and a[i + n] == b[j + n] and not taken_a[i + n] and not taken_b[j + n]:
                n += 1
            if n > best[i]:
                best[i] = n
                found.setdefault(n, []).append((i, j))
                longest = max(longest, n)
    return longest, found


def least_of(tokens: int) -> int:
    """The length of the seeds, and of the least tile, of an item of so many tokens."""
    return max(1, min(LEAST, tokens))


def seeds(benchmark: DataFrame, id_col="item_id", text_col="text") -> DataFrame:
    """item_id, tokens, seeds: the different seeds of every item; of one with fewer than five
    tokens all of them are the seed. Items without a token have none."""
    items = narrow(benchmark, item_id=id_col, text=text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = Tokens()
        for batch in parts(batches, "text"):
            own = [tokens.of(t.as_py()) for t in batch.column("text")]
            lists = [pa.array([t.view(np.int64) for t in own], pa.list_(pa.int64()))]
            lists.append(pa.array([np.unique(windows(t, least_of(len(t)))).view(np.int64) for t in own], pa.list_(pa.int64())))
            yield pa.RecordBatch.from_arrays([batch.column("item_id"), *lists], names=["item_id", "tokens", "seeds"])

    schema = T.StructType([items.schema["item_id"], *T.StructType.fromDDL("tokens array<bigint>, seeds array<bigint>")])
    return map_batches(items, run, schema)


def suspects(docs: DataFrame, bits: np.ndarray, sizes: Sequence[int] = (LEAST,)) -> DataFrame:
    """doc_id, h, at, seed, tokens of the windows of documents, of the ``sizes`` that seeds
    have, that the bitmap has. Of a window under five tokens, which alone covers its item,
    the first in a document will do."""
    shared = docs.sparkSession.sparkContext.broadcast(bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, held, none = Tokens(), shared.value, np.zeros(0, np.int64)
        for batch in parts(batches, "text"):
            rows, at, seed, own = [], [], [], []
            for i, text in enumerate(batch.column("text")):
                t = tokens.of(text.as_py())
                for size in sizes:
                    w = windows(t, size)
                    hit = np.flatnonzero(may_hold(held, w))
                    if size < LEAST:
                        hit = hit[np.unique(w[hit], return_index=True)[1]]
                    rows += [i] * len(hit)
                    at.append(hit)
                    seed.append(w[hit])
                    own += [t[k : k + size].view(np.int64) for k in hit]
            picked = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").take(picked),
                    batch.column("h").take(picked),
                    pa.array(np.concatenate([none, *at]), pa.int64()),
                    pa.array(np.concatenate([none.view(np.uint64), *seed]).view(np.int64), pa.int64()),
                    pa.array(own, pa.list_(pa.int64())),
                ],
                names=["doc_id", "h", "at", "seed", "tokens"],
            )

    schema = T.StructType([docs.schema["doc_id"], *T.StructType.fromDDL("h bigint, at bigint, seed bigint, tokens array<bigint>")])
    return map_batches(docs.select("doc_id", "h", "text"), run, schema)


def _segments(at: list[int], tokens: list[list[int]]) -> list[list[int]]:
    """Runs of overlapping or touching windows as one list of tokens each."""
    out: list[list[int]] = []
    end = -1
    for a, t in sorted(zip(at, tokens)):
        if a > end:
            out.append(list(t))
        else:
            out[-1] += t[end - a :]
        end = a + len(t)
    return out


def _tiled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        covered, tiles = [], []
        for item, hits in zip(batch.column("item").to_pylist(), batch.column("hits").to_pylist()):
            found = tile(item, _segments([x["at"] for x in hits], [x["tokens"] for x in hits]), least_of(len(item)))
            covered.append(sum(found))
            tiles.append(len(found))
        names = ["doc_id", "h", "item_id", "n"]
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(c) for c in names), pa.array(covered, pa.int64()), pa.array(tiles, pa.int64())],
            names=[*names, "covered", "tiles"],
        )


def keyed(docs: DataFrame, id_col="doc_id", text_col="text") -> DataFrame:
    return narrow(docs, doc_id=id_col, text=text_col).withColumn("h", F.xxhash64("text"))


def contaminated(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE, id_col="doc_id", text_col="text") -> DataFrame:
    """doc_id, h (hash of the text), item_id, item_tokens, covered, tiles, coverage of the
    pairs whose coverage reaches the threshold.

    Rows of equal id and text are one document. NULL and empty texts match nothing. An item
    of fewer than five tokens is in every document where all of them stand together, however
    common they are: leave out of the benchmark what is no evidence. Items of one id, or with
    a NULL id, are told apart by their tokens, documents by their text.
    An empty benchmark gives no rows.
    """
    # an id can be NULL or repeat: the tokens' hash tells its rows apart
    items = keep(seeds(benchmark).withColumn("passage", F.xxhash64("tokens")))
    seed = items.select("item_id", "passage", F.explode("seeds").alias("seed")).distinct()
    sizes = items.select(F.least(F.size("tokens"), F.lit(LEAST)).alias("n")).where("n > 0").distinct()
    sizes = sorted(r["n"] for r in sizes.collect())  # five at most
    found = suspects(keyed(docs, id_col, text_col), bitmap(seed, "seed"), sizes)
    hits = keep(found.join(seed.withColumnRenamed("seed", "s"), F.col("seed") == F.col("s")).drop("s", "seed"))
    groups = hits.groupBy("doc_id", "h", "item_id", "passage").agg(F.collect_set(F.struct("at", "tokens")).alias("hits"))
    item = items.select(F.col("item_id").alias("i"), F.col("passage").alias("p"), F.col("tokens").alias("item"), F.size("tokens").cast("long").alias("n")).distinct()
    same = groups["item_id"].eqNullSafe(item["i"]) & (groups["passage"] == item["p"])
    # no more tokens can be covered than the windows hold: most chance pairs end here
    pairs = groups.join(item, same).where(F.size("hits") * LEAST >= coverage * F.col("n")).drop("i", "p")
    head = [pairs.schema[c] for c in ("doc_id", "h", "item_id", "n")]
    schema = T.StructType([*head, T.StructField("covered", T.LongType()), T.StructField("tiles", T.LongType())])
    done = map_batches(pairs.select("doc_id", "h", "item_id", "n", "item", "hits"), _tiled, schema)
    done = done.withColumn("coverage", F.col("covered") / F.col("n")).where(F.col("coverage") >= coverage)
    return done.withColumnRenamed("n", "item_tokens")


def decontaminate(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE, id_col="doc_id", text_col="text") -> DataFrame:
    """``docs`` without the documents that contain a test item; all columns as they are,
    whatever their names. NULL and empty texts stay, as do all rows of an empty benchmark."""
    bad = keep(contaminated(docs, benchmark, coverage, id_col, text_col).select(F.col("doc_id").alias("bad"), F.col("h").alias("bad_h")).distinct())
    # other columns may have any name: they are one struct in the join
    rows = docs.select(F.struct("*").alias("row"), F.col(f"`{id_col}`").alias("id"), F.xxhash64(F.col(f"`{text_col}`")).alias("h"))
    same = rows["id"].eqNullSafe(bad["bad"]) & (rows["h"] == bad["bad_h"])
    return rows.join(bad, same, "left_anti").select("row.*")
