"""SimHash near-duplicates over deletion-variant signatures.

A fingerprint is cut into three segments: of four differing bits some segment has at
most one. Each segment is indexed with every one of its bits as a wildcard (64 variants
in all), so two fingerprints that may link share an indexed variant; an equality join
finds them and the differing bits are counted. Copies are one fingerprint before any
join, and groups of near copies are linked by ``bucket_components`` without all pairs.

A variant has about 20 free bits, so its bucket grows with the corpus. From ``DEEP``
fingerprints on, a second, equal way is cheaper: where a segment has a wrong bit, at most
three others are wrong, so of four pieces of the rest one agrees (of five, where the segment
has none), and a variant takes the piece as well: 31 free bits, about 270 variants. The
segments then follow one another with the components carried on, so that the variants of
one of them are shuffled at a time.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T
from xxhash import xxh64_intdigest

from quotewright.llm.arrow import map_batches, narrow, parts, with_columns
from quotewright.llm.components import bucket_components, carried_components, rooted
from quotewright.session import keep

BITS, DISTANCE, SHINGLE, SEED = 64, 4, 4, 42
# fingerprints from which on a fourfold index costs less than the pairs in its buckets
DEEP = 1 << 28
_SHIFTS = np.arange(8, dtype=np.uint64)[:, None]
_LOW = np.uint64(0x0101010101010101)


def fingerprint(text: bytes, size: int = SHINGLE, seed: int = SEED) -> int:
    """A bit is set if over half of the shingles' hashes have it; 0 without words."""
    words = text.lower().split()  # of bytes: A-Z only, and the six ASCII blanks
    if not words:
        return 0
    line = b" ".join(words)
    if len(words) <= size:
        return xxh64_intdigest(line, seed)
    lengths = np.fromiter(map(len, words), np.int64, len(words)) + 1
    ends = np.cumsum(lengths) - 1
    starts = (ends - lengths + 1)[: len(words) - size + 1].tolist()
    hashes = [xxh64_intdigest(line[a:b], seed) for a, b in zip(starts, ends[size - 1 :].tolist())]
    n = len(hashes)
    # eight bits of each byte at a time, added up bytewise in runs short enough for a byte
    spread = (np.array(hashes, np.uint64) >> _SHIFTS) & _LOW
    sums = np.add.reduceat(spread, np.arange(0, n, 255), axis=1)
    counts = np.ascontiguousarray(sums).view(np.uint8).reshape(8, -1, 8).sum(axis=1, dtype=np.int64).T.ravel()
    return sum(1 << i for i in np.flatnonzero(2 * counts > n).tolist())


def fingerprints(rows: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """``rows`` with fp (the fingerprint of ``text`` as a signed long) in place of text;
    NULL texts are empty."""
    rows = rows.withColumn("text", F.coalesce("text", F.lit("")).cast("binary"))
    kept = [c for c in rows.columns if c != "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts(batches, "text"):
            found = np.array([fingerprint(t.as_py(), shingle) for t in batch.column("text")], np.uint64)
            yield with_columns(batch, kept, fp=pa.array(found.view(np.int64)))

    schema = rows.drop("text").schema.add("fp", T.LongType())
    return map_batches(rows, run, schema)


def segments(distance: int = DISTANCE) -> list[tuple[int, int]]:
    """First bit and end of each segment: with so many, one differs by at most one bit."""
    n = distance // 2 + 1
    if n < 2:
        raise ValueError("two segments at least: the distance has to be 2 or more")
    edges = [BITS * k // n for k in range(n + 1)]
    return list(zip(edges, edges[1:]))


def variants(fp: Column, distance: int = DISTANCE) -> Column:
    """The indexed variants, a long each: for every bit of the fingerprint its place,
    and below it its segment's value without the bit."""
    keys = []
    for low, high in segments(distance):
        for bit in range(low, high):
            mask = ((1 << (high - low)) - 1) & ~(1 << (bit - low))
            keys.append(F.shiftrightunsigned(fp, low).bitwiseAND(F.lit(mask)).bitwiseOR(F.lit(bit << 40)))
    return F.array(*keys)


def deep_variants(fp: Column, low: int, high: int, distance: int = DISTANCE) -> Column:
    """The variants of one segment, each with a piece of the other bits: the whole segment
    with one of ``distance + 1`` pieces, and the segment without one of its bits with one of
    ``distance`` pieces. A long holds the segment below, the piece above it, and on top which
    of them it is."""
    size, others = high - low, BITS - (high - low)
    own = F.shiftrightunsigned(fp, low).bitwiseAND(F.lit((1 << size) - 1))
    rest = fp.bitwiseAND(F.lit((1 << low) - 1))
    if high < BITS:
        rest = rest.bitwiseOR(F.shiftleft(F.shiftrightunsigned(fp, high), low))

    def keys(segment: Column, pieces: int, kind: int) -> list[Column]:
        ends = [others * k // pieces for k in range(pieces + 1)]
        cut = [F.shiftrightunsigned(rest, a).bitwiseAND(F.lit((1 << (b - a)) - 1)) for a, b in zip(ends, ends[1:])]
        tops = [(kind * (distance + 1) + k) << 48 for k in range(pieces)]
        return [segment.bitwiseOR(F.shiftleft(c, 32)).bitwiseOR(F.lit(top)) for c, top in zip(cut, tops)]

    out = keys(own, distance + 1, 0)
    for bit in range(size):
        out += keys(own.bitwiseAND(F.lit(((1 << size) - 1) & ~(1 << bit))), distance, 1 + bit)
    return F.array(*out)


def linked(prints: DataFrame, distance: int = DISTANCE, deep: int = DEEP) -> DataFrame:
    """fp, root: the smallest fingerprint reachable from each of ``prints``. From ``deep``
    different fingerprints on by ``deep_variants``: the same components."""
    own = keep(prints.groupBy("fp").agg(F.count("*").alias("weight")))
    if own.count() >= deep:
        indexes = (
            own.select(F.col("fp").alias("node"), "weight", F.explode(deep_variants(F.col("fp"), low, high, distance)).alias("key"))
            for low, high in segments(distance)
        )
        alike = lambda a, b: F.bit_count(a[0].bitwiseXOR(b[0])) <= distance
        roots = carried_components(indexes, lambda live: (lambda pairs: pairs, None), alike, prints.sparkSession)
        return keep(_least_of_root(rooted(own.select("fp"), roots, "fp", "root")))
    nodes = own.select(F.col("fp").alias("node"), "weight").withColumn("keys", variants(F.col("node"), distance))
    close = lambda a, b: F.bit_count(a.bitwiseXOR(b)) <= distance
    return keep(rooted(own.select("fp"), bucket_components(nodes, close), "fp", "root"))


def _least_of_root(prints: DataFrame) -> DataFrame:
    """Carried roots name a component by any of its fingerprints: here by the smallest."""
    least = prints.groupBy("root").agg(F.min("fp").alias("least")).withColumnRenamed("root", "r")
    return prints.join(least, prints["root"] == least["r"]).select("fp", F.col("least").alias("root"))


def _of_component(prints: DataFrame, roots: DataFrame, value: Column) -> DataFrame:
    """The least ``value`` (an aggregate's argument) of each component, as ``least``, by
    every fingerprint ``f`` of it. Copies combine by fingerprint first."""
    by_print = prints.groupBy("fp").agg(F.min(value).alias("least")).withColumnRenamed("fp", "p")
    named = roots.join(by_print, roots["fp"] == by_print["p"])
    by_root = named.groupBy("root").agg(F.min("least").alias("least")).withColumnRenamed("root", "r")
    return roots.join(by_root, roots["root"] == by_root["r"]).select(F.col("fp").alias("f"), "least")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE, id_col="doc_id", text_col="text") -> DataFrame:
    """doc_id, fingerprint, component_id of every row.

    component_id is the smallest doc_id reachable by links of ``distance`` or fewer
    differing bits. NULL and empty texts have fingerprint 0 and link like others; NULL ids
    never name a component that has another; repeated rows stay; an empty table gives no
    rows.
    """
    prints = keep(fingerprints(narrow(docs, doc_id=id_col, text=text_col), shingle))
    ids = _of_component(prints, linked(prints, distance), F.col("doc_id"))
    out = prints.join(ids, prints["fp"] == ids["f"])
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.col("least").alias("component_id"))


def one_per_group(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE, id_col="doc_id", text_col="text") -> DataFrame:
    """``docs`` with one row of each component: that of the smallest id (NULL last; then
    by a hash of id and text). Of rows equal in both any one stays. All columns as they are."""
    text = F.col(f"`{text_col}`")
    k1, k2 = F.xxhash64(F.col(f"`{id_col}`").cast("string"), text), F.hash(text)
    rows = narrow(docs, doc_id=id_col, text=text_col)
    keyed = rows.select("doc_id", "text", F.xxhash64(F.col("doc_id").cast("string"), "text").alias("k1"), F.hash("text").alias("k2"))
    prints = keep(fingerprints(keyed, shingle))
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "k1", "k2")
    first = _of_component(prints, linked(prints, distance), place).select("least.k1", "least.k2").distinct()
    packed = docs.select(F.struct("*").alias("row"), k1.alias("k1"), k2.alias("k2")).join(first, ["k1", "k2"])
    nth = F.row_number().over(W.partitionBy("k1", "k2").orderBy("k1"))
    return packed.withColumn("nth", nth).where("nth = 1").select("row.*")
