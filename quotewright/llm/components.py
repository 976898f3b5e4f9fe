"""Connected components and links within buckets, distributed."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quotewright.llm.arrow import map_batches
from quotewright.session import finished, keep


def components(edges: DataFrame) -> DataFrame:
    """node, root of every node of the edges (a, b: long); the root is the smallest node.

    Distributed union-find by alternating large and small stars: every node passes the
    smallest neighbour it knows to its larger, then to its smaller neighbours, until all
    edges point from a node to its root. A round is a partial minimum and a join for each
    star, written to the shared folder; the number of rounds grows with the logarithm of
    the largest component. A hub's edges are spread: the minimum combines before the
    shuffle and the join splits hot keys. Self loops and repeated edges change nothing.
    """
    forest = keep(
        edges.where("a <> b").select(F.greatest("a", "b").alias("high"), F.least("a", "b").alias("low")).distinct()
    )
    while not _all_stars(forest):
        both = forest.select(F.col("high").alias("u"), F.col("low").alias("v")).unionAll(forest.select("low", "high"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("w"), F.least("u", "m").alias("m"))
        large = both.join(least, both["u"] == least["w"]).where("v > u").select(F.col("v").alias("high"), F.col("m").alias("low"))
        large = keep(large.distinct())
        least = large.groupBy("high").agg(F.min("low").alias("m")).select(F.col("high").alias("w"), "m")
        passed = large.join(least, large["high"] == least["w"]).where("low <> m").select(F.col("low").alias("high"), F.col("m").alias("low"))
        forest = keep(passed.unionAll(least.select(F.col("w").alias("high"), F.col("m").alias("low"))).distinct())
    roots = forest.select(F.col("low").alias("node"), F.col("low").alias("root")).distinct()
    return forest.select(F.col("high").alias("node"), F.col("low").alias("root")).unionAll(roots)


def _all_stars(forest: DataFrame) -> bool:
    """Every node has one lower neighbour or is only ever the lower one."""
    ends = forest.select(F.col("high").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down"))
    ends = ends.unionAll(forest.select("low", F.lit(0), F.lit(1)))
    per_node = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return per_node.where("up > 1 or (up = 1 and down = 1)").isEmpty()


def rooted(nodes: DataFrame, roots: DataFrame, node: str, name: str) -> DataFrame:
    """``nodes`` with the root of column ``node`` as ``name``; a node without edges is its own."""
    r = roots.select(F.col("node").alias("_node"), F.col("root").alias("_root"))
    return nodes.join(r, nodes[node] == r["_node"], "left").withColumn(name, F.coalesce("_root", node)).drop("_node", "_root")


def bucket_components(
    nodes: DataFrame,
    close: Callable[[Column, Column], Column],
    verify: Callable[[DataFrame], DataFrame] = lambda pairs: pairs,
    salt: int = 4096,
    sketch: Sequence[str] = (),
    alike: Callable[[list[Column], list[Column]], Column] = lambda a, b: F.lit(True),
) -> DataFrame:
    """node, root over all pairs of ``nodes`` (node, weight, keys: the buckets it is in)
    that share a bucket and are close: the links' components, without making all pairs.

    ``close`` is a cheap exact or necessary test on two nodes, part of the joins;
    ``verify`` keeps the linked ones of distinct pairs (a, b). Columns ``sketch`` of the
    nodes, where given, go into the second join below for a further test, ``alike``.

    First every member meets its bucket's heaviest node only; that links most of a group
    of near copies. Then, in buckets of three and more, members outside the heaviest node's
    component meet all members of other components but that node: exactly the pairs that
    could still join two components. Large buckets are salted into
    blocks of ``salt`` members for this. So no link is lost, and pairs within a component
    cost nothing.
    """
    # a node has many index entries: few nodes a task, so that its entries fit in memory
    nodes = nodes.repartition(int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    index = nodes.select("node", "weight", F.explode("keys").alias("key"))
    stats = index.groupBy("key").agg(F.count("*").alias("n"), F.max_by("node", "weight").alias("rep")).where("n > 1")
    stats = keep(stats.withColumnRenamed("key", "s_key"))
    near = (index["key"] == stats["s_key"]) & (index["node"] != stats["rep"]) & close(index["node"], stats["rep"])
    star = index.join(stats, near).select(F.col("node").alias("a"), F.col("rep").alias("b")).distinct()
    first = keep(components(verify(star)))

    # roots join the nodes, not their many index entries
    index = rooted(nodes, first, "node", "root").select("node", "root", F.explode("keys").alias("key"))
    large = rooted(stats.where("n > 2"), first, "rep", "rep_root").withColumn("blocks", F.ceil(F.col("n") / salt))
    apart = (index["key"] == large["s_key"]) & (index["root"] != large["rep_root"])
    minor = keep(index.join(large, apart).drop("s_key", "rep_root", "n"))
    # sketches join the few members that are left, not the index
    drawn = nodes.select(F.col("node").alias("d_node"), *sketch)

    def sketched(df: DataFrame) -> DataFrame:
        return df.join(drawn, df["node"] == drawn["d_node"]) if sketch else df

    keys = minor.select(F.col("key").alias("m_key"), "blocks", "rep").distinct()
    other = sketched(index.join(keys, (index["key"] == keys["m_key"]) & (index["node"] != keys["rep"]))).select(
        F.col("m_key").alias("o_key"),
        F.col("node").alias("b"),
        F.col("root").alias("b_root"),
        F.pmod(F.xxhash64("node"), "blocks").alias("o_salt"),
        *(F.col(c).alias(f"b_{c}") for c in sketch),
    )
    minor = sketched(minor).select(
        "key",
        F.col("node").alias("a"),
        F.col("root").alias("a_root"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("salt"),
        *(F.col(c).alias(f"a_{c}") for c in sketch),
    )
    meet = (
        (minor["key"] == other["o_key"])
        & (minor["salt"] == other["o_salt"])
        & (minor["a_root"] != other["b_root"])
        & close(minor["a"], other["b"])
        & alike([minor[f"a_{c}"] for c in sketch], [other[f"b_{c}"] for c in sketch])
    )
    pairs = minor.join(other, meet).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    bridges = rooted(rooted(verify(pairs), first, "a", "ra"), first, "b", "rb")
    second = components(bridges.select(F.col("ra").alias("a"), F.col("rb").alias("b")))
    joined = rooted(first.withColumnRenamed("root", "mid"), second, "mid", "root").select("node", "root")
    # nodes that only the second round linked
    new = second.join(first, "node", "left_anti")
    return keep(joined.unionAll(new.select("node", "root")))


def sized(df: DataFrame, most: int = 1_000_000) -> DataFrame:
    """``df`` (written, a few numbers a row) marked for broadcast if it has ``most`` rows or
    fewer; a larger one is joined by a shuffle."""
    return F.broadcast(df) if df.limit(most + 1).count() <= most else df


# entries of an index that a task packs at once
_ENTRIES = 1 << 20


def _ends(key: np.ndarray, node: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each key once, with its least and its greatest node."""
    order = np.argsort(key)
    key, node = key[order], node[order]
    starts = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
    return key[starts], np.minimum.reduceat(node, starts), np.maximum.reduceat(node, starts)


def shared_keys(index: DataFrame) -> DataFrame:
    """key: the keys that two different nodes or more have in ``index``, whose columns are
    node and one or more for keys, none of them NULL.

    Nearly all keys are of one node, which a hash aggregate would hold row by row on both
    sides of the shuffle. So tasks send, for each class of keys, their different keys with
    two nodes at most as one row of packed numbers, however often a key comes; a class is
    compared as arrays. Classes are eight to a partition, so that they deal out evenly.
    """
    classes = 8 * int(index.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    at_once = _ENTRIES // (len(index.columns) - 1)

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for node, *keys in _gathered(batches, at_once):
            key, low, high = _ends(np.concatenate(keys), np.tile(node, len(keys)))
            several = low != high
            key, node = np.concatenate((key, key[several])), np.concatenate((low, high[several]))
            mixed = key.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(32)
            at = (mixed * np.uint64(classes) >> np.uint64(32)).astype(np.uint16 if classes < 1 << 16 else np.int64)
            order = np.argsort(at, kind="stable")
            count = np.bincount(at, minlength=classes)
            own = np.flatnonzero(count)
            ends = pa.py_buffer(np.concatenate(([0], np.cumsum(count[own]) * 8)).astype(np.int32))
            blobs = (pa.Array.from_buffers(pa.binary(), len(own), [None, ends, pa.py_buffer(x[order])]) for x in (key, node))
            yield pa.RecordBatch.from_arrays([pa.array(own.astype(np.int64)), *blobs], names=["class", "keys", "nodes"])

    def shared(table: pa.Table) -> pa.Table:
        key, node = (np.frombuffer(b"".join(x.as_py() for x in table.column(c)), np.int64) for c in ("keys", "nodes"))
        key, low, high = _ends(key, node)
        return pa.table({"key": key[low != high]})

    rows = map_batches(index, packed, "class bigint, keys binary, nodes binary")
    return rows.groupBy("class").applyInArrow(shared, "key bigint")


def _gathered(batches: Iterable[pa.RecordBatch], most: int) -> Iterator[tuple[np.ndarray, ...]]:
    """The columns of about ``most`` rows at a time."""
    held, rows = [], 0
    for batch in batches:
        if batch.num_rows:
            held.append([c.to_numpy(zero_copy_only=False) for c in batch.columns])
            rows += batch.num_rows
        if rows >= most:
            yield tuple(map(np.concatenate, zip(*held)))
            held, rows = [], 0
    if held:
        yield tuple(map(np.concatenate, zip(*held)))


def carried_components(
    indexes: Iterable[DataFrame],
    prepare: Callable[[DataFrame], tuple[Callable[[DataFrame], DataFrame], DataFrame | None]],
    alike: Callable[[list[Column], list[Column]], Column],
    spark: SparkSession,
    salt: int = 4096,
) -> DataFrame:
    """node, root over all verified pairs that share a key in some index (node, weight and one
    or more columns of keys; where a node has a key several times, the weights add up), as ``bucket_components`` finds them, one index after the other: what one has joined costs
    the next nothing, and only one index is shuffled at a time.

    ``prepare`` gets the nodes of buckets that still hold several components and returns
    the verification of pairs (a, b, ...) and a table (node, sketch columns) for ``alike``;
    with no such table (None) the nodes themselves are what ``alike`` compares.
    """
    roots = spark.createDataFrame([], "node bigint, root bigint")
    for index in indexes:
        roots = finished(spark, partial(_with_links, roots, index, prepare, alike, salt))
    return roots


def _mapped(df: DataFrame, column: str, new: DataFrame) -> DataFrame:
    """``column``, a root, replaced by the root that ``new`` (node, root) gives it."""
    n = new.select(F.col("node").alias("_old"), F.col("root").alias("_new"))
    return df.join(n, df[column] == n["_old"], "left").withColumn(column, F.coalesce("_new", column)).drop("_old", "_new")


def _with_links(roots, index, prepare, alike, salt) -> DataFrame:
    keys = [c for c in index.columns if c not in ("node", "weight")]
    several = sized(keep(shared_keys(index.select("node", *keys)).withColumnRenamed("key", "s_key")))
    index = index.select("node", "weight", F.explode(F.array(*keys)).alias("key"))
    members = index.join(several, index["key"] == several["s_key"])
    members = members.groupBy("node", "key").agg(F.sum("weight").alias("weight"))
    members = keep(rooted(members, roots, "node", "root"))
    rep = F.max_by(F.struct("node", "root"), F.struct("weight", "node")).alias("rep")
    ends = (F.count("*").alias("n"), F.min("root").alias("low"), F.max("root").alias("high"))
    open_ = members.groupBy("key").agg(rep, *ends).where("low <> high")
    open_ = open_.select(F.col("key").alias("o_key"), F.col("rep.node").alias("rep"), F.col("rep.root").alias("rep_root"), "n")
    live = keep(members.join(open_, members["key"] == open_["o_key"]).drop("o_key", "weight"))
    if live.isEmpty():
        return roots
    verify, sketches = prepare(live.select("node").distinct())
    names = [c for c in sketches.columns if c != "node"] if sketches else []
    star = live.where("root <> rep_root").select(
        F.col("node").alias("a"), F.col("rep").alias("b"), F.col("root").alias("ra"), F.col("rep_root").alias("rb")
    )
    if sketches:
        sides = [sketches.select(F.col("node").alias(f"{x}_node"), *(F.col(c).alias(f"{x}_{c}") for c in names)) for x in "ab"]
        star = star.distinct().join(sides[0], F.col("a") == F.col("a_node")).join(sides[1], F.col("b") == F.col("b_node"))
        star = star.where(alike(*([F.col(f"{x}_{c}") for c in names] for x in "ab"))).select("a", "b", "ra", "rb")
    else:
        star = star.where(alike([F.col("a")], [F.col("b")])).distinct()
    joined = keep(components(verify(star).select(F.col("ra").alias("a"), F.col("rb").alias("b"))))

    left = keep(_mapped(_mapped(live.where("n > 2"), "root", joined), "rep_root", joined).where("node <> rep"))
    minor = left.where("root <> rep_root")
    if not minor.isEmpty():
        if sketches:
            drawn = sketches.withColumnRenamed("node", "d_node")
            left = left.join(drawn, left["node"] == drawn["d_node"]).drop("d_node")
        left = keep(left.withColumn("blocks", F.ceil(F.col("n") / salt)))
        keys = minor.select("key").distinct()
        other = left.join(keys, "key", "left_semi").select(
            F.col("key").alias("o_key"), F.col("node").alias("b"), F.col("root").alias("rb"),
            F.pmod(F.xxhash64("node"), "blocks").alias("o_salt"), *(F.col(c).alias(f"b_{c}") for c in names),
        )
        minor = left.where("root <> rep_root").select(
            "key", F.col("node").alias("a"), F.col("root").alias("ra"),
            F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("salt"), *(F.col(c).alias(f"a_{c}") for c in names),
        )
        meet = (minor["key"] == other["o_key"]) & (minor["salt"] == other["o_salt"]) & (minor["ra"] != other["rb"])
        compared = [[minor[f"a_{c}"] for c in names], [other[f"b_{c}"] for c in names]] if sketches else [[minor["a"]], [other["b"]]]
        meet = meet & alike(*compared)
        ordered = F.when(F.col("a") < F.col("b"), F.struct("a", "b", "ra", "rb")).otherwise(
            F.struct(F.col("b").alias("a"), F.col("a").alias("b"), F.col("rb").alias("ra"), F.col("ra").alias("rb"))
        )
        pairs = keep(minor.join(other, meet).select(ordered.alias("p")).select("p.*").distinct())
        second = keep(components(verify(pairs).select(F.col("ra").alias("a"), F.col("rb").alias("b"))))
        joined = _mapped(joined, "root", second).unionAll(second.join(joined.select("node"), "node", "left_anti"))
    before = _mapped(roots, "root", joined)
    return keep(before.unionAll(joined.join(roots.select("node"), "node", "left_anti").select("node", "root")))
