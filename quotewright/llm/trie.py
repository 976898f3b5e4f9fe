"""The prefix trie of conversations by digests of fixed-length blocks of turns.

A turn is the digest of its role and text, a prefix the sum of its turns' digests times
powers of a base, modulo a prime (with two bases, 122 bits in all). Such sums can be put
together, so the turns of a conversation need not meet in one task: ranges of the order
(conversation, turn) are summed apart and carry on from the ranges before them.

Turns go to blocks of four. Conversations are grouped by their successive block digests:
equal blocks after equal prefixes are one row with a count, however many copies there are.
A block without siblings makes its nodes as it is; only where blocks diverge after the
same prefix are their turns grouped again, to find the turn at which they part. Sums over
subtrees double their reach in each round, so rounds grow with the logarithm of the depth.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quotewright.llm.arrow import map_batches, narrow
from quotewright.session import keep

BLOCK = 4
_PRIME = (1 << 61) - 1
_BASES = (0x1B873593CC9E2D51 % _PRIME, 0x2545F4914F6CDD1D % _PRIME)
_CHUNK = 4096
_KEYS = ("p1", "p2", "q1", "q2")


def _lists(batch: pa.RecordBatch, *names: str) -> list[list]:
    return [batch.column(n).to_pylist() for n in names]


def _record(**columns: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns.values()], names=list(columns))


def _longs(*names: str) -> str:
    return ", ".join(f"{n} bigint" for n in names)


def _sum_ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Place, prefix and parent's prefix of every turn within its conversation's run in
    this range, which is in order."""
    current = None
    n = a = b = 0
    for batch in batches:
        conv, part, size, v1, v2 = _lists(batch, "conv", "part", "bytes", "v1", "v2")
        at, p1, p2, q1, q2 = [], [], [], [], []
        for c, x, y in zip(conv, v1, v2):
            if c != current:
                current, n, a, b = c, 0, 0, 0
            q1.append(a)
            q2.append(b)
            n, a, b = n + 1, (a * _BASES[0] + x) % _PRIME, (b * _BASES[1] + y) % _PRIME
            at.append(n)
            p1.append(a)
            p2.append(b)
        yield _record(conv=conv, part=part, at=at, bytes=size, p1=p1, p2=p2, q1=q1, q2=q2)


def _carry(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each later range of a conversation: the turns and the prefix before it."""
    for batch in batches:
        out = []
        for conv, runs in zip(*_lists(batch, "conv", "runs")):
            n = a = b = 0
            for run in runs:
                if n:
                    out.append((conv, run["part"], n, a, b))
                n += run["at"]
                a = (a * pow(_BASES[0], run["at"], _PRIME) + run["p1"]) % _PRIME
                b = (b * pow(_BASES[1], run["at"], _PRIME) + run["p2"]) % _PRIME
        names = ("conv", "part", "before", "c1", "c2")
        yield _record(**dict(zip(names, zip(*out) if out else [[]] * 5)))


def _moved(rows: DataFrame, *kept: str) -> DataFrame:
    """``kept`` columns (longs), and the prefixes p and q (the parent's) behind another
    prefix, whose sums ``add`` count times the base to the power of ``steps``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = dict(zip(kept, _lists(batch, *kept)))
            (steps,) = _lists(batch, "steps")
            for k, base in enumerate(_BASES, 1):
                p, q, add = _lists(batch, f"p{k}", f"q{k}", f"add{k}")
                low = [a % _PRIME * pow(base, s - 1, _PRIME) if a else 0 for a, s in zip(add, steps)]
                columns[f"p{k}"] = [(x + m * base) % _PRIME for x, m in zip(p, low)]
                columns[f"q{k}"] = [(x + m) % _PRIME for x, m in zip(q, low)]
            yield _record(**columns)

    return map_batches(rows, run, _longs(*kept, "p1", "q1", "p2", "q2"))


def chains(conversations: DataFrame, conv_id="conv_id", turn="turn", role="role", text="text") -> DataFrame:
    """conv, at (from 1), bytes (of the text), p1, p2 (the prefix up to the turn), q1, q2
    (up to the one before). Turns are in the order of ``turn``, NULL first; of equal ones
    by the MD5 digest of role and text."""
    rows = narrow(conversations, conv=conv_id, turn=turn, role=role, text=text).where("conv is not null")
    said, by = F.coalesce("text", F.lit("")), F.coalesce("role", F.lit(""))
    digest = F.md5(F.concat(F.length(by).cast("string"), F.lit(":"), by, said).cast("binary"))
    rows = rows.select(F.col("conv").cast("long"), "turn", digest.alias("digest"), F.octet_length(said).cast("long").alias("bytes"))
    # the reading task spreads copies of one row over ranges
    rows = rows.withColumn("task", F.spark_partition_id())
    order = ["conv", F.col("turn").asc_nulls_first(), "digest", "task"]
    ranges = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = rows.repartitionByRange(ranges, *order).sortWithinPartitions(*order)
    half = [(F.conv(F.substring("digest", at, 15), 16, 10).cast("long") + 1).alias(v) for at, v in ((1, "v1"), (17, "v2"))]
    ranged = ranged.select("conv", F.spark_partition_id().cast("long").alias("part"), "bytes", *half)
    runs = keep(map_batches(ranged, _sum_ranges, _longs("conv", "part", "at", "bytes", *_KEYS)))
    ends = runs.groupBy("conv", "part").agg(F.max(F.struct("at", "p1", "p2")).alias("end"))
    # as many runs as ranges at most, and few conversations have several
    listed = ends.groupBy("conv").agg(F.array_sort(F.collect_list(F.struct("part", "end.at", "end.p1", "end.p2"))).alias("runs"))
    carried = map_batches(listed.where(F.size("runs") > 1), _carry, _longs("conv", "part", "before", "c1", "c2"))
    carried = carried.withColumnsRenamed({"conv": "c_conv", "part": "c_part"})
    both = runs.join(carried, (runs["conv"] == carried["c_conv"]) & (runs["part"] == carried["c_part"]), "left")
    added = {f"add{k}": F.coalesce(f"c{k}", F.lit(0)).cast("long") for k in (1, 2)}
    both = both.withColumns({**added, "steps": F.col("at"), "at": F.col("at") + F.coalesce("before", F.lit(0))})
    return keep(_moved(both, "conv", "at", "bytes"))


def lengths(chained: DataFrame) -> DataFrame:
    """conv, n: turns of each conversation."""
    return chained.groupBy("conv").agg(F.max("at").alias("n"))


def spliced(chained: DataFrame, base: Column, taken: Column, most: int) -> tuple[DataFrame, DataFrame]:
    """Chains and lengths of conversations rebuilt from the first ``taken`` turns (``most``
    at most) of conversation ``base``, then their own after their first ``taken``; both are
    expressions of ``conv``. A rebuilt conversation may have no turns."""
    first = F.when(F.col("at") <= most, F.struct("at", "bytes", *_KEYS))
    convs = keep(chained.groupBy("conv").agg(F.max("at").alias("n"), F.array_sort(F.collect_list(first)).alias("head")))
    own = convs.withColumns({"base": base, "taken": taken.cast("long")})
    heads = convs.select(F.col("conv").alias("b_conv"), F.col("head").alias("b_head"))
    taken_head = F.coalesce(F.slice("b_head", F.lit(1), F.col("taken").cast("int")), F.slice("head", 1, 0))
    end = lambda head, n, k: F.coalesce(F.get(head, n.cast("int") - 1)[f"p{k}"], F.lit(0))
    met = own.join(heads, own["base"] == heads["b_conv"], "left").withColumn("b_head", taken_head)
    size = F.size("b_head").cast("long")
    met = met.select(
        "conv", "taken", "b_head", size.alias("shift"), (size + F.greatest(F.col("n") - F.col("taken"), F.lit(0))).alias("n"),
        *((end(F.col("b_head"), size, k) - end(F.col("head"), F.col("taken"), k)).alias(f"add{k}") for k in (1, 2)),
    )
    met = keep(met)
    inherited = met.select("conv", "n", F.explode("b_head").alias("t")).select("conv", "t.at", "t.bytes", "n", *(f"t.{k}" for k in _KEYS))
    own = met.select(F.col("conv").alias("m_conv"), "taken", "shift", "n", "add1", "add2")
    rest = chained.join(own, chained["conv"] == own["m_conv"]).where("at > taken")
    rest = rest.withColumns({"steps": F.col("at") - F.col("taken"), "at": F.col("at") - F.col("taken") + F.col("shift")})
    columns = ["conv", "at", "bytes", "n", *_KEYS]
    rebuilt = inherited.select(columns).unionAll(_moved(rest, "conv", "at", "bytes", "n").select(columns))
    return keep(rebuilt.drop("n")), met.select("conv", "n")


def _joined_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of ids of one node, in order, as text: some thousand ids a row."""
    rows: list[tuple] = []
    current, ids = None, []

    def close() -> None:
        if ids:
            rows.append((*current, ids[0], ",".join(map(str, ids))))
            ids.clear()

    def packed() -> pa.RecordBatch:
        columns = zip(*rows) if rows else [[]] * 5
        kinds = [pa.int64()] * 4 + [pa.string()]
        out = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["depth", "p1", "p2", "first", "ids"])
        rows.clear()
        return out

    for batch in batches:
        for *key, conv in zip(*_lists(batch, "depth", "p1", "p2", "conv")):
            if key != current or len(ids) == _CHUNK:
                close()
                current = key
            ids.append(conv)
        yield packed()
    close()
    yield packed()


def _digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The digest of each node's texts, which come in order."""
    names, kinds = ["e_depth", "e_p1", "e_p2", "ends_sha256"], [pa.int64()] * 3 + [pa.string()]
    current, digest, done = None, None, []

    def packed() -> pa.RecordBatch:
        out = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*done) if done else [[]] * 4, kinds)], names=names)
        done.clear()
        return out

    for batch in batches:
        for *key, ids in zip(*_lists(batch, "depth", "p1", "p2", "ids")):
            if key != current:
                if current is not None:
                    done.append((*current, digest.hexdigest()))
                current, digest = key, sha256()
            else:
                digest.update(b",")
            digest.update(ids.encode())
        yield packed()
    if current is not None:
        done.append((*current, digest.hexdigest()))
    yield packed()


def ends_digests(ends: DataFrame) -> DataFrame:
    """e_depth, e_p1, e_p2, ends_sha256: of each node (depth, p1, p2) the digest of the ids
    (conv) that end there, ascending. Ids are sorted and joined in ranges; only the joined
    texts of a node, one row for some thousand ids, stream through one task, since a SHA-256
    can only be taken in order."""
    order = ["depth", "p1", "p2", "conv"]
    ranges = int(ends.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sorted_ = ends.select(order).repartitionByRange(ranges, *order).sortWithinPartitions(*order)
    texts = map_batches(sorted_, _joined_ids, "depth bigint, p1 bigint, p2 bigint, first bigint, ids string")
    together = texts.repartition("depth", "p1", "p2").sortWithinPartitions("depth", "p1", "p2", "first")
    return map_batches(together, _digested, "e_depth bigint, e_p1 bigint, e_p2 bigint, ends_sha256 string")


def trie_nodes(chained: DataFrame, block: int = BLOCK) -> DataFrame:
    """depth, p1, p2, q1, q2, bytes, n_convs, conv_id of every node below the root."""
    turn = F.struct("at", *_KEYS, "bytes")
    k = F.floor((F.col("at") - 1) / block).alias("k")
    held = chained.groupBy("conv", k).agg(F.array_sort(F.collect_list(turn)).alias("turns"))
    start, end = F.get("turns", F.lit(0)), F.element_at("turns", -1)
    held = held.select(
        "conv", "k", "turns", start["q1"].alias("s1"), start["q2"].alias("s2"),
        end["at"].alias("e"), end["p1"].alias("e1"), end["p2"].alias("e2"),
    )
    blocks = held.groupBy("k", "s1", "s2", "e", "e1", "e2").agg(
        F.count("*").alias("n"), F.min("conv").alias("conv"), F.first("turns").alias("turns")
    )
    blocks = keep(blocks)
    after = blocks.groupBy("k", "s1", "s2").agg(F.count("*").alias("siblings")).where("siblings > 1")
    after = after.withColumnsRenamed({"k": "a_k", "s1": "a_s1", "s2": "a_s2"})
    same = (blocks["k"] == after["a_k"]) & (blocks["s1"] == after["a_s1"]) & (blocks["s2"] == after["a_s2"])
    told = blocks.join(after, same, "left")
    turns = lambda df: df.select("n", "conv", F.explode("turns").alias("t")).select("n", "conv", "t.*")
    alone = turns(told.where("siblings is null"))
    parted = turns(told.where("siblings is not null")).groupBy("at", "p1", "p2").agg(
        F.sum("n").alias("n"), F.min("conv").alias("conv"), *(F.first(c).alias(c) for c in ("q1", "q2", "bytes"))
    )
    columns = ["at", *_KEYS, "bytes", "n", "conv"]
    both = alone.select(columns).unionAll(parted.select(columns))
    return both.withColumnsRenamed({"at": "depth", "n": "n_convs", "conv": "conv_id"})


def subtree_sums(nodes: DataFrame, *sums: str) -> DataFrame:
    """node and the sums of columns over its subtree, from rows (node, up, *sums) where ``up``
    is NULL for the tops. After round j a node has the sums of its subtree to depth 2^j and
    points 2^j nodes up."""
    state = keep(nodes.select("node", F.col("up").alias("jump"), *sums))
    while not state.where("jump is not null").isEmpty():
        below = state.where("jump is not null").groupBy("jump").agg(*(F.sum(s).alias(f"_{s}") for s in sums))
        below = below.withColumnRenamed("jump", "_below")
        above = state.select(F.col("node").alias("_above"), F.col("jump").alias("_next"))
        more = state.join(below, state["node"] == below["_below"], "left")
        more = more.join(above, more["jump"] == above["_above"], "left")
        total = [(F.col(s) + F.coalesce(f"_{s}", F.lit(0))).alias(s) for s in sums]
        state = keep(more.select("node", F.col("_next").alias("jump"), *total))
    return state.drop("jump")


def trie(chained: DataFrame, convs: DataFrame, block: int = BLOCK) -> DataFrame:
    """conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens,
    ends_sha256 of every node of the trie of chains, from the textless root down. ``convs``
    (conv, n) has all conversations, those without turns as well; without any there is no
    node."""
    node, up = F.struct("depth", "p1", "p2"), F.struct((F.col("depth") - 1).alias("depth"), F.col("q1").alias("p1"), F.col("q2").alias("p2"))
    nodes = trie_nodes(chained, block).withColumns({"node": node, "up": up}).drop("p1", "p2", "q1", "q2")
    nodes = keep(nodes)
    zero = F.lit(0).cast("long")
    origin = F.struct(zero.alias("depth"), zero.alias("p1"), zero.alias("p2"))
    top = convs.agg(F.count("*").alias("n_convs"), F.min("conv").alias("conv_id")).where("n_convs > 0")
    top = top.select(zero.alias("depth"), zero.alias("bytes"), "n_convs", "conv_id", origin.alias("node"), F.lit(None).cast(nodes.schema["up"].dataType).alias("up"))
    nodes = nodes.unionByName(top)
    children = nodes.where("up is not null").groupBy("up").agg(F.count("*").alias("n_children")).withColumnRenamed("up", "c_up")
    counted = keep(nodes.join(children, nodes["node"] == children["c_up"], "left").withColumn("n_children", F.coalesce("n_children", zero)).drop("c_up"))
    saved = ((F.col("n_convs") - 1) * F.col("bytes")).alias("saved_tokens")
    leaf = (F.col("n_children") == 0).cast("long").alias("n_leaves")
    own = counted.select("depth", "node", "up", leaf, saved)
    # the root's sums are those of all; so no node points at it, which all would in the end
    below = own.where("depth > 0").withColumn("up", F.when(F.col("depth") > 1, F.col("up")))
    whole = own.agg(F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens"))
    sums = subtree_sums(below, "n_leaves", "saved_tokens").unionByName(whole.where("n_leaves is not null").withColumn("node", origin))
    sums = sums.withColumnRenamed("node", "s_node")

    last = chained.join(convs.withColumnRenamed("conv", "l_conv"), (F.col("conv") == F.col("l_conv")) & (F.col("at") == F.col("n")))
    last = last.select(F.col("at").alias("depth"), "p1", "p2", "conv")
    turnless = convs.where("n = 0").select(zero.alias("depth"), zero.alias("p1"), zero.alias("p2"), "conv")
    ends = ends_digests(last.unionAll(turnless))
    ends = ends.select(F.struct(F.col("e_depth").alias("depth"), F.col("e_p1").alias("p1"), F.col("e_p2").alias("p2")).alias("e_node"), "ends_sha256")
    parents = counted.select(F.col("node").alias("p_node"), F.col("conv_id").alias("parent_conv_id"))
    out = counted.join(sums, counted["node"] == sums["s_node"])
    out = out.join(ends, out["node"] == ends["e_node"], "left").join(parents, out["up"] == parents["p_node"], "left")
    return out.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(sha256().hexdigest())).alias("ends_sha256"),
    )


def conversation_trie(conversations: DataFrame, every: int = 5, folds: int = 9, block: int = BLOCK, **columns: str) -> DataFrame:
    """The trie of the conversations rebuilt: of conversation c the first h turns are those
    of conversation c - c % ``every`` (all if it has fewer, none if it is absent), the rest
    its own after its first h, where h is the CRC-32 of c as text modulo ``folds``.

    NULL roles and texts are empty. NULL turns come first; turns of equal number are in the
    order of the MD5 digest of role and text; repeated rows are turns each. Rows whose
    conversation is NULL belong to none and are left out. Columns beside the four are not
    read. An empty table gives no node. Of a negative id the remainder is negative, as in SQL.
    """
    own = chains(conversations, **columns)
    conv = F.col("conv")
    rebuilt, convs = spliced(own, conv - conv % every, F.crc32(conv.cast("string").cast("binary")) % folds, folds - 1)
    return trie(rebuilt, convs, block)
