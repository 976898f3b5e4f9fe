"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree.

Each source has a target in words. Its documents, in an order permuted by a hash, are
dealt to about sqrt(n) blocks; a pass over the source is its blocks one after the other,
and the source's quota is the exact number of blocks that reach the target. Of the last
one, documents are taken in their order as long as that brings the words nearer to the
target: all documents are taken whole, none is cut. A binary tree splits the quotas among
the output shards: at each node the blocks of the left half are drawn without replacement
from those of all sources, one hypergeometric draw after the other, so every shard has its
exact share of blocks and each source its exact quota. The shards then take disjoint runs
of each source's blocks in permuted order, and a hash orders the documents in a shard.

The plan is a table of blocks, made from sizes and hashes alone; texts are shuffled once,
to their place in the output. No window or task holds more than about sqrt(n) blocks of a
source or sqrt(n) documents of its last block; the list of sources (not of documents) is
held in one row.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quotewright.llm.arrow import narrow
from quotewright.llm.words import word_count
from quotewright.session import keep

WEIGHTS = (3, 1, 2)


def targets(sizes: DataFrame, weights=WEIGHTS, share: float = 1.5, most: float = 2.0) -> DataFrame:
    """source, rank, docs, source_size, target from rows (source, size). Sources go by
    code point, NULL last, and take the weights in turn; what a cap of ``most`` times the
    source's size leaves is shared again by weight. That is one level for all sources:
    target = min(cap, level * weight), found from the caps in order of cap per weight."""
    by_source = sizes.groupBy("source").agg(F.count("*").alias("docs"), F.sum("size").alias("source_size"))
    rank = F.row_number().over(W.orderBy(F.col("source").isNull(), "source"))
    weight = F.element_at(F.array(*map(F.lit, weights)), ((F.col("rank") - 1) % len(weights) + 1).cast("int"))
    named = by_source.withColumn("rank", rank).withColumn("weight", weight)
    named = named.withColumn("cap", F.lit(most) * F.col("source_size"))
    order = W.orderBy(F.col("cap") / F.col("weight"), "rank")
    everything = W.partitionBy()
    level = named.withColumns(
        {
            "full": F.coalesce(F.sum("cap").over(order.rowsBetween(W.unboundedPreceding, -1)), F.lit(0.0)),
            "open": F.sum("weight").over(order.rowsBetween(0, W.unboundedFollowing)),
            "all": F.lit(share) * F.sum("source_size").over(everything),
            "nth": F.row_number().over(order),
        }
    ).withColumn("try", (F.col("all") - F.col("full")) / F.col("open"))
    fits = F.when(F.col("try") * F.col("weight") <= F.col("cap"), F.struct("nth", "try"))
    found = level.withColumn("level", F.min(fits).over(everything)["try"])
    target = F.least(F.col("cap"), F.coalesce(F.col("level") * F.col("weight"), F.col("cap")))
    return found.select("source", "rank", "docs", "source_size", target.cast("double").alias("target"))


def uniform(*keys: Column) -> Column:
    """A repeatable number in [0, 1) from the keys."""
    return F.shiftrightunsigned(F.xxhash64(*keys), 11) / F.lit(float(1 << 53))


def named(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once and stands in the plan once, however often
    ``use`` mentions it: expressions that repeat each other's terms grow the driver's plans
    by a multiple with every step."""
    return F.element_at(F.transform(F.array(value), use), 1)


def hypergeometric(total: Column, good: Column, drawn: Column, u: Column) -> Column:
    """How many of ``good`` among ``total`` are in ``drawn`` without replacement, by the
    inverse of the distribution at ``u``. Weights follow from the ratio of neighbouring
    terms, over 12 standard deviations (and 40 more) around the mean."""
    given = {"total": total.cast("double"), "good": good.cast("double"), "drawn": drawn.cast("double"), "u": u}
    return named(F.struct(*(c.alias(n) for n, c in given.items())), _hypergeometric)


def _hypergeometric(given: Column) -> Column:
    total, good, drawn = (given[c] for c in ("total", "good", "drawn"))

    def grown(weight: Column, k: Column) -> Column:
        """The weight of k + 1 from that of k."""
        k = k.cast("double")
        return weight * ((good - k) * (drawn - k)) / ((k + 1) * (total - good - drawn + k + 1))

    def bounds(mean: Column) -> Column:
        variance = F.when(total > 1, mean * (1 - good / total) * (total - drawn) / (total - 1)).otherwise(0.0)
        reach = F.ceil(12 * F.sqrt(F.greatest(variance, F.lit(0.0)))) + 40

        def ends(reach: Column) -> Column:
            low = F.greatest(F.lit(0), (drawn + good - total).cast("long"), F.floor(mean) - reach)
            most = F.least(good.cast("long"), drawn.cast("long"), F.floor(mean) + reach)
            return named(low, lambda low: F.struct(low.alias("low"), F.greatest(low, most).alias("high")))

        return named(reach, ends)

    def found(ends: Column) -> Column:
        low, high = ends["low"], ends["high"]
        steps = F.when(high > low, F.sequence(low, high - 1)).otherwise(F.array().cast("array<bigint>"))
        return named(F.struct(low.alias("low"), steps.alias("steps")), chosen)

    def chosen(over: Column) -> Column:
        steps = over["steps"]
        first = F.struct(F.lit(1.0).alias("w"), F.lit(1.0).alias("sum"))
        begin = F.struct(F.lit(1.0).alias("w"), F.lit(1.0).alias("sum"), over["low"].alias("at"))

        def add(acc: Column, k: Column) -> Column:
            return named(grown(acc["w"], k), lambda w: F.struct(w.alias("w"), (acc["sum"] + w).alias("sum")))

        def find(goal: Column):
            def seek(acc: Column, k: Column) -> Column:
                at = F.when(acc["sum"] <= goal, k + 1).otherwise(acc["at"])
                return named(grown(acc["w"], k), lambda w: F.struct(w.alias("w"), (acc["sum"] + w).alias("sum"), at.alias("at")))

            return seek

        whole = F.aggregate(steps, first, add, lambda acc: acc["sum"])
        return named(given["u"] * whole, lambda goal: F.aggregate(steps, begin, find(goal), lambda acc: acc["at"]))

    return named(F.when(total > 0, drawn * good / total).otherwise(0.0), lambda mean: named(bounds(mean), found))


def split_quotas(quotas: DataFrame, shards: int, seed: int) -> DataFrame:
    """rank, ends: for each source, where the blocks of shard 0, 1, ... end, from rows
    (rank, quota). One row a node, all nodes of a level in one step; no shuffle but the
    gathering of the list of sources and its return."""
    listed = F.array_sort(F.collect_list(F.struct("rank", F.col("quota").cast("long").alias("quota"))))
    nodes = quotas.agg(listed.alias("q")).select(F.lit(0).alias("low"), F.lit(shards).alias("high"), "q")
    for _ in range((shards - 1).bit_length()):
        count = F.aggregate("q", F.lit(0).cast("long"), lambda a, x: a + x["quota"])
        middle = F.col("low") + F.floor((F.col("high") - F.col("low")) / 2).cast("int")
        split = nodes.withColumns({"middle": middle, "n": count})
        to_left = F.floor(F.col("n") * (F.col("middle") - F.col("low")) / (F.col("high") - F.col("low"))).cast("long")

        def draw(acc: Column, x: Column) -> Column:
            u = uniform(F.lit(seed), F.lit("split"), F.col("low"), F.col("high"), x["rank"])
            k = hypergeometric(acc["total"], x["quota"], acc["drawn"], u).cast("long")
            return named(k, lambda k: F.struct(
                (acc["total"] - x["quota"]).alias("total"),
                (acc["drawn"] - k).alias("drawn"),
                F.concat(acc["left"], F.array(F.struct(x["rank"].alias("rank"), k.alias("quota")))).alias("left"),
            ))

        none = F.array().cast("array<struct<rank:int,quota:bigint>>")
        begin = F.struct(F.col("n").alias("total"), to_left.alias("drawn"), none.alias("left"))
        drawn = split.withColumn("left", F.aggregate("q", begin, draw, lambda acc: acc["left"]))
        rest = F.zip_with("q", "left", lambda x, y: F.struct(x["rank"].alias("rank"), (x["quota"] - y["quota"]).alias("quota")))
        halves = F.array(
            F.struct(F.col("low"), F.col("middle").alias("high"), F.col("left").alias("q")),
            F.struct(F.col("middle").alias("low"), F.col("high"), rest.alias("q")),
        )
        leaf = F.array(F.struct("low", "high", "q"))
        nodes = drawn.select(F.explode(F.when(F.col("high") - F.col("low") > 1, halves).otherwise(leaf)).alias("x")).select("x.*")
    leaves = nodes.select("low", F.explode("q").alias("x")).select("low", "x.rank", "x.quota")
    ordered = leaves.groupBy("rank").agg(F.array_sort(F.collect_list(F.struct("low", "quota"))).alias("parts"))
    until = F.transform(
        "parts", lambda _, i: F.aggregate(F.slice("parts", F.lit(1), i + 1), F.lit(0).cast("long"), lambda a, x: a + x["quota"])
    )
    return ordered.select("rank", until.alias("ends"))


SHARD_WORDS, PIECES = 16_000_000, 4


def plan(sizes: DataFrame, shards: int | None = None, seed: int = 17, weights=WEIGHTS, share=1.5, most=2.0) -> tuple[DataFrame, DataFrame, int]:
    """Of rows (source, size, key), which must be written: the sources (source, rank,
    source_size, target, blocks), the units drawn from each block (rank, block, drawn: a list
    of pass, shard and the last place that is taken, NULL for all), and the number of
    shards, which follows the words of the mix unless it is given."""
    sources = targets(sizes, weights, share, most)
    # as many blocks as the root of the source's documents, so that both stay small
    sources = sources.withColumn("blocks", F.ceil(F.sqrt("docs")).cast("long"))
    sources = keep(sources)
    if shards is None:
        words = sources.agg(F.sum("target")).first()[0] or 0
        shards = max(16, -(-int(words) // SHARD_WORDS))
    wanted, size = F.round("target").cast("long"), F.col("source_size")
    spread = sources.select(
        F.col("source").alias("s"), "rank", "blocks",
        F.when(size > 0, F.floor(wanted / size)).otherwise(0).cast("long").alias("passes"),
        F.when(size > 0, wanted % F.greatest(size, F.lit(1))).otherwise(0).cast("long").alias("part"),
    )
    dealt = sizes.join(spread, sizes["source"].eqNullSafe(spread["s"])).withColumn("place", place_of(seed))
    dealt = dealt.withColumn("block", F.pmod("place", "blocks"))
    own = dealt.groupBy("rank", "block").agg(F.sum("size").alias("words"), *(F.first(c).alias(c) for c in ("passes", "part")))
    before = F.coalesce(F.sum("words").over(W.partitionBy("rank").orderBy("block").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    own = keep(own.withColumn("cut", F.greatest(F.lit(0), F.least(F.col("words"), F.col("part") - before))))
    # in the block where a source's target ends: its documents up to the nearest border
    ending = own.where("cut > 0 and cut < words").select(F.col("rank").alias("e_rank"), F.col("block").alias("e_block"), "cut")
    inside = dealt.join(ending, (dealt["rank"] == ending["e_rank"]) & (dealt["block"] == ending["e_block"]))
    inside = inside.groupBy("rank", "place").agg(F.sum("size").alias("size"), F.first("cut").alias("cut"))
    prior = F.coalesce(F.sum("size").over(W.partitionBy("rank").orderBy("place").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    near = inside.withColumn("prior", prior).where(2 * (F.col("cut") - F.col("prior")) >= F.col("size"))
    last = near.groupBy("rank").agg(F.max("place").alias("upto")).withColumnRenamed("rank", "l_rank")
    own = own.join(last, (own["rank"] == last["l_rank"]) & (F.col("cut") < F.col("words")), "left")
    # a block is drawn once whole for each full pass, and once up to its cut
    passes = F.when(F.col("passes") > 0, F.sequence(F.lit(0).cast("long"), F.col("passes") - 1)).otherwise(F.array().cast("array<bigint>"))
    whole = F.transform(passes, lambda p: F.struct(p.alias("pass"), F.lit(None).cast("long").alias("upto")))
    taken = (F.col("cut") > 0) & ((F.col("cut") >= F.col("words")) | F.col("upto").isNotNull())
    rest = F.when(taken, F.array(F.struct(F.col("passes").alias("pass"), "upto"))).otherwise(
        F.array().cast("array<struct<pass:bigint,upto:bigint>>")
    )
    units = keep(own.where("words > 0").select("rank", "block", F.explode(F.concat(whole, rest)).alias("u")).select("rank", "block", "u.pass", "u.upto"))
    ends = split_quotas(units.groupBy("rank").agg(F.count("*").alias("quota")), shards, seed)
    turn = W.partitionBy("rank").orderBy(F.xxhash64(F.lit(seed), F.lit("block"), "rank", "block", "pass"), "block", "pass")
    numbered = units.withColumn("n", F.row_number().over(turn)).join(ends, "rank")
    shard = F.size(F.filter("ends", lambda e: e < F.col("n"))).alias("shard")
    drawn = numbered.groupBy("rank", "block").agg(F.array_sort(F.collect_list(F.struct("pass", shard, "upto"))).alias("drawn"))
    return sources, keep(drawn), shards


def place_of(seed: int) -> Column:
    """The place of a row in its source's permuted order, from its key."""
    return F.xxhash64(F.lit(seed), F.col("key"))


def takes(rows: DataFrame, sources: DataFrame, drawn: DataFrame, seed: int) -> DataFrame:
    """``rows`` (source, size, key and any others) with source_size, target, place and
    takes: (pass, shard) of each time the mix takes the row. Both joins are to small tables,
    one row a source and one a block; rows move only where these are not small."""
    found = sources.select(F.col("source").alias("s_source"), F.col("rank").alias("s_rank"), "source_size", "target", "blocks")
    placed = rows.join(found, rows["source"].eqNullSafe(found["s_source"])).withColumn("place", place_of(seed))
    units = drawn.select(F.col("rank").alias("d_rank"), F.col("block").alias("d_block"), "drawn")
    own = (placed["s_rank"] == units["d_rank"]) & (F.pmod(placed["place"], placed["blocks"]) == units["d_block"])
    placed = placed.join(units, own, "left")
    fits = F.filter("drawn", lambda u: (F.col("size") > 0) & (u["upto"].isNull() | (F.col("place") <= u["upto"])))
    none = F.array().cast("array<struct<pass:bigint,shard:int>>")
    picked = F.transform(F.coalesce(fits, F.filter("drawn", lambda u: F.lit(False))), lambda u: F.struct(u["pass"].alias("pass"), u["shard"].alias("shard")))
    return placed.withColumn("takes", F.coalesce(picked, none)).drop("s_source", "s_rank", "blocks", "d_rank", "d_block", "drawn")


def sized(docs: DataFrame, id_col="doc_id", text_col="text", source_col="source") -> DataFrame:
    """doc, source, size and a key by which rows are permuted: of the id and the text."""
    rows = narrow(docs, doc=id_col, text=text_col, source=source_col)
    return rows.select("doc", "source", word_count(F.col("text")).alias("size"), _key("doc", "text"))


def _key(doc: str, text: str) -> Column:
    return F.xxhash64(F.col(doc).cast("string"), F.col(text)).alias("key")


def mix_counts(docs: DataFrame, shards: int | None = None, seed: int = 17, **columns: str) -> DataFrame:
    """doc_id, size, source_size, target, taken, shards of every row.

    ``taken`` counts the words of all passes, whole documents each; a source's sum is as
    near its target as the documents at its end allow, half a document's words off at
    most. NULL texts have size 0 and are never taken; NULL sources are one source, last in
    order. Rows equal in id and text share a place and are taken alike, so reruns agree.
    Other columns are not read; an empty table gives no rows.
    """
    rows = keep(sized(docs, **columns))
    sources, drawn, _ = plan(rows, shards, seed)
    found = takes(rows, sources, drawn, seed)
    taken = F.size("takes") * F.col("size")
    return found.select(F.col("doc").alias("doc_id"), "size", "source_size", "target", taken.alias("taken"), F.transform("takes", lambda t: t["shard"]).alias("shards"))


ADDED = ("mix_shard", "mix_place", "mix_pass", "mix_words")


def mix(docs: DataFrame, shards: int | None = None, seed: int = 17, id_col="doc_id", text_col="text", source_col="source") -> DataFrame:
    """The mix itself: the rows of ``docs``, once for each time a row is taken, whole, with
    mix_shard, mix_place (its order in the shard), mix_pass and mix_words after their columns.
    Columns of ``docs`` of these names are replaced.

    A shard is ``PIECES`` tasks, each with a range of its places in order. NULL and empty
    texts and those of blanks are never taken; NULL sources are one source; rows equal in id
    and text are taken alike, each of them; an empty table gives no rows. ``docs`` is read
    twice and must not change meanwhile.
    """
    sources, drawn, shards = plan(keep(sized(docs, id_col, text_col, source_col).drop("doc")), shards, seed)
    text, own = F.col(f"doc.`{text_col}`"), [c for c in docs.columns if c not in ADDED]
    rows = docs.select(F.struct("*").alias("doc")).select("doc", F.col(f"doc.`{source_col}`").alias("source"), word_count(text).alias("size"), _key(f"doc.`{id_col}`", f"doc.`{text_col}`"))
    taken = takes(rows, sources, drawn, seed).where(F.size("takes") > 0)
    taken = taken.select("doc", "size", "place", F.explode("takes").alias("t"))
    place = F.xxhash64(F.lit(seed), F.lit("place"), "place", "t.pass").alias("at")
    taken = taken.select("doc", "size", F.col("t.shard").alias("shard"), F.col("t.pass").alias("pass"), place)
    # the upper bits of a place say which piece of the shard it is in
    piece = F.shiftright("at", 62) + PIECES // 2
    dealt = taken.repartitionById(shards * PIECES, (F.col("shard") * PIECES + piece).cast("int")).sortWithinPartitions("shard", "at")
    added = (F.col(c).alias(n) for c, n in zip(("shard", "at", "pass", "size"), ADDED))
    return dealt.select(*(F.col(f"doc.`{c}`").alias(c) for c in own), *added)
