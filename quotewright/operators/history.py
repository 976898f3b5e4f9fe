"""Validity ranges of a dimension's states from its dated snapshots."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

RANGE = ("version", "valid_from", "valid_to", "is_current", "snapshots")


def state_history(df: DataFrame, keys: Sequence[str], day: str, attributes: Sequence[str]) -> DataFrame:
    """keys, attributes, version, valid_from, valid_to, is_current, snapshots: one row for
    each range of successive snapshots in which a key is present with equal attributes.

    The snapshots are the different days of ``df``, whichever keys they have. A range ends
    with the first snapshot that shows the key in another state or no more (``valid_to``,
    exclusive; NULL while the last snapshot still shows it, which is ``is_current``); a key
    that comes back starts a new range. NULL attributes are equal to each other, NULL keys
    are a key. A key repeated on a day counts once; of different states on one day the
    largest, attribute after attribute, with NULL the least. Rows without a day are in no snapshot.

    Rows combine map-side to one a key and day before any window, so a window holds as
    many rows as there are days, however many rows a key has. The list of days is small and
    ordered in one task.
    """
    keys, attributes = list(keys), list(attributes)
    state = F.max(F.struct(*(F.col(c).alias(f"a{i}") for i, c in enumerate(attributes)))).alias("_s")
    seen = df.where(F.col(day).isNotNull()).groupBy(*keys, F.col(day).alias("_day")).agg(state)
    days = df.where(F.col(day).isNotNull()).select(F.col(day).alias("_d")).distinct()
    in_order = W.orderBy("_d")
    days = days.withColumns({"_earlier": F.lag("_d").over(in_order), "_later": F.lead("_d").over(in_order)})
    placed = seen.join(days, seen["_day"] == days["_d"])
    own = W.partitionBy(*keys).orderBy("_day")
    same = reduce(and_, (F.col(f"_s.a{i}").eqNullSafe(F.col(f"_was.a{i}")) for i in range(len(attributes))), F.lit(True))
    starts = or_(~F.col("_before").eqNullSafe(F.col("_earlier")) | F.col("_before").isNull(), ~same)
    marked = placed.withColumns({"_before": F.lag("_day").over(own), "_was": F.lag("_s").over(own)})
    marked = marked.withColumn("version", F.sum(starts.cast("long")).over(own.rowsBetween(W.unboundedPreceding, 0)))
    ranges = marked.groupBy(*keys, "version").agg(
        F.first("_s").alias("_s"),
        F.min("_day").alias("valid_from"),
        F.max_by(F.struct("_later"), "_day").alias("_end"),
        F.count("*").alias("snapshots"),
    )
    return ranges.select(
        *keys,
        *(F.col(f"_s.a{i}").alias(c) for i, c in enumerate(attributes)),
        "version",
        "valid_from",
        F.col("_end._later").alias("valid_to"),
        F.col("_end._later").isNull().alias("is_current"),
        "snapshots",
    )


def as_of(history: DataFrame, day) -> DataFrame:
    """The states valid on a day, an expression or a value."""
    on = F.lit(day) if not hasattr(day, "alias") else day
    return history.where((F.col("valid_from") <= on) & (F.col("valid_to").isNull() | (F.col("valid_to") > on)))
