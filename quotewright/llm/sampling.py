"""Bounded, repeatable samples of labelled rows for fitting classifiers."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_PARTS = 1 << 20


def order_of(*keys: str) -> Column:
    """The hash of the keys that decides which rows a sample has."""
    return F.xxhash64(*(F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys))


def per_class(df: DataFrame, label: str, most: int, *keys: str) -> tuple[DataFrame, dict]:
    """About ``most`` rows of each class (all of smaller ones), chosen by a hash of ``keys``,
    and the number of different keys by class. Rows of equal keys and class are one, so a
    class made of copies is learned from once and none sends its copies to the driver. Only
    hashes are shuffled to be counted, and of the texts those drawn; the driver sees one
    row a class. A column ``_order`` holds the hash."""
    order = order_of(*keys)
    df = df.withColumn("_order", order)
    counts = {r[0]: r[1] for r in df.select(label, "_order").distinct().groupBy(label).count().collect()}
    if not counts:
        return df, counts
    share = F.create_map(*chain(*((F.lit(c), F.lit(min(_PARTS, -(-most * _PARTS // n)))) for c, n in counts.items())))
    return df.where(F.pmod(order, F.lit(_PARTS)) < share[F.col(label)]).dropDuplicates([label, "_order"]), counts
