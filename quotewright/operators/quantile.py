"""Exact grouped median without holding a group in memory or in one task."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

_BITS = 16  # of a value's image are decided in a round
_LEAST = 2.0**-1022  # the smallest double of full precision


def ordered_image(value: Column) -> Column:
    """A long that rises exactly as the double does: its bits, negated for values below
    zero. Both zeros are 0; NaN, the largest value, has the largest image."""
    size = F.abs(value)
    finite = F.coalesce(size < float("inf"), F.lit(False)) & ~F.isnan(value)
    a = F.when(finite, size).otherwise(1.0)
    b = F.greatest(a, F.lit(_LEAST))
    # the logarithm may miss the exponent by one; comparing with exact powers mends it
    guess = F.least(F.floor(F.log2(b)), F.lit(1023))
    low = F.pow(F.lit(2.0), guess.cast("double"))
    power = guess + F.when(b < low, -1).when(b / 2 >= low, 1).otherwise(0)
    power = F.least(F.greatest(power, F.lit(-1022)), F.lit(1023))
    fraction = (b / F.pow(F.lit(2.0), power.cast("double")) - 1) * 2.0**52
    normal = (power + 1023) * F.lit(1 << 52) + fraction.cast("long")
    image = F.when(a < _LEAST, (a / 5e-324).cast("long")).otherwise(normal)
    signed = F.when(value < 0, -image).otherwise(image)
    infinite = F.when(value > 0, F.lit(2047 << 52)).otherwise(F.lit(-(2047 << 52)))
    return F.when(F.isnan(value), F.lit((1 << 63) - 1)).when(finite, signed).otherwise(infinite)


def _same(rows: DataFrame, cells: DataFrame, names: Sequence[str]) -> DataFrame:
    """Rows joined to cells on equal columns, NULL equal to NULL."""
    other = cells.withColumnsRenamed({c: f"_r_{c}" for c in names})
    on = reduce(and_, (rows[c].eqNullSafe(other[f"_r_{c}"]) for c in names))
    return rows.join(other, on).drop(*(f"_r_{c}" for c in names))


def _holding_middle(cells: DataFrame, parts: Sequence[str], order: str, start: Column) -> DataFrame:
    """Cells holding rank ``_lo`` or ``_hi``, with ``_before`` = rows below them."""
    upto = start + F.sum("_n").over(W.partitionBy(*parts).orderBy(order))
    return (
        cells.withColumn("_upto", upto)
        .withColumn("_before", F.col("_upto") - F.col("_n"))
        .where("_upto >= _lo and _before < _hi")
    )


def grouped_median(df: DataFrame, keys: Sequence[str], value: str, weight: str) -> DataFrame:
    """Median of ``value`` (a double, each row counting ``weight`` times) per key.

    Radix selection: a value's 64-bit image is decided 16 bits a round, from the highest.
    Each of the four rounds counts the cells of the prefixes that still hold a middle rank,
    at most two a group, so a group has at most 65,536 cells in each (twice as many where
    its middle ranks part) whatever its values are. Counts combine map-side, so the size of
    a group does not matter. Prefixes are joined back: by broadcast where Spark measures
    them small, else with AQE splitting a hot one. NULL keys are groups like others; NaN
    counts as the largest value, as it does in Spark's order; NULL values and groups of no
    others are left out.
    """
    keys = list(keys)
    image = ordered_image(F.col(value))
    rows = df.where(F.col(value).isNotNull()).select(*keys, F.col(value).alias("_v"), F.col(weight).alias("_w"), image.alias("_x"))
    prefix = lambda bits: F.shiftright("_x", 64 - bits)
    cells = rows.groupBy(*keys, prefix(_BITS).alias("_p")).agg(F.sum("_w").alias("_n"))
    cells = cells.withColumn("_total", F.sum("_n").over(W.partitionBy(*keys)))
    cells = cells.withColumns({"_lo": F.expr("(_total + 1) div 2"), "_hi": F.expr("_total div 2 + 1")})
    held = _holding_middle(cells, keys, "_p", F.lit(0))
    for bits in range(2 * _BITS, 65, _BITS):
        held = held.select(*keys, "_p", "_lo", "_hi", F.col("_before").alias("_start"))
        own = _same(rows.withColumn("_p", prefix(bits - _BITS)), held, [*keys, "_p"])
        last = [F.min("_v").alias("_v")] if bits == 64 else []
        cells = own.groupBy(*keys, "_p", prefix(bits).alias("_next")).agg(
            F.sum("_w").alias("_n"), *(F.first(c).alias(c) for c in ("_lo", "_hi", "_start")), *last
        )
        held = _holding_middle(cells, [*keys, "_p"], "_next", F.col("_start")).drop("_p").withColumnRenamed("_next", "_p")
    # the two middle ranks fall on one value or on two neighbours
    return held.groupBy(*keys).agg(((F.min("_v") + F.max("_v")) / 2).alias(f"median_{value}"))
