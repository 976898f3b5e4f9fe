"""Star joins and the derived dimension and consensus tables.

No broadcast hints: Spark broadcasts a dimension when its measured size is under
the session's threshold and otherwise shuffles, where AQE splits hot keys.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotewright.functions.columns import beyond_tolerance, date_key, sym_pct_diff


def star_join(
    fact: DataFrame, dims: Sequence[tuple[DataFrame, str, dict[str, str]]]
) -> DataFrame:
    """Inner join of a fact to dimensions.

    ``dims`` lists (dimension, shared key, {dimension column: output name}).
    Facts without a dimension row drop out, as in any inner join; the foreign key
    checks count them.
    """
    out = fact
    for dim, key, columns in dims:
        picked = dim.select(key, *[F.col(c).alias(name) for c, name in columns.items()])
        out = out.join(picked, key)
    return out


def current_versions(dim: DataFrame, columns: Sequence[str], current: str = "is_current") -> DataFrame:
    return dim.where(F.col(current)).select(*columns)


def calendar(bounds: DataFrame) -> DataFrame:
    """One row per day between the smallest ``first`` and largest ``last`` of
    ``bounds``. Day numbers run from 0 (Monday)."""
    span = bounds.agg(F.min("first").alias("a"), F.max("last").alias("b"))
    day = F.col("date")
    return span.select(F.explode(F.sequence("a", "b")).alias("date")).select(
        date_key(day).cast("int").alias("date_key"),
        "date",
        F.year(day).cast("smallint").alias("year"),
        F.quarter(day).cast("smallint").alias("quarter"),
        F.month(day).cast("smallint").alias("month"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.dayofmonth(day).cast("smallint").alias("day"),
        F.weekday(day).cast("smallint").alias("day_of_week"),
        F.date_format(day, "EEEE").alias("day_name"),
        (F.weekday(day) < 5).alias("is_weekday"),
    )


def trading_days(dates: DataFrame, facts: DataFrame, key: str = "date_key") -> DataFrame:
    """``dates`` with is_trading_day = some fact row falls on that day."""
    seen = facts.select(key).distinct().withColumn("is_trading_day", F.lit(True))
    return dates.join(seen, key, "left").withColumn(
        "is_trading_day", F.coalesce("is_trading_day", F.lit(False))
    )


def consensus(
    prices: DataFrame,
    keys: Sequence[str],
    source: str,
    prefer: str,
    other: str,
    value: str,
    tolerance: float,
) -> DataFrame:
    """One trusted row per key out of two sources.

    A single conditional aggregation: both sources meet in one shuffle, copies
    collapse before it, and no key is held whole in a task.
    """
    sides = prices.where(F.col(source).isin(prefer, other)).groupBy(*keys).agg(
        F.max(F.when(F.col(source) == prefer, F.col(value))).alias("_a"),
        F.max(F.when(F.col(source) == other, F.col(value))).alias("_b"),
    )
    a, b = F.col("_a"), F.col("_b")
    both = a.isNotNull() & b.isNotNull()
    first, second = sorted((prefer, other))
    diff = sym_pct_diff(a, b)
    return sides.where(a.isNotNull() | b.isNotNull()).select(
        *keys,
        F.coalesce(a, b).alias(value),
        F.when(a.isNotNull(), prefer).otherwise(other).alias("primary_source"),
        F.when(both, f"{first}|{second}")
        .when(a.isNotNull(), prefer)
        .otherwise(other)
        .alias("sources_available"),
        F.when(both, diff.try_cast("decimal(9,6)")).alias("pct_diff"),
        F.when(~both, "single_source")
        .when(beyond_tolerance(diff, tolerance) == 1, "disagreed")
        .otherwise("agreed")
        .alias("reconciliation_flag"),
    )
