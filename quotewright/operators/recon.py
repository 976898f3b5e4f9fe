"""Reconciliation of two sources: compared pairs, coverage and totals.

Pairs are kept as (prices, ``pairs``): each side first collapses to its distinct
prices with a row count, so copies of one row are counted by multiplication and
never paired one by one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotewright.functions.columns import beyond_tolerance, sym_pct_diff
from quotewright.operators.quantile import grouped_median
from quotewright.operators.rows import repeat_rows


def weighted_pairs(
    prices: DataFrame, keys: Sequence[str], source: str, a: str, b: str, value: str, tolerance: float
) -> DataFrame:
    """Distinct price pairs per key with pct_diff, is_flagged and their count."""
    keys = list(keys)

    def side(name: str) -> DataFrame:
        return (
            prices.where((F.col(source) == name) & F.col(value).isNotNull())
            .groupBy(*keys, F.col(value).alias(f"{name}_{value}"))
            .agg(F.count(F.lit(1)).alias(f"_{name}"))
        )

    diff = sym_pct_diff(f"{a}_{value}", f"{b}_{value}")
    return (
        side(a)
        .join(side(b), keys)
        .withColumn("pct_diff", diff)
        .select(
            *keys,
            *[F.col(f"{s}_{value}").cast("double").alias(f"{s}_{value}") for s in (a, b)],
            "pct_diff",
            beyond_tolerance("pct_diff", tolerance).alias("is_flagged"),
            (F.col(f"_{a}") * F.col(f"_{b}")).alias("pairs"),
        )
    )


def recon_pairs(pairs: DataFrame) -> DataFrame:
    """One row per compared pair: weighted pairs written out."""
    return repeat_rows(pairs, "pairs")


def top_discrepancies(pairs: DataFrame, keys: Sequence[str], n: int = 10) -> DataFrame:
    """The ``n`` largest differences; ties by key, so the report is repeatable."""
    order = [F.desc("pct_diff"), *keys]
    # n weighted rows hold the n largest pairs, and none needs more than n copies
    head = pairs.orderBy(*order).limit(n).withColumn("pairs", F.least(F.lit(n), "pairs"))
    return recon_pairs(head).orderBy(*order).limit(n)


def recon_by_entity(pairs: DataFrame, key: str, day: str) -> DataFrame:
    """Totals, extreme and median difference and flagged window per entity.

    Describe the entities by joining a dimension to the result: that joins one row
    per entity instead of one per pair.
    """
    flagged_day = F.when(F.col("is_flagged") == 1, F.col(day))
    totals = pairs.groupBy(key).agg(
        F.sum("pairs").alias("compared"),
        F.sum(F.col("is_flagged") * F.col("pairs")).alias("flagged"),
        F.max("pct_diff").alias("max_pct_diff"),
        F.min(flagged_day).alias("first_flagged_date"),
        F.max(flagged_day).alias("last_flagged_date"),
    )
    return totals.join(grouped_median(pairs, [key], "pct_diff", "pairs"), key, "left").select(
        key,
        "compared",
        "flagged",
        (F.col("flagged").cast("double") / F.col("compared")).alias("flagged_pct"),
        "max_pct_diff",
        "median_pct_diff",
        "first_flagged_date",
        "last_flagged_date",
    )


def recon_coverage(trusted: DataFrame, keys: Sequence[str], a: str, b: str) -> DataFrame:
    """Rows per entity by which source delivered them.

    ``trusted`` carries has_<a> and has_<b> flags.
    """
    in_a, in_b = F.col(f"has_{a}") == 1, F.col(f"has_{b}") == 1
    return trusted.groupBy(*keys).agg(
        F.count_if(in_a).alias(f"{a}_rows"),
        F.count_if(in_b).alias(f"{b}_rows"),
        F.count_if(in_a & in_b).alias("both_rows"),
        F.count_if(in_a & ~in_b).alias(f"{a}_only_rows"),
        F.count_if(~in_a & in_b).alias(f"{b}_only_rows"),
        F.max(f"has_{b}").alias(f"in_{b}_sample"),
    )


def recon_summary(pairs: DataFrame, coverage: DataFrame, entity: str, a: str, b: str) -> DataFrame:
    """One row of totals. Entities are counted by a grouped pass, which combines
    map-side, instead of two distinct counts over all pairs."""
    per_entity = pairs.groupBy(entity).agg(
        F.sum("pairs").alias("n"), F.sum(F.col("is_flagged") * F.col("pairs")).alias("f")
    )
    compared = per_entity.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("compared_pairs"),
        F.coalesce(F.sum("f"), F.lit(0)).alias("flagged_pairs"),
        F.count(entity).alias("tickers_compared"),
        F.count(F.when(F.col("f") > 0, F.col(entity))).alias("tickers_affected"),
    )

    def total(rows: str, sampled: int | None = None):
        n = F.col(rows)
        if sampled is not None:
            n = F.when(F.col(f"in_{b}_sample") == sampled, n).otherwise(0)
        return F.coalesce(F.sum(n), F.lit(0))

    covered = coverage.agg(
        total(f"{a}_only_rows").alias(f"only_{a}"),
        total(f"{b}_only_rows").alias(f"only_{b}"),
        total(f"{a}_only_rows", 0).alias(f"only_{a}_unsampled_tickers"),
        total(f"{a}_only_rows", 1).alias(f"only_{a}_within_sampled_tickers"),
    )
    # two one-row frames side by side, without a cross join
    names = [*compared.columns, *covered.columns]
    merged = compared.unionByName(covered, allowMissingColumns=True).agg(
        *[F.max(c).alias(c) for c in names]
    )
    flagged_pct = F.try_divide(F.col("flagged_pairs").cast("double"), F.col("compared_pairs"))
    return merged.select(
        "compared_pairs",
        "flagged_pairs",
        flagged_pct.alias("flagged_pct"),
        "tickers_compared",
        "tickers_affected",
        *covered.columns,
    )
