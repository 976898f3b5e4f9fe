"""Comparison of recomputed totals with the figures of a published report."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotewright.operators.quality import as_results


def _long(df: DataFrame, figures: Sequence[str], name: str) -> DataFrame:
    pairs = [
        F.struct(F.lit(c).alias("figure"), F.col(c).cast("bigint").alias(name)) for c in figures
    ]
    return df.select(F.inline(F.array(*pairs)))


def headline_differences(summary: DataFrame, control: DataFrame, figures: Sequence[str]) -> DataFrame:
    """(figure, computed, published, difference); a missing control gives NULL.

    Both sides are unpivoted and joined on the figure's name, not crossed.
    """
    computed = _long(summary, figures, "computed")
    published = _long(control, figures, "published")
    return computed.join(published, "figure", "left").withColumn(
        "difference", F.abs(F.col("computed") - F.col("published"))
    )


def entity_differences(by_entity: DataFrame, control: DataFrame, entity: str) -> DataFrame:
    """Entities whose flagged count differs or that only one side lists."""
    computed = by_entity.where("flagged > 0").select(entity, F.col("flagged").alias("computed"))
    published = control.select(entity, F.col("flagged").alias("published"))
    c, p = F.col("computed"), F.col("published")
    return computed.join(published, entity, "full").where(c.isNull() | p.isNull() | (c != p))


def control_results(
    summary: DataFrame,
    by_entity: DataFrame,
    control: DataFrame,
    control_entity: DataFrame,
    figures: Sequence[str],
    report_date: date,
    run_id: str,
    at: datetime,
) -> DataFrame:
    """Result rows of the control checks for the report of one date."""
    on_date = F.col("report_ingest_date") == F.lit(report_date)
    entities = control_entity.where(on_date)
    heads = headline_differences(summary, control.where(on_date), figures).select(
        F.concat(F.lit("report_control__"), "figure").alias("check_name"),
        F.concat(F.lit("recomputed "), "figure", F.lit(" against the published figure")).alias("description"),
        F.col("difference").alias("failing_count"),
        F.col("computed").alias("checked_rows"),
    )
    # two one-row counts, merged
    per_entity = (
        entity_differences(by_entity, entities, "ticker")
        .agg(F.count(F.lit(1)).alias("failing_count"))
        .unionByName(entities.agg(F.count(F.lit(1)).alias("checked_rows")), allowMissingColumns=True)
        .agg(F.max("failing_count").alias("failing_count"), F.max("checked_rows").alias("checked_rows"))
        .select(
            F.lit("report_control__per_ticker_flagged").alias("check_name"),
            F.lit("tickers whose flagged count differs or that one side lacks").alias("description"),
            "failing_count",
            "checked_rows",
        )
    )
    counts = heads.unionByName(per_entity).withColumns(
        {
            "table_name": F.lit(f"reconciliation_report_{report_date.isoformat()}"),
            "severity": F.lit("error"),
        }
    )
    return as_results(counts, run_id, at)
