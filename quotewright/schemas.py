"""The six market tables, the audit tables and the load fingerprints.

One schema per table; decimal columns, null counts and key orders derive from it.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

PRICE_FIELDS = ("open", "high", "low", "close", "adj_open", "adj_high", "adj_low", "adj_close")


def tally(condition: str) -> str:
    """Rows where the condition is true; NULL, like any sum, over an empty table."""
    return f"sum(case when {condition} then 1 else 0 end)"


@dataclass(frozen=True)
class TableSpec:
    """A typed table: its schema, its declared grain and its fingerprint metrics."""

    name: str
    schema: T.StructType
    key: tuple[str, ...]
    metrics: dict[str, str] = field(default_factory=dict)
    # shown as the newest value on the health page
    newest: str = ""

    @property
    def decimals(self) -> list[str]:
        return decimal_columns(self.schema)

    @property
    def fingerprints(self) -> dict[str, str]:
        """Metric name to SQL aggregate: row count, listed metrics, null counts."""
        nulls = {f"null_{c}": tally(f"{c} is null") for c in self.decimals}
        return {"row_count": "count(1)", **self.metrics, **nulls}


def decimal_columns(schema: T.StructType) -> list[str]:
    return [f.name for f in schema if isinstance(f.dataType, T.DecimalType)]


INT, SMALL, BIG = T.IntegerType(), T.ShortType(), T.LongType()
TEXT, BOOL, DATE, STAMP = T.StringType(), T.BooleanType(), T.DateType(), T.TimestampType()
NUMBER, LOCAL_STAMP = T.DoubleType(), T.TimestampNTZType()
PRICE, RATIO = T.DecimalType(18, 6), T.DecimalType(9, 6)


def columns(**kinds: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in kinds.items()])


# Table names, column names, types, grains and metric names are the
# interchange format of the data and must stay as they are.
MARKET_TABLES: dict[str, TableSpec] = {
    t.name: t
    for t in (
        TableSpec(
            "dim_date",
            columns(
                date_key=INT, date=DATE, year=SMALL, quarter=SMALL, month=SMALL,
                month_name=TEXT, day=SMALL, day_of_week=SMALL, day_name=TEXT,
                is_weekday=BOOL, is_trading_day=BOOL,
            ),
            ("date_key",),
            {
                "min_date_key": "min(date_key)",
                "max_date_key": "max(date_key)",
                "trading_days": tally("is_trading_day"),
            },
            "date",
        ),
        TableSpec(
            "dim_security",
            columns(
                security_key=INT, ticker=TEXT, company_name=TEXT, gics_sector=TEXT,
                gics_sub_industry=TEXT, figi=TEXT, effective_from=DATE,
                effective_to=DATE, is_current=BOOL,
            ),
            ("security_key",),
            {
                "distinct_tickers": "count(distinct ticker)",
                "current_rows": tally("is_current"),
                "max_security_key": "max(security_key)",
            },
            "effective_from",
        ),
        TableSpec(
            "fact_price_daily",
            columns(
                security_key=INT, date_key=INT, source=TEXT,
                **dict.fromkeys(PRICE_FIELDS, PRICE), volume=BIG, adj_volume=BIG,
            ),
            ("security_key", "date_key", "source"),
            {
                "distinct_securities": "count(distinct security_key)",
                "min_date_key": "min(date_key)",
                "max_date_key": "max(date_key)",
                "sum_adj_close": "sum(adj_close)",
                # bigint sums overflow under ANSI mode, decimals do not
                "sum_volume": "sum(cast(volume as decimal(28,0)))",
            },
            "date_key",
        ),
        TableSpec(
            "fact_price_daily_consensus",
            columns(
                security_key=INT, date_key=INT, adj_close=PRICE, primary_source=TEXT,
                sources_available=TEXT, pct_diff=RATIO, reconciliation_flag=TEXT,
            ),
            ("security_key", "date_key"),
            {
                "sum_adj_close": "sum(adj_close)",
                "sum_pct_diff": "sum(pct_diff)",
                "disagreed_rows": tally("reconciliation_flag = 'disagreed'"),
                "single_source_rows": tally("reconciliation_flag = 'single_source'"),
            },
            "date_key",
        ),
        TableSpec(
            "fact_corporate_action",
            columns(
                security_key=INT, date_key=INT, action_type=TEXT, value=PRICE,
                source=TEXT,
            ),
            ("security_key", "date_key", "action_type", "source"),
            {"sum_value": "sum(value)", "split_rows": tally("action_type = 'split'")},
            "date_key",
        ),
        TableSpec(
            "fact_macro_rate",
            columns(
                date_key=INT, series_id=TEXT, value=PRICE,
            ),
            ("date_key", "series_id"),
            {"distinct_series": "count(distinct series_id)", "sum_value": "sum(value)"},
            "date_key",
        ),
    )
}

LOAD_LOG = columns(
    run_id=TEXT, table_name=TEXT, rows_expected=BIG, rows_loaded=BIG,
    fingerprint_match=BOOL, mismatch_detail=TEXT, loaded_at_utc=STAMP,
)
DQ_RESULTS = columns(
    run_id=TEXT, check_name=TEXT, table_name=TEXT, severity=TEXT, status=TEXT,
    failing_count=BIG, checked_rows=BIG, description=TEXT, checked_at_utc=STAMP,
)


def control_schema(source_a: str, source_b: str) -> T.StructType:
    only = {f"only_{s}": BIG for s in (source_a, source_b)}
    return columns(
        report_ingest_date=DATE, compared_pairs=BIG, flagged_pairs=BIG, **only,
        tickers_compared=INT, tickers_affected=INT,
    )


CONTROL_TICKER = columns(
    report_ingest_date=DATE, ticker=TEXT, flagged=BIG, compared=BIG, first_flagged=DATE,
    last_flagged=DATE,
)
# The manifest is one document. ``file`` names the table's file or folder; a folder
# has its hashes in the listing, and no sha256 of its own.
MANIFEST = columns(
    exported_at_utc=TEXT,
    tables=T.MapType(
        TEXT,
        columns(
            rows=BIG, file=TEXT, bytes=BIG, sha256=TEXT, nan_to_null=T.MapType(TEXT, BIG),
            fingerprints=T.MapType(TEXT, TEXT), files=BIG, content=TEXT,
        ),
    ),
)
