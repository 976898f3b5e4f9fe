"""The market: models, marts and checks over the six tables.

Every function takes a mapping of table name to DataFrame and stays lazy.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotewright.functions.columns import first_violated, has_token
from quotewright.operators import quality as q
from quotewright.operators import recon, series, star
from quotewright.schemas import MARKET_TABLES, PRICE_FIELDS, TableSpec

Tables = Mapping[str, DataFrame]
ENTITY = ("ticker", "gics_sector", "security_key")
PAIR_KEYS = ("security_key", "date_key")

# The ordering rules in priority order, with their reported names.
OHLC_RULES = (
    ("low>open", "low > open"),
    ("high<low", "high < low"),
    ("high<open", "high < open"),
    ("high<close", "high < close"),
    ("low>close", "low > close"),
)


@dataclass(frozen=True)
class Market:
    """Parameters of the market; the defaults are those of the daily price data."""

    source_a: str = "yfinance"
    source_b: str = "tiingo"
    # the sources as the published report spells them
    printed_a: str = "yfinance"
    printed_b: str = "Tiingo"
    tolerance: float = 0.005
    gap_days: int = 5
    window: int = 21
    annualise: int = 252
    ranges: int | None = None

    @property
    def vol(self) -> str:
        return f"vol_{self.window}d_ann"

    @property
    def control_figures(self) -> tuple[str, ...]:
        return (
            "compared_pairs",
            "flagged_pairs",
            f"only_{self.source_a}",
            f"only_{self.source_b}",
            "tickers_compared",
            "tickers_affected",
        )


# ---------------------------------------------------------------- models


def _security(t: Tables, *columns: str):
    return (t["dim_security"], "security_key", {c: c for c in columns})


def _date(t: Tables, name: str):
    return (t["dim_date"], "date_key", {"date": name})


def price_daily(t: Tables) -> DataFrame:
    joined = star.star_join(
        t["fact_price_daily"], [_security(t, "ticker", "gics_sector"), _date(t, "trade_date")]
    )
    return joined.select(
        "security_key", "ticker", "gics_sector", "date_key", "trade_date", "source",
        *PRICE_FIELDS, "volume", "adj_volume",
    )


def _delivered(m: Market):
    return [has_token("sources_available", s).alias(f"has_{s}") for s in (m.source_a, m.source_b)]


def price_trusted(t: Tables, m: Market) -> DataFrame:
    joined = star.star_join(
        t["fact_price_daily_consensus"],
        [_security(t, "ticker", "gics_sector"), _date(t, "trade_date")],
    )
    return joined.select(
        "security_key", "ticker", "gics_sector", "date_key", "trade_date", "adj_close",
        "primary_source", "sources_available", "pct_diff", "reconciliation_flag", *_delivered(m),
    )


def corporate_action(t: Tables) -> DataFrame:
    joined = star.star_join(
        t["fact_corporate_action"], [_security(t, "ticker"), _date(t, "action_date")]
    )
    return joined.select(
        "security_key", "ticker", "date_key", "action_date", "action_type", "value", "source"
    )


def macro_rate(t: Tables) -> DataFrame:
    joined = star.star_join(t["fact_macro_rate"], [_date(t, "rate_date")])
    return joined.select("date_key", "rate_date", "series_id", "value")


# ---------------------------------------------------------------- marts


def price_returns(t: Tables, m: Market) -> DataFrame:
    """Securities are described after the windows, so their names are not shuffled;
    one without a dimension row drops out whole either way."""
    dated = star.star_join(t["fact_price_daily_consensus"], [_date(t, "trade_date")]).select(
        "security_key", "date_key", "trade_date", "adj_close", "reconciliation_flag"
    )
    computed = series.returns(
        dated, "security_key", "trade_date", "adj_close",
        gap_days=m.gap_days, window=m.window, annualise=m.annualise, ranges=m.ranges,
    )
    return _described(t, computed, ("security_key", "ticker", "gics_sector"))


def _described(t: Tables, df: DataFrame, first: tuple[str, ...]) -> DataFrame:
    """``df`` with ticker and sector; ``first`` leads the columns."""
    joined = star.star_join(df, [_security(t, "ticker", "gics_sector")])
    return joined.select(*first, *[c for c in df.columns if c not in first])


def latest_price(returns: DataFrame, m: Market) -> DataFrame:
    newest = series.latest_per_key(returns, "security_key", "trade_date", ("date_key",))
    return newest.select(
        "security_key", "ticker", "gics_sector", "trade_date", "adj_close", "daily_return",
        m.vol, "reconciliation_flag",
    )


def security_summary(returns: DataFrame, m: Market) -> DataFrame:
    return series.entity_summary(
        returns, ("security_key", "ticker", "gics_sector"), "trade_date", "adj_close", m.vol
    )


def sector_daily_return(returns: DataFrame) -> DataFrame:
    return series.group_daily_return(returns, "gics_sector", "trade_date")


def dim_security_current(t: Tables) -> DataFrame:
    return star.current_versions(
        t["dim_security"],
        ("security_key", "ticker", "company_name", "gics_sector", "gics_sub_industry", "figi"),
    )


def dim_date(t: Tables) -> DataFrame:
    return t["dim_date"].select(
        "date_key", F.col("date").alias("calendar_date"), "year", "quarter", "month",
        "month_name", "day_name", "is_weekday", "is_trading_day",
    )


def recon_pairs(t: Tables, m: Market) -> DataFrame:
    """Weighted pairs over RAW, so orphan facts still count."""
    return recon.weighted_pairs(
        t["fact_price_daily"], PAIR_KEYS, "source", m.source_a, m.source_b, "adj_close", m.tolerance
    )


def recon_by_ticker(t: Tables, pairs: DataFrame) -> DataFrame:
    dated = star.star_join(pairs, [_date(t, "date")])
    per_security = recon.recon_by_entity(dated, "security_key", "date")
    return _described(t, per_security, ENTITY)


def recon_coverage(t: Tables, m: Market) -> DataFrame:
    delivered = star.star_join(t["fact_price_daily_consensus"], [_date(t, "trade_date")]).select(
        "security_key", *_delivered(m)
    )
    per_security = recon.recon_coverage(delivered, ("security_key",), m.source_a, m.source_b)
    return _described(t, per_security, ENTITY)


def recon_summary(pairs: DataFrame, coverage: DataFrame, m: Market) -> DataFrame:
    return recon.recon_summary(pairs, coverage, "security_key", m.source_a, m.source_b)


def price_anomalies(daily: DataFrame) -> DataFrame:
    return daily.withColumn("violated_rule", first_violated(OHLC_RULES)).where(
        "violated_rule is not null"
    ).select("ticker", "trade_date", "source", "open", "high", "low", "close", "violated_rule")


def first_anomalies(anomalies: DataFrame, n: int = 10) -> DataFrame:
    return anomalies.select("ticker", "trade_date", "source", "violated_rule").orderBy(
        "trade_date", "ticker", "source", "violated_rule"
    ).limit(n)


def platform_health(t: Tables, specs: Mapping[str, TableSpec] = MARKET_TABLES) -> DataFrame:
    rows = [
        t[s.name].agg(
            F.count(F.lit(1)).alias("row_count"),
            F.max(s.newest).cast("string").alias("latest_value"),
        ).select(F.lit(s.name).alias("table_name"), "row_count", "latest_value")
        for s in specs.values()
    ]
    return reduce(DataFrame.unionByName, rows)


def null_prices(daily: DataFrame) -> DataFrame:
    """Rows with a missing price field, per ticker and source."""
    return daily.where(_any_null(PRICE_FIELDS)).groupBy("ticker", "source").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.min("trade_date").alias("first_date"),
        F.max("trade_date").alias("last_date"),
    )


def securities_without_prices(t: Tables) -> DataFrame:
    priced = t["fact_price_daily"].select("security_key").distinct()
    return dim_security_current(t).join(priced, "security_key", "left_anti").select("ticker")


def _any_null(columns) -> str:
    return " or ".join(f"{c} is null" for c in columns)


# ---------------------------------------------------------------- measures


def measures(
    returns: DataFrame, latest: DataFrame, summary: DataFrame, checks: DataFrame, loads: DataFrame,
    m: Market,
) -> DataFrame:
    """Dashboard measures as (measure, value). ``checks`` and ``loads`` are the
    rows of the latest run."""

    def long(df: DataFrame, **columns) -> DataFrame:
        wide = df.agg(*[c.cast("double").alias(n) for n, c in columns.items()])
        pairs = [F.struct(F.lit(n).alias("measure"), F.col(n).alias("value")) for n in columns]
        return wide.select(F.inline(F.array(*pairs)))

    def status(s: str):
        return F.count_if(F.col("status") == s)

    # securities are counted over one row per security, combined map-side
    per_security = returns.groupBy("security_key").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.when(F.col("is_gap_return") == 0, F.col("daily_return"))).alias("r"),
        F.count(F.when(F.col("is_gap_return") == 0, F.col("daily_return"))).alias("rn"),
        F.sum(m.vol).alias("v"),
        F.count(m.vol).alias("vn"),
    )
    parts = [
        long(
            per_security,
            securities=F.count("security_key"),
            observations=F.coalesce(F.sum("n"), F.lit(0)),
            avg_daily_return=F.try_divide(F.sum("r"), F.sum("rn")),
            **{f"avg_{m.vol}": F.try_divide(F.sum("v"), F.sum("vn"))},
        ),
        long(latest, **{f"latest_{m.vol}": F.avg(m.vol)}),
        long(
            summary,
            compared_pairs=F.sum("compared_pairs"),
            flagged_pairs=F.sum("flagged_pairs"),
            flagged_pct=F.try_divide(F.sum("flagged_pairs"), F.sum("compared_pairs")),
            tickers_affected=F.sum("tickers_affected"),
            tickers_compared=F.sum("tickers_compared"),
        ),
        long(
            checks, checks_passed=status("PASS"), checks_warned=status("WARN"),
            checks_failed=status("FAIL"),
        ),
        long(loads, tables_verified=F.count_if("fingerprint_match")),
    ]
    return reduce(DataFrame.unionByName, parts)


def latest_run(log: DataFrame, rows: DataFrame, stamp: str = "loaded_at_utc") -> DataFrame:
    """Rows of the run with the newest load stamp; equal stamps go to the larger id."""
    newest = log.agg(F.max(F.struct(stamp, "run_id")).alias("r")).select(F.col("r.run_id").alias("run_id"))
    return rows.join(newest, "run_id", "left_semi")


# ---------------------------------------------------------------- checks


def market_checks(m: Market) -> list[q.Check]:
    """The 33 checks. ``recon_pairs`` must be among the tables they run on."""
    price, cons = "fact_price_daily", "fact_price_daily_consensus"
    facts = (price, cons, "fact_corporate_action")
    out: list[q.Check] = []

    for spec in MARKET_TABLES.values():
        keys = ", ".join(spec.key)
        out.append(q.Unique(
            f"pk_unique__{spec.name}", spec.name, "error", f"values of ({keys}) held by several rows",
            keys=spec.key,
        ))
    out.append(q.Unique(
        "one_current_row_per_ticker", "dim_security", "error", "tickers with several current versions",
        rows="is_current", keys=("ticker",),
    ))

    def fk(kind: str, table: str, parent: str, key: str) -> q.Check:
        return q.ForeignKey(
            f"fk_{kind}__{table}", table, "error", f"rows whose {key} has no row in {parent}",
            keys=(key,), parent=parent,
        )

    out += [fk("security", f, "dim_security", "security_key") for f in facts]
    out += [fk("date", f, "dim_date", "date_key") for f in (*facts, "fact_macro_rate")]

    def rule(name: str, table: str, severity: str, description: str, fails: str, rows: str = "true"):
        return q.RowRule(name, table, severity, description, rows, fails)

    pairs = "reconciliation_flag in ('agreed', 'disagreed')"
    tol = m.tolerance
    out += [
        rule("not_null__dim_security_ticker", "dim_security", "error", "rows without a ticker",
             "ticker is null"),
        rule(f"not_null__{price}_adj_close", price, "error",
             "rows without adj_close, which returns and reconciliation need", "adj_close is null"),
        rule(f"not_null__{cons}_adj_close", cons, "error", "rows without adj_close",
             "adj_close is null"),
        rule(f"price_positive__{price}", price, "error", "rows with close or adj_close at or below zero",
             "close <= 0 or adj_close <= 0"),
        rule("null_price_fields", price, "warn",
             "rows missing a price field (NaN in the source arrives as NULL)", _any_null(PRICE_FIELDS)),
        rule("ohlc_high_ge_low", price, "warn", "rows with high below low", "high < low"),
        rule("ohlc_low_le_open", price, "warn", "rows with low above open", "low > open"),
        rule("ohlc_low_le_close", price, "warn", "rows with low above close", "low > close"),
        rule("ohlc_high_ge_open", price, "warn", "rows with high below open", "high < open"),
        rule("ohlc_high_ge_close", price, "warn", "rows with high below close", "high < close"),
        rule("consensus_flag_domain", cons, "error", "rows with an unknown reconciliation_flag",
             "reconciliation_flag is null or "
             "reconciliation_flag not in ('agreed', 'single_source', 'disagreed')"),
        rule("consensus_pct_diff_vs_flag", cons, "error",
             "single_source rows with a pct_diff, or compared rows without one",
             f"(reconciliation_flag = 'single_source' and pct_diff is not null) or ({pairs} and pct_diff is null)"),
        # strict on both sides: flags come from the unrounded difference, so a
        # disagreed row may be stored at exactly the tolerance
        rule("consensus_flag_vs_tolerance", cons, "error", "rows whose flag contradicts their own pct_diff",
             f"(reconciliation_flag = 'agreed' and pct_diff > {tol}) or "
             f"(reconciliation_flag = 'disagreed' and pct_diff < {tol})",
             "pct_diff is not null"),
        q.PairCount("recon_pair_count_match", cons, "error",
                    "recomputed pairs against rows flagged agreed or disagreed",
                    pairs="recon_pairs", expected=pairs),
        q.PairFlag("recon_flag_mismatch", cons, "warn",
                   "pairs whose recomputed flag differs from the stored one (rounding can flip it)",
                   pairs="recon_pairs", keys=PAIR_KEYS, stored="reconciliation_flag = 'disagreed'"),
        q.DistinctForeignKey("consensus_covers_price_keys", cons, "error",
                             "priced (security_key, date_key) without a consensus row",
                             keys=PAIR_KEYS, child=price),
        q.ForeignKey("security_without_prices", "dim_security", "warn", "current securities without a price",
                     "is_current", keys=("security_key",), parent=price),
        q.ForeignKey("trading_day_without_prices", "dim_date", "warn", "trading days without a price",
                     "is_trading_day", keys=("date_key",), parent=price),
        q.JoinRule("price_on_non_trading_day", price, "warn", "prices on non-trading days",
                   keys=("date_key",), other="dim_date", fails="not is_trading_day"),
    ]
    return out
