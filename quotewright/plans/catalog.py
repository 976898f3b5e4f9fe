"""Every operator as a query over the given tables, by name.

Each takes (spark, folder of Parquet tables). Doubles are rounded, so that equal
results compare equal across engines.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone
from functools import partial, reduce
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quotewright.functions.columns import first_violated, has_token, plain_number
from quotewright.operators import clean, control, fingerprint, history, quality, quantile, recon, series, star
from quotewright.operators.rows import repeat_rows
from quotewright.plans import bridge, runs
from quotewright.plans import market as mk
from quotewright.schemas import MARKET_TABLES, TableSpec
from quotewright.session import keep, new_folder
from quotewright.sources import exports, reports
from quotewright.sources.warehouse import Warehouse

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
M = bridge.MARKET
RUN = ("run", datetime(2024, 2, 1, tzinfo=timezone.utc))


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def rounded(df: DataFrame, digits: int = 9, deviation: int = 5) -> DataFrame:
    """Doubles to ``digits``; deviations, whose last bits depend on the order of
    summation, to ``deviation``."""
    doubles = [f.name for f in df.schema if isinstance(f.dataType, T.DoubleType)]

    def places(c: str) -> int:
        return deviation if "vol_" in c else min(digits, 7) if c == "log_return" else digits

    return df.withColumns({c: F.round(c, places(c)) for c in doubles})


def _returns(tables) -> DataFrame:
    return mk.price_returns(tables, M)


# ------------------------------------------------------------------ models


@query
def price_daily(spark, sf):
    return mk.price_daily(bridge.MarketTables(spark, sf))


@query
def price_trusted(spark, sf):
    return mk.price_trusted(bridge.MarketTables(spark, sf), M)


@query
def corporate_action(spark, sf):
    return mk.corporate_action(bridge.MarketTables(spark, sf))


@query
def macro_rate(spark, sf):
    return mk.macro_rate(bridge.MarketTables(spark, sf))


@query
def star_join_orders(spark, sf):
    """Two dimensions, the second reached through the first."""
    orders = bridge.read(spark, sf, "orders").withColumnRenamed("o_custkey", "c_custkey")
    customer = bridge.read(spark, sf, "customer").withColumnRenamed("c_nationkey", "n_nationkey")
    nation = bridge.read(spark, sf, "nation")
    joined = star.star_join(
        orders,
        [
            (customer, "c_custkey", {"c_mktsegment": "segment", "n_nationkey": "n_nationkey"}),
            (nation, "n_nationkey", {"n_name": "nation"}),
        ],
    )
    return joined.select("o_orderkey", "o_totalprice", "segment", "nation")


@query
def dim_security_current(spark, sf):
    return mk.dim_security_current(bridge.MarketTables(spark, sf))


@query
def calendar_dim(spark, sf):
    return mk.dim_date(bridge.MarketTables(spark, sf))


@query
def calendar_days(spark, sf):
    return bridge.MarketTables(spark, sf)["dim_date"]


@query
def trading_day_flag(spark, sf):
    """Days of the calendar flagged by whether any order was placed on them."""
    orders = bridge.read(spark, sf, "orders").select(F.col("o_orderdate").cast("date").alias("date"))
    days = bridge.MarketTables(spark, sf)["dim_date"].select("date_key", "date")
    return star.trading_days(days, orders, "date")


@query
def source_membership_flags(spark, sf):
    """The sources of each user and day as delimited text, and tokens read from it."""
    held = (
        bridge.read(spark, sf, "events")
        .groupBy("user_id", F.col("ts").cast("date").alias("day"))
        .agg(F.sort_array(F.collect_set("event_type")).alias("sources"))
    )
    listed = clean.clean_decimals(
        held, T.StructType.fromDDL("user_id BIGINT, day DATE, sources STRING")
    )
    flags = [has_token("sources", s).alias(f"has_{s}") for s in ("click", "view", "purchase", "clic")]
    return listed.select("*", *flags)


@query
def consensus_build(spark, sf):
    return bridge.MarketTables(spark, sf)["fact_price_daily_consensus"]


# ------------------------------------------------------------------ series


@query
def series_returns(spark, sf):
    return rounded(_returns(bridge.MarketTables(spark, sf)))


@query
def rolling_volatility(spark, sf):
    """Series cut into several ranges each."""
    out = series.returns(
        bridge.shipped_prices(partial(bridge.read, spark, sf)), "supplier", "day", "price",
        gap_days=10, window=21, annualise=252, ranges=9,
    )
    return rounded(out, deviation=4)


@query
def rolling_volatility_whole_series(spark, sf):
    """The same in one range, with a shorter window."""
    out = series.returns(
        bridge.shipped_prices(partial(bridge.read, spark, sf)), "supplier", "day", "price",
        gap_days=5, window=5, annualise=252, ranges=1,
    )
    return rounded(out, deviation=4)


@query
def series_returns_with_copies(spark, sf):
    """Order lines as three hot series with many copies and different rows a day."""
    lines = bridge.read(spark, sf, "lineitem").select(
        F.col("l_returnflag").alias("flag"), F.col("l_shipdate").cast("date").alias("day"),
        F.col("l_quantity").cast("decimal(18,6)").alias("price"), "l_linestatus",
    )
    out = series.returns(lines, "flag", "day", "price", gap_days=3, window=6, annualise=252, ranges=7)
    return rounded(out, deviation=3)


@query
def repeated_rows(spark, sf):
    """Order lines as often as their tax says in percent: up to eight times, or never."""
    lines = bridge.read(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", F.round(F.col("l_tax") * 100).cast("bigint").alias("times")
    )
    return repeat_rows(lines, "times").groupBy("l_orderkey", "l_linenumber").agg(F.count(F.lit(1)).alias("copies"))


@query
def latest_per_entity(spark, sf):
    return rounded(mk.latest_price(_returns(bridge.MarketTables(spark, sf)), M))


@query
def entity_summary(spark, sf):
    return rounded(mk.security_summary(_returns(bridge.MarketTables(spark, sf)), M))


@query
def sector_daily_return(spark, sf):
    return rounded(mk.sector_daily_return(_returns(bridge.MarketTables(spark, sf))))


# ---------------------------------------------------------- reconciliation


def _pairs(spark, sf) -> DataFrame:
    return mk.recon_pairs(bridge.MarketTables(spark, sf), M)


@query
def recon_pairs(spark, sf):
    return rounded(recon.recon_pairs(_pairs(spark, sf)))


@query
def recon_pairs_with_copies(spark, sf):
    """Order lines carry several rows per key and source, so pairs multiply."""
    lines = bridge.read(spark, sf, "lineitem").select(
        "l_partkey", F.col("l_returnflag").alias("source"),
        F.col("l_quantity").cast("decimal(18,6)").alias("qty"),
    )
    pairs = recon.weighted_pairs(lines, ["l_partkey"], "source", "A", "N", "qty", 0.5)
    return rounded(
        pairs.groupBy("l_partkey").agg(
            F.sum("pairs").alias("compared"),
            F.sum(F.col("is_flagged") * F.col("pairs")).alias("flagged"),
            F.max("pct_diff").alias("max_pct_diff"),
        )
    )


def _by_ticker(tables) -> DataFrame:
    return mk.recon_by_ticker(tables, keep(mk.recon_pairs(tables, M)))


@query
def recon_by_entity(spark, sf):
    return rounded(_by_ticker(bridge.MarketTables(spark, sf)))


@query
def grouped_median(spark, sf):
    """Exact median of a large group: line prices per return flag and status."""
    lines = bridge.read(spark, sf, "lineitem").select(
        "l_returnflag", "l_linestatus", "l_extendedprice", F.lit(1).alias("rows")
    )
    return rounded(
        quantile.grouped_median(lines, ["l_returnflag", "l_linestatus"], "l_extendedprice", "rows"), 6
    )


@query
def grouped_median_null_key(spark, sf):
    """Groups by a status that is NULL for a part of the lines."""
    lines = bridge.read(spark, sf, "lineitem").select(
        F.when(F.col("l_linenumber") < 5, F.col("l_returnflag")).alias("flag"), "l_extendedprice", F.lit(1).alias("rows")
    )
    return rounded(quantile.grouped_median(lines, ["flag"], "l_extendedprice", "rows"), 6)


@query
def recon_coverage(spark, sf):
    return mk.recon_coverage(bridge.MarketTables(spark, sf), M)


def _summary(tables) -> DataFrame:
    coverage = mk.recon_coverage(tables, M)
    return mk.recon_summary(mk.recon_pairs(tables, M), coverage, M)


@query
def recon_summary(spark, sf):
    return rounded(_summary(bridge.MarketTables(spark, sf)))


@query
def top_discrepancies(spark, sf):
    return rounded(recon.top_discrepancies(_pairs(spark, sf), mk.PAIR_KEYS, 10))


# ---------------------------------------------------- anomalies and health


def _line_bars(spark, sf) -> DataFrame:
    """Order lines read as bars whose ordering rules often fail."""
    def dec(c):
        return c.cast("decimal(18,6)")

    return bridge.read(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        dec(F.col("l_tax")).alias("open"),
        dec(F.col("l_quantity") / 10).alias("high"),
        dec(F.col("l_discount")).alias("low"),
        dec(F.col("l_extendedprice") / 10000).alias("close"),
    )


@query
def ordering_anomalies(spark, sf):
    return _line_bars(spark, sf).withColumn("violated_rule", first_violated(mk.OHLC_RULES)).where(
        "violated_rule is not null"
    )


@query
def first_anomalies(spark, sf):
    """The earliest ten violations, by order and line."""
    found = ordering_anomalies(spark, sf)
    order = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "violated_rule")
    return found.select(*order).orderBy(*order).limit(10)


@query
def price_anomalies(spark, sf):
    """Market bars whose open is delivered as their high."""
    daily = mk.price_daily(bridge.MarketTables(spark, sf))
    return mk.price_anomalies(daily.withColumn("high", F.col("open")))


@query
def first_price_anomalies(spark, sf):
    """The earliest ten of ``price_anomalies``, by the operator of the run's listing."""
    return mk.first_anomalies(price_anomalies(spark, sf))


@query
def platform_health(spark, sf):
    return mk.platform_health(bridge.MarketTables(spark, sf))


@query
def null_price_by_entity(spark, sf):
    """Bars of a single event have no range: their high and low count as missing."""
    daily = mk.price_daily(bridge.MarketTables(spark, sf))
    ranged = F.col("volume") > 1
    return mk.null_prices(
        daily.withColumns({c: F.when(ranged, F.col(c)) for c in ("high", "low")})
    )


@query
def entities_without_rows(spark, sf):
    return mk.securities_without_prices(bridge.MarketTables(spark, sf))


# ---------------------------------------------------- cleaning, fingerprints

_LINE = (
    "l_orderkey BIGINT, l_linenumber INT, l_discount DECIMAL(18,6), l_tax DECIMAL(18,6), "
    "l_extendedprice DECIMAL(18,6), flags STRING"
)


def _dirty_lines(spark, sf) -> DataFrame:
    """Order lines with zero rates as NaN and the two flags as an array."""
    def holed(c):
        return F.when(F.col(c) == 0, F.lit(float("nan"))).otherwise(F.col(c)).alias(c.upper())

    return bridge.read(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", holed("l_discount"), holed("l_tax"), "l_extendedprice",
        F.array("l_returnflag", "l_linestatus").alias("flags"),
    )


@query
def nan_census(spark, sf):
    return clean.schema_nan_census(_dirty_lines(spark, sf), T.StructType.fromDDL(_LINE))


@query
def clean_projection(spark, sf):
    return clean.clean_decimals(_dirty_lines(spark, sf), T.StructType.fromDDL(_LINE))


@query
def canonical_numbers(spark, sf):
    """Decimal text without trailing zeros, for display of figures."""
    lines = bridge.read(spark, sf, "lineitem")
    shown = [plain_number(c).alias(c) for c in ("l_discount", "l_quantity", "l_extendedprice")]
    return lines.select("l_orderkey", "l_linenumber", *shown)


def _register_fingerprint(name: str) -> None:
    def fn(spark, sf):
        spec = MARKET_TABLES[name]
        return fingerprint.fingerprint(
            bridge.MarketTables(spark, sf)[name], name, spec.fingerprints
        )

    QUERIES[f"fingerprint_{name}"] = fn


for _name in MARKET_TABLES:
    _register_fingerprint(_name)

_LINE_METRICS = {
    "row_count": "count(1)",
    "distinct_orders": "count(distinct l_orderkey)",
    "sum_discount": "sum(l_discount)",
    "sum_tax": "sum(l_tax)",
    "null_tax": "count_if(l_tax is null)",
}


def _two_copies(spark, sf) -> tuple[DataFrame, DataFrame]:
    """Fingerprints of the order lines, and of a copy with one rate nudged by a
    micro-unit on returned lines and one metric missing."""
    lines = bridge.read(spark, sf, "lineitem").select(
        "l_orderkey", "l_returnflag",
        *[F.col(c).cast("decimal(18,6)").alias(c) for c in ("l_discount", "l_tax")],
    )
    micro = F.when(F.col("l_returnflag") == "R", F.lit("0.000001").cast("decimal(18,6)")).otherwise(0)
    nudged = lines.withColumn("l_discount", (F.col("l_discount") + micro).cast("decimal(18,6)"))
    kept = {m: sql for m, sql in _LINE_METRICS.items() if m != "distinct_orders"}
    return (
        fingerprint.fingerprint(lines, "lineitem", _LINE_METRICS),
        fingerprint.fingerprint(nudged, "lineitem", kept),
    )


@query
def fingerprint_compare(spark, sf):
    return fingerprint.compare_fingerprints(*_two_copies(spark, sf))


@query
def load_log(spark, sf):
    """Loads of the six tables against copies that lost one source's prices."""
    tables = bridge.MarketTables(spark, sf)
    lost = {
        **tables,
        "fact_price_daily": tables["fact_price_daily"].where("source <> 'error'"),
        "fact_corporate_action": tables["fact_corporate_action"].where("value < 400000"),
    }
    log = fingerprint.load_log(
        runs.observed_fingerprints(tables), runs.observed_fingerprints(lost), *RUN
    )
    return log.select(
        "table_name", "rows_expected", "rows_loaded", "fingerprint_match",
        F.size(F.split(F.coalesce("mismatch_detail", F.lit("")), "; ")).alias("messages"),
        F.substring_index(F.coalesce("mismatch_detail", F.lit("")), ":", 1).alias("first_metric"),
    )


# ------------------------------------------------------------ data quality

_SHOWN = ("check_name", "table_name", "severity", "status", "failing_count", "checked_rows")


def _checked(checks, tables) -> DataFrame:
    return quality.run_checks(checks, tables, *RUN).select(*_SHOWN)


def _order_tables(spark, sf) -> dict[str, DataFrame]:
    return {
        "lines": _line_bars(spark, sf),
        "orders": bridge.read(spark, sf, "orders")
        .withColumnsRenamed({"o_orderkey": "l_orderkey", "o_custkey": "c_custkey"}),
        "customer": bridge.read(spark, sf, "customer"),
        "good_customer": bridge.read(spark, sf, "customer").where("c_acctbal >= 0"),
        "events": bridge.read(spark, sf, "events").withColumnRenamed("user_id", "c_custkey"),
    }


@query
def dq_unique(spark, sf):
    u, t = quality.Unique, _order_tables(spark, sf)
    return _checked(
        [
            u("unique_line", "lines", "error", "", keys=("l_orderkey", "l_linenumber")),
            u("unique_order", "orders", "error", "", keys=("l_orderkey",)),
            u("one_open_order", "orders", "warn", "", "o_orderstatus = 'O'", ("c_custkey",)),
        ],
        t,
    )


@query
def dq_foreign_key(spark, sf):
    fk, t = quality.ForeignKey, _order_tables(spark, sf)
    return _checked(
        [
            fk("line_order", "lines", "error", "", keys=("l_orderkey",), parent="orders"),
            fk("order_customer", "orders", "error", "", keys=("c_custkey",), parent="good_customer"),
            fk("event_customer", "events", "warn", "", "value > 10", ("c_custkey",), "good_customer"),
            fk("customer_orders", "customer", "warn", "", "c_acctbal > 0", ("c_custkey",), "orders"),
        ],
        t,
    )


@query
def dq_row_rules(spark, sf):
    rules = [
        quality.RowRule(name, "lines", "warn", "", "true", predicate)
        for name, predicate in mk.OHLC_RULES
    ]
    rules += [
        quality.RowRule("positive", "lines", "error", "", "true", "open <= 0 or low <= 0"),
        quality.RowRule("known", "lines", "error", "", "high > 2.5", "close is null"),
    ]
    return _checked(rules, _order_tables(spark, sf))


@query
def dq_join_rules(spark, sf):
    rule, t = quality.JoinRule, _order_tables(spark, sf)
    return _checked(
        [
            rule("line_of_open_order", "lines", "warn", "", keys=("l_orderkey",), other="orders",
                 fails="o_orderstatus = 'O'"),
            rule("event_of_debtor", "events", "warn", "", keys=("c_custkey",), other="customer",
                 fails="not (c_acctbal >= 0)"),
        ],
        t,
    )


@query
def dq_anti_distinct(spark, sf):
    check = quality.DistinctForeignKey(
        "orders_cover_customers", "orders", "error", "", child="good_customer", keys=("c_custkey",)
    )
    return _checked([check], _order_tables(spark, sf))


@query
def dq_abs_diff(spark, sf):
    """Pairs recomputed at a tighter tolerance against the stored consensus."""
    market, cons = bridge.MarketTables(spark, sf), "fact_price_daily_consensus"
    pairs = recon.weighted_pairs(
        market["fact_price_daily"], mk.PAIR_KEYS, "source", M.source_a, M.source_b, "adj_close", 0.25
    )
    tables = {cons: market[cons], "recon_pairs": pairs}
    return _checked(
        [
            quality.PairCount("pair_count", cons, "error", "", pairs="recon_pairs",
                              expected="reconciliation_flag = 'agreed'"),
            quality.PairFlag("pair_flag", cons, "warn", "", pairs="recon_pairs", keys=mk.PAIR_KEYS,
                             stored="reconciliation_flag = 'disagreed'"),
        ],
        tables,
    )


def _all_results(tables) -> DataFrame:
    checked = {**tables, "recon_pairs": keep(mk.recon_pairs(tables, M))}
    return quality.run_checks(mk.market_checks(M), checked, *RUN)


@query
def dq_results_all(spark, sf):
    return _all_results(bridge.MarketTables(spark, sf, kept=True)).select(*_SHOWN)


@query
def dq_status_tally(spark, sf):
    return quality.status_tally(_all_results(bridge.MarketTables(spark, sf, kept=True)))


@query
def dq_not_passed(spark, sf):
    return quality.not_passed(_all_results(bridge.MarketTables(spark, sf, kept=True)))


# -------------------------------------------------- audit rows and control


def _daily_runs(spark, sf) -> DataFrame:
    """An audit log out of the events: a day is a run, a type a table."""
    return (
        bridge.read(spark, sf, "events")
        .groupBy(
            F.date_format("ts", "'run-'yyyyMMdd").alias("run_id"),
            F.col("event_type").alias("table_name"),
        )
        .agg(F.count(F.lit(1)).alias("rows_loaded"), F.max("ts").alias("loaded_at"))
    )


@query
def latest_run_rows(spark, sf):
    log = _daily_runs(spark, sf)
    return mk.latest_run(log, log, "loaded_at").select("run_id", "table_name", "rows_loaded")


def _looser(tables) -> tuple[DataFrame, DataFrame]:
    """Published figures as a report of a looser tolerance would give them, for
    one date; per ticker, only those with a flagged pair."""
    pairs = recon.weighted_pairs(
        tables["fact_price_daily"], mk.PAIR_KEYS, "source", M.source_a, M.source_b, "adj_close", 1.0
    )
    day = F.lit("2024-01-31").cast("date").alias("report_ingest_date")
    coverage = mk.recon_coverage(tables, M)
    head = mk.recon_summary(pairs, coverage, M).select(day, *M.control_figures)
    described = star.star_join(pairs, [(tables["dim_security"], "security_key", {"ticker": "ticker"})])
    by_ticker = (
        described.groupBy("ticker")
        .agg(F.sum(F.col("is_flagged") * F.col("pairs")).alias("flagged"))
        .where("flagged > 0")
        .select(day, "ticker", "flagged")
    )
    return head, by_ticker


@query
def control_compare_headline(spark, sf):
    tables = bridge.MarketTables(spark, sf, kept=True)
    return control.headline_differences(
        _summary(tables), _looser(tables)[0], M.control_figures
    )


@query
def control_compare_by_entity(spark, sf):
    tables = bridge.MarketTables(spark, sf, kept=True)
    return control.entity_differences(_by_ticker(tables), _looser(tables)[1], "ticker")


@query
def control_results(spark, sf):
    tables = bridge.MarketTables(spark, sf, kept=True)
    head, by_ticker = _looser(tables)
    out = control.control_results(
        _summary(tables), _by_ticker(tables), head, by_ticker, M.control_figures,
        datetime(2024, 1, 31).date(), *RUN,
    )
    return out.select(*_SHOWN)


@query
def control_results_without_report(spark, sf):
    """No control row for the date: the figures fail with a NULL count."""
    tables = bridge.MarketTables(spark, sf, kept=True)
    head, by_ticker = _looser(tables)
    out = control.control_results(
        _summary(tables), _by_ticker(tables), head, by_ticker, M.control_figures,
        datetime(2024, 2, 1).date(), *RUN,
    )
    return out.select(*_SHOWN)


# ----------------------------------------------------------------- reports


def _report_texts(spark, sf) -> DataFrame:
    """One published report per security, in the layout the parser reads. The row
    of a security flagged on every compared day is left out of its report."""
    tables = bridge.MarketTables(spark, sf, kept=True)
    a, b = M.source_a, M.source_b
    coverage = mk.recon_coverage(tables, M)
    seen = _by_ticker(tables).drop("ticker", "gics_sector")
    figures = coverage.join(seen, "security_key", "left").withColumns(
        {
            "code": F.upper(F.translate("ticker", "#", "-")),
            "flagged": F.coalesce("flagged", F.lit(0)),
            "compared": F.coalesce("compared", F.lit(0)),
        }
    )
    affected = F.when(F.col("flagged") > 0, 1).otherwise(0)
    row = F.format_string(
        "  %s  %d  %d  1.0%%  2.00%%  1.00%%  %s to %s\n",
        "code", "flagged", "compared",
        F.col("first_flagged_date").cast("string"), F.col("last_flagged_date").cast("string"),
    )
    shown = (F.col("flagged") > 0) & (F.col("flagged") < F.col("compared"))
    text = F.concat(
        F.lit("Reconciliation report - ingest_date=2024-01-31\n"),
        F.format_string("  Compared: %d (ticker, date) pairs present in both sources\n", "compared"),
        F.format_string("  Flagged (> 50.00%% adj_close discrepancy): %d (1.00%%)\n", "flagged"),
        F.format_string(f"  Present only in {a} (coverage gap): %d\n", f"{a}_only_rows"),
        F.format_string(f"  Present only in {b} (coverage gap): %d\n\n", f"{b}_only_rows"),
        F.format_string("  Affected tickers: %d of %d compared - see below\n", affected,
                        F.when(F.col("compared") > 0, 1).otherwise(0)),
        F.lit("  ticker  flagged  compared  flagged%  max diff  median diff  flagged window\n"),
        F.when(shown, row).otherwise(""),
        F.lit("\n  Free text with 12 numbers and 2024-01-01 to 2024-01-02 in it.\n"),
    )
    return figures.select(F.col("code").alias("report"), text.alias("text"))


def _parsed(spark, sf) -> reports.ParsedReports:
    return reports.parse_reports(
        _report_texts(spark, sf), (M.source_a, M.printed_a), (M.source_b, M.printed_b)
    )


@query
def report_headlines(spark, sf):
    return _parsed(spark, sf).headline


@query
def report_tickers(spark, sf):
    return _parsed(spark, sf).entities


@query
def report_rejects(spark, sf):
    return _parsed(spark, sf).rejects


# ---------------------------------------------------------- writes and runs


def _exported(spark, sf, folder: str) -> DataFrame:
    tables = exports.snapshot(bridge.MarketTables(spark, sf))
    return exports.export_all(tables, MARKET_TABLES, folder, RUN[1])


@query
def export_manifest(spark, sf):
    """Rows and fingerprints the manifest of an export records."""
    folder = new_folder(spark)
    _exported(spark, sf, folder)
    return exports.manifest_fingerprints(exports.read_manifest(spark, folder))


def _typed(name: str, key: tuple[str, ...], metrics: dict[str, str], **columns) -> TableSpec:
    schema = T.StructType([T.StructField(c, t) for c, t in columns.items()])
    return TableSpec(name, schema, key, metrics)


_BIG, _INT, _TEXT, _PRICE = T.LongType(), T.IntegerType(), T.StringType(), T.DecimalType(18, 6)
ORDER_TABLES = {
    "lineitem": _typed(
        "lineitem", ("l_orderkey", "l_linenumber"),
        {"distinct_orders": "count(distinct l_orderkey)", "sum_price": "sum(l_extendedprice)"},
        l_orderkey=_BIG, l_linenumber=_INT, l_partkey=_BIG, l_suppkey=_BIG, l_quantity=_PRICE,
        l_extendedprice=_PRICE, l_discount=_PRICE, l_tax=_PRICE, l_returnflag=_TEXT, l_linestatus=_TEXT,
        l_shipdate=T.DateType(),
    ),
    "orders": _typed(
        "orders", ("o_orderkey",),
        {"max_order": "max(o_orderkey)", "sum_price": "sum(o_totalprice)"},
        o_orderkey=_BIG, o_custkey=_BIG, o_orderstatus=_TEXT, o_totalprice=_PRICE,
        o_orderdate=T.DateType(), o_orderpriority=_TEXT,
    ),
    "events": _typed(
        "events", ("event_id",),
        {"distinct_users": "count(distinct user_id)", "sum_value": "sum(value)"},
        event_id=_BIG, user_id=_BIG, event_type=_TEXT, value=_PRICE, props=_TEXT,
    ),
}


@query
def export_order_tables(spark, sf):
    """The large given tables exported as they are, by the same operator."""
    folder = new_folder(spark)
    tables = {name: bridge.read(spark, sf, name) for name in ORDER_TABLES}
    manifest = exports.export_all(tables, ORDER_TABLES, folder, RUN[1])
    return exports.manifest_fingerprints(manifest)


@query
def export_files(spark, sf):
    """Files and bytes the manifest records, against a second look at the files."""
    folder = new_folder(spark)
    manifest = _exported(spark, sf, folder).select("table_name", "files", "bytes")
    again = [
        exports.file_hashes(spark, f"{folder}/{t}.parquet").select(F.lit(t).alias("table_name"), "file", "sha256")
        for t in MARKET_TABLES
    ]
    listed = [
        spark.read.schema("table_name STRING, file STRING, sha256 STRING").json(
            f"{folder}/manifest_files/{t}"
        )
        for t in MARKET_TABLES
    ]
    same = reduce(DataFrame.unionByName, again).join(
        reduce(DataFrame.unionByName, listed), ["table_name", "file", "sha256"]
    )
    counted = same.groupBy("table_name").agg(F.count(F.lit(1)).alias("same_files"))
    return manifest.join(counted, "table_name").select(
        "table_name", (F.col("files") == F.col("same_files")).alias("all_files_same"),
        (F.col("bytes") > 0).alias("has_bytes"),
    )


@query
def ordered_write(spark, sf):
    """The bars written in key order and read back, behind the write guard."""
    folder, spec = new_folder(spark), MARKET_TABLES["fact_price_daily"]
    df = bridge.MarketTables(spark, sf)["fact_price_daily"]
    written = exports.write_ordered(df, folder, spec.key)
    exports.guard_write(spark, folder, spec.schema, df.count(), int(written.get["rows"]))
    return exports.read_typed(spark, folder, spec.schema)


def _warehouse(spark) -> Warehouse:
    return Warehouse(spark, new_folder(spark), f"qw_{uuid4().hex[:8]}_")


@query
def full_refresh(spark, sf):
    """A table loaded twice: the second load replaces the first."""
    wh, spec = _warehouse(spark), MARKET_TABLES["fact_macro_rate"]
    wh.create({spec.name: spec}, M.source_a, M.source_b)
    rates = bridge.MarketTables(spark, sf)["fact_macro_rate"]
    for run_id, df in (("first", rates.where("value < 100000")), ("second", rates)):
        wh.publish(wh.stage(df, run_id, "raw", spec.name), run_id, "raw", spec.name)
    return wh.table("raw", spec.name)


@query
def audit_append(spark, sf):
    """Two appended blocks of load log rows, one per half of the event types."""
    wh = _warehouse(spark)
    wh.create({}, M.source_a, M.source_b)
    stamped = _daily_runs(spark, sf).select(
        "run_id", "table_name", F.col("rows_loaded").alias("rows_expected"), "rows_loaded",
        F.lit(True).alias("fingerprint_match"), F.lit(None).alias("mismatch_detail"),
        F.col("loaded_at").alias("loaded_at_utc"),
    )
    early = F.col("table_name") < "purchase"
    wh.append(stamped.where(early), "load_log")
    wh.append(stamped.where(~early), "load_log")
    return wh.table("mart", "load_log").select(
        "run_id", "table_name", "rows_expected", "rows_loaded", "fingerprint_match"
    )


@query
def audit_record_twice(spark, sf):
    """Load log rows of the runs, each run recorded by two writers: the last one counts."""
    wh = _warehouse(spark)
    wh.create({}, M.source_a, M.source_b)
    stamped = keep(_daily_runs(spark, sf).groupBy(F.substring("run_id", -2, 1).alias("run_id"), "table_name").agg(
        F.sum("rows_loaded").alias("rows_loaded"), F.max("loaded_at").alias("loaded_at_utc")
    ))
    rows = stamped.select(
        "run_id", "table_name", F.col("rows_loaded").alias("rows_expected"), "rows_loaded",
        F.lit(True).alias("fingerprint_match"), F.lit(None).alias("mismatch_detail"), "loaded_at_utc",
    )
    runs_ = [r.run_id for r in rows.select("run_id").distinct().orderBy("run_id").collect()]
    for run_id in runs_ + runs_:
        wh.record(rows.where(F.col("run_id") == run_id), "load_log", run_id)
    return wh.table("mart", "load_log").select("run_id", "table_name", "rows_expected", "rows_loaded", "fingerprint_match")


@query
def pinned_snapshot(spark, sf):
    """Rows and figures of copies of three tables at one moment."""
    copies = exports.pinned_snapshot(spark, {t: f"{sf}/{t}.parquet" for t in ("customer", "lineitem", "orders")})
    sums = {"customer": F.sum("c_nationkey"), "lineitem": F.sum("l_linenumber"), "orders": F.sum("o_custkey")}
    counted = [copies[t].agg(F.count("*").alias("n_rows"), s.cast("long").alias("total")).select(F.lit(t).alias("table_name"), "*") for t, s in sums.items()]
    return reduce(DataFrame.unionAll, counted)


@query
def state_history(spark, sf):
    """Ranges of months in which a customer's orders show the same priority and status."""
    orders = bridge.read(spark, sf, "orders").select(
        "o_custkey", F.trunc("o_orderdate", "MM").alias("month"), F.col("o_orderstatus").alias("status"),
        F.when(F.substring("o_orderpriority", 1, 1) < "4", F.substring("o_orderpriority", 1, 1)).alias("priority"),
    )
    return history.state_history(orders, ["o_custkey"], "month", ["priority", "status"])


@query
def content_digests(spark, sf):
    """Whether the digest of each table is that of its rows in another order and layout, and
    whether it tells them from rows two of whose columns were exchanged between rows."""
    parts = []
    for name, key, moved in (("orders", "o_orderkey", "o_orderpriority"), ("customer", "c_custkey", "c_mktsegment")):
        rows = bridge.read(spark, sf, name)
        shuffled = rows.select(*reversed(rows.columns)).repartition(7, key)
        ranks = W.partitionBy(F.pmod(key, F.lit(50))).orderBy(key)
        swapped = rows.withColumn(moved, F.coalesce(F.lead(moved).over(ranks), F.lit("")))
        for kind, df in (("given", rows), ("shuffled", shuffled), ("swapped", swapped)):
            parts.append(fingerprint.content_digest(df).select(F.lit(name).alias("table_name"), F.lit(kind).alias("kind"), "*"))
    of = lambda kind, c: F.max(F.when(F.col("kind") == kind, F.col(c)))
    return reduce(DataFrame.unionAll, parts).groupBy("table_name").agg(
        of("given", "rows").alias("n_rows"),
        (of("given", "digest") == of("shuffled", "digest")).alias("same"),
        (of("given", "digest") != of("swapped", "digest")).alias("told_apart"),
    )


@query
def control_partition_replace(spark, sf):
    """Control rows of one date written twice with different figures, and of a
    date whose second report lists no ticker."""
    wh, tables = _warehouse(spark), bridge.MarketTables(spark, sf)
    wh.create({}, M.source_a, M.source_b)
    rows = keep(_by_ticker(tables)).select(
        "ticker", "flagged", "compared",
        F.col("first_flagged_date").alias("first_flagged"), F.col("last_flagged_date").alias("last_flagged"),
    )
    name, column = "recon_report_control_ticker", "report_ingest_date"
    for day, part in (
        ("2024-01-30", rows),
        ("2024-01-31", rows),
        ("2024-01-31", rows.where("flagged > 0")),
        ("2024-01-30", rows.where("flagged < 0")),
    ):
        wh.replace(part, name, column, day)
    return wh.table("mart", name)


@query
def bi_measures(spark, sf):
    log = _daily_runs(spark, sf)
    loads = mk.latest_run(log, log, "loaded_at").withColumn(
        "fingerprint_match", F.col("rows_loaded") > 60
    )
    tables = bridge.MarketTables(spark, sf, kept=True)
    returns = keep(_returns(tables))
    return rounded(
        mk.measures(
            returns, mk.latest_price(returns, M), _summary(tables), _all_results(tables), loads, M
        ),
        6,
    )


@query
def market_run(spark, sf):
    """Export, load, verify, publish, build and check; the run's results."""
    folder = new_folder(spark)
    _exported(spark, sf, folder)
    return runs.run_market(_warehouse(spark), folder, M).results.select(*_SHOWN)


@query
def market_run_listings(spark, sf):
    """What an inspection shows after a run: the reconciliation totals."""
    folder, wh = new_folder(spark), _warehouse(spark)
    _exported(spark, sf, folder)
    runs.run_market(wh, folder, M)
    return rounded(runs.inspect(wh)["reconciliation"])


@query
def market_run_lists(spark, sf):
    """The three lists an inspection shows beside the totals, in one long form."""
    folder, wh = new_folder(spark), _warehouse(spark)
    _exported(spark, sf, folder)
    runs.run_market(wh, folder, M)
    shown = runs.inspect(wh)

    def listed(name: str, **columns) -> DataFrame:
        none = F.lit(None).cast("string")
        wanted = [columns.get(c, none).cast("string").alias(c) for c in ("source", "detail")]
        return shown[name].select(F.lit(name).alias("listing"), "ticker", *wanted)

    lists = [
        listed("null_prices", source=F.col("source"), detail=F.col("n_rows")),
        listed("securities_without_prices"),
        listed("anomalies", source=F.col("source"), detail=F.concat_ws(" ", "trade_date", "violated_rule")),
    ]
    return reduce(DataFrame.unionByName, lists)
