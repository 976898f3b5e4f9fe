"""The market's six tables derived from the order, customer and event tables.

Prices: the events of one user, day and type form a bar; user is the security and
type the source, click against view. The view source does not cover customers of
one market segment, and customers with a negative balance are not securities, so
coverage gaps and orphan facts occur.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import cache, partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quotewright.functions.columns import date_key
from quotewright.operators import star
from quotewright.operators.clean import conform
from quotewright.plans.market import Market
from quotewright.schemas import BIG, INT, LOCAL_STAMP, MARKET_TABLES, NUMBER, TEXT, columns
from quotewright.session import keep

MARKET = Market(
    source_a="click", source_b="view", printed_a="click", printed_b="view",
    tolerance=0.5, gap_days=3, window=7,
)
UNCOVERED = "MACHINERY"
# Columns of the given tables that are used; reading them needs no look at a file.
GIVEN = {
    "nation": columns(n_nationkey=INT, n_name=TEXT, n_regionkey=INT),
    "customer": columns(
        c_custkey=BIG, c_name=TEXT, c_nationkey=INT, c_acctbal=NUMBER, c_mktsegment=TEXT
    ),
    "orders": columns(
        o_orderkey=BIG, o_custkey=BIG, o_orderstatus=TEXT, o_totalprice=NUMBER,
        o_orderdate=LOCAL_STAMP, o_orderpriority=TEXT,
    ),
    "lineitem": columns(
        l_orderkey=BIG, l_partkey=BIG, l_suppkey=BIG, l_linenumber=INT, l_quantity=NUMBER,
        l_extendedprice=NUMBER, l_discount=NUMBER, l_tax=NUMBER, l_returnflag=TEXT,
        l_linestatus=TEXT, l_shipdate=LOCAL_STAMP,
    ),
    "events": columns(
        event_id=BIG, ts=LOCAL_STAMP, user_id=BIG, event_type=TEXT, value=NUMBER, props=TEXT
    ),
}
# opens a given table by name
Given = Callable[[str], DataFrame]


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(GIVEN[name]).parquet(f"{sf_dir}/{name}.parquet")


class MarketTables(Mapping):
    """The six tables by name. Each is put together when first asked for, and each
    given table is opened once. ``kept`` writes the two price tables out, for
    queries that read them in many branches."""

    def __init__(self, spark: SparkSession, sf_dir: str, kept: bool = False):
        self.given = cache(partial(read, spark, sf_dir))
        self.kept = kept
        self._made: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._made:
            if name == "fact_price_daily_consensus":
                made = consensus(self["fact_price_daily"])
            else:
                made = _BUILDERS[name](self.given)
            written = self.kept and name.startswith("fact_price_daily")
            self._made[name] = keep(made) if written else made
        return self._made[name]

    def __iter__(self):
        return iter(MARKET_TABLES)

    def __len__(self) -> int:
        return len(MARKET_TABLES)


def bars(given: Given) -> DataFrame:
    """Open, high, low, close and volume per security, day and source."""
    events = given("events").select(
        F.col("user_id").cast("int").alias("security_key"),
        F.col("ts").cast("date").alias("day"),
        F.col("event_type").alias("source"),
        "event_id",
        "value",
    )
    return events.groupBy("security_key", "day", "source").agg(
        F.min_by("value", "event_id").alias("open"),
        F.max("value").alias("high"),
        F.min("value").alias("low"),
        F.max_by("value", "event_id").alias("close"),
        F.count(F.lit(1)).alias("volume"),
    )


def fact_price_daily(given: Given) -> DataFrame:
    uncovered = (
        given("customer")
        .where(F.col("c_mktsegment") == UNCOVERED)
        .select(
            F.col("c_custkey").cast("int").alias("security_key"),
            F.lit(MARKET.source_b).alias("source"),
        )
    )
    covered = bars(given).join(uncovered, ["security_key", "source"], "left_anti")
    adjusted = {f"adj_{c}": F.col(c) for c in ("open", "high", "low", "close", "volume")}
    full = covered.withColumn("date_key", date_key("day")).withColumns(adjusted)
    return conform(full, MARKET_TABLES["fact_price_daily"].schema)


def dim_security(given: Given) -> DataFrame:
    current = F.col("c_acctbal") >= 1000
    customers = given("customer").where("c_acctbal >= 0").select(
        F.col("c_custkey").alias("security_key"),
        F.col("c_name").alias("ticker"),
        F.concat(F.lit("Company "), "c_name").alias("company_name"),
        F.col("c_mktsegment").alias("gics_sector"),
        F.concat(F.lit("NATION_"), "c_nationkey").alias("gics_sub_industry"),
        F.concat(F.lit("F"), "c_custkey").alias("figi"),
        F.date_add(F.lit("2020-01-01").cast("date"), F.col("c_nationkey")).alias("effective_from"),
        F.when(~current, F.lit("2023-12-31")).alias("effective_to"),
        current.alias("is_current"),
    )
    return conform(customers, MARKET_TABLES["dim_security"].schema)


def dim_date(given: Given) -> DataFrame:
    def span(name: str, column: str) -> DataFrame:
        day = F.col(column).cast("date")
        return given(name).agg(F.min(day).alias("first"), F.max(day).alias("last"))

    days = star.calendar(span("orders", "o_orderdate").unionByName(span("events", "ts")))
    return conform(
        days.withColumn("is_trading_day", F.col("is_weekday")), MARKET_TABLES["dim_date"].schema
    )


def fact_corporate_action(given: Given) -> DataFrame:
    actions = given("orders").select(
        F.col("o_custkey").alias("security_key"),
        date_key(F.col("o_orderdate").cast("date")).alias("date_key"),
        F.when(F.col("o_orderstatus") == "O", "dividend").otherwise("split").alias("action_type"),
        F.col("o_totalprice").alias("value"),
        F.col("o_orderpriority").alias("source"),
    )
    return conform(actions, MARKET_TABLES["fact_corporate_action"].schema)


def fact_macro_rate(given: Given) -> DataFrame:
    rates = (
        given("orders")
        .groupBy(
            date_key(F.col("o_orderdate").cast("date")).alias("date_key"),
            F.col("o_orderpriority").alias("series_id"),
        )
        .agg(F.max("o_totalprice").alias("value"))
    )
    return conform(rates, MARKET_TABLES["fact_macro_rate"].schema)


def consensus(prices: DataFrame) -> DataFrame:
    m = MARKET
    agreed = star.consensus(
        prices, ["security_key", "date_key"], "source", m.source_a, m.source_b, "adj_close", m.tolerance
    )
    return conform(agreed, MARKET_TABLES["fact_price_daily_consensus"].schema)


_BUILDERS: dict[str, Callable[[Given], DataFrame]] = {
    "dim_date": dim_date,
    "dim_security": dim_security,
    "fact_price_daily": fact_price_daily,
    "fact_corporate_action": fact_corporate_action,
    "fact_macro_rate": fact_macro_rate,
}


def shipped_prices(given: Given) -> DataFrame:
    """A long daily series: the highest line price per supplier and ship date."""
    return (
        given("lineitem")
        .groupBy(
            F.col("l_suppkey").cast("int").alias("supplier"),
            F.col("l_shipdate").cast("date").alias("day"),
        )
        .agg(F.max("l_extendedprice").cast("decimal(18,6)").alias("price"))
    )
