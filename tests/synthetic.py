"""A quarter of a small market with known faults; expected figures are counted from it.

KILO  both sources, b from the seventh trading day on; a renamed old version
LIMA  both; b is 4% lower on every third day from the tenth on
MIKE  both, silent for twelve days in June; one print of b with its high below the bar
NOVA  only b
OSLO  only a; some adjusted prices are missing
"""

from __future__ import annotations

from dataclasses import dataclass, replace
from datetime import date, timedelta
from decimal import Decimal

from pyspark.sql import functions as F

from quotewright.operators import star
from quotewright.schemas import MARKET_TABLES, PRICE_FIELDS

A, B = "yfinance", "tiingo"
FIRST, LAST = date(2022, 5, 2), date(2022, 7, 29)
CLOSED = {date(2022, 5, 30), date(2022, 7, 4)}
SILENT = {date(2022, 6, 6) + timedelta(i) for i in range(12)}
KEYS = {"KILO": 11, "LIMA": 12, "MIKE": 13, "NOVA": 14, "OSLO": 15}
SECTORS = {"KILO": "Materials", "LIMA": "Materials", "MIKE": "Health", "NOVA": "Health", "OSLO": "Transport"}
TRADING = [
    d for d in (FIRST + timedelta(i) for i in range((LAST - FIRST).days + 1)) if d.weekday() < 5 and d not in CLOSED
]
BAD_PRINT = ("MIKE", B, TRADING[12])
OFF_DAYS = TRADING[9::3]
MISSING = {("OSLO", TRADING[4]): ("adj_low", "adj_high"), ("OSLO", TRADING[5]): ("adj_open",)}
RATES = {"SOFR": "0.79", "PRIME": "4.0", "T1Y": "2.08"}
SINGLE, SHARED = ("OSLO", TRADING[1]), ("KILO", TRADING[20])  # of one source; of both, agreed


@dataclass(frozen=True)
class Bar:
    """Prices in hundredths, except the consensus price, which has six places."""

    ticker: str
    source: str
    day: date
    open: int
    high: int
    low: int
    close: int
    adj_close: Decimal
    volume: int

    @property
    def at(self) -> tuple[str, date]:
        return self.ticker, self.day


def key_of(d: date) -> int:
    return d.year * 10000 + d.month * 100 + d.day


def _where(at: tuple[str, date]) -> str:
    return f"security_key = {KEYS[at[0]]} and date_key = {key_of(at[1])}"


ONE, BOTH = _where(SINGLE), _where(SHARED)


def bars() -> list[Bar]:
    out = []
    for ticker, k in KEYS.items():
        for i, d in enumerate(TRADING):
            close = 100 * k + 7 * i + (i * i * k) % 53 - (i * 29) % 17
            opened = close + (i * k) % 9 - 4
            bar = Bar(
                ticker, A, d, opened, max(opened, close) + 12, min(opened, close) - 15, close,
                Decimal(close * 9).scaleb(-3), 5000 * k + 11 * i,
            )
            if ticker == "MIKE" and d in SILENT:
                continue
            if ticker != "NOVA":
                out.append(bar)
            if ticker == "OSLO" or (ticker == "KILO" and i < 6):
                continue
            off = Decimal("0.96") if ticker == "LIMA" and d in OFF_DAYS else Decimal(100_000 + i % 7) / 100_000
            other = replace(bar, source=B, adj_close=(bar.adj_close * off).quantize(Decimal("0.000001")))
            if (ticker, B, d) == BAD_PRINT:
                other = replace(other, high=min(opened, close) - 1)
            out.append(other)
    return out


def price_rows() -> list[tuple]:
    rows = []
    for b in bars():
        values = {c: getattr(b, c) / 100 for c in ("open", "high", "low", "close")}
        values |= {f"adj_{c}": round(getattr(b, c) * 0.009, 4) for c in ("open", "high", "low")}
        values["adj_close"] = float(b.adj_close)
        values |= dict.fromkeys(MISSING.get(b.at, ()), float("nan"))
        rows.append((KEYS[b.ticker], key_of(b.day), b.source, *[values[c] for c in PRICE_FIELDS], b.volume, b.volume))
    return rows


def tables(spark):
    """The six source tables: prices as doubles with NaN, the source list an array."""
    days = star.calendar(spark.createDataFrame([(FIRST, LAST)], "first date, last date"))
    typed = ", ".join(f"{c} double" for c in PRICE_FIELDS)
    prices = spark.createDataFrame(
        price_rows(), f"security_key int, date_key int, source string, {typed}, volume bigint, adj_volume bigint"
    )
    exact = prices.withColumn("adj_close", F.col("adj_close").cast("decimal(18,6)"))
    agreed = star.consensus(exact, ["security_key", "date_key"], "source", A, B, "adj_close", 0.005)
    agreed = agreed.withColumn("sources_available", F.split("sources_available", "[|]"))

    def version(key, ticker, name, since, until, current):
        return key, ticker, name, SECTORS[ticker], "General", f"ID-{ticker}", since, until, current

    versions = [version(k, t, f"{t.title()} plc", date(2021, 3, 1), None, True) for t, k in KEYS.items()]
    versions.append(version(91, "KILO", "Kilogram plc", date(2018, 6, 1), date(2021, 2, 28), False))
    actions = [
        (KEYS["LIMA"], key_of(TRADING[8]), "split", Decimal("3"), B),
        (KEYS["MIKE"], key_of(TRADING[50]), "dividend", Decimal("0.12"), A),
        (KEYS["MIKE"], key_of(TRADING[55]), "dividend", Decimal("0.13"), A),
    ]
    rates = [(key_of(d), s, Decimal(v)) for d in TRADING[::9] for s, v in RATES.items()]
    schema = {name: spec.schema for name, spec in MARKET_TABLES.items()}
    return {
        "dim_date": star.trading_days(days, prices),
        "dim_security": spark.createDataFrame(versions, schema["dim_security"]),
        "fact_price_daily": prices,
        "fact_price_daily_consensus": agreed,
        "fact_corporate_action": spark.createDataFrame(actions, schema["fact_corporate_action"]),
        "fact_macro_rate": spark.createDataFrame(rates, schema["fact_macro_rate"]),
    }


def truth() -> dict:
    """Counted from the bars without Spark."""
    a = {b.at: b.adj_close for b in bars() if b.source == A}
    b = {x.at: x.adj_close for x in bars() if x.source == B}
    diff = {k: abs(float(a[k] - b[k])) / (float(a[k] + b[k]) / 2) for k in a.keys() & b.keys()}
    sampled = {t for t, _ in b}
    return dict(
        prices=len(a) + len(b), consensus=len(a | b), diff=diff, flagged={k for k, v in diff.items() if v > 0.005},
        only_a=a.keys() - b.keys(), only_b=b.keys() - a.keys(), trusted=b | a,
        unsampled={k for k in a.keys() - b.keys() if k[0] not in sampled},
        days=(LAST - FIRST).days + 1, rates=len(TRADING[::9]) * len(RATES),
    )


def report_text(compared=None, flagged=None, only_a=None, only_b=None, affected=1, of=3, rows=None):
    """A report of the market, or of the given figures."""
    t = truth()
    figures = [len(t[k]) for k in ("diff", "flagged", "only_a", "only_b")]
    given = (compared, flagged, only_a, only_b)
    compared, flagged, only_a, only_b = (f if g is None else g for f, g in zip(figures, given))
    rows = (("LIMA", figures[1]),) if rows is None else rows
    lines = [
        "Weekly comparison (ingest_date=2022-08-03)",
        f"  Compared: {compared} (ticker, date) pairs of two sources",
        f"  Flagged (> 0.50% adj_close discrepancy): {flagged} (9.99%)",
        f"  Present only in yfinance (no second price): {only_a}",
        f"  Present only in Tiingo (no second price): {only_b}",
        "",
        f"  Affected tickers: {affected} of {of} compared",
        "  name      flagged  compared  share     largest   middle       from and to",
        *[f"  {t}   {n}   63   2.5%   4.08%   4.08%  2022-05-13 to 2022-07-27" for t, n in rows],
        "",
        "  Notes follow.",
    ]
    return "\n".join(lines) + "\n"
