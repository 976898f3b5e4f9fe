"""Runs: verify a staged load, publish it, build the marts, check, append results.

RAW switches to a new load only after the load is verified, so a failed load
leaves readers with the last good tables.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date, datetime, timezone
from enum import IntEnum
from functools import partial, reduce
from uuid import uuid4

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotewright.operators.control import control_results
from quotewright.operators.fingerprint import CONTENT, fingerprint, fingerprint_with_content, load_log, load_problems
from quotewright.operators.quality import run_checks
from quotewright.plans import market as mk
from quotewright.schemas import MARKET_TABLES
from quotewright.session import together
from quotewright.sources.exports import manifest_contents, manifest_fingerprints, read_manifest, read_typed
from quotewright.sources.reports import ParsedReports, only_date, parse_reports, read_reports, refuse_unparsed
from quotewright.sources.warehouse import Warehouse


class Outcome(IntEnum):
    OK = 0
    CHECK_FAILED = 1
    LOAD_NOT_VERIFIED = 2


@dataclass(frozen=True)
class RunResult:
    outcome: Outcome
    run_id: str
    # table and mismatch detail, at most one row per table
    problems: list[tuple[str, str]] = field(default_factory=list)
    # this run's checks ordered by name; None when the load was not verified
    results: DataFrame | None = None


def new_run() -> tuple[str, datetime]:
    """A run id and a UTC stamp of second resolution."""
    return uuid4().hex[:12], datetime.now(timezone.utc).replace(microsecond=0)


def observed_fingerprints(tables: mk.Tables, content: bool = False) -> DataFrame:
    """Long-form fingerprints of all tables, with their content digests where asked for."""
    of = fingerprint_with_content if content else fingerprint
    parts = [of(tables[s.name], s.name, s.fingerprints) for s in MARKET_TABLES.values()]
    return reduce(DataFrame.unionByName, parts)


def verify_load(
    wh: Warehouse, manifest: DataFrame, staged: mk.Tables, run_id: str, at: datetime
) -> list[tuple[str, str]]:
    """Compare staged tables with the manifest, append the load log and return the
    mismatches (none means every table is exact). Contents are compared where the manifest
    has a digest of them: values that changed rows leave all counts and sums as they are."""
    expected = manifest_fingerprints(manifest).unionByName(manifest_contents(manifest))
    observed = observed_fingerprints(staged, content=True)
    plain = manifest.where("content is null").select(F.col("table_name").alias("plain"))
    unasked = (observed["table_name"] == plain["plain"]) & observed["metric"].startswith(CONTENT)
    log = load_log(expected, observed.join(plain, unasked, "left_anti"), run_id, at)
    wh.record(log, "load_log", run_id)
    stored = wh.table("mart", "load_log").where(f"run_id = '{run_id}'")
    return [tuple(r) for r in load_problems(stored).orderBy("table_name").collect()]


def build_marts(wh: Warehouse, tables: mk.Tables, run_id: str, m: mk.Market) -> dict[str, DataFrame]:
    """Write every mart of the run to its folders; nothing is visible yet.

    Returns and pairs are read by several marts and checks, so they are written
    first and read back: a lost executor costs one stage, not the whole lineage.
    """

    def stage(marts: dict[str, DataFrame]) -> dict[str, DataFrame]:
        written = together(partial(wh.stage, df, run_id, "mart", name) for name, df in marts.items())
        return dict(zip(marts, written))

    first = stage(
        {
            "price_returns": mk.price_returns(tables, m),
            "recon_pair_counts": mk.recon_pairs(tables, m),
            "v_recon_coverage": mk.recon_coverage(tables, m),
            "dim_security_current": mk.dim_security_current(tables),
            "dim_date": mk.dim_date(tables),
            "v_price_anomalies": mk.price_anomalies(mk.price_daily(tables)),
            "v_platform_health": mk.platform_health(tables),
        }
    )
    returns, pairs, coverage = (
        first[n] for n in ("price_returns", "recon_pair_counts", "v_recon_coverage")
    )
    return first | stage(
        {
            "v_latest_price": mk.latest_price(returns, m),
            "v_security_summary": mk.security_summary(returns, m),
            "v_sector_daily_return": mk.sector_daily_return(returns),
            "v_recon_by_ticker": mk.recon_by_ticker(tables, pairs),
            "v_recon_summary": mk.recon_summary(pairs, coverage, m),
        }
    )


def create_views(wh: Warehouse, m: mk.Market) -> None:
    """Catalog views for SQL users: the models over RAW, which follow each publish,
    the compared pairs one by one, and the latest-run rows of the audit tables."""
    raw, mart = (lambda t: wh.name("raw", t)), (lambda t: wh.name("mart", t))
    security = f"JOIN {raw('dim_security')} s ON s.security_key = f.security_key"
    day = f"JOIN {raw('dim_date')} d ON d.date_key = f.date_key"
    flags = ", ".join(
        f"cast(coalesce(array_contains(split(f.sources_available, '[|]'), '{s}'), false) AS int) AS has_{s}"
        for s in (m.source_a, m.source_b)
    )
    tasks = wh.spark.conf.get("spark.sql.shuffle.partitions")
    newest = f"(SELECT max(struct(loaded_at_utc, run_id)).run_id FROM {mart('load_log')})"
    views = {
        wh.name("model", "price_daily"): f"""
            SELECT f.security_key, s.ticker, s.gics_sector, f.date_key, d.date AS trade_date,
                   f.* EXCEPT (security_key, date_key)
            FROM {raw('fact_price_daily')} f {security} {day}""",
        wh.name("model", "price_trusted"): f"""
            SELECT f.security_key, s.ticker, s.gics_sector, f.date_key, d.date AS trade_date,
                   f.* EXCEPT (security_key, date_key), {flags}
            FROM {raw('fact_price_daily_consensus')} f {security} {day}""",
        wh.name("model", "corporate_action"): f"""
            SELECT f.security_key, s.ticker, f.date_key, d.date AS action_date,
                   f.* EXCEPT (security_key, date_key)
            FROM {raw('fact_corporate_action')} f {security} {day}""",
        wh.name("model", "macro_rate"): f"""
            SELECT f.date_key, d.date AS rate_date, f.* EXCEPT (date_key)
            FROM {raw('fact_macro_rate')} f {day}""",
        # written out only when read: copies of a price may stand for many pairs
        mart("v_recon_pairs"): f"""
            SELECT p.* EXCEPT (pairs, block) FROM (
              SELECT /*+ REPARTITION({tasks}) */ * FROM {mart('recon_pair_counts')}
              LATERAL VIEW explode(sequence(0, (pairs - 1) div 10000, 1)) AS block
              WHERE pairs > 0) p
            LATERAL VIEW explode(sequence(1, least(10000, pairs - block * 10000))) AS copy""",
        mart("v_load_latest"): f"SELECT * FROM {mart('load_log')} WHERE run_id = {newest}",
        mart("v_dq_latest"): f"SELECT * FROM {mart('dq_results')} WHERE run_id = {newest}",
    }
    for name, sql in views.items():
        wh.spark.sql(f"CREATE OR REPLACE VIEW {name} AS {sql}")


def load_control(wh: Warehouse, parsed: ParsedReports, day: date) -> None:
    """Replace the control rows of the report's date."""
    wh.replace(parsed.headline, "recon_report_control", "report_ingest_date", str(day))
    wh.replace(parsed.entities, "recon_report_control_ticker", "report_ingest_date", str(day))


def build_and_check(
    wh: Warehouse,
    tables: mk.Tables,
    run_id: str,
    at: datetime,
    m: mk.Market,
    parsed: ParsedReports | None = None,
    report_date: date | None = None,
) -> DataFrame:
    """Marts, checks, the optional report control, and then the commit and publication of
    the run; returns its results, read back from the audit table and ordered by name."""
    marts = build_marts(wh, tables, run_id, m)
    checked = {**tables, "recon_pairs": marts["recon_pair_counts"]}
    results = run_checks(mk.market_checks(m), checked, run_id, at)
    if parsed is not None:
        load_control(wh, parsed, report_date)
        results = results.unionByName(
            control_results(
                marts["v_recon_summary"],
                marts["v_recon_by_ticker"],
                wh.table("mart", "recon_report_control"),
                wh.table("mart", "recon_report_control_ticker"),
                m.control_figures,
                report_date,
                run_id,
                at,
            )
        )
    wh.record(results, "dq_results", run_id)
    staged = {("raw", name): tables[name] for name in MARKET_TABLES} | {("mart", name): df for name, df in marts.items()}
    wh.commit(staged, run_id, at)
    wh.catch_up()
    create_views(wh, m)
    return wh.table("mart", "dq_results").where(f"run_id = '{run_id}'").orderBy("check_name")


def run_market(
    wh: Warehouse, export_dir: str, m: mk.Market = mk.Market(), report: str | None = None
) -> RunResult:
    """A full run over an export. The report is read first: one that cannot be read
    whole, or several, stop the run before any table or folder is made.

    RAW tables and marts become the warehouse's at one moment, when the commit record of
    the run appears. Until then a run that fails leaves all tables of the run before it;
    after it, catalog tables that were not yet switched are, by the next run or ``catch_up``."""
    spark = wh.spark
    parsed = report_date = None
    if report is not None:
        texts = read_reports(spark, report)
        parsed = parse_reports(texts, (m.source_a, m.printed_a), (m.source_b, m.printed_b))
        refuse_unparsed(parsed)
        report_date = only_date(parsed)
    run_id, at = new_run()
    wh.create(MARKET_TABLES, m.source_a, m.source_b)
    wh.catch_up()

    manifest = read_manifest(spark, export_dir)
    copies = together(
        partial(wh.stage, read_typed(spark, f"{export_dir}/{s.name}.parquet", s.schema), run_id, "raw", s.name)
        for s in MARKET_TABLES.values()
    )
    staged = dict(zip(MARKET_TABLES, copies))
    problems = verify_load(wh, manifest, staged, run_id, at)
    if problems:
        return RunResult(Outcome.LOAD_NOT_VERIFIED, run_id, problems)
    results = build_and_check(wh, staged, run_id, at, m, parsed, report_date)
    failed = bool(results.where("status = 'FAIL'").limit(1).collect())
    return RunResult(Outcome.CHECK_FAILED if failed else Outcome.OK, run_id, [], results)


def inspect(wh: Warehouse) -> dict[str, DataFrame]:
    """The listings shown after a run, all of the run committed last."""
    run = wh.committed()
    tables = {name: run["raw", name] for name in MARKET_TABLES}
    daily = mk.price_daily(tables)
    return {
        "reconciliation": run["mart", "v_recon_summary"],
        "null_prices": mk.null_prices(daily).orderBy("n_rows", "ticker", "source", ascending=[False, True, True]),
        "securities_without_prices": mk.securities_without_prices(tables).orderBy("ticker"),
        "anomalies": mk.first_anomalies(run["mart", "v_price_anomalies"]),
    }
