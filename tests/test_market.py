"""End to end on the synthetic market: export, load, verify, marts, checks, control."""

import hashlib
import json
import math
import statistics
from dataclasses import replace
from decimal import Decimal
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quotewright.operators import quality as q
from quotewright.operators.clean import clean_decimals
from quotewright.plans import market as mk
from quotewright.plans import runs
from quotewright.schemas import MARKET_TABLES, TableSpec
from quotewright.sources import exports
from quotewright.sources.exports import export_all, read_manifest, read_typed, snapshot
from quotewright.sources.warehouse import Warehouse
from tests import synthetic as syn

M = mk.Market()
_RUN = ("r1", runs.new_run()[1])


@pytest.fixture(scope="session")
def export(spark, tmp_path_factory):
    out = str(tmp_path_factory.mktemp("export"))
    export_all(syn.tables(spark), MARKET_TABLES, out, _RUN[1])
    return out


@pytest.fixture(scope="session")
def raw(spark, export):
    return {s.name: read_typed(spark, f"{export}/{s.name}.parquet", s.schema) for s in MARKET_TABLES.values()}


@pytest.fixture(scope="session")
def loaded(spark, export, tmp_path_factory):
    wh = Warehouse(spark, str(tmp_path_factory.mktemp("wh")), "t1_")
    report = tmp_path_factory.mktemp("report") / "report.txt"
    report.write_text(syn.report_text(), encoding="utf-8")
    return wh, runs.run_market(wh, export, M, str(report))


def check_map(df):
    return {r.check_name: (r.status, r.failing_count, r.checked_rows) for r in df.collect()}


def all_checks(tables, m=M):
    tables = {**tables, "recon_pairs": mk.recon_pairs(tables, m)}
    return check_map(q.run_checks(mk.market_checks(m), tables, *_RUN))


# ------------------------------------------------------------------ export


def test_manifest_counts_rows_nan_and_files(spark, export):
    rows = {r.table_name: r for r in read_manifest(spark, export).collect()}
    t = syn.truth()
    assert set(rows) == set(MARKET_TABLES)
    assert rows["fact_price_daily"].rows == t["prices"]
    assert rows["fact_price_daily_consensus"].rows == t["consensus"]
    assert rows["dim_security"].rows == len(syn.KEYS) + 1 and rows["dim_date"].rows == t["days"]
    assert rows["fact_price_daily"].nan_to_null == {"adj_open": 1, "adj_high": 1, "adj_low": 1}
    assert all(not r.nan_to_null for n, r in rows.items() if n != "fact_price_daily")
    assert rows["fact_price_daily"].fingerprints["null_adj_open"] == "1"
    files = spark.read.json(f"{export}/manifest_files/fact_price_daily").collect()
    assert sum(f.bytes for f in files) == rows["fact_price_daily"].bytes
    own = {f.name: hashlib.sha256(f.read_bytes()).hexdigest() for f in Path(export, "fact_price_daily.parquet").glob("*.parquet")}
    assert {f.file: f.sha256 for f in files} == own
    assert rows["fact_price_daily"].sha256 == hashlib.sha256("\n".join(sorted(own.values())).encode()).hexdigest()
    assert all(len(r.sha256) == 64 for r in rows.values())


def test_wide_rows_make_more_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(exports, "BYTES_PER_FILE", 10_000)
    schema = T.StructType([T.StructField("k", T.LongType()), T.StructField("t", T.StringType())])
    spec = TableSpec("wide", schema, ("k",))
    exports.export_table(spark.range(40).selectExpr("id as k", "repeat('x', 1000) as t").coalesce(1), spec, str(tmp_path))
    assert len(list((tmp_path / "wide.parquet").glob("*.parquet"))) >= 4


def test_export_is_typed_and_ordered(spark, export):
    df = spark.read.parquet(f"{export}/fact_price_daily.parquet")
    assert [(f.name, f.dataType) for f in df.schema] == [
        (f.name, f.dataType) for f in MARKET_TABLES["fact_price_daily"].schema
    ]
    files = df.groupBy(F.input_file_name()).agg(
        F.min(F.struct("security_key", "date_key", "source")).alias("lo"),
        F.max(F.struct("security_key", "date_key", "source")).alias("hi"),
    ).orderBy("lo").collect()
    assert all(a.hi <= b.lo for a, b in zip(files, files[1:]))


# -------------------------------------------------------------------- load


def test_clean_run_passes_errors_and_warns_on_real_properties(loaded):
    wh, result = loaded
    assert result.outcome is runs.Outcome.OK and result.problems == []
    got = check_map(result.results)
    assert len(got) == 40
    assert {n: v[:2] for n, v in got.items() if v[0] != "PASS"} == {
        "null_price_fields": ("WARN", len(syn.MISSING)),
        "ohlc_high_ge_open": ("WARN", 1),
        "ohlc_high_ge_close": ("WARN", 1),
    }
    log = wh.table("mart", "v_load_latest").collect()
    assert len(log) == 6 and all(r.fingerprint_match and r.mismatch_detail is None for r in log)
    assert wh.table("mart", "v_dq_latest").count() == 40


def test_reconciliation_equals_plain_counts(loaded):
    wh, _ = loaded
    t = syn.truth()
    s = wh.table("mart", "v_recon_summary").first()
    assert (s.compared_pairs, s.flagged_pairs) == (len(t["diff"]), len(t["flagged"]))
    assert len(t["flagged"]) == len(syn.OFF_DAYS) > 10
    assert (s.tickers_compared, s.tickers_affected) == (3, 1)
    assert (s.only_yfinance, s.only_tiingo) == (len(t["only_a"]), len(t["only_b"]))
    assert s.only_yfinance_unsampled_tickers == len(t["unsampled"]) == len(syn.TRADING)
    assert s.only_yfinance_within_sampled_tickers == 6
    for r in wh.table("mart", "v_recon_by_ticker").collect():
        mine = sorted(v for (tk, _), v in t["diff"].items() if tk == r.ticker)
        assert r.compared == len(mine)
        assert r.median_pct_diff == pytest.approx(statistics.median(mine), rel=1e-12)
        assert r.max_pct_diff == pytest.approx(mine[-1], rel=1e-12)
        days = sorted(d for tk, d in t["flagged"] if tk == r.ticker)
        assert [r.first_flagged_date, r.last_flagged_date] == ([days[0], days[-1]] if days else [None, None])
    assert wh.table("mart", "v_recon_pairs").count() == len(t["diff"])


@pytest.mark.parametrize("ranges", [None, 1, 3, 40])
def test_returns_and_volatility_match_plain_python(raw, ranges):
    m = replace(M, ranges=ranges)
    rows = mk.price_returns(raw, m).orderBy("security_key", "trade_date").collect()
    trusted = syn.truth()["trusted"]
    assert len(rows) == len(trusted)
    for ticker in syn.KEYS:
        mine = [r for r in rows if r.ticker == ticker]
        days = sorted(d for t, d in trusted if t == ticker)
        px = [float(trusted[ticker, d]) for d in days]
        gaps = [None] + [(b - a).days for a, b in zip(days, days[1:])]
        rets = [None] + [b / a - 1 for a, b in zip(px, px[1:])]
        usable = [r if g is not None and g <= 5 else None for r, g in zip(rets, gaps)]
        assert [r.trade_date for r in mine] == days
        for i, r in enumerate(mine):
            assert r.days_since_prev == gaps[i]
            assert r.is_gap_return == int(gaps[i] is not None and gaps[i] > 5)
            assert (r.daily_return is None) == (rets[i] is None)
            if rets[i] is not None:
                assert r.daily_return == pytest.approx(rets[i], rel=1e-9)
                assert r.log_return == pytest.approx(math.log1p(rets[i]), rel=1e-9)
            frame = usable[max(0, i - 20): i + 1]
            if len(frame) == 21 and None not in frame:
                assert r.vol_21d_ann == pytest.approx(statistics.stdev(frame) * math.sqrt(252), rel=1e-9)
            else:
                assert r.vol_21d_ann is None
    after = [r.trade_date for r in rows if r.is_gap_return == 1]
    assert after == [min(d for d in syn.TRADING if d > max(syn.SILENT))]


def test_marts_over_returns(loaded, raw):
    wh, _ = loaded
    latest = {r.ticker: r for r in wh.table("mart", "v_latest_price").collect()}
    assert set(latest) == set(syn.KEYS) and latest["KILO"].trade_date == syn.TRADING[-1]
    summary = {r.ticker: r for r in wh.table("mart", "v_security_summary").collect()}
    spoken = len(set(syn.TRADING) - syn.SILENT)
    assert summary["LIMA"].disagreed_observations == len(syn.OFF_DAYS)
    assert summary["MIKE"].observations == spoken
    nova = summary["NOVA"]
    assert nova.adj_close_return == pytest.approx(float(nova.last_adj_close) / float(nova.first_adj_close) - 1)
    sectors = wh.table("mart", "v_sector_daily_return").where("gics_sector = 'Transport'")
    assert sectors.count() == len(syn.TRADING) - 1  # the first day has no return
    anomalies = wh.table("mart", "v_price_anomalies").collect()
    assert [(r.ticker, r.trade_date, r.source, r.violated_rule) for r in anomalies] == [
        (syn.BAD_PRINT[0], syn.BAD_PRINT[2], syn.BAD_PRINT[1], "high<open")
    ]
    trusted = mk.price_trusted(raw, M)
    assert trusted.where("has_yfinance = 1 and has_tiingo = 1").count() == len(syn.truth()["diff"])
    assert mk.corporate_action(raw).count() == 3 and mk.macro_rate(raw).count() == syn.truth()["rates"]


def test_catalog_views_equal_the_models(loaded, raw):
    wh, _ = loaded
    models = {
        "price_daily": mk.price_daily(raw), "price_trusted": mk.price_trusted(raw, M),
        "corporate_action": mk.corporate_action(raw), "macro_rate": mk.macro_rate(raw),
    }
    for name, df in models.items():
        view = wh.table("model", name)
        assert view.columns == df.columns
        assert view.exceptAll(df).isEmpty() and df.exceptAll(view).isEmpty()


def test_listings_and_measures(loaded):
    wh, _ = loaded
    shown = runs.inspect(wh)
    assert [(r.ticker, r.source, r.n_rows) for r in shown["null_prices"].collect()] == [("OSLO", "yfinance", len(syn.MISSING))]
    assert shown["securities_without_prices"].count() == 0
    assert shown["anomalies"].first().ticker == "MIKE"
    tables = {n: wh.table("mart", n) for n in ("price_returns", "v_latest_price", "v_recon_summary")}
    got = {
        r.measure: r.value
        for r in mk.measures(
            tables["price_returns"], tables["v_latest_price"], tables["v_recon_summary"],
            wh.table("mart", "v_dq_latest"), wh.table("mart", "v_load_latest"), M,
        ).collect()
    }
    t = syn.truth()
    assert (got["securities"], got["observations"], got["compared_pairs"]) == (5, t["consensus"], len(t["diff"]))
    assert (got["checks_passed"], got["checks_warned"], got["checks_failed"]) == (37, 3, 0)
    assert got["tables_verified"] == 6


# --------------------------------------------------- verification of loads


def _verify(spark, wh, export, tables):
    wh.create(MARKET_TABLES, M.source_a, M.source_b)
    run_id, at = runs.new_run()
    return dict(runs.verify_load(wh, read_manifest(spark, export), tables, run_id, at))


@pytest.fixture(scope="session")
def audit(spark, tmp_path_factory):
    return Warehouse(spark, str(tmp_path_factory.mktemp("audit")), "t2_")


def test_one_micro_unit_is_caught(spark, audit, export, raw):
    hit = F.expr(syn.BOTH) & (F.col("source") == "yfinance")
    nudged = raw["fact_price_daily"].withColumn(
        "adj_close", (F.col("adj_close") + F.when(hit, F.lit("0.000001").cast("decimal(18,6)")).otherwise(0)).cast("decimal(18,6)")
    )
    problems = _verify(spark, audit, export, {**raw, "fact_price_daily": nudged})
    assert list(problems) == ["fact_price_daily"]
    assert problems["fact_price_daily"].startswith("sum_adj_close: expected ")


def test_dropped_rows_and_invented_values_are_caught(spark, audit, export, raw):
    changed = {
        **raw,
        "fact_macro_rate": raw["fact_macro_rate"].where("series_id <> 'SOFR'"),
        "fact_price_daily": raw["fact_price_daily"].fillna({"adj_open": 1}),
    }
    problems = _verify(spark, audit, export, changed)
    rates = syn.truth()["rates"]
    assert problems["fact_macro_rate"].startswith(f"row_count: expected {rates}, got {rates * 2 // 3}; ")
    assert problems["fact_price_daily"] == "null_adj_open: expected 1, got 0"


def test_values_that_changed_rows_are_caught(spark, audit, export, raw):
    """Two days' prices in each other's place: every count and sum is as before."""
    prices = raw["fact_price_daily"]
    keys = MARKET_TABLES["fact_price_daily"].key
    pick = prices.where("adj_close is not null").orderBy(*keys).limit(400).toPandas()
    other = pick[pick["adj_close"] != pick["adj_close"].iloc[0]].iloc[0]
    first = pick.iloc[0]

    def at(row):
        return F.expr(" and ".join(f"{k} <=> {_literal(row[k])}" for k in keys))

    close = F.when(at(first), F.lit(other["adj_close"])).when(at(other), F.lit(first["adj_close"])).otherwise(F.col("adj_close"))
    problems = _verify(spark, audit, export, {**raw, "fact_price_daily": prices.withColumn("adj_close", close.cast("decimal(18,6)"))})
    assert list(problems) == ["fact_price_daily"]
    assert problems["fact_price_daily"].startswith("content_1: expected ")


def _literal(value):
    return f"DATE'{value}'" if hasattr(value, "year") else f"'{value}'"


def test_failed_load_keeps_the_published_tables(spark, loaded, export, tmp_path):
    wh, good = loaded
    # the manifest as a plain, indented file
    document = json.loads(spark.read.text(f"{export}/manifest.json").first()[0])
    document["tables"]["dim_date"]["rows"] += 1
    (tmp_path / "manifest.json").write_text(json.dumps(document, indent=2))
    for t in MARKET_TABLES:
        (tmp_path / f"{t}.parquet").symlink_to(Path(export) / f"{t}.parquet")
    result = runs.run_market(wh, str(tmp_path), M)
    assert result.outcome is runs.Outcome.LOAD_NOT_VERIFIED and result.results is None
    assert result.problems == [("dim_date", f"row_count: expected {syn.truth()['days'] + 1}, got {syn.truth()['days']}")]
    where = wh.table("raw", "dim_date").select(F.input_file_name().alias("f")).first().f
    assert f"/runs/{good.run_id}/" in where
    # the newest load has no checks
    assert wh.table("mart", "v_dq_latest").count() == 0
    # and a good load afterwards is the latest again (same second: larger id wins)
    again = runs.run_market(wh, export, M)
    assert again.outcome is runs.Outcome.OK and again.results.count() == 33


def test_publish_follows_a_changed_schema(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path), "t4_")
    wh.create({}, "a", "b")
    for run_id, column in (("one", "vol_21d_ann"), ("two", "vol_7d_ann")):
        staged = wh.stage(spark.range(3).withColumnRenamed("id", column), run_id, "mart", "m")
        wh.publish(staged, run_id, "mart", "m")
        assert wh.table("mart", "m").columns == [column] and wh.table("mart", "m").count() == 3


def test_missing_column_stops_a_load(spark, export):
    spec = MARKET_TABLES["dim_date"]
    with pytest.raises(ValueError, match="year"):
        clean_decimals(spark.read.parquet(f"{export}/dim_date.parquet").drop("year"), spec.schema)


# ------------------------------------------------------ every check can fire


def _set(col, value, where):
    """Replace a value on the rows matching ``where``."""
    def change(df):
        new = F.lit(value).cast(df.schema[col].dataType)
        return df.withColumn(col, F.when(F.expr(where), new).otherwise(F.col(col)))
    return change


def _expr(col, expr, where):
    def change(df):
        return df.withColumn(col, F.when(F.expr(where), F.expr(expr).cast(df.schema[col].dataType)).otherwise(F.col(col)))
    return change


def _dup(where):
    return lambda df: df.unionByName(df.where(where))


def _drop(where):
    return lambda df: df.where(f"not ({where})")


P, C, S, D = "fact_price_daily", "fact_price_daily_consensus", "dim_security", "dim_date"
ACT, MAC = "fact_corporate_action", "fact_macro_rate"
ONE, BOTH = syn.ONE, syn.BOTH
DAY = f"date_key = {syn.key_of(syn.TRADING[0])}"
OLD = "security_key = 91"
BREAKS = [
    ("pk_unique__dim_date", D, _dup(DAY), "FAIL", 1),
    ("pk_unique__dim_security", S, _dup(OLD), "FAIL", 1),
    ("one_current_row_per_ticker", S, _set("is_current", True, OLD), "FAIL", 1),
    ("pk_unique__fact_price_daily", P, _dup(ONE), "FAIL", 1),
    ("pk_unique__fact_price_daily_consensus", C, _dup(ONE), "FAIL", 1),
    ("pk_unique__fact_corporate_action", ACT, _dup("action_type = 'split'"), "FAIL", 1),
    ("pk_unique__fact_macro_rate", MAC, _dup(DAY), "FAIL", 3),
    ("fk_security__fact_price_daily", P, _set("security_key", 999, ONE), "FAIL", 1),
    ("fk_date__fact_price_daily", P, _set("date_key", 19000101, ONE), "FAIL", 1),
    ("fk_date__fact_price_daily", P, _set("date_key", None, ONE), "FAIL", 1),
    ("fk_security__fact_price_daily_consensus", C, _set("security_key", 999, ONE), "FAIL", 1),
    ("fk_date__fact_price_daily_consensus", C, _set("date_key", 19000101, ONE), "FAIL", 1),
    ("fk_security__fact_corporate_action", ACT, _set("security_key", 999, "action_type = 'split'"), "FAIL", 1),
    ("fk_date__fact_corporate_action", ACT, _set("date_key", 19000101, "action_type = 'split'"), "FAIL", 1),
    ("fk_date__fact_macro_rate", MAC, _set("date_key", 19000101, DAY), "FAIL", 3),
    ("not_null__dim_security_ticker", S, _set("ticker", None, OLD), "FAIL", 1),
    ("not_null__fact_price_daily_adj_close", P, _set("adj_close", None, ONE), "FAIL", 1),
    ("not_null__fact_price_daily_consensus_adj_close", C, _set("adj_close", None, ONE), "FAIL", 1),
    ("price_positive__fact_price_daily", P, _set("close", 0, ONE), "FAIL", 1),
    ("null_price_fields", P, _set("high", None, ONE), "WARN", 3),
    ("ohlc_high_ge_low", P, _expr("high", "low - 2", ONE), "WARN", 1),
    ("ohlc_low_le_open", P, _expr("low", "open + 2", ONE), "WARN", 1),
    ("ohlc_low_le_close", P, _expr("low", "close + 2", ONE), "WARN", 1),
    ("ohlc_high_ge_open", P, _expr("high", "open - 0.2", ONE), "WARN", 2),
    ("ohlc_high_ge_close", P, _expr("high", "close - 0.2", ONE), "WARN", 2),
    ("consensus_flag_domain", C, _set("reconciliation_flag", "weird", BOTH), "FAIL", 1),
    ("consensus_flag_domain", C, _set("reconciliation_flag", None, BOTH), "FAIL", 1),
    ("consensus_pct_diff_vs_flag", C, _set("pct_diff", "0.1", ONE), "FAIL", 1),
    ("consensus_pct_diff_vs_flag", C, _set("pct_diff", None, BOTH), "FAIL", 1),
    ("consensus_flag_vs_tolerance", C, _set("reconciliation_flag", "agreed", "reconciliation_flag = 'disagreed'"), "FAIL", len(syn.OFF_DAYS)),
    ("recon_pair_count_match", P, _drop(f"{BOTH} and source = 'tiingo'"), "FAIL", 1),
    ("recon_flag_mismatch", C, lambda df: _set("pct_diff", "0.006", BOTH)(_set("reconciliation_flag", "disagreed", BOTH)(df)), "WARN", 1),
    ("consensus_covers_price_keys", C, _drop(BOTH), "FAIL", 1),
    ("security_without_prices", S, lambda df: df.unionByName(df.where(OLD).withColumns({"security_key": F.lit(92), "ticker": F.lit("PAPA"), "is_current": F.lit(True)})), "WARN", 1),
    ("trading_day_without_prices", D, _set("is_trading_day", True, f"date_key = {syn.key_of(min(syn.CLOSED))}"), "WARN", 1),
    ("price_on_non_trading_day", D, _set("is_trading_day", False, DAY), "WARN", 7),
]


@pytest.fixture(scope="session")
def clean_checks(raw):
    return all_checks(raw)


@pytest.mark.parametrize("name, table, change, status, failing", BREAKS, ids=[f"{b[0]}-{i}" for i, b in enumerate(BREAKS)])
def test_check_fires(raw, clean_checks, name, table, change, status, failing):
    tables = {**raw, table: change(raw[table])}
    checks = [c for c in mk.market_checks(M) if c.name == name]
    tables["recon_pairs"] = mk.recon_pairs(tables, M)
    got = check_map(q.run_checks(checks, tables, *_RUN))[name]
    assert clean_checks[name][1] < failing
    assert got[:2] == (status, failing)


def test_every_check_is_broken_at_least_once(clean_checks):
    assert {b[0] for b in BREAKS} == set(clean_checks) and len(clean_checks) == 33


def test_disagreed_row_stored_at_the_tolerance_passes(raw):
    edge = _set("pct_diff", "0.005000", "reconciliation_flag = 'disagreed'")(raw[C])
    got = all_checks({**raw, C: edge})
    assert got["consensus_flag_vs_tolerance"][:2] == ("PASS", 0)


def test_checked_rows(clean_checks):
    t = syn.truth()
    assert clean_checks["pk_unique__fact_price_daily"][2] == t["prices"]
    assert clean_checks["one_current_row_per_ticker"][2] == len(syn.KEYS)
    assert clean_checks["consensus_flag_vs_tolerance"][2] == len(t["diff"])
    assert clean_checks["recon_flag_mismatch"][2] == clean_checks["recon_pair_count_match"][2] == len(t["diff"])
    assert clean_checks["consensus_covers_price_keys"][2] == t["consensus"]
    assert clean_checks["trading_day_without_prices"][2] == len(syn.TRADING)


def test_single_file_exports_load_too(spark, raw, tmp_path):
    """One Parquet file per table with plain columns and an indented manifest."""
    tables = {}
    for spec in MARKET_TABLES.values():
        df = raw[spec.name]
        file = f"{spec.name}.parquet"
        pq.write_table(df.toArrow(), tmp_path / file)
        figures = df.agg(*[F.expr(sql).alias(m) for m, sql in spec.fingerprints.items()]).first().asDict()
        rows = figures.pop("row_count")
        texts = {m: None if v is None else format(Decimal(str(v)).normalize(), "f") for m, v in figures.items()}
        tables[spec.name] = dict(rows=rows, file=file, bytes=1, sha256="x", nan_to_null={}, fingerprints=texts)
    document = {"exported_at_utc": "2022-08-03T06:00:00+00:00", "server_version": "9", "tables": tables}
    (tmp_path / "manifest.json").write_text(json.dumps(document, indent=2))
    wh = Warehouse(spark, str(tmp_path / "wh"), "t3_")
    result = runs.run_market(wh, str(tmp_path), M)
    assert result.problems == [] and result.outcome is runs.Outcome.OK


def test_a_messy_load_is_verified_built_and_failed(spark, tmp_path):
    """Duplicates, orphans, zero, negative and missing prices: the marts still build
    and the checks report."""
    tables = syn.tables(spark)
    changes = {
        P: [_dup("security_key = 12"), _set("close", 0.0, ONE), _set("adj_close", -1.0, BOTH),
            _set("security_key", None, f"security_key = 13 and {DAY}"),
            _set("adj_close", float("nan"), f"security_key = 11 and date_key = {syn.key_of(syn.TRADING[30])}")],
        C: [_dup("security_key = 12"), _set("adj_close", "0", f"security_key = 15 and {DAY}"),
            _set("reconciliation_flag", None, BOTH)],
        S: [_set("ticker", None, OLD)],
        D: [_drop(f"date_key = {syn.key_of(syn.TRADING[7])}"), _dup(f"date_key = {syn.key_of(syn.TRADING[8])}")],
    }
    for name, steps in changes.items():
        for step in steps:
            tables[name] = step(tables[name])
    tables = snapshot(tables)
    export_all(tables, MARKET_TABLES, str(tmp_path / "export"), _RUN[1])
    wh = Warehouse(spark, str(tmp_path / "wh"), "t5_")
    result = runs.run_market(wh, str(tmp_path / "export"), M)
    assert result.outcome is runs.Outcome.CHECK_FAILED and result.problems == []
    failed = {n for n, v in check_map(result.results).items() if v[0] == "FAIL"}
    assert failed == {
        "pk_unique__dim_date", f"pk_unique__{P}", f"pk_unique__{C}", f"fk_security__{P}", f"fk_date__{P}",
        f"fk_date__{C}", "not_null__dim_security_ticker", f"not_null__{P}_adj_close", f"price_positive__{P}",
        "consensus_flag_domain", "recon_pair_count_match", "consensus_covers_price_keys",
    }
    assert wh.table("mart", "price_returns").count() > 0
    assert wh.table("mart", "v_recon_pairs").count() > len(syn.truth()["diff"])


@pytest.mark.parametrize("texts", [["2022-07-27\n"], [None, None]], ids=["impossible date", "two reports"])
def test_a_report_that_cannot_be_used_leaves_nothing(spark, export, tmp_path, texts):
    """A ticker row with a date that no calendar has, and two reports in the folder."""
    folder, root = tmp_path / "reports", tmp_path / "wh"
    folder.mkdir()
    for i, bad in enumerate(texts):
        text = syn.report_text()
        if bad:
            text = text.replace(bad, "2022-02-30\n")
            assert "2022-02-30" in text
        (folder / f"{i}.txt").write_text(text, encoding="utf-8")
    wh = Warehouse(spark, str(root), "t6_")
    with pytest.raises(ValueError, match="impossible figure in the row of 'LIMA'|exactly one report"):
        runs.run_market(wh, export, M, str(folder))
    assert not root.exists()
    assert not [d.name for d in spark.catalog.listDatabases() if d.name.startswith("t6_")]


def test_snapshot_keeps_all_rows(spark):
    tables = syn.tables(spark)
    copies = snapshot(tables)
    assert {n: df.count() for n, df in copies.items()} == {n: df.count() for n, df in tables.items()}
    assert all("FileScan" in df._jdf.queryExecution().executedPlan().toString() for df in copies.values())
