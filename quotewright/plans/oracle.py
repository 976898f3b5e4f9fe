"""The same queries as SQL text for DuckDB, to check results against.

``SQL`` maps query names to statements over the given tables. Most start from
``MARKET``: the six derived tables and what is built on them, as one WITH list.
"""

from __future__ import annotations

SQL: dict[str, str] = {}

_PRICES = "open high low close adj_open adj_high adj_low adj_close".split()

MARKET = """
WITH bars AS (
  SELECT CAST(user_id AS INTEGER) AS security_key, CAST(ts AS DATE) AS day, event_type AS source,
         arg_min(value, event_id) AS open, max(value) AS high, min(value) AS low,
         arg_max(value, event_id) AS close, count(*) AS volume
  FROM events GROUP BY 1, 2, 3
),
fact_price_daily AS (
  SELECT security_key, CAST(strftime(day, '%Y%m%d') AS INTEGER) AS date_key, source,
         CAST(open AS DECIMAL(18,6)) AS open, CAST(high AS DECIMAL(18,6)) AS high,
         CAST(low AS DECIMAL(18,6)) AS low, CAST(close AS DECIMAL(18,6)) AS close,
         CAST(open AS DECIMAL(18,6)) AS adj_open, CAST(high AS DECIMAL(18,6)) AS adj_high,
         CAST(low AS DECIMAL(18,6)) AS adj_low, CAST(close AS DECIMAL(18,6)) AS adj_close,
         volume, volume AS adj_volume
  FROM bars LEFT JOIN customer ON c_custkey = security_key
  WHERE source <> 'view' OR c_mktsegment IS DISTINCT FROM 'MACHINERY'
),
dim_security AS (
  SELECT CAST(c_custkey AS INTEGER) AS security_key, c_name AS ticker,
         'Company ' || c_name AS company_name, c_mktsegment AS gics_sector,
         'NATION_' || c_nationkey AS gics_sub_industry, 'F' || c_custkey AS figi,
         CAST(DATE '2020-01-01' + c_nationkey AS DATE) AS effective_from,
         CASE WHEN c_acctbal < 1000 THEN DATE '2023-12-31' END AS effective_to,
         c_acctbal >= 1000 AS is_current
  FROM customer WHERE c_acctbal >= 0
),
bounds AS (
  SELECT min(d) AS a, max(d) AS b FROM (
    SELECT CAST(o_orderdate AS DATE) AS d FROM orders UNION ALL SELECT CAST(ts AS DATE) FROM events) x
),
days AS (
  SELECT CAST(unnest(generate_series(a, b, INTERVAL 1 DAY)) AS DATE) AS date FROM bounds
),
dim_date AS (
  SELECT CAST(strftime(date, '%Y%m%d') AS INTEGER) AS date_key, date,
         CAST(year(date) AS SMALLINT) AS year, CAST(quarter(date) AS SMALLINT) AS quarter,
         CAST(month(date) AS SMALLINT) AS month, monthname(date) AS month_name,
         CAST(day(date) AS SMALLINT) AS day, CAST(isodow(date) - 1 AS SMALLINT) AS day_of_week,
         dayname(date) AS day_name, isodow(date) <= 5 AS is_weekday, isodow(date) <= 5 AS is_trading_day
  FROM days
),
sides AS (
  SELECT security_key, date_key,
         max(adj_close) FILTER (WHERE source = 'click') AS a,
         max(adj_close) FILTER (WHERE source = 'view') AS b
  FROM fact_price_daily WHERE source IN ('click', 'view') GROUP BY 1, 2
),
measured AS (
  SELECT *, abs(CAST(a AS DOUBLE) - CAST(b AS DOUBLE))
            / NULLIF((CAST(a AS DOUBLE) + CAST(b AS DOUBLE)) / 2, 0) AS diff FROM sides
),
fact_price_daily_consensus AS (
  SELECT security_key, date_key, coalesce(a, b) AS adj_close,
         CASE WHEN a IS NULL THEN 'view' ELSE 'click' END AS primary_source,
         concat_ws('|', CASE WHEN a IS NOT NULL THEN 'click' END, CASE WHEN b IS NOT NULL THEN 'view' END)
           AS sources_available,
         CAST(diff AS DECIMAL(9,6)) AS pct_diff,
         CASE WHEN a IS NULL OR b IS NULL THEN 'single_source' WHEN diff > 0.5 THEN 'disagreed'
              ELSE 'agreed' END AS reconciliation_flag
  FROM measured
),
fact_corporate_action AS (
  SELECT CAST(o_custkey AS INTEGER) AS security_key,
         CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) AS date_key,
         CASE WHEN o_orderstatus = 'O' THEN 'dividend' ELSE 'split' END AS action_type,
         CAST(o_totalprice AS DECIMAL(18,6)) AS value, o_orderpriority AS source
  FROM orders
),
fact_macro_rate AS (
  SELECT CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) AS date_key, o_orderpriority AS series_id,
         CAST(max(o_totalprice) AS DECIMAL(18,6)) AS value
  FROM orders GROUP BY 1, 2
),
price_daily AS (
  SELECT f.security_key, ticker, gics_sector, f.date_key, d.date AS trade_date, source,
         open, high, low, close, adj_open, adj_high, adj_low, adj_close, volume, adj_volume
  FROM fact_price_daily f JOIN dim_security USING (security_key) JOIN dim_date d USING (date_key)
),
price_trusted AS (
  SELECT security_key, ticker, gics_sector, date_key, d.date AS trade_date, adj_close, primary_source,
         sources_available, pct_diff, reconciliation_flag,
         CAST(contains(sources_available, 'click') AS INTEGER) AS has_click,
         CAST(contains(sources_available, 'view') AS INTEGER) AS has_view
  FROM fact_price_daily_consensus JOIN dim_security USING (security_key) JOIN dim_date d USING (date_key)
),
stepped AS (
  SELECT *, CAST(date_diff('day', lag(trade_date) OVER s, trade_date) AS INTEGER) AS days_since_prev,
         CAST(adj_close AS DOUBLE) / NULLIF(CAST(lag(adj_close) OVER s AS DOUBLE), 0) - 1 AS daily_return
  FROM price_trusted WINDOW s AS (PARTITION BY security_key ORDER BY trade_date)
),
usable AS (SELECT *, CASE WHEN days_since_prev <= 3 THEN daily_return END AS u FROM stepped),
price_returns AS (
  SELECT security_key, ticker, gics_sector, date_key, trade_date, adj_close, reconciliation_flag,
         days_since_prev, daily_return,
         CASE WHEN daily_return > -1 THEN ln(1 + daily_return) END AS log_return,
         CASE WHEN days_since_prev > 3 THEN 1 ELSE 0 END AS is_gap_return,
         CASE WHEN count(u) OVER f = 7 THEN stddev_samp(u) OVER f * sqrt(252) END AS vol_7d_ann
  FROM usable
  WINDOW f AS (PARTITION BY security_key ORDER BY trade_date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)
),
pairs AS (
  SELECT a.security_key, a.date_key, CAST(a.adj_close AS DOUBLE) AS click_adj_close,
         CAST(b.adj_close AS DOUBLE) AS view_adj_close,
         abs(CAST(a.adj_close AS DOUBLE) - CAST(b.adj_close AS DOUBLE))
           / NULLIF((CAST(a.adj_close AS DOUBLE) + CAST(b.adj_close AS DOUBLE)) / 2, 0) AS pct_diff
  FROM fact_price_daily a JOIN fact_price_daily b
    ON a.security_key = b.security_key AND a.date_key = b.date_key
  WHERE a.source = 'click' AND b.source = 'view'
),
flagged AS (SELECT *, CASE WHEN pct_diff > 0.5 THEN 1 ELSE 0 END AS is_flagged FROM pairs),
by_ticker AS (
  SELECT ticker, gics_sector, security_key, count(*) AS compared,
         CAST(sum(is_flagged) AS BIGINT) AS flagged,
         CAST(sum(is_flagged) AS DOUBLE) / count(*) AS flagged_pct, max(pct_diff) AS max_pct_diff,
         median(pct_diff) AS median_pct_diff,
         min(date) FILTER (WHERE is_flagged = 1) AS first_flagged_date,
         max(date) FILTER (WHERE is_flagged = 1) AS last_flagged_date
  FROM flagged JOIN dim_security USING (security_key) JOIN dim_date USING (date_key)
  GROUP BY 1, 2, 3
),
coverage AS (
  SELECT ticker, gics_sector, security_key,
         CAST(sum(has_click) AS BIGINT) AS click_rows, CAST(sum(has_view) AS BIGINT) AS view_rows,
         CAST(sum(has_click * has_view) AS BIGINT) AS both_rows,
         CAST(sum(has_click * (1 - has_view)) AS BIGINT) AS click_only_rows,
         CAST(sum((1 - has_click) * has_view) AS BIGINT) AS view_only_rows,
         max(has_view) AS in_view_sample
  FROM price_trusted GROUP BY 1, 2, 3
),
summary AS (
  SELECT compared_pairs, flagged_pairs,
         CAST(flagged_pairs AS DOUBLE) / NULLIF(compared_pairs, 0) AS flagged_pct,
         tickers_compared, tickers_affected, only_click, only_view,
         only_click_unsampled_tickers, only_click_within_sampled_tickers
  FROM (SELECT count(*) AS compared_pairs, count(*) FILTER (WHERE is_flagged = 1) AS flagged_pairs,
               count(DISTINCT security_key) AS tickers_compared,
               count(DISTINCT security_key) FILTER (WHERE is_flagged = 1) AS tickers_affected
        FROM flagged) p,
       (SELECT CAST(coalesce(sum(click_only_rows), 0) AS BIGINT) AS only_click,
               CAST(coalesce(sum(view_only_rows), 0) AS BIGINT) AS only_view,
               CAST(coalesce(sum(click_only_rows) FILTER (WHERE in_view_sample = 0), 0) AS BIGINT)
                 AS only_click_unsampled_tickers,
               CAST(coalesce(sum(click_only_rows) FILTER (WHERE in_view_sample = 1), 0) AS BIGINT)
                 AS only_click_within_sampled_tickers
        FROM coverage) c
)
"""

_RETURN_COLUMNS = """
security_key, ticker, gics_sector, date_key, trade_date, adj_close, reconciliation_flag, days_since_prev,
round(daily_return, 9) + 0.0 AS daily_return, round(log_return, 7) + 0.0 AS log_return, is_gap_return,
round(vol_7d_ann, 5) AS vol_7d_ann
"""
_PAIR_COLUMNS = """
security_key, date_key, round(click_adj_close, 9) AS click_adj_close,
round(view_adj_close, 9) AS view_adj_close, round(pct_diff, 9) AS pct_diff, is_flagged
"""
_SUMMARY_COLUMNS = """
compared_pairs, flagged_pairs, round(flagged_pct, 9) AS flagged_pct, tickers_compared, tickers_affected,
only_click, only_view, only_click_unsampled_tickers, only_click_within_sampled_tickers
"""


def _market(**queries: str) -> None:
    SQL.update({name: f"{MARKET} {sql}" for name, sql in queries.items()})


_market(
    price_daily="SELECT * FROM price_daily",
    price_trusted="SELECT * FROM price_trusted",
    corporate_action="""
      SELECT security_key, ticker, date_key, date AS action_date, action_type, value, source
      FROM fact_corporate_action JOIN dim_security USING (security_key) JOIN dim_date USING (date_key)""",
    macro_rate="""
      SELECT date_key, date AS rate_date, series_id, value
      FROM fact_macro_rate JOIN dim_date USING (date_key)""",
    dim_security_current="""
      SELECT security_key, ticker, company_name, gics_sector, gics_sub_industry, figi
      FROM dim_security WHERE is_current""",
    calendar_dim="""
      SELECT date_key, date AS calendar_date, year, quarter, month, month_name, day_name,
             is_weekday, is_trading_day FROM dim_date""",
    calendar_days="SELECT * FROM dim_date",
    trading_day_flag="""
      SELECT date_key, date, date IN (SELECT CAST(o_orderdate AS DATE) FROM orders) AS is_trading_day
      FROM dim_date""",
    consensus_build="SELECT * FROM fact_price_daily_consensus",
    series_returns=f"SELECT {_RETURN_COLUMNS} FROM price_returns",
    latest_per_entity="""
      SELECT security_key, ticker, gics_sector, trade_date, adj_close,
             round(daily_return, 9) + 0.0 AS daily_return, round(vol_7d_ann, 5) AS vol_7d_ann, reconciliation_flag
      FROM price_returns
      QUALIFY row_number() OVER (PARTITION BY security_key ORDER BY trade_date DESC) = 1""",
    entity_summary="""
      SELECT security_key, ticker, gics_sector, count(*) AS observations, min(trade_date) AS first_date,
             max(trade_date) AS last_date, round(avg(vol_7d_ann), 5) AS avg_vol_7d_ann,
             count(*) FILTER (WHERE reconciliation_flag = 'disagreed') AS disagreed_observations,
             arg_min(adj_close, trade_date) AS first_adj_close,
             arg_max(adj_close, trade_date) AS last_adj_close,
             round(CAST(arg_max(adj_close, trade_date) AS DOUBLE)
                   / NULLIF(CAST(arg_min(adj_close, trade_date) AS DOUBLE), 0) - 1, 9) + 0.0 AS adj_close_return
      FROM price_returns GROUP BY 1, 2, 3""",
    sector_daily_return="""
      SELECT gics_sector, trade_date, count(*) AS securities, round(avg(daily_return), 9) + 0.0 AS ew_return
      FROM price_returns WHERE daily_return IS NOT NULL AND is_gap_return = 0 GROUP BY 1, 2""",
    recon_pairs=f"SELECT {_PAIR_COLUMNS} FROM flagged",
    recon_by_entity="""
      SELECT ticker, gics_sector, security_key, compared, flagged, round(flagged_pct, 9) AS flagged_pct,
             round(max_pct_diff, 9) AS max_pct_diff, round(median_pct_diff, 9) AS median_pct_diff,
             first_flagged_date, last_flagged_date FROM by_ticker""",
    recon_coverage="SELECT * FROM coverage",
    recon_summary=f"SELECT {_SUMMARY_COLUMNS} FROM summary",
    market_run_listings=f"SELECT {_SUMMARY_COLUMNS} FROM summary",
    top_discrepancies=f"""
      SELECT {_PAIR_COLUMNS} FROM flagged
      ORDER BY flagged.pct_diff DESC, security_key, date_key LIMIT 10""",
    price_anomalies="""
      SELECT ticker, trade_date, source, open, open AS high, low, close,
             CASE WHEN low > open THEN 'low>open' WHEN open < low THEN 'high<low'
                  WHEN open < close THEN 'high<close' ELSE 'low>close' END AS violated_rule
      FROM price_daily WHERE low > open OR open < close OR low > close""",
    first_price_anomalies="""
      SELECT ticker, trade_date, source,
             CASE WHEN low > open THEN 'low>open' WHEN open < low THEN 'high<low'
                  WHEN open < close THEN 'high<close' ELSE 'low>close' END AS violated_rule
      FROM price_daily WHERE low > open OR open < close OR low > close
      ORDER BY trade_date, ticker, source, violated_rule LIMIT 10""",
    market_run_lists="""
      SELECT 'null_prices' AS listing, ticker, source, CAST(count(*) AS VARCHAR) AS detail
      FROM price_daily
      WHERE open IS NULL OR high IS NULL OR low IS NULL OR close IS NULL OR adj_open IS NULL
         OR adj_high IS NULL OR adj_low IS NULL OR adj_close IS NULL
      GROUP BY ticker, source
      UNION ALL
      SELECT 'securities_without_prices', ticker, NULL, NULL FROM dim_security
      WHERE is_current AND security_key NOT IN (SELECT security_key FROM fact_price_daily)
      UNION ALL
      SELECT 'anomalies', ticker, source, CAST(trade_date AS VARCHAR) || ' ' || rule FROM (
        SELECT ticker, trade_date, source,
               CASE WHEN low > open THEN 'low>open' WHEN high < low THEN 'high<low' WHEN high < open THEN 'high<open'
                    WHEN high < close THEN 'high<close' WHEN low > close THEN 'low>close' END AS rule
        FROM price_daily)
      WHERE rule IS NOT NULL
      QUALIFY row_number() OVER (ORDER BY trade_date, ticker, source, rule) <= 10""",
    platform_health="""
      SELECT 'dim_date' AS table_name, count(*) AS row_count, CAST(max(date) AS VARCHAR) AS latest_value
      FROM dim_date
      UNION ALL SELECT 'dim_security', count(*), CAST(max(effective_from) AS VARCHAR) FROM dim_security
      UNION ALL SELECT 'fact_price_daily', count(*), CAST(max(date_key) AS VARCHAR) FROM fact_price_daily
      UNION ALL SELECT 'fact_price_daily_consensus', count(*), CAST(max(date_key) AS VARCHAR)
      FROM fact_price_daily_consensus
      UNION ALL SELECT 'fact_corporate_action', count(*), CAST(max(date_key) AS VARCHAR)
      FROM fact_corporate_action
      UNION ALL SELECT 'fact_macro_rate', count(*), CAST(max(date_key) AS VARCHAR) FROM fact_macro_rate""",
    null_price_by_entity="""
      SELECT ticker, source, count(*) AS n_rows, min(trade_date) AS first_date, max(trade_date) AS last_date
      FROM price_daily WHERE volume <= 1 GROUP BY 1, 2""",
    entities_without_rows="""
      SELECT ticker FROM dim_security
      WHERE is_current AND security_key NOT IN (SELECT security_key FROM fact_price_daily)""",
    ordered_write="SELECT * FROM fact_price_daily",
    full_refresh="SELECT * FROM fact_macro_rate",
    control_partition_replace="""
      SELECT DATE '2024-01-31' AS report_ingest_date, ticker, flagged, compared,
             first_flagged_date AS first_flagged, last_flagged_date AS last_flagged
      FROM by_ticker WHERE flagged > 0""",
)

# ------------------------------------------------------------ fingerprints

_METRICS = {
    "dim_date": {
        "min_date_key": "min(date_key)",
        "max_date_key": "max(date_key)",
        "trading_days": "count(*) FILTER (WHERE is_trading_day)",
    },
    "dim_security": {
        "distinct_tickers": "count(DISTINCT ticker)",
        "current_rows": "count(*) FILTER (WHERE is_current)",
        "max_security_key": "max(security_key)",
    },
    "fact_price_daily": {
        "distinct_securities": "count(DISTINCT security_key)",
        "min_date_key": "min(date_key)",
        "max_date_key": "max(date_key)",
        "sum_adj_close": "sum(adj_close)",
        "sum_volume": "sum(volume)",
        **{f"null_{c}": f"count(*) - count({c})" for c in _PRICES},
    },
    "fact_price_daily_consensus": {
        "sum_adj_close": "sum(adj_close)",
        "sum_pct_diff": "sum(pct_diff)",
        "disagreed_rows": "count(*) FILTER (WHERE reconciliation_flag = 'disagreed')",
        "single_source_rows": "count(*) FILTER (WHERE reconciliation_flag = 'single_source')",
        "null_adj_close": "count(*) - count(adj_close)",
        "null_pct_diff": "count(*) - count(pct_diff)",
    },
    "fact_corporate_action": {
        "sum_value": "sum(value)",
        "split_rows": "count(*) FILTER (WHERE action_type = 'split')",
        "null_value": "count(*) - count(value)",
    },
    "fact_macro_rate": {
        "distinct_series": "count(DISTINCT series_id)",
        "sum_value": "sum(value)",
        "null_value": "count(*) - count(value)",
    },
}


def _fingerprint(table: str) -> str:
    metrics = {"row_count": "count(*)", **_METRICS[table]}
    return " UNION ALL ".join(
        f"SELECT '{table}' AS table_name, '{m}' AS metric, CAST({sql} AS DECIMAL(38,6)) AS value FROM {table}"
        for m, sql in metrics.items()
    )


_market(**{f"fingerprint_{t}": _fingerprint(t) for t in _METRICS})
_market(
    export_manifest=" UNION ALL ".join(_fingerprint(t) for t in _METRICS),
    export_files=" UNION ALL ".join(
        f"SELECT '{t}' AS table_name, true AS all_files_same, count(*) > 0 AS has_bytes FROM {t}"
        for t in _METRICS
    ),
    load_log=" UNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) AS rows_expected, count(*) FILTER (WHERE {kept}) AS rows_loaded, "
        f"count(*) = count(*) FILTER (WHERE {kept}) AS fingerprint_match, CAST({messages} AS INTEGER) AS messages, "
        f"CASE WHEN count(*) = count(*) FILTER (WHERE {kept}) THEN '' ELSE 'row_count' END AS first_metric FROM {t}"
        for t, kept, messages in (
            ("dim_date", "true", "1"),
            ("dim_security", "true", "1"),
            ("fact_price_daily", "source <> 'error'", "3 + CAST(count(DISTINCT security_key) <> "
             "count(DISTINCT security_key) FILTER (WHERE source <> 'error') AS INTEGER)"),
            ("fact_price_daily_consensus", "true", "1"),
            ("fact_corporate_action", "value < 400000", "3"),
            ("fact_macro_rate", "true", "1"),
        )
    ),
)

_LINE_METRICS = {
    "row_count": ("count(*)", "count(*)"),
    "distinct_orders": ("count(DISTINCT l_orderkey)", "NULL"),
    "sum_discount": ("sum(d)", "sum(nudged)"),
    "sum_tax": ("sum(t)", "sum(t)"),
    "null_tax": ("count(*) - count(t)", "count(*) - count(t)"),
}
SQL["fingerprint_compare"] = (
    "WITH lines AS (SELECT l_orderkey, CAST(l_discount AS DECIMAL(18,6)) AS d, CAST(l_tax AS DECIMAL(18,6)) AS t, "
    "CAST(l_discount AS DECIMAL(18,6)) + CASE WHEN l_returnflag = 'R' THEN 0.000001 ELSE 0 END AS nudged "
    "FROM lineitem) SELECT * FROM ("
    + " UNION ALL ".join(
        f"SELECT 'lineitem' AS table_name, '{m}' AS metric, CAST({e} AS DECIMAL(38,6)) AS expected, "
        f"CAST({o} AS DECIMAL(38,6)) AS observed FROM lines"
        for m, (e, o) in _LINE_METRICS.items()
    )
    + ") x WHERE expected IS DISTINCT FROM observed"
)

_ORDER_METRICS = {
    "lineitem": {
        "distinct_orders": "count(DISTINCT l_orderkey)",
        "sum_price": "sum(l_extendedprice)",
        **{f"null_{c}": f"count(*) - count({c})" for c in ("l_quantity", "l_extendedprice", "l_discount", "l_tax")},
    },
    "orders": {
        "max_order": "max(o_orderkey)",
        "sum_price": "sum(o_totalprice)",
        "null_o_totalprice": "count(*) - count(o_totalprice)",
    },
    "events": {
        "distinct_users": "count(DISTINCT user_id)",
        "sum_value": "sum(value)",
        "null_value": "count(*) - count(value)",
    },
}


def _exact(sql: str) -> str:
    """Sum the doubles as decimals."""
    return sql.replace("sum(", "sum(CAST(").replace(")", " AS DECIMAL(18,6)))") if sql.startswith("sum(") else sql


SQL["export_order_tables"] = " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, '{m}' AS metric, CAST({_exact(sql)} AS DECIMAL(38,6)) AS value FROM {t}"
    for t, metrics in _ORDER_METRICS.items()
    for m, sql in {"row_count": "count(*)", **metrics}.items()
)

# ----------------------------------------------------- data-quality checks


def _check(name: str, table: str, severity: str, failing: str, checked: str) -> str:
    return (
        f"SELECT '{name}' AS check_name, '{table}' AS table_name, '{severity}' AS severity, "
        f"CAST(({failing}) AS BIGINT) AS failing_count, CAST(({checked}) AS BIGINT) AS checked_rows"
    )


def _results(checks: list[str], prefix: str, shown: str = "*") -> str:
    status = (
        "CASE WHEN failing_count = 0 THEN 'PASS' WHEN severity = 'warn' THEN 'WARN' ELSE 'FAIL' END AS status"
    )
    return f"{prefix} SELECT {shown} FROM (SELECT *, {status} FROM ({' UNION ALL '.join(checks)}) c) r"


def _count(table: str, where: str = "true") -> str:
    return f"SELECT count(*) FROM {table} WHERE {where}"


def _duplicates(table: str, keys: str, where: str = "true") -> str:
    return f"SELECT count(*) FROM (SELECT 1 FROM {table} WHERE {where} GROUP BY {keys} HAVING count(*) > 1) g"


def _orphans(table: str, parent: str, on: str, where: str = "true") -> str:
    return f"SELECT count(*) FROM {table} c WHERE ({where}) AND NOT EXISTS (SELECT 1 FROM {parent} p WHERE {on})"


def _market_checks() -> list[str]:
    p, c = "fact_price_daily", "fact_price_daily_consensus"
    out = []
    for table, keys in (
        ("dim_date", "date_key"),
        ("dim_security", "security_key"),
        (p, "security_key, date_key, source"),
        (c, "security_key, date_key"),
        ("fact_corporate_action", "security_key, date_key, action_type, source"),
        ("fact_macro_rate", "date_key, series_id"),
    ):
        out.append(_check(f"pk_unique__{table}", table, "error", _duplicates(table, keys), _count(table)))
    out.append(_check("one_current_row_per_ticker", "dim_security", "error",
                      _duplicates("dim_security", "ticker", "is_current"), _count("dim_security", "is_current")))
    for table in (p, c, "fact_corporate_action", "fact_macro_rate"):
        for kind in ("security", "date") if table != "fact_macro_rate" else ("date",):
            key = f"{kind}_key"
            out.append(_check(f"fk_{kind}__{table}", table, "error",
                              _orphans(table, f"dim_{kind}", f"p.{key} = c.{key}"), _count(table)))
    any_null = " OR ".join(f"{x} IS NULL" for x in _PRICES)
    both = "reconciliation_flag IN ('agreed', 'disagreed')"
    for name, table, severity, where in (
        ("not_null__dim_security_ticker", "dim_security", "error", "ticker IS NULL"),
        (f"not_null__{p}_adj_close", p, "error", "adj_close IS NULL"),
        (f"not_null__{c}_adj_close", c, "error", "adj_close IS NULL"),
        (f"price_positive__{p}", p, "error", "close <= 0 OR adj_close <= 0"),
        ("null_price_fields", p, "warn", any_null),
        ("ohlc_high_ge_low", p, "warn", "high < low"),
        ("ohlc_low_le_open", p, "warn", "low > open"),
        ("ohlc_low_le_close", p, "warn", "low > close"),
        ("ohlc_high_ge_open", p, "warn", "high < open"),
        ("ohlc_high_ge_close", p, "warn", "high < close"),
        ("consensus_flag_domain", c, "error",
         f"reconciliation_flag IS NULL OR NOT ({both} OR reconciliation_flag = 'single_source')"),
        ("consensus_pct_diff_vs_flag", c, "error",
         f"(reconciliation_flag = 'single_source' AND pct_diff IS NOT NULL) OR ({both} AND pct_diff IS NULL)"),
    ):
        out.append(_check(name, table, severity, _count(table, where), _count(table)))
    out += [
        _check("consensus_flag_vs_tolerance", c, "error",
               _count(c, "(reconciliation_flag = 'agreed' AND pct_diff > 0.5) OR "
                         "(reconciliation_flag = 'disagreed' AND pct_diff < 0.5)"),
               _count(c, "pct_diff IS NOT NULL")),
        _check("recon_pair_count_match", c, "error",
               f"SELECT abs((SELECT count(*) FROM flagged) - ({_count(c, both)}))", _count("flagged")),
        _check("recon_flag_mismatch", c, "warn",
               f"SELECT count(*) FROM flagged JOIN {c} x USING (security_key, date_key) "
               "WHERE (is_flagged = 1) <> (reconciliation_flag = 'disagreed')", _count("flagged")),
        _check("consensus_covers_price_keys", c, "error",
               f"SELECT count(*) FROM (SELECT DISTINCT security_key, date_key FROM {p}) k "
               f"WHERE (security_key, date_key) NOT IN (SELECT (security_key, date_key) FROM {c})",
               f"SELECT count(*) FROM (SELECT DISTINCT security_key, date_key FROM {p}) k"),
        _check("security_without_prices", "dim_security", "warn",
               _orphans("dim_security", p, "p.security_key = c.security_key", "is_current"),
               _count("dim_security", "is_current")),
        _check("trading_day_without_prices", "dim_date", "warn",
               _orphans("dim_date", p, "p.date_key = c.date_key", "is_trading_day"),
               _count("dim_date", "is_trading_day")),
        _check("price_on_non_trading_day", p, "warn",
               f"SELECT count(*) FROM {p} JOIN dim_date USING (date_key) WHERE NOT is_trading_day", _count(p)),
    ]
    return out


SQL["dq_results_all"] = _results(_market_checks(), MARKET)
SQL["market_run"] = SQL["dq_results_all"]
SQL["dq_status_tally"] = _results(_market_checks(), MARKET, "status, count(*) AS checks") + " GROUP BY status"
SQL["dq_not_passed"] = (
    _results(_market_checks(), MARKET, "check_name, severity, status, failing_count") + " WHERE status <> 'PASS'"
)

_LINES = """
WITH lines AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(l_tax AS DECIMAL(18,6)) AS open,
         CAST(l_quantity / 10 AS DECIMAL(18,6)) AS high, CAST(l_discount AS DECIMAL(18,6)) AS low,
         CAST(l_extendedprice / 10000 AS DECIMAL(18,6)) AS close
  FROM lineitem),
violations AS (
  SELECT *, CASE WHEN low > open THEN 'low>open' WHEN high < low THEN 'high<low'
                 WHEN high < open THEN 'high<open' WHEN high < close THEN 'high<close'
                 WHEN low > close THEN 'low>close' END AS violated_rule FROM lines)
"""
SQL["ordering_anomalies"] = f"{_LINES} SELECT * FROM violations WHERE violated_rule IS NOT NULL"
SQL["first_anomalies"] = f"""{_LINES}
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, violated_rule FROM violations
  WHERE violated_rule IS NOT NULL ORDER BY ALL LIMIT 10"""

SQL["dq_unique"] = _results(
    [
        _check("unique_line", "lines", "error", _duplicates("lineitem", "l_orderkey, l_linenumber"), _count("lineitem")),
        _check("unique_order", "orders", "error", _duplicates("orders", "o_orderkey"), _count("orders")),
        _check("one_open_order", "orders", "warn", _duplicates("orders", "o_custkey", "o_orderstatus = 'O'"),
               _count("orders", "o_orderstatus = 'O'")),
    ],
    "",
)
_GOOD = "(SELECT * FROM customer WHERE c_acctbal >= 0)"
SQL["dq_foreign_key"] = _results(
    [
        _check("line_order", "lines", "error", _orphans("lineitem", "orders", "o_orderkey = l_orderkey"),
               _count("lineitem")),
        _check("order_customer", "orders", "error", _orphans("orders", _GOOD, "c_custkey = o_custkey"),
               _count("orders")),
        _check("event_customer", "events", "warn", _orphans("events", _GOOD, "c_custkey = user_id", "value > 10"),
               _count("events", "value > 10")),
        _check("customer_orders", "customer", "warn",
               _orphans("customer", "orders", "o_custkey = c_custkey", "c_acctbal > 0"),
               _count("customer", "c_acctbal > 0")),
    ],
    "",
)
SQL["dq_row_rules"] = _results(
    [
        _check(rule, "lines", "warn", _count("lines", where), _count("lines"))
        for rule, where in (
            ("low>open", "low > open"), ("high<low", "high < low"), ("high<open", "high < open"),
            ("high<close", "high < close"), ("low>close", "low > close"),
        )
    ]
    + [
        _check("positive", "lines", "error", _count("lines", "open <= 0 OR low <= 0"), _count("lines")),
        _check("known", "lines", "error", _count("lines", "close IS NULL"), _count("lines", "high > 2.5")),
    ],
    _LINES,
)
SQL["dq_join_rules"] = _results(
    [
        _check("line_of_open_order", "lines", "warn",
               "SELECT count(*) FROM lineitem JOIN orders ON o_orderkey = l_orderkey WHERE o_orderstatus = 'O'",
               _count("lineitem")),
        _check("event_of_debtor", "events", "warn",
               "SELECT count(*) FROM events JOIN customer ON c_custkey = user_id WHERE c_acctbal < 0",
               _count("events")),
    ],
    "",
)
SQL["dq_anti_distinct"] = _results(
    [
        _check("orders_cover_customers", "orders", "error",
               "SELECT count(DISTINCT c_custkey) FROM customer "
               "WHERE c_acctbal >= 0 AND c_custkey NOT IN (SELECT o_custkey FROM orders)",
               "SELECT count(DISTINCT c_custkey) FROM customer WHERE c_acctbal >= 0"),
    ],
    "",
)
SQL["dq_abs_diff"] = _results(
    [
        _check("pair_count", "fact_price_daily_consensus", "error",
               "SELECT abs((SELECT count(*) FROM pairs) - (SELECT count(*) FROM fact_price_daily_consensus "
               "WHERE reconciliation_flag = 'agreed'))", _count("pairs")),
        _check("pair_flag", "fact_price_daily_consensus", "warn",
               "SELECT count(*) FROM pairs JOIN fact_price_daily_consensus c USING (security_key, date_key) "
               "WHERE (pairs.pct_diff > 0.25) <> (reconciliation_flag = 'disagreed')", _count("pairs")),
    ],
    MARKET,
)

# ------------------------------------------------------- control and audit

_FIGURES = ("compared_pairs", "flagged_pairs", "only_click", "only_view", "tickers_compared", "tickers_affected")
_LOOSER = {
    **{f: f for f in _FIGURES},
    "flagged_pairs": "(SELECT count(*) FROM pairs WHERE pct_diff > 1.0)",
    "tickers_affected": "(SELECT count(DISTINCT security_key) FROM pairs WHERE pct_diff > 1.0)",
}
_LOOSER_TICKERS = """
  (SELECT ticker, count(*) AS published FROM pairs JOIN dim_security USING (security_key)
   WHERE pct_diff > 1.0 GROUP BY 1)"""
_ENTITY_DIFF = f"""
  SELECT ticker, computed, published
  FROM (SELECT ticker, flagged AS computed FROM by_ticker WHERE flagged > 0) w
  FULL JOIN {_LOOSER_TICKERS} r USING (ticker) WHERE computed IS DISTINCT FROM published"""

_market(
    control_compare_headline=" UNION ALL ".join(
        f"SELECT '{f}' AS figure, CAST({f} AS BIGINT) AS computed, CAST({pub} AS BIGINT) AS published, "
        f"CAST(abs({f} - {pub}) AS BIGINT) AS difference FROM summary"
        for f, pub in _LOOSER.items()
    ),
    control_compare_by_entity=_ENTITY_DIFF,
)
SQL["control_results"] = _results(
    [
        _check(f"report_control__{f}", "reconciliation_report_2024-01-31", "error",
               f"SELECT abs({f} - {pub}) FROM summary", f"SELECT {f} FROM summary")
        for f, pub in _LOOSER.items()
    ]
    + [
        _check("report_control__per_ticker_flagged", "reconciliation_report_2024-01-31", "error",
               f"SELECT count(*) FROM ({_ENTITY_DIFF}) m", f"SELECT count(*) FROM {_LOOSER_TICKERS} t"),
    ],
    MARKET,
)
SQL["control_results_without_report"] = _results(
    [
        _check(f"report_control__{f}", "reconciliation_report_2024-02-01", "error",
               "SELECT NULL", f"SELECT {f} FROM summary")
        for f in _FIGURES
    ]
    + [
        _check("report_control__per_ticker_flagged", "reconciliation_report_2024-02-01", "error",
               "SELECT count(DISTINCT ticker) FROM by_ticker WHERE flagged > 0", "SELECT 0"),
    ],
    MARKET,
)

_REPORTED = """,
reported AS (
  SELECT upper(replace(v.ticker, '#', '-')) AS report, v.click_only_rows, v.view_only_rows,
         coalesce(t.compared, 0) AS compared, coalesce(t.flagged, 0) AS flagged,
         t.first_flagged_date, t.last_flagged_date
  FROM coverage v LEFT JOIN by_ticker t USING (security_key)),
-- the row of a security flagged every day is missing from its report
broken AS (SELECT * FROM reported WHERE flagged > 0 AND flagged = compared),
sound AS (SELECT * FROM reported WHERE NOT (flagged > 0 AND flagged = compared))
"""
_market(
    report_headlines=f"""{_REPORTED}
      SELECT report, DATE '2024-01-31' AS report_ingest_date, compared AS compared_pairs,
             flagged AS flagged_pairs, click_only_rows AS only_click, view_only_rows AS only_view,
             CAST(flagged > 0 AS INTEGER) AS tickers_affected, CAST(compared > 0 AS INTEGER) AS tickers_compared
      FROM sound""",
    report_tickers=f"""{_REPORTED}
      SELECT report, DATE '2024-01-31' AS report_ingest_date, report AS ticker, flagged, compared,
             first_flagged_date AS first_flagged, last_flagged_date AS last_flagged
      FROM sound WHERE flagged > 0""",
    report_rejects=f"""{_REPORTED}
      SELECT report, 'parsed 0 ticker rows but the header says 1 tickers affected' AS reason FROM broken""",
)

_RUNS = """
WITH log AS (
  SELECT 'run-' || strftime(ts, '%Y%m%d') AS run_id, event_type AS table_name, count(*) AS rows_loaded,
         max(ts) AS loaded_at
  FROM events GROUP BY 1, 2),
latest AS (SELECT * FROM log WHERE run_id = (SELECT run_id FROM log ORDER BY loaded_at DESC, run_id DESC LIMIT 1))
"""
SQL["latest_run_rows"] = f"{_RUNS} SELECT run_id, table_name, rows_loaded FROM latest"
SQL["audit_append"] = f"""{_RUNS}
  SELECT run_id, table_name, rows_loaded AS rows_expected, rows_loaded, true AS fingerprint_match FROM log"""

SQL["audit_record_twice"] = f"""{_RUNS}
  SELECT substr(run_id, -2, 1) AS run_id, table_name, CAST(sum(rows_loaded) AS BIGINT) AS rows_expected,
         CAST(sum(rows_loaded) AS BIGINT) AS rows_loaded, true AS fingerprint_match
  FROM log GROUP BY 1, 2"""
SQL["pinned_snapshot"] = """
  SELECT 'customer' AS table_name, count(*) AS n_rows, CAST(sum(c_nationkey) AS BIGINT) AS total FROM customer
  UNION ALL SELECT 'lineitem', count(*), CAST(sum(l_linenumber) AS BIGINT) FROM lineitem
  UNION ALL SELECT 'orders', count(*), CAST(sum(o_custkey) AS BIGINT) FROM orders"""
SQL["content_digests"] = """
  SELECT 'orders' AS table_name, count(*) AS n_rows, true AS same, true AS told_apart FROM orders
  UNION ALL SELECT 'customer', count(*), true, true FROM customer"""
SQL["state_history"] = """
  WITH o AS (
    SELECT o_custkey, CAST(date_trunc('month', o_orderdate) AS DATE) AS month, o_orderstatus AS status,
           CASE WHEN substr(o_orderpriority, 1, 1) < '4' THEN substr(o_orderpriority, 1, 1) END AS priority
    FROM orders WHERE o_orderdate IS NOT NULL
  ), seen AS (
    SELECT * FROM o
    QUALIFY row_number() OVER (PARTITION BY o_custkey, month ORDER BY priority DESC NULLS LAST, status DESC NULLS LAST) = 1
  ), days AS (
    SELECT month, lag(month) OVER (ORDER BY month) AS earlier, lead(month) OVER (ORDER BY month) AS later
    FROM (SELECT DISTINCT month FROM o)
  ), marked AS (
    SELECT seen.*, earlier, later, lag(seen.month) OVER w AS before, lag(priority) OVER w AS p, lag(status) OVER w AS s
    FROM seen JOIN days ON days.month = seen.month
    WINDOW w AS (PARTITION BY o_custkey ORDER BY seen.month)
  ), numbered AS (
    SELECT *, sum(CASE WHEN before IS NULL OR before IS DISTINCT FROM earlier OR p IS DISTINCT FROM priority
                            OR s IS DISTINCT FROM status THEN 1 ELSE 0 END)
              OVER (PARTITION BY o_custkey ORDER BY month) AS version
    FROM marked
  )
  SELECT o_custkey, min(priority) AS priority, min(status) AS status, CAST(version AS BIGINT) AS version,
         min(month) AS valid_from, CASE WHEN max(month) < (SELECT max(month) FROM days) THEN max(later) END AS valid_to,
         max(month) = (SELECT max(month) FROM days) AS is_current, count(*) AS snapshots
  FROM numbered GROUP BY o_custkey, version"""

_STATUS = _results(_market_checks(), "", "status")
_LATEST = """(SELECT vol_7d_ann FROM price_returns
  QUALIFY row_number() OVER (PARTITION BY security_key ORDER BY trade_date DESC) = 1)"""
_MEASURES = {
    "securities": "SELECT count(DISTINCT security_key) FROM price_returns",
    "observations": "SELECT count(*) FROM price_returns",
    "avg_daily_return": "SELECT avg(daily_return) FROM price_returns WHERE is_gap_return = 0",
    "avg_vol_7d_ann": "SELECT avg(vol_7d_ann) FROM price_returns",
    "latest_vol_7d_ann": f"SELECT avg(vol_7d_ann) FROM {_LATEST} l",
    "compared_pairs": "SELECT compared_pairs FROM summary",
    "flagged_pairs": "SELECT flagged_pairs FROM summary",
    "flagged_pct": "SELECT flagged_pct FROM summary",
    "tickers_affected": "SELECT tickers_affected FROM summary",
    "tickers_compared": "SELECT tickers_compared FROM summary",
    **{
        f"checks_{word}": f"SELECT count(*) FROM statuses WHERE status = '{status}'"
        for word, status in (("passed", "PASS"), ("warned", "WARN"), ("failed", "FAIL"))
    },
    "tables_verified": """SELECT count(*) FROM events_of_run WHERE rows_loaded > 60""",
}
_market(
    bi_measures=f""",
      statuses AS ({_STATUS}),
      event_log AS (SELECT CAST(ts AS DATE) AS day, event_type, count(*) AS rows_loaded, max(ts) AS loaded_at
                    FROM events GROUP BY 1, 2),
      events_of_run AS (SELECT * FROM event_log
                        WHERE day = (SELECT day FROM event_log ORDER BY loaded_at DESC, day DESC LIMIT 1)) """
    + " UNION ALL ".join(
        f"SELECT '{name}' AS measure, round(CAST(({sql}) AS DOUBLE), 6) AS value" for name, sql in _MEASURES.items()
    )
)

# ------------------------------------------------- order and line queries

SQL["star_join_orders"] = """
  SELECT o_orderkey, o_totalprice, c_mktsegment AS segment, n_name AS nation
  FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey"""
SQL["source_membership_flags"] = """
  SELECT user_id, CAST(ts AS DATE) AS day,
         string_agg(DISTINCT event_type, '|' ORDER BY event_type) AS sources,
         CAST(bool_or(event_type = 'click') AS INTEGER) AS has_click,
         CAST(bool_or(event_type = 'view') AS INTEGER) AS has_view,
         CAST(bool_or(event_type = 'purchase') AS INTEGER) AS has_purchase, 0 AS has_clic
  FROM events GROUP BY 1, 2"""


def _volatility(gap: int, window: int) -> str:
    return f"""
  WITH prices AS (
    SELECT CAST(l_suppkey AS INTEGER) AS supplier, CAST(l_shipdate AS DATE) AS day,
           CAST(max(l_extendedprice) AS DECIMAL(18,6)) AS price FROM lineitem GROUP BY 1, 2),
  stepped AS (
    SELECT *, CAST(date_diff('day', lag(day) OVER s, day) AS INTEGER) AS days_since_prev,
           CAST(price AS DOUBLE) / NULLIF(CAST(lag(price) OVER s AS DOUBLE), 0) - 1 AS daily_return
    FROM prices WINDOW s AS (PARTITION BY supplier ORDER BY day)),
  usable AS (SELECT *, CASE WHEN days_since_prev <= {gap} THEN daily_return END AS u FROM stepped)
  SELECT supplier, day, price, days_since_prev, round(daily_return, 9) + 0.0 AS daily_return,
         round(CASE WHEN daily_return > -1 THEN ln(1 + daily_return) END, 7) + 0.0 AS log_return,
         CASE WHEN days_since_prev > {gap} THEN 1 ELSE 0 END AS is_gap_return,
         round(CASE WHEN count(u) OVER f = {window} THEN stddev_samp(u) OVER f * sqrt(252) END, 4)
           AS vol_{window}d_ann
  FROM usable
  WINDOW f AS (PARTITION BY supplier ORDER BY day ROWS BETWEEN {window - 1} PRECEDING AND CURRENT ROW)"""


SQL["rolling_volatility"] = _volatility(10, 21)
SQL["rolling_volatility_whole_series"] = _volatility(5, 5)
SQL["series_returns_with_copies"] = """
  WITH prices AS (
    SELECT l_returnflag AS flag, CAST(l_shipdate AS DATE) AS day, CAST(l_quantity AS DECIMAL(18,6)) AS price,
           l_linestatus FROM lineitem),
  stepped AS (
    SELECT *, row_number() OVER s AS nth,
           CAST(date_diff('day', lag(day) OVER s, day) AS INTEGER) AS days_since_prev,
           CAST(price AS DOUBLE) / NULLIF(CAST(lag(price) OVER s AS DOUBLE), 0) - 1 AS daily_return
    FROM prices WINDOW s AS (PARTITION BY flag ORDER BY day, l_linestatus, price)),
  usable AS (SELECT *, CASE WHEN days_since_prev <= 3 THEN daily_return END AS u FROM stepped)
  SELECT flag, day, price, l_linestatus, days_since_prev, round(daily_return, 9) + 0.0 AS daily_return,
         round(CASE WHEN daily_return > -1 THEN ln(1 + daily_return) END, 7) + 0.0 AS log_return,
         CASE WHEN days_since_prev > 3 THEN 1 ELSE 0 END AS is_gap_return,
         round(CASE WHEN count(u) OVER f = 6 THEN stddev_samp(u) OVER f * sqrt(252) END, 3) AS vol_6d_ann
  FROM usable
  WINDOW f AS (PARTITION BY flag ORDER BY nth ROWS BETWEEN 5 PRECEDING AND CURRENT ROW)"""
SQL["repeated_rows"] = """
  SELECT l_orderkey, l_linenumber, CAST(sum(CAST(round(l_tax * 100) AS BIGINT)) AS BIGINT) AS copies
  FROM lineitem WHERE round(l_tax * 100) > 0 GROUP BY 1, 2"""
SQL["grouped_median_null_key"] = """
  SELECT CASE WHEN l_linenumber < 5 THEN l_returnflag END AS flag,
         round(median(l_extendedprice), 6) AS median_l_extendedprice
  FROM lineitem GROUP BY 1"""
SQL["recon_pairs_with_copies"] = """
  WITH lines AS (SELECT l_partkey, l_returnflag, l_quantity AS q FROM lineitem),
  p AS (SELECT a.l_partkey, abs(a.q - b.q) / NULLIF((a.q + b.q) / 2, 0) AS diff
        FROM lines a JOIN lines b USING (l_partkey)
        WHERE a.l_returnflag = 'A' AND b.l_returnflag = 'N')
  SELECT l_partkey, count(*) AS compared, count(*) FILTER (WHERE diff > 0.5) AS flagged,
         round(max(diff), 9) AS max_pct_diff
  FROM p GROUP BY 1"""
SQL["grouped_median"] = """
  SELECT l_returnflag, l_linestatus, round(median(l_extendedprice), 6) AS median_l_extendedprice
  FROM lineitem GROUP BY 1, 2"""
SQL["nan_census"] = """
  SELECT * FROM (
    SELECT 'L_DISCOUNT' AS column_name, count(*) FILTER (WHERE l_discount = 0) AS nan_count FROM lineitem
    UNION ALL SELECT 'L_TAX', count(*) FILTER (WHERE l_tax = 0) FROM lineitem) x
  WHERE nan_count > 0"""
SQL["clean_projection"] = """
  SELECT l_orderkey, l_linenumber, CAST(NULLIF(l_discount, 0) AS DECIMAL(18,6)) AS l_discount,
         CAST(NULLIF(l_tax, 0) AS DECIMAL(18,6)) AS l_tax,
         CAST(l_extendedprice AS DECIMAL(18,6)) AS l_extendedprice,
         l_returnflag || '|' || l_linestatus AS flags
  FROM lineitem"""


def _plain(column: str) -> str:
    return f"rtrim(rtrim(CAST(CAST({column} AS DECIMAL(38,6)) AS VARCHAR), '0'), '.') AS {column}"


SQL["canonical_numbers"] = f"""
  SELECT l_orderkey, l_linenumber, {_plain('l_discount')}, {_plain('l_quantity')}, {_plain('l_extendedprice')}
  FROM lineitem"""
