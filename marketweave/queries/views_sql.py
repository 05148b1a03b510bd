"""The domain views of ``sources.landing`` as SQL, for the checking queries only."""

from __future__ import annotations


def norm(c: str) -> str:
    t = f"upper(trim({c}))"
    return (
        f"CASE WHEN {c} IS NULL THEN '' WHEN regexp_matches({t}, '^Q[0-9]{{6}}$') THEN substr({t}, 2) "
        f"WHEN regexp_matches({t}, '^[0-9]+$') AND length({t}) < 6 THEN lpad({t}, 6, '0') ELSE {t} END"
    )


def valid(p: str = "") -> str:
    return f"coalesce({p}close_price > 0 AND {p}volume > 0 AND {p}trading_value > 0, false)"


_OVERRIDES = """(VALUES ('XKRX', DATE '2000-05-06', true, 'manual_override_trading_day'), ('XKRX', DATE '2001-05-01', false, 'labour_day'),
 ('XNYS', DATE '2001-07-04', false, 'independence_day'), ('XNYS', DATE '2000-12-25', false, 'christmas')) AS o(exchange_code, calendar_date, m_open, m_reason)"""

VIEWS = {
    "lines": """
SELECT *, ((2 * cents + qty) // (2 * qty))::DOUBLE / 100 AS unit, printf('%06d', l_suppkey) AS code,
  (l_discount < 0.005 AND l_tax < 0.005) AS no_close, (l_discount < 0.005 AND l_tax < 0.005 AND l_returnflag = 'N') AS snap,
  CASE l_linenumber WHEN 1 THEN 'KIS_DETAIL' WHEN 2 THEN 'KIS' WHEN 3 THEN 'KRX' WHEN 4 THEN 'VALID_PRICE_FALLBACK'
    WHEN 5 THEN 'UNKNOWN' WHEN 6 THEN 'UNKNOWN' END AS source,
  round(l_discount * 100)::INT AS disc_pct, round(l_tax * 100)::INT AS tax_pct
FROM (SELECT *, l_quantity::BIGINT AS qty, round(l_extendedprice * 100)::BIGINT AS cents, l_shipdate::DATE AS base_date FROM lineitem)""",
    "prices_raw": """
SELECT CASE WHEN qty = 50 THEN 'Q' ELSE '' END || code AS symbol, base_date,
  CASE WHEN NOT snap THEN unit END AS open_price, CASE WHEN NOT snap THEN unit + 1 END AS high_price,
  CASE WHEN NOT snap THEN unit - 1 END AS low_price, CASE WHEN NOT no_close THEN unit END AS close_price,
  CASE WHEN NOT snap THEN CASE WHEN tax_pct >= 8 THEN 0.0::DOUBLE ELSE l_quantity END END AS volume,
  CASE WHEN NOT snap THEN l_extendedprice END AS trading_value,
  CASE WHEN disc_pct > 2 THEN unit * l_partkey END AS market_cap,
  CASE WHEN disc_pct > 3 THEN l_partkey::DOUBLE END AS outstanding_shares, source,
  base_date::TIMESTAMP + to_minutes(420 + tax_pct) AS available_at
FROM lines""",
    "prices": f"SELECT * REPLACE ({norm('symbol')} AS symbol), symbol AS raw_symbol FROM prices_raw",
    "master": """
SELECT printf('%06d', s_suppkey) AS symbol, s_name AS name, market, CASE WHEN market IN ('ETF', 'ETN') THEN market ELSE 'STOCK' END AS asset_type,
  s_acctbal > 0 AS is_active, s_acctbal FROM (SELECT s.*, CASE n_regionkey WHEN 0 THEN 'KOSPI' WHEN 1 THEN 'KOSDAQ' WHEN 2 THEN 'ETF' WHEN 3 THEN 'ETN' END AS market
  FROM supplier s JOIN nation ON n_nationkey = s_nationkey)""",
    "static_universe": "SELECT symbol, name, market, asset_type, s_acctbal < 9500 AS enabled FROM master WHERE s_acctbal > 7000",
    "supply": """
SELECT code AS symbol, base_date, sum(CASE l_returnflag WHEN 'A' THEN qty WHEN 'R' THEN -qty ELSE 0 END)::DOUBLE AS foreign_net_buy,
  sum(CASE l_linestatus WHEN 'O' THEN qty WHEN 'F' THEN -qty ELSE 0 END)::DOUBLE AS institutional_net_buy,
  CASE WHEN max(tax_pct) > 2 THEN max(disc_pct)::DOUBLE END AS foreign_holding_ratio FROM lines GROUP BY 1, 2""",
    "shorts": """
SELECT code AS symbol, base_date, sum(CASE WHEN l_linestatus = 'F' THEN qty ELSE 0 END)::BIGINT AS short_volume,
  sum(CASE WHEN l_linestatus = 'F' THEN cents ELSE 0 END)::DOUBLE / 100 AS short_value,
  CASE WHEN max(tax_pct) >= 7 THEN NULL WHEN min(disc_pct) = 0 THEN 0.0 ELSE 1.5 END::DOUBLE AS short_ratio FROM lines GROUP BY 1, 2""",
    "snapshots": """
SELECT code AS symbol, base_date, max(unit * l_partkey) AS market_cap, max(l_partkey) AS listed_shares, max(disc_pct)::DOUBLE AS per,
  max(tax_pct)::DOUBLE AS pbr, min(disc_pct)::DOUBLE AS foreign_holding_ratio,
  min(CASE WHEN l_linenumber <= 4 THEN 'KIS' ELSE 'KIS_DETAIL' END) AS source FROM lines GROUP BY 1, 2""",
    "ratios": """
SELECT code AS symbol, base_date, max(disc_pct)::DOUBLE AS per, max(tax_pct)::DOUBLE AS pbr,
  CASE WHEN max(l_linenumber) <= 5 THEN min(tax_pct)::DOUBLE END AS roe, min(disc_pct)::DOUBLE AS debt_ratio,
  min(CASE WHEN l_linenumber <= 4 THEN 'KIS' ELSE 'KIS_DETAIL' END) AS source FROM lines GROUP BY 1, 2""",
    "day_bars": """
SELECT code AS symbol, base_date, max(cents // qty) AS p, sum(qty)::BIGINT AS vol, sum(cents)::BIGINT AS val, max(l_partkey) AS shares, min(tax_pct) AS tx, min(disc_pct) AS dc,
  max(l_linenumber) AS ln FROM lines GROUP BY 1, 2""",
    "macro_series": """
SELECT CASE o_orderpriority WHEN '1-URGENT' THEN 'KR_GOVT_10Y' WHEN '2-HIGH' THEN 'KR_GOVT_3Y' WHEN '3-MEDIUM' THEN 'KR_CORP_AA_3Y'
   WHEN '4-NOT SPECIFIED' THEN 'KR_CORP_BBB_3Y' WHEN '5-LOW' THEN 'USDKRW' END AS series_id, o_orderdate::DATE AS base_date,
  sum(round(o_totalprice * 100)::BIGINT)::DOUBLE / (count(*) * 100)::DOUBLE AS value FROM orders GROUP BY 1, 2""",
    "global_macro": """
SELECT base_date, max(value) FILTER (WHERE series_id = 'KR_GOVT_10Y') AS gold, max(value) FILTER (WHERE series_id = 'KR_GOVT_3Y') AS copper,
  max(value) FILTER (WHERE series_id = 'KR_CORP_AA_3Y') AS wti, max(value) FILTER (WHERE series_id = 'KR_CORP_BBB_3Y') AS us10y,
  max(value) FILTER (WHERE series_id = 'USDKRW') AS usdkrw FROM macro_series GROUP BY 1""",
    "schedule": """
SELECT DISTINCT o_orderdate::DATE AS calendar_date, e AS exchange_code FROM orders, (VALUES ('XKRX'), ('XNYS')) AS x(e)
WHERE isodow(o_orderdate) < 6 AND (e = 'XKRX' OR o_orderstatus = 'F')""",
    "built_calendar": """
SELECT d.calendar_date, e AS exchange_code, s.calendar_date IS NOT NULL AS is_open,
  CASE WHEN s.calendar_date IS NOT NULL THEN 'trading_day' WHEN isodow(d.calendar_date) < 6 THEN 'holiday' ELSE 'weekend' END AS reason
FROM (SELECT unnest(generate_series(min(o_orderdate::DATE), max(o_orderdate::DATE), INTERVAL 1 DAY))::DATE AS calendar_date FROM orders) d
CROSS JOIN (VALUES ('XKRX'), ('XNYS')) AS x(e) LEFT JOIN schedule s ON s.calendar_date = d.calendar_date AND s.exchange_code = e""",
    "calendar": f"""
SELECT b.calendar_date, b.exchange_code, coalesce(m_open, is_open) AS is_open, coalesce(m_reason, reason) AS reason,
  CASE WHEN m_reason IS NULL THEN 'schedule' ELSE 'manual_override' END AS source
FROM built_calendar b LEFT JOIN {_OVERRIDES} ON o.exchange_code = b.exchange_code AND o.calendar_date = b.calendar_date""",
    "open_days": "SELECT calendar_date AS base_date FROM calendar WHERE exchange_code = 'XKRX' AND is_open",
    "rankings": """
SELECT base_date, CASE l_returnflag WHEN 'A' THEN 'KOSPI' WHEN 'R' THEN 'KOSDAQ' WHEN 'N' THEN 'ETF' END AS market,
  CASE WHEN l_linenumber <= 2 THEN 'volume' WHEN l_linenumber <= 4 THEN 'trading_value' ELSE 'market_cap' END AS rank_type,
  (tax_pct * 10 + l_linenumber)::BIGINT AS rank, CASE WHEN qty = 50 THEN 'Q' ELSE '' END || code AS symbol,
  CASE WHEN l_linestatus = 'O' THEN 'KIS' ELSE 'VALID_PRICE_FALLBACK' END AS source, l_extendedprice AS metric_value,
  CASE WHEN disc_pct > 5 THEN base_date - (disc_pct - 5) WHEN disc_pct > 1 THEN base_date END AS source_base_date,
  CASE WHEN disc_pct = 1 THEN base_date - 1 END AS raw_price_date FROM lines""",
    "features": """
SELECT CASE WHEN l_suppkey = 0 THEN 'GLOBAL' ELSE CASE WHEN qty = 50 THEN 'Q' ELSE '' END || code END AS symbol, base_date,
  CASE l_linenumber WHEN 1 THEN 'close_price' WHEN 2 THEN 'return_5d' WHEN 3 THEN 'moving_avg_5' WHEN 4 THEN 'moving_avg_20'
    WHEN 5 THEN 'foreign_flow_zscore' WHEN 6 THEN 'trading_value_ratio_20d' WHEN 7 THEN 'volume' END AS feature_name,
  CASE WHEN tax_pct < 8 THEN unit END AS feature_value FROM lines""",
    "run_logs": """
SELECT o_orderkey AS run_id, CASE o_orderpriority WHEN '1-URGENT' THEN 'daily_stock_pipeline' WHEN '2-HIGH' THEN 'daily_stock_full_price_pipeline'
   WHEN '3-MEDIUM' THEN 'daily_macro_pipeline' WHEN '4-NOT SPECIFIED' THEN 'daily_kis_universe_pipeline' WHEN '5-LOW' THEN 'daily_ranking_pipeline' END AS job_name,
  o_orderdate::DATE AS target_date, CASE o_orderstatus WHEN 'F' THEN 'SUCCESS' WHEN 'O' THEN 'WARN' WHEN 'P' THEN 'FAIL' END AS status,
  o_custkey AS records_processed, printf('universe_count=%d; failed_symbols_count=%d; note', o_custkey, o_orderkey % 7) AS error_message FROM orders""",
    "intraday": """
SELECT ts AS observed_at, ts::DATE AS base_date, CASE event_type WHEN 'click' THEN 'KOSPI' WHEN 'view' THEN 'KOSDAQ' WHEN 'purchase' THEN 'USDKRW'
   WHEN 'signup' THEN 'VIX' WHEN 'error' THEN 'WTI' END AS series_id, value * 10 AS value,
  CASE WHEN k > 20 THEN (k - 50)::DOUBLE / 2 END AS change_rate, CASE WHEN k < 60 THEN 'KIS' WHEN k < 80 THEN 'YAHOO' ELSE 'FALLBACK_DAILY' END AS source, event_id
FROM (SELECT *, json_extract_string(props, '$.k')::INT AS k FROM events)""",
    "filings": "SELECT doc_id, printf('%06d', doc_id) AS symbol, text AS report_nm, lang, source FROM documents",
    "panel": f"""
SELECT * EXCLUDE (rn, pr) FROM (SELECT *, row_number() OVER (PARTITION BY symbol, base_date ORDER BY pr, available_at DESC NULLS LAST,
    trading_value DESC NULLS LAST, volume DESC NULLS LAST, close_price DESC NULLS LAST, market_cap DESC NULLS LAST, outstanding_shares DESC NULLS LAST) AS rn
  FROM (SELECT *, CASE source WHEN 'KIS_DETAIL' THEN 0 WHEN 'KIS' THEN 1 WHEN 'KRX' THEN 2 WHEN 'VALID_PRICE_FALLBACK' THEN 3 ELSE 4 END AS pr
    FROM prices WHERE {valid()} AND coalesce(source, '') <> '' AND base_date IN (SELECT base_date FROM open_days)))
WHERE rn = 1""",
    "joined_panel": """
SELECT p.*, coalesce(s.foreign_net_buy, 0) AS foreign_net_buy FROM panel p LEFT JOIN supply s ON s.symbol = p.symbol AND s.base_date = p.base_date""",
    "listing_updates": "SELECT code AS symbol, max(base_date) AS base_date FROM lines WHERE l_linenumber = 7 GROUP BY 1",
    "static_updates": "SELECT * FROM listing_updates WHERE symbol IN (SELECT symbol FROM static_universe)",
    "series_updates": "SELECT o_orderpriority AS series_id, max(o_orderdate::DATE) AS base_date FROM orders WHERE o_orderstatus = 'P' GROUP BY 1",
    "statements": "SELECT symbol, base_date, val AS revenue, -vol AS operating_income, shares AS total_assets, p AS total_equity FROM day_bars WHERE dc <> 10",
    "raw_supply": "SELECT code AS symbol, base_date, source, qty FROM lines WHERE l_linestatus = 'O'",
    "raw_shorts": "SELECT code AS symbol, base_date, source, qty FROM lines WHERE l_linestatus = 'F' AND tax_pct < 7",
    "raw_rankings": "SELECT * FROM rankings WHERE source = 'KIS'",
    "raw_ecos": "SELECT o_orderpriority AS series_id, o_orderdate::DATE AS base_date, o_totalprice AS value FROM orders WHERE o_orderstatus <> 'P'",
    "breadth": """
SELECT base_date, count(*) FILTER (WHERE l_returnflag = 'A') AS advances, count(*) FILTER (WHERE l_returnflag = 'R') AS declines, count(*) FILTER (WHERE l_returnflag = 'N') AS unchanged,
  coalesce(sum(qty) FILTER (WHERE l_returnflag = 'A'), 0)::BIGINT AS advancing_volume, coalesce(sum(qty) FILTER (WHERE l_returnflag = 'R'), 0)::BIGINT AS declining_volume FROM lines GROUP BY 1""",
    "derivatives": """
SELECT base_date, max(cents)::DOUBLE / 100 AS kospi200_futures, (max(cents) - min(cents))::DOUBLE / 100 AS futures_basis, count(*) AS open_interest, day(base_date) = 14 AS expiration_flag
FROM (SELECT o_orderdate::DATE AS base_date, round(o_totalprice * 100)::BIGINT AS cents FROM orders) GROUP BY 1""",
    "disclosures": "SELECT ts::DATE AS base_date, CASE WHEN event_type = 'click' THEN 'NaverNews' ELSE 'OpenDart' END AS source, event_id FROM events",
    "stock_events": "SELECT ts::DATE AS base_date, printf('%06d', user_id) AS symbol, event_id FROM events WHERE event_type IN ('purchase', 'signup')",
}
