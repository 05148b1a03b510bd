"""Data-quality audits."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from ..operators import aggregates as agg, audits as au, calendar as cal, joins as jn, prices as px
from ..sources import scan
from .macro_q import _FX, _IDXWIDE, etf_view, snapshot
from .normalize_q import c, text
from .rankings_q import _DETAIL, _Q, _REPORT_VIEW, combined, report_rows
from .registry import TARGET, query
from .views_sql import valid
from .windows_q import DEMO_BOUNDS, panel

_GOAL = "goal AS (SELECT max(base_date) AS g FROM open_days WHERE base_date <= $T)"
_BAD = "(coalesce(volume, 0) <= 0 OR coalesce(trading_value, 0) <= 0)"
_SNAP = "(open_price IS NULL AND high_price IS NULL AND low_price IS NULL AND close_price IS NULL AND volume IS NULL AND trading_value IS NULL)"


def is_open(L):
    return au.one(L.open_days.where(c("base_date") == F.lit(TARGET)), F.count(F.lit(1))) > 0


#: The audited tables: the landing's name of each, and its kind.
_KINDS = {
    "normalized_stock_prices_daily": ("prices_raw", "prices"), "normalized_stock_supply_daily": ("supply", "supply"), "normalized_stock_short_selling": ("shorts", "shorts"),
    "normalized_stock_snapshots_daily": ("snapshots", "krx"), "normalized_market_rankings_daily": ("rankings", "krx"), "normalized_stock_fundamentals_ratios": ("ratios", "ratios"),
    "normalized_stock_events_daily": ("stock_events", "krx"), "normalized_macro_series": ("macro_series", "other"), "normalized_global_macro_daily": ("global_macro", "other"),
    "market_breadth_daily": ("breadth", "other"), "feature_store_daily": ("features", "covered"), "raw_stock_prices_daily": ("day_bars", "krx"), "raw_stock_supply_daily": ("raw_supply", "krx"),
    "raw_stock_short_selling": ("raw_shorts", "krx"), "raw_market_rankings": ("raw_rankings", "krx"), "raw_ecos_macro_daily": ("raw_ecos", "other"), "stocks_master": ("listing_updates", "other"),
    "macro_series_master": ("series_updates", "other"), "normalized_stock_fundamentals": ("statements", "legacy"),
}


_FRESH = "UNION ALL ".join(
    f"""SELECT '{n}' AS table_name, '{k}' AS kind, count(*) AS row_count, max(base_date) AS latest_date, count(*) FILTER (WHERE base_date = $T) AS target_count,
 {'(SELECT count(DISTINCT symbol) FROM ' + t + ' WHERE base_date = (SELECT max(base_date) FROM ' + t + ') AND symbol IN (SELECT symbol FROM master WHERE is_active)' + (' AND ' + valid() if k == 'prices' else '') + ')' if k in au.COVERED_KINDS else 'NULL::BIGINT'} AS covered FROM {t} """
    for n, (t, k) in _KINDS.items())


@query("dq_table_freshness", f"""WITH f AS ({_FRESH}), n AS (SELECT count(*) AS active FROM master WHERE is_active), o AS (SELECT count(*) > 0 AS opn FROM open_days WHERE base_date = $T),
x AS (SELECT f.*, covered::DOUBLE / greatest(active, 1) AS coverage, CASE WHEN covered IS NOT NULL THEN active - covered END AS missing, date_diff('day', latest_date, $T) AS stale_days, opn FROM f, n, o)
SELECT table_name, row_count, latest_date, target_count, coverage, missing, stale_days, CASE WHEN kind = 'legacy' THEN 'LEGACY' WHEN row_count = 0 THEN 'FAIL_EMPTY' WHEN stale_days IS NULL THEN 'FAIL_SCHEMA' WHEN kind = 'shorts' AND stale_days > 5 THEN 'WARN_STALE' WHEN kind = 'shorts' THEN 'SUCCESS'
 WHEN kind IN ('prices', 'supply', 'ratios', 'krx') AND NOT opn AND target_count > 0 THEN 'WARN_CLOSED_MARKET_ROWS' WHEN kind IN ('prices', 'supply', 'ratios', 'krx') AND NOT opn THEN 'OK_CLOSED_MARKET_NO_ROWS'
 WHEN kind = 'prices' AND coverage < 0.7 THEN 'WARN_COVERAGE' WHEN kind = 'supply' AND coverage < 0.4 THEN 'WARN_COVERAGE' WHEN stale_days > 5 THEN 'WARN_STALE' WHEN target_count = 0 AND stale_days > 0 THEN 'WARN_NO_TARGET_ROWS' ELSE 'SUCCESS' END AS status FROM x""",
       "latest_date", "coverage")
def dq_table_freshness(L):
    return au.table_freshness({n: (getattr(L, t), k) for n, (t, k) in _KINDS.items()}, L.master.where("is_active"), TARGET, is_open(L))


@query("dq_core_macro_freshness", """
WITH w AS (SELECT DISTINCT CASE o_orderpriority WHEN '1-URGENT' THEN 'KR_GOVT_10Y' WHEN '2-HIGH' THEN 'KR_GOVT_3Y' WHEN '3-MEDIUM' THEN 'USDKRW' WHEN '4-NOT SPECIFIED' THEN 'KR_CD_91D' ELSE 'KR_CORP_AA_3Y' END AS series_id FROM orders),
x AS (SELECT w.series_id, max(m.base_date) AS latest_date, date_diff('day', max(m.base_date), DATE '2001-08-05') AS stale_days FROM w LEFT JOIN macro_series m ON m.series_id = w.series_id GROUP BY 1)
SELECT *, CASE WHEN stale_days IS NULL THEN 'FAIL_EMPTY' WHEN series_id IN ('KR_GOVT_10Y', 'USDKRW') AND stale_days > 5 THEN 'FAIL_STALE' WHEN series_id IN ('KR_GOVT_10Y', 'USDKRW') AND stale_days > 2 THEN 'WARN_STALE' WHEN stale_days > 5 THEN 'WARN_STALE' ELSE 'SUCCESS' END AS status FROM x""", "latest_date")
def dq_core_macro_freshness(L):
    sid = F.lit(None).cast("string")
    for key, name in {"1-URGENT": "KR_GOVT_10Y", "2-HIGH": "KR_GOVT_3Y", "3-MEDIUM": "USDKRW", "4-NOT SPECIFIED": "KR_CD_91D", "5-LOW": "KR_CORP_AA_3Y"}.items():
        sid = F.when(c("o_orderpriority") == key, name).otherwise(sid)
    return au.core_macro_freshness(L.table("orders").select(sid.alias("series_id")).distinct(), L.macro_series, date(2001, 8, 5))


_PRICE_PANEL = f"""count(*) AS latest_total_rows, count(*) FILTER (WHERE close_price IS NULL) AS null_close_rows, count(*) FILTER (WHERE volume IS NULL) AS null_volume_rows, count(*) FILTER (WHERE trading_value IS NULL) AS null_trading_value_rows,
 count(*) FILTER (WHERE {_SNAP}) AS snapshot_only_rows, count(*) FILTER (WHERE {valid()}) AS valid_price_rows"""
_PRICE_STATUS = "CASE WHEN snapshot_only_rows > 0 THEN 'FAIL_PRICE_QUALITY' WHEN valid_price_rows = 0 THEN 'FAIL_NO_VALID_PRICE_ROWS' WHEN latest_total_rows > 0 AND valid_price_rows / latest_total_rows < 0.8 THEN 'WARN_PRICE_NULL_RATIO' ELSE 'SUCCESS' END"


@query("dq_price_table", f"WITH x AS (SELECT max(base_date) AS latest_price_date, {_PRICE_PANEL} FROM prices_raw WHERE base_date = (SELECT max(base_date) FROM prices_raw)) SELECT *, {_PRICE_STATUS} AS status FROM x", "latest_price_date")
def dq_price_table(L):
    return au.price_table(L.prices_raw)


def _side(side: str, table: str) -> str:
    return f"""SELECT '{side}' AS side, max(base_date) AS base_date, count(*) AS total_rows, count(close_price) AS valid_close_rows, count(volume) AS valid_volume_rows, count(trading_value) AS valid_trading_value_rows, count(m.symbol) AS market_not_null_rows
 FROM {table} t LEFT JOIN master m ON m.symbol = t.symbol AND m.market IS NOT NULL WHERE base_date = (SELECT max(base_date) FROM {table})"""


@query("dq_raw_vs_normalized", f"WITH rawt AS (SELECT symbol, base_date, CASE WHEN tx > 0 THEN p END AS close_price, vol AS volume, CASE WHEN dc > 0 THEN val END AS trading_value FROM day_bars) {_side('raw', 'rawt')} UNION ALL {_side('normalized', 'prices_raw')}", "base_date")
def dq_raw_vs_normalized(L):
    from ..sources.payloads import field, parsed

    nested = F.struct(F.struct(F.when(c("tx") > 0, text("p")).otherwise("").alias("stck_clpr")).alias("response_row"), text("vol").alias("volume"), F.when(c("dc") > 0, text("val")).alias("acml_tr_pbmn"))
    raw = parsed(L.day_bars.select("symbol", "base_date", F.to_json(nested).alias("raw_data"))).select(
        "symbol", "base_date", field("stck_clpr", "doc", "close_price").alias("close_price"), field("acml_vol", "doc", "volume").alias("volume"), field("acml_tr_pbmn", "doc", "trading_value").alias("trading_value"))
    return au.raw_vs_normalized(raw, L.prices_raw, L.master)


@query("dq_ratio_short", """
SELECT * FROM (SELECT max(base_date) AS ratio_date, count(*) FILTER (WHERE per = 0) AS per_zero_rows, count(*) FILTER (WHERE pbr = 0) AS pbr_zero_rows, count(*) FILTER (WHERE roe = 0) AS roe_zero_rows, count(*) FILTER (WHERE debt_ratio = 0) AS debt_ratio_zero_rows
 FROM ratios WHERE base_date = (SELECT max(base_date) FROM ratios)), (SELECT max(base_date) AS short_date, count(*) AS short_rows, count(*) FILTER (WHERE short_volume > 0 AND short_value > 0 AND coalesce(short_ratio, 0) = 0) AS positive_short_missing_ratio_rows
 FROM shorts WHERE base_date = (SELECT max(base_date) FROM shorts))""", "ratio_date short_date")
def dq_ratio_short(L):
    return au.ratio_short(L.ratios, L.shorts)


_SYM = ("features", "prices_raw", "day_bars", "supply", "shorts", "snapshots", "ratios", "rankings", "static_universe")


@query("dq_symbol_normalization", " UNION ALL ".join(
    f"""SELECT '{t}' AS table_name, count(*) FILTER (WHERE symbol LIKE 'Q%') AS q_prefix_rows, count(DISTINCT symbol) FILTER (WHERE symbol LIKE 'Q%' AND substr(symbol, 2) IN (SELECT symbol FROM {t})) AS canonical_duplicates,
 CASE WHEN count(*) FILTER (WHERE symbol LIKE 'Q%') > 0 THEN 'FAIL_SYMBOL_NORMALIZATION' ELSE 'SUCCESS' END AS status FROM {t}""" for t in _SYM))
def dq_symbol_normalization(L):
    return au.symbol_normalization({n: getattr(L, n) for n in _SYM})


@query("dq_symbol_candidates", " UNION ALL ".join(
    f"""SELECT '{t}' AS table_name, s AS symbol, count(*) FILTER (WHERE symbol LIKE 'Q%') AS q_rows, count(*) FILTER (WHERE symbol NOT LIKE 'Q%') AS plain_rows
FROM (SELECT *, CASE WHEN symbol LIKE 'Q%' THEN substr(symbol, 2) ELSE symbol END AS s FROM {t}) GROUP BY s HAVING count(*) FILTER (WHERE symbol LIKE 'Q%') > 0 AND count(*) FILTER (WHERE symbol NOT LIKE 'Q%') > 0""" for t in _SYM))
def dq_symbol_candidates(L):
    return au.symbol_candidates({n: getattr(L, n) for n in _SYM})


_RANKJOIN = "lr AS (SELECT r.*, coalesce(m.market, CASE WHEN m.symbol IS NOT NULL THEN 'UNKNOWN' END) AS mm FROM rankings r LEFT JOIN master m ON m.symbol = r.symbol WHERE base_date = (SELECT max(base_date) FROM rankings))"


@query("dq_market_ranking", f"""WITH {_RANKJOIN}, p AS (SELECT market, rank_type, count(*) AS row_count, count(*) FILTER (WHERE mm IS NULL) AS no_master_rows, count(*) FILTER (WHERE mm <> market) AS market_mismatch_rows, count(*) FILTER (WHERE symbol LIKE 'Q%') AS q_prefix_rows FROM lr GROUP BY 1, 2)
SELECT *, CASE WHEN q_prefix_rows > 0 THEN 'FAIL_SYMBOL_NORMALIZATION' WHEN market = 'KOSPI' AND market_mismatch_rows > 0 THEN 'FAIL_RANKING_MARKET_MISMATCH' ELSE 'SUCCESS' END AS status,
 coalesce((SELECT string_agg(e, ',' ORDER BY e) FROM (VALUES ('KOSPI:volume'), ('KOSDAQ:volume'), ('ETF:volume'), ('ETN:volume')) AS t(e) WHERE e NOT IN (SELECT market || ':' || rank_type FROM lr)), '') AS missing_expected FROM p""")
def dq_market_ranking(L):
    missing = au.missing_rankings(L.rankings, [(m, "volume") for m in au.MARKETS])
    return au.market_ranking(L.rankings, L.master).withColumn("missing_expected", missing)


@query("dq_market_master", """
WITH x AS (SELECT count(*) FILTER (WHERE market = 'KOSPI') AS kospi, count(*) FILTER (WHERE market = 'KOSDAQ') AS kosdaq, count(*) FILTER (WHERE market = 'ETF') AS etf, count(*) FILTER (WHERE market = 'ETN') AS etn,
 count(*) FILTER (WHERE market IS NULL) AS unknown_market, count(*) - count(DISTINCT symbol) AS duplicate_symbols, 0::BIGINT AS q_prefix FROM master)
SELECT *, CASE WHEN kosdaq < 10 THEN 'FAIL_KOSDAQ_MASTER' WHEN etf < 30 THEN 'WARN_ETF_MASTER' WHEN etn = 0 THEN 'WARN_ETN_MASTER' ELSE 'SUCCESS' END AS status FROM x""")
def dq_market_master(L):
    return au.market_master(L.master, 10, 30)


_DAYCOUNTS = ", ".join(
    f"count(*) FILTER (WHERE m.market = '{m}') AS {m.lower()}_total, count(*) FILTER (WHERE m.market = '{m}' AND {valid()}) AS {m.lower()}_valid, count(*) FILTER (WHERE m.market = '{m}' AND NOT {valid()} AND close_price IS NOT NULL AND {_BAD}) AS {m.lower()}_zero"
    for m in ("KOSPI", "KOSDAQ", "ETF", "ETN"))
_DAYC = f"dayc AS (SELECT {_DAYCOUNTS} FROM prices p LEFT JOIN master m ON m.symbol = p.symbol, goal WHERE base_date = g)"


@query("dq_price_coverage_by_market", f"""WITH {_GOAL}, {_DAYC}
SELECT *, CASE WHEN kospi_valid >= 2 THEN 'KOSPI_PRICE_READY' ELSE 'FAIL_KOSPI_PRICE_COVERAGE' END AS kospi_readiness, CASE WHEN kosdaq_valid >= 5 THEN 'KOSDAQ_PRICE_READY' ELSE 'FAIL_KOSDAQ_PRICE_COVERAGE' END AS kosdaq_readiness,
 CASE WHEN etf_valid > 0 THEN 'ETF_PRICE_READY' ELSE 'WARN_ETF_PRICE_COVERAGE' END AS etf_readiness, CASE WHEN etn_valid > 0 THEN 'ETN_PRICE_READY' ELSE 'WARN_ETN_PRICE_COVERAGE' END AS etn_readiness,
 (SELECT string_agg(t, ',' ORDER BY t) FROM (SELECT coalesce(source, 'UNKNOWN') || '=' || count(*) AS t FROM prices_raw, goal WHERE base_date = g GROUP BY coalesce(source, 'UNKNOWN'))) AS source_mix,
 CASE WHEN kospi_valid < 2 OR kosdaq_valid < 5 THEN 'FAIL_INSUFFICIENT_STOCK_PRICE_ROWS' WHEN kospi_zero + kosdaq_zero + etf_zero + etn_zero > 0 THEN 'WARN_OPEN_MARKET_ZERO_VOLUME_ROWS' ELSE 'SUCCESS' END AS status FROM dayc""")
def dq_price_coverage_by_market(L):
    return au.price_coverage_by_market(L.prices_raw, L.master, L.open_days, TARGET, 2, 5)


@query("dq_full_market_coverage", f"""WITH {_GOAL}, x AS (SELECT max(g) AS goal_day, count(*) FILTER (WHERE m.market = 'KOSPI') AS kospi_rows, count(*) FILTER (WHERE m.market = 'KOSDAQ') AS kosdaq_rows FROM prices p LEFT JOIN master m ON m.symbol = p.symbol, goal WHERE base_date = g AND {valid()})
SELECT *, kospi_rows >= 2 AND kosdaq_rows >= 5 AS full_market_price_ready, CASE WHEN kospi_rows >= 2 AND kosdaq_rows >= 5 THEN 'SUCCESS' WHEN kospi_rows < 2 AND kosdaq_rows < 5 THEN 'WARN_KR_STOCK_PRICE_COVERAGE' ELSE 'WARN_PARTIAL_KR_STOCK_PRICE_COVERAGE' END AS status FROM x""", "goal_day")
def dq_full_market_coverage(L):
    return au.full_market_coverage(L.prices_raw, L.master, L.open_days, TARGET, 2, 5)


@query("dq_universe_coverage", f"""
WITH l AS (SELECT * FROM run_logs WHERE job_name = 'daily_kis_universe_pipeline' AND target_date <= $T ORDER BY target_date DESC, run_id DESC LIMIT 1),
raws AS (SELECT DISTINCT symbol FROM prices WHERE source = 'KIS_DETAIL' AND base_date = (SELECT target_date FROM l)),
x AS (SELECT target_date AS run_date, status AS log_status, regexp_extract(error_message, 'failed_symbols_count=([0-9]+)', 1)::BIGINT AS logged_failures, (SELECT count(*) FROM raws) AS detail_success_count,
 (SELECT count(DISTINCT symbol) FROM prices WHERE base_date = l.target_date AND {valid()} AND symbol IN (SELECT symbol FROM raws)) AS price_valid_count,
 (SELECT count(*) FROM snapshots WHERE source = 'KIS_DETAIL' AND base_date = l.target_date) AS snapshot_success_count, (SELECT count(*) FROM ratios WHERE source = 'KIS_DETAIL' AND base_date = l.target_date) AS ratio_success_count FROM l),
y AS (SELECT *, greatest(detail_success_count, snapshot_success_count, ratio_success_count) AS universe_count FROM x),
z AS (SELECT *, CASE WHEN logged_failures > 0 THEN logged_failures ELSE universe_count - detail_success_count END AS failed_symbols_count FROM y)
SELECT *, CASE WHEN universe_count = 0 THEN 'FAIL_KIS_UNIVERSE_EMPTY' WHEN failed_symbols_count > 0 OR universe_count > detail_success_count THEN 'WARN_PARTIAL_KIS_UNIVERSE_COVERAGE' ELSE 'SUCCESS' END AS status FROM z""", "run_date")
def dq_universe_coverage(L):
    return au.universe_coverage(L.run_logs, L.snapshots, L.ratios, L.prices_raw, TARGET)


@query("dq_ranking_source", f"""WITH {_RANKJOIN},
a AS (SELECT max(base_date) AS latest_date, """ + ", ".join(f"count(*) FILTER (WHERE rank_type = 'volume' AND market = '{m}' AND source = '{s}') AS {m.lower()}_volume_{s.lower()}" for m in ("KOSPI", "KOSDAQ") for s in ("KIS", "VALID_PRICE_FALLBACK")) + ", "
       + ", ".join(f"count(*) FILTER (WHERE rank_type = 'volume' AND market = '{m}') AS {m.lower()}_volume" for m in ("KOSPI", "KOSDAQ", "ETF", "ETN")) + f""", count(*) FILTER (WHERE mm <> market) AS mismatch_rows, count(*) FILTER (WHERE symbol LIKE 'Q%') AS q_prefix_rows,
 coalesce(bool_or(market = 'KOSPI' AND source <> 'KIS'), false) AS kospi_price_based, coalesce(bool_or(market = 'KOSDAQ' AND source <> 'KIS'), false) AS kosdaq_price_based FROM lr),
v AS (SELECT count(*) FILTER (WHERE m.market = 'KOSPI') AS kospi_rows, count(*) FILTER (WHERE m.market = 'KOSDAQ') AS kosdaq_rows FROM prices p LEFT JOIN master m ON m.symbol = p.symbol WHERE base_date = (SELECT max(base_date) FROM rankings) AND {valid()})
SELECT *, date_diff('day', latest_date, DATE '2001-11-04') AS stale_days, CASE WHEN latest_date = DATE '2001-11-04' AND ((kospi_price_based AND kospi_rows < 2) OR (kosdaq_price_based AND kosdaq_rows < 5)) THEN 'FAIL_STALE_KR_RANKING_PRESENT'
 WHEN latest_date = DATE '2001-11-04' AND (kospi_rows < 2 OR kosdaq_rows < 5) THEN 'OK_SKIPPED_INSUFFICIENT_PRICE_DATA' WHEN kosdaq_volume = 0 THEN 'FAIL_KOSDAQ_VOLUME_RANK' WHEN mismatch_rows > 0 THEN 'FAIL_RANKING_MARKET_MISMATCH'
 WHEN q_prefix_rows > 0 THEN 'FAIL_SYMBOL_NORMALIZATION' WHEN kospi_volume < 1 THEN 'WARN_KOSPI_VOLUME_SPARSE' ELSE 'SUCCESS' END AS status FROM a, v""", "latest_date")
def dq_ranking_source(L):
    return au.ranking_source(L.rankings, L.master, L.prices_raw, date(2001, 11, 4), 2, 5)


@query("dq_ranking_source_date", """
WITH r AS (SELECT *, coalesce(source_base_date, raw_price_date) AS e, market IN ('KOSPI', 'KOSDAQ') AS kr FROM rankings WHERE base_date = (SELECT max(base_date) FROM rankings)),
x AS (SELECT max(base_date) AS latest_date, count(*) FILTER (WHERE kr AND e <> base_date) AS kr_stale_ranking_rows, count(*) FILTER (WHERE kr AND source = 'VALID_PRICE_FALLBACK' AND e IS NULL) AS kr_missing_source_date_rows, count(*) FILTER (WHERE NOT kr AND e <> base_date) AS etf_etn_fallback_rows FROM r)
SELECT *, CASE WHEN kr_missing_source_date_rows > 0 THEN 'FAIL_RANKING_SOURCE_DATE_MISSING' WHEN kr_stale_ranking_rows > 0 THEN 'WARN_STALE_KR_STOCK_RANKING' ELSE 'SUCCESS' END AS status FROM x""", "latest_date")
def dq_ranking_source_date(L):
    return au.ranking_source_date(L.rankings)


_FLAGS = """coalesce(bool_or(source = 'KIS' AND rank_type = 'volume' AND market IN ('KOSPI', 'KOSDAQ')), false) AS kis_volume_ready, coalesce(bool_or(source = 'KIS' AND rank_type = 'trading_value' AND market IN ('KOSPI', 'KOSDAQ')), false) AS kis_trading_value_ready,
 coalesce(bool_or(source <> 'KIS' AND rank_type = 'trading_value' AND market IN ('KOSPI', 'KOSDAQ')), false) AS full_market_trading_value_ready, coalesce(bool_or(rank_type = 'market_cap' AND market IN ('KOSPI', 'KOSDAQ')), false) AS full_market_market_cap_ready"""


@query("dq_ranking_readiness", f"SELECT *, CASE WHEN kis_volume_ready THEN 'SUCCESS' ELSE 'FAIL_KIS_VOLUME_RANKING_NOT_READY' END AS status FROM (SELECT {_FLAGS} FROM rankings WHERE base_date = (SELECT max(base_date) FROM rankings))")
def dq_ranking_readiness(L):
    return au.ranking_readiness(L.rankings)


@query("dq_report_readiness", f"""WITH {_GOAL}, {_DAYC}, fl AS (SELECT {_FLAGS} FROM rankings, goal WHERE base_date = g),
x AS (SELECT *, coalesce((SELECT status LIKE 'SUCCESS%' OR status LIKE 'WARN_PARTIAL%' FROM run_logs WHERE job_name = 'daily_kis_universe_pipeline' AND target_date <= $T ORDER BY target_date DESC, run_id DESC LIMIT 1), false) AS universe_ready,
 (SELECT count(DISTINCT symbol) FROM prices WHERE base_date = $T AND source IN ('KIS_DETAIL', 'KIS') AND {valid()} AND symbol IN (SELECT symbol FROM static_universe WHERE enabled)) AS watchlist_covered,
 (SELECT count(DISTINCT {_Q}) FROM features WHERE base_date = $T AND symbol <> 'GLOBAL') AS feature_stock_symbols, kospi_valid >= 2 AND kosdaq_valid >= 5 AS full_market_price_ready FROM dayc, fl),
y AS (SELECT *, universe_ready AND kis_volume_ready AND watchlist_covered > 0 AND feature_stock_symbols > 0 AS universe_only_ready, etf_valid > 0 OR etn_valid > 0 AS etp, full_market_trading_value_ready AND full_market_price_ready AS tv, full_market_market_cap_ready AND full_market_price_ready AS mc FROM x)
SELECT full_market_price_ready, universe_ready, kis_volume_ready, watchlist_covered, feature_stock_symbols, universe_only_ready,
 concat_ws(',', 'macro', 'us_market', CASE WHEN kis_volume_ready THEN 'kis_volume_top' END, CASE WHEN universe_ready THEN 'watchlist_signal' END, CASE WHEN etp THEN 'etf_etn' END, CASE WHEN tv THEN 'kr_full_market_trading_value_top' END, CASE WHEN mc THEN 'kr_full_market_market_cap_top' END) AS allowed_sections,
 concat_ws(',', CASE WHEN NOT kis_volume_ready THEN 'kis_volume_top' END, CASE WHEN NOT universe_ready THEN 'watchlist_signal' END, CASE WHEN NOT etp THEN 'etf_etn' END, CASE WHEN NOT tv THEN 'kr_full_market_trading_value_top' END, CASE WHEN NOT mc THEN 'kr_full_market_market_cap_top' END) AS blocked_sections,
 CASE WHEN NOT kis_volume_ready AND NOT universe_ready THEN 'FAIL_REPORT_NOT_READY' WHEN universe_only_ready AND NOT full_market_price_ready THEN 'WARN_KIS_UNIVERSE_ONLY' WHEN NOT full_market_price_ready THEN 'WARN_KR_STOCK_PRICE_COVERAGE' ELSE 'SUCCESS' END AS status FROM y""")
def dq_report_readiness(L):
    return au.report_readiness(L.prices_raw, L.master, L.rankings, L.run_logs, L.static_universe, L.features, L.open_days, TARGET, 2, 5)


@query("dq_macro_snapshot", """
WITH x AS (SELECT base_date, copper AS us3y, (SELECT arg_max(value, base_date) FROM macro_series WHERE series_id = 'KR_GOVT_3Y' AND base_date <= $T) AS series_value FROM global_macro WHERE base_date = (SELECT max(base_date) FROM global_macro))
SELECT *, CASE WHEN series_value IS NULL THEN 'WARN_MACRO_DGS3_MISSING' WHEN us3y IS NULL THEN 'WARN_MACRO_US3Y_NULL' ELSE 'SUCCESS' END AS status FROM x""", "base_date", "us3y series_value")
def dq_macro_snapshot(L):
    return au.macro_snapshot(L.global_macro, L.macro_series, TARGET, "copper", "KR_GOVT_3Y")


@query("dq_calendar", """
WITH x AS (SELECT count(*) FILTER (WHERE exchange_code = 'XKRX' AND year(calendar_date) = 2001) AS xkrx_rows, count(*) FILTER (WHERE exchange_code = 'XKRX' AND year(calendar_date) = 2002) AS xkrx_next_rows,
 count(*) FILTER (WHERE exchange_code = 'XNYS' AND year(calendar_date) = 2001) AS xnys_rows, count(*) FILTER (WHERE exchange_code = 'XNYS' AND year(calendar_date) = 2002) AS xnys_next_rows, count(*) FILTER (WHERE exchange_code = 'XKRX' AND calendar_date = $T) AS xkrx_today_rows,
 count(*) FILTER (WHERE exchange_code = 'XKRX' AND is_open AND calendar_date BETWEEN $T - 30 AND $T) AS recent_30d_open_days, count(*) FILTER (WHERE exchange_code = 'XKRX' AND is_open AND calendar_date BETWEEN $T AND $T + 30) AS next_30d_open_days,
 count(*) FILTER (WHERE exchange_code = 'XKRX' AND year(calendar_date) = 2001 AND reason = 'holiday') AS xkrx_weekday_holidays, count(*) FILTER (WHERE exchange_code = 'XNYS' AND year(calendar_date) = 2001 AND reason = 'holiday') AS xnys_weekday_holidays,
 count(*) FILTER (WHERE source = 'manual_override' AND year(calendar_date) IN (2001, 2002)) AS manual_override_rows,
 count(*) FILTER (WHERE source = 'manual_override' AND calendar_date BETWEEN $T - 30 AND $T + 30) AS recent_override_rows, count(*) FILTER (WHERE exchange_code = 'XNYS' AND calendar_date = $T) AS xnys_today_rows,
""" + ", ".join(f"""max(calendar_date) FILTER (WHERE exchange_code = '{x}' AND is_open AND calendar_date < $T) AS {x.lower()}_previous, min(calendar_date) FILTER (WHERE exchange_code = '{x}' AND is_open AND calendar_date > $T) AS {x.lower()}_next,
 min(calendar_date) FILTER (WHERE exchange_code = '{x}' AND year(calendar_date) IN (2001, 2002)) AS {x.lower()}_first, max(calendar_date) FILTER (WHERE exchange_code = '{x}' AND year(calendar_date) IN (2001, 2002)) AS {x.lower()}_last""" for x in ("XKRX", "XNYS")) + """
 FROM calendar)
SELECT *, CASE WHEN xkrx_rows < 300 THEN 'WARN_MARKET_CALENDAR_INCOMPLETE' WHEN xkrx_next_rows < 300 THEN 'WARN_NEXT_YEAR_CALENDAR_INCOMPLETE' WHEN xnys_rows < 300 THEN 'WARN_MARKET_CALENDAR_MISSING_XNYS' WHEN xnys_next_rows < 300 THEN 'WARN_NEXT_YEAR_CALENDAR_INCOMPLETE_XNYS'
 WHEN xkrx_today_rows = 0 THEN 'WARN_TODAY_CALENDAR_MISSING' WHEN xkrx_next IS NULL THEN 'WARN_NEXT_TRADING_DAY_MISSING' ELSE 'SUCCESS' END AS status FROM x""", " ".join(f"{x}_{n}" for x in ("xkrx", "xnys") for n in ("previous", "next", "first", "last")))
def dq_calendar(L):
    return au.calendar_quality(L.calendar, TARGET)


@query("dq_closed_market_rows", """
WITH k AS (SELECT calendar_date AS d FROM calendar WHERE exchange_code = 'XKRX' AND NOT is_open AND calendar_date BETWEEN $T - 30 AND $T), u AS (SELECT calendar_date AS d FROM calendar WHERE exchange_code = 'XNYS' AND NOT is_open AND calendar_date BETWEEN $T - 30 AND $T),
x AS (SELECT (SELECT count(*) FROM calendar WHERE exchange_code = 'XKRX' AND calendar_date BETWEEN $T - 30 AND $T) AS xkrx_calendar_dates, (SELECT count(*) FROM calendar WHERE exchange_code = 'XNYS' AND calendar_date BETWEEN $T - 30 AND $T) AS xnys_calendar_dates,
 (SELECT count(*) FROM k) AS xkrx_closed_dates, (SELECT count(*) FROM u) AS xnys_closed_dates, (SELECT count(*) FROM rankings WHERE base_date IN (SELECT d FROM k)) AS krx_closed_date_ranking_rows,
 (SELECT count(*) FROM global_macro WHERE base_date IN (SELECT d FROM u) AND coalesce(gold, copper) IS NOT NULL) AS us_closed_date_rows)
SELECT *, CASE WHEN xkrx_calendar_dates = 0 THEN 'WARN_MARKET_CALENDAR_MISSING_XKRX' WHEN xnys_calendar_dates = 0 THEN 'WARN_MARKET_CALENDAR_MISSING_XNYS' WHEN krx_closed_date_ranking_rows > 0 THEN 'WARN_KRX_CLOSED_DATE_MARKET_ROWS' WHEN us_closed_date_rows > 0 THEN 'WARN_US_CLOSED_DATE_MARKET_ROWS' ELSE 'SUCCESS' END AS status FROM x""")
def dq_closed_market_rows(L):
    return au.closed_market_rows(L.rankings, L.global_macro, L.calendar, TARGET, ["gold", "copper"])


_REPORT_ROWS = """rr AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY symbol, base_date ORDER BY CASE source WHEN 'KIS_DETAIL' THEN 0 WHEN 'KIS' THEN 1 WHEN 'KRX' THEN 2 WHEN 'VALID_PRICE_FALLBACK' THEN 3 ELSE 4 END, available_at NULLS FIRST,
   trading_value DESC NULLS LAST, volume DESC NULLS LAST, close_price DESC NULLS LAST, market_cap DESC NULLS LAST, outstanding_shares DESC NULLS LAST) AS rn FROM prices) WHERE rn = 1)"""


@query("dq_invalid_prices", f"""WITH {_REPORT_ROWS},
s AS (SELECT *, base_date NOT IN (SELECT base_date FROM open_days) AS closed, coalesce(close_price, 0) <= 0 AS zero, coalesce(source, '') = '' AS bare FROM rr WHERE base_date BETWEEN $T - 180 AND $T AND symbol IN (SELECT symbol FROM master WHERE market IS NOT NULL)),
pd AS (SELECT calendar_date AS d, is_open, last_value(CASE WHEN is_open THEN calendar_date END IGNORE NULLS) OVER (ORDER BY calendar_date ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev FROM calendar WHERE exchange_code = 'XKRX'),
x AS (SELECT count(*) FILTER (WHERE closed) AS non_trading_day_price_rows, count(*) FILTER (WHERE zero) AS zero_close_rows, count(*) FILTER (WHERE bare) AS null_source_rows, count(*) FILTER (WHERE (closed OR zero OR bare) AND base_date >= $T - 30) AS recent_invalid_rows,
 count(*) FILTER (WHERE closed OR zero OR bare) AS invalid_rows, (SELECT count(*) FROM s a JOIN pd ON pd.d = a.base_date AND NOT pd.is_open JOIN s b ON b.symbol = a.symbol AND b.base_date = pd.prev WHERE a.close_price IS NOT DISTINCT FROM b.close_price AND a.volume IS NOT DISTINCT FROM b.volume
  AND a.trading_value IS NOT DISTINCT FROM b.trading_value) AS duplicate_weekend_carry_rows FROM s)
SELECT *, CASE WHEN recent_invalid_rows > 0 THEN 'FAIL_INVALID_PRICE_ROWS' WHEN invalid_rows > 0 THEN 'WARN_INVALID_PRICE_ROWS' ELSE 'SUCCESS' END AS status FROM x""")
def dq_invalid_prices(L):
    return au.invalid_prices(px.best_source(px.canonical(L.prices_raw), latest_first=False), L.master, L.calendar, TARGET)


@query("dq_feature_without_price", f"""
WITH d AS (SELECT DISTINCT symbol FROM prices WHERE base_date = $T AND source = 'KIS_DETAIL'), g AS (SELECT DISTINCT symbol FROM prices WHERE base_date = $T AND {valid()} AND ((SELECT count(*) FROM d) = 0 OR symbol IN (SELECT symbol FROM d))),
f AS (SELECT * FROM features WHERE base_date = $T), s AS (SELECT DISTINCT {_Q} AS symbol FROM f WHERE symbol <> 'GLOBAL'),
x AS (SELECT (SELECT count(*) FROM f) AS feature_total_rows, (SELECT count(*) FROM f WHERE symbol = 'GLOBAL') AS global_feature_rows, count(*) AS stock_feature_symbols, count(*) FILTER (WHERE symbol NOT IN (SELECT symbol FROM g)) AS without_price_count,
 (SELECT count(*) FROM g) AS detail_valid_price_rows FROM s)
SELECT *, CASE WHEN stock_feature_symbols = 0 OR without_price_count = 0 THEN 'SUCCESS' WHEN without_price_count < stock_feature_symbols THEN 'WARN_FEATURE_PARTIAL_PRICE_MATCH' ELSE 'WARN_FEATURE_WITHOUT_VALID_PRICE' END AS status FROM x""")
def dq_feature_without_price(L):
    return au.feature_without_price(L.features, L.prices_raw, TARGET)


@query("dq_features_without_price", f"""
WITH d AS (SELECT DISTINCT symbol FROM prices WHERE base_date = $T AND source = 'KIS_DETAIL'), g AS (SELECT DISTINCT symbol FROM prices WHERE base_date = $T AND {valid()} AND ((SELECT count(*) FROM d) = 0 OR symbol IN (SELECT symbol FROM d)))
SELECT DISTINCT {_Q} AS symbol FROM features WHERE base_date = $T AND symbol <> 'GLOBAL' AND {_Q} NOT IN (SELECT symbol FROM g)""")
def dq_features_without_price(L):
    return au.features_without_price(L.features, L.prices_raw, TARGET)


@query("dq_detail_universe_size", f"""WITH {_DETAIL}, x AS (SELECT (SELECT count(*) FROM static_universe WHERE enabled) AS static_enabled, (SELECT count(DISTINCT {_Q}) FROM rankings WHERE base_date = (SELECT max(base_date) FROM rankings)) AS ranking_symbols,
 (SELECT count(*) FROM master WHERE is_active) AS active_master, (SELECT count(*) FROM combined) AS detail_universe)
SELECT *, CASE WHEN detail_universe > 500 THEN 'FAIL_DETAIL_UNIVERSE_TOO_LARGE' WHEN active_master > 50 THEN 'WARN_MASTER_ACTIVE_TOO_BROAD' WHEN ranking_symbols = 0 THEN 'WARN_RANKING_UNIVERSE_EMPTY' ELSE 'SUCCESS' END AS status FROM x""")
def dq_detail_universe_size(L):
    return au.detail_universe_size(L.static_universe, L.rankings, L.master, combined(L), 500, 50)


def watch(L):
    return au.watchlist_symbols(L.static_universe, L.prices_raw, L.calendar, TARGET, DEMO_BOUNDS)


_W = "OVER (PARTITION BY symbol ORDER BY base_date"
_WATCH = f"""{_REPORT_ROWS}, wr AS (SELECT * FROM rr WHERE base_date BETWEEN $T - 90 AND $T AND symbol IN (SELECT symbol FROM static_universe)),
rej AS (SELECT symbol, count(*) FILTER (WHERE base_date NOT IN (SELECT base_date FROM open_days)) AS non_trading_rows, count(*) FILTER (WHERE coalesce(close_price, 0) <= 0) AS zero_close_rows, count(*) FILTER (WHERE coalesce(source, '') = '') AS null_source_rows FROM wr GROUP BY 1),
gd AS (SELECT *, close_price / lag(close_price, 5) {_W}) - 1 AS r5, close_price / lag(close_price, 20) {_W}) - 1 AS r20,
 (count(*) {_W} ROWS 5 PRECEDING) = 6 AND min(source) {_W} ROWS 5 PRECEDING) <> max(source) {_W} ROWS 5 PRECEDING)) OR (count(*) {_W} ROWS 20 PRECEDING) = 21 AND min(source) {_W} ROWS 20 PRECEDING) <> max(source) {_W} ROWS 20 PRECEDING)) AS mixed,
 median(close_price) {_W} ROWS BETWEEN 20 PRECEDING AND 1 PRECEDING) AS med, count(*) {_W} ROWS BETWEEN 20 PRECEDING AND 1 PRECEDING) AS h, count(*) OVER (PARTITION BY symbol) AS n, row_number() OVER (PARTITION BY symbol ORDER BY base_date DESC) AS back
 FROM wr WHERE {valid()} AND coalesce(source, '') <> '' AND base_date IN (SELECT base_date FROM open_days)),
wl AS (SELECT u.symbol, l.base_date AS latest_date, l.source, l.close_price, r5 AS return_5d, r20 AS return_20d, coalesce(mixed, false) AS source_mixed,
 concat_ws(',', CASE WHEN h >= 5 AND (close_price / med >= 1.8 OR close_price / med <= 0.55) THEN 'WARN_PRICE_JUMP_ANOMALY' END, CASE WHEN u.symbol BETWEEN '000001' AND '000005' AND NOT close_price BETWEEN 1000 AND 2500 THEN 'WARN_PRICE_SCALE_ANOMALY' END) AS price_scale_warning,
 CASE WHEN l.base_date IS NOT NULL THEN greatest((SELECT count(*) FROM open_days o WHERE o.base_date BETWEEN l.base_date AND $T) - 1, 0) END AS stale_days, coalesce(n, 0) AS valid_rows, coalesce(non_trading_rows, 0) AS non_trading_rows, coalesce(zero_close_rows, 0) AS zero_close_rows, coalesce(null_source_rows, 0) AS null_source_rows
 FROM static_universe u LEFT JOIN rej ON rej.symbol = u.symbol LEFT JOIN (SELECT * FROM gd WHERE back = 1) l ON l.symbol = u.symbol),
ws AS (SELECT *, CASE WHEN price_scale_warning <> '' THEN 'WARN_PRICE_SCALE_ANOMALY' WHEN source_mixed THEN 'WARN_FEATURE_SOURCE_MIXED' WHEN stale_days > 3 THEN 'WARN_REPORT_SOURCE_STALE' ELSE 'SUCCESS' END AS status FROM wl)"""


@query("dq_watchlist_symbol", f"WITH {_WATCH} SELECT * FROM ws", "latest_date", "return_5d return_20d")
def dq_watchlist_symbol(L):
    return watch(L)


@query("dq_feature_source", f"""WITH {_WATCH} SELECT w.symbol, f.a AS stored_return_5d, f.b AS stored_trading_value_ratio_20d, NOT source_mixed AS calculation_source_consistent, CASE WHEN source_mixed THEN 'WARN_FEATURE_SOURCE_MIXED' ELSE 'SUCCESS' END AS status
FROM ws w LEFT JOIN (SELECT {_Q} AS symbol, max(feature_value) FILTER (WHERE feature_name = 'return_5d') AS a, max(feature_value) FILTER (WHERE feature_name = 'trading_value_ratio_20d') AS b FROM features WHERE base_date = $T GROUP BY 1) f ON f.symbol = w.symbol""")
def dq_feature_source(L):
    return au.feature_source(watch(L), L.features, TARGET)


_ETFV = f"""el AS (SELECT symbol, max(base_date) AS d FROM panel WHERE base_date <= $T GROUP BY 1), ev AS (SELECT m.symbol, d AS latest_price_date, CASE WHEN d IS NOT NULL THEN greatest((SELECT count(*) FROM open_days o WHERE o.base_date BETWEEN d AND $T) - 1, 0) END AS stale_days
 FROM (SELECT * FROM master WHERE market = 'ETF') m LEFT JOIN el ON el.symbol = m.symbol)"""
_VIEWS = f"""{_REPORT_VIEW}, {_ETFV}, vx AS (SELECT (SELECT count(*) FROM wv) AS watchlist_rows, (SELECT count(*) FROM wv) AS active_rows, (SELECT count(*) FROM ev) AS etf_rows, (SELECT count(*) FROM wv WHERE data_status = 'STALE') AS stale_watchlist,
 (SELECT count(*) FROM ev WHERE stale_days > 3) AS stale_sector_etf, (SELECT count(*) FROM wv WHERE base_date > DATE '2001-06-28') + (SELECT count(*) FROM ev WHERE latest_price_date > DATE '2001-06-28') AS future_date_rows)"""


def views(L):
    return au.report_views(L.static_universe, report_rows(L), etf_view(L), date(2001, 6, 28))


@query("dq_report_views", f"WITH {_VIEWS} SELECT *, CASE WHEN future_date_rows > 0 THEN 'FAIL_REPORT_SOURCE_QUALITY' WHEN stale_watchlist > 0 OR stale_sector_etf > 0 THEN 'WARN_REPORT_SOURCE_STALE' ELSE 'SUCCESS' END AS status FROM vx")
def dq_report_views(L):
    return views(L)


@query("dq_report_source", f"""WITH {_WATCH}, {_VIEWS}, x AS (SELECT count(*) AS symbols_checked, count(*) FILTER (WHERE coalesce(stale_days, 0) > 3) AS stale_watch_symbols, count(*) FILTER (WHERE source_mixed) AS source_mixed_symbols,
 count(*) FILTER (WHERE price_scale_warning <> '') AS scale_warning_symbols FROM ws),
m AS (SELECT concat_ws(',', CASE WHEN NOT wti BETWEEN 20 AND 200 THEN 'wti' END, CASE WHEN NOT us10y BETWEEN 0 AND 10 THEN 'us10y' END) AS macro_suspicious FROM global_macro WHERE base_date = (SELECT max(base_date) FROM global_macro WHERE base_date <= $T))
SELECT x.*, stale_sector_etf, future_date_rows, macro_suspicious, CASE WHEN future_date_rows > 0 THEN 'FAIL_REPORT_SOURCE_QUALITY' WHEN source_mixed_symbols > 0 THEN 'WARN_FEATURE_SOURCE_MIXED' WHEN stale_watch_symbols > 0 OR stale_sector_etf > 0 THEN 'WARN_REPORT_SOURCE_STALE'
 WHEN macro_suspicious <> '' THEN 'WARN_PRICE_SCALE_ANOMALY' ELSE 'SUCCESS' END AS status FROM x, vx, m""")
def dq_report_source(L):
    return au.report_source(watch(L), views(L), scan.latest_row(L.global_macro, "base_date", TARGET), {"wti": "wti", "us10y": "us10y"})


_INTRA = """ia AS (SELECT *, CASE WHEN value - 20 <= 0 THEN 'INVALID' WHEN abs(change_rate) > 20 THEN 'ANOMALY' ELSE 'OK' END AS quality_flag, value - 20 AS raw_value FROM intraday),
il AS (SELECT series_id, arg_max(quality_flag, (observed_at, event_id)) AS q, arg_max(source, (observed_at, event_id)) AS s, arg_max(raw_value, (observed_at, event_id)) AS v FROM ia WHERE base_date = DATE '2024-01-20' GROUP BY 1)"""


def intraday_rows(L):
    from ..functions.sanity import classify_index_quality

    raw = c("value") - 20
    return L.intraday.select("*", classify_index_quality(raw, c("change_rate")).alias("quality_flag"), raw.alias("raw_value"))


@query("dq_intraday", f"""WITH {_INTRA}, x AS (SELECT max(observed_at) AS latest_observed_at, count(*) FILTER (WHERE quality_flag = 'INVALID') AS invalid_count, (SELECT q FROM il WHERE series_id = 'KOSPI') AS kospi_quality_flag, (SELECT q FROM il WHERE series_id = 'KOSDAQ') AS kosdaq_quality_flag,
 (SELECT q FROM il WHERE series_id = 'USDKRW') AS usdkrw_quality_flag, (SELECT s FROM il WHERE series_id = 'KOSPI') AS kospi_source, (SELECT v FROM il WHERE series_id = 'KOSPI') AS kospi_raw_value, floor((epoch(TIMESTAMP '2024-01-20 23:59:00') - floor(epoch(max(observed_at)))) / 60)::BIGINT AS stale_minutes
 FROM ia WHERE base_date = DATE '2024-01-20')
SELECT *, CASE WHEN usdkrw_quality_flag IS NULL THEN 'FAIL_MISSING_INTRADAY_FX' WHEN kospi_quality_flag = 'INVALID' AND kospi_source = 'KIS' AND kospi_raw_value > 0 THEN 'WARN_RECLASSIFY_NEEDED' WHEN kospi_quality_flag = 'INVALID' OR kosdaq_quality_flag = 'INVALID' THEN 'FAIL_INVALID_INTRADAY_MACRO'
 WHEN usdkrw_quality_flag = 'INVALID' THEN 'FAIL_INVALID_INTRADAY_FX' WHEN kospi_quality_flag = 'ANOMALY' THEN 'WARN_KOSPI_ANOMALY' WHEN stale_minutes > 90 THEN 'WARN_STALE_INTRADAY_MACRO' ELSE 'SUCCESS' END AS status FROM x""", "latest_observed_at", "kospi_raw_value")
def dq_intraday(L):
    return au.intraday(intraday_rows(L), date(2024, 1, 20), F.lit("2024-01-20 23:59:00").cast("timestamp"), F.lit(True))


@query("dq_macro_index_source", f"""WITH {_FX}, pair AS (SELECT base_date, index_name, max(value) FILTER (WHERE source = 'KIS') AS k, max(change_rate) FILTER (WHERE source = 'KIS') AS kc, max(value) FILTER (WHERE source = 'YAHOO') AS y FROM quotes GROUP BY 1, 2),
resolved AS (SELECT base_date, index_name, CASE WHEN k > 0 THEN k WHEN y > 0 THEN y END AS value, CASE WHEN k > 0 THEN 'KIS' WHEN y > 0 THEN 'YAHOO' ELSE 'UNKNOWN' END AS source,
 CASE WHEN k > 0 THEN CASE WHEN abs(kc) > 20 THEN 'ANOMALY' WHEN y > 0 AND abs(k / y - 1) * 100 > 10 THEN 'SOURCE_MISMATCH' ELSE 'OK' END WHEN y > 0 THEN 'FALLBACK_YAHOO' ELSE 'MISSING' END AS quality_flag FROM pair), {_IDXWIDE}
SELECT d.base_date, kospi_quality_flag, kospi_source, usdkrw_quality_flag, CASE WHEN kospi_quality_flag = 'FALLBACK_YAHOO' OR (kospi_source = 'YAHOO' AND kospi_quality_flag <> 'INVALID') THEN 'WARN_KOSPI_FALLBACK_YAHOO' WHEN kospi_quality_flag = 'ANOMALY' THEN 'WARN_KOSPI_ANOMALY'
 WHEN kospi_quality_flag = 'SOURCE_MISMATCH' THEN 'WARN_KOSPI_SOURCE_MISMATCH' WHEN usdkrw_quality_flag = 'STALE' THEN 'WARN_STALE_USDKRW' ELSE 'SUCCESS' END AS status
FROM days d LEFT JOIN idx i ON i.base_date = d.base_date LEFT JOIN fx f ON f.base_date = d.base_date""", "base_date")
def dq_macro_index_source(L):
    return au.macro_index_source(snapshot(L)).select("base_date", "kospi_quality_flag", "kospi_source", "usdkrw_quality_flag", "status")


@query("dq_run_quality", f"""
WITH x AS (SELECT base_date, count(DISTINCT symbol) AS total_symbols, count(DISTINCT CASE WHEN close_price IS NOT NULL AND volume > 0 AND trading_value > 0 THEN symbol END) AS price_success, count(DISTINCT CASE WHEN source IN ('KIS', 'KIS_DETAIL', 'KRX') THEN symbol END) AS supply_success,
 count(*) FILTER (WHERE {_SNAP}) AS snapshot_only_rows, count(*) FILTER (WHERE {valid()}) AS valid_price_rows FROM prices GROUP BY 1)
SELECT *, CASE WHEN snapshot_only_rows > 0 OR valid_price_rows = 0 OR price_success / total_symbols < 0.8 THEN 'FAIL' WHEN supply_success / total_symbols < 0.5 THEN 'WARN' ELSE 'SUCCESS' END AS status,
 concat_ws('; ', CASE WHEN snapshot_only_rows > 0 THEN 'snapshot_only_price_rows=' || snapshot_only_rows END, CASE WHEN valid_price_rows = 0 THEN 'valid_price_rows=0' END, CASE WHEN price_success / total_symbols < 0.8 THEN 'price coverage low: ' || price_success || '/' || total_symbols END,
  CASE WHEN price_success / total_symbols >= 0.8 AND supply_success / total_symbols < 0.5 THEN 'supply coverage low: ' || supply_success || '/' || total_symbols END) AS issues FROM x""", "base_date")
def dq_run_quality(L):
    each = px.canonical(L.prices_raw).groupBy("base_date", "symbol").agg(
        F.max(px.valid_row_lenient()).alias("priced"), F.max(F.coalesce(c("source").isin("KIS", "KIS_DETAIL", "KRX"), F.lit(False))).alias("flow"), F.count_if(px.snapshot_only()).alias("snap"), F.count_if(px.valid_row()).alias("ok"))
    days = each.groupBy("base_date").agg(
        F.count(F.lit(1)).alias("total_symbols"), F.count_if("priced").alias("price_success"), F.count_if("flow").alias("supply_success"), F.sum("snap").alias("snapshot_only_rows"), F.sum("ok").alias("valid_price_rows"))
    return au.run_quality(days)


@query("dq_job_status", """
WITH x AS (SELECT o_orderkey AS run_id, CASE o_orderpriority WHEN '1-URGENT' THEN 'listing' WHEN '2-HIGH' THEN 'detail' WHEN '3-MEDIUM' THEN 'central_bank' ELSE 'macro' END AS job, CASE WHEN o_custkey % 5 = 0 THEN 0 ELSE o_custkey * 3 END AS processed,
 CASE WHEN o_orderstatus = 'P' THEN 1 ELSE 0 END AS failures, CASE WHEN o_orderstatus = 'O' THEN 1 ELSE 0 END AS warnings, o_custkey AS universe, o_custkey // 4 AS valid FROM orders)
SELECT run_id, job, CASE WHEN job = 'listing' THEN CASE WHEN processed >= 2000 THEN 'SUCCESS' WHEN processed >= 100 THEN 'WARN_PARTIAL_STOCK_PRICE_ROWS' ELSE 'WARN_INSUFFICIENT_STOCK_PRICE_ROWS' END
 WHEN job = 'detail' THEN CASE WHEN failures > 0 AND processed = 0 THEN 'FAIL_KIS_UNIVERSE_EMPTY' WHEN failures > 0 OR valid < greatest(1, universe // 3) THEN 'WARN_PARTIAL_KIS_UNIVERSE_COVERAGE' ELSE 'SUCCESS' END
 WHEN job = 'central_bank' THEN CASE WHEN failures > 0 THEN 'WARN' WHEN processed > 0 THEN 'SUCCESS' WHEN warnings > 0 THEN 'WARN_NO_NEW_DATA' ELSE 'SUCCESS_WITH_NO_NEW_DATA' END
 ELSE CASE WHEN processed > 0 AND failures = 0 AND warnings = 0 THEN 'SUCCESS' ELSE 'WARN' END END AS status FROM x""")
def dq_job_status(L):
    job = F.when(c("o_orderpriority") == "1-URGENT", "listing").when(c("o_orderpriority") == "2-HIGH", "detail").when(c("o_orderpriority") == "3-MEDIUM", "central_bank").otherwise("macro")
    rows = L.table("orders").select(
        c("o_orderkey").alias("run_id"), job.alias("job"), F.when(c("o_custkey") % 5 == 0, 0).otherwise(c("o_custkey") * 3).alias("processed"), (c("o_orderstatus") == "P").cast("int").alias("failures"),
        (c("o_orderstatus") == "O").cast("int").alias("warnings"), c("o_custkey").alias("universe"), F.floor(c("o_custkey") / 4).alias("valid"))
    return au.job_status(rows).select("run_id", "job", "status")


@query("dq_zero_row_alarm", "SELECT d.calendar_date AS base_date, t.n AS table_name FROM (SELECT DISTINCT calendar_date FROM calendar) d CROSS JOIN (VALUES ('prices_raw'), ('supply'), ('macro_usdkrw'), ('features')) AS t(n) WHERE "
       + " AND ".join(f"NOT (t.n = '{n}' AND d.calendar_date IN (SELECT base_date FROM {s}))" for n, s in (("prices_raw", "prices_raw"), ("supply", "supply"), ("macro_usdkrw", "macro_series WHERE series_id = 'USDKRW'"), ("features", "features"))), "base_date")
def dq_zero_row_alarm(L):
    watched = {"prices_raw": L.prices_raw, "supply": L.supply, "macro_usdkrw": L.macro_series.where("series_id = 'USDKRW'"), "features": L.features}
    return au.zero_row_alarm({n: df.select("base_date") for n, df in watched.items()}, cal.spine(L.date_range, "base_date"))


_COVER = "cv AS (SELECT count(DISTINCT p.symbol) AS covered_symbols, count(DISTINCT p.symbol) FILTER (WHERE market = 'KOSPI') AS kospi_covered, count(DISTINCT p.symbol) FILTER (WHERE market = 'KOSDAQ') AS kosdaq_covered FROM prices p JOIN master m ON m.symbol = p.symbol AND market IN ('KOSPI', 'KOSDAQ') WHERE base_date = (SELECT max(base_date) FROM prices))"
_WCOV = "wc AS (SELECT d AS base_date, count(*) AS watchlist_symbols, count(p.symbol) AS watchlist_symbols_with_price FROM (SELECT max(base_date) AS d FROM prices) CROSS JOIN (SELECT symbol FROM static_universe WHERE enabled) u LEFT JOIN (SELECT DISTINCT symbol, base_date FROM prices) p ON p.symbol = u.symbol AND p.base_date = d GROUP BY 1)"


def readiness(L):
    prices = px.canonical(L.prices_raw)
    return au.consumer_readiness(agg.price_coverage(prices, L.master), jn.watchlist_coverage(L.static_universe, prices), 5)


@query("dq_consumer_readiness", f"WITH {_COVER}, {_WCOV} SELECT base_date, covered_symbols, kospi_covered, kosdaq_covered, watchlist_symbols, watchlist_symbols_with_price, watchlist_symbols > 0 AND watchlist_symbols_with_price > 0 AS minimum_report_ready, covered_symbols > 5 AS full_market_coverage_pass FROM cv, wc", "base_date")
def dq_consumer_readiness(L):
    return readiness(L)


@query("dq_macro_inspect", """
SELECT 'macro' AS slice, base_date::VARCHAR AS at, 'usdkrw' AS item, usdkrw AS value FROM global_macro WHERE base_date BETWEEN $T - 7 AND $T
UNION ALL SELECT 'series', base_date::VARCHAR, series_id, value FROM macro_series WHERE series_id IN ('USDKRW', 'DEXKOUS', 'KRW=X') AND base_date <= $T
UNION ALL SELECT 'intraday', observed_at::VARCHAR, series_id, value FROM intraday WHERE base_date BETWEEN DATE '2024-01-20' - 3 AND DATE '2024-01-20'
UNION ALL SELECT 'runs', target_date::VARCHAR, job_name, run_id::DOUBLE FROM run_logs WHERE job_name LIKE '%macro%'""".replace(" AS at,", " AS seen_at,"), rounds="value")
def dq_macro_inspect(L):
    shape = lambda df, name, at, item, value: df.select(F.lit(name).alias("slice"), text(at).alias("seen_at"), item.alias("item"), value.cast("double").alias("value"))
    wide = scan.date_range(L.global_macro, "base_date", date(2001, 6, 22), TARGET)
    series = L.macro_series.where(c("series_id").isin("USDKRW", "DEXKOUS", "KRW=X") & (c("base_date") <= F.lit(TARGET)))
    bars = scan.date_range(L.intraday, "base_date", date(2024, 1, 17), date(2024, 1, 20))
    runs = L.run_logs.where(c("job_name").contains("macro"))
    return agg.stack([
        shape(wide, "macro", "base_date", F.lit("usdkrw"), c("usdkrw")), shape(series, "series", "base_date", c("series_id"), c("value")),
        shape(bars, "intraday", "observed_at", c("series_id"), c("value")), shape(runs, "runs", "target_date", c("job_name"), c("run_id"))])
