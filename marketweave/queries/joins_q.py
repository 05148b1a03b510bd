"""Joins and aggregations."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import functions as F

from ..functions.markets import STOCK_MARKETS
from ..functions.symbols import normalize_symbol
from ..operators import aggregates as agg, joins as jn, prices as px
from .registry import TARGET, query
from .views_sql import norm, valid
from .windows_q import panel


@query("join_prices_supply", "SELECT symbol, base_date, source, close_price, foreign_net_buy FROM joined_panel", "base_date")
def join_prices_supply(L):
    return px.with_flows(panel(L), L.supply).select("symbol", "base_date", "source", "close_price", "foreign_net_buy")


@query("join_master_broadcast", "SELECT p.symbol, base_date, close_price, market, asset_type, name FROM prices p JOIN master m ON m.symbol = p.symbol", "base_date")
def join_master_broadcast(L):
    return jn.with_master(L.prices_raw, L.master).select("symbol", "base_date", "close_price", "market", "asset_type", "name")


@query("join_stock_snapshot", """
SELECT p.symbol, m.name, m.market, p.base_date, p.close_price, p.volume, p.trading_value, s.foreign_net_buy, s.institutional_net_buy, s.foreign_holding_ratio, r.per, r.pbr, r.roe, r.debt_ratio
FROM panel p JOIN master m ON m.symbol = p.symbol AND m.market IN ('KOSPI', 'KOSDAQ') LEFT JOIN supply s ON s.symbol = p.symbol AND s.base_date = p.base_date
LEFT JOIN ratios r ON r.symbol = p.symbol AND r.base_date = p.base_date WHERE p.base_date = (SELECT max(base_date) FROM panel)""", "base_date")
def join_stock_snapshot(L):
    day = px.clean_rows(L.prices_raw, L.open_days).agg(F.max("base_date").alias("d"))
    return jn.stock_snapshot(panel(L), L.supply, L.ratios, L.master, list(STOCK_MARKETS), day).select(
        "symbol", "name", "market", "base_date", "close_price", "volume", "trading_value", "foreign_net_buy", "institutional_net_buy",
        "foreign_holding_ratio", "per", "pbr", "roe", "debt_ratio")


@query("join_latest_close_active", """
SELECT p.symbol, m.name, base_date, close_price, volume, trading_value FROM prices_raw p JOIN master m ON m.symbol = p.symbol AND is_active
WHERE base_date = (SELECT max(base_date) FROM prices_raw)""", "base_date")
def join_latest_close_active(L):
    return jn.latest_close_active(L.prices_raw, L.master)


@query("join_sample_status", """
WITH fin AS (SELECT symbol, base_date, val AS revenue, -vol AS operating_income, shares AS total_assets, p AS total_equity FROM day_bars WHERE dc <> 10)
SELECT u.symbol, m.name, m.market, m.asset_type, m.is_active, p.base_date AS price_date, p.close_price, p.volume, p.trading_value, p.market_cap, p.outstanding_shares,
 s.base_date AS supply_date, s.foreign_net_buy, s.institutional_net_buy, s.foreign_holding_ratio, h.base_date AS short_date, h.short_volume, h.short_value, h.short_ratio,
 f.base_date AS statement_date, f.revenue, f.operating_income, f.total_assets, f.total_equity, r.per, r.pbr, r.roe, r.debt_ratio
FROM static_universe u LEFT JOIN master m ON m.symbol = u.symbol
LEFT JOIN prices_raw p ON p.symbol = u.symbol AND p.base_date = (SELECT max(base_date) FROM prices_raw) AND p.close_price IS NOT NULL AND p.volume IS NOT NULL AND p.trading_value IS NOT NULL
LEFT JOIN supply s ON s.symbol = u.symbol AND s.base_date = (SELECT max(base_date) FROM supply) LEFT JOIN shorts h ON h.symbol = u.symbol AND h.base_date = (SELECT max(base_date) FROM shorts)
LEFT JOIN fin f ON f.symbol = u.symbol AND f.base_date = (SELECT max(base_date) FROM fin g WHERE g.symbol = u.symbol) LEFT JOIN ratios r ON r.symbol = u.symbol AND r.base_date = p.base_date""",
       "price_date supply_date short_date statement_date")
def join_sample_status(L):
    statements = L.day_bars.where("dc <> 10").select(
        "symbol", "base_date", F.col("val").alias("revenue"), (-F.col("vol")).alias("operating_income"), F.col("shares").alias("total_assets"), F.col("p").alias("total_equity"))
    return jn.sample_status(L.static_universe.select("symbol"), L.master, L.prices_raw, L.supply, L.shorts, statements, L.ratios)


@query("semi_static_active", "SELECT symbol, base_date, close_price FROM panel WHERE symbol IN (SELECT symbol FROM static_universe WHERE enabled)", "base_date")
def semi_static_active(L):
    return jn.enabled_members(panel(L), L.static_universe).select("symbol", "base_date", "close_price")


@query("anti_missing_symbols", """
SELECT 'prices' AS missing_in, symbol FROM static_universe WHERE enabled AND symbol NOT IN (SELECT symbol FROM prices_raw WHERE base_date = $T)
UNION ALL SELECT 'features', symbol FROM static_universe WHERE enabled AND symbol NOT IN (SELECT symbol FROM features WHERE base_date = $T)
UNION ALL SELECT 'rankings', symbol FROM static_universe WHERE enabled AND symbol NOT IN (SELECT symbol FROM rankings WHERE base_date = $T)""")
def anti_missing_symbols(L):
    day = F.col("base_date") == F.lit(TARGET)
    watch = L.static_universe.where("enabled")
    parts = {"prices": L.prices_raw, "features": L.features, "rankings": L.rankings}
    return agg.stack([jn.missing_from(watch, df.where(day)).select(F.lit(n).alias("missing_in"), "symbol") for n, df in parts.items()])


@query("anti_coverage_gap", """
SELECT symbol, name, market FROM master WHERE market IN ('KOSPI', 'KOSDAQ') AND symbol NOT IN (SELECT symbol FROM prices_raw WHERE base_date = (SELECT max(base_date) FROM prices_raw))""")
def anti_coverage_gap(L):
    return jn.coverage_gap(L.master, L.prices_raw, list(STOCK_MARKETS))


@query("cross_watchlist_latest", """
SELECT d AS base_date, count(*) AS watchlist_symbols, count(p.symbol) AS watchlist_symbols_with_price FROM (SELECT max(base_date) AS d FROM prices)
CROSS JOIN (SELECT symbol FROM static_universe WHERE enabled) u LEFT JOIN (SELECT DISTINCT symbol, base_date FROM prices) p ON p.symbol = u.symbol AND p.base_date = d GROUP BY 1""", "base_date")
def cross_watchlist_latest(L):
    return jn.watchlist_coverage(L.static_universe, px.canonical(L.prices_raw))


_ON_LATEST = "EXISTS (SELECT 1 FROM {t} WHERE base_date = (SELECT max(base_date) FROM {t}){more})"
_FIELDS = """EXISTS (SELECT 1 FROM prices_raw p JOIN supply s ON s.symbol = p.symbol AND s.base_date = p.base_date WHERE p.symbol = '{s}' AND p.base_date = (SELECT max(base_date) FROM prices_raw)
  AND market_cap IS NOT NULL AND outstanding_shares IS NOT NULL AND foreign_holding_ratio IS NOT NULL)"""


@query("exists_flags", f"""
WITH statements AS (SELECT symbol, base_date FROM day_bars WHERE dc <> 10), told AS (SELECT ts::DATE AS base_date, CASE WHEN event_type = 'click' THEN 'NaverNews' ELSE 'OpenDart' END AS source FROM events)
SELECT EXISTS (SELECT 1 FROM macro_series WHERE series_id = 'KR_GOVT_10Y') AS has_kr10y, EXISTS (SELECT 1 FROM macro_series WHERE series_id = 'KR_GOVT_10Y' AND base_date = $T) AS has_kr10y_on_target,
 {_ON_LATEST.format(t='global_macro', more=' AND gold IS NOT NULL')} AS wide_macro_has_kr10y, {_ON_LATEST.format(t='global_macro', more=' AND gold IS NOT NULL AND wti IS NOT NULL')} AS wide_macro_has_metals,
 {_ON_LATEST.format(t='supply', more=' AND foreign_net_buy IS NOT NULL AND institutional_net_buy IS NOT NULL')} AS has_market_flows,
 {_FIELDS.format(s='000001')} AS first_sample_has_snapshot_fields, {_FIELDS.format(s='000002')} AS second_sample_has_snapshot_fields,
 {_ON_LATEST.format(t='told', more=" AND source = 'OpenDart'")} AS has_disclosures, {_ON_LATEST.format(t='told', more=" AND source = 'NaverNews'")} AS has_news,
 {_ON_LATEST.format(t='day_bars', more='')} AS has_raw_rows, {_ON_LATEST.format(t='shorts', more='')} AS has_shorts, {_ON_LATEST.format(t='statements', more='')} AS has_statements, {_ON_LATEST.format(t='told', more='')} AS has_events""")
def exists_flags(L):
    told = L.table("events").select(F.col("ts").cast("date").alias("base_date"), F.when(F.col("event_type") == "click", "NaverNews").otherwise("OpenDart").alias("source"))
    return jn.exists_flags(L.spark, L.macro_series, L.global_macro, L.prices_raw, L.supply, L.shorts, L.day_bars, L.day_bars.where("dc <> 10"), told, TARGET, ("000001", "000002"))


@query("self_join_previous_open_day", f"""
WITH d AS (SELECT symbol, base_date, CASE WHEN count(*) > 1 THEN NULL ELSE 100.0::DOUBLE END AS close_price, 10 * count(*)::DOUBLE AS volume, 5::DOUBLE AS trading_value FROM prices GROUP BY 1, 2),
p AS (SELECT calendar_date, is_open, last_value(CASE WHEN is_open THEN calendar_date END IGNORE NULLS) OVER (ORDER BY calendar_date ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS previous_day
 FROM calendar WHERE exchange_code = 'XKRX')
SELECT d.symbol, d.base_date, p.previous_day, d.close_price, d.volume, d.trading_value FROM d JOIN p ON p.calendar_date = d.base_date AND NOT p.is_open
JOIN d AS e ON e.symbol = d.symbol AND e.base_date = p.previous_day WHERE d.close_price IS NOT DISTINCT FROM e.close_price AND d.volume IS NOT DISTINCT FROM e.volume
 AND d.trading_value IS NOT DISTINCT FROM e.trading_value""", "base_date previous_day")
def self_join_previous_open_day(L):
    n = F.count(F.lit(1))
    rows = px.canonical(L.prices_raw).groupBy("symbol", "base_date").agg(
        F.when(n <= 1, F.lit(100.0)).alias("close_price"), (n * 10).cast("double").alias("volume"), F.lit(5.0).alias("trading_value"))
    return jn.carried_rows(rows, L.calendar)


@query("join_calendar_closed", """
SELECT p.base_date, coalesce(CASE WHEN is_open THEN 'open' WHEN NOT is_open THEN 'closed' END, 'missing') AS day_status, count(*) AS n
FROM prices_raw p LEFT JOIN calendar c ON c.calendar_date = p.base_date AND exchange_code = 'XKRX' GROUP BY 1, 2""", "base_date")
def join_calendar_closed(L):
    return jn.calendar_status(L.prices_raw, L.calendar).groupBy("base_date", "day_status").agg(F.count(F.lit(1)).alias("n"))


@query("asof_point_in_time", """
SELECT symbol, max(base_date) AS known_date, arg_max(close_price, base_date) AS known_value FROM panel WHERE available_at <= $T + INTERVAL '7 hours 2 minutes' GROUP BY 1""", "known_date")
def asof_point_in_time(L):
    instant = F.lit(f"{TARGET} 07:02:00").cast("timestamp")
    return jn.known_at(panel(L), ["symbol"], instant, F.col("close_price"), F.col("base_date"))


@query("asof_many_decisions", """
SELECT d.event_id AS decision_id, d.series_id, d.observed_at AS decided_at, o.value AS known_value FROM (SELECT * FROM intraday WHERE source <> 'KIS') d
ASOF LEFT JOIN (SELECT series_id, observed_at, arg_max(value, event_id) AS value FROM intraday WHERE source = 'KIS' GROUP BY 1, 2) o ON o.series_id = d.series_id AND o.observed_at <= d.observed_at""", "decided_at")
def asof_many_decisions(L):
    rows = L.intraday.withColumnRenamed("observed_at", "at")
    seen = rows.where("source = 'KIS'").withColumnRenamed("event_id", "seq")
    asked = rows.where("source <> 'KIS'").withColumnRenamed("event_id", "decision_id")
    return jn.asof_many(seen, asked, "series_id").withColumnRenamed("at", "decided_at")


@query("update_from_join", """
SELECT coalesce(a.symbol, b.symbol) AS symbol, coalesce(a.base_date, b.base_date) AS base_date,
 CASE WHEN a.symbol IS NULL OR coalesce(b.market_cap > a.market_cap, false) THEN coalesce(b.market_cap, a.market_cap) ELSE coalesce(a.market_cap, b.market_cap) END AS market_cap,
 CASE WHEN a.symbol IS NULL OR coalesce(b.market_cap > a.market_cap, false) THEN coalesce(b.per, a.per) ELSE coalesce(a.per, b.per) END AS per
FROM (SELECT symbol, base_date, max(market_cap) AS market_cap, max(CASE WHEN source = 'KRX' THEN volume END) AS per FROM prices WHERE raw_symbol NOT LIKE 'Q%' GROUP BY 1, 2) a
FULL JOIN (SELECT symbol, base_date, max(market_cap) AS market_cap, max(volume) AS per FROM prices WHERE raw_symbol LIKE 'Q%' GROUP BY 1, 2) b ON b.symbol = a.symbol AND b.base_date = a.base_date""", "base_date")
def update_from_join(L):
    raw = L.prices_raw
    plain = raw.where(~F.col("symbol").startswith("Q")).groupBy("symbol", "base_date").agg(
        F.max("market_cap").alias("market_cap"), F.max(F.when(F.col("source") == "KRX", F.col("volume"))).alias("per"))
    other = px.canonical(raw.where(F.col("symbol").startswith("Q"))).groupBy("symbol", "base_date").agg(
        F.max("market_cap").alias("market_cap"), F.max("volume").alias("per"))
    better = F.col("new_market_cap") > F.col("market_cap")
    return jn.update_from(plain, other, ["symbol", "base_date"], ["market_cap", "per"], better)


@query("delete_using_join", """
SELECT r.base_date, r.market, rank_type, symbol, rank, metric_value FROM rankings r WHERE NOT EXISTS (SELECT 1 FROM master m WHERE m.symbol = r.symbol AND m.market <> r.market)
 AND base_date NOT IN (SELECT calendar_date FROM calendar WHERE exchange_code = 'XKRX' AND NOT is_open)""", "base_date")
def delete_using_join(L):
    listed = L.master.where("market is not null").select("symbol", F.col("market").alias("master_market"))
    closed = L.calendar.where("exchange_code = 'XKRX' and not is_open").select(F.col("calendar_date").alias("base_date"))
    kept = L.rankings.join(listed, "symbol", "left").where(F.col("master_market").isNull() | (F.col("master_market") == F.col("market")))
    return kept.join(F.broadcast(closed), "base_date", "left_anti").select("base_date", "market", "rank_type", "symbol", "rank", "metric_value")


# ---- aggregations -----------------------------------------------------------


@query("agg_counts_by_source", " UNION ALL ".join(
    f"SELECT '{t}' AS section, source, base_date, count(*) AS row_count FROM {t} WHERE base_date = (SELECT max(base_date) FROM {t}) GROUP BY 2, 3"
    for t in ("prices_raw", "rankings", "snapshots", "ratios")), "base_date")
def agg_counts_by_source(L):
    return agg.counts_by_source({"prices_raw": L.prices_raw, "rankings": L.rankings, "snapshots": L.snapshots, "ratios": L.ratios})


@query("agg_feature_summary", """
SELECT base_date, count(*) AS total_feature_rows, count(DISTINCT symbol) AS symbol_count, count(DISTINCT feature_name) AS feature_name_count FROM features
WHERE base_date = (SELECT max(base_date) FROM features) GROUP BY 1""", "base_date")
def agg_feature_summary(L):
    return agg.feature_summary(L.features)


@query("agg_market_counts", f"""
SELECT base_date, count(*) FILTER (WHERE market = 'KOSPI') AS kospi_rows, count(*) FILTER (WHERE market = 'KOSDAQ') AS kosdaq_rows, count(*) AS total_rows
FROM prices p JOIN master m ON m.symbol = p.symbol WHERE {valid()} AND market IN ('KOSPI', 'KOSDAQ') GROUP BY 1""", "base_date")
def agg_market_counts(L):
    return agg.market_counts(L.prices_raw, L.master)


@query("agg_series_stats", """
SELECT 'series' AS kind, series_id AS id, count(*) AS n, min(base_date) AS first_date, max(base_date) AS last_date FROM macro_series GROUP BY 2
UNION ALL SELECT 'symbol', symbol, count(*), min(base_date), max(base_date) FROM prices GROUP BY 2""", "first_date last_date")
def agg_series_stats(L):
    one = agg.series_stats(L.macro_series, "series_id").withColumnRenamed("series_id", "id")
    two = agg.series_stats(px.canonical(L.prices_raw), "symbol").withColumnRenamed("symbol", "id")
    return one.select(F.lit("series").alias("kind"), "*").unionByName(two.select(F.lit("symbol").alias("kind"), "*"))


@query("agg_pipeline_health", """
SELECT target_date, job_name, status, count(*) AS occurrences, max(records_processed) AS max_records_processed FROM run_logs
WHERE target_date BETWEEN $T - 7 AND $T GROUP BY 1, 2, 3""", "target_date")
def agg_pipeline_health(L):
    return agg.pipeline_health(L.run_logs, TARGET)


@query("latest_run_per_job", """
SELECT job_name, run_id, target_date, status, records_processed, error_message FROM (SELECT *, row_number() OVER (PARTITION BY job_name ORDER BY target_date DESC, run_id DESC) AS rn
 FROM run_logs) WHERE rn = 1""", "target_date")
def latest_run_per_job(L):
    return agg.latest_run(L.run_logs)


@query("agg_volume_rank_distribution", """
SELECT r.source, coalesce(m.market, 'UNKNOWN') AS master_market, coalesce(m.asset_type, 'UNKNOWN') AS asset_type, count(*) AS n
FROM (SELECT *, CASE WHEN symbol LIKE 'Q%' THEN substr(symbol, 2) ELSE symbol END AS s FROM rankings WHERE rank_type = 'volume') r LEFT JOIN master m ON m.symbol = r.s GROUP BY 1, 2, 3""")
def agg_volume_rank_distribution(L):
    return agg.rank_distribution(L.rankings.where("rank_type = 'volume'"), L.master, "source")


@query("agg_recent_runs", """
SELECT '[' || string_agg('{"target_date":"' || target_date::VARCHAR || '","run_id":' || run_id || ',"job_name":"' || job_name || '","status":"' || status || '","records_processed":' || records_processed || '}', ','
  ORDER BY target_date DESC, run_id DESC) || ']' AS recent_runs
FROM (SELECT * FROM run_logs WHERE job_name IN ('daily_stock_pipeline', 'daily_stock_full_price_pipeline') ORDER BY target_date DESC, run_id DESC LIMIT 10)""")
def agg_recent_runs(L):
    return agg.recent_runs_document(L.run_logs, ["daily_stock_pipeline", "daily_stock_full_price_pipeline"])


@query("agg_price_coverage", """
SELECT base_date, count(DISTINCT p.symbol) AS covered_symbols, count(DISTINCT p.symbol) FILTER (WHERE market = 'KOSPI') AS kospi_covered,
 count(DISTINCT p.symbol) FILTER (WHERE market = 'KOSDAQ') AS kosdaq_covered, count(*) FILTER (WHERE close_price IS NULL) AS null_close_rows, count(DISTINCT p.symbol) > 2000 AS full_market_coverage_pass
FROM prices_raw p JOIN master m ON m.symbol = p.symbol AND market IN ('KOSPI', 'KOSDAQ') WHERE base_date = (SELECT max(base_date) FROM prices_raw) GROUP BY 1""", "base_date")
def agg_price_coverage(L):
    return agg.price_coverage(L.prices_raw, L.master)


@query("agg_latest_rank_counts", """
SELECT base_date, market, rank_type, count(*) FILTER (WHERE source = 'KIS') AS KIS, count(*) FILTER (WHERE source = 'KIS_DETAIL') AS KIS_DETAIL, count(*) FILTER (WHERE source = 'KRX') AS KRX,
 count(*) FILTER (WHERE source = 'VALID_PRICE_FALLBACK') AS VALID_PRICE_FALLBACK, count(*) FILTER (WHERE coalesce(source, '') NOT IN ('KIS', 'KIS_DETAIL', 'KRX', 'VALID_PRICE_FALLBACK')) AS OTHER
FROM rankings WHERE base_date = (SELECT max(base_date) FROM rankings) GROUP BY 1, 2, 3""", "base_date")
def agg_latest_rank_counts(L):
    return agg.latest_rank_counts(L.rankings)


@query("agg_rank_market_crosstab", "SELECT r.market, " + ", ".join(
    f"count(*) FILTER (WHERE coalesce(m.market, 'UNKNOWN') = '{k}') AS {k}" for k in ("KOSPI", "KOSDAQ", "ETF", "ETN", "UNKNOWN"))
    + " FROM (SELECT *, CASE WHEN symbol LIKE 'Q%' THEN substr(symbol, 2) ELSE symbol END AS s FROM rankings) r JOIN master m ON m.symbol = r.s GROUP BY 1")
def agg_rank_market_crosstab(L):
    return agg.market_crosstab(L.rankings, L.master)


@query("agg_market_breadth", """
WITH w AS (SELECT *, lag(close_price) OVER (PARTITION BY symbol ORDER BY base_date) AS prev FROM panel WHERE base_date BETWEEN $T - 10 AND $T),
t AS (SELECT *, close_price - prev AS diff FROM w WHERE base_date = (SELECT max(base_date) FROM panel WHERE base_date <= $T) AND prev IS NOT NULL)
SELECT base_date, count(*) FILTER (WHERE diff > 0) AS advances, count(*) FILTER (WHERE diff < 0) AS declines, count(*) FILTER (WHERE diff = 0) AS unchanged,
 coalesce(sum(volume::BIGINT) FILTER (WHERE diff > 0), 0)::BIGINT AS advancing_volume, coalesce(sum(volume::BIGINT) FILTER (WHERE diff < 0), 0)::BIGINT AS declining_volume FROM t GROUP BY 1""", "base_date")
def agg_market_breadth(L):
    day = px.effective_date(px.clean_rows(L.prices_raw, L.open_days), TARGET).withColumnRenamed("effective_date", "base_date")
    return agg.market_breadth(panel(L), day, TARGET)


@query("agg_market_breadth_from_change", """
SELECT base_date, count(*) FILTER (WHERE disc_pct > 5) AS advances, count(*) FILTER (WHERE disc_pct < 5) AS declines, count(*) FILTER (WHERE disc_pct = 5) AS unchanged,
 coalesce(sum(qty) FILTER (WHERE disc_pct > 5), 0)::BIGINT AS advancing_volume, coalesce(sum(qty) FILTER (WHERE disc_pct < 5), 0)::BIGINT AS declining_volume
FROM lines WHERE l_returnflag IN ('A', 'R') GROUP BY 1""", "base_date")
def agg_market_breadth_from_change(L):
    lines = L._lines
    market = lambda flag: lines.where(F.col("l_returnflag") == flag).select(
        "base_date", (F.col("disc_pct") - 5).cast("double").alias("change_rate"), F.col("l_quantity").alias("volume"))
    return agg.market_breadth_from_change(market("A").unionByName(market("R")))


@query("agg_symbol_history_count", "SELECT symbol, count(*) AS n FROM prices_raw GROUP BY 1 HAVING count(*) < 20")
def agg_symbol_history_count(L):
    return agg.short_history(L.prices_raw)


_FEATS = ("close_price", "return_5d", "moving_avg_5", "moving_avg_20", "foreign_flow_zscore", "trading_value_ratio_20d", "volume")


@query("pivot_features", "SELECT symbol, base_date, " + ", ".join(f"max(feature_value) FILTER (WHERE feature_name = '{n}') AS {n}" for n in _FEATS) + " FROM features GROUP BY 1, 2", "base_date")
def pivot_features(L):
    return agg.pivot_features(L.features, ["symbol", "base_date"], list(_FEATS))
