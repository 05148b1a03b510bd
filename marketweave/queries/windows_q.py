"""Window columns, trading calendar and feature store."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame, Window, functions as F

from ..functions.sanity import price_scale_warning
from ..operators import calendar as cal, features as feat, prices as px, windows as win
from ..sources.landing import Landing
from .registry import TARGET, query

DEMO_BOUNDS = {f"{n:06d}": (1000, 2500) for n in range(1, 6)}


def panel(L: Landing) -> DataFrame:
    return px.clean_panel(L.prices_raw, L.open_days)


def joined(L: Landing) -> DataFrame:
    return px.with_flows(panel(L), L.supply)


_W = "OVER (PARTITION BY symbol ORDER BY base_date"


@query("win_return_n", f"""
SELECT symbol, base_date, close_price / lag(close_price, 5) {_W}) - 1 AS return_5d, close_price / lag(close_price, 20) {_W}) - 1 AS return_20d,
  close_price / lag(close_price, 60) {_W}) - 1 AS return_60d FROM panel""", "base_date", "return_5d return_20d return_60d")
def win_return_n(L):
    return panel(L).select("symbol", "base_date", *[win.return_n(n).alias(f"return_{n}d") for n in (5, 20, 60)])


@query("win_moving_avg", f"""
SELECT symbol, base_date, avg(close_price) {_W} ROWS 4 PRECEDING) AS moving_avg_5, avg(close_price) {_W} ROWS 19 PRECEDING) AS moving_avg_20
FROM panel""", "base_date", "moving_avg_5 moving_avg_20")
def win_moving_avg(L):
    return panel(L).select("symbol", "base_date", win.moving_avg(5).alias("moving_avg_5"), win.moving_avg(20).alias("moving_avg_20"))


@query("win_ratio_to_mean_20", f"""
SELECT symbol, base_date, CASE WHEN count(*) {_W} ROWS 19 PRECEDING) = 20 THEN trading_value / avg(trading_value) {_W} ROWS 19 PRECEDING) END AS ratio
FROM panel""", "base_date", "ratio")
def win_ratio_to_mean_20(L):
    return panel(L).select("symbol", "base_date", win.ratio_to_mean().alias("ratio"))


@query("win_volatility_20", f"""
SELECT symbol, base_date, CASE WHEN row_number() {_W}) = 1 THEN 0.0 ELSE stddev_samp(r) {_W} ROWS 19 PRECEDING) END AS volatility_20d
FROM (SELECT *, close_price / lag(close_price) {_W}) - 1 AS r FROM panel)""", "base_date", "volatility_20d")
def win_volatility_20(L):
    rows = panel(L).withColumn("return_1d", win.return_n(1))
    return rows.select("symbol", "base_date", win.volatility().alias("volatility_20d"))


@query("win_zscore_20", f"""
SELECT symbol, base_date, (foreign_net_buy - avg(foreign_net_buy) {_W} ROWS 19 PRECEDING)) / nullif(stddev_samp(foreign_net_buy) {_W} ROWS 19 PRECEDING), 0)
 AS foreign_flow_zscore FROM joined_panel""", "base_date", "foreign_flow_zscore")
def win_zscore_20(L):
    return joined(L).select("symbol", "base_date", win.zscore().alias("foreign_flow_zscore"))


@query("win_source_mixed", "SELECT symbol, base_date, " + ", ".join(
    f"count(*) {_W} ROWS {n} PRECEDING) = {n + 1} AND min(source) {_W} ROWS {n} PRECEDING) <> max(source) {_W} ROWS {n} PRECEDING) AS mixed_{n}"
    for n in (5, 20, 60)) + " FROM panel", "base_date")
def win_source_mixed(L):
    return panel(L).select("symbol", "base_date", *[win.source_mixed(n).alias(f"mixed_{n}") for n in (5, 20, 60)])


@query("win_price_jump", f"""
SELECT symbol, base_date, coalesce(n >= 5 AND (close_price / med >= 1.8 OR close_price / med <= 0.55), false) AS jump
FROM (SELECT *, median(close_price) {_W} ROWS BETWEEN 20 PRECEDING AND 1 PRECEDING) AS med, count(close_price) {_W} ROWS BETWEEN 20 PRECEDING AND 1 PRECEDING) AS n FROM panel)
""", "base_date")
def win_price_jump(L):
    return panel(L).select("symbol", "base_date", win.jump_warning().alias("jump"))


@query("price_scale_bounds", """
SELECT symbol, base_date, close_price, symbol BETWEEN '000001' AND '000005' AND NOT close_price BETWEEN 1000 AND 2500 AS out_of_scale FROM panel""", "base_date")
def price_scale_bounds(L):
    flag = price_scale_warning(F.col("symbol"), F.col("close_price"), DEMO_BOUNDS)
    return panel(L).select("symbol", "base_date", "close_price", flag.alias("out_of_scale"))


@query("win_source_priority_dedupe", "SELECT symbol, base_date, source, close_price, available_at FROM panel", "base_date available_at")
def win_source_priority_dedupe(L):
    return panel(L).select("symbol", "base_date", "source", "close_price", "available_at")


@query("win_source_priority_dedupe_report", """
SELECT symbol, base_date, source, close_price, trading_value, available_at FROM (SELECT *, row_number() OVER (PARTITION BY symbol, base_date ORDER BY
   CASE source WHEN 'KIS_DETAIL' THEN 0 WHEN 'KIS' THEN 1 WHEN 'KRX' THEN 2 WHEN 'VALID_PRICE_FALLBACK' THEN 3 ELSE 4 END, available_at NULLS FIRST,
   trading_value DESC NULLS LAST, volume DESC NULLS LAST, close_price DESC NULLS LAST, market_cap DESC NULLS LAST, outstanding_shares DESC NULLS LAST) AS rn
 FROM prices) WHERE rn = 1""", "base_date available_at")
def win_source_priority_dedupe_report(L):
    rows = px.best_source(px.canonical(L.prices_raw), latest_first=False)
    return rows.select("symbol", "base_date", "source", "close_price", "trading_value", "available_at")


@query("fill_forward_back", """
SELECT d.base_date, s.series_id, coalesce(last_value(value IGNORE NULLS) OVER w, first_value(value IGNORE NULLS) OVER (PARTITION BY s.series_id
    ORDER BY d.base_date ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS value
FROM (SELECT DISTINCT base_date FROM macro_series) d CROSS JOIN (SELECT DISTINCT series_id FROM macro_series) s
LEFT JOIN macro_series m ON m.base_date = d.base_date AND m.series_id = s.series_id
WINDOW w AS (PARTITION BY s.series_id ORDER BY d.base_date ROWS UNBOUNDED PRECEDING)""", "base_date", "value")
def fill_forward_back(L):
    names = {"gold": "KR_GOVT_10Y", "copper": "KR_GOVT_3Y", "wti": "KR_CORP_AA_3Y", "us10y": "KR_CORP_BBB_3Y", "usdkrw": "USDKRW"}
    renamed = L.global_macro.withColumnsRenamed(names)
    return feat.macro_long(renamed, causal=False).select("base_date", F.col("column_name").alias("series_id"), "value")


_FILLED = """filled AS (SELECT d.base_date, s.name, last_value(value IGNORE NULLS) OVER w AS value
FROM (SELECT DISTINCT base_date FROM macro_series) d CROSS JOIN (VALUES ('gold','KR_GOVT_10Y'),('copper','KR_GOVT_3Y'),('wti','KR_CORP_AA_3Y'),('us10y','KR_CORP_BBB_3Y'),('usdkrw','USDKRW')) AS s(name, series_id)
LEFT JOIN macro_series m ON m.base_date = d.base_date AND m.series_id = s.series_id
WINDOW w AS (PARTITION BY s.name ORDER BY d.base_date ROWS UNBOUNDED PRECEDING)),
wide_chg AS (SELECT *, value / nullif(lag(value) OVER p, 0) - 1 AS chg_1d, value / nullif(lag(value, 5) OVER p, 0) - 1 AS chg_5d FROM filled WINDOW p AS (PARTITION BY name ORDER BY base_date))"""
_SERIES = """series_chg AS (SELECT *, value / nullif(lag(value) OVER p, 0) - 1 AS chg_1d,
  CASE WHEN row_number() OVER p > 1 THEN value / nullif(first_value(value) OVER (PARTITION BY series_id ORDER BY base_date ROWS 5 PRECEDING), 0) - 1 END AS chg_5d
  FROM macro_series WINDOW p AS (PARTITION BY series_id ORDER BY base_date))"""


@query("win_lag_change_wide", f"WITH {_FILLED} SELECT name AS column_name, base_date, chg_1d, chg_5d FROM wide_chg", "base_date", "chg_1d chg_5d")
def win_lag_change_wide(L):
    return win.lag_change_wide(feat.macro_long(L.global_macro)).select("column_name", "base_date", "chg_1d", "chg_5d")


@query("win_lag_change_series", f"WITH {_SERIES} SELECT series_id, base_date, chg_1d, chg_5d FROM series_chg", "base_date", "chg_1d chg_5d")
def win_lag_change_series(L):
    return win.lag_change_series(L.macro_series).select("series_id", "base_date", "chg_1d", "chg_5d")


@query("win_rank_by_market", """
SELECT base_date, market, symbol, rank, trading_value FROM (SELECT p.base_date, m.market, p.symbol, p.trading_value,
   row_number() OVER (PARTITION BY p.base_date, m.market ORDER BY volume DESC, trading_value DESC, p.symbol) AS rank
 FROM panel p JOIN master m ON m.symbol = p.symbol WHERE m.market IS NOT NULL) WHERE rank <= CASE WHEN market IN ('KOSPI', 'KOSDAQ') THEN 30 ELSE 20 END""", "base_date")
def win_rank_by_market(L):
    rows = panel(L).join(L.master.select("symbol", "market"), "symbol").where(F.col("market").isNotNull())
    limits = {"KOSPI": 30, "KOSDAQ": 30, "ETF": 20, "ETN": 20}
    order = [F.desc("volume"), F.desc("trading_value"), F.col("symbol")]
    return win.rank_by(rows, ["base_date", "market"], order, limits).select("base_date", "market", "symbol", "rank", "trading_value")


@query("win_carry_forward_cap", f"""
SELECT symbol, base_date, last_value(market_cap IGNORE NULLS) {_W} ROWS UNBOUNDED PRECEDING) AS market_cap FROM panel""", "base_date", "market_cap")
def win_carry_forward_cap(L):
    carried = F.last("market_cap", ignorenulls=True).over(win.by_symbol().rowsBetween(Window.unboundedPreceding, 0))
    return panel(L).select("symbol", "base_date", carried.alias("market_cap"))


@query("win_latest_per_symbol", """
SELECT symbol, max(base_date) AS base_date, arg_max(close_price, base_date) AS close_price FROM panel
WHERE base_date BETWEEN $T - 10 AND $T GROUP BY symbol""", "base_date")
def win_latest_per_symbol(L):
    recent = panel(L).where(F.col("base_date").between(F.lit(TARGET - timedelta(days=10)), F.lit(TARGET)))
    return recent.groupBy("symbol").agg(F.max("base_date").alias("base_date"), F.max_by("close_price", "base_date").alias("close_price"))


@query("win_previous_bar_change", """
SELECT series_id, observed_at, value, (value / nullif(lag(value) OVER w, 0) - 1) * 100 AS change_rate FROM intraday
WINDOW w AS (PARTITION BY series_id ORDER BY observed_at, event_id)""", "observed_at", "change_rate")
def win_previous_bar_change(L):
    from ..functions.sanity import change_rate

    bars = L.intraday.select("series_id", "value", "observed_at", F.struct("observed_at", "event_id").alias("at"))
    rows = win.blocked_lag(bars, "series_id", "at", "value")
    return rows.select("series_id", "observed_at", "value", change_rate(F.col("value"), F.col("previous")).alias("change_rate"))


@query("resolve_effective_date", "SELECT max(base_date) AS effective_date FROM panel WHERE base_date <= DATE '2001-07-01'", "effective_date")
def resolve_effective_date(L):
    return px.effective_date(px.clean_rows(L.prices_raw, L.open_days), date(2001, 7, 1))


# ---- trading calendar -------------------------------------------------------


@query("calendar_build", "SELECT calendar_date, exchange_code, is_open, reason FROM built_calendar", "calendar_date")
def calendar_build(L):
    return cal.build(L.date_range, L.schedule, ["XKRX", "XNYS"]).select("calendar_date", "exchange_code", "is_open", "reason")


@query("calendar_apply_overrides", """
SELECT calendar_date, exchange_code, is_open, reason, source, CASE WHEN is_open THEN
  CASE exchange_code WHEN 'XKRX' THEN calendar_date::VARCHAR || ' 00:00:00' ELSE strftime(timezone('UTC', timezone('America/New_York', calendar_date::TIMESTAMP + INTERVAL 570 MINUTE)), '%Y-%m-%d %H:%M:%S') END END AS open_time
FROM calendar""", "calendar_date")
def calendar_apply_overrides(L):
    return L.calendar.select("calendar_date", "exchange_code", "is_open", "reason", "source", "open_time")


@query("calendar_summary", """
SELECT exchange_code, count(*) AS total_days, count(*) FILTER (WHERE is_open) AS open_days_n, count(*) FILTER (WHERE NOT is_open) AS closed_days,
 count(*) FILTER (WHERE reason = 'weekend') AS weekend_days, count(*) FILTER (WHERE reason = 'holiday') AS weekday_holidays,
 min(calendar_date) FILTER (WHERE is_open) AS first_open_day, max(calendar_date) FILTER (WHERE is_open) AS last_open_day,
 count(*) FILTER (WHERE source = 'manual_override') AS override_count,
 coalesce(string_agg(calendar_date::VARCHAR, ',' ORDER BY calendar_date) FILTER (WHERE source = 'manual_override'), '') AS override_dates
FROM calendar GROUP BY 1""", "first_open_day last_open_day")
def calendar_summary(L):
    return cal.summary(L.calendar).withColumnRenamed("open_days", "open_days_n")


_SHIP_DAYS = "(SELECT DISTINCT l_shipdate::DATE AS calendar_date FROM lineitem)"


def ship_days(L: Landing) -> DataFrame:
    """Dates of the fact table; some lie past the calendar's end and use the weekday fallback."""
    return L.table("lineitem").select(F.col("l_shipdate").cast("date").alias("calendar_date")).distinct()


_STATUS = f"""status AS (SELECT d.calendar_date, 'XKRX' AS exchange_code, coalesce(c.is_open, isodow(d.calendar_date) < 6) AS is_open,
 coalesce(c.reason, CASE WHEN isodow(d.calendar_date) < 6 THEN 'weekday_fallback_open' ELSE 'weekday_fallback_closed' END) AS reason, c.source,
 c.is_open IS NULL AS calendar_fallback_used FROM {_SHIP_DAYS} d LEFT JOIN calendar c ON c.calendar_date = d.calendar_date AND c.exchange_code = 'XKRX')"""


@query("calendar_diagnostic", f"WITH {_STATUS} SELECT * FROM status", "calendar_date")
def calendar_diagnostic(L):
    return cal.diagnostic(ship_days(L), L.calendar)


@query("calendar_gate", f"""WITH {_STATUS} SELECT calendar_date, exchange_code, NOT is_open AS skip, CASE WHEN calendar_fallback_used AND is_open THEN 'MARKET_OPEN'
 WHEN calendar_fallback_used THEN 'MARKET_CLOSED: XKRX ' || calendar_date::VARCHAR || ' weekday_fallback'
 WHEN is_open THEN 'MARKET_OPEN: XKRX ' || calendar_date::VARCHAR || ' ' || reason || ' source=' || source
 ELSE 'MARKET_CLOSED: XKRX ' || calendar_date::VARCHAR || ' ' || reason || ' source=' || source END AS gate_reason FROM status""", "calendar_date")
def calendar_gate(L):
    return cal.gate(cal.diagnostic(ship_days(L), L.calendar))


@query("calendar_prev_next", """
SELECT calendar_date, exchange_code, last_value(d IGNORE NULLS) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS previous_open_day,
 first_value(d IGNORE NULLS) OVER (w ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS next_open_day,
 last_value(d IGNORE NULLS) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS latest_open_day
FROM (SELECT *, CASE WHEN is_open THEN calendar_date END AS d FROM calendar) WINDOW w AS (PARTITION BY exchange_code ORDER BY calendar_date)""",
       "calendar_date previous_open_day next_open_day latest_open_day")
def calendar_prev_next(L):
    return cal.neighbours(L.calendar)


@query("calendar_between", """
SELECT calendar_date FROM calendar WHERE exchange_code = 'XKRX' AND is_open AND calendar_date BETWEEN DATE '2001-04-01' AND $T""", "calendar_date")
def calendar_between(L):
    return cal.between(L.calendar, date(2001, 4, 1), TARGET)


@query("trading_stale_days", """
SELECT s.symbol, s.latest_date, CASE WHEN latest_date > $T THEN -1 ELSE greatest((SELECT count(*) FROM open_days o WHERE o.base_date BETWEEN latest_date AND $T) - 1, 0) END AS stale_days
FROM (SELECT symbol, max(base_date) AS latest_date FROM panel GROUP BY 1) s""", "latest_date", ints="stale_days")
def trading_stale_days(L):
    latest = panel(L).groupBy("symbol").agg(F.max("base_date").alias("latest_date"))
    return cal.stale_days(latest, L.calendar, TARGET)


@query("calendar_last_n_window", """
SELECT min(base_date) AS start_date, max(base_date) AS end_date, count(*) AS n_days
FROM (SELECT base_date FROM open_days WHERE base_date <= $T ORDER BY base_date DESC LIMIT 60)""", "start_date end_date")
def calendar_last_n_window(L):
    return cal.last_n_window(L.calendar, TARGET, 60).withColumnRenamed("open_days", "n_days")


# ---- feature store ----------------------------------------------------------

_F90 = f"""f90 AS (SELECT * FROM joined_panel WHERE base_date BETWEEN $T - 90 AND $T),
uni AS (SELECT symbol FROM static_universe WHERE enabled UNION SELECT CASE WHEN symbol LIKE 'Q%' THEN substr(symbol, 2) ELSE symbol END FROM rankings
  WHERE source = 'KIS' AND base_date = (SELECT max(base_date) FROM rankings)),
w1 AS (SELECT *, close_price / lag(close_price) {_W}) - 1 AS r1 FROM f90),
w2 AS (SELECT *, """ + ", ".join(
    f"close_price / lag(close_price, {n}) {_W}) - 1 AS ret{n}, count(*) {_W} ROWS {n} PRECEDING) = {n + 1} AND min(source) {_W} ROWS {n} PRECEDING) <> max(source) {_W} ROWS {n} PRECEDING) AS mix{n}"
    for n in (5, 20, 60)) + f""",
  avg(close_price) {_W} ROWS 4 PRECEDING) AS ma5, avg(close_price) {_W} ROWS 19 PRECEDING) AS ma20,
  CASE WHEN count(*) {_W} ROWS 19 PRECEDING) = 20 THEN trading_value / avg(trading_value) {_W} ROWS 19 PRECEDING) END AS tvr,
  CASE WHEN row_number() {_W}) = 1 THEN 0.0 ELSE stddev_samp(r1) {_W} ROWS 19 PRECEDING) END AS vol20,
  (foreign_net_buy - avg(foreign_net_buy) {_W} ROWS 19 PRECEDING)) / nullif(stddev_samp(foreign_net_buy) {_W} ROWS 19 PRECEDING), 0) AS fz,
  median(close_price) {_W} ROWS BETWEEN 20 PRECEDING AND 1 PRECEDING) AS med, count(*) {_W} ROWS BETWEEN 20 PRECEDING AND 1 PRECEDING) AS hist FROM w1),
w3 AS (SELECT *, CASE WHEN hist >= 5 AND (close_price / med >= 1.8 OR close_price / med <= 0.55) THEN 'WARN_PRICE_JUMP_ANOMALY'
  WHEN symbol BETWEEN '000001' AND '000005' AND NOT close_price BETWEEN 1000 AND 2500 THEN 'WARN_PRICE_SCALE_ANOMALY' END AS warn
  FROM w2 WHERE symbol IN (SELECT symbol FROM uni) AND base_date = (SELECT max(base_date) FROM f90)),
long AS (SELECT symbol, base_date, warn, unnest(['close_price', 'return_5d', 'return_20d', 'return_60d', 'moving_avg_5', 'moving_avg_20', 'trading_value_ratio_20d', 'volatility_20d', 'foreign_flow_zscore', 'volume']) AS feature_name,
  unnest([close_price, CASE WHEN NOT mix5 THEN ret5 END, CASE WHEN NOT mix20 THEN ret20 END, CASE WHEN NOT mix60 THEN ret60 END, ma5, ma20, CASE WHEN NOT mix20 THEN tvr END, vol20, fz, volume]) AS feature_value FROM w3)"""


def stock_features(L: Landing) -> DataFrame:
    universe = feat.universe(L.static_universe, L.rankings)
    return feat.stock_features(L.prices_raw, L.supply, L.open_days, universe, TARGET, DEMO_BOUNDS)


@query("feat_price_panel", """
SELECT symbol, base_date, source, close_price, volume, trading_value, foreign_net_buy FROM joined_panel WHERE base_date BETWEEN $T - 90 AND $T""", "base_date")
def feat_price_panel(L):
    rows = feat.price_panel(L.prices_raw, L.supply, L.open_days, TARGET)
    return rows.select("symbol", "base_date", "source", "close_price", "volume", "trading_value", "foreign_net_buy")


@query("feat_stock", f"WITH {_F90} SELECT symbol, base_date, feature_name, feature_value FROM long WHERE feature_value IS NOT NULL", "base_date", "feature_value")
def feat_stock(L):
    return stock_features(L).select("symbol", "base_date", "feature_name", "feature_value")


@query("feat_mixed_nulling", f"""
SELECT symbol, base_date, CASE WHEN NOT (count(*) {_W} ROWS 5 PRECEDING) = 6 AND min(source) {_W} ROWS 5 PRECEDING) <> max(source) {_W} ROWS 5 PRECEDING))
   THEN close_price / lag(close_price, 5) {_W}) - 1 END AS return_5d,
  CASE WHEN NOT (count(*) {_W} ROWS 20 PRECEDING) = 21 AND min(source) {_W} ROWS 20 PRECEDING) <> max(source) {_W} ROWS 20 PRECEDING))
   THEN close_price / lag(close_price, 20) {_W}) - 1 END AS return_20d FROM panel""", "base_date", "return_5d return_20d")
def feat_mixed_nulling(L):
    rows = panel(L).withColumns({f"return_{n}d": win.return_n(n) for n in (5, 20, 60)} | {f"mixed_{n}": win.source_mixed(n) for n in (5, 20, 60)})
    rows = rows.withColumn("trading_value_ratio_20d", win.ratio_to_mean())
    return feat.null_mixed(rows).select("symbol", "base_date", "return_5d", "return_20d")


@query("feat_quality_flags", f"""WITH {_F90}
SELECT symbol, base_date, feature_name, CASE WHEN feature_name IN ('close_price', 'return_5d', 'return_20d', 'return_60d') THEN warn END AS data_quality_flag,
 CASE WHEN warn IS NOT NULL AND feature_name IN ('close_price', 'return_5d', 'return_20d', 'return_60d') THEN 'PRICE_SCALE_WARNING' END AS source_consistency_status
FROM long WHERE feature_value IS NOT NULL""", "base_date")
def feat_quality_flags(L):
    return stock_features(L).select("symbol", "base_date", "feature_name", "data_quality_flag", "source_consistency_status")


@query("feat_macro_ratio", f"""WITH {_FILLED}, byday AS (SELECT base_date, max(value) FILTER (WHERE name = 'gold') AS gold, max(value) FILTER (WHERE name = 'copper') AS copper,
 max(value) FILTER (WHERE name = 'wti') AS wti FROM filled GROUP BY 1)
SELECT 'GLOBAL' AS symbol, base_date, 'copper_gold_ratio' AS feature_name, copper / gold AS feature_value FROM byday WHERE copper / gold IS NOT NULL
UNION ALL SELECT 'GLOBAL', base_date, 'gold_oil_ratio', gold / wti FROM byday WHERE gold / wti IS NOT NULL""", "base_date", "feature_value")
def feat_macro_ratio(L):
    return feat.macro_ratios(L.global_macro)


_WIDE_ROWS = """SELECT 'GLOBAL' AS symbol, base_date, 'macro_' || name || '_1d_chg' AS feature_name, chg_1d AS feature_value FROM wide_chg WHERE chg_1d IS NOT NULL
UNION ALL SELECT 'GLOBAL', base_date, 'macro_' || name || '_5d_chg', chg_5d FROM wide_chg WHERE chg_5d IS NOT NULL"""
_SERIES_ROWS = """SELECT 'GLOBAL' AS symbol, base_date, 'macro_' || lower(series_id) || '_1d_chg' AS feature_name, chg_1d AS feature_value FROM series_chg WHERE chg_1d IS NOT NULL
UNION ALL SELECT 'GLOBAL', base_date, 'macro_' || lower(series_id) || '_5d_chg', chg_5d FROM series_chg WHERE chg_5d IS NOT NULL"""


@query("feat_macro_wide_change", f"WITH {_FILLED} {_WIDE_ROWS}", "base_date", "feature_value")
def feat_macro_wide_change(L):
    return feat.macro_wide_change(L.global_macro)


@query("feat_macro_series_change", f"WITH {_SERIES} {_SERIES_ROWS}", "base_date", "feature_value")
def feat_macro_series_change(L):
    return feat.macro_series_change(L.macro_series)


_LATEST = "(SELECT arg_max(value, base_date) FROM macro_series WHERE series_id = '{}' AND base_date <= $T)"


@query("feat_yield_spreads", " UNION ALL ".join(
    f"SELECT 'GLOBAL' AS symbol, $T AS base_date, '{n}' AS feature_name, {_LATEST.format(a)} - {_LATEST.format('KR_GOVT_3Y')} AS feature_value"
    for n, a in (("KR_YIELD_SPREAD_10Y_3Y", "KR_GOVT_10Y"), ("KR_CREDIT_SPREAD_AA_3Y", "KR_CORP_AA_3Y"), ("KR_CREDIT_SPREAD_BBB_3Y", "KR_CORP_BBB_3Y"))),
    "base_date", "feature_value")
def feat_yield_spreads(L):
    return feat.yield_spreads(L.macro_series, TARGET)


@query("feat_fx_rate_change", """
SELECT 'GLOBAL' AS symbol, base_date, 'USDKRW_1D_CHG_PCT' AS feature_name, v AS feature_value FROM (SELECT base_date,
 (value / nullif(lag(value) OVER (ORDER BY base_date), 0) - 1) * 100 AS v FROM macro_series WHERE series_id = 'USDKRW') WHERE v IS NOT NULL""", "base_date", "feature_value")
def feat_fx_rate_change(L):
    return feat.fx_rate_change(L.macro_series)


@query("feat_rate_bp_change", """
WITH r AS (SELECT base_date, (value - lag(value) OVER w) * 100 AS d1, (value - lag(value, 20) OVER w) * 100 AS d20 FROM macro_series
 WHERE series_id = 'KR_GOVT_10Y' WINDOW w AS (ORDER BY base_date))
SELECT 'GLOBAL' AS symbol, base_date, 'KR10Y_1D_CHG_BP' AS feature_name, d1 AS feature_value FROM r WHERE d1 IS NOT NULL
UNION ALL SELECT 'GLOBAL', base_date, 'KR10Y_20D_CHG_BP', d20 FROM r WHERE d20 IS NOT NULL""", "base_date", "feature_value")
def feat_rate_bp_change(L):
    return feat.rate_bp_change(L.macro_series)


@query("feat_us_curve_spread", """
SELECT base_date, us10y, copper AS us3y, us10y - copper AS spread, (us10y - copper) * 100 AS spread_bp FROM global_macro""", "base_date", "us10y us3y spread spread_bp")
def feat_us_curve_spread(L):
    spread = F.col("us10y") - F.col("us3y")
    rows = L.global_macro.select("base_date", "us10y", F.col("copper").alias("us3y"))
    return rows.select("*", spread.alias("spread"), (spread * 100).alias("spread_bp"))


@query("feat_universe", f"WITH {_F90} SELECT symbol FROM uni")
def feat_universe(L):
    return feat.universe(L.static_universe, L.rankings)


@query("feat_readiness_gate", """
WITH r AS (SELECT p.*, coalesce(close_price > 0 AND volume > 0 AND trading_value > 0, false) AS ok FROM prices_raw p WHERE base_date = $T),
c AS (SELECT (SELECT count(*) FROM r JOIN master m ON m.symbol = r.symbol WHERE ok AND m.market IN ('KOSPI', 'KOSDAQ')) AS valid_stock_rows,
 (SELECT count(DISTINCT symbol) FROM r WHERE source = 'KIS_DETAIL') AS detail_symbols,
 (SELECT count(*) FROM r WHERE ok AND symbol IN (SELECT symbol FROM r WHERE source = 'KIS_DETAIL')) AS detail_valid_rows)
SELECT *, CASE WHEN detail_symbols > 0 THEN greatest(10, detail_symbols // 5) ELSE 100 END AS minimum_required,
 CASE WHEN CASE WHEN detail_symbols > 0 THEN detail_valid_rows ELSE valid_stock_rows END >= CASE WHEN detail_symbols > 0 THEN greatest(10, detail_symbols // 5) ELSE 100 END
  THEN 'READY' ELSE 'SKIPPED_INSUFFICIENT_PRICE_DATA' END AS status FROM c""", ints="minimum_required")
def feat_readiness_gate(L):
    return feat.readiness_gate(L.prices_raw, L.master, TARGET)


# One date's macro features: everything is cut at the date first, so filling a head from later rows stays within the look-back.
_CUT = """day AS (SELECT max(base_date) AS d FROM f90), far AS (SELECT m.* FROM macro_series m, day WHERE m.base_date BETWEEN $T - 90 AND d), near AS (SELECT m.* FROM macro_series m, day WHERE m.base_date BETWEEN $T - 45 AND d),
cutf AS (SELECT t.base_date, s.name, coalesce(last_value(value IGNORE NULLS) OVER w, first_value(value IGNORE NULLS) OVER (PARTITION BY s.name ORDER BY t.base_date ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS value
 FROM (SELECT DISTINCT base_date FROM far) t CROSS JOIN (VALUES ('gold','KR_GOVT_10Y'),('copper','KR_GOVT_3Y'),('wti','KR_CORP_AA_3Y'),('us10y','KR_CORP_BBB_3Y'),('usdkrw','USDKRW')) AS s(name, series_id)
 LEFT JOIN far m ON m.base_date = t.base_date AND m.series_id = s.series_id WINDOW w AS (PARTITION BY s.name ORDER BY t.base_date ROWS UNBOUNDED PRECEDING)),
metal AS (SELECT max(value) FILTER (WHERE name = 'gold') AS gold, max(value) FILTER (WHERE name = 'copper') AS copper, max(value) FILTER (WHERE name = 'wti') AS wti FROM cutf, day WHERE base_date = d),
widec AS (SELECT *, value / nullif(lag(value) OVER p, 0) - 1 AS c1, value / nullif(lag(value, 5) OVER p, 0) - 1 AS c5 FROM cutf WINDOW p AS (PARTITION BY name ORDER BY base_date)),
serc AS (SELECT *, value / nullif(lag(value) OVER p, 0) - 1 AS c1, CASE WHEN row_number() OVER p > 1 THEN value / nullif(first_value(value) OVER (PARTITION BY series_id ORDER BY base_date ROWS 5 PRECEDING), 0) - 1 END AS c5,
 (value / nullif(lag(value) OVER p, 0) - 1) * 100 AS pct, (value - lag(value) OVER p) * 100 AS bp1, (value - lag(value, 20) OVER p) * 100 AS bp20 FROM near WINDOW p AS (PARTITION BY series_id ORDER BY base_date)),
last AS (SELECT series_id, arg_max(value, base_date) AS v FROM near GROUP BY 1),
y AS (SELECT max(v) FILTER (WHERE series_id = 'KR_GOVT_10Y') AS y10, max(v) FILTER (WHERE series_id = 'KR_GOVT_3Y') AS y3, max(v) FILTER (WHERE series_id = 'KR_CORP_AA_3Y') AS aa, max(v) FILTER (WHERE series_id = 'KR_CORP_BBB_3Y') AS bbb FROM last),
macro AS (SELECT 1 AS p, 'copper_gold_ratio' AS name, copper / gold AS v FROM metal UNION ALL SELECT 1, 'gold_oil_ratio', gold / wti FROM metal
 UNION ALL SELECT 2, 'macro_' || name || '_1d_chg', c1 FROM widec, day WHERE base_date = d UNION ALL SELECT 2, 'macro_' || name || '_5d_chg', c5 FROM widec, day WHERE base_date = d
 UNION ALL SELECT 3, 'macro_' || lower(series_id) || '_1d_chg', arg_max(c1, base_date) FILTER (WHERE c1 IS NOT NULL) FROM serc GROUP BY 2
 UNION ALL SELECT 3, 'macro_' || lower(series_id) || '_5d_chg', arg_max(c5, base_date) FILTER (WHERE c5 IS NOT NULL) FROM serc GROUP BY 2
 UNION ALL SELECT 4, 'KR_YIELD_SPREAD_10Y_3Y', y10 - y3 FROM y UNION ALL SELECT 4, 'KR_CREDIT_SPREAD_AA_3Y', aa - y3 FROM y UNION ALL SELECT 4, 'KR_CREDIT_SPREAD_BBB_3Y', bbb - y3 FROM y
 UNION ALL SELECT 5, 'USDKRW_1D_CHG_PCT', arg_max(pct, base_date) FILTER (WHERE pct IS NOT NULL) FROM serc WHERE series_id = 'USDKRW'
 UNION ALL SELECT 6, 'KR10Y_1D_CHG_BP', arg_max(bp1, base_date) FILTER (WHERE bp1 IS NOT NULL) FROM serc WHERE series_id = 'KR_GOVT_10Y'
 UNION ALL SELECT 6, 'KR10Y_20D_CHG_BP', arg_max(bp20, base_date) FILTER (WHERE bp20 IS NOT NULL) FROM serc WHERE series_id = 'KR_GOVT_10Y')"""


@query("union_features", f"""WITH {_F90}, {_CUT},
allf AS (SELECT 0 AS p, symbol, base_date, feature_name, feature_value, warn FROM long WHERE feature_value IS NOT NULL
 UNION ALL SELECT p, 'GLOBAL', d, name, v, NULL FROM macro, day WHERE v IS NOT NULL),
won AS (SELECT symbol, base_date, feature_name, arg_max(feature_value, p) AS feature_value, arg_max(coalesce(warn, ''), p) AS warn FROM allf GROUP BY 1, 2, 3)
SELECT symbol, base_date, feature_name, feature_value, base_date + INTERVAL 7 HOUR AS available_at,
 CASE WHEN warn <> '' AND feature_name IN ('close_price', 'return_5d', 'return_20d', 'return_60d') THEN warn END AS data_quality_flag,
 CASE WHEN warn <> '' AND feature_name IN ('close_price', 'return_5d', 'return_20d', 'return_60d') THEN 'PRICE_SCALE_WARNING' END AS source_consistency_status FROM won""", "base_date available_at", "feature_value")
def union_features(L):
    """The whole feature store of one date: stock features and every macro producer, with flags and availability."""
    day = feat.effective_day(L.prices_raw, L.open_days, TARGET).first()["effective_date"]
    stock = feat.stock_features(L.prices_raw, L.supply, L.open_days, feat.universe(L.static_universe, L.rankings), TARGET, DEMO_BOUNDS, day)
    return feat.union_features(stock, *feat.macro_features(L.global_macro, L.macro_series, TARGET, day))
