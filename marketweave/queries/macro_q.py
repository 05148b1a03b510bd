"""Macro snapshot, signals and report tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import aggregates as agg, features as feat, joins as jn, macro as mc, signals as sg
from ..operators import calendar as cal, windows as win
from .rankings_q import _REPORT_VIEW, report_rows
from .registry import TARGET, query
from .windows_q import DEMO_BOUNDS, _F90, joined, panel

_INDEX = {"A": "kospi", "R": "kosdaq", "N": "usdkrw"}


def quotes(L):
    """Index and FX quotes of two sources per date, some invalid or off."""
    c = F.col
    name = F.lit(None).cast("string")
    for flag, index in _INDEX.items():
        name = F.when(c("l_returnflag") == flag, index).otherwise(name)
    mean = F.sum("cents").cast("double") / (F.count(F.lit(1)) * 100).cast("double")
    return L._lines.groupBy("base_date", name.alias("index_name"), F.when(c("l_linestatus") == "O", "KIS").otherwise("YAHOO").alias("source")).agg(
        F.when((F.min("disc_pct") == 0) & (F.max("tax_pct") == 8), 0.0).otherwise(mean).alias("value"),
        F.when(F.max("tax_pct") > 3, (F.max("disc_pct") - F.min("tax_pct") * 4).cast("double")).alias("change_rate"),
    )


_QUOTES = """quotes AS (SELECT base_date, CASE l_returnflag WHEN 'A' THEN 'kospi' WHEN 'R' THEN 'kosdaq' ELSE 'usdkrw' END AS index_name, CASE WHEN l_linestatus = 'O' THEN 'KIS' ELSE 'YAHOO' END AS source,
 CASE WHEN min(disc_pct) = 0 AND max(tax_pct) = 8 THEN 0.0 ELSE sum(cents)::DOUBLE / (count(*) * 100)::DOUBLE END AS value,
 CASE WHEN max(tax_pct) > 3 THEN (max(disc_pct) - min(tax_pct) * 4)::DOUBLE END AS change_rate FROM lines GROUP BY 1, 2, 3)"""
_RESOLVED = f"""{_QUOTES}, pair AS (SELECT base_date, index_name, max(value) FILTER (WHERE source = 'KIS') AS k, max(change_rate) FILTER (WHERE source = 'KIS') AS kc,
  max(value) FILTER (WHERE source = 'YAHOO') AS y, max(change_rate) FILTER (WHERE source = 'YAHOO') AS yc FROM quotes GROUP BY 1, 2),
resolved AS (SELECT base_date, index_name, CASE WHEN k > 0 THEN k WHEN y > 0 THEN y END AS value, CASE WHEN k > 0 THEN kc ELSE yc END AS change_rate, CASE WHEN k > 0 THEN 'KIS' WHEN y > 0 THEN 'YAHOO' ELSE 'UNKNOWN' END AS source,
 CASE WHEN k > 0 THEN CASE WHEN abs(kc) > 20 THEN 'ANOMALY' WHEN y > 0 AND abs(k / y - 1) * 100 > 10 THEN 'SOURCE_MISMATCH' ELSE 'OK' END WHEN y > 0 THEN 'FALLBACK_YAHOO' ELSE 'MISSING' END AS quality_flag FROM pair)"""


def indices(L):
    return mc.index_resolve(quotes(L).where("index_name <> 'usdkrw'"))


@query("macro_index_resolve", f"WITH {_RESOLVED} SELECT * FROM resolved WHERE index_name <> 'usdkrw'", "base_date", "value")
def macro_index_resolve(L):
    return indices(L)


def days(L):
    return cal.spine(L.date_range, "base_date")


def fx_quotes(L):
    return quotes(L).where("index_name = 'usdkrw' and source = 'YAHOO' and value > 0")


_DAYS = "days AS (SELECT DISTINCT calendar_date AS base_date FROM calendar)"


def _known(series: str) -> str:
    return f"""(SELECT d.base_date, last_value(m.value IGNORE NULLS) OVER w AS value, last_value(CASE WHEN m.value IS NOT NULL THEN d.base_date END IGNORE NULLS) OVER w AS known_date
 FROM days d LEFT JOIN (SELECT * FROM macro_series WHERE series_id = '{series}') m ON m.base_date = d.base_date WINDOW w AS (ORDER BY d.base_date ROWS UNBOUNDED PRECEDING))"""


_FX = f"""{_DAYS}, {_QUOTES}, fxq AS (SELECT base_date, value AS quote FROM quotes WHERE index_name = 'usdkrw' AND source = 'YAHOO' AND value > 0),
fx0 AS (SELECT k.*, q.quote, q.quote IS NOT NULL AND (k.value IS NULL OR k.base_date - k.known_date > 2) AS use_quote FROM {_known('USDKRW')} k LEFT JOIN fxq q ON q.base_date = k.base_date),
fx AS (SELECT base_date, CASE WHEN use_quote THEN quote ELSE value END AS usdkrw, CASE WHEN use_quote THEN 'YAHOO' WHEN value IS NOT NULL THEN 'ECOS' ELSE 'UNKNOWN' END AS usdkrw_source,
 CASE WHEN use_quote THEN base_date ELSE known_date END AS usdkrw_source_date, CASE WHEN use_quote THEN 'OK' WHEN value IS NULL THEN 'MISSING' WHEN base_date - known_date <= 2 THEN 'OK' ELSE 'STALE' END AS usdkrw_quality_flag FROM fx0)"""


def fx(L):
    return mc.fx_resolve(days(L), L.macro_series, fx_quotes(L))


@query("macro_fx_resolve", f"WITH {_FX} SELECT * FROM fx", "base_date usdkrw_source_date", "usdkrw")
def macro_fx_resolve(L):
    return fx(L)


_RATES = f"""rates AS (SELECT d.base_date, coalesce(a.value, b.value) AS kr10y, coalesce(g.gold, c.value) AS us10y, e.value AS us3y FROM days d JOIN {_known('KR_GOVT_10Y')} a ON a.base_date = d.base_date
 JOIN {_known('KR_GOVT_3Y')} b ON b.base_date = d.base_date JOIN {_known('KR_CORP_AA_3Y')} c ON c.base_date = d.base_date JOIN {_known('KR_CORP_BBB_3Y')} e ON e.base_date = d.base_date
 LEFT JOIN global_macro g ON g.base_date = d.base_date)"""


def rates(L):
    direct = L.global_macro.select("base_date", F.col("gold").alias("value"))
    return mc.rate_fallback(days(L), L.macro_series, direct, ("KR_GOVT_10Y", "KR_GOVT_3Y"), "KR_CORP_AA_3Y", "KR_CORP_BBB_3Y")


@query("macro_rate_fallback", f"WITH {_DAYS}, {_RATES} SELECT * FROM rates", "base_date", "kr10y us10y us3y")
def macro_rate_fallback(L):
    return rates(L)


@query("macro_carry_us_closed", """
WITH n AS (SELECT calendar_date, is_open, last_value(CASE WHEN is_open THEN calendar_date END IGNORE NULLS) OVER (ORDER BY calendar_date ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev
 FROM calendar WHERE exchange_code = 'XNYS')
SELECT g.base_date, CASE WHEN p.base_date IS NOT NULL THEN p.gold ELSE g.gold END AS sp500, CASE WHEN p.base_date IS NOT NULL THEN p.copper ELSE g.copper END AS vix, g.usdkrw,
 CASE WHEN p.base_date IS NOT NULL THEN p.base_date ELSE g.base_date END AS us_data_date
FROM global_macro g LEFT JOIN n ON n.calendar_date = g.base_date AND NOT n.is_open LEFT JOIN global_macro p ON p.base_date = n.prev""", "base_date us_data_date", "sp500 vix usdkrw")
def macro_carry_us_closed(L):
    wide = L.global_macro.select("base_date", F.col("gold").alias("sp500"), F.col("copper").alias("vix"), "usdkrw")
    return mc.carry_us_closed(wide, L.calendar).select("base_date", "sp500", "vix", "usdkrw", "us_data_date")


_IDXWIDE = """idx AS (SELECT base_date, max(value) FILTER (WHERE index_name = 'kospi') AS kospi, max(quality_flag) FILTER (WHERE index_name = 'kospi') AS kospi_quality_flag, max(source) FILTER (WHERE index_name = 'kospi') AS kospi_source,
 max(value) FILTER (WHERE index_name = 'kosdaq') AS kosdaq, max(quality_flag) FILTER (WHERE index_name = 'kosdaq') AS kosdaq_quality_flag, max(source) FILTER (WHERE index_name = 'kosdaq') AS kosdaq_source FROM resolved GROUP BY 1)"""


def flows(L):
    """Market flows per date: net quantities of the stock lines."""
    c = F.col
    market = F.when(c("l_returnflag") == "A", "KOSPI").when(c("l_returnflag") == "R", "KOSDAQ")
    signed = F.when(c("l_linestatus") == "O", c("qty")).otherwise(-c("qty"))
    return L._lines.where("l_returnflag in ('A', 'R')").groupBy("base_date", market.alias("market")).agg(F.sum(signed).alias("foreign_net_buy"))


@query("macro_quality_flag", """
WITH q AS (SELECT base_date, min(CASE WHEN l_returnflag = 'A' THEN disc_pct END) AS a, min(CASE WHEN l_returnflag = 'R' THEN disc_pct END) AS r FROM lines GROUP BY 1)
SELECT base_date, CASE WHEN coalesce(a = 0, false) OR coalesce(r = 0, false) THEN 'WARN_INVALID_INDEX' ELSE 'OK' END AS macro_quality_flag FROM q""", "base_date")
def macro_quality_flag(L):
    worst = lambda flag: F.min(F.when(F.col("l_returnflag") == flag, F.col("disc_pct")))
    rows = L._lines.groupBy("base_date").agg(worst("A").alias("a"), worst("R").alias("r"))
    invalid = lambda name: F.when(F.col(name) == 0, "INVALID").when(F.col(name) > 0, "OK")
    return rows.select("base_date", mc.quality_flag(invalid("a"), invalid("r")).alias("macro_quality_flag"))


@query("macro_series_fallback_report", """
WITH w AS (SELECT DISTINCT CASE o_orderpriority WHEN '1-URGENT' THEN 'DGS3' WHEN '2-HIGH' THEN 'DGS5' ELSE 'USDKRW' END AS series_id FROM orders),
s AS (SELECT CASE series_id WHEN 'KR_GOVT_10Y' THEN 'DGS3' ELSE series_id END AS series_id, base_date FROM macro_series WHERE series_id = 'USDKRW' OR base_date < DATE '2001-06-01')
SELECT w.series_id, 'NO_OBSERVATIONS' AS error_type, max(s.base_date) AS fallback_latest_date, CASE WHEN w.series_id IN ('DGS3', 'DGS10', 'DTWEXBGS', 'DEXKOUS') THEN 'HIGH' ELSE 'LOW' END AS report_impact
FROM w LEFT JOIN s ON s.series_id = w.series_id AND s.base_date <= $T GROUP BY 1 HAVING max(s.base_date) IS NULL OR max(s.base_date) < $T - 7""", "fallback_latest_date")
def macro_series_fallback_report(L):
    c = F.col("o_orderpriority")
    wanted = L.table("orders").select(F.when(c == "1-URGENT", "DGS3").when(c == "2-HIGH", "DGS5").otherwise("USDKRW").alias("series_id")).distinct()
    series = L.macro_series.where("series_id = 'USDKRW' or base_date < date'2001-06-01'").withColumn(
        "series_id", F.when(F.col("series_id") == "KR_GOVT_10Y", "DGS3").otherwise(F.col("series_id")))
    return mc.series_fallback_report(wanted, series, TARGET)


@query("macro_market_flow_pick", """
WITH f AS (SELECT CASE l_returnflag WHEN 'A' THEN 'KOSPI' ELSE 'KOSDAQ' END AS market, base_date, sum(CASE l_linestatus WHEN 'O' THEN qty ELSE -qty END)::BIGINT AS foreign_net_buy,
 date_diff('day', base_date, DATE '2001-12-31') AS pos FROM lines WHERE l_returnflag IN ('A', 'R') AND (l_returnflag = 'A' OR base_date <> $T) GROUP BY 1, 2)
SELECT market, base_date, foreign_net_buy FROM (SELECT *, row_number() OVER (PARTITION BY market ORDER BY base_date <> $T, pos) AS rn FROM f) WHERE rn = 1""", "base_date")
def macro_market_flow_pick(L):
    rows = flows(L).where((F.col("market") == "KOSPI") | (F.col("base_date") != F.lit(TARGET)))
    rows = rows.withColumn("pos", F.datediff(F.lit("2001-12-31").cast("date"), "base_date"))
    return mc.market_flow_pick(rows, TARGET, "pos", ["foreign_net_buy"])


def snapshot(L):
    return mc.snapshot(days(L), L.global_macro, indices(L), fx(L), rates(L), flows(L))


@query("macro_snapshot_build", f"""WITH {_FX}, {_RATES},
pair AS (SELECT base_date, index_name, max(value) FILTER (WHERE source = 'KIS') AS k, max(change_rate) FILTER (WHERE source = 'KIS') AS kc, max(value) FILTER (WHERE source = 'YAHOO') AS y FROM quotes GROUP BY 1, 2),
resolved AS (SELECT base_date, index_name, CASE WHEN k > 0 THEN k WHEN y > 0 THEN y END AS value, CASE WHEN k > 0 THEN 'KIS' WHEN y > 0 THEN 'YAHOO' ELSE 'UNKNOWN' END AS source,
 CASE WHEN k > 0 THEN CASE WHEN abs(kc) > 20 THEN 'ANOMALY' WHEN y > 0 AND abs(k / y - 1) * 100 > 10 THEN 'SOURCE_MISMATCH' ELSE 'OK' END WHEN y > 0 THEN 'FALLBACK_YAHOO' ELSE 'MISSING' END AS quality_flag FROM pair), {_IDXWIDE},
net AS (SELECT base_date, sum(CASE l_linestatus WHEN 'O' THEN qty ELSE -qty END) FILTER (WHERE l_returnflag = 'A')::BIGINT AS kospi_foreign_net_buy FROM lines GROUP BY 1)
SELECT d.base_date, g.gold, g.wti, i.kospi, kospi_source, kospi_quality_flag, i.kosdaq, kosdaq_quality_flag, f.usdkrw, usdkrw_source, usdkrw_quality_flag, r.kr10y, r.us10y, r.us3y, kospi_foreign_net_buy,
 CASE WHEN coalesce(kospi_quality_flag = 'INVALID', false) OR coalesce(kosdaq_quality_flag = 'INVALID', false) THEN 'WARN_INVALID_INDEX' ELSE 'OK' END AS macro_quality_flag
FROM days d LEFT JOIN global_macro g ON g.base_date = d.base_date LEFT JOIN idx i ON i.base_date = d.base_date LEFT JOIN fx f ON f.base_date = d.base_date LEFT JOIN rates r ON r.base_date = d.base_date
LEFT JOIN net n ON n.base_date = d.base_date""", "base_date", "gold wti kospi kosdaq usdkrw kr10y us10y us3y")
def macro_snapshot_build(L):
    return snapshot(L).select("base_date", "gold", "wti", "kospi", "kospi_source", "kospi_quality_flag", "kosdaq", "kosdaq_quality_flag", "usdkrw", "usdkrw_source", "usdkrw_quality_flag",
                              "kr10y", "us10y", "us3y", "kospi_foreign_net_buy", "macro_quality_flag")


# ---- signals and report -----------------------------------------------------

_WIDE = """wide AS (SELECT symbol, base_date, """ + ", ".join(f"max(feature_value) FILTER (WHERE feature_name = '{n}') AS {n}" for n in ("moving_avg_5", "moving_avg_20", "foreign_flow_zscore")) + """ FROM features GROUP BY 1, 2),
fxm AS (SELECT base_date, value / nullif(lag(value) OVER (ORDER BY base_date), 0) - 1 AS usdkrw_momentum FROM macro_series WHERE series_id = 'USDKRW'),
risk AS (SELECT base_date, -(value / nullif(lag(value) OVER (ORDER BY base_date), 0) - 1) AS risk_on_off_score FROM macro_series WHERE series_id = 'KR_CORP_BBB_3Y'),
inputs AS (SELECT w.*, usdkrw_momentum, risk_on_off_score, (b.dc - 5)::DOUBLE / 10 AS basis_signal, (b.tx - 4)::DOUBLE / 10 AS event_score FROM wide w LEFT JOIN fxm ON fxm.base_date = w.base_date
 LEFT JOIN risk ON risk.base_date = w.base_date LEFT JOIN day_bars b ON b.symbol = w.symbol AND b.base_date = w.base_date),
parts AS (SELECT *, CASE WHEN moving_avg_5 > moving_avg_20 THEN 0.8 WHEN moving_avg_5 <= moving_avg_20 THEN -0.5 ELSE 0 END::DOUBLE AS price,
 CASE WHEN foreign_flow_zscore - 1500 >= 1 THEN 0.9 WHEN foreign_flow_zscore - 1500 <= -1 THEN -0.9 ELSE 0 END::DOUBLE AS supply_part,
 CASE WHEN coalesce(usdkrw_momentum, 0) > 0.02 THEN -0.5 WHEN coalesce(risk_on_off_score, 0) > 0 THEN 0.5 ELSE 0 END::DOUBLE AS macro_part, coalesce(basis_signal, 0)::DOUBLE AS derivatives_part, coalesce(event_score, 0)::DOUBLE AS event_part FROM inputs),
scored AS (SELECT *, 0.3::DOUBLE * price + 0.25::DOUBLE * supply_part + 0.2::DOUBLE * macro_part + 0.15::DOUBLE * derivatives_part + 0.1::DOUBLE * event_part AS total_score FROM parts),
sig AS (SELECT *, CASE WHEN total_score > 0.5 THEN 'BUY' WHEN total_score < -0.2 THEN 'SELL' ELSE 'HOLD' END AS signal FROM scored)"""


def signal_inputs(L):
    """All seven inputs: stored features pivoted per symbol-day (the flow score centred for this data), the day's currency and credit moves, and the day bar's basis and event marks."""
    wide = agg.pivot_features(L.features, ["symbol", "base_date"], ["moving_avg_5", "moving_avg_20", "foreign_flow_zscore"])
    moves = win.lag_change_series(L.macro_series.where(F.col("series_id").isin("USDKRW", "KR_CORP_BBB_3Y"))).groupBy("base_date").agg(
        F.max(F.when(F.col("series_id") == "USDKRW", F.col("chg_1d"))).alias("usdkrw_momentum"), F.max(F.when(F.col("series_id") == "KR_CORP_BBB_3Y", -F.col("chg_1d"))).alias("risk_on_off_score"))
    marks = L.day_bars.select("symbol", "base_date", ((F.col("dc") - 5).cast("double") / 10).alias("basis_signal"), ((F.col("tx") - 4).cast("double") / 10).alias("event_score"))
    return wide.join(moves, "base_date", "left").join(marks, ["symbol", "base_date"], "left").withColumn("foreign_flow_zscore", F.col("foreign_flow_zscore") - 1500)


@query("signal_components", f"WITH {_WIDE} SELECT symbol, base_date, price, supply_part AS supply, macro_part AS macro, derivatives_part AS derivatives, event_part AS event FROM parts", "base_date")
def signal_components(L):
    return sg.components(signal_inputs(L)).select("symbol", "base_date", "price", "supply", "macro", "derivatives", "event")


def scored(L):
    return sg.score(sg.components(signal_inputs(L)))


@query("signal_score", f"WITH {_WIDE} SELECT symbol, base_date, total_score, signal FROM sig", "base_date", "total_score")
def signal_score(L):
    return scored(L).select("symbol", "base_date", "total_score", "signal")


@query("agg_buy_ratio", f"""WITH {_WIDE}, b AS (SELECT count(*) FILTER (WHERE signal = 'BUY') AS buy_count, count(*) AS total_count FROM sig)
SELECT *, buy_count * 100.0 / total_count AS buy_ratio, CASE WHEN buy_count * 100.0 / total_count >= 40 THEN 'RISK_ON' WHEN buy_count * 100.0 / total_count >= 20 THEN 'STOCK_PICKING' ELSE 'RISK_OFF' END AS stance FROM b""", rounds="buy_ratio")
def agg_buy_ratio(L):
    return agg.buy_ratio(scored(L))


def today(L):
    return scored(L).where(F.col("base_date") == F.lit(TARGET))


@query("report_market_summary", f"""WITH {_WIDE}, b AS (SELECT count(*) FILTER (WHERE signal = 'BUY') AS buy_count, count(*) AS total_count FROM sig WHERE base_date = $T),
m AS (SELECT base_date, usdkrw, us10y FROM global_macro WHERE base_date = (SELECT max(base_date) FROM global_macro WHERE base_date <= $T))
SELECT m.*, coalesce(buy_count * 100.0 / nullif(total_count, 0), 0) AS buy_ratio, CASE WHEN buy_count * 100.0 / nullif(total_count, 0) >= 40 THEN 'RISK_ON' WHEN buy_count * 100.0 / nullif(total_count, 0) >= 20 THEN 'STOCK_PICKING' ELSE 'RISK_OFF' END AS stance
FROM m, b""", "base_date", "usdkrw us10y buy_ratio")
def report_market_summary(L):
    newest = L.global_macro.where(F.col("base_date") <= F.lit(TARGET)).orderBy(F.desc("base_date")).limit(1)

    return jn.beside(newest, agg.buy_ratio(today(L))).select("base_date", "usdkrw", "us10y", "buy_ratio", "stance")


@query("report_top5", f"""WITH {_WIDE} SELECT s.symbol, coalesce(m.name, s.symbol) AS name, total_score, signal, coalesce(foreign_flow_zscore - 1500, 0) AS foreign_flow_zscore
FROM (SELECT * FROM sig WHERE base_date = $T ORDER BY total_score DESC, symbol LIMIT 5) s LEFT JOIN master m ON m.symbol = s.symbol""", rounds="total_score foreign_flow_zscore")
def report_top5(L):
    return sg.top5(today(L), L.master)


@query("report_focus_symbols", f"""WITH {_WIDE} SELECT u.symbol, signal, total_score,
 CASE WHEN signal IS NULL THEN 'insufficient data' WHEN coalesce(moving_avg_5, 0) > coalesce(moving_avg_20, 0) THEN 'short average above long (positive)' ELSE 'short average not above long (cautious)' END AS trend,
 CASE WHEN signal IS NULL THEN 'insufficient data' WHEN coalesce(foreign_flow_zscore - 1500, 0) > 0 THEN 'foreign buying ahead' ELSE 'foreign selling ahead' END AS flow,
 CASE WHEN signal IS NULL THEN 'insufficient data' WHEN signal = 'BUY' THEN 'raise the position' ELSE 'stay cautious' END AS comment
FROM static_universe u LEFT JOIN (SELECT * FROM sig WHERE base_date = $T) s ON s.symbol = u.symbol""", rounds="total_score")
def report_focus_symbols(L):
    return sg.focus(L.static_universe.select("symbol"), today(L))


@query("report_watchlist_view", f"WITH {_REPORT_VIEW} SELECT * FROM wv", "base_date")
def report_watchlist_view(L):
    return report_rows(L)


_W = "OVER (PARTITION BY symbol ORDER BY base_date"


def etf_view(L):
    rows = panel(L).withColumns({"return_5d": win.return_n(5), "return_20d": win.return_n(20), "trading_value_ratio_20d": win.ratio_to_mean()})
    return sg.sector_etf_view(L.master, rows, L.calendar, TARGET)


@query("report_sector_etf_view", f"""
WITH w AS (SELECT *, close_price / lag(close_price, 5) {_W}) - 1 AS return_5d, close_price / lag(close_price, 20) {_W}) - 1 AS return_20d,
  CASE WHEN count(*) {_W} ROWS 19 PRECEDING) = 20 THEN trading_value / avg(trading_value) {_W} ROWS 19 PRECEDING) END AS ratio FROM panel),
l AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY base_date DESC) AS rn FROM w WHERE base_date <= $T) WHERE rn = 1),
v AS (SELECT m.symbol, m.name, l.base_date AS latest_price_date, CASE WHEN l.base_date IS NOT NULL THEN greatest((SELECT count(*) FROM open_days o WHERE o.base_date BETWEEN l.base_date AND $T) - 1, 0) END AS stale_days,
 close_price, return_5d, return_20d, ratio AS trading_value_ratio_20d FROM (SELECT * FROM master WHERE market = 'ETF') m LEFT JOIN l ON l.symbol = m.symbol)
SELECT *, CASE WHEN stale_days IS NULL THEN 'MISSING' WHEN stale_days <= 0 THEN 'FRESH' WHEN stale_days <= 3 THEN 'STALE_BUT_USABLE' ELSE 'STALE' END AS data_status FROM v""",
       "latest_price_date", "return_5d return_20d trading_value_ratio_20d", "stale_days")
def report_sector_etf_view(L):
    return etf_view(L)
