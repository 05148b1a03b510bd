"""Table rewrites and stream jobs."""

from __future__ import annotations

import uuid
from datetime import date, timedelta

from pyspark.sql import functions as F, types as T

from ..operators import aggregates as agg, maintenance as mt, prices as px
from ..session import landing_dir, shared_dir
from ..sources.landing import SERIES_BY_EVENT, pick
from ..streaming import intraday as st
from .normalize_q import c
from .registry import TARGET, query
from .scalars_q import _NAMED, named

_KEYED = """keyed AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY symbol, base_date ORDER BY CASE source WHEN 'KIS_DETAIL' THEN 0 WHEN 'KIS' THEN 1 WHEN 'KRX' THEN 2 WHEN 'VALID_PRICE_FALLBACK' THEN 3 ELSE 4 END, available_at DESC NULLS LAST,
   trading_value DESC NULLS LAST, volume DESC NULLS LAST, close_price DESC NULLS LAST, market_cap DESC NULLS LAST, outstanding_shares DESC NULLS LAST) AS rn FROM prices_raw) WHERE rn = 1),
qr AS (SELECT *, substr(symbol, 2) AS cs FROM keyed WHERE symbol LIKE 'Q%'), cr AS (SELECT * FROM keyed WHERE symbol NOT LIKE 'Q%')"""


def keyed(L):
    """Stored prices, one row per spelling and day."""
    return px.best_source(L.prices_raw)


def _score(p: str) -> str:
    return f"(CASE WHEN {p}.close_price IS NOT NULL AND {p}.volume IS NOT NULL AND {p}.trading_value IS NOT NULL THEN 1e9 ELSE 0 END + coalesce({p}.trading_value, 0) + coalesce({p}.volume, 0) / 1e6)"


def _better(col: str) -> str:
    return f"CASE WHEN c.symbol IS NULL OR (q.symbol IS NOT NULL AND {_score('q')} > {_score('c')}) THEN q.{col} ELSE c.{col} END AS {col}"


def _filled(col: str) -> str:
    return f"CASE WHEN c.symbol IS NULL OR (q.symbol IS NOT NULL AND {_score('q')} > {_score('c')}) THEN coalesce(q.{col}, c.{col}) ELSE c.{col} END AS {col}"


@query("fix_canonical_prices", f"""WITH {_KEYED} SELECT coalesce(c.symbol, q.cs) AS symbol, coalesce(c.base_date, q.base_date) AS base_date, {_better('close_price')}, {_better('volume')}, {_better('trading_value')}, {_filled('market_cap')}, {_filled('outstanding_shares')}, {_filled('available_at')}
FROM cr c FULL JOIN qr q ON q.cs = c.symbol AND q.base_date = c.base_date""", "base_date available_at")
def fix_canonical_prices(L):
    return mt.canonical_prices(keyed(L)).select("symbol", "base_date", "close_price", "volume", "trading_value", "market_cap", "outstanding_shares", "available_at")


@query("fix_canonical_fill", f"""WITH {_KEYED} SELECT coalesce(c.symbol, q.cs) AS symbol, coalesce(c.base_date, q.base_date) AS base_date, coalesce(c.close_price, q.close_price) AS close_price, coalesce(c.market_cap, q.market_cap) AS market_cap, coalesce(c.source, q.source) AS source
FROM cr c FULL JOIN qr q ON q.cs = c.symbol AND q.base_date = c.base_date""", "base_date")
def fix_canonical_fill(L):
    return mt.canonical_fill(keyed(L), ["symbol", "base_date"], ["close_price", "market_cap", "source"])


@query("fix_canonical_raw", f"""WITH {_KEYED}, r AS (SELECT source, symbol, base_date, max(trading_value) AS trading_value FROM prices_raw WHERE source IS NOT NULL GROUP BY 1, 2, 3)
SELECT * FROM r WHERE symbol NOT LIKE 'Q%' UNION ALL SELECT source, substr(symbol, 2), base_date, trading_value FROM r WHERE symbol LIKE 'Q%' AND NOT EXISTS (SELECT 1 FROM r c WHERE c.source = r.source AND c.symbol = substr(r.symbol, 2) AND c.base_date = r.base_date)""", "base_date")
def fix_canonical_raw(L):
    raw = L.prices_raw.where("source is not null").groupBy("source", "symbol", "base_date").agg(F.max("trading_value").alias("trading_value"))
    return mt.canonical_raw(raw, ["source", "symbol", "base_date"])


@query("fix_ranking_market", "SELECT base_date, coalesce(m.market, r.market) AS market, rank_type, rank, r.symbol, source FROM rankings r LEFT JOIN master m ON m.symbol = r.symbol", "base_date")
def fix_ranking_market(L):
    return mt.ranking_market(L.rankings, L.master).select("base_date", "market", "rank_type", "rank", "symbol", "source")


@query("fix_legacy_rankings", """
SELECT base_date, r.market, rank_type, rank, r.symbol, source FROM rankings r LEFT JOIN master m ON m.symbol = r.symbol WHERE r.symbol NOT LIKE 'Q%' AND NOT (source = 'KIS' AND rank_type IN ('trading_value', 'market_cap')) AND NOT coalesce(m.market <> r.market, false)""", "base_date")
def fix_legacy_rankings(L):
    return mt.legacy_rankings(L.rankings, L.master).select("base_date", "market", "rank_type", "rank", "symbol", "source")


_FLAGGED = """fl AS (SELECT p.*, m.market IS NOT NULL AS listed, coalesce(close_price <= 0, true) AS zero, coalesce(p.source, '') = '' AS bare, coalesce(NOT c.is_open, false) AS closed, c.is_open IS NULL AS missing
 FROM prices_raw p LEFT JOIN master m ON m.symbol = p.symbol LEFT JOIN calendar c ON c.calendar_date = p.base_date AND c.exchange_code = 'XKRX')"""


@query("fix_invalid_prices", f"WITH {_FLAGGED} SELECT symbol, base_date, close_price, volume, source FROM fl WHERE NOT (listed AND (zero OR bare OR closed))", "base_date")
def fix_invalid_prices(L):
    return mt.invalid_prices(L.prices_raw, L.master, L.calendar).select("symbol", "base_date", "close_price", "volume", "source")


_COUNTS = "count(*) FILTER (WHERE zero) AS zero_or_null_close_rows, count(*) FILTER (WHERE bare) AS null_source_rows, count(*) FILTER (WHERE closed) AS confirmed_non_trading_day_rows, count(*) FILTER (WHERE missing) AS calendar_missing_rows"


@query("fix_invalid_prices_counts", f"WITH {_FLAGGED} SELECT 'before' AS phase, {_COUNTS} FROM fl WHERE listed UNION ALL SELECT 'after', {_COUNTS} FROM fl WHERE listed AND NOT (zero OR bare OR closed)")
def fix_invalid_prices_counts(L):
    return mt.invalid_price_counts(L.prices_raw, L.master, L.calendar)


@query("fix_snapshot_only", "SELECT symbol, base_date, close_price, volume, source FROM prices_raw WHERE NOT (open_price IS NULL AND high_price IS NULL AND low_price IS NULL AND close_price IS NULL AND volume IS NULL AND trading_value IS NULL)", "base_date")
def fix_snapshot_only(L):
    return mt.snapshot_only(L.prices_raw).select("symbol", "base_date", "close_price", "volume", "source")


@query("fix_calendar_period", """
WITH cal2 AS (SELECT calendar_date, exchange_code, is_open OR (exchange_code = 'XKRX' AND calendar_date = DATE '2001-06-16') AS is_open, CASE WHEN exchange_code = 'XKRX' AND calendar_date = DATE '2001-06-16' THEN 'manual_override' ELSE source END AS source FROM calendar),
bad AS (SELECT calendar_date AS d FROM cal2 WHERE exchange_code = 'XKRX' AND NOT is_open AND source <> 'manual_override' AND calendar_date >= $T - 60)
SELECT 'prices' AS table_name, base_date, count(*) AS n FROM prices_raw p LEFT JOIN master m ON m.symbol = p.symbol WHERE NOT (base_date = DATE '2001-06-16' AND m.market IS NOT NULL AND (coalesce(volume, 0) <= 0 OR coalesce(trading_value, 0) <= 0)) GROUP BY 2
UNION ALL SELECT 'features', base_date, count(*) FROM features WHERE base_date <> DATE '2001-06-16' GROUP BY 2
UNION ALL SELECT 'rankings', base_date, count(*) FROM rankings WHERE base_date NOT IN (SELECT d FROM bad) GROUP BY 2""", "base_date")
def fix_calendar_period(L):


    day = date(2001, 6, 16)
    calendar = mt.reopened_day(L.calendar, "XKRX", day)
    kept = {
        "prices": mt.drop_day_prices(L.prices_raw, L.master, day), "features": L.features.where(c("base_date") != F.lit(day)),
        "rankings": mt.closed_day_rankings(L.rankings, calendar, TARGET - timedelta(days=60)),
    }
    return agg.stack([df.groupBy("base_date").agg(F.count(F.lit(1)).alias("n")).select(F.lit(n).alias("table_name"), "base_date", "n") for n, df in kept.items()])


@query("fix_stale_fallback_rankings", """
SELECT base_date, market, rank_type, source, coalesce(source_base_date, raw_price_date) AS effective_source_base_date, count(*) AS row_count FROM rankings WHERE base_date = $T AND market IN ('KOSPI', 'KOSDAQ') AND source = 'VALID_PRICE_FALLBACK' GROUP BY 1, 2, 3, 4, 5""", "base_date effective_source_base_date")
def fix_stale_fallback_rankings(L):
    return mt.stale_fallback_report(L.rankings, TARGET)


@query("fix_stale_fallback_rankings_drop", "SELECT base_date, market, rank_type, symbol, rank, source FROM rankings WHERE NOT (base_date = $T AND market IN ('KOSPI', 'KOSDAQ') AND source = 'VALID_PRICE_FALLBACK')", "base_date")
def fix_stale_fallback_rankings_drop(L):
    return mt.drop_stale_fallback(L.rankings, TARGET).select("base_date", "market", "rank_type", "symbol", "rank", "source")


@query("fix_closed_market_rankings", """
SELECT base_date, market, rank_type, symbol, rank, source FROM rankings WHERE base_date NOT IN (SELECT calendar_date FROM calendar WHERE exchange_code = 'XKRX' AND NOT is_open AND source <> 'manual_override' AND calendar_date BETWEEN DATE '2000-01-01' AND $T)""", "base_date")
def fix_closed_market_rankings(L):
    return mt.closed_day_rankings(L.rankings, L.calendar, date(2000, 1, 1), TARGET).select("base_date", "market", "rank_type", "symbol", "rank", "source")


@query("fix_intraday_reclassify", """
WITH i AS (SELECT event_id, series_id, source, change_rate, CASE WHEN value > 600 THEN 'INVALID' ELSE 'OK' END AS quality_flag, CASE WHEN value <= 600 THEN value END AS value, CASE WHEN event_id % 3 > 0 THEN value - 700 END AS raw FROM intraday),
h AS (SELECT *, coalesce(series_id = 'KOSPI' AND source = 'KIS' AND quality_flag = 'INVALID' AND raw > 0 AND abs(coalesce(change_rate, 0)) <= 20, false) AS hit FROM i)
SELECT event_id, CASE WHEN hit THEN raw ELSE value END AS value, CASE WHEN hit THEN 'OK' ELSE quality_flag END AS quality_flag, CASE WHEN hit THEN CASE WHEN change_rate IS NULL THEN 'INVALID_RANGE_RULE_NO_CHANGE_RATE' ELSE 'INVALID_RANGE_RULE' END END AS reclassified_from,
 raw IS NOT NULL AND NOT hit AS has_raw_value FROM h""", rounds="value")
def fix_intraday_reclassify(L):
    raw = F.when(c("event_id") % 3 > 0, c("value") - 700)
    rows = L.intraday.select(
        "event_id", "series_id", "source", "change_rate", F.when(c("value") > 600, "INVALID").otherwise("OK").alias("quality_flag"),
        F.to_json(F.struct(raw.alias("raw_value"), F.lit(1.5).alias("yahoo_fallback_val"))).alias("quality_detail"), F.when(c("value") <= 600, c("value")).alias("value"))
    out = mt.reclassify_intraday(rows)
    return out.select("event_id", "value", "quality_flag", F.get_json_object("quality_detail", "$.reclassified_from").alias("reclassified_from"), F.get_json_object("quality_detail", "$.raw_value").isNotNull().alias("has_raw_value"))


@query("fix_asset_type", f"""WITH {_NAMED}, t AS (SELECT s_suppkey, name, market, CASE WHEN upper(coalesce(other_market, '')) = 'ETF' OR upper(name) LIKE '%ETF%' OR regexp_matches(upper(name), '^(KODEX|TIGER|RISE|ACE|PLUS|SOL|HANARO|KOSEF|TIMEFOLIO)') THEN 'ETF'
 WHEN upper(coalesce(other_market, '')) = 'ETN' OR upper(name) LIKE '%ETN%' THEN 'ETN' ELSE 'STOCK' END AS asset_type, other_market FROM named)
SELECT s_suppkey, asset_type, CASE WHEN asset_type IN ('ETF', 'ETN') THEN asset_type ELSE other_market END AS market FROM t""")
def fix_asset_type(L):
    rows = named(L).select("s_suppkey", "name", c("other_market").alias("market"), F.when(c("s_suppkey") % 2 == 0, "STOCK").alias("asset_type"))
    return mt.asset_type(rows).select("s_suppkey", "asset_type", "market")


# ---- streams ----------------------------------------------------------------

EVENTS = T.StructType([
    T.StructField("event_id", T.LongType()), T.StructField("ts", T.TimestampNTZType()), T.StructField("user_id", T.LongType()),
    T.StructField("event_type", T.StringType()), T.StructField("value", T.DoubleType()), T.StructField("props", T.StringType()),
])


def event_stream(L):
    return st.read_files(L.spark, L.folder, "events.parquet", EVENTS)


def bar_stream(L):
    """The intraday bars of ``Landing.intraday`` as a stream."""
    code = F.get_json_object("props", "$.k").cast("int")
    return event_stream(L).select(
        c("ts").cast("timestamp").alias("observed_at"), pick(c("event_type"), SERIES_BY_EVENT).alias("series_id"), (c("value") * 10).alias("value"),
        F.when(code > 20, (code - 50).cast("double") / F.lit(2.0)).alias("change_rate"), F.when(code < 60, "KIS").when(code < 80, "YAHOO").otherwise("FALLBACK_DAILY").alias("source"), c("event_id").alias("seq"))


_BOUND = """(value <= 0 OR NOT value BETWEEN CASE series_id WHEN 'KOSPI' THEN 100 WHEN 'KOSDAQ' THEN 50 WHEN 'USDKRW' THEN 500 WHEN 'VIX' THEN 1 WHEN 'WTI' THEN 5 END
 AND CASE series_id WHEN 'KOSPI' THEN 100000 WHEN 'KOSDAQ' THEN 50000 WHEN 'USDKRW' THEN 5000 WHEN 'VIX' THEN 500 WHEN 'WTI' THEN 1000 END)"""


# The rule of a record, stated on the last value (v) and change (c) of the broker (k), Yahoo (y) and the daily source (d).
_RECORD = f"""p AS (SELECT *, CASE WHEN k.v IS NOT NULL THEN 'KIS' WHEN y.v IS NOT NULL THEN 'YAHOO' ELSE 'FALLBACK_DAILY' END AS source, coalesce(k.v, y.v, d.v) AS value,
  CASE WHEN k.v IS NOT NULL THEN k.c WHEN y.v IS NOT NULL THEN y.c ELSE d.c END AS change, CASE WHEN k.v IS NOT NULL THEN coalesce(y.v, d.v) END AS other FROM last),
rec AS (SELECT *, {_BOUND} AS bad, CASE WHEN abs(change) > 20 THEN 'ANOMALY' WHEN other > 0 AND abs(value / other - 1) * 100 > 10 THEN 'SOURCE_MISMATCH' ELSE 'OK' END AS judged FROM p),
flagged AS (SELECT *, CASE WHEN bad THEN 'INVALID' WHEN source = 'KIS' THEN judged WHEN source = 'FALLBACK_DAILY' THEN 'FALLBACK_DAILY' WHEN series_id IN ('KOSPI', 'KOSDAQ') THEN 'FALLBACK_YAHOO' ELSE judged END AS quality_flag FROM rec)"""
_LASTS = ", ".join(f"arg_max({{'v': value, 'c': change_rate}}, %s) FILTER (WHERE source = '{s}') AS {n}" for s, n in (("KIS", "k"), ("YAHOO", "y"), ("FALLBACK_DAILY", "d")))
_SHOWN = "source, CASE WHEN NOT bad THEN value END AS value, CASE WHEN NOT bad THEN change END AS change_rate, quality_flag, other AS yahoo_value, CASE WHEN bad THEN value END AS raw_value"


def shown(out):
    """The JSON detail as columns."""
    detail = lambda n: F.get_json_object("quality_detail", f"$.{n}").cast("double")
    return out.withColumns({"yahoo_value": detail("yahoo_fallback_val"), "raw_value": detail("raw_value")}).drop("quality_detail")


@query("stream_intraday_ingest", f"WITH last AS (SELECT observed_at, series_id, {_LASTS.replace('%s', 'event_id')} FROM intraday GROUP BY 1, 2), {_RECORD} SELECT observed_at, series_id, {_SHOWN} FROM flagged", "observed_at")
def stream_intraday_ingest(L):
    """Bars merged into the stored table, and the records of what it holds."""
    folder = shared_dir(L.spark, "streams", uuid.uuid4().hex)
    sink = st.bar_sink(L.spark, f"{folder}/bars")
    st.merge_bars(bar_stream(L), sink, f"{folder}/state")
    return shown(st.ingest(sink.read()))


@query("stream_source_resolve", f"""
WITH last AS (SELECT time_bucket(INTERVAL 10 MINUTE, observed_at) AS window_start, series_id, count(*) AS bars, {_LASTS.replace('%s', "{'t': observed_at, 'e': event_id}")} FROM intraday GROUP BY 1, 2), {_RECORD}
SELECT window_start, series_id, {_SHOWN}, bars FROM flagged""", "window_start")
def stream_source_resolve(L):
    out = st.resolve(bar_stream(L))
    return shown(st.written(L.spark, st.run_available(out, "update"), out.schema, ["window_start", "series_id"]))


_SESSIONS = """g AS (SELECT *, CASE WHEN observed_at - lag(observed_at) OVER w >= INTERVAL 90 MINUTE OR lag(observed_at) OVER w IS NULL THEN 1 ELSE 0 END AS starts FROM intraday WINDOW w AS (PARTITION BY series_id ORDER BY observed_at)),
s AS (SELECT *, sum(starts) OVER (PARTITION BY series_id ORDER BY observed_at) AS n FROM g)"""


def ticks(L):
    """A clock that goes on after the last bar: a stream of one instant a day later."""
    folder = landing_dir(L.spark, "streams", uuid.uuid4().hex, "clock")
    L.intraday.agg((F.max("observed_at") + F.expr("INTERVAL 1 DAY")).cast("timestamp").alias("tick")).write.parquet(folder)
    return L.spark.readStream.schema("tick timestamp").parquet(folder)


@query("stream_stale_alarm", f"WITH {_SESSIONS} SELECT series_id, min(observed_at) AS first_observed_at, max(observed_at) + INTERVAL 90 MINUTE AS alarm_at, count(*) AS bars FROM s GROUP BY series_id, n", "first_observed_at alarm_at")
def stream_stale_alarm(L):
    out = st.stale_alarms(bar_stream(L), ticks(L))
    return st.written(L.spark, st.run_available(out), out.schema, ["series_id", "first_observed_at"])


@query("stream_silent_series", """
SELECT series_id, max(observed_at) AS last_observed_at, max(max(observed_at)) OVER () + INTERVAL 1 DAY AS noticed_at,
 (epoch(max(max(observed_at)) OVER () + INTERVAL 1 DAY)::BIGINT - epoch(max(observed_at))::BIGINT) // 60 AS stale_minutes FROM (SELECT * REPLACE (date_trunc('second', observed_at) AS observed_at) FROM intraday) GROUP BY series_id
UNION ALL SELECT 'GOLD', NULL, (SELECT date_trunc('second', max(observed_at)) + INTERVAL 1 DAY FROM intraday), NULL""", "last_observed_at noticed_at")
def stream_silent_series(L):
    """Silent series at a tick after the last bar, one that never sent among them."""
    folder = shared_dir(L.spark, "streams", uuid.uuid4().hex)
    sink = st.bar_sink(L.spark, f"{folder}/bars")
    st.merge_bars(bar_stream(L), sink, f"{folder}/state")
    expected = L.intraday.select("series_id").distinct().unionByName(L.spark.range(1).select(F.lit("GOLD").alias("series_id")))
    st.alarm_on_ticks(ticks(L), sink, expected, f"{folder}/alarms", f"{folder}/clock_state")
    found = L.spark.read.schema(st.ALARMS).parquet(f"{folder}/alarms")
    return found.select("series_id", F.date_trunc("second", "last_observed_at").alias("last_observed_at"), F.date_trunc("second", "noticed_at").alias("noticed_at"), "stale_minutes")


@query("stream_news_freshness", """
SELECT event_id, printf('%06d', user_id) AS symbol, date_trunc('second', ts) - INTERVAL 9 HOUR AS published_at FROM events WHERE event_type <> 'error' AND date_trunc('second', ts) - INTERVAL 9 HOUR >= TIMESTAMP '2024-01-30 09:00:00' - INTERVAL 12 HOUR""", "published_at")
def stream_news_freshness(L):
    stamp = F.concat(F.date_format("ts", "EEE, dd MMM yyyy HH:mm:ss"), F.lit(" +0900"))
    news = event_stream(L).select("event_id", F.format_string("%06d", "user_id").alias("symbol"), F.when(c("event_type") == "error", "not a date").otherwise(stamp).alias("pub_date"))
    out = st.fresh_news(news, F.lit("2024-01-30 09:00:00").cast("timestamp")).select("event_id", "symbol", "published_at")
    return st.written(L.spark, st.run_available(out), out.schema, ["event_id"])
