"""Scans, readers of landed files, and keyed table writes."""

from __future__ import annotations

import uuid
from datetime import date

from pyspark.sql import functions as F

from ..operators import prices as px
from ..schemas import SHORTS
from ..session import landing_dir
from ..sources import scan, tables as tb
from .registry import TARGET, query
from .windows_q import panel


def c(name):
    return F.col(name)


def landed(L, kind: str) -> str:
    """A new folder for files this run lands."""
    return landing_dir(L.spark, f"{kind}-{uuid.uuid4().hex}")


@query("scan_date_range", "SELECT symbol, base_date, close_price, volume, source FROM prices_raw WHERE base_date BETWEEN DATE '1999-01-01' AND DATE '1999-12-31'", "base_date")
def scan_date_range(L):
    return scan.date_range(L.prices_raw, "base_date", date(1999, 1, 1), date(1999, 12, 31)).select("symbol", "base_date", "close_price", "volume", "source")


@query("scan_eq_in", "SELECT base_date, symbol, metric_value FROM rankings WHERE source = 'KIS' AND market IN ('KOSPI', 'ETF') AND rank_type <> 'market_cap'", "base_date")
def scan_eq_in(L):
    return scan.matching(L.rankings, ["base_date", "symbol", "metric_value"], {"source": "KIS"}, {"market": ["KOSPI", "ETF"]}, {"rank_type": "market_cap"})


@query("latest_row", "SELECT * FROM global_macro WHERE base_date = (SELECT max(base_date) FROM global_macro WHERE base_date <= $T)", "base_date", "gold copper wti us10y usdkrw")
def latest_row(L):
    return scan.latest_row(L.global_macro, "base_date", TARGET)


@query("latest_row_per_series", "SELECT series_id, max(base_date) AS base_date, arg_max(value, base_date) AS value FROM macro_series WHERE base_date <= $T GROUP BY 1", "base_date", "value")
def latest_row_per_series(L):
    return scan.latest_row_per_series(L.macro_series, TARGET)


_TABLES = ("prices_raw", "supply", "shorts", "rankings", "features", "macro_series", "global_macro")


def stored(L):
    return {n: getattr(L, n) for n in _TABLES}


@query("latest_date_per_table", " UNION ALL ".join(f"SELECT '{t}' AS table_name, max(base_date) AS latest_date, date_diff('day', max(base_date), DATE '2001-12-31') AS lag_days FROM {t}" for t in _TABLES), "latest_date")
def latest_date_per_table(L):
    return scan.latest_dates(stored(L), date(2001, 12, 31))


@query("count_rows", " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS row_count, count(*) FILTER (WHERE base_date = $T) AS target_count FROM {t}" for t in _TABLES))
def count_rows(L):
    return scan.row_counts(stored(L), TARGET)


@query("read_series_config", """
SELECT DISTINCT o_orderpriority AS series_id, 'ECOS' AS source, CASE WHEN o_orderpriority < '3' THEN 'rates' ELSE 'fx' END AS category, 'D' AS frequency, true AS enabled FROM orders WHERE o_orderpriority NOT IN ('5-LOW', '2-HIGH')""")
def read_series_config(L):
    sid = c("o_orderpriority")
    rows = L.table("orders").select(sid.alias("series_id")).distinct().select(
        "series_id", F.lit("ECOS").alias("source"), F.when(c("series_id") < "3", "rates").otherwise("fx").alias("category"), F.lit("D").alias("frequency"), (c("series_id") != "5-LOW").alias("enabled"))
    path = landed(L, "series")
    rows.write.json(path)
    return scan.series_config(L.spark, path, ["rates", "fx"]).where("series_id <> '2-HIGH'")


@query("read_calendar_overrides", """
SELECT 'XKRX' AS exchange_code, calendar_date, NOT is_open AS is_open, 'manual' AS reason FROM calendar WHERE exchange_code = 'XKRX' AND reason = 'weekend' AND calendar_date >= DATE '2001-01-01'""", "calendar_date")
def read_calendar_overrides(L):
    rows = L.calendar.where("exchange_code = 'XKRX' and reason = 'weekend' and calendar_date >= date'2001-01-01'")
    item = F.struct(F.lower("exchange_code").alias("exchange_code"), "calendar_date", (~c("is_open")).alias("is_open"), F.lit("manual").alias("reason"))
    path = landed(L, "overrides")
    # one document per month, each with its list
    docs = rows.groupBy(F.trunc("calendar_date", "month").alias("m")).agg(F.collect_list(item).alias("overrides"))
    docs.select(F.to_json(F.struct("overrides")).alias("value")).write.text(path)
    return scan.calendar_overrides(L.spark, path, multi_line=False)


@query("read_listing", "SELECT symbol AS code, CASE WHEN s_acctbal > 5000 THEN name || ' new' ELSE name END AS name, coalesce(market, 'KONEX') AS market FROM master")
def read_listing(L):
    rows = L.table("supplier").join(L.master.withColumnRenamed("symbol", "m"), F.format_string("%06d", "s_suppkey") == c("m"))
    base = rows.select(c("s_suppkey").cast("string").alias("code"), "name", F.coalesce("market", F.lit("KONEX")).alias("market"), F.lit(1).cast("long").alias("line_no"), "s_acctbal")
    again = base.where("s_acctbal > 5000").withColumns({"code": F.concat(F.lit("Q"), F.lpad("code", 6, "0")), "name": F.concat("name", F.lit(" new")), "line_no": F.lit(2).cast("long")})
    path = landed(L, "listing")
    base.unionByName(again).drop("s_acctbal").write.option("header", True).csv(path)
    return scan.listing(L.spark, path)


@query("read_corp_code_map", "SELECT printf('%08d', s_suppkey) AS corp_code, s_name AS corp_name, printf('%06d', s_suppkey) AS stock_code FROM supplier WHERE s_acctbal > 0")
def read_corp_code_map(L):
    code = F.when(c("s_acctbal") > 0, F.format_string("%06d", "s_suppkey")).otherwise(" ")
    path = landed(L, "corp")
    L.table("supplier").select(F.format_string("%08d", "s_suppkey").alias("corp_code"), c("s_name").alias("corp_name"), code.alias("stock_code")).write.format("xml").option("rootTag", "result").option("rowTag", "list").save(path)
    return scan.corp_codes(L.spark, path)


# ---- keyed writes -----------------------------------------------------------

_KEY = ["symbol", "base_date"]
_STORED = """stored AS (SELECT symbol, base_date, short_volume, short_value, short_ratio FROM shorts WHERE (symbol::INT + day(base_date)) % 3 <> 0)"""
_FRESH = """fresh AS (SELECT symbol, base_date, short_volume + 1 AS short_volume, short_value, coalesce(short_ratio, 9.0) AS short_ratio FROM shorts WHERE (symbol::INT + day(base_date)) % 3 <> 1)"""


def _third():
    """Which third of all symbol-days a row is in: one is stored only, one arrives only, one does both."""
    return (c("symbol").cast("int") + F.dayofmonth("base_date")) % 3


def stored_shorts(L):
    return L.shorts.where(_third() != 0).select("symbol", "base_date", "short_volume", "short_value", "short_ratio")


def fresh_shorts(L):
    return L.shorts.where(_third() != 1).select(
        "symbol", "base_date", (c("short_volume") + 1).alias("short_volume"), "short_value", F.coalesce("short_ratio", F.lit(9.0)).alias("short_ratio"))


_PREPARED = f"""prepared AS (SELECT symbol, base_date, close_price, volume, trading_value, source FROM (SELECT *, row_number() OVER (PARTITION BY symbol, base_date ORDER BY available_at DESC NULLS LAST, trading_value DESC NULLS LAST, volume DESC NULLS LAST,
   close_price DESC NULLS LAST, source DESC NULLS LAST) AS rn FROM prices WHERE close_price IS NOT NULL AND volume IS NOT NULL AND trading_value IS NOT NULL) WHERE rn = 1)"""
_LAST = ("available_at", "trading_value", "volume", "close_price", "source")


def last_order():
    return [F.col(n).desc_nulls_last() for n in _LAST]


@query("upsert_by_key", f"""WITH {_PREPARED}, old AS (SELECT symbol, base_date, p::DOUBLE AS close_price, vol::DOUBLE AS volume, val::DOUBLE AS trading_value, 'OLD' AS source FROM day_bars)
SELECT * FROM prepared UNION ALL SELECT * FROM old o WHERE NOT EXISTS (SELECT 1 FROM prepared p WHERE p.symbol = o.symbol AND p.base_date = o.base_date)""", "base_date")
def upsert_by_key(L):
    columns = ["symbol", "base_date", "close_price", "volume", "trading_value", "source"]
    old = L.day_bars.select("symbol", "base_date", c("p").cast("double").alias("close_price"), c("vol").cast("double").alias("volume"), c("val").cast("double").alias("trading_value"), F.lit("OLD").alias("source"))
    new = tb.prepare("normalized_stock_prices_daily", L.prices_raw, last_order())
    return tb.upsert(old, new.select(*columns), _KEY)


@query("insert_ignore", f"WITH {_STORED}, {_FRESH} SELECT * FROM stored UNION ALL SELECT * FROM fresh f WHERE NOT EXISTS (SELECT 1 FROM stored s WHERE s.symbol = f.symbol AND s.base_date = f.base_date)", "base_date")
def insert_ignore(L):
    return tb.insert_ignore(stored_shorts(L), fresh_shorts(L), _KEY)


@query("dedupe_last_by_key", """
SELECT symbol, base_date, source, close_price, available_at FROM (SELECT *, row_number() OVER (PARTITION BY source, symbol, base_date ORDER BY available_at DESC NULLS LAST, trading_value DESC NULLS LAST, volume DESC NULLS LAST,
  close_price DESC NULLS LAST, source DESC NULLS LAST) AS rn FROM prices WHERE coalesce(source, '') <> '') WHERE rn = 1""", "base_date available_at")
def dedupe_last_by_key(L):
    return tb.dedupe_last(px.canonical(L.prices_raw), ["source", "symbol", "base_date"], last_order()).select("symbol", "base_date", "source", "close_price", "available_at")


@query("reject_missing_keys", "SELECT base_date, CASE WHEN source IS NULL THEN 'missing source' END AS reject_reason, count(*) AS n FROM prices_raw GROUP BY 1, 2", "base_date")
def reject_missing_keys(L):
    return tb.reject_missing_keys(L.prices_raw, ["source", "symbol", "base_date"]).groupBy("base_date", "reject_reason").agg(F.count(F.lit(1)).alias("n"))


@query("update_where", f"WITH {_STORED}, {_FRESH} SELECT s.symbol, s.base_date, s.short_volume, s.short_value, coalesce(f.short_ratio, s.short_ratio) AS short_ratio FROM stored s LEFT JOIN fresh f ON f.symbol = s.symbol AND f.base_date = s.base_date", "base_date")
def update_where(L):
    return tb.update_where(stored_shorts(L), fresh_shorts(L), _KEY, ["short_ratio"])


@query("delete_where", "SELECT symbol, base_date, source, close_price FROM prices_raw WHERE NOT coalesce(source = 'KRX' AND base_date < DATE '1999-01-01', false)", "base_date")
def delete_where(L):
    return tb.delete_where(L.prices_raw, {"source": "KRX"}, {"base_date": date(1999, 1, 1)}).select("symbol", "base_date", "source", "close_price")


@query("replace_slice", """
SELECT symbol, base_date, feature_name, feature_value FROM features WHERE NOT (base_date = $T AND symbol <> 'GLOBAL' AND feature_name IN ('close_price', 'volume'))
UNION ALL SELECT symbol, base_date, 'close_price', close_price FROM panel WHERE base_date = $T""", "base_date")
def replace_slice(L):
    gone = (c("base_date") == F.lit(TARGET)) & (c("symbol") != "GLOBAL") & c("feature_name").isin("close_price", "volume")
    fresh = panel(L).where(c("base_date") == F.lit(TARGET)).select("symbol", "base_date", F.lit("close_price").alias("feature_name"), c("close_price").alias("feature_value"))
    return tb.replace_slice(L.features, gone, fresh)


@query("refresh_news_slice", """
WITH n AS (SELECT event_id, printf('%06d', user_id) AS symbol, CASE WHEN event_type = 'click' THEN 'News' ELSE 'Filing' END AS source, ts FROM events),
r AS (SELECT DISTINCT symbol FROM n WHERE ts >= TIMESTAMP '2024-01-29 00:00:00')
SELECT event_id, symbol, source FROM n WHERE source <> 'News' OR symbol NOT IN (SELECT symbol FROM r) UNION ALL SELECT event_id + 1000000, symbol, 'News' FROM n WHERE source = 'News' AND ts >= TIMESTAMP '2024-01-29 00:00:00'""")
def refresh_news_slice(L):
    rows = L.table("events").select("event_id", F.format_string("%06d", "user_id").alias("symbol"), F.when(c("event_type") == "click", "News").otherwise("Filing").alias("source"), "ts")
    recent = rows.where(c("ts") >= F.lit("2024-01-29 00:00:00").cast("timestamp_ntz"))
    fresh = recent.where("source = 'News'").withColumn("event_id", c("event_id") + 1000000)
    columns = ["event_id", "symbol", "source"]
    return tb.refresh_slices(rows.select(*columns), fresh.select(*columns), ["source", "symbol"], recent.select(F.lit("News").alias("source"), "symbol"))


@query("align_schema", "SELECT symbol, base_date, short_volume::DOUBLE AS short_volume, short_value, short_ratio, NULL::VARCHAR AS source, NULL::VARCHAR AS available_at FROM shorts", "base_date")
def align_schema(L):
    return tb.align_schema(L.shorts.withColumn("unknown_extra", F.lit(1)), SHORTS)


@query("append_run_log", "SELECT job_name, target_date, status, records_processed, error_message FROM run_logs UNION ALL SELECT 'agg_features', base_date, 'SKIPPED_MARKET_CLOSED', count(*), '' FROM features GROUP BY base_date", "target_date")
def append_run_log(L):
    fresh = L.features.groupBy("base_date").agg(F.count(F.lit(1)).alias("n"))
    rows = fresh.select(*tb.run_log(F.lit("agg_features"), c("base_date"), F.lit("SKIPPED_MARKET_CLOSED"), c("n")))
    return L.run_logs.drop("run_id").unionByName(rows)
