"""Column rules applied to whole tables, row predicates and filters."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import markets as mk, parsing as ps, sanity as sn, symbols as sy, times as tm
from ..operators import prices as px, windows as win
from .registry import TARGET, query
from .views_sql import norm, valid

_LIST_NAMES = {0: "KODEX ", 1: "PLUS ", 2: "ETN ", 3: "SPAC ", 4: ""}

_NAMED = """named AS (SELECT s_suppkey, CASE s_nationkey % 5 WHEN 0 THEN 'KODEX ' WHEN 1 THEN 'PLUS ' WHEN 2 THEN 'ETN ' WHEN 3 THEN 'SPAC ' ELSE '' END || s_name AS name,
 CASE s_nationkey % 7 WHEN 0 THEN 'j' WHEN 1 THEN 'KQ' WHEN 2 THEN ' ks ' WHEN 3 THEN 'T' WHEN 4 THEN 'KOSDAQ GLOBAL' WHEN 5 THEN 'kospi200' END AS market,
 CASE s_nationkey % 4 WHEN 0 THEN 'KOSPI' WHEN 1 THEN 'ETF' WHEN 2 THEN 'Q' END AS other_market FROM supplier)"""


def named(L):
    """Suppliers as listed products with name prefixes and market spellings."""
    key = F.col("s_nationkey")
    name = F.lit("")
    for value, prefix in _LIST_NAMES.items():
        name = F.when(key % 5 == value, prefix).otherwise(name)
    markets = {0: "j", 1: "KQ", 2: " ks ", 3: "T", 4: "KOSDAQ GLOBAL", 5: "kospi200"}
    others = {0: "KOSPI", 1: "ETF", 2: "Q"}
    market, other = F.lit(None).cast("string"), F.lit(None).cast("string")
    for value, text in markets.items():
        market = F.when(key % 7 == value, text).otherwise(market)
    for value, text in others.items():
        other = F.when(key % 4 == value, text).otherwise(other)
    return L.table("supplier").select("s_suppkey", F.concat(name, "s_name").alias("name"), market.alias("market"), other.alias("other_market"))


@query("fn_normalize_symbol", f"SELECT symbol AS raw_symbol, {norm('symbol')} AS symbol, count(*) AS n FROM prices_raw GROUP BY 1, 2")
def fn_normalize_symbol(L):
    raw = F.col("symbol")
    return L.prices_raw.groupBy(raw.alias("raw_symbol")).agg(F.count(F.lit(1)).alias("n")).withColumn("symbol", sy.normalize_symbol(F.col("raw_symbol")))


@query("fn_is_q_symbol", "SELECT base_date, count(*) FILTER (WHERE symbol LIKE 'Q%') AS q_rows, count(*) AS n FROM prices_raw GROUP BY 1", "base_date")
def fn_is_q_symbol(L):
    return L.prices_raw.groupBy("base_date").agg(F.count_if(sy.is_q_symbol(F.col("symbol"))).alias("q_rows"), F.count(F.lit(1)).alias("n"))




def amount_text(L):
    c = F.col
    text = F.when(c("tax_pct") >= 8, "-").when(c("tax_pct") == 0, "").when(c("disc_pct") == 0, "n/a").otherwise(F.format_number("cents", 0))
    return L._lines.select("l_linenumber", "l_orderkey", "l_partkey", "cents", text.alias("text"))


@query("fn_parse_nullable", """
SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN tax_pct >= 8 THEN '-' WHEN tax_pct = 0 THEN '' WHEN disc_pct = 0 THEN 'n/a' ELSE format('{:,}', cents) END AS text,
 CASE WHEN tax_pct < 8 AND tax_pct > 0 AND disc_pct > 0 THEN cents::DOUBLE END AS parsed FROM lines""")
def fn_parse_nullable(L):
    return amount_text(L).select("l_orderkey", "l_linenumber", "l_partkey", "text", ps.parse_nullable(F.col("text")).alias("parsed"))


@query("fn_parse_default_zero", """
SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN tax_pct < 8 AND tax_pct > 0 AND disc_pct > 0 THEN cents ELSE 0 END AS parsed_int,
 CASE WHEN tax_pct < 8 AND tax_pct > 0 AND disc_pct > 0 THEN cents ELSE 0 END::DOUBLE AS parsed_float FROM lines""")
def fn_parse_default_zero(L):
    text = F.col("text")
    return amount_text(L).select("l_orderkey", "l_linenumber", "l_partkey", ps.parse_int_zero(text).alias("parsed_int"), ps.parse_zero(text).alias("parsed_float"))


@query("fn_parse_date_any", """
SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN o_orderdate::DATE WHEN 'O' THEN o_orderdate::DATE END AS parsed,
 CASE o_orderstatus WHEN 'P' THEN $T ELSE o_orderdate::DATE END AS with_fallback FROM orders""", "parsed with_fallback")
def fn_parse_date_any(L):
    day = F.col("o_orderdate")
    text = F.when(F.col("o_orderstatus") == "F", F.date_format(day, "yyyy-MM-dd'T'HH:mm:ss")).when(
        F.col("o_orderstatus") == "O", F.date_format(day, "yyyy/MM/dd")).otherwise("n.a.")
    rows = L.table("orders").select("o_orderkey", text.alias("text"))
    return rows.select("o_orderkey", ps.parse_date_any(F.col("text")).alias("parsed"), ps.parse_date_any(F.col("text"), F.lit(TARGET)).alias("with_fallback"))


@query("fn_parse_cycle_date", """
SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN CASE WHEN o_orderpriority = '1-URGENT' THEN o_orderdate::DATE ELSE date_trunc('month', o_orderdate)::DATE END
 WHEN 'O' THEN date_trunc('quarter', o_orderdate)::DATE ELSE date_trunc('year', o_orderdate)::DATE END AS first_day FROM orders""", "first_day")
def fn_parse_cycle_date(L):
    c, day = F.col, F.col("o_orderdate")
    urgent = c("o_orderpriority") == "1-URGENT"
    cycle = F.when((c("o_orderstatus") == "F") & urgent, "D").when(c("o_orderstatus") == "F", "M").when(c("o_orderstatus") == "O", "Q").otherwise("A")
    period = F.when(c("cycle") == "D", F.date_format(day, "yyyyMMdd")).when(c("cycle") == "M", F.date_format(day, "yyyyMM")).when(
        c("cycle") == "Q", F.concat(F.year(day).cast("string"), F.lit("Q"), F.quarter(day).cast("string"))).otherwise(F.year(day).cast("string"))
    rows = L.table("orders").withColumn("cycle", cycle).withColumn("period", period)
    return rows.select("o_orderkey", ps.parse_cycle_date(c("period"), c("cycle")).alias("first_day"))


@query("fn_first_present", """
SELECT o_orderkey, coalesce(CASE WHEN o_orderstatus <> 'F' THEN nullif(CASE WHEN o_orderstatus = 'O' THEN '' ELSE 'a' END, '') END,
  CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderpriority END, '0') AS chosen FROM orders""")
def fn_first_present(L):
    c = F.col
    a = F.when(c("o_orderstatus") == "F", F.lit(None)).when(c("o_orderstatus") == "O", "").otherwise("a")
    b = F.when(c("o_orderpriority") != "5-LOW", c("o_orderpriority"))
    return L.table("orders").select("o_orderkey", ps.first_present(a, b, default=F.lit("0")).alias("chosen"))


_STD = "CASE WHEN upper(trim({0})) IN ('KOSPI','KOSDAQ','ETF','ETN','KOSPI200') THEN upper(trim({0})) WHEN upper(trim({0})) IN ('J','STOCK','KS','KSE') THEN 'KOSPI' WHEN upper(trim({0})) IN ('Q','KQ') THEN 'KOSDAQ' WHEN upper(trim({0})) = 'T' THEN 'ETF' END"
_ETFNAME = "(upper(name) NOT LIKE '%ETN%' AND (regexp_matches(upper(name), '^(KODEX|TIGER|RISE|ACE|SOL|HANARO|KOSEF|TIMEFOLIO|PLUS )') OR upper(name) LIKE '% ETF%' OR upper(name) = 'ETF'))"
_BYNAME = f"CASE WHEN upper(name) LIKE '%ETN%' THEN 'ETN' WHEN {_ETFNAME} THEN 'ETF' END"
_ALIAS = "CASE WHEN upper(trim({0})) IN ('KOSPI','KOSDAQ','ETF','ETN') THEN upper(trim({0})) WHEN upper(trim({0})) IN ('J','STOCK','KS','KSE') THEN 'KOSPI' WHEN upper(trim({0})) IN ('Q','KQ','KOSDAQ GLOBAL') THEN 'KOSDAQ' END"


@query("fn_standard_market", f"""WITH {_NAMED} SELECT s_suppkey, {_STD.format('market')} AS standard, coalesce({_STD.format('market')}, upper(trim(market))) AS audit_market,
 coalesce({_BYNAME}, {_ALIAS.format('market')}) AS listed FROM named""")
def fn_standard_market(L):
    market = F.col("market")
    return named(L).select(
        "s_suppkey", mk.standard_market(market).alias("standard"),
        mk.standard_market(market, F.upper(F.btrim(market))).alias("audit_market"), mk.listing_market(market, F.col("name")).alias("listed"),
    )


@query("fn_market_label", f"""WITH {_NAMED} SELECT s_suppkey, CASE WHEN market IS NULL THEN '' WHEN upper(market) LIKE '%KOSPI%' THEN 'KOSPI' WHEN upper(market) LIKE '%KOSDAQ%' THEN 'KOSDAQ'
 ELSE upper(trim(market)) END AS label FROM named""")
def fn_market_label(L):
    return named(L).select("s_suppkey", mk.market_label(F.col("market")).alias("label"))


@query("fn_is_etf_name", f"WITH {_NAMED} SELECT s_suppkey, name, {_ETFNAME} AS is_etf FROM named")
def fn_is_etf_name(L):
    return named(L).select("s_suppkey", "name", mk.is_etf_name(F.col("name")).alias("is_etf"))


@query("fn_infer_market_from_name", f"WITH {_NAMED} SELECT s_suppkey, {_BYNAME} AS market FROM named")
def fn_infer_market_from_name(L):
    return named(L).select("s_suppkey", mk.market_from_name(F.col("name")).alias("market"))


@query("fn_infer_asset_type", f"""WITH {_NAMED} SELECT s_suppkey, CASE WHEN coalesce({_BYNAME}, {_ALIAS.format('market')}) IN ('ETF', 'ETN')
 THEN coalesce({_BYNAME}, {_ALIAS.format('market')}) ELSE 'STOCK' END AS asset_type FROM named""")
def fn_infer_asset_type(L):
    return named(L).select("s_suppkey", mk.asset_type_of(F.col("market"), F.col("name")).alias("asset_type"))


@query("fn_is_common_stock", f"""WITH {_NAMED} SELECT s_suppkey, {_BYNAME} IS NULL AND NOT regexp_matches(upper(name), 'ETF|ETN|SPAC|REIT|PREFERRED|1우|2우|3우|우B|우C') AS is_common FROM named""")
def fn_is_common_stock(L):
    return named(L).select("s_suppkey", mk.is_common_stock(F.col("name")).alias("is_common"))


@query("fn_prefer_market", f"""WITH {_NAMED}, a AS (SELECT *, {_ALIAS.format('market')} AS o, {_ALIAS.format('other_market')} AS f FROM named)
SELECT s_suppkey, CASE WHEN o IN ('ETF', 'ETN') THEN o WHEN f IN ('ETF', 'ETN') THEN f ELSE coalesce(o, f) END AS market FROM a""")
def fn_prefer_market(L):
    return named(L).select("s_suppkey", mk.prefer_market(F.col("market"), F.col("other_market")).alias("market"))


@query("fn_prefer_symbol", """
SELECT s_suppkey, CASE WHEN s_nationkey % 2 = 0 THEN printf('%06d', s_suppkey) ELSE printf('%06d', s_nationkey) || 'X' END AS symbol FROM supplier""")
def fn_prefer_symbol(L):
    existing = F.when(F.col("s_nationkey") % 2 == 0, F.concat(F.lit("Q"), F.format_string("%06d", "s_suppkey"))).otherwise(F.col("s_suppkey").cast("string"))
    new = F.when(F.col("s_nationkey") % 2 == 0, F.lit(None).cast("string")).otherwise(F.concat(F.format_string("%06d", "s_nationkey"), F.lit("x ")))
    return L.table("supplier").select("s_suppkey", sy.prefer_symbol(existing, new).alias("symbol"))


@query("fn_available_at", """
SELECT o_orderkey, o_orderdate::DATE::TIMESTAMP + INTERVAL 7 HOUR AS eod, o_orderdate::DATE::TIMESTAMP + INTERVAL 570 MINUTE AS central_bank,
 o_orderdate::DATE::TIMESTAMP + INTERVAL 9 HOUR AS back_fill FROM orders""", "eod central_bank back_fill")
def fn_available_at(L):
    day = F.col("o_orderdate").cast("date")
    return L.table("orders").select("o_orderkey", tm.available_at(day).alias("eod"), tm.available_at(day, 18, 30).alias("central_bank"), tm.available_at(day, 18).alias("back_fill"))


@query("fn_kst_date", "SELECT event_id, (ts + INTERVAL 9 HOUR)::DATE AS kst_date FROM events", "kst_date")
def fn_kst_date(L):
    return L.table("events").select("event_id", tm.kst_date(F.col("ts")).alias("kst_date"))


_BARS = "bars AS (SELECT *, lag(value) OVER (PARTITION BY series_id, base_date ORDER BY observed_at, event_id) AS previous, first_value(value) OVER (PARTITION BY series_id, base_date ORDER BY observed_at, event_id) AS opening FROM intraday)"


def bars(L):
    """Intraday bars with the previous and first value of their series-day.

    A busy series-day is cut into ranges for the first and aggregated for the second.
    """
    day = ["series_id", "base_date"]
    rows = L.intraday.withColumn("at", F.struct("observed_at", "event_id"))
    opening = rows.groupBy(*day).agg(F.min_by("value", "at").alias("opening"))
    stepped = win.blocked_lag(rows, day, "at", "value")
    return stepped.join(opening, day)


@query("fn_change_rate", f"WITH {_BARS} SELECT event_id, (value / nullif(previous, 0) - 1) * 100 AS change_rate FROM bars", rounds="change_rate")
def fn_change_rate(L):
    return bars(L).select("event_id", sn.change_rate(F.col("value"), F.col("previous")).alias("change_rate"))


@query("fn_index_hard_invalid", f"WITH {_BARS} SELECT event_id, coalesce(previous - 200 <= 0, true) AS invalid FROM bars")
def fn_index_hard_invalid(L):
    return bars(L).select("event_id", sn.index_hard_invalid(F.col("previous") - 200).alias("invalid"))


_CLASS = """CASE WHEN value - 20 <= 0 THEN 'INVALID' WHEN abs(coalesce(change_rate, CASE WHEN previous > 0 THEN ((value - 20) / previous - 1) * 100 END)) > 20 THEN 'ANOMALY'
 WHEN opening > 0 AND abs((value - 20) / opening - 1) * 100 > 10 THEN 'SOURCE_MISMATCH' ELSE 'OK' END"""


@query("fn_classify_index_quality", f"WITH {_BARS} SELECT event_id, {_CLASS} AS quality FROM bars")
def fn_classify_index_quality(L):
    c = F.col
    flag = sn.classify_index_quality(c("value") - 20, c("change_rate"), c("previous"), c("opening"))
    return bars(L).select("event_id", flag.alias("quality"))


@query("fn_intraday_bounds", """
SELECT event_id, value <= 0 OR NOT value BETWEEN CASE series_id WHEN 'KOSPI' THEN 100 WHEN 'KOSDAQ' THEN 50 WHEN 'USDKRW' THEN 500 WHEN 'VIX' THEN 1 WHEN 'WTI' THEN 5 END
 AND CASE series_id WHEN 'KOSPI' THEN 100000 WHEN 'KOSDAQ' THEN 50000 WHEN 'USDKRW' THEN 5000 WHEN 'VIX' THEN 500 WHEN 'WTI' THEN 1000 END AS out_of_bounds FROM intraday""")
def fn_intraday_bounds(L):
    return L.intraday.select("event_id", sn.intraday_out_of_bounds(F.col("series_id"), F.col("value")).alias("out_of_bounds"))


@query("fn_macro_suspicious", """
SELECT base_date, concat_ws(',', CASE WHEN NOT wti / 1000 BETWEEN 20 AND 200 THEN 'wti' END, CASE WHEN NOT us10y / 50000 BETWEEN 0 AND 10 THEN 'us10y' END,
 CASE WHEN NOT copper / 50000 BETWEEN 0 AND 10 THEN 'us3y' END) AS suspicious FROM global_macro""", "base_date")
def fn_macro_suspicious(L):
    fields = {"wti": F.col("wti") / 1000, "us10y": F.col("us10y") / 50000, "us3y": F.col("copper") / 50000}
    return L.global_macro.select("base_date", F.array_join(sn.macro_suspicious(fields), ",").alias("suspicious"))


@query("fn_expiration_flag", "SELECT o_orderkey, isodow(o_orderdate) = 4 AND day(o_orderdate) BETWEEN 8 AND 14 AS expiration_flag FROM orders")
def fn_expiration_flag(L):
    return L.table("orders").select("o_orderkey", tm.expiration_flag(F.col("o_orderdate").cast("date")).alias("expiration_flag"))


@query("fn_source_priority", """
SELECT source, CASE source WHEN 'KIS_DETAIL' THEN 0 WHEN 'KIS' THEN 1 WHEN 'KRX' THEN 2 WHEN 'VALID_PRICE_FALLBACK' THEN 3 ELSE 4 END AS priority, count(*) AS n
FROM prices_raw GROUP BY 1, 2""", ints="priority")
def fn_source_priority(L):
    return L.prices_raw.groupBy("source", mk.source_priority(F.col("source")).alias("priority")).agg(F.count(F.lit(1)).alias("n"))


@query("fn_feature_prefix", "SELECT DISTINCT o_orderpriority AS series, 'macro_' || replace(lower(o_orderpriority), ' ', '_') AS prefix FROM orders")
def fn_feature_prefix(L):
    from ..operators.features import feature_prefix

    series = F.col("o_orderpriority")
    return L.table("orders").select(series.alias("series")).distinct().withColumn("prefix", feature_prefix(F.col("series")))


@query("fn_staleness_days", "SELECT o_orderkey, date_diff('day', o_orderdate::DATE, $T) AS stale_days FROM orders")
def fn_staleness_days(L):
    return L.table("orders").select("o_orderkey", tm.staleness_days(F.col("o_orderdate").cast("date"), F.lit(TARGET)).alias("stale_days"))


@query("fn_effective_source_date", """
SELECT base_date, market, rank_type, coalesce(source_base_date, raw_price_date) AS effective_date, count(*) AS n FROM rankings GROUP BY 1, 2, 3, 4""", "base_date effective_date")
def fn_effective_source_date(L):
    stored = F.get_json_object("raw_data", "$.price_base_date").try_cast("date")
    return L.rankings.groupBy("base_date", "market", "rank_type", F.coalesce("source_base_date", stored).alias("effective_date")).agg(F.count(F.lit(1)).alias("n"))


# ---- predicates -------------------------------------------------------------


@query("valid_price_row", f"SELECT symbol, base_date, close_price, volume, trading_value, source FROM prices_raw WHERE {valid()} AND coalesce(source, '') <> ''", "base_date")
def valid_price_row(L):
    return L.prices_raw.where(px.valid_row(require_source=True)).select("symbol", "base_date", "close_price", "volume", "trading_value", "source")


@query("valid_price_row_lenient", "SELECT symbol, base_date, close_price, volume, trading_value, source FROM prices_raw WHERE close_price IS NOT NULL AND volume > 0 AND trading_value > 0", "base_date")
def valid_price_row_lenient(L):
    return L.prices_raw.where(px.valid_row_lenient()).select("symbol", "base_date", "close_price", "volume", "trading_value", "source")


@query("valid_price_view", """
SELECT symbol, base_date, close_price, volume, trading_value, base_date = (SELECT max(base_date) FROM prices_raw WHERE close_price IS NOT NULL AND volume IS NOT NULL AND trading_value IS NOT NULL) AS is_latest
FROM prices_raw WHERE close_price IS NOT NULL AND volume IS NOT NULL AND trading_value IS NOT NULL""", "base_date")
def valid_price_view(L):
    rows = L.prices_raw.where(px.complete_row())
    newest = rows.agg(F.max("base_date").alias("d"))
    return rows.select("symbol", "base_date", "close_price", "volume", "trading_value", (F.col("base_date") == newest.scalar()).alias("is_latest"))


@query("block_incomplete_prices", """
SELECT base_date, CASE WHEN open_price IS NULL AND high_price IS NULL AND low_price IS NULL AND close_price IS NULL AND volume IS NULL AND trading_value IS NULL THEN 'snapshot_only_price_row'
 WHEN close_price IS NULL OR volume IS NULL OR trading_value IS NULL THEN 'missing_required_price_fields' ELSE 'ACCEPTED' END AS outcome, count(*) AS n FROM prices_raw GROUP BY 1, 2""", "base_date")
def block_incomplete_prices(L):
    outcome = F.coalesce(px.block_reason(), F.lit("ACCEPTED")).alias("outcome")
    return L.prices_raw.groupBy("base_date", outcome).agg(F.count(F.lit(1)).alias("n"))


@query("snapshot_only_rows", """
SELECT base_date, count(*) AS snapshot_only_rows FROM prices_raw WHERE open_price IS NULL AND high_price IS NULL AND low_price IS NULL AND close_price IS NULL AND volume IS NULL
 AND trading_value IS NULL GROUP BY 1""", "base_date")
def snapshot_only_rows(L):
    return L.prices_raw.where(px.snapshot_only()).groupBy("base_date").agg(F.count(F.lit(1)).alias("snapshot_only_rows"))


@query("trading_day_filter", "SELECT symbol, base_date, close_price, source FROM prices WHERE base_date IN (SELECT base_date FROM open_days)", "base_date")
def trading_day_filter(L):
    return px.trading_day_filter(px.canonical(L.prices_raw), L.open_days).select("symbol", "base_date", "close_price", "source")


@query("suspicious_short_rows", "SELECT symbol, base_date, short_volume, short_value, short_ratio FROM shorts WHERE short_volume > 0 AND short_value > 0 AND coalesce(short_ratio, 0) = 0", "base_date")
def suspicious_short_rows(L):
    return L.shorts.where(px.suspicious_short()).select("symbol", "base_date", "short_volume", "short_value", "short_ratio")


@query("zero_volume_on_open_day", """
SELECT p.symbol, p.base_date, market, close_price, volume, trading_value FROM prices_raw p JOIN master m ON m.symbol = p.symbol
WHERE market IS NOT NULL AND close_price IS NOT NULL AND (coalesce(volume, 0) <= 0 OR coalesce(trading_value, 0) <= 0) AND base_date IN (SELECT base_date FROM open_days)""", "base_date")
def zero_volume_on_open_day(L):
    bad = F.col("close_price").isNotNull() & ((F.coalesce("volume", F.lit(0)) <= 0) | (F.coalesce("trading_value", F.lit(0)) <= 0))
    rows = px.on_open_days(L.prices_raw.where(bad), L.open_days)
    return rows.join(L.master.where("market is not null").select("symbol", "market"), "symbol").select(
        "symbol", "base_date", "market", "close_price", "volume", "trading_value")


@query("meaningful_etp_rows", """
WITH e AS (SELECT p.*, m.market FROM prices_raw p JOIN master m ON m.symbol = p.symbol WHERE m.market IN ('ETF', 'ETN') AND base_date BETWEEN $T - 10 AND $T),
d AS (SELECT market, max(base_date) AS base_date FROM e WHERE close_price IS NOT NULL OR volume IS NOT NULL OR trading_value IS NOT NULL OR market_cap IS NOT NULL GROUP BY 1)
SELECT e.market, e.symbol, e.base_date, e.close_price, e.trading_value FROM e JOIN d ON d.market = e.market AND d.base_date = e.base_date""", "base_date")
def meaningful_etp_rows(L):
    from datetime import timedelta

    rows = L.prices_raw.where(F.col("base_date").between(F.lit(TARGET - timedelta(days=10)), F.lit(TARGET))).join(
        L.master.where(F.col("market").isin(*mk.ETP_MARKETS)).select("symbol", "market"), "symbol")
    filled = F.coalesce("close_price", "volume", "trading_value", "market_cap").isNotNull()
    # at most one row per ETP market
    newest = rows.where(filled).groupBy("market").agg(F.max("base_date").alias("base_date"))
    return rows.join(F.broadcast(newest), ["market", "base_date"]).select("market", "symbol", "base_date", "close_price", "trading_value")
