"""Valid dates, rankings, universe, master, and set operations."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import functions as F

from ..functions import markets as mk
from ..functions.symbols import normalize_symbol
from ..operators import aggregates as agg, joins as jn, prices as px, rankings as rk, universe as un
from .registry import TARGET, query
from .views_sql import norm, valid
from .windows_q import panel

LIMITS = rk.RANKING_LIMITS
THRESHOLDS = {"KOSPI": 2, "KOSDAQ": 2, "ETF": 3, "ETN": 1}
READY = {"KOSPI": 1, "KOSDAQ": 100}
MIN_VALID = 22

_LIM = "CASE WHEN market IN ('KOSPI', 'KOSDAQ') THEN 30 ELSE 20 END"
_Q = "CASE WHEN symbol LIKE 'Q%' THEN substr(symbol, 2) ELSE symbol END"

_VALID_DAY = f"""goal AS (SELECT max(base_date) AS d FROM open_days WHERE base_date <= $T),
per_day AS (SELECT p.base_date, count(*) FILTER (WHERE {valid()}) AS n, """ + ", ".join(
    f"count(*) FILTER (WHERE {valid()} AND market = '{m}') AS n_{m}" for m in ("ETF", "ETN", "KOSDAQ", "KOSPI")) + """
 FROM prices p LEFT JOIN master m ON m.symbol = p.symbol, goal WHERE p.base_date BETWEEN d - 30 AND d AND p.base_date IN (SELECT base_date FROM open_days) GROUP BY 1),
newest AS (SELECT * FROM per_day ORDER BY base_date DESC LIMIT 10),
sel AS (SELECT max(base_date) FILTER (WHERE n >= 22) AS d FROM newest)"""


@query("latest_valid_price_date", f"""WITH {_VALID_DAY}
SELECT sel.d AS selected_price_base_date, coalesce((SELECT n FROM newest WHERE base_date = sel.d), 0) AS valid_rows_count,
 coalesce((SELECT concat_ws(',', CASE WHEN n_ETF > 0 THEN 'ETF:' || n_ETF END, CASE WHEN n_ETN > 0 THEN 'ETN:' || n_ETN END, CASE WHEN n_KOSDAQ > 0 THEN 'KOSDAQ:' || n_KOSDAQ END,
   CASE WHEN n_KOSPI > 0 THEN 'KOSPI:' || n_KOSPI END) FROM newest WHERE base_date = sel.d), '') AS market_counts,
 coalesce((SELECT string_agg(base_date::VARCHAR || '=' || n, ';' ORDER BY base_date DESC) FROM newest WHERE sel.d IS NULL OR base_date > sel.d), '') AS rejected_dates
FROM sel""", "selected_price_base_date")
def latest_valid_price_date(L):
    return rk.latest_valid_price_date(L.prices_raw, L.master, L.open_days, TARGET, 10, MIN_VALID)


def valid_day(L):
    return latest_valid_price_date(L).select("selected_price_base_date")


def broker(L):
    """Broker volume rows: one per symbol and day of the two broker sources."""
    return px.clean_panel(L.prices_raw.where(F.col("source").isin("KIS", "KIS_DETAIL")), L.open_days).select(
        "symbol", "base_date", "volume", "trading_value", "market_cap", (200 / F.col("close_price")).alias("change_rate"), "source")


_BROKER = """broker AS (SELECT * FROM panel WHERE source IN ('KIS', 'KIS_DETAIL')),
cls AS (SELECT b.*, m.market, m.name FROM broker b JOIN master m ON m.symbol = b.symbol WHERE m.market IS NOT NULL)"""


@query("rank_classify_volume", f"""WITH {_BROKER}
SELECT base_date, market, symbol, name, volume, trading_value, rank FROM (SELECT *, row_number() OVER (PARTITION BY base_date, market ORDER BY volume DESC, trading_value DESC, symbol) AS rank FROM cls)
WHERE rank <= {_LIM}""", "base_date")
def rank_classify_volume(L):
    return rk.top_broker(rk.classify_volume(broker(L), L.master), "volume", LIMITS).select("base_date", "market", "symbol", "name", "volume", "trading_value", "rank")


@query("topk_trading_value", f"""WITH {_BROKER}
SELECT base_date, market, symbol, trading_value, rank FROM (SELECT *, row_number() OVER (PARTITION BY base_date, market ORDER BY trading_value DESC, volume DESC, symbol) AS rank FROM cls)
WHERE rank <= {_LIM}""", "base_date")
def topk_trading_value(L):
    return rk.top_broker(rk.classify_volume(broker(L), L.master), "trading_value", LIMITS).select("base_date", "market", "symbol", "trading_value", "rank")


_PRICED = f"""{_VALID_DAY}, {_BROKER},
cand AS (SELECT p.symbol, p.base_date, m.market, m.name, volume, trading_value, market_cap, unnest(['volume', 'trading_value', 'market_cap']) AS rank_type, unnest([volume, trading_value, market_cap]) AS metric_value
 FROM panel p JOIN master m ON m.symbol = p.symbol WHERE m.market IS NOT NULL AND base_date BETWEEN $T - 10 AND $T),
cand2 AS (SELECT * FROM cand WHERE metric_value IS NOT NULL),
day AS (SELECT market, rank_type, coalesce(max(base_date) FILTER (WHERE base_date = (SELECT d FROM sel)), max(base_date)) AS base_date FROM cand2 GROUP BY 1, 2),
priced AS (SELECT * FROM (SELECT c.*, row_number() OVER (PARTITION BY c.market, c.rank_type ORDER BY metric_value DESC, coalesce(trading_value, 0) DESC, symbol) AS rank,
  CASE WHEN c.market IN ('ETF', 'ETN') AND c.base_date = $T THEN 'KRX' ELSE 'VALID_PRICE_FALLBACK' END AS source FROM cand2 c JOIN day d ON d.market = c.market AND d.rank_type = c.rank_type AND d.base_date = c.base_date)
 WHERE rank <= {_LIM})"""


def priced(L):
    return rk.price_based(panel(L), L.master, valid_day(L), TARGET, LIMITS)


@query("rank_price_based", f"""WITH {_PRICED}
SELECT $T AS base_date, market, rank_type, rank, symbol, name, metric_value, source, base_date AS source_base_date FROM priced""", "base_date source_base_date", "metric_value")
def rank_price_based(L):
    return priced(L).select("base_date", "market", "rank_type", "rank", "symbol", "name", "metric_value", "source", "source_base_date")


_SELECT = f"""today AS (SELECT * FROM cls WHERE base_date = $T),
brk AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY market ORDER BY volume DESC, trading_value DESC, symbol) AS rank FROM today) WHERE rank <= {_LIM}),
repl AS (SELECT DISTINCT market FROM priced WHERE rank_type = 'volume' AND market IN ('ETF', 'ETN')
  AND market NOT IN (SELECT market FROM today GROUP BY 1 HAVING count(*) >= CASE market WHEN 'ETF' THEN 3 ELSE 1 END)),
vol AS (SELECT 'volume' AS rank_type, market, rank, symbol, volume AS metric_value, 'KIS' AS source, $T AS source_base_date FROM brk WHERE market NOT IN (SELECT market FROM repl)
 UNION ALL SELECT 'volume', market, rank, symbol, metric_value, source, base_date FROM priced WHERE rank_type = 'volume' AND market IN (SELECT market FROM repl))"""


@query("rank_select_volume", f"WITH {_PRICED}, {_SELECT} SELECT rank_type, market, rank, symbol, metric_value, source, source_base_date FROM vol", "source_base_date")
def rank_select_volume(L):
    rows = rk.select_volume(rk.classify_volume(broker(L), L.master), priced(L), TARGET, THRESHOLDS, LIMITS)
    return rows.select("rank_type", "market", "rank", "symbol", "metric_value", "source", "source_base_date")


_READY = """ready AS (SELECT m.market, count(*) >= CASE m.market WHEN 'KOSPI' THEN 1 ELSE 100 END AS ok FROM panel p JOIN master m ON m.symbol = p.symbol
 WHERE base_date = $T AND m.market IN ('KOSPI', 'KOSDAQ') GROUP BY 1),
caps AS (SELECT p.* FROM priced p LEFT JOIN ready r ON r.market = p.market WHERE rank_type = 'market_cap' AND (p.market IN ('ETF', 'ETN') OR (coalesce(r.ok, false) AND p.base_date = $T)))"""


@query("rank_market_cap_gate", f"WITH {_PRICED}, {_READY} SELECT market, rank, symbol, metric_value, base_date AS source_base_date FROM caps", "source_base_date", "metric_value")
def rank_market_cap_gate(L):
    rows = rk.market_cap_gate(priced(L), rk.market_ready(panel(L), L.master, TARGET, READY), TARGET)
    return rows.select("market", "rank", "symbol", "metric_value", "source_base_date")


_DAILY = f"""{_PRICED}, {_SELECT}, {_READY},
landed AS (SELECT 'volume' AS rank_type, market, rank, symbol, name, volume, trading_value, 200 / close_price AS change_rate, volume AS metric_value FROM brk WHERE market NOT IN (SELECT market FROM repl)
 UNION ALL SELECT 'trading_value', market, rank, symbol, name, volume, trading_value, 200 / close_price, trading_value FROM (SELECT *, row_number() OVER (PARTITION BY market ORDER BY trading_value DESC, volume DESC, symbol) AS rank
   FROM today WHERE market IN ('KOSPI', 'KOSDAQ')) WHERE rank <= 30),
from_prices AS (SELECT *, 'kis_volume_sparse' AS fallback_reason, (SELECT count(*) FROM today t WHERE t.market = p.market) AS original_kis_count FROM priced p WHERE rank_type = 'volume' AND market IN (SELECT market FROM repl)
 UNION ALL SELECT *, NULL, NULL FROM priced WHERE rank_type = 'trading_value' AND market IN ('ETF', 'ETN') UNION ALL SELECT *, NULL, NULL FROM caps),
daily AS (SELECT rank_type, market, rank, symbol, name, volume, trading_value, NULL::DOUBLE AS market_cap, change_rate, metric_value, 'KIS' AS source, $T AS source_base_date,
  NULL AS price_base_date, NULL AS fallback_reason, NULL AS original_kis_count, volume AS response_volume, symbol AS response_symbol FROM landed
 UNION ALL SELECT rank_type, market, rank, symbol, name, volume, trading_value, market_cap, NULL, metric_value, source, base_date, base_date, fallback_reason, original_kis_count, NULL, NULL FROM from_prices)"""


def daily_rankings(L):
    return rk.build_daily(panel(L), broker(L), L.master, valid_day(L), TARGET, THRESHOLDS, LIMITS, READY)


@query("rank_build_daily", f"""WITH {_DAILY}
SELECT $T AS base_date, d.* EXCLUDE (original_kis_count), CAST(original_kis_count AS VARCHAR) AS original_kis_count, $T + INTERVAL 7 HOUR AS available_at, market AS master_market,
 CASE WHEN market IN ('ETF', 'ETN') THEN market ELSE 'STOCK' END AS master_asset_type, source_base_date AS raw_source_base_date, $T AS ranking_base_date FROM daily d""",
       "base_date source_base_date price_base_date raw_source_base_date ranking_base_date available_at", "metric_value change_rate")
def rank_build_daily(L):
    """Every column, the JSON detail key by key."""
    raw = lambda path, name: F.get_json_object("raw_data", f"$.{path}").alias(name)
    return daily_rankings(L).select(
        "base_date", "rank_type", "market", "rank", "symbol", "name", "volume", "trading_value", "market_cap", "change_rate", "metric_value", "source", "source_base_date", "available_at",
        raw("price_base_date", "price_base_date"), raw("fallback_reason", "fallback_reason"), raw("original_kis_count", "original_kis_count"), raw("master_market", "master_market"),
        raw("master_asset_type", "master_asset_type"), raw("source_base_date", "raw_source_base_date"), raw("ranking_base_date", "ranking_base_date"),
        raw("response_row.volume", "response_volume").cast("double").alias("response_volume"), raw("response_row.symbol", "response_symbol"))


@query("rank_simple_fallback", """
SELECT base_date, symbol, market, rank, trading_value AS metric_value FROM (SELECT p.*, m.market, row_number() OVER (PARTITION BY base_date ORDER BY trading_value DESC, p.symbol) AS rank
 FROM panel p JOIN master m ON m.symbol = p.symbol AND m.market = 'ETF') WHERE rank <= 20""", "base_date")
def rank_simple_fallback(L):
    return rk.simple_fallback(panel(L), L.master, "ETF", "trading_value", 20).select("base_date", "symbol", "market", "rank", "metric_value")


@query("rank_persist_verified", f"""
SELECT base_date, market, rank_type, rank, symbol, source, metric_value FROM (SELECT r.* EXCLUDE (rank, symbol), s AS symbol, row_number() OVER (PARTITION BY base_date, r.market, rank_type
   ORDER BY r.rank, s, source, metric_value) AS rank FROM (SELECT *, {_Q} AS s FROM rankings) r JOIN master m ON m.symbol = r.s AND m.market = r.market) WHERE rank <= 30""", "base_date")
def rank_persist_verified(L):
    rows = rk.verified(L.rankings, L.master, 30, ["raw_rank", "symbol", "source", "metric_value"])
    return rows.select("base_date", "market", "rank_type", "rank", "symbol", "source", "metric_value")


# ---- universe ---------------------------------------------------------------

_RANKED = f"ranked AS (SELECT DISTINCT m.symbol, m.name, m.market FROM (SELECT *, {_Q} AS s FROM rankings WHERE base_date = (SELECT max(base_date) FROM rankings)) r JOIN master m ON m.symbol = r.s AND m.market = r.market)"
_REPORT = f"""report AS (SELECT m.symbol, any_value(m.name) AS name, max(coalesce(m.market, r.market)) AS market FROM (SELECT *, {_Q} AS s FROM rankings WHERE source = 'KIS' AND base_date = (SELECT max(base_date) FROM rankings WHERE source = 'KIS')) r
 JOIN master m ON m.symbol = r.s GROUP BY 1)"""
_LIVE = "live AS (SELECT DISTINCT m.symbol, m.name, m.market FROM panel b JOIN master m ON m.symbol = b.symbol WHERE b.source IN ('KIS', 'KIS_DETAIL') AND b.base_date = $T)"
_DETAIL = f"""{_REPORT}, {_LIVE}, parts AS (SELECT symbol, name, market, 'static' AS category, 0 AS part FROM static_universe WHERE enabled UNION ALL SELECT *, 'kis_volume_rank', 1 FROM live UNION ALL SELECT *, 'report_rank', 2 FROM report),
combined AS (SELECT symbol, arg_min(name, part) FILTER (WHERE name IS NOT NULL) AS name, arg_min(market, part) FILTER (WHERE market IS NOT NULL) AS market, string_agg(DISTINCT category, ',' ORDER BY category) AS source_category FROM parts GROUP BY 1)"""


def live_rows(L):
    return broker(L).where(F.col("base_date") == F.lit(TARGET))


@query("universe_latest_ranked", f"WITH {_RANKED} SELECT *, 'ranking' AS category FROM ranked")
def universe_latest_ranked(L):
    return un.latest_ranked(L.rankings, L.master)


@query("universe_latest_broker_ranked", f"WITH {_REPORT} SELECT *, 'report_rank' AS category FROM report")
def universe_latest_broker_ranked(L):
    return un.latest_broker_ranked(L.rankings, L.master)


@query("universe_live_volume", f"WITH {_LIVE} SELECT *, 'kis_volume_rank' AS category FROM live")
def universe_live_volume(L):
    return un.live_volume(live_rows(L), L.master)


def combined(L):
    return un.union_sources([un.static_members(L.static_universe), un.live_volume(live_rows(L), L.master), un.latest_broker_ranked(L.rankings, L.master)])


@query("union_universe_sources", f"WITH {_DETAIL} SELECT * FROM combined")
def union_universe_sources(L):
    return combined(L)


_PRIO = "CASE WHEN source_category LIKE '%static%' THEN 0 WHEN source_category LIKE '%kis_volume_rank%' THEN 3 ELSE 4 END"


@query("topk_universe", f"WITH {_DETAIL} SELECT symbol, source_category, {_PRIO} AS priority FROM combined ORDER BY priority, symbol LIMIT 300", ints="priority")
def topk_universe(L):
    return un.top_universe(combined(L)).select("symbol", "source_category", "priority")


@query("universe_detail", f"WITH {_DETAIL} SELECT symbol, name, market, source_category FROM combined ORDER BY {_PRIO}, symbol LIMIT 300")
def universe_detail(L):
    return un.detail_universe(L.static_universe, L.rankings, live_rows(L), L.master).select("symbol", "name", "market", "source_category")


@query("universe_source_counts", f"""WITH {_DETAIL} SELECT count(*) FILTER (WHERE source_category LIKE '%static%') AS static, 0 AS manual, 0 AS ranking,
 count(*) FILTER (WHERE source_category LIKE '%kis_volume_rank%') AS kis_volume_rank, count(*) FILTER (WHERE source_category LIKE '%report_rank%') AS report_rank FROM combined""", ints="manual ranking")
def universe_source_counts(L):
    return un.source_counts(combined(L))


def listing(L, where: str):
    return L.table("supplier").where(where).join(
        L.master.withColumnRenamed("symbol", "m_symbol"), F.format_string("%06d", "s_suppkey") == F.col("m_symbol")
    ).select(F.col("s_suppkey").cast("string").alias("code"), "name", "market", "s_acctbal")


@query("universe_full_listing", """
WITH src AS (SELECT symbol, name, market, s_acctbal FROM master WHERE market IN ('KOSPI', 'KOSDAQ')),
pick AS (SELECT CASE WHEN (SELECT count(*) FROM src WHERE s_acctbal > 5000) >= 30 THEN 0 WHEN (SELECT count(*) FROM src WHERE s_acctbal > 0) >= 30 THEN 1 ELSE 2 END AS attempt)
SELECT symbol, name, market, attempt FROM src, pick WHERE s_acctbal > CASE attempt WHEN 0 THEN 5000 WHEN 1 THEN 0 ELSE -100000 END""", ints="attempt")
def universe_full_listing(L):
    return un.full_listing([listing(L, "s_acctbal > 5000"), listing(L, "s_acctbal > 0"), listing(L, "true")], 30)


def raw_supply(L):
    """Landed flow payloads: one JSON text per line with its market code."""
    c = F.col
    code = F.when(c("l_returnflag") == "A", "J").when(c("l_returnflag") == "R", "Q")
    payload = F.to_json(F.struct(code.alias("market_div_code"), F.struct(c("l_quantity").alias("frgn_ntby_qty")).alias("response_row")))
    return L._lines.select(c("code").alias("symbol"), "base_date", payload.alias("raw_data"))


_FLOW = """flow AS (SELECT code AS symbol, arg_max(CASE l_returnflag WHEN 'A' THEN 'KOSPI' ELSE 'KOSDAQ' END, (base_date, CASE l_returnflag WHEN 'A' THEN 'KOSPI' ELSE 'KOSDAQ' END)) AS supply_market
 FROM lines WHERE l_returnflag IN ('A', 'R') GROUP BY 1)"""


@query("infer_market_from_supply_raw", f"WITH {_FLOW} SELECT * FROM flow")
def infer_market_from_supply_raw(L):
    return un.supply_market(raw_supply(L))


@query("universe_canonicalise", f"""WITH {_FLOW},
u AS (SELECT symbol, name, market AS m0 FROM master WHERE s_acctbal > 3000),
s1 AS (SELECT u.symbol, coalesce(l.name, u.name) AS name, CASE WHEN m0 IN ('ETF', 'ETN') THEN m0 WHEN l.market IN ('ETF', 'ETN') THEN l.market ELSE coalesce(m0, l.market) END AS m1
 FROM u LEFT JOIN (SELECT * FROM master WHERE s_acctbal > 5000) l ON l.symbol = u.symbol),
s2 AS (SELECT s1.symbol, name, coalesce(m1, 'KOSPI') AS m2, supply_market FROM s1 LEFT JOIN flow ON flow.symbol = s1.symbol)
SELECT symbol, name, m2 AS market, CASE WHEN m2 IN ('ETF', 'ETN') THEN m2 ELSE 'STOCK' END AS asset_type FROM s2""")
def universe_canonicalise(L):
    c = F.col
    rows = L.table("supplier").where("s_acctbal > 3000").join(L.master.withColumnRenamed("symbol", "m_symbol"), F.format_string("%06d", "s_suppkey") == c("m_symbol"))
    spelled = F.explode(F.array(F.concat(F.lit("Q"), c("m_symbol")), c("s_suppkey").cast("string")))
    universe = rows.select(spelled.alias("symbol"), "name", "market").withColumn("seq", F.length("symbol"))
    listed = listing(L, "s_acctbal > 5000").withColumn("symbol", normalize_symbol(c("code")))
    return un.canonicalise(universe, listed, un.supply_market(raw_supply(L)))


def report_rows(L):
    """Watchlist snapshot rows with a data status."""
    from ..operators import signals as sg

    return sg.watchlist_view(L.static_universe, panel(L), L.calendar, TARGET)


_REPORT_VIEW = """opened AS (SELECT base_date AS od FROM open_days),
wv AS (SELECT u.symbol, p.base_date, CASE WHEN p.base_date IS NULL THEN 'MISSING' WHEN (SELECT count(*) FROM opened WHERE od BETWEEN p.base_date AND $T) - 1 <= 0 THEN 'FRESH'
  WHEN (SELECT count(*) FROM opened WHERE od BETWEEN p.base_date AND $T) - 1 <= 3 THEN 'STALE_BUT_USABLE' ELSE 'STALE' END AS data_status, p.close_price
 FROM static_universe u LEFT JOIN (SELECT symbol, max(base_date) AS base_date, arg_max(close_price, base_date) AS close_price FROM panel WHERE base_date <= $T GROUP BY 1) p ON p.symbol = u.symbol WHERE enabled)"""


_ALIGN = f"""{_REPORT_VIEW},
w AS (SELECT symbol FROM static_universe WHERE enabled), det AS (SELECT symbol FROM snapshots WHERE base_date = $T AND source = 'KIS_DETAIL'),
dp AS (SELECT DISTINCT symbol FROM prices WHERE base_date = $T AND source = 'KIS_DETAIL'), ft AS (SELECT DISTINCT {_Q} AS symbol FROM features WHERE base_date = $T AND symbol <> 'GLOBAL'),
vr AS (SELECT DISTINCT {_Q} AS symbol FROM rankings WHERE base_date = $T AND source = 'KIS' AND rank_type = 'volume'),
bad AS (SELECT symbol, 'missing_in_detail' AS problem FROM w WHERE symbol NOT IN (SELECT symbol FROM det) UNION ALL SELECT symbol, 'missing_in_feature' FROM w WHERE symbol NOT IN (SELECT symbol FROM ft)
 UNION ALL SELECT symbol, 'missing_in_report_view' FROM w WHERE symbol NOT IN (SELECT symbol FROM wv) UNION ALL SELECT DISTINCT symbol, 'stale_in_report_view' FROM wv WHERE data_status LIKE 'STALE%' AND symbol IN (SELECT symbol FROM w))"""


@query("universe_alignment", f"""WITH {_ALIGN},
r AS (SELECT (SELECT count(*) FROM w) AS static_enabled_count, (SELECT count(*) FROM det) AS detail_universe_count, (SELECT count(*) FROM dp) AS detail_price_symbols_count, (SELECT count(*) FROM ft) AS feature_symbol_count,
 (SELECT count(DISTINCT symbol) FROM wv) AS report_watchlist_count, (SELECT count(*) FROM vr) AS volume_symbol_count, """ + ", ".join(
    f"(SELECT count(*) FROM bad WHERE problem = '{p}') AS {p}" for p in ("missing_in_detail", "missing_in_feature", "missing_in_report_view", "stale_in_report_view")) + """)
SELECT *, CASE WHEN missing_in_detail > 0 THEN 'FAIL_STATIC_WATCHLIST_MISSING' WHEN missing_in_feature + missing_in_report_view + stale_in_report_view > 0 THEN 'WARN_UNIVERSE_MISMATCH' ELSE 'SUCCESS' END AS status FROM r""")
def universe_alignment(L):
    return un.alignment(L.static_universe, L.snapshots, L.prices_raw, L.features, report_rows(L), L.rankings, TARGET)


@query("universe_alignment_symbols", f"WITH {_ALIGN} SELECT symbol, problem FROM bad")
def universe_alignment_symbols(L):
    return un.alignment_symbols(L.static_universe, L.snapshots, L.prices_raw, L.features, report_rows(L), L.rankings, TARGET)


# ---- master -----------------------------------------------------------------


def existing_master(L):
    """Every other symbol is known already."""
    return L.master.where("cast(symbol as int) % 2 = 0").select("symbol", "name", "market", "asset_type", "is_active")


@query("norm_master_record", """
SELECT symbol, name, market, CASE WHEN market IN ('ETF', 'ETN') THEN market ELSE 'STOCK' END AS asset_type,
 CASE WHEN symbol IN (SELECT symbol FROM static_universe WHERE enabled) THEN true WHEN symbol::INT % 2 = 0 THEN is_active ELSE false END AS is_active FROM master WHERE market IS NOT NULL""")
def norm_master_record(L):
    rows = listing(L, "true").where("market is not null").select(F.col("code").alias("symbol"), "name", "market")
    kind = F.when(F.col("market").isin(*mk.ETP_MARKETS), F.col("market")).otherwise("STOCK")
    return un.master_record(rows, kind, existing_master(L), L.static_universe.where("enabled"))


def listing_parts(L):
    """Stock, ETF and ETN listings; the ETF listing repeats some stock codes."""
    base = L.master.select("symbol", "name", "market", "asset_type", "is_active")
    stock = base.withColumn("market", F.coalesce("market", F.lit("KOSPI"))).where("market in ('KOSPI', 'KOSDAQ')")
    etf = base.where("market = 'ETF' or (market = 'KOSPI' and is_active)").withColumns({"market": F.lit("ETF"), "asset_type": F.lit("ETF")})
    etn = base.where("market = 'ETN'")
    return [etf, stock, etn]


_PARTS = """parts AS (SELECT symbol, name, 'ETF' AS market, 'ETF' AS asset_type, is_active, 0 AS part FROM master WHERE market = 'ETF' OR (market = 'KOSPI' AND is_active)
 UNION ALL SELECT symbol, name, coalesce(market, 'KOSPI'), asset_type, is_active, 1 FROM master WHERE coalesce(market, 'KOSPI') IN ('KOSPI', 'KOSDAQ')
 UNION ALL SELECT symbol, name, market, asset_type, is_active, 2 FROM master WHERE market = 'ETN'),
merged AS (SELECT * EXCLUDE (rn, part) FROM (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY market IN ('ETF', 'ETN') DESC, part DESC) AS rn FROM parts) WHERE rn = 1)"""


@query("dedupe_master_union", f"WITH {_PARTS} SELECT * FROM merged")
def dedupe_master_union(L):
    return un.merge_listings(listing_parts(L))


@query("master_sync_listing", f"""WITH {_PARTS} SELECT count(*) FILTER (WHERE market = 'KOSPI') AS kospi, count(*) FILTER (WHERE market = 'KOSDAQ') AS kosdaq, count(*) FILTER (WHERE market = 'ETF') AS etf,
 count(*) FILTER (WHERE market = 'ETN') AS etn, (SELECT count(*) FROM parts) - count(*) AS duplicates FROM merged""")
def master_sync_listing(L):
    parts = listing_parts(L)
    merged = un.merge_listings(parts)
    total = agg.stack(parts).agg(F.count(F.lit(1)).alias("n"))
    counts = merged.agg(*[F.count_if(F.col("market") == m).alias(m.lower()) for m in mk.MASTER_MARKETS], F.count(F.lit(1)).alias("merged"))
    return counts.select("kospi", "kosdaq", "etf", "etn", (total.scalar() - F.col("merged")).alias("duplicates"))


def file_rows(L):
    """The watchlist file: symbol text, name, market and an enabled flag."""
    return listing(L, "s_acctbal > 7500").select(F.concat(F.lit("Q"), F.format_string("%06d", F.col("code").cast("long"))).alias("symbol"), "name", "market", (F.col("s_acctbal") < 9000).alias("enabled"))


_FILE = "file AS (SELECT symbol, name, coalesce(market, 'KOSPI') AS market, CASE WHEN market IN ('ETF', 'ETN') THEN market ELSE 'STOCK' END AS asset_type, s_acctbal < 9000 AS enabled FROM master WHERE s_acctbal > 7500)"


@query("master_sync_static", f"""WITH {_FILE} SELECT symbol, name, market, asset_type, is_active FROM master WHERE symbol NOT IN (SELECT symbol FROM static_universe) AND symbol NOT IN (SELECT symbol FROM file)
UNION ALL SELECT symbol, name, market, asset_type, true FROM file WHERE enabled""")
def master_sync_static(L):
    return un.sync_static(L.master, L.static_universe, file_rows(L))


@query("set_difference", f"WITH {_FILE} SELECT symbol FROM static_universe WHERE symbol NOT IN (SELECT symbol FROM file)")
def set_difference(L):
    return L.static_universe.select("symbol").exceptAll(px.canonical(file_rows(L)).select("symbol"))


@query("master_sync_universe", f"""WITH {_DETAIL} SELECT symbol, name, coalesce(market, 'KOSPI') AS market, CASE WHEN market IN ('ETF', 'ETN') THEN market ELSE 'STOCK' END AS asset_type,
 symbol IN (SELECT symbol FROM master WHERE is_active) AS is_active FROM combined""")
def master_sync_universe(L):
    return un.sync_universe(combined(L).withColumn("seq", F.lit(0)), L.master)


@query("master_deactivate_missing", """
SELECT symbol, name, market, is_active AND NOT (market IS NOT NULL AND s_acctbal <= 5000 AND symbol NOT IN (SELECT symbol FROM static_universe WHERE enabled)) AS is_active FROM master""")
def master_deactivate_missing(L):
    current = px.canonical(listing(L, "s_acctbal > 5000").withColumnRenamed("code", "symbol"))
    return un.deactivate_missing(L.master, current, L.static_universe.where("enabled")).select("symbol", "name", "market", "is_active")


_ETF_REQ = f"""{_FILE}, req AS (SELECT symbol FROM static_universe WHERE enabled AND market = 'ETF' UNION SELECT symbol FROM file WHERE enabled AND market = 'ETF'),
req2 AS (SELECT symbol FROM req UNION ALL SELECT unnest(['396500', '305720']) WHERE NOT EXISTS (SELECT 1 FROM req)),
tgt AS (SELECT symbol FROM req2 UNION SELECT {_Q} FROM rankings WHERE market = 'ETF' AND base_date = (SELECT max(base_date) FROM rankings WHERE market = 'ETF'))"""


def etf_targets(L):
    return un.etf_targets(un.required_etfs(L.static_universe, file_rows(L)), L.rankings)


@query("etf_required_universe", f"WITH {_ETF_REQ} SELECT symbol FROM tgt")
def etf_required_universe(L):
    return etf_targets(L)


_ETF_COV = f"""{_ETF_REQ}, g AS (SELECT max(base_date) AS d FROM open_days WHERE base_date <= $T),
seen AS (SELECT symbol, max(base_date) AS latest_date FROM prices, g WHERE close_price IS NOT NULL AND volume IS NOT NULL AND trading_value IS NOT NULL AND base_date BETWEEN d - 10 AND d GROUP BY 1),
cov AS (SELECT t.symbol, latest_date, CASE WHEN latest_date IS NULL THEN 'missing' WHEN latest_date = d THEN 'covered' ELSE 'stale' END AS coverage FROM tgt t CROSS JOIN g LEFT JOIN seen s ON s.symbol = t.symbol)"""


@query("etf_coverage", f"WITH {_ETF_COV} SELECT * FROM cov", "latest_date")
def etf_coverage(L):
    return un.etf_coverage(etf_targets(L), L.prices_raw, L.open_days, TARGET)


@query("snapshot_repair_candidates", """
SELECT m.symbol, p.symbol IS NOT NULL AS has_price, p.symbol IS NOT NULL AS price_updatable, s.foreign_holding_ratio IS NULL AS needs_supply_ratio
FROM master m LEFT JOIN (SELECT * FROM panel WHERE base_date = $T) p ON p.symbol = m.symbol LEFT JOIN (SELECT * FROM supply WHERE base_date = $T) s ON s.symbol = m.symbol
WHERE is_active AND (p.market_cap IS NULL OR p.outstanding_shares IS NULL OR s.foreign_holding_ratio IS NULL)""")
def snapshot_repair_candidates(L):
    return un.snapshot_repair_candidates(L.master, panel(L), L.supply, TARGET)


@query("incremental_start", """
SELECT w.series_id, latest, coalesce(latest + 1, DATE '2010-01-01') AS start_date, coalesce(latest + 1, DATE '2010-01-01') > DATE '2001-07-31' AS skip
FROM (SELECT DISTINCT CASE o_orderpriority WHEN '1-URGENT' THEN 'KR_GOVT_10Y' WHEN '2-HIGH' THEN 'KR_CD_91D' ELSE 'USDKRW' END AS series_id FROM orders) w
LEFT JOIN (SELECT series_id, max(base_date) AS latest FROM macro_series GROUP BY 1) s ON s.series_id = w.series_id""", "latest start_date")
def incremental_start(L):
    from datetime import date

    c = F.col("o_orderpriority")
    wanted = L.table("orders").select(F.when(c == "1-URGENT", "KR_GOVT_10Y").when(c == "2-HIGH", "KR_CD_91D").otherwise("USDKRW").alias("series_id")).distinct()
    return un.incremental_start(wanted, L.macro_series, date(2001, 7, 31))


@query("full_price_skip_gate", f"""WITH {_VALID_DAY} SELECT sel.d AS latest_date, count(p.symbol) AS valid_stock_rows, count(p.symbol) >= 5 AS skip FROM sel LEFT JOIN (SELECT p.symbol, base_date FROM prices_raw p
 JOIN master m ON m.symbol = p.symbol AND m.market IN ('KOSPI', 'KOSDAQ') WHERE close_price IS NOT NULL AND volume IS NOT NULL AND trading_value IS NOT NULL) p ON p.base_date = sel.d GROUP BY 1""", "latest_date")
def full_price_skip_gate(L):
    return un.full_price_skip(L.prices_raw, L.master, valid_day(L), 5)


@query("union_all_stack", " UNION ALL ".join(f"SELECT '{t}' AS table_name, base_date, count(*) AS row_count FROM {t} GROUP BY 2" for t in ("prices_raw", "supply", "shorts", "rankings")), "base_date")
def union_all_stack(L):
    tables = {"prices_raw": L.prices_raw, "supply": L.supply, "shorts": L.shorts, "rankings": L.rankings}
    return agg.stack([df.groupBy("base_date").agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(n).alias("table_name"), "base_date", "row_count") for n, df in tables.items()])
