"""Table rewrites: each takes a whole table and returns it repaired.

Tables are keyed, so a canonical key gathers at most its plain row and its
Q-prefixed row; grouping by it aggregates before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import markets as mk
from ..functions.symbols import is_q_symbol, normalize_symbol
from . import joins as jn, prices as px

_PRICE_COLUMNS = ("open_price", "high_price", "low_price", "close_price", "volume", "trading_value")
# Name patterns of listed products.
ETF_PATTERNS = ("KODEX", "TIGER", "RISE", "ACE", "PLUS", "SOL", "HANARO", "KOSEF", "TIMEFOLIO")


def _spelled(df: DataFrame) -> DataFrame:
    plain = ~is_q_symbol(F.col("symbol"))
    return df.withColumns({"plain": plain, "symbol": normalize_symbol(F.col("symbol"))})


def canonical_prices(prices: DataFrame) -> DataFrame:
    """The better of the plain and the Q-prefixed row per canonical key; cap, shares and availability fill from the other.

    Score: 1e9 for a complete row, plus value, plus volume in millions. The plain row wins ties.
    """
    zero = lambda n: F.coalesce(n, F.lit(0.0))
    score = F.when(px.complete_row(), 1e9).otherwise(0.0) + zero("trading_value") + zero("volume") / F.lit(1e6)
    body = F.struct(*_PRICE_COLUMNS, "market_cap", "outstanding_shares", "available_at")
    kept = lambda n: F.max(F.when(F.col("plain"), F.col(n))).alias(f"c_{n}")
    fills = ("market_cap", "outstanding_shares", "available_at")
    best = _spelled(prices).withColumn("score", score).groupBy("symbol", "base_date").agg(F.max_by(body, F.struct("score", "plain")).alias("b"), *[kept(n) for n in fills])
    return best.select("symbol", "base_date", *[F.col(f"b.{n}").alias(n) for n in _PRICE_COLUMNS], *[F.coalesce(f"b.{n}", f"c_{n}").alias(n) for n in fills])


def canonical_fill(df: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """Nulls of the plain row are filled from the Q-prefixed row; a lone Q row is renamed."""
    side = lambda n, yes: F.max(F.when(F.col("plain") if yes else ~F.col("plain"), F.col(n)))
    return _spelled(df).groupBy(*keys).agg(*[F.coalesce(side(n, True), side(n, False)).alias(n) for n in columns])


def canonical_raw(df: DataFrame, keys: list[str]) -> DataFrame:
    """A Q row takes the canonical name where that key is free, else it goes."""
    others = [c for c in df.columns if c not in keys]
    row = F.max_by(F.struct(*others), F.struct("plain", *others))
    return _spelled(df).groupBy(*keys).agg(row.alias("r")).select(*keys, "r.*")


def _master_market(master: DataFrame) -> DataFrame:
    return master.where(F.col("market").isin(*mk.MASTER_MARKETS)).select("symbol", F.col("market").alias("master_market"))


def ranking_market(rankings: DataFrame, master: DataFrame) -> DataFrame:
    """Ranking market set to the master market; KOSPI200 rows and unknown symbols keep theirs."""
    joined = rankings.join(_master_market(master), "symbol", "left")
    market = F.when(F.col("market") == "KOSPI200", F.col("market")).otherwise(F.coalesce("master_market", "market"))
    return joined.withColumn("market", market).drop("master_market")


def legacy_rankings(rankings: DataFrame, master: DataFrame) -> DataFrame:
    """Without Q rows, broker value and cap ranks, and rows of another market than the master's."""
    legacy = is_q_symbol(F.col("symbol")) | ((F.col("source") == "KIS") & F.col("rank_type").isin("trading_value", "market_cap"))
    joined = rankings.where(~legacy).join(_master_market(master), "symbol", "left")
    wrong = F.col("market").isin(*mk.MASTER_MARKETS) & (F.col("market") != F.col("master_market"))
    return joined.where(~F.coalesce(wrong, F.lit(False))).drop("master_market")


def _flag_invalid(prices: DataFrame, master: DataFrame, calendar: DataFrame) -> DataFrame:
    listed = _master_market(master).select("symbol", F.lit(True).alias("listed"))
    dated = jn.calendar_status(prices, calendar).join(listed, "symbol", "left").withColumns({
        "listed": F.col("listed").isNotNull(), "zero": F.coalesce(F.col("close_price") <= 0, F.lit(True)), "bare": px.no_source()})
    drop = F.col("listed") & (F.col("zero") | F.col("bare") | (F.col("day_status") == "closed"))
    return dated.withColumn("dropped", drop)


def invalid_prices(prices: DataFrame, master: DataFrame, calendar: DataFrame) -> DataFrame:
    """Without invalid or closed-day rows of listed symbols; a day the calendar lacks is kept."""
    return _flag_invalid(prices, master, calendar).where(~F.col("dropped")).select(*prices.columns)


def invalid_price_counts(prices: DataFrame, master: DataFrame, calendar: DataFrame) -> DataFrame:
    """Counts before and after the clean-up, from one pass."""
    rows = _flag_invalid(prices, master, calendar).where("listed")
    checks = {"zero_or_null_close_rows": F.col("zero"), "null_source_rows": F.col("bare"), "confirmed_non_trading_day_rows": F.col("day_status") == "closed", "calendar_missing_rows": F.col("day_status") == "missing"}
    phase = F.explode(F.when(F.col("dropped"), F.array(F.lit("before"))).otherwise(F.array(F.lit("before"), F.lit("after"))))
    return rows.withColumn("phase", phase).groupBy("phase").agg(*[F.count_if(cond).alias(n) for n, cond in checks.items()])


def snapshot_only(prices: DataFrame) -> DataFrame:
    return prices.where(~px.snapshot_only())


def closed_day_rankings(rankings: DataFrame, calendar: DataFrame, since, until=None, markets: tuple = mk.MASTER_MARKETS) -> DataFrame:
    """Rankings of listed markets dated on a closed day (manual overrides aside) go; older rows stay."""
    day = F.col("calendar_date")
    closed = calendar.where((F.col("exchange_code") == "XKRX") & ~F.col("is_open") & (F.coalesce("source", F.lit("")) != "manual_override") & (day >= F.lit(since).cast("date")))
    closed = closed if until is None else closed.where(day <= F.lit(until).cast("date"))
    marked = rankings.join(F.broadcast(closed.select(day.alias("base_date"), F.lit(True).alias("is_closed"))), "base_date", "left")
    return marked.where(F.col("is_closed").isNull() | ~F.col("market").isin(*markets)).drop("is_closed")


def reopened_day(calendar: DataFrame, exchange: str, day) -> DataFrame:
    """Manual override of one day to open."""
    hit = (F.col("exchange_code") == exchange) & (F.col("calendar_date") == F.lit(day).cast("date"))
    return calendar.withColumns({
        "is_open": F.col("is_open") | hit, "reason": F.when(hit, "manual_override_trading_day").otherwise(F.col("reason")), "source": F.when(hit, "manual_override").otherwise(F.col("source"))})


def drop_day_prices(prices: DataFrame, master: DataFrame, day) -> DataFrame:
    """Rows of one day without positive volume and value go, for listed symbols."""
    listed = _master_market(master).select("symbol", F.lit(True).alias("listed"))
    idle = (F.coalesce("volume", F.lit(0)) <= 0) | (F.coalesce("trading_value", F.lit(0)) <= 0)
    marked = prices.join(listed, "symbol", "left")
    return marked.where(~((F.col("base_date") == F.lit(day).cast("date")) & F.col("listed").isNotNull() & idle)).drop("listed")


def _stale_fallback(day) -> Column:
    return (F.col("base_date") == F.lit(day).cast("date")) & F.col("market").isin(*mk.STOCK_MARKETS) & (F.col("source") == "VALID_PRICE_FALLBACK")


def stale_fallback_report(rankings: DataFrame, day) -> DataFrame:
    """Fallback rankings of a date for stock markets, by the price date they came from."""
    stored = F.get_json_object("raw_data", "$.price_base_date").try_cast("date")
    return rankings.where(_stale_fallback(day)).groupBy("base_date", "market", "rank_type", "source", F.coalesce("source_base_date", stored).alias("effective_source_base_date")).agg(F.count(F.lit(1)).alias("row_count"))


def drop_stale_fallback(rankings: DataFrame, day) -> DataFrame:
    return rankings.where(~_stale_fallback(day))


def reclassify_intraday(rows: DataFrame, series: str = "KOSPI", limit_pct: float = 20.0) -> DataFrame:
    """INVALID broker rows whose landed value is positive become OK; the JSON detail notes why.

    The detail is rebuilt without ``raw_value``; other known entries are kept.
    """
    raw = F.get_json_object("quality_detail", "$.raw_value").try_cast("double")
    change = F.col("change_rate")
    hit = F.coalesce(
        (F.col("series_id") == series) & (F.col("source") == "KIS") & (F.col("quality_flag") == "INVALID") & (raw > 0) & (F.abs(F.coalesce(change, F.lit(0.0))) <= limit_pct), F.lit(False))
    reason = F.when(change.isNull(), "INVALID_RANGE_RULE_NO_CHANGE_RATE").otherwise("INVALID_RANGE_RULE")
    detail = F.to_json(F.struct(F.get_json_object("quality_detail", "$.yahoo_fallback_val").try_cast("double").alias("yahoo_fallback_val"), reason.alias("reclassified_from")))
    return rows.withColumns({
        "value": F.when(hit, raw).otherwise(F.col("value")), "quality_detail": F.when(hit, detail).otherwise(F.col("quality_detail")), "quality_flag": F.when(hit, "OK").otherwise(F.col("quality_flag"))})


def asset_type(master: DataFrame) -> DataFrame:
    """Asset type of rows still unset or STOCK from market and name; ETF/ETN is copied to the market."""
    market, name = F.upper(F.coalesce("market", F.lit(""))), F.upper(F.coalesce("name", F.lit("")))
    etf = (market == "ETF") | name.contains("ETF") | name.rlike("^(" + "|".join(ETF_PATTERNS) + ")")
    derived = F.when(etf, "ETF").when((market == "ETN") | name.contains("ETN"), "ETN").otherwise("STOCK")
    unset = F.col("asset_type").isNull() | (F.col("asset_type") == "STOCK")
    typed = master.withColumn("asset_type", F.when(unset, derived).otherwise(F.col("asset_type")))
    return typed.withColumn("market", F.when(F.col("asset_type").isin(*mk.ETP_MARKETS), F.col("asset_type")).otherwise(F.col("market")))
