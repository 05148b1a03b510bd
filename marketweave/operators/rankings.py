"""Valid price dates and per-market rankings of a target date."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from ..functions.markets import ETP_MARKETS, MASTER_MARKETS, STOCK_MARKETS
from ..functions.times import available_at
from . import prices as px, windows as win

# Sizes of the daily rankings and their readiness thresholds.
VOLUME_THRESHOLDS = {"KOSPI": 20, "KOSDAQ": 20, "ETF": 10, "ETN": 5}
RANKING_LIMITS = {"KOSPI": 30, "KOSDAQ": 30, "ETF": 20, "ETN": 20}
READY_THRESHOLDS = {"KOSPI": 700, "KOSDAQ": 1200}
RANK_TYPES = ("volume", "trading_value", "market_cap")
# Fixed value: why an ETF/ETN volume ranking comes from prices.
SPARSE_BROKER = "kis_volume_sparse"


def _counts_text(markets: tuple = MASTER_MARKETS) -> Column:
    """``KOSDAQ:2,KOSPI:3`` of the n_<market> columns above 0."""
    parts = [F.when(F.col(f"n_{m}") > 0, F.concat(F.lit(f"{m}:"), F.col(f"n_{m}").cast("string"))) for m in sorted(markets)]
    return F.concat_ws(",", *parts)


def latest_valid_price_date(
    prices: DataFrame, master: DataFrame, open_days: DataFrame, target: date, lookback_days: int = 10, min_valid_rows: int = 100
) -> DataFrame:
    """One row: newest open date with enough valid rows among the newest ``lookback_days`` dates, and the rejected ones.

    One aggregate over the span replaces a scan per candidate date; what remains
    is at most one row per calendar day of the span.
    """
    goal = open_days.where(F.col("base_date") <= F.lit(target)).agg(F.max("base_date").alias("d"))
    span = max(lookback_days * 3, 14)
    rows = prices.where((F.col("base_date") <= goal.scalar()) & (F.col("base_date") >= F.date_sub(goal.scalar(), span)))
    marked = px.on_open_days(px.canonical(rows), open_days).join(master.select("symbol", "market"), "symbol", "left")
    ok = px.valid_row()
    per_day = marked.groupBy("base_date").agg(
        F.count_if(ok).alias("valid_rows_count"), *[F.count_if(ok & (F.col("market") == m)).alias(f"n_{m}") for m in MASTER_MARKETS]
    )
    newest = per_day.orderBy(F.desc("base_date")).limit(lookback_days)
    good = F.when(F.col("valid_rows_count") >= min_valid_rows, F.col("base_date"))
    row = F.struct("base_date", "valid_rows_count", _counts_text().alias("market_counts"))
    picked = newest.agg(F.max(good).alias("selected"), F.collect_list(row).alias("days"))
    of_day = F.get(F.filter("days", lambda d: d["base_date"] == F.col("selected")), F.lit(0))
    rejected = F.reverse(F.array_sort(F.filter("days", lambda d: F.col("selected").isNull() | (d["base_date"] > F.col("selected")))))
    text = F.transform(rejected, lambda d: F.concat_ws("=", d["base_date"].cast("string"), d["valid_rows_count"].cast("string")))
    return picked.select(
        F.col("selected").alias("selected_price_base_date"),
        F.coalesce(of_day["valid_rows_count"], F.lit(0)).alias("valid_rows_count"),
        F.coalesce(of_day["market_counts"], F.lit("")).alias("market_counts"),
        F.array_join(text, ";").alias("rejected_dates"),
    )


def classify_volume(broker_rows: DataFrame, master: DataFrame) -> DataFrame:
    """Broker volume rows that fit their master market and asset type; others are dropped."""
    fits = (F.col("market").isin(*STOCK_MARKETS) & (F.col("asset_type") == "STOCK")) | (
        F.col("market").isin(*ETP_MARKETS) & (F.col("asset_type") == F.col("market"))
    )
    listed = master.where(fits).select("symbol", "market", "asset_type", "name")
    landed = px.canonical(broker_rows).drop("market", "asset_type")
    if "name" not in landed.columns:
        return landed.join(listed, "symbol")
    named = landed.withColumnRenamed("name", "landed_name").join(listed, "symbol")
    return named.withColumn("name", _named("name", "landed_name")).drop("landed_name")


def _named(*columns: str) -> Column:
    """The first name that isn't blank."""
    return F.coalesce(*[F.when(F.col(c) != "", F.col(c)) for c in columns])


def _ordered(first: str, second: str) -> list[Column]:
    return [F.coalesce(first, F.lit(0)).desc(), F.coalesce(second, F.lit(0)).desc(), F.col("symbol")]


def top_broker(classified: DataFrame, metric: str = "volume", limits: dict | None = None, keys: tuple = ("base_date", "market")) -> DataFrame:
    """Top rows per market by (volume, value), or by (value, volume) of rows with a value."""
    other = "trading_value" if metric == "volume" else "volume"
    rows = classified if metric == "volume" else classified.where(F.col(metric).isNotNull())
    return win.rank_by(rows, list(keys), _ordered(metric, other), limits or RANKING_LIMITS).withColumn("metric_value", F.col(metric))


def price_candidates(prices: DataFrame, master: DataFrame, start, end) -> DataFrame:
    """Valid rows of listed markets, one row per metric that has a value."""
    rows = px.canonical(prices.where(F.col("base_date").between(F.lit(start), F.lit(end)) & px.valid_row()))
    asset_type = F.col("asset_type") if "asset_type" in master.columns else F.lit(None).cast("string")
    listed = master.where(F.col("market").isin(*MASTER_MARKETS)).select("symbol", "market", asset_type.alias("asset_type"), "name")
    metrics = F.array(*[F.struct(F.lit(t).alias("rank_type"), F.col(t).cast("double").alias("metric_value")) for t in RANK_TYPES])
    return rows.join(listed, "symbol").select(
        "symbol", "base_date", "market", "asset_type", "name", "volume", "trading_value", "market_cap", F.inline(metrics)
    ).where(F.col("metric_value").isNotNull())


def price_based(
    prices: DataFrame, master: DataFrame, global_date: DataFrame, target: date, limits: dict | None = None, lookback_days: int = 10
) -> DataFrame:
    """Top rows per (market, rank_type) on the global price date, else on the market's newest date with candidates.

    Each date is cut to its top rows first, in one scan; the date is then chosen
    among those few rows.
    """
    rows = price_candidates(prices, master, target - timedelta(days=lookback_days), target)
    order = [F.desc("metric_value"), F.coalesce("trading_value", F.lit(0)).desc(), F.col("symbol")]
    ranked = win.rank_by(rows, ["market", "rank_type", "base_date"], order, limits or RANKING_LIMITS)
    group = Window.partitionBy("market", "rank_type")
    on_global = F.max(F.when(F.col("base_date") == global_date.scalar(), F.col("base_date"))).over(group)
    picked = ranked.withColumn("day", F.coalesce(on_global, F.max("base_date").over(group))).where(F.col("base_date") == F.col("day")).drop("day")
    on_target = F.col("market").isin(*ETP_MARKETS) & (F.col("base_date") == F.lit(target))
    return picked.withColumns({
        "source_base_date": F.col("base_date"),
        "source": F.when(on_target, "KRX").otherwise("VALID_PRICE_FALLBACK"),
        "base_date": F.lit(target),
    })


_OUT = ("base_date", "market", "rank_type", "rank", "symbol", "name", "volume", "trading_value", "market_cap", "change_rate", "metric_value", "source", "source_base_date")
_DETAIL = ("asset_type", "response_row")
_LANDED = ("symbol", "volume", "trading_value", "change_rate")


def _response(rows: DataFrame) -> Column:
    """JSON text of the landed row: the column ``response_row`` (JSON text or a nested value), else the row's own figures."""
    if "response_row" not in rows.columns:
        return F.to_json(F.struct(*_LANDED))
    given = F.col("response_row")
    return given if isinstance(rows.schema["response_row"].dataType, T.StringType) else F.to_json(given)


def broker_rankings(classified: DataFrame, target: date, limits: dict, need: dict) -> DataFrame:
    """Broker rows of the date ranked by volume, and for stock markets by value, in one scan.

    Kept down to the larger of limit and density threshold. ``change_rate`` and
    ``response_row`` are optional in ``classified``; a broker row has no market_cap.
    """
    today = classified.where(F.col("base_date") == F.lit(target))
    rate = F.col("change_rate") if "change_rate" in today.columns else F.lit(None)
    today = today.withColumns({"change_rate": rate.cast("double"), "market_cap": F.lit(None).cast("double")})
    given = [c for c in ("response_row",) if c in today.columns]
    by_value = F.when(F.col("market").isin(*STOCK_MARKETS), F.col("trading_value"))
    kinds = F.array(*[F.struct(F.lit(t).alias("rank_type"), v.alias("metric_value"), o.alias("second")) for t, v, o in (
        ("volume", F.col("volume"), F.col("trading_value")), ("trading_value", by_value, F.col("volume")))])
    rows = today.select("base_date", "market", "asset_type", "symbol", "name", "volume", "trading_value", "market_cap", "change_rate", *given, F.inline(kinds))
    rows = rows.where((F.col("rank_type") == "volume") | F.col("metric_value").isNotNull())
    depth = {m: max(limits[m], need[m]) for m in limits}
    ranked = win.rank_by(rows, ["market", "rank_type"], _ordered("metric_value", "second"), depth)
    return ranked.withColumns({"source": F.lit("KIS"), "source_base_date": F.lit(target), "response_row": _response(ranked)}).select(*_OUT, *_DETAIL)


def _by_market(values: dict) -> Column:
    out = F.lit(None).cast("int")
    for market, value in values.items():
        out = F.when(F.col("market") == market, value).otherwise(out)
    return out


def choose(broker: DataFrame, priced: DataFrame, limits: dict, need: dict) -> DataFrame:
    """Broker or price rows per (market, type), from the few ranked rows of both.

    Volume: stock markets keep broker rows; an ETF/ETN market below its threshold
    takes price rows if it has any. Value: broker rows for stock markets, price rows
    for ETF/ETN. Cap: price rows. ``original_kis_count`` is the number of broker rows that
    a sparse market had.
    """
    absent = {"change_rate": F.lit(None).cast("double"), "response_row": F.lit(None).cast("string")}
    both = broker.withColumn("priced", F.lit(False)).unionByName(priced.withColumns(absent).select(*_OUT, *_DETAIL).withColumn("priced", F.lit(True)))
    market, volume = Window.partitionBy("market"), F.col("rank_type") == "volume"
    landed = F.coalesce(F.max(F.when(volume & ~F.col("priced"), F.col("rank"))).over(market), F.lit(0))
    dense = F.coalesce(landed >= _by_market(need), F.lit(False))
    has_price = F.max(volume & F.col("priced")).over(market)
    stock = F.col("market").isin(*STOCK_MARKETS)
    use_price = F.when(volume, ~stock & ~dense & has_price).when(F.col("rank_type") == "trading_value", ~stock).otherwise(F.lit(True))
    fallen = volume & F.col("priced")
    marked = both.withColumns({
        "use_price": use_price, "fallback_reason": F.when(fallen, SPARSE_BROKER), "original_kis_count": F.when(fallen, landed)})
    return marked.where((F.col("priced") == F.col("use_price")) & (F.col("rank") <= _by_market(limits))).drop("use_price")


def select_volume(classified: DataFrame, fallback: DataFrame, target: date, thresholds: dict | None = None, limits: dict | None = None) -> DataFrame:
    """Volume ranking per market: broker rows, replaced by price rows for a sparse ETF/ETN market that has any."""
    need, top = thresholds or VOLUME_THRESHOLDS, limits or RANKING_LIMITS
    return choose(broker_rankings(classified, target, top, need), fallback, top, need).where(F.col("rank_type") == "volume")


def market_ready(prices: DataFrame, master: DataFrame, target: date, thresholds: dict | None = None) -> DataFrame:
    """Valid stock rows of the target date per market against its threshold; one row per stock market."""
    need = thresholds or READY_THRESHOLDS
    stock = master.where(F.col("market").isin(*STOCK_MARKETS) & (F.col("asset_type") == "STOCK")).select("symbol", "market")
    rows = px.canonical(prices.where((F.col("base_date") == F.lit(target)) & px.valid_row())).join(stock, "symbol")
    counts = rows.agg(*[F.count_if(F.col("market") == m).alias(m) for m in STOCK_MARKETS])
    gates = F.array(*[F.struct(F.lit(m).alias("market"), F.col(m).alias("valid_rows"), F.lit(need[m]).cast("long").alias("threshold")) for m in STOCK_MARKETS])
    return counts.select(F.inline(gates)).withColumn("ready", F.col("valid_rows") >= F.col("threshold"))


def market_cap_gate(priced: DataFrame, ready: DataFrame, target: date) -> DataFrame:
    """Market-cap rows: ETP markets as they are, stock markets only when ready and priced on the target."""
    rows = priced.where(F.col("rank_type") == "market_cap")
    gate = F.broadcast(ready.select("market", "ready"))
    stock_ok = F.coalesce("ready", F.lit(False)) & (F.col("source_base_date") == F.lit(target))
    return rows.join(gate, "market", "left").where(F.col("market").isin(*ETP_MARKETS) | stock_ok).drop("ready")


def build_daily(
    prices: DataFrame, broker_rows: DataFrame, master: DataFrame, global_date: DataFrame, target: date,
    thresholds: dict | None = None, limits: dict | None = None, ready_thresholds: dict | None = None,
) -> DataFrame:
    """All rankings of a date: four markets by volume, value and capitalisation.

    ``raw_data`` is the JSON detail of a row: the landed row of a broker ranking; the
    price date, and what made it fall back, of a price ranking.
    """
    need, top = thresholds or VOLUME_THRESHOLDS, limits or RANKING_LIMITS
    broker = broker_rankings(classify_volume(broker_rows, master), target, top, need)
    chosen = choose(broker, price_based(prices, master, global_date, target, top), top, need)
    gate = F.broadcast(market_ready(prices, master, target, ready_thresholds).select("market", "ready"))  # two rows
    stock_ok = F.coalesce("ready", F.lit(False)) & (F.col("source_base_date") == F.lit(target))
    cap_ok = (F.col("rank_type") != "market_cap") | F.col("market").isin(*ETP_MARKETS) | stock_ok
    rows = chosen.join(gate, "market", "left").where(cap_ok)
    return rows.select(
        *[_named("name", "symbol").alias("name") if c == "name" else F.col(c) for c in _OUT],
        available_at(F.col("base_date")).alias("available_at"), _detail().alias("raw_data"),
    )


def _detail() -> Column:
    shared = [
        F.col("market").alias("master_market"), F.col("asset_type").alias("master_asset_type"),
        "source_base_date", F.col("base_date").alias("ranking_base_date"),
    ]
    landed = F.struct(F.try_parse_json(F.col("response_row")).alias("response_row"), *shared)
    priced = F.struct(F.col("source_base_date").alias("price_base_date"), "fallback_reason", "original_kis_count", *shared)
    text = lambda row: F.to_json(row, {"ignoreNullFields": "false"})  # noqa: E731  absent values are written as null
    return F.when(F.col("priced"), text(priced)).otherwise(text(landed))


def raw_rankings(rows: DataFrame) -> DataFrame:
    """The rows of :func:`build_daily` as raw rankings: the JSON detail under the rank that it was given."""
    return rows.select("source", "base_date", "market", "rank_type", "symbol", "name", F.col("rank").cast("long").alias("raw_rank"), "raw_data", "available_at")


def simple_fallback(prices: DataFrame, master: DataFrame, market: str, metric: str, limit: int) -> DataFrame:
    """Rank the valid rows of one market by one metric, per date."""
    listed = master.where(F.col("market") == market).select("symbol", "market", "name")
    rows = prices.where(px.valid_row() & F.col(metric).isNotNull()).join(listed, "symbol")
    return win.rank_by(rows, ["base_date"], [F.desc(metric), F.col("symbol")], limit).withColumn("metric_value", F.col(metric))


def verified(rankings: DataFrame, master: DataFrame, limit: int, order: list[str]) -> DataFrame:
    """Rows whose master market is the ranking market (KOSPI200 exempt), renumbered in payload order."""
    listed = master.select("symbol", F.col("market").alias("master_market"), F.col("name").alias("master_name"))
    rows = px.canonical(rankings).join(listed, "symbol").where((F.col("market") == "KOSPI200") | (F.col("master_market") == F.col("market")))
    return win.rank_by(rows.withColumnRenamed("rank", "raw_rank"), ["base_date", "market", "rank_type"], [F.col(c) for c in order], limit)
