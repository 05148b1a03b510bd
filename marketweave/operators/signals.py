"""Signal scoring and the tables behind the daily report."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import markets as mk
from . import calendar as cal

# Weights and thresholds of the signal.
WEIGHTS = {"price": 0.3, "supply": 0.25, "macro": 0.2, "derivatives": 0.15, "event": 0.1}
BUY_ABOVE, SELL_BELOW = 0.5, -0.2
USABLE_STALE_DAYS = 3
SIGNAL_FEATURES = ("moving_avg_5", "moving_avg_20", "foreign_flow_zscore", "usdkrw_momentum", "risk_on_off_score", "basis_signal", "event_score")


def components(wide: DataFrame) -> DataFrame:
    """Score parts from one row per symbol-day; inputs nobody produced default to 0."""
    have = set(wide.columns)
    f = lambda name: F.col(name) if name in have else F.lit(None).cast("double")
    zero = lambda name: F.coalesce(f(name), F.lit(0.0))
    fast, slow, flow = f("moving_avg_5"), f("moving_avg_20"), f("foreign_flow_zscore")
    return wide.withColumns({
        "price": F.when(fast > slow, 0.8).when(fast <= slow, -0.5).otherwise(0.0),
        "supply": F.when(flow >= 1, 0.9).when(flow <= -1, -0.9).otherwise(0.0),
        "macro": F.when(zero("usdkrw_momentum") > 0.02, -0.5).when(zero("risk_on_off_score") > 0, 0.5).otherwise(0.0),
        "derivatives": zero("basis_signal"),
        "event": zero("event_score"),
    })


def score(parts: DataFrame) -> DataFrame:
    total = sum((F.lit(w) * F.col(name) for name, w in list(WEIGHTS.items())[1:]), F.lit(WEIGHTS["price"]) * F.col("price"))
    signal = F.when(F.col("total_score") > BUY_ABOVE, "BUY").when(F.col("total_score") < SELL_BELOW, "SELL").otherwise("HOLD")
    return parts.withColumn("total_score", total).withColumn("signal", signal)


def top5(scored: DataFrame, names: DataFrame, n: int = 5) -> DataFrame:
    """Best scores of a date with name and flow z-score."""
    best = scored.orderBy(F.desc("total_score"), "symbol").limit(n)
    return best.join(names.select("symbol", "name"), "symbol", "left").select(
        "symbol", F.coalesce("name", "symbol").alias("name"), "total_score", "signal", F.coalesce("foreign_flow_zscore", F.lit(0.0)).alias("foreign_flow_zscore")
    )


def focus(symbols: DataFrame, scored: DataFrame) -> DataFrame:
    """Trend, flow and comment text of chosen symbols."""
    zero = lambda name: F.coalesce(F.col(name), F.lit(0.0))
    known = F.col("signal").isNotNull()
    text = lambda cond, yes, no: F.when(known, F.when(cond, yes).otherwise(no)).otherwise("insufficient data")
    return symbols.join(scored, "symbol", "left").select(
        "symbol", "signal", "total_score",
        text(zero("moving_avg_5") > zero("moving_avg_20"), "short average above long (positive)", "short average not above long (cautious)").alias("trend"),
        text(zero("foreign_flow_zscore") > 0, "foreign buying ahead", "foreign selling ahead").alias("flow"),
        text(F.col("signal") == "BUY", "raise the position", "stay cautious").alias("comment"),
    )


def data_status(stale_days: Column) -> Column:
    return F.when(stale_days.isNull(), "MISSING").when(stale_days <= 0, "FRESH").when(stale_days <= USABLE_STALE_DAYS, "STALE_BUT_USABLE").otherwise("STALE")


def _with_latest(symbols: DataFrame, panel: DataFrame, calendar: DataFrame, target, values: list[str]) -> DataFrame:
    row = F.max_by(F.struct(*values), "base_date")
    newest = panel.where(F.col("base_date") <= F.lit(target)).groupBy("symbol").agg(F.max("base_date").alias("latest_date"), row.alias("r"))
    return cal.stale_days(symbols.join(newest, "symbol", "left"), calendar, target)


def watchlist_view(static_universe: DataFrame, panel: DataFrame, calendar: DataFrame, target) -> DataFrame:
    """Enabled watchlist symbols with their newest price and how fresh it is."""
    rows = _with_latest(static_universe.where("enabled").select("symbol"), panel, calendar, target, ["close_price"])
    stale = F.when(F.col("latest_date").isNotNull(), F.col("stale_days"))
    return rows.select("symbol", F.col("latest_date").alias("base_date"), F.col("r.close_price").alias("close_price"), data_status(stale).alias("data_status"))


def sector_etf_view(master: DataFrame, computed: DataFrame, calendar: DataFrame, target) -> DataFrame:
    """ETF rows: newest price date, staleness, returns and value ratio."""
    values = ["close_price", "return_5d", "return_20d", "trading_value_ratio_20d"]
    rows = _with_latest(master.where(F.col("market") == "ETF").select("symbol", "name"), computed, calendar, target, values)
    stale = F.when(F.col("latest_date").isNotNull(), F.col("stale_days"))
    return rows.select("symbol", "name", F.col("latest_date").alias("latest_price_date"), stale.alias("stale_days"), *[F.col(f"r.{v}").alias(v) for v in values], data_status(stale).alias("data_status"))
