"""Daily jobs over stored tables: gate, compute, rewrite the touched partitions, log.

Only one-row decisions (open or closed, ready or not, the effective date) come to
the driver; rows stay in Spark from scan to write.
"""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..operators import calendar as cal, features as feat, macro as mc, rankings as rk
from ..schemas import KEYS, SCHEMAS
from ..sources import tables as tb


class Store:
    """Stored tables under one root, each partitioned by its day."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def read(self, table: str) -> DataFrame:
        return tb.read(self.spark, self.path(table), SCHEMAS[table])

    def state(self, tables: list[str], target: date) -> DataFrame:
        """Newest date, rows, rows of the target and lag of the named tables, without reading their rows."""
        return tb.stored_state(self.spark, {t: self.path(t) for t in tables}, target)

    def upsert(self, table: str, rows: DataFrame, order: list, partition: str = "base_date") -> None:
        tb.upsert_table(self.spark, self.path(table), table, rows, order, partition)

    def overwrite(self, table: str, rows: DataFrame, partition: str = "base_date") -> None:
        tb.store(tb.align_schema(rows, SCHEMAS[table]), self.path(table), partition)

    def overwrite_counted(self, table: str, rows: DataFrame, flag: str, partition: str = "base_date") -> int:
        """Overwrites as above; the number of written rows where the extra column ``flag`` is true."""
        typed = tb.align_schema(rows, T.StructType([*SCHEMAS[table].fields, T.StructField(flag, T.BooleanType())]))
        return tb.store_counted(typed, flag, self.path(table), partition)

    def log(self, job: str, target: date, status: str, processed: int, message: str = "") -> None:
        rows = self.spark.range(1).select(*tb.run_log(F.lit(job), F.lit(target), F.lit(status), F.lit(processed), F.lit(message)))
        tb.append_run_log(self.spark, self.path("pipeline_run_logs"), rows)


def market_gate(store: Store, target: date, exchange: str = "XKRX") -> tuple[bool, str]:
    """Whether a job must skip the date, and why; one row."""
    day = store.spark.range(1).select(F.lit(target).alias("calendar_date"))
    row = cal.gate(cal.diagnostic(day, store.read("market_trading_calendar"), exchange)).first()
    return row["skip"], row["gate_reason"]


def open_days(store: Store, start: date, end: date) -> DataFrame:
    return cal.between(store.read("market_trading_calendar"), start, end).withColumnRenamed("calendar_date", "base_date")


def feature_job(store: Store, universe: DataFrame, master: DataFrame, wide_macro: DataFrame, target: date, minimum: int = 100) -> str:
    """Features of the target's effective date; the recomputed slice of that date is replaced.

    The log has the rows that this run made, not those that the date held before.
    """
    skip, _ = market_gate(store, target)
    prices = store.read("normalized_stock_prices_daily")
    ready = feat.readiness_gate(prices, master, target, full_minimum=minimum).first()["status"] == "READY"
    if not skip and not ready:
        store.log("daily_feature_generator", target, "SKIPPED_INSUFFICIENT_PRICE_DATA", 0)
        return "SKIPPED_INSUFFICIENT_PRICE_DATA"
    days = open_days(store, target - timedelta(days=feat.LOOKBACK_DAYS), target)
    supply = store.read("normalized_stock_supply_daily")
    day = feat.effective_day(prices, days, target).first()["effective_date"]
    if day is None:
        store.log("daily_feature_generator", target, "WARN", 0, "no tradable date in the look-back")
        return "WARN"
    stock = feat.stock_features(prices, supply, days, universe, target, day=day)
    rows = feat.union_features(stock, *feat.macro_features(wide_macro, store.read("normalized_macro_series"), target, day))
    old = store.read("feature_store_daily").where(F.col("base_date") == F.lit(day))
    kept = old.where(~((F.col("symbol") != "GLOBAL") & F.col("feature_name").isin(*feat.STOCK_FEATURES)))
    made = tb.align_schema(rows, SCHEMAS["feature_store_daily"]).withColumn("made", F.lit(True))
    merged = tb.upsert(kept.withColumn("made", F.lit(False)), made, KEYS["feature_store_daily"])
    written = store.overwrite_counted("feature_store_daily", merged, "made")
    status = "SUCCESS" if written else "WARN"
    store.log("daily_feature_generator", target, status, written)
    return status


def ranking_job(store: Store, broker_rows: DataFrame, master: DataFrame, target: date, min_valid_rows: int = 100, ready_thresholds: dict | None = None) -> str:
    """All rankings of a date; each (date, market, type) slice of the job is replaced across sources, empty ones included.

    Rows of other markets and types of the date, such as index members, stay.
    """
    skip, reason = market_gate(store, target)
    if skip:
        store.log("daily_ranking_pipeline", target, "SKIPPED_MARKET_CLOSED", 0, reason)
        return "SKIPPED_MARKET_CLOSED"
    prices = store.read("normalized_stock_prices_daily")
    days = open_days(store, target - timedelta(days=60), target)
    valid = rk.latest_valid_price_date(prices, master, days, target, min_valid_rows=min_valid_rows).select("selected_price_base_date")
    rows = rk.build_daily(prices, broker_rows, master, valid, target, ready_thresholds=ready_thresholds).persist()  # some hundred rows
    made = _replace_rankings(store, "normalized_market_rankings_daily", rows, target)
    _replace_rankings(store, "raw_market_rankings", rk.raw_rankings(rows), target)
    rows.unpersist()
    ready = rk.market_ready(prices, master, target, ready_thresholds).agg(F.min("ready").alias("all_ready")).first()["all_ready"]
    status = "SUCCESS" if ready else "SKIPPED_INSUFFICIENT_PRICE_DATA"
    store.log("daily_ranking_pipeline", target, status, made)
    return status


def _replace_rankings(store: Store, table: str, rows: DataFrame, target: date) -> int:
    """Replaces the job's slices of the date in one table; the number of rows it wrote."""
    own = F.col("market").isin(*rk.MASTER_MARKETS) & F.col("rank_type").isin(*rk.RANK_TYPES)
    others = store.read(table).where((F.col("base_date") == F.lit(target)) & ~F.coalesce(own, F.lit(False)))
    fresh = tb.align_schema(rows, SCHEMAS[table]).withColumn("made", F.lit(True))
    merged = others.withColumn("made", F.lit(False)).unionByName(fresh).persist()
    try:
        if merged.isEmpty():
            tb.clear(store.spark, store.path(table), SCHEMAS[table], "base_date", target)
            return 0
        return store.overwrite_counted(table, merged, "made")
    finally:
        merged.unpersist()


def calendar_job(store: Store, date_range: DataFrame, schedule: DataFrame, overrides: DataFrame, exchanges: list[str]) -> None:
    """Calendar of a period per exchange, manual overrides applied; days outside the period stay."""
    rows = cal.apply_overrides(cal.build(date_range, schedule, exchanges), overrides)
    store.upsert("market_trading_calendar", rows, [F.col("is_open").desc(), F.col("reason")], "exchange_code")


def macro_snapshot(store: Store, days: DataFrame, wide: DataFrame, index_quotes: DataFrame, fx_quotes: DataFrame, flows: DataFrame, rates: tuple) -> DataFrame:
    """Wide macro rows of the wanted days from stored series and landed quotes; US closed days carried forward."""
    series = store.read("normalized_macro_series")
    direct, kr10y, us10y, us3y = rates
    rows = mc.snapshot(
        days, wide, mc.index_resolve(index_quotes), mc.fx_resolve(days, series, fx_quotes), mc.rate_fallback(days, series, direct, kr10y, us10y, us3y), flows)
    return mc.carry_us_closed(rows, store.read("market_trading_calendar"))
