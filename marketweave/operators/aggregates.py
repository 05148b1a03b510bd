"""Counts, health panels and market breadth."""

from __future__ import annotations

from datetime import date, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import dealt
from . import joins, prices as px


def stack(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def counts_by_source(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows per (section, source, date) of each table's latest date."""
    return stack([
        joins.latest(df).groupBy("source", "base_date").agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(section).alias("section"), "source", "base_date", "row_count")
        for section, df in tables.items()
    ])


def feature_summary(features: DataFrame) -> DataFrame:
    return joins.latest(features).groupBy("base_date").agg(
        F.count(F.lit(1)).alias("total_feature_rows"),
        F.count_distinct("symbol").alias("symbol_count"),
        F.count_distinct("feature_name").alias("feature_name_count"),
    )


def market_counts(prices: DataFrame, master: DataFrame) -> DataFrame:
    """Valid rows per (date, stock market) and the date's total."""
    stock = master.where(F.col("market").isin("KOSPI", "KOSDAQ") & (F.col("asset_type") == "STOCK")).select("symbol", "market")
    rows = px.canonical(prices.where(px.valid_row())).join(stock, "symbol")
    return rows.groupBy("base_date").agg(
        F.count_if(F.col("market") == "KOSPI").alias("kospi_rows"),
        F.count_if(F.col("market") == "KOSDAQ").alias("kosdaq_rows"),
        F.count(F.lit(1)).alias("total_rows"),
    )


def series_stats(df: DataFrame, key: str, day: str = "base_date") -> DataFrame:
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n"), F.min(day).alias("first_date"), F.max(day).alias("last_date"))


def pipeline_health(logs: DataFrame, target, days: int = 7) -> DataFrame:
    recent = F.col("target_date").between(F.date_sub(F.lit(target).cast("date"), days), F.lit(target).cast("date"))
    return logs.where(recent).groupBy("target_date", "job_name", "status").agg(
        F.count(F.lit(1)).alias("occurrences"), F.max("records_processed").alias("max_records_processed")
    )


def latest_run(logs: DataFrame) -> DataFrame:
    """Newest log row per job; the run id breaks ties."""
    row = F.max_by(F.struct("run_id", "target_date", "status", "records_processed", "error_message"), F.struct("target_date", "run_id"))
    return logs.groupBy("job_name").agg(row.alias("r")).select("job_name", "r.*")


def recent_runs_document(logs: DataFrame, jobs: list[str], n: int = 10) -> DataFrame:
    """The newest ``n`` runs of chosen jobs as one ordered JSON list."""
    newest = logs.where(F.col("job_name").isin(*jobs)).orderBy(F.desc("target_date"), F.desc("run_id")).limit(n)
    item = F.struct("target_date", "run_id", "job_name", "status", "records_processed")
    return newest.agg(F.to_json(F.sort_array(F.collect_list(item), asc=False)).alias("recent_runs"))


def rank_distribution(rankings: DataFrame, master: DataFrame, group: str) -> DataFrame:
    """Ranking rows per (master market, asset type); unmatched rows are UNKNOWN."""
    listed = master.select("symbol", F.col("market").alias("m"), F.col("asset_type").alias("a"))
    return px.canonical(rankings).join(listed, "symbol", "left").groupBy(
        group, F.coalesce("m", F.lit("UNKNOWN")).alias("master_market"), F.coalesce("a", F.lit("UNKNOWN")).alias("asset_type")
    ).agg(F.count(F.lit(1)).alias("n"))


def price_coverage(prices: DataFrame, master: DataFrame, minimum: int = 2000) -> DataFrame:
    """Distinct covered symbols on the latest date, in total and per market."""
    listed = master.where(F.col("market").isin("KOSPI", "KOSDAQ")).select("symbol", "market")
    rows = joins.latest(prices).join(listed, "symbol")
    covered = F.count_distinct("symbol")
    per = lambda m: F.count_distinct(F.when(F.col("market") == m, F.col("symbol")))
    return rows.groupBy("base_date").agg(
        covered.alias("covered_symbols"), per("KOSPI").alias("kospi_covered"), per("KOSDAQ").alias("kosdaq_covered"),
        F.count_if(F.col("close_price").isNull()).alias("null_close_rows"),
    ).withColumn("full_market_coverage_pass", F.col("covered_symbols") > minimum)


# The sources of ranking rows.
RANK_SOURCES = ("KIS", "KIS_DETAIL", "KRX", "VALID_PRICE_FALLBACK")


def latest_rank_counts(rankings: DataFrame) -> DataFrame:
    """Rows of the latest date by source; sources without a column of their own count as OTHER."""
    rows = joins.latest(rankings).withColumn("source", F.when(F.col("source").isin(*RANK_SOURCES), F.col("source")).otherwise("OTHER"))
    return rows.groupBy("base_date", "market", "rank_type").pivot("source", [*RANK_SOURCES, "OTHER"]).agg(F.count(F.lit(1))).na.fill(0)


def market_crosstab(rankings: DataFrame, master: DataFrame) -> DataFrame:
    """Ranking market against master market over the whole table."""
    listed = master.select("symbol", F.coalesce("market", F.lit("UNKNOWN")).alias("master_market"))
    return px.canonical(rankings).join(listed, "symbol").groupBy("market").pivot(
        "master_market", ["KOSPI", "KOSDAQ", "ETF", "ETN", "UNKNOWN"]
    ).agg(F.count(F.lit(1))).na.fill(0)


def _breadth(day: Column, diff: Column, volume: Column, df: DataFrame) -> DataFrame:
    return df.groupBy(day).agg(
        F.count_if(diff > 0).alias("advances"),
        F.count_if(diff < 0).alias("declines"),
        F.count_if(diff == 0).alias("unchanged"),
        F.coalesce(F.sum(F.when(diff > 0, volume)), F.lit(0)).alias("advancing_volume"),
        F.coalesce(F.sum(F.when(diff < 0, volume)), F.lit(0)).alias("declining_volume"),
    )


def market_breadth(prices: DataFrame, valid_day: DataFrame, target: date, lookback_days: int = 10) -> DataFrame:
    """Close on the valid date against each symbol's last earlier close inside the look-back.

    ``prices`` holds one row per symbol and day; ``valid_day`` is one row (base_date).
    Volumes are cut to whole numbers.
    """
    goal = valid_day.select("base_date")
    rows = prices.where(F.col("close_price").isNotNull() & (F.col("base_date") >= F.lit(target - timedelta(days=lookback_days))) & (F.col("base_date") <= goal.scalar()))
    w = Window.partitionBy("symbol").orderBy("base_date")
    stepped = rows.withColumn("previous_close", F.lag("close_price").over(w)).where(F.col("base_date") == goal.scalar())
    diff, volume = F.col("close_price") - F.col("previous_close"), F.coalesce("volume", F.lit(0)).cast("long")
    return _breadth(F.col("base_date"), diff, volume, stepped.where(F.col("previous_close").isNotNull()))


def market_breadth_from_change(rows: DataFrame) -> DataFrame:
    """Breadth per date from a given change rate; a missing rate counts as unchanged."""
    change, volume = F.coalesce("change_rate", F.lit(0.0)), F.coalesce("volume", F.lit(0)).cast("long")
    return _breadth(F.col("base_date"), change, volume, rows)


def short_history(prices: DataFrame, minimum: int = 20) -> DataFrame:
    """Symbols with fewer than ``minimum`` price rows."""
    return prices.groupBy("symbol").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") < minimum)


def buy_ratio(signals: DataFrame) -> DataFrame:
    """Share of BUY signals in percent and the stance it stands for."""
    share = F.col("buy_count") / F.nullif(F.col("total_count"), F.lit(0)) * 100
    ratio = F.coalesce(share, F.lit(0.0))
    counted = signals.agg(F.count_if(F.col("signal") == "BUY").alias("buy_count"), F.count(F.lit(1)).alias("total_count"))
    stance = F.when(ratio >= 40, "RISK_ON").when(ratio >= 20, "STOCK_PICKING").otherwise("RISK_OFF")
    return counted.select("buy_count", "total_count", ratio.alias("buy_ratio"), stance.alias("stance"))


def pivot_features(features: DataFrame, keys: list[str], names: list[str]) -> DataFrame:
    """One row per key with a column per feature; all columns come from one shuffle."""
    of = lambda name: F.max(F.when(F.col("feature_name") == name, F.col("feature_value"))).alias(name)
    return dealt(features, keys).groupBy(*keys).agg(*map(of, names))
