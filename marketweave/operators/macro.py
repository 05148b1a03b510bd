"""Macro snapshot: source resolution per date, carried US fields, fallback reports.

All of these work on one row per day and series, so windows per series or
exchange are bounded by the calendar.
"""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.sanity import classify_index_quality, index_hard_invalid
from . import calendar as cal

# Fields carried over US closed days, and series a report depends on.
US_FIELDS = ("sp500", "sp500_change_rate", "nasdaq", "nasdaq_change_rate", "sox", "vix")
HIGH_IMPACT_SERIES = ("DGS3", "DGS10", "DTWEXBGS", "DEXKOUS")
FX_STALE_DAYS = 2


def index_resolve(quotes: DataFrame) -> DataFrame:
    """Per date and index: the primary quote if valid, else the secondary, else missing.

    ``quotes`` has (base_date, index_name, source, value, change_rate) with source
    ``KIS`` for the primary and ``YAHOO`` for the secondary.
    """
    of = lambda source, name: F.max(F.when(F.col("source") == source, F.col(name)))
    pair = quotes.groupBy("base_date", "index_name").agg(
        of("KIS", "value").alias("k"), of("KIS", "change_rate").alias("k_change"), of("YAHOO", "value").alias("y"), of("YAHOO", "change_rate").alias("y_change")
    )
    k_ok, y_ok = ~index_hard_invalid(F.col("k")), ~index_hard_invalid(F.col("y"))
    flag = classify_index_quality(F.col("k"), F.col("k_change"), secondary=F.when(y_ok, F.col("y")))
    return pair.select(
        "base_date", "index_name",
        F.when(k_ok, F.col("k")).when(y_ok, F.col("y")).alias("value"),
        F.when(k_ok, F.col("k_change")).otherwise(F.col("y_change")).alias("change_rate"),
        F.when(k_ok, "KIS").when(y_ok, "YAHOO").otherwise("UNKNOWN").alias("source"),
        F.when(k_ok, flag).when(y_ok, "FALLBACK_YAHOO").otherwise("MISSING").alias("quality_flag"),
    )


def known_per_day(days: DataFrame, series: DataFrame, ids: list[str]) -> DataFrame:
    """For every day: newest value and its date at or before it, per wanted series (wide)."""
    out = days.select("base_date")
    picked = series.where(F.col("series_id").isin(*ids)).groupBy("base_date").agg(
        *[F.max(F.when(F.col("series_id") == s, F.col("value"))).alias(s) for s in ids]
    )
    one = Window.partitionBy("part").orderBy("base_date").rowsBetween(Window.unboundedPreceding, 0)
    joined = out.join(picked, "base_date", "left").withColumn("part", F.lit(0))
    cols = {}
    for s in ids:
        cols[s] = F.last(s, ignorenulls=True).over(one)
        cols[f"{s}_date"] = F.last(F.when(F.col(s).isNotNull(), F.col("base_date")), ignorenulls=True).over(one)
    return joined.select("base_date", *[c.alias(n) for n, c in cols.items()])


def fx_resolve(days: DataFrame, series: DataFrame, quotes: DataFrame) -> DataFrame:
    """Central-bank rate unless older than two days and a market quote exists."""
    known = known_per_day(days, series, ["USDKRW"])
    market = quotes.select("base_date", F.col("value").alias("quote"))
    stale = F.datediff("base_date", "USDKRW_date")
    use_quote = F.col("quote").isNotNull() & (F.col("USDKRW").isNull() | (stale > FX_STALE_DAYS))
    has_bank = F.col("USDKRW").isNotNull()
    return known.join(market, "base_date", "left").select(
        "base_date",
        F.when(use_quote, F.col("quote")).otherwise(F.col("USDKRW")).alias("usdkrw"),
        F.when(use_quote, "YAHOO").when(has_bank, "ECOS").otherwise("UNKNOWN").alias("usdkrw_source"),
        F.when(use_quote, F.col("base_date")).otherwise(F.col("USDKRW_date")).alias("usdkrw_source_date"),
        F.when(use_quote, "OK").when(has_bank & (stale <= FX_STALE_DAYS), "OK").when(has_bank, "STALE").otherwise("MISSING").alias("usdkrw_quality_flag"),
    )


def rate_fallback(days: DataFrame, series: DataFrame, direct: DataFrame, kr10y: tuple[str, str], us10y: str, us3y: str) -> DataFrame:
    """kr10y: first series, else second; us10y: the day's own quote, else the series; us3y: its series."""
    known = known_per_day(days, series, list(dict.fromkeys([*kr10y, us10y, us3y])))
    quote = direct.select("base_date", F.col("value").alias("quote"))
    return known.join(quote, "base_date", "left").select(
        "base_date", F.coalesce(*kr10y).alias("kr10y"), F.coalesce("quote", us10y).alias("us10y"), F.col(us3y).alias("us3y")
    )


def carry_us_closed(wide: DataFrame, calendar: DataFrame, fields: tuple = US_FIELDS, exchange: str = "XNYS") -> DataFrame:
    """On US closed days copy the US fields from the previous US open day."""
    status = cal.neighbours(calendar.where(F.col("exchange_code") == exchange)).join(
        calendar.where(F.col("exchange_code") == exchange).select("calendar_date", "is_open"), "calendar_date"
    )
    days = status.where(~F.col("is_open")).select(F.col("calendar_date").alias("base_date"), "previous_open_day")
    mine = [f for f in fields if f in wide.columns]
    before = wide.select(F.col("base_date").alias("previous_open_day"), *[F.col(f).alias(f"p_{f}") for f in mine], F.lit(True).alias("has_previous"))
    joined = wide.join(F.broadcast(days), "base_date", "left").join(before, "previous_open_day", "left")
    closed = F.col("has_previous").isNotNull()
    return joined.select(
        "base_date", *[F.when(closed, F.col(f"p_{f}")).otherwise(F.col(f)).alias(f) if f in mine else F.col(f) for f in wide.columns if f != "base_date"],
        F.when(closed, F.col("previous_open_day")).otherwise(F.col("base_date")).alias("us_data_date"),
    )


def quality_flag(kospi_flag: Column, kosdaq_flag: Column) -> Column:
    bad = F.coalesce(kospi_flag == "INVALID", F.lit(False)) | F.coalesce(kosdaq_flag == "INVALID", F.lit(False))
    return F.when(bad, "WARN_INVALID_INDEX").otherwise("OK")


def series_fallback_report(wanted: DataFrame, series: DataFrame, target: date, lookback_days: int = 7, high: tuple = HIGH_IMPACT_SERIES) -> DataFrame:
    """Wanted series without an observation in the look-back, their last known date and impact."""
    until = F.col("base_date") <= F.lit(target)
    known = series.where(until).groupBy("series_id").agg(F.max("base_date").alias("fallback_latest_date"))
    recent = F.col("fallback_latest_date") >= F.lit(target - timedelta(days=lookback_days))
    return wanted.join(known, "series_id", "left").where(~F.coalesce(recent, F.lit(False))).select(
        "series_id", F.lit("NO_OBSERVATIONS").alias("error_type"), "fallback_latest_date",
        F.when(F.col("series_id").isin(*high), "HIGH").otherwise("LOW").alias("report_impact"),
    )


def market_flow_pick(flows: DataFrame, target, position: str, values: list[str]) -> DataFrame:
    """Per market the payload row of the target date, else the first row of the payload."""
    order = F.struct((F.col("base_date") != F.lit(target)).alias("miss"), position, *values)
    return flows.groupBy("market").agg(F.min_by(F.struct("base_date", *values), order).alias("r")).select("market", "r.*")


def snapshot(days: DataFrame, wide: DataFrame, indices: DataFrame, fx: DataFrame, rates: DataFrame, flows: DataFrame) -> DataFrame:
    """One wide row per date: macro columns, resolved indices, FX, rates, flows and one quality flag."""
    names = ("kospi", "kosdaq")
    of = lambda name, col: F.max(F.when(F.col("index_name") == name, F.col(col)))
    idx = indices.groupBy("base_date").agg(
        *[of(n, c).alias(n if c == "value" else f"{n}_{c}") for n in names for c in ("value", "change_rate", "source", "quality_flag")]
    )
    net = flows.groupBy("base_date").agg(
        *[F.max(F.when(F.col("market") == n.upper(), F.col("foreign_net_buy"))).alias(f"{n}_foreign_net_buy") for n in names]
    )
    joined = days.select("base_date").join(wide.drop("usdkrw", "us10y"), "base_date", "left")
    for part in (idx, fx, rates, net):
        joined = joined.join(part, "base_date", "left")
    return joined.withColumn("macro_quality_flag", quality_flag(F.col("kospi_quality_flag"), F.col("kosdaq_quality_flag")))
