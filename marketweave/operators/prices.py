"""Row predicates and reconciliation of price rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.markets import source_priority
from ..functions.symbols import normalize_symbol

PRICE_FIELDS = ("open_price", "high_price", "low_price", "close_price", "volume", "trading_value")
REQUIRED_FIELDS = ("close_price", "volume", "trading_value")
_TIES = ("trading_value", "volume", "close_price", "market_cap", "outstanding_shares")


def _all(conditions) -> Column:
    return reduce(lambda a, b: a & b, conditions)


def valid_row(require_source: bool = False, prefix: str = "") -> Column:
    """Close, volume and trading value present and above 0; optionally a named source."""
    ok = _all(F.col(prefix + f) > 0 for f in REQUIRED_FIELDS)
    if require_source:
        ok = ok & (F.col(prefix + "source") != "")
    return F.coalesce(ok, F.lit(False))


def valid_row_lenient() -> Column:
    """Close merely present; volume and trading value above 0."""
    return F.coalesce(F.col("close_price").isNotNull() & (F.col("volume") > 0) & (F.col("trading_value") > 0), F.lit(False))


def complete_row() -> Column:
    return _all(F.col(f).isNotNull() for f in REQUIRED_FIELDS)


def snapshot_only() -> Column:
    return _all(F.col(f).isNull() for f in PRICE_FIELDS)


def block_reason() -> Column:
    """Why the price table refuses a row; null for an accepted row."""
    return F.when(snapshot_only(), "snapshot_only_price_row").when(~complete_row(), "missing_required_price_fields")


def suspicious_short() -> Column:
    """Positive short volume and value, but ratio missing or 0."""
    return F.coalesce(
        (F.col("short_volume") > 0) & (F.col("short_value") > 0) & (F.col("short_ratio").isNull() | (F.col("short_ratio") == 0)),
        F.lit(False),
    )


def zero_close() -> Column:
    """A null close counts as 0."""
    return F.coalesce(F.col("close_price"), F.lit(0.0)) <= 0


def no_source() -> Column:
    return F.coalesce(F.col("source"), F.lit("")) == ""


def canonical(df: DataFrame) -> DataFrame:
    return df.withColumn("symbol", normalize_symbol(F.col("symbol")))


def on_open_days(df: DataFrame, open_days: DataFrame) -> DataFrame:
    """Rows dated on an open day. The day list is bounded by the calendar, so it is broadcast."""
    return df.join(F.broadcast(open_days), "base_date", "left_semi")


def trading_day_filter(df: DataFrame, open_days: DataFrame) -> DataFrame:
    """As :func:`on_open_days`, but an empty calendar keeps every row."""
    known = open_days.select("base_date", F.lit(True).alias("is_open_day"))
    any_day = open_days.agg(F.count(F.lit(1)).alias("n"))
    return (
        df.join(F.broadcast(known), "base_date", "left")
        .where(F.col("is_open_day").isNotNull() | (any_day.scalar() == 0))
        .drop("is_open_day")
    )


def best_source(df: DataFrame, latest_first: bool = True, ties: tuple = _TIES) -> DataFrame:
    """One row per (symbol, base_date): best source, then latest (or earliest) ``available_at``.

    ``row_number() = 1`` lets Spark keep one row per key before the shuffle
    (WindowGroupLimit), so a symbol holding much of the table is not moved whole,
    and the shuffle key includes the date.
    """
    when = F.col("available_at")
    order = [
        source_priority(F.col("source")).asc(),
        when.desc_nulls_last() if latest_first else when.asc_nulls_first(),
        *[F.col(t).desc_nulls_last() for t in ties if t in df.columns],
    ]
    rank = F.row_number().over(Window.partitionBy("symbol", "base_date").orderBy(*order))
    return df.withColumn("pick", rank).where(F.col("pick") == 1).drop("pick")


def clean_rows(prices: DataFrame, open_days: DataFrame) -> DataFrame:
    """Valid and sourced rows of open days: what the panel chooses from."""
    return on_open_days(prices.where(valid_row(require_source=True)), open_days)


def clean_panel(prices: DataFrame, open_days: DataFrame, latest_first: bool = True) -> DataFrame:
    """Canonical symbol, valid and sourced rows of open days, one row per symbol-day."""
    return best_source(canonical(clean_rows(prices, open_days)), latest_first)


def with_flows(panel: DataFrame, supply: DataFrame) -> DataFrame:
    """Left join of flows; a missing foreign net buy is 0; the price row keeps its source."""
    flows = supply.select("symbol", "base_date", "foreign_net_buy")
    return panel.join(flows, ["symbol", "base_date"], "left").withColumn(
        "foreign_net_buy", F.coalesce("foreign_net_buy", F.lit(0.0))
    )


def effective_date(df: DataFrame, target) -> DataFrame:
    """One row: the target date if the panel has it, else its latest earlier date."""
    return df.where(F.col("base_date") <= F.lit(target).cast("date")).agg(F.max("base_date").alias("effective_date"))
