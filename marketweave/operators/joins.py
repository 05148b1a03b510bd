"""Joins between the keyed daily tables.

No side is broadcast by hint here unless the calendar or a one-row aggregate
bounds it; masters and watchlists are left to the optimizer, which broadcasts
them only below its size threshold and re-plans skewed joins at run time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.symbols import normalize_symbol
from . import prices as px, windows as win

MASTER_COLUMNS = ("symbol", "market", "asset_type", "name")


def latest(df: DataFrame, column: str = "base_date") -> DataFrame:
    """Rows of the table's newest date, as a scalar subquery on that date."""
    newest = df.agg(F.max(column).alias("d"))
    return df.where(F.col(column) == newest.scalar())


def beside(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """The columns of a one-row frame on every row, as one scalar subquery instead of a join."""
    packed = one_row.select(F.struct(*one_row.columns).alias("r"))
    return df.withColumn("one_row", packed.scalar()).select(*df.columns, "one_row.*")


def with_master(df: DataFrame, master: DataFrame, keep_unmatched: bool = False) -> DataFrame:
    return px.canonical(df).join(master.select(*MASTER_COLUMNS), "symbol", "left" if keep_unmatched else "inner")


def stock_snapshot(prices: DataFrame, supply: DataFrame, ratios: DataFrame, master: DataFrame, markets: list[str], day: DataFrame | None = None) -> DataFrame:
    """Price, flows and ratios of the latest price date for the given markets; ``day`` may give that date as one cell, found more cheaply."""
    key = ["symbol", "base_date"]
    return (
        (latest(prices) if day is None else prices.where(F.col("base_date") == day.scalar()))
        .join(master.where(F.col("market").isin(*markets)).select("symbol", "name", "market"), "symbol")
        .join(supply, key, "left")
        .join(ratios.drop("source"), key, "left")
    )


def latest_close_active(prices: DataFrame, master: DataFrame) -> DataFrame:
    return latest(prices).join(master.where("is_active").select("symbol", "name"), "symbol").select(
        "symbol", "name", "base_date", "close_price", "volume", "trading_value"
    )


def sample_status(symbols: DataFrame, master, prices, supply, shorts, statements, ratios) -> DataFrame:
    """Every listed symbol with its row of each table's newest date; statements are its own newest, ratios those of the price date.

    A price row counts if it is complete, and only on the newest date of the whole price table.
    """
    named = lambda df, date_name, *cols: latest(df).select("symbol", F.col("base_date").alias(date_name), *cols)
    amounts = [c for c in statements.columns if c not in ("symbol", "base_date")]
    own = statements.groupBy("symbol").agg(F.max_by(F.struct(F.col("base_date").alias("statement_date"), *amounts), "base_date").alias("newest")).select("symbol", "newest.*")
    priced = latest(prices).where(px.complete_row()).select(
        "symbol", F.col("base_date").alias("price_date"), "close_price", "volume", "trading_value", "market_cap", "outstanding_shares")
    of_day = ratios.select("symbol", F.col("base_date").alias("price_date"), "per", "pbr", "roe", "debt_ratio")
    return (
        symbols.join(master.select("symbol", "name", "market", "asset_type", "is_active"), "symbol", "left")
        .join(priced, "symbol", "left")
        .join(named(supply, "supply_date", "foreign_net_buy", "institutional_net_buy", "foreign_holding_ratio"), "symbol", "left")
        .join(named(shorts, "short_date", "short_volume", "short_value", "short_ratio"), "symbol", "left")
        .join(own, "symbol", "left")
        .join(of_day, ["symbol", "price_date"], "left")
    )


def exists_flags(spark, series, wide, prices, supply, shorts, raw, statements, told, target, samples: tuple[str, str]) -> DataFrame:
    """One row of whether each table has what a report of its newest date needs."""
    kr10y = series.where(F.col("series_id") == "KR_GOVT_10Y")
    held = latest(prices).where("market_cap is not null and outstanding_shares is not null")
    ratio = supply.where("foreign_holding_ratio is not null")
    fields = [held.where(F.col("symbol") == s).join(ratio, ["symbol", "base_date"], "left_semi") for s in samples]
    newest = latest(told)
    parts = {
        "has_kr10y": kr10y, "has_kr10y_on_target": kr10y.where(F.col("base_date") == F.lit(target)),
        "wide_macro_has_kr10y": latest(wide).where("gold is not null"), "wide_macro_has_metals": latest(wide).where("gold is not null and wti is not null"),
        "has_market_flows": latest(supply).where("foreign_net_buy is not null and institutional_net_buy is not null"),
        "first_sample_has_snapshot_fields": fields[0], "second_sample_has_snapshot_fields": fields[1],
        "has_disclosures": newest.where("source = 'OpenDart'"), "has_news": newest.where("source = 'NaverNews'"),
        "has_raw_rows": latest(raw), "has_shorts": latest(shorts), "has_statements": latest(statements), "has_events": newest,
    }
    return spark.range(1).select(*[df.exists().alias(name) for name, df in parts.items()])


def enabled_members(df: DataFrame, static_universe: DataFrame) -> DataFrame:
    return df.join(static_universe.where("enabled").select("symbol"), "symbol", "left_semi")


def missing_from(symbols: DataFrame, df: DataFrame) -> DataFrame:
    return symbols.select("symbol").join(df.select("symbol"), "symbol", "left_anti")


def coverage_gap(master: DataFrame, prices: DataFrame, markets: list[str], limit: int | None = None) -> DataFrame:
    """Listed symbols without a row on the latest price date; the first ``limit`` by symbol, or all."""
    listed = master.where(F.col("market").isin(*markets)).select("symbol", "name", "market")
    gap = listed.join(latest(prices).select("symbol"), "symbol", "left_anti")
    return gap if limit is None else gap.orderBy("symbol").limit(limit)


def watchlist_coverage(static_universe: DataFrame, prices: DataFrame) -> DataFrame:
    """Watchlist symbols, and those with a row, on the latest price date."""
    day = prices.agg(F.max("base_date").alias("base_date"))
    wanted = beside(static_universe.where("enabled").select("symbol"), day)
    have = prices.where(F.col("base_date") == day.scalar()).select("symbol", "base_date").distinct().withColumn("has_price", F.lit(1))
    return wanted.join(have, ["symbol", "base_date"], "left").groupBy("base_date").agg(
        F.count(F.lit(1)).alias("watchlist_symbols"), F.count("has_price").alias("watchlist_symbols_with_price")
    )


def previous_open_day(calendar: DataFrame, exchange: str = "XKRX") -> DataFrame:
    """Each calendar date with the open day before it."""
    w = Window.partitionBy("exchange_code").orderBy("calendar_date").rowsBetween(Window.unboundedPreceding, -1)
    rows = calendar.where(F.col("exchange_code") == exchange)
    hit = F.when(F.col("is_open"), F.col("calendar_date"))
    return rows.select(
        F.col("calendar_date").alias("base_date"), F.col("is_open").alias("day_is_open"),
        F.last(hit, ignorenulls=True).over(w).alias("previous_day"),
    )


def carried_rows(prices: DataFrame, calendar: DataFrame) -> DataFrame:
    """Closed-day rows that repeat the same symbol's row of the previous open day.

    ``prices`` has one row per symbol and day; null equals null.
    """
    fields = ("close_price", "volume", "trading_value")
    days = previous_open_day(calendar)
    closed = prices.join(F.broadcast(days.where(~F.col("day_is_open") & F.col("previous_day").isNotNull())), "base_date")
    before = prices.select("symbol", F.col("base_date").alias("previous_day"), *[F.col(f).alias(f"p_{f}") for f in fields])
    same = [F.col(f).eqNullSafe(F.col(f"p_{f}")) for f in fields]
    return closed.join(before, ["symbol", "previous_day"]).where(same[0] & same[1] & same[2]).select(
        "symbol", "base_date", "previous_day", *fields
    )


def calendar_status(df: DataFrame, calendar: DataFrame, exchange: str = "XKRX") -> DataFrame:
    """Adds ``day_status``: open, closed or missing from the calendar."""
    days = calendar.where(F.col("exchange_code") == exchange).select(F.col("calendar_date").alias("base_date"), F.col("is_open").alias("day_is_open"))
    status = F.when(F.col("day_is_open"), "open").when(~F.col("day_is_open"), "closed").otherwise("missing")
    return df.join(F.broadcast(days), "base_date", "left").withColumn("day_status", status).drop("day_is_open")


def known_at(df: DataFrame, keys: list[str], as_of: Column, value: Column, order: Column) -> DataFrame:
    """Newest value per key among rows available at the decision time."""
    return df.where(F.col("available_at") <= as_of).groupBy(*keys).agg(
        F.max("base_date").alias("known_date"), F.max_by(value, order).alias("known_value")
    )


def asof_many(observations: DataFrame, decisions: DataFrame, key: str) -> DataFrame:
    """For many decision instants: the newest observation of the same key at or before each; of one instant the last by ``seq``.

    Both sides are stacked with columns (key, at, seq, value, decision_id) and filled
    forward per (key, block); the first rows of a block look back through a table
    with one row per block, so no key is handled by one task alone.
    """
    place = lambda kind, seq: F.struct("at", F.lit(kind).alias("kind"), F.col(seq).cast("long").alias("seq")).alias("place")
    stacked = win.in_blocks(observations.select(key, "at", "value", F.lit(None).cast("long").alias("decision_id"), F.lit(0).alias("kind"), place(0, "seq")).unionByName(
        decisions.select(key, "at", F.lit(None).cast("double").alias("value"), "decision_id", F.lit(1).alias("kind"), place(1, "decision_id"))
    ), [key], "place")
    inside = Window.partitionBy(key, "block").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    blocks = Window.partitionBy(key).orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    tails = stacked.groupBy(key, "block").agg(F.max_by("value", F.when(F.col("kind") == 0, F.col("place"))).alias("tail"))
    carried = tails.select(key, "block", F.last("tail", ignorenulls=True).over(blocks).alias("carried"))
    filled = stacked.withColumn("known", F.last("value", ignorenulls=True).over(inside))
    return filled.where(F.col("kind") == 1).join(carried, [key, "block"], "left").select(
        "decision_id", key, "at", F.coalesce("known", "carried").alias("known_value")
    )


def update_from(target: DataFrame, changes: DataFrame, keys: list[str], columns: list[str], better: Column | None = None) -> DataFrame:
    """UPDATE ... FROM and the insert of unmatched rows: full outer join on the key.

    Without ``better`` a change only fills gaps; with it, a better change row
    overwrites. ``changes`` columns are visible to ``better`` as ``new_<name>``.
    """
    renamed = changes.select(*keys, *[F.col(c).alias(f"new_{c}") for c in columns], F.lit(True).alias("has_change"))
    joined = target.withColumn("has_row", F.lit(True)).join(renamed, keys, "full_outer")
    take = F.lit(False) if better is None else F.coalesce(better & F.col("has_change"), F.lit(False))
    picks = [
        F.when(F.col("has_row").isNull() | take, F.coalesce(F.col(f"new_{c}"), F.col(c))).otherwise(F.coalesce(F.col(c), F.col(f"new_{c}"))).alias(c)
        for c in columns
    ]
    return joined.select(*keys, *picks)
