"""Long feature rows: stock features of a date, macro features, and their union."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.symbols import normalize_symbol
from ..functions.times import available_at
from . import prices as px, windows as win

# Names of the stock features.
STOCK_FEATURES = (
    "close_price", "return_5d", "return_20d", "return_60d", "moving_avg_5", "moving_avg_20",
    "trading_value_ratio_20d", "volatility_20d", "foreign_flow_zscore", "volume",
)
LOOKBACK_DAYS = 90
SERIES_LOOKBACK_DAYS = 45
_WARNED = ("close_price", "return_5d", "return_20d", "return_60d")


def price_panel(prices: DataFrame, supply: DataFrame, open_days: DataFrame, target: date) -> DataFrame:
    """Clean price rows of the look-back, joined with flows, cut at the effective date."""
    span = F.col("base_date").between(F.lit(target - timedelta(days=LOOKBACK_DAYS)), F.lit(target))
    panel = px.clean_panel(prices.where(span), open_days.where(span))
    return px.with_flows(panel, supply.where(span))


def null_mixed(df: DataFrame) -> DataFrame:
    """Returns and the value ratio are unknown when their window mixes sources."""
    unless = lambda flag, name: F.when(~F.col(flag), F.col(name))
    return df.withColumns({
        "return_5d": unless("mixed_5", "return_5d"),
        "return_20d": unless("mixed_20", "return_20d"),
        "return_60d": unless("mixed_60", "return_60d"),
        "trading_value_ratio_20d": unless("mixed_20", "trading_value_ratio_20d"),
    })


def to_long(df: DataFrame) -> DataFrame:
    """One row per non-null feature, with its price warning."""
    pairs = F.array(*[F.struct(F.lit(c).alias("n"), F.col(c).cast("double").alias("v")) for c in STOCK_FEATURES])
    long = df.select("symbol", "base_date", "price_warning", F.inline(pairs).alias("feature_name", "feature_value"))
    warned = F.col("price_warning").isNotNull() & F.col("feature_name").isin(*_WARNED)
    return long.where(F.col("feature_value").isNotNull()).select(
        "symbol", "base_date", "feature_name", "feature_value",
        available_at(F.col("base_date")).alias("available_at"),
        F.when(warned, F.col("price_warning")).alias("data_quality_flag"),
        F.when(warned, F.lit("PRICE_SCALE_WARNING")).alias("source_consistency_status"),
    )


def effective_day(prices: DataFrame, open_days: DataFrame, target: date) -> DataFrame:
    """One row, the panel's newest date in the look-back, from its rows before any is chosen: no shuffle but of one row a task."""
    span = F.col("base_date").between(F.lit(target - timedelta(days=LOOKBACK_DAYS)), F.lit(target))
    return px.effective_date(px.clean_rows(prices.where(span), open_days.where(span)), target)


def stock_features_wide(
    prices: DataFrame, supply: DataFrame, open_days: DataFrame, universe: DataFrame, target: date, bounds: dict | None = None, day: date | None = None
) -> DataFrame:
    """Window columns of the universe's symbols at the effective date of the whole panel, which a caller may know as ``day``."""
    at = F.lit(day) if day is not None else effective_day(prices, open_days, target).scalar()
    mine = price_panel(prices, supply, open_days, target).join(universe.select("symbol").distinct(), "symbol", "left_semi")
    computed = win.stock_columns(mine, bounds)
    return null_mixed(computed.where(F.col("base_date") == at))


def stock_features(prices, supply, open_days, universe, target, bounds: dict | None = None, day: date | None = None) -> DataFrame:
    return to_long(stock_features_wide(prices, supply, open_days, universe, target, bounds, day))


def _global(df: DataFrame, name: Column, value: Column) -> DataFrame:
    out = df.select(
        F.lit("GLOBAL").alias("symbol"), "base_date", name.alias("feature_name"), value.alias("feature_value"),
    )
    return out.where(F.col("feature_value").isNotNull() & ~F.isnan("feature_value") & (F.abs("feature_value") != float("inf")))


def macro_long(wide: DataFrame, causal: bool = True) -> DataFrame:
    """Wide macro table as (column_name, base_date, value), filled per column; only rows that are cut at a target may fill their head from later ones."""
    names = [c for c in wide.columns if c != "base_date"]
    long = wide.unpivot(["base_date"], names, "column_name", "value")
    return win.fill_forward_back(long, "column_name", "base_date", "value", causal)


def macro_ratios(wide: DataFrame, causal: bool = True) -> DataFrame:
    """copper/gold and gold/wti after filling."""
    filled = macro_long(wide.select("base_date", "gold", "copper", "wti"), causal)
    by_day = filled.groupBy("base_date").agg(
        *[F.max(F.when(F.col("column_name") == n, F.col("value"))).alias(n) for n in ("gold", "copper", "wti")]
    )
    pair = F.explode(F.array(
        F.struct(F.lit("copper_gold_ratio").alias("n"), F.try_divide("copper", "gold").alias("v")),
        F.struct(F.lit("gold_oil_ratio").alias("n"), F.try_divide("gold", "wti").alias("v")),
    ))
    rows = by_day.select("base_date", pair.alias("p"))
    return _global(rows, F.col("p.n"), F.col("p.v"))


def _two_changes(changed: DataFrame, prefix: Column) -> DataFrame:
    pair = F.explode(F.array(
        F.struct(F.concat(prefix, F.lit("_1d_chg")).alias("n"), F.col("chg_1d").alias("v")),
        F.struct(F.concat(prefix, F.lit("_5d_chg")).alias("n"), F.col("chg_5d").alias("v")),
    ))
    return _global(changed.select("base_date", pair.alias("p")), F.col("p.n"), F.col("p.v"))


def macro_wide_change(wide: DataFrame, causal: bool = True) -> DataFrame:
    changed = win.lag_change_wide(macro_long(wide, causal))
    return _two_changes(changed, F.concat(F.lit("macro_"), F.col("column_name")))


def feature_prefix(series: Column) -> Column:
    return F.concat(F.lit("macro_"), F.replace(F.lower(series), F.lit(" "), F.lit("_")))


def macro_series_change(series: DataFrame, causal: bool = True) -> DataFrame:
    filled = win.fill_forward_back(series, "series_id", "base_date", "value", causal)
    return _two_changes(win.lag_change_series(filled), feature_prefix(F.col("series_id")))


def latest_values(series: DataFrame, ids: dict[str, str], target) -> DataFrame:
    """One row: the newest value at or before the target of each wanted series."""
    rows = series.where((F.col("base_date") <= F.lit(target).cast("date")) & F.col("series_id").isin(*ids.values()))
    return rows.agg(*[
        F.max_by(F.when(F.col("series_id") == sid, F.col("value")), F.when(F.col("series_id") == sid, F.col("base_date"))).alias(name)
        for name, sid in ids.items()
    ])


def yield_spreads(series: DataFrame, target) -> DataFrame:
    """10Y-3Y, AA-3Y and BBB-3Y of the latest values."""
    ids = {"y10": "KR_GOVT_10Y", "y3": "KR_GOVT_3Y", "aa": "KR_CORP_AA_3Y", "bbb": "KR_CORP_BBB_3Y"}
    y = F.col
    spread = F.explode(F.array(
        F.struct(F.lit("KR_YIELD_SPREAD_10Y_3Y").alias("n"), (y("y10") - y("y3")).alias("v")),
        F.struct(F.lit("KR_CREDIT_SPREAD_AA_3Y").alias("n"), (y("aa") - y("y3")).alias("v")),
        F.struct(F.lit("KR_CREDIT_SPREAD_BBB_3Y").alias("n"), (y("bbb") - y("y3")).alias("v")),
    ))
    rows = latest_values(series, ids, target).select(F.lit(target).cast("date").alias("base_date"), spread.alias("p"))
    return _global(rows, y("p.n"), y("p.v"))


def row_changes(series: DataFrame, series_id: str, lags: dict[int, tuple[str, str]]) -> DataFrame:
    """Change of one series over row lags, as percent (``pct``) or basis points (``bp``), for every date."""
    w = Window.partitionBy("series_id").orderBy("base_date")
    rows = series.where(F.col("series_id") == series_id)
    value, out = F.col("value"), []
    for lag, (name, kind) in lags.items():
        before = F.lag("value", lag).over(w)
        change = F.when(before != 0, (value / before - F.lit(1.0)) * F.lit(100.0)) if kind == "pct" else (value - before) * F.lit(100.0)
        out.append(F.struct(F.lit(name).alias("n"), change.alias("v")))
    return _global(rows.select("base_date", F.array(*out).alias("ps")).select("base_date", F.explode("ps").alias("p")), F.col("p.n"), F.col("p.v"))


def fx_rate_change(series: DataFrame) -> DataFrame:
    return row_changes(series, "USDKRW", {1: ("USDKRW_1D_CHG_PCT", "pct")})


def rate_bp_change(series: DataFrame) -> DataFrame:
    return row_changes(series, "KR_GOVT_10Y", {1: ("KR10Y_1D_CHG_BP", "bp"), 20: ("KR10Y_20D_CHG_BP", "bp")})


def _named(*pairs: tuple[Column, Column]) -> Column:
    return F.array(*[F.struct(name.alias("n"), value.cast("double").alias("v")) for name, value in pairs])


def wide_macro_features(wide: DataFrame, day, causal: bool = True) -> DataFrame:
    """Changes of every macro column and the two ratios at one date: the columns are filled once, and the date's few values meet in one row."""
    at = F.lit(day).cast("date")
    today = win.lag_change_wide(macro_long(wide, causal)).where(F.col("base_date") == at)
    name = F.concat(F.lit("macro_"), F.col("column_name"))
    changes = _named((F.concat(name, F.lit("_1d_chg")), F.col("chg_1d")), (F.concat(name, F.lit("_5d_chg")), F.col("chg_5d")))
    needed = ("gold", "copper", "wti")
    row = today.groupBy("base_date").agg(F.flatten(F.collect_list(changes)).alias("ps"), *[F.max(F.when(F.col("column_name") == n, F.col("value"))).alias(n) for n in needed])
    if set(needed) <= set(wide.columns):
        ratios = _named((F.lit("copper_gold_ratio"), F.try_divide("copper", "gold")), (F.lit("gold_oil_ratio"), F.try_divide("gold", "wti")))
        row = row.withColumn("ps", F.concat("ps", ratios))
    return _global(row.select("base_date", F.explode("ps").alias("p")), F.col("p.n"), F.col("p.v"))


def series_macro_features(series: DataFrame, causal: bool = True) -> DataFrame:
    """Changes of every series, filled, and the rate changes of the exchange rate and the bond yield, not filled, for every date: one shuffle and one sort for all windows."""
    w = Window.partitionBy("series_id").orderBy("base_date")
    own = F.col("own")
    kept = series.withColumns({"own": F.col("value"), "own_1": F.lag("value", 1).over(w), "own_20": F.lag("value", 20).over(w)})
    changed = win.lag_change_series(win.fill_forward_back(kept, "series_id", "base_date", "value", causal))
    prefix = feature_prefix(F.col("series_id"))
    both = _named((F.concat(prefix, F.lit("_1d_chg")), F.col("chg_1d")), (F.concat(prefix, F.lit("_5d_chg")), F.col("chg_5d")))
    points = lambda before: (own - F.col(before)) * F.lit(100.0)
    percent = F.when(F.col("own_1") != 0, (own / F.col("own_1") - F.lit(1.0)) * F.lit(100.0))
    extra = F.when(F.col("series_id") == "USDKRW", _named((F.lit("USDKRW_1D_CHG_PCT"), percent)))
    extra = extra.when(F.col("series_id") == "KR_GOVT_10Y", _named((F.lit("KR10Y_1D_CHG_BP"), points("own_1")), (F.lit("KR10Y_20D_CHG_BP"), points("own_20"))))
    rows = changed.select("base_date", F.explode(F.when(extra.isNull(), both).otherwise(F.concat(both, extra))).alias("p"))
    return _global(rows, F.col("p.n"), F.col("p.v"))


def macro_features(wide: DataFrame, series: DataFrame, target: date, day: date) -> list[DataFrame]:
    """Macro producers of one date in the order that decides equal names, each cut to its look-back and at the date before anything is filled."""
    cut = lambda df, days: df.where(F.col("base_date").between(F.lit(target - timedelta(days=days)), F.lit(day)))
    near, far = cut(series, SERIES_LOOKBACK_DAYS), cut(wide, LOOKBACK_DAYS)
    # a series may end before the date; its newest change counts for the date
    changes = series_macro_features(near, causal=False)
    newest = changes.groupBy("symbol", "feature_name").agg(F.max_by("feature_value", "base_date").alias("feature_value")).withColumn("base_date", F.lit(day))
    return [wide_macro_features(far, day, causal=False), newest, yield_spreads(near, day)]


_FLAGS = {"available_at": "timestamp", "data_quality_flag": "string", "source_consistency_status": "string"}


def union_features(*producers: DataFrame) -> DataFrame:
    """Stack producers with their flags; blank keys and non-finite values go, the last producer of a key wins."""
    stacked = None
    for order, df in enumerate(producers):
        flags = [(F.col(n) if n in df.columns else F.lit(None)).cast(t).alias(n) for n, t in _FLAGS.items()]
        part = df.select("symbol", "base_date", "feature_name", "feature_value", *flags, F.lit(order).alias("producer"))
        stacked = part if stacked is None else stacked.unionByName(part)
    finite = F.col("feature_value").isNotNull() & ~F.isnan("feature_value") & (F.abs("feature_value") != float("inf"))
    ready = stacked.withColumn("symbol", normalize_symbol(F.col("symbol"))).where(
        finite & (F.col("symbol") != "") & F.col("base_date").isNotNull() & (F.coalesce("feature_name", F.lit("")) != "")
    )
    last = F.max_by(F.struct("feature_value", *_FLAGS), F.struct("producer", "feature_value")).alias("last")
    rows = ready.groupBy("symbol", "base_date", "feature_name").agg(last).select("symbol", "base_date", "feature_name", "last.*")
    return rows.withColumn("available_at", F.coalesce("available_at", available_at(F.col("base_date"))))


def universe(static_universe: DataFrame, rankings: DataFrame) -> DataFrame:
    """Enabled watchlist and broker-sourced rows of the latest ranking date."""
    newest = rankings.agg(F.max("base_date").alias("d"))
    ranked = rankings.where((F.col("base_date") == newest.scalar()) & (F.col("source") == "KIS")).select("symbol")
    both = static_universe.where("enabled").select("symbol").unionByName(ranked)
    return both.select(normalize_symbol(F.col("symbol")).alias("symbol")).where(F.col("symbol") != "").distinct()


def readiness_gate(prices: DataFrame, master: DataFrame, target, open_now: Column | None = None, full_minimum: int = 100) -> DataFrame:
    """Whether the date has enough valid rows to compute features.

    With broker-detail rows on the date their symbols form the universe and
    max(10, n // 5) of them must be valid; else ``full_minimum`` stock rows.
    """
    rows = prices.where(F.col("base_date") == F.lit(target).cast("date"))
    per_symbol = rows.groupBy("symbol").agg(
        F.max(F.when(F.col("source") == "KIS_DETAIL", 1).otherwise(0)).alias("in_detail"),
        F.count_if(px.valid_row()).alias("valid"),
    )
    stock = master.where(F.col("market").isin("KOSPI", "KOSDAQ")).select("symbol", F.lit(True).alias("is_stock"))
    counts = per_symbol.join(stock, "symbol", "left").agg(
        F.coalesce(F.sum(F.when(F.col("is_stock"), F.col("valid"))), F.lit(0)).alias("valid_stock_rows"),
        F.coalesce(F.sum("in_detail"), F.lit(0)).alias("detail_symbols"),
        F.coalesce(F.sum(F.when(F.col("in_detail") == 1, F.col("valid"))), F.lit(0)).alias("detail_valid_rows"),
    )
    has_detail = F.col("detail_symbols") > 0
    need = F.when(has_detail, F.greatest(F.lit(10), F.floor(F.col("detail_symbols") / 5))).otherwise(full_minimum).cast("long")
    have = F.when(has_detail, F.col("detail_valid_rows")).otherwise(F.col("valid_stock_rows"))
    return counts.select(
        "*", need.alias("minimum_required"),
        F.when(have >= need, "READY").otherwise("SKIPPED_INSUFFICIENT_PRICE_DATA").alias("status"),
    )
