"""Universe selection and the stock master."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions import markets as mk
from ..functions.symbols import normalize_symbol
from . import joins as jn, prices as px
from .aggregates import stack

# Universe sizes, source order and the ETFs a report always needs.
DEFAULT_LIMIT, HARD_LIMIT = 300, 500
CATEGORY_ORDER = ("static", "manual", "watchlist", "kis_volume_rank", "report_rank", "ranking")
CATEGORY_PRIORITY = {"static": 0, "manual": 1, "watchlist": 2, "kis_volume_rank": 3, "report_rank": 4, "ranking": 4}
DEFAULT_REQUIRED_ETFS = ("396500", "305720")


def static_members(static_universe: DataFrame) -> DataFrame:
    return static_universe.where("enabled").select(
        normalize_symbol(F.col("symbol")).alias("symbol"), "name", mk.standard_market(F.col("market")).alias("market"), F.lit("static").alias("category")
    )


def _ranked(rows: DataFrame, master: DataFrame) -> DataFrame:
    listed = master.select("symbol", mk.standard_market(F.col("market")).alias("master_market"), "asset_type", "name")
    return px.canonical(rows).withColumn("ranking_market", mk.standard_market(F.col("market"))).drop("market").join(listed, "symbol")


def latest_ranked(rankings: DataFrame, master: DataFrame) -> DataFrame:
    """Symbols of the latest ranking date whose market the master confirms."""
    rows = _ranked(jn.latest(rankings), master)
    ok = (F.col("ranking_market") == "KOSPI200") | F.col("ranking_market").eqNullSafe(F.col("master_market"))
    return rows.where(ok).select("symbol", "name", F.coalesce("master_market", "ranking_market").alias("market"), F.lit("ranking").alias("category")).distinct()


def latest_broker_ranked(rankings: DataFrame, master: DataFrame) -> DataFrame:
    """Symbols of the latest broker ranking date, master known."""
    rows = _ranked(jn.latest(rankings.where(F.col("source") == "KIS")), master)
    return rows.groupBy("symbol").agg(
        F.first("name").alias("name"), F.max(F.coalesce("master_market", "ranking_market")).alias("market")
    ).withColumn("category", F.lit("report_rank"))


def live_volume(broker_rows: DataFrame, master: DataFrame) -> DataFrame:
    """Symbols of broker volume rows whose asset type fits the market; a market outside the four stays."""
    rows = px.canonical(broker_rows.select("symbol")).join(master.select("symbol", "name", "market", "asset_type"), "symbol")
    wrong = (F.col("market").isin(*mk.STOCK_MARKETS) & (F.col("asset_type") != "STOCK")) | (
        F.col("market").isin(*mk.ETP_MARKETS) & (F.col("asset_type") != F.col("market"))
    )
    return rows.where(~F.coalesce(wrong, F.lit(False))).select("symbol", "name", "market", F.lit("kis_volume_rank").alias("category")).distinct()


def union_sources(parts: list[DataFrame]) -> DataFrame:
    """One row per symbol: first known name and market by part order, all categories sorted."""
    stacked = stack([df.select("symbol", "name", "market", "category", F.lit(i).alias("part")) for i, df in enumerate(parts)])
    first = lambda c: F.min_by(F.col(c), F.when(F.col(c).isNotNull(), F.struct("part", c)))
    return stacked.where(F.col("symbol") != "").groupBy("symbol").agg(
        F.coalesce(first("name"), F.first("symbol")).alias("name"), first("market").alias("market"),
        F.array_join(F.array_sort(F.collect_set("category")), ",").alias("source_category"),
    )


def _has(category: str) -> Column:
    return F.array_contains(F.split("source_category", ","), category)


def priority(order: dict | None = None) -> Column:
    table = order or CATEGORY_PRIORITY
    out = F.lit(max(table.values()) + 1)
    for name, rank in sorted(table.items(), key=lambda kv: -kv[1]):
        out = F.when(_has(name), F.lit(rank)).otherwise(out)
    return out


def top_universe(universe: DataFrame, limit: int | None = None) -> DataFrame:
    """Priority-ordered universe, ``DEFAULT_LIMIT`` symbols unless told otherwise; a limit outside 1 to ``HARD_LIMIT`` is refused."""
    size = DEFAULT_LIMIT if limit is None else limit
    if not 1 <= size <= HARD_LIMIT:
        raise ValueError(f"a detail universe has 1 to {HARD_LIMIT} symbols, not {size}")
    return universe.withColumn("priority", priority()).orderBy("priority", "symbol").limit(size)


def detail_universe(static_universe, rankings, broker_rows, master, limit: int | None = None) -> DataFrame:
    parts = [static_members(static_universe), live_volume(broker_rows, master), latest_broker_ranked(rankings, master)]
    return top_universe(union_sources(parts), limit)


def full_listing(sources: list[DataFrame], minimum: int = 2000) -> DataFrame:
    """The first listing with at least ``minimum`` stock rows; if none, the last."""
    last = len(sources) - 1
    tagged = stack([
        df.where(F.col("market").isin(*mk.STOCK_MARKETS)).select(normalize_symbol(F.col("code")).alias("symbol"), "name", "market", F.lit(i).alias("attempt"))
        for i, df in enumerate(sources)
    ])
    counts = tagged.groupBy("attempt").agg(F.count_distinct("symbol").alias("n"))
    chosen = counts.agg(F.coalesce(F.min(F.when(F.col("n") >= minimum, F.col("attempt"))), F.lit(last)).alias("attempt"))
    one = tagged.where(F.col("attempt") == chosen.scalar())
    return one.groupBy("symbol").agg(F.max("name").alias("name"), F.max("market").alias("market"), F.max("attempt").alias("attempt"))


def supply_market(raw_supply: DataFrame) -> DataFrame:
    """Market per symbol from the market code inside the landed flow JSON; the newest known row decides."""
    code = F.get_json_object("raw_data", "$.market_div_code")
    market = F.when(code == "J", "KOSPI").when(code == "Q", "KOSDAQ")
    return raw_supply.withColumn("market", market).where(F.col("market").isNotNull()).groupBy("symbol").agg(
        F.max_by("market", F.struct("base_date", "market")).alias("supply_market")
    )


def canonicalise(universe: DataFrame, listing: DataFrame, flow_markets: DataFrame) -> DataFrame:
    """Merge spellings of a symbol, then correct name, market and asset type from listing, name and flow code."""
    c = F.col
    merged = universe.select(normalize_symbol(c("symbol")).alias("symbol"), "name", mk.listing_market(c("market"), F.lit("")).alias("market"), "seq")
    etp = F.when(c("market").isin(*mk.ETP_MARKETS), c("market"))
    one = merged.groupBy("symbol").agg(
        F.min_by("name", F.struct("seq", "name")).alias("name"),
        F.coalesce(F.min_by(etp, F.when(etp.isNotNull(), F.struct("seq", "market"))),
                   F.min_by("market", F.when(c("market").isNotNull(), F.struct("seq", "market")))).alias("market"),
    )
    listed = listing.select("symbol", c("name").alias("l_name"), mk.listing_market(c("market"), F.lit("")).alias("l_market"))
    named = one.join(listed, "symbol", "left").join(flow_markets, "symbol", "left").select(
        "symbol", F.coalesce("l_name", "name").alias("name"), mk.prefer_standard(c("market"), c("l_market")).alias("market"), "supply_market"
    ).withColumn("by_name", mk.market_from_name(c("name")))
    settled = F.coalesce("by_name", "market", F.lit("KOSPI"))
    final = named.withColumn("market", F.coalesce("by_name", mk.prefer_standard(settled, c("supply_market"))))
    return final.select("symbol", "name", "market", F.when(c("market").isin(*mk.ETP_MARKETS), c("market")).otherwise("STOCK").alias("asset_type"))


def source_counts(universe: DataFrame, categories: tuple = ("static", "manual", "ranking", "kis_volume_rank", "report_rank")) -> DataFrame:
    return universe.agg(*[F.count_if(_has(c)).alias(c) for c in categories])


def _sources(snapshots, prices, features, rankings, target) -> dict[str, DataFrame]:
    """Distinct symbols of the date by where they come from."""
    day = F.col("base_date") == F.lit(target).cast("date")
    symbols = lambda df: px.canonical(df).select("symbol").where(F.col("symbol") != "").distinct()
    return {
        "detail": symbols(snapshots.where(day & (F.col("source") == "KIS_DETAIL"))), "price": symbols(prices.where(day & (F.col("source") == "KIS_DETAIL"))),
        "feature": symbols(features.where(day & (F.col("symbol") != "GLOBAL"))), "volume": symbols(rankings.where(day & (F.col("source") == "KIS") & (F.col("rank_type") == "volume"))),
    }


def misaligned(static_universe, report_rows, sources: dict[str, DataFrame]) -> DataFrame:
    """(symbol, problem): every enabled watchlist symbol that detail, features or report lack, or that the report holds stale."""
    watch = static_universe.where("enabled").select(normalize_symbol(F.col("symbol")).alias("symbol")).distinct()
    reported = report_rows.groupBy("symbol").agg(F.max(F.col("data_status").startswith("STALE")).alias("stale"), F.lit(1).alias("in_report"))
    flag = lambda name: sources[name].withColumn(f"in_{name}", F.lit(1))
    marked = watch.join(flag("detail"), "symbol", "left").join(flag("feature"), "symbol", "left").join(reported, "symbol", "left")
    lacks = lambda name, label: F.when(F.col(f"in_{name}").isNull(), label)
    problems = F.array_compact(F.array(lacks("detail", "missing_in_detail"), lacks("feature", "missing_in_feature"), lacks("report", "missing_in_report_view"), F.when(F.col("stale"), "stale_in_report_view")))
    return marked.select("symbol", F.explode(problems).alias("problem"))


def alignment(static_universe, snapshots, prices, features, report_rows, rankings, target) -> DataFrame:
    """Watchlist against detail, price, feature, report and rank symbols in counts, with a status; :func:`misaligned` has the symbols."""
    sources = _sources(snapshots, prices, features, rankings, target)
    size = lambda df: df.agg(F.count(F.lit(1)).alias("n")).scalar()
    problems = ("missing_in_detail", "missing_in_feature", "missing_in_report_view", "stale_in_report_view")
    found = misaligned(static_universe, report_rows, sources).agg(*[F.count_if(F.col("problem") == p).alias(p) for p in problems])
    return found.select(
        size(static_universe.where("enabled").select(normalize_symbol(F.col("symbol"))).distinct()).alias("static_enabled_count"), size(sources["detail"]).alias("detail_universe_count"),
        size(sources["price"]).alias("detail_price_symbols_count"), size(sources["feature"]).alias("feature_symbol_count"),
        size(report_rows.select("symbol").distinct()).alias("report_watchlist_count"), size(sources["volume"]).alias("volume_symbol_count"), *problems,
        F.when(F.col("missing_in_detail") > 0, "FAIL_STATIC_WATCHLIST_MISSING")
        .when((F.col("missing_in_feature") > 0) | (F.col("missing_in_report_view") > 0) | (F.col("stale_in_report_view") > 0), "WARN_UNIVERSE_MISMATCH")
        .otherwise("SUCCESS").alias("status"),
    )


def alignment_symbols(static_universe, snapshots, prices, features, report_rows, rankings, target) -> DataFrame:
    return misaligned(static_universe, report_rows, _sources(snapshots, prices, features, rankings, target))


# ---- stock master -----------------------------------------------------------


def master_record(listing: DataFrame, asset_type: Column, existing: DataFrame, protected: DataFrame) -> DataFrame:
    """Listing row to master row: active if protected, else as before, else inactive."""
    known = existing.select("symbol", F.col("is_active").alias("was_active"))
    guard = protected.select("symbol").distinct().withColumn("protected", F.lit(True))
    rows = px.canonical(listing).where(F.col("symbol") != "").withColumn("asset_type", asset_type)
    return rows.join(known, "symbol", "left").join(guard, "symbol", "left").select(
        "symbol", F.coalesce("name", "symbol").alias("name"), "market", "asset_type",
        F.coalesce("protected", "was_active", F.lit(False)).alias("is_active"),
    )


def merge_listings(parts: list[DataFrame]) -> DataFrame:
    """One row per symbol: an ETF/ETN row beats a stock row, else the later part wins."""
    stacked = stack([df.withColumn("part", F.lit(i)) for i, df in enumerate(parts)])
    is_etp = F.col("market").isin(*mk.ETP_MARKETS)
    row = F.struct("name", "market", "asset_type", "is_active")
    return stacked.groupBy("symbol").agg(F.max_by(row, F.struct(is_etp, "part", "name")).alias("r")).select("symbol", "r.*")


def sync_static(master: DataFrame, existing_static: DataFrame, file_rows: DataFrame) -> DataFrame:
    """Master after the watchlist file is applied: removed and disabled symbols go, enabled ones are upserted as active."""
    rows = px.canonical(file_rows).withColumn("listed", mk.listing_market(F.col("market"), F.col("name")))
    rows = rows.withColumns({
        "market": F.coalesce("listed", F.lit("KOSPI")),
        "asset_type": F.when(F.col("listed").isin(*mk.ETP_MARKETS), F.col("listed")).otherwise("STOCK"),
    })
    removed = existing_static.select("symbol").join(rows.select("symbol"), "symbol", "left_anti")
    touched = removed.unionByName(rows.select("symbol")).distinct()
    columns = ["symbol", "name", "market", "asset_type", "is_active"]
    kept = master.select(*columns).join(touched, "symbol", "left_anti")
    enabled = rows.where("enabled").withColumn("is_active", F.lit(True)).select(*columns)
    return kept.unionByName(enabled)


def sync_universe(universe: DataFrame, master: DataFrame, activate_new: bool = False) -> DataFrame:
    """Universe to master rows: the first row of a symbol, keeping or setting the active flag."""
    one = px.canonical(universe).where(F.col("symbol") != "").groupBy("symbol").agg(F.min_by(F.struct("name", "market"), F.struct("seq", "name")).alias("r"))
    active = master.where("is_active").select("symbol", F.lit(True).alias("active"))
    listed = one.select("symbol", "r.name", mk.listing_market(F.col("r.market"), F.col("r.name")).alias("listed"))
    return listed.join(active, "symbol", "left").select(
        "symbol", F.coalesce("name", "symbol").alias("name"), F.coalesce("listed", F.lit("KOSPI")).alias("market"),
        F.when(F.col("listed").isin(*mk.ETP_MARKETS), F.col("listed")).otherwise("STOCK").alias("asset_type"),
        (F.lit(activate_new) | F.coalesce("active", F.lit(False))).alias("is_active"),
    )


def deactivate_missing(master: DataFrame, current: DataFrame, protected: DataFrame) -> DataFrame:
    """Master with rows switched off that are no longer listed nor protected."""
    keep = current.select("symbol").unionByName(protected.select("symbol")).distinct().withColumn("keep", F.lit(True))
    off = F.col("keep").isNull() & F.coalesce(F.col("market").isin(*mk.MASTER_MARKETS), F.lit(False))
    return master.join(keep, "symbol", "left").withColumn("is_active", F.col("is_active") & ~off).drop("keep")


def required_etfs(static_universe: DataFrame, file_rows: DataFrame) -> DataFrame:
    """Watchlist and file ETFs; two default symbols when there are none."""
    etf = lambda df: px.canonical(df.where("enabled")).where(mk.listing_market(F.col("market"), F.lit("")) == "ETF").select("symbol")
    known = etf(static_universe).unionByName(etf(file_rows)).distinct()
    none = known.agg(F.count(F.lit(1)).alias("n"))
    defaults = static_universe.sparkSession.range(1).select(F.explode(F.array(*[F.lit(s) for s in DEFAULT_REQUIRED_ETFS])).alias("symbol"))
    return known.unionByName(defaults.where(none.scalar() == 0))


def etf_targets(required: DataFrame, rankings: DataFrame) -> DataFrame:
    ranked = px.canonical(jn.latest(rankings.where(F.col("market") == "ETF"))).select("symbol")
    return required.unionByName(ranked).where(F.col("symbol") != "").distinct()


def etf_coverage(targets: DataFrame, prices: DataFrame, open_days: DataFrame, target: date, lookback_days: int = 10) -> DataFrame:
    """Each target ETF: covered, stale or missing on the latest open day."""
    goal = open_days.where(F.col("base_date") <= F.lit(target)).agg(F.max("base_date").alias("d"))
    rows = px.canonical(prices.where(px.complete_row() & (F.col("base_date") <= goal.scalar()) & (F.col("base_date") >= F.date_sub(goal.scalar(), lookback_days))))
    seen = rows.groupBy("symbol").agg(F.max("base_date").alias("latest_date"))
    fresh = F.col("latest_date") == goal.scalar()
    return targets.join(seen, "symbol", "left").select(
        "symbol", "latest_date", F.when(F.col("latest_date").isNull(), "missing").when(fresh, "covered").otherwise("stale").alias("coverage")
    )


def snapshot_repair_candidates(master: DataFrame, prices: DataFrame, supply: DataFrame, target) -> DataFrame:
    """Active symbols lacking a price row, cap, shares or holding ratio on a date; only valid price rows may be updated."""
    day = F.col("base_date") == F.lit(target).cast("date")
    priced = prices.where(day).select("symbol", "market_cap", "outstanding_shares", px.valid_row_lenient().alias("price_updatable"), F.lit(True).alias("has_price"))
    flows = supply.where(day).select("symbol", "foreign_holding_ratio")
    joined = master.where("is_active").select("symbol").join(priced, "symbol", "left").join(flows, "symbol", "left")
    lacking = F.col("market_cap").isNull() | F.col("outstanding_shares").isNull() | F.col("foreign_holding_ratio").isNull()
    return joined.where(lacking).select(
        "symbol", F.coalesce("has_price", F.lit(False)).alias("has_price"), F.coalesce("price_updatable", F.lit(False)).alias("price_updatable"),
        F.col("foreign_holding_ratio").isNull().alias("needs_supply_ratio"),
    )


def incremental_start(wanted: DataFrame, loaded: DataFrame, end: date, first_day: str = "2010-01-01") -> DataFrame:
    """Next date to load per series, and whether it is already past the end."""
    newest = loaded.groupBy("series_id").agg(F.max("base_date").alias("latest"))
    start = F.coalesce(F.date_add("latest", 1), F.lit(first_day).cast("date"))
    return wanted.select("series_id").join(newest, "series_id", "left").select(
        "series_id", "latest", start.alias("start_date"), (start > F.lit(end)).alias("skip")
    )


def full_price_skip(prices: DataFrame, master: DataFrame, day: DataFrame, minimum: int = 2000) -> DataFrame:
    """Skip a full load when the latest valid date already has enough complete stock rows."""
    stock = master.where(F.col("market").isin(*mk.STOCK_MARKETS) & (F.col("asset_type") == "STOCK")).select("symbol")
    rows = prices.where((F.col("base_date") == day.scalar()) & px.complete_row()).join(stock, "symbol", "left_semi")
    counted = rows.agg(F.count(F.lit(1)).alias("valid_stock_rows"))
    return counted.select(day.scalar().alias("latest_date"), "valid_stock_rows", (F.col("valid_stock_rows") >= minimum).alias("skip"))
