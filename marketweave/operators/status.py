"""The health of all tables as one document of seventeen panels.

Each panel is one row with one struct. What a panel says of a table's newest
day comes from one pass: the table is counted by day, partially before the
shuffle, and the newest day's counts are picked among the few days. Lists are
bounded by definition (tables, series, feature names, jobs of a week, named
samples) or cut to their first entries before they are collected.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from . import aggregates as agg, audits as au, joins as jn, prices as px

#: Symbols that the list of the static universe shows at most.
LISTED = 100

# What the panels name.
KEY_SERIES = ("KR_GOVT_10Y", "USDKRW", "KR_GOVT_3Y", "KR_CORP_AA_3Y", "KR_CORP_BBB_3Y")
KEY_FEATURES = ("KR_YIELD_SPREAD_10Y_3Y", "KR_CREDIT_SPREAD_AA_3Y", "KR_CREDIT_SPREAD_BBB_3Y", "USDKRW_1D_CHG_PCT", "KR10Y_1D_CHG_BP", "KR10Y_20D_CHG_BP")
PANELS = (
    "freshness", "universe_summary", "price_table_quality", "price_raw_normalized_field_quality", "static_universe_summary", "latest_global_macro", "latest_market_breadth", "latest_derivatives",
    "ecos_status", "disclosure_and_news_status", "stock_auxiliary_status", "ratio_and_short_quality", "ranking_status", "sample_stock_rows", "feature_checks", "pipeline_health", "quality_flags",
)


def newest_counts(df: DataFrame, **counts: Column) -> DataFrame:
    """One row: ``latest_date`` and the aggregates of that day's rows, in one pass; no rows give nulls."""
    per_day = df.groupBy("base_date").agg(*[c.alias(n) for n, c in counts.items()])
    picked = per_day.agg(F.max("base_date").alias("latest_date"), F.max_by(F.struct(*counts) if counts else F.struct("base_date"), "base_date").alias("newest"))
    return picked.select("latest_date", *[F.col(f"newest.{n}").alias(n) for n in counts])


def newest_row(df: DataFrame) -> DataFrame:
    """The newest row of a table of one row a day, without a sort."""
    return df.agg(F.max_by(F.struct(*df.columns), "base_date").alias("r")).select("r.*")


def _listed(df: DataFrame, order: list[str], descending: bool = False) -> DataFrame:
    """A bounded frame as one ordered list; ``order`` names its first columns."""
    item = F.struct(*order, *[c for c in df.columns if c not in order])
    return df.agg(F.sort_array(F.collect_list(item), asc=not descending).alias("rows"))


def first_rows(df: DataFrame, key: str, limit: int = LISTED) -> DataFrame:
    """The first rows by a unique key as one list, cut in every task before they meet."""
    return _listed(df.orderBy(key).limit(limit), [key])


def _cell(one_row: DataFrame, name: str) -> Column:
    return one_row.select(name).scalar()


def _panel(spark, **fields: Column) -> DataFrame:
    return spark.range(1).select(F.struct(*[c.alias(n) for n, c in fields.items()]).alias("panel"))


def _whole(one_row: DataFrame) -> DataFrame:
    return one_row.select(F.struct(*one_row.columns).alias("panel"))


def _on(counts: Mapping[str, Column]) -> list[Column]:
    return [c.alias(n) for n, c in counts.items()]


def freshness(dated: dict[str, DataFrame], target) -> DataFrame:
    """Newest date and lag of each named table, by name."""
    parts = [df.agg(F.max("base_date").alias("latest_date")).select(F.lit(name).alias("table_name"), "latest_date") for name, df in dated.items()]
    rows = agg.stack(parts).withColumn("lag_days", F.datediff(F.lit(target), "latest_date"))
    return _listed(rows, ["table_name"]).select(F.col("rows").alias("panel"))


def universe_summary(master: DataFrame, updates: DataFrame) -> DataFrame:
    counts = master.agg(F.count_if("is_active").alias("active_count"), F.count_if(~F.col("is_active")).alias("inactive_count"))
    return _whole(jn.beside(counts, updates.agg(F.max("base_date").alias("latest_updated_at"))))


def price_quality(prices: DataFrame) -> DataFrame:
    counted = newest_counts(prices, **{
        "latest_total_rows": F.count(F.lit(1)), "null_close_rows": F.count_if(F.col("close_price").isNull()), "null_volume_rows": F.count_if(F.col("volume").isNull()),
        "null_trading_value_rows": F.count_if(F.col("trading_value").isNull()), "snapshot_only_rows": F.count_if(px.snapshot_only()), "valid_price_rows": F.count_if(px.complete_row())})
    return _whole(counted.withColumnRenamed("latest_date", "latest_price_date").withColumn("status", au.price_status()))


def field_quality(raw: DataFrame, normalized: DataFrame, master: DataFrame) -> DataFrame:
    """Field presence of the newest landed and the newest normalised day."""
    sides = au.raw_vs_normalized(raw, normalized, master)
    names = ("base_date", "total_rows", "valid_close_rows", "valid_volume_rows", "valid_trading_value_rows", "market_not_null_rows")
    of = lambda side: F.max(F.when(F.col("side") == side, F.struct(*names))).alias(side)
    return _whole(sides.agg(of("raw"), of("normalized")))


def static_summary(static_universe: DataFrame, updates: DataFrame, limit: int = LISTED) -> DataFrame:
    """Counts, and the first symbols by code; the counts tell whether the list was cut."""
    counts = static_universe.agg(F.count_if("enabled").alias("enabled_count"), F.count_if(~F.col("enabled")).alias("disabled_count"))
    listed = first_rows(static_universe.select("symbol", "name", "market", "asset_type", "enabled"), "symbol", limit)
    dated = jn.beside(counts, updates.agg(F.max("base_date").alias("latest_updated_at")))
    return _whole(jn.beside(dated, listed.withColumnRenamed("rows", "symbols")))


def central_bank(raw: DataFrame, series: DataFrame) -> DataFrame:
    """Newest landed and normalised dates, and the key series on the newest day that any of them has."""
    keyed = series.where(F.col("series_id").isin(*KEY_SERIES))
    days = keyed.groupBy("base_date").agg(F.collect_list(F.struct("series_id", "base_date", "value")).alias("rows"))  # a row for each key series at most
    newest = days.agg(F.max("base_date").alias("normalized_latest_date"), F.max_by("rows", "base_date").alias("rows"))
    return _whole(jn.beside(raw.agg(F.max("base_date").alias("raw_latest_date")), newest.select("normalized_latest_date", F.sort_array("rows").alias("latest_key_series"))))


def told(disclosures: DataFrame, events: DataFrame) -> DataFrame:
    per = disclosures.groupBy("base_date", "source").agg(F.count(F.lit(1)).alias("row_count"))
    days = per.groupBy("base_date").agg(F.sort_array(F.collect_list(F.struct("source", F.col("base_date").alias("latest_date"), "row_count"))).alias("rows"))
    newest = days.agg(F.max("base_date").alias("latest_raw_disclosures_date"), F.max_by("rows", "base_date").alias("latest_sources"))
    dated = jn.beside(newest, events.agg(F.max("base_date").alias("latest_normalized_event_date")))
    return _whole(dated.withColumn("naver_news_expected_enabled", F.lit(False)))


def auxiliary(shorts: DataFrame, raw_shorts: DataFrame, statements: DataFrame, ratios: DataFrame) -> DataFrame:
    n = F.count(F.lit(1))
    short, raw = newest_counts(shorts, n=n), newest_counts(raw_shorts, n=n)
    last = lambda df: _cell(df.agg(F.max("base_date").alias("d")), "d")
    return _panel(
        shorts.sparkSession, latest_short_selling_date=_cell(short, "latest_date"), latest_raw_short_selling_date=_cell(raw, "latest_date"), latest_raw_short_selling_count=F.coalesce(_cell(raw, "n"), F.lit(0)),
        latest_normalized_short_selling_count=F.coalesce(_cell(short, "n"), F.lit(0)), latest_fundamentals_date=last(statements), latest_ratio_date=last(ratios))


def ratio_short(ratios: DataFrame, shorts: DataFrame) -> DataFrame:
    zero = {f"{n}_zero_rows": F.count_if(F.col(n) == 0) for n in ("per", "pbr", "roe", "debt_ratio")}
    left = newest_counts(ratios, **zero)
    left = left.select(F.col("latest_date").alias("latest_ratio_date"), F.struct(*[F.coalesce(n, F.lit(0)).alias(n) for n in zero]).alias("latest_ratio_zero_counts"))
    right = newest_counts(shorts, positive_short_missing_ratio_rows=F.count_if(px.suspicious_short())).withColumnRenamed("latest_date", "latest_short_selling_date")
    return _whole(jn.beside(left, right.withColumn("positive_short_missing_ratio_rows", F.coalesce("positive_short_missing_ratio_rows", F.lit(0)))))


def ranking_status(rankings: DataFrame, raw: DataFrame) -> DataFrame:
    n = F.count(F.lit(1))
    mine, landed = newest_counts(rankings, n=n), newest_counts(raw, n=n)
    left = mine.select(F.col("latest_date").alias("latest_ranking_date"), F.coalesce("n", F.lit(0)).alias("latest_normalized_count"))
    return _whole(jn.beside(left, landed.select(F.coalesce("n", F.lit(0)).alias("latest_raw_count"))))


def samples(symbols: tuple[str, ...], master, prices, supply, shorts, statements, ratios) -> DataFrame:
    """What each table says of a few named symbols on its newest day; an unknown symbol has nulls.

    Newest days are those of whole tables, except that statements have one for each symbol;
    of several rows the one with the greatest values stands.
    """
    spark = master.sparkSession
    named = spark.createDataFrame([(s,) for s in symbols], "symbol string")
    mine = lambda df: df.where(F.col("symbol").isin(*symbols))
    priced = jn.latest(prices).where(px.complete_row())
    rows = jn.sample_status(named, mine(master), mine(priced), mine(jn.latest(supply)), mine(jn.latest(shorts)), mine(statements), mine(ratios))
    kinds = dict(rows.dtypes)
    amounts = [c for t in (supply, shorts, statements, ratios) for c in t.columns if c in kinds and c not in ("symbol", "source")]
    shown = [*master.columns, "price_date", "close_price", "volume", "trading_value", "market_cap", "outstanding_shares", "supply_date", *supply.columns, "short_date", *shorts.columns, "statement_date", *amounts]
    shown = [c for c in dict.fromkeys(shown) if c in kinds and c != "symbol"]
    values = [F.col(c).cast("decimal(28,2)").alias(c) if kinds[c] == "double" else F.col(c) for c in shown]
    best = rows.groupBy("symbol").agg(F.max(F.struct(*values)).alias("r")).select("symbol", "r.*")
    return _listed(best, ["symbol"]).select(F.col("rows").alias("panel"))


def feature_checks(features: DataFrame, names: tuple[str, ...] = KEY_FEATURES) -> DataFrame:
    """Newest feature day, its market-wide rows, and the greatest value of each key feature of that day."""
    per = features.groupBy("base_date").agg(
        F.count_if(F.col("symbol") == "GLOBAL").alias("n"), *[F.max(F.when((F.col("symbol") == "GLOBAL") & (F.col("feature_name") == n), F.struct(F.coalesce("feature_value", F.lit(None).cast("double")).alias("v")))).alias(f"f{i}") for i, n in enumerate(names)])
    newest = per.agg(F.max("base_date").alias("d"), F.max_by(F.struct("n", *[f"f{i}" for i in range(len(names))]), "base_date").alias("r"))
    items = [F.when(F.col(f"r.f{i}").isNotNull(), F.struct(F.lit(n).alias("feature_name"), F.col(f"r.f{i}.v").cast("decimal(28,2)").alias("feature_value"))) for i, n in sorted(enumerate(names), key=lambda x: x[1])]
    return newest.select(F.struct(F.col("d").alias("latest_feature_date"), F.coalesce("r.n", F.lit(0)).alias("global_feature_count"), F.array_compact(F.array(*items)).alias("key_global_features")).alias("panel"))


def pipeline_health(logs: DataFrame, target) -> DataFrame:
    """Runs of the last week by day, newest first, then by job and status."""
    runs = agg.pipeline_health(logs, target)
    back = F.datediff(F.lit(target), "target_date")
    rows = _listed(runs.withColumn("back", back), ["back", "job_name", "status"])
    return rows.select(F.transform("rows", lambda r: F.struct(r["target_date"].alias("target_date"), r["job_name"].alias("job_name"), r["status"].alias("status"), r["occurrences"].alias("occurrences"), r["max_records_processed"].alias("max_records_processed"))).alias("panel"))


def quality_flags(series, wide, prices, supply, shorts, raw_shorts, statements, disclosures, events, sampled: tuple[str, ...], kr10y: str, flows: tuple[str, ...]) -> DataFrame:
    """Whether the newest day of each table has what a report needs."""
    spark = series.sparkSession
    held = jn.latest(prices).where("market_cap is not null and outstanding_shares is not null")
    ratio = supply.where("foreign_holding_ratio is not null")
    newest = newest_row(wide)
    some = lambda df: F.coalesce(_cell(df.agg((F.count(F.lit(1)) > 0).alias("x")), "x"), F.lit(False))
    by_source = newest_counts(disclosures, opendart=F.max(F.col("source") == "OpenDart"), news=F.max(F.col("source") == "NaverNews"))
    fields = [some(held.where(F.col("symbol") == s).join(ratio.where(F.col("symbol") == s), ["symbol", "base_date"], "left_semi")).alias(f"{s}_ok") for s in sampled]
    filled = F.lit(True)
    for f in flows:
        filled = filled & F.col(f).isNotNull()
    return _panel(
        spark, has_ecos_kr10y_today=some(series.where(F.col("series_id") == "KR_GOVT_10Y")),
        global_macro_has_kr10y=F.coalesce(_cell(newest.select(F.col(kr10y).isNotNull().alias("x")), "x"), F.lit(False)),
        global_macro_has_market_flows=some(jn.latest(supply).where(filled)), sample_rows_have_snapshot_fields=F.struct(*fields),
        disclosure_and_news_sources_present=F.struct(
            F.coalesce(_cell(by_source, "opendart"), F.lit(False)).alias("has_opendart_today"), F.coalesce(_cell(by_source, "news"), F.lit(False)).alias("has_navernews_today"), F.lit(False).alias("navernews_required_today")),
        normalized_aux_tables_present=F.struct(*_on({
            "has_raw_short_selling_today": some(raw_shorts), "has_short_selling_today": some(shorts), "has_fundamentals_today": some(statements), "has_events_today": some(events)})))


def document(panels: dict[str, DataFrame]) -> DataFrame:
    """One row, one JSON text: every panel under its name, in the fixed order; nulls are written."""
    if tuple(panels) != PANELS:
        raise ValueError(f"panels missing or out of order: {[p for p in PANELS if p not in panels]}")
    spark = next(iter(panels.values())).sparkSession
    cells = [df.select("panel").scalar().alias(name) for name, df in panels.items()]
    return spark.range(1).select(*cells).select(F.to_json(F.struct(*PANELS), {"ignoreNullFields": "false"}).alias("document"))
