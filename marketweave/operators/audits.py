"""Data-quality audits: each returns its counts and one ``status``.

An audit reads each table with one aggregate where it can; lists in the result
name watchlist or master symbols only, so they are bounded by those.
"""

from __future__ import annotations

from datetime import date, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions import markets as mk, sanity as sn
from ..functions.symbols import is_q_symbol, normalize_symbol
from . import calendar as cal, joins as jn, prices as px, windows as win
from .aggregates import stack

# Thresholds of the audits.
KOSPI_READY, KOSDAQ_READY = 700, 1200
CORE_SERIES = ("KR_GOVT_10Y", "KR_GOVT_3Y", "USDKRW", "KR_CD_91D", "KR_CORP_AA_3Y")
WATCHED_SERIES = ("KR_GOVT_10Y", "USDKRW")
COVERAGE_MINIMUM = {"prices": 0.7, "supply": 0.4}
COVERED_KINDS = ("prices", "supply", "ratios", "covered")
MARKETS = mk.MASTER_MARKETS


def ladder(steps: list[tuple[Column, str]], default: str = "SUCCESS") -> Column:
    """First step whose condition is true."""
    out = F.lit(default)
    for cond, label in reversed(steps):
        out = F.when(cond, F.lit(label)).otherwise(out)
    return out


def lit_date(day) -> Column:
    return F.lit(day).cast("date")


def one(df: DataFrame, agg: Column) -> Column:
    """A single aggregate of a table as a scalar subquery."""
    return df.agg(agg.alias("v")).scalar()


def size(df: DataFrame) -> Column:
    return one(df, F.count(F.lit(1)))


def row(spark) -> DataFrame:
    return spark.range(1).drop("id")


def goal_day(open_days: DataFrame, target) -> DataFrame:
    return open_days.where(F.col("base_date") <= lit_date(target)).agg(F.max("base_date").alias("goal_day"))


def with_market(df: DataFrame, master: DataFrame) -> DataFrame:
    listed = master.select("symbol", F.col("market").alias("m"), F.col("asset_type").alias("a"))
    return px.canonical(df).join(listed, "symbol", "left")


# ---- freshness and price tables ---------------------------------------------


def covered_stats(df: DataFrame, active: DataFrame, goal: Column, counts: Column) -> DataFrame:
    """One row: rows, newest day, rows of the goal day, distinct active symbols with a row of the newest day where ``counts`` holds.

    A symbol covers the newest day if the newest of its counting days is that day, so one
    hash aggregate by symbol, reduced in the map tasks, answers all four in one scan.
    """
    day = F.col("base_date")
    symbols = df.groupBy("symbol").agg(
        F.count(F.lit(1)).alias("n"), F.max(day).alias("newest"), F.count_if(day == goal).alias("on_goal"), F.max(F.when(counts, day)).alias("seen"))
    marked = symbols.join(active.select("symbol", F.lit(True).alias("listed")).distinct(), "symbol", "left")
    by_day = marked.groupBy("seen").agg(F.sum("n").alias("n"), F.max("newest").alias("newest"), F.sum("on_goal").alias("on_goal"), F.count("listed").alias("found"))
    found = F.when(F.max("seen") == F.max("newest"), F.max_by("found", "seen"))
    return by_day.agg(*_stats(F.sum("n"), F.max("newest"), F.sum("on_goal"), F.coalesce(found, F.lit(0))))


def _stats(rows: Column, newest: Column, on_goal: Column, covered: Column) -> list[Column]:
    return [F.coalesce(rows, F.lit(0)).alias("row_count"), newest.alias("latest_date"), F.coalesce(on_goal, F.lit(0)).alias("target_count"), covered.cast("long").alias("covered")]


def table_freshness(tables: dict[str, tuple[DataFrame, str]], active: DataFrame, target, is_open: Column) -> DataFrame:
    """Per table: rows, latest date, target rows, active-symbol coverage, staleness, status.

    The second item of a table is its kind: ``prices``, ``supply``, ``ratios`` (market rows with
    coverage), ``covered`` (coverage only), ``shorts``, ``krx`` (market rows without coverage),
    ``legacy`` (not needed any more) or ``other``.
    Each table is read once.
    """
    goal, parts = lit_date(target), []
    active_n = size(active)
    for name, (df, kind) in tables.items():
        if kind in COVERED_KINDS:
            stats = covered_stats(df, active, goal, px.valid_row() if kind == "prices" else F.lit(True))
        else:
            stats = df.agg(*_stats(F.count(F.lit(1)), F.max("base_date"), F.count_if(F.col("base_date") == goal), F.lit(None)))
        parts.append(stats.select(F.lit(name).alias("table_name"), F.lit(kind).alias("kind"), "row_count", "latest_date", "target_count", "covered"))
    rows = stack(parts).withColumns({
        "coverage": F.col("covered") / F.greatest(active_n, F.lit(1)),
        "missing": F.when(F.col("covered").isNotNull(), active_n - F.col("covered")),
        "stale_days": F.datediff(goal, "latest_date"),
    })
    kind, stale = F.col("kind"), F.col("stale_days")
    krx = kind.isin("prices", "supply", "ratios", "krx") & ~is_open
    status = ladder([
        (kind == "legacy", "LEGACY"),
        (F.col("row_count") == 0, "FAIL_EMPTY"),
        (stale.isNull(), "FAIL_SCHEMA"),
        ((kind == "shorts") & (stale > 5), "WARN_STALE"),
        (kind == "shorts", "SUCCESS"),
        (krx & (F.col("target_count") > 0), "WARN_CLOSED_MARKET_ROWS"),
        (krx, "OK_CLOSED_MARKET_NO_ROWS"),
        ((kind == "prices") & (F.col("coverage") < COVERAGE_MINIMUM["prices"]), "WARN_COVERAGE"),
        ((kind == "supply") & (F.col("coverage") < COVERAGE_MINIMUM["supply"]), "WARN_COVERAGE"),
        (stale > 5, "WARN_STALE"),
        ((F.col("target_count") == 0) & (stale > 0), "WARN_NO_TARGET_ROWS"),
    ])
    return rows.select("table_name", "row_count", "latest_date", "target_count", "coverage", "missing", "stale_days", status.alias("status"))


def core_macro_freshness(wanted: DataFrame, series: DataFrame, target) -> DataFrame:
    newest = series.groupBy("series_id").agg(F.max("base_date").alias("latest_date"))
    rows = wanted.join(newest, "series_id", "left").withColumn("stale_days", F.datediff(lit_date(target), "latest_date"))
    watched, stale = F.col("series_id").isin(*WATCHED_SERIES), F.col("stale_days")
    status = ladder([
        (stale.isNull(), "FAIL_EMPTY"), (watched & (stale > 5), "FAIL_STALE"), (watched & (stale > 2), "WARN_STALE"), (stale > 5, "WARN_STALE"),
    ])
    return rows.select("series_id", "latest_date", "stale_days", status.alias("status"))


def price_counts() -> list[Column]:
    null = lambda n: F.count_if(F.col(n).isNull()).alias(f"null_{n.replace('_price', '')}_rows")
    return [
        F.count(F.lit(1)).alias("latest_total_rows"), null("close_price"), null("volume"), null("trading_value"),
        F.count_if(px.snapshot_only()).alias("snapshot_only_rows"), F.count_if(px.valid_row()).alias("valid_price_rows"),
    ]


def price_status() -> Column:
    total, ok = F.col("latest_total_rows"), F.col("valid_price_rows")
    return ladder([
        (F.col("snapshot_only_rows") > 0, "FAIL_PRICE_QUALITY"), (ok == 0, "FAIL_NO_VALID_PRICE_ROWS"),
        ((total > 0) & (ok / total < 0.8), "WARN_PRICE_NULL_RATIO"),
    ])


def price_table(prices: DataFrame) -> DataFrame:
    rows = jn.latest(prices)
    return rows.agg(F.max("base_date").alias("latest_price_date"), *price_counts()).withColumn("status", price_status())


def raw_vs_normalized(raw: DataFrame, normalized: DataFrame, master: DataFrame) -> DataFrame:
    """Field presence at each side's own latest date; ``raw`` has close, volume and value texts."""
    listed = master.where(F.col("market").isin(*MARKETS)).select("symbol", F.lit(1).alias("listed"))
    panel = lambda df, side: jn.latest(df).join(listed, "symbol", "left").agg(
        F.max("base_date").alias("base_date"), F.count(F.lit(1)).alias("total_rows"), F.count("close_price").alias("valid_close_rows"),
        F.count("volume").alias("valid_volume_rows"), F.count("trading_value").alias("valid_trading_value_rows"), F.count("listed").alias("market_not_null_rows"),
    ).withColumn("side", F.lit(side))
    return panel(raw, "raw").unionByName(panel(normalized, "normalized"))


def ratio_short(ratios: DataFrame, shorts: DataFrame) -> DataFrame:
    zero = lambda n: F.count_if(F.col(n) == 0).alias(f"{n}_zero_rows")
    left = jn.latest(ratios).agg(F.max("base_date").alias("ratio_date"), *[zero(n) for n in ("per", "pbr", "roe", "debt_ratio")])
    right = jn.latest(shorts).agg(F.max("base_date").alias("short_date"), F.count(F.lit(1)).alias("short_rows"), F.count_if(px.suspicious_short()).alias("positive_short_missing_ratio_rows"))
    return jn.beside(left, right)


# ---- symbols, master and rankings -------------------------------------------


def _spellings(df: DataFrame) -> DataFrame:
    """Rows of each canonical symbol with and without the Q prefix."""
    spelled = df.groupBy("symbol").agg(F.count(F.lit(1)).alias("n")).withColumns({"q": is_q_symbol(F.col("symbol")), "canonical": normalize_symbol(F.col("symbol"))})
    rows = lambda cond: F.sum(F.when(cond, F.col("n")).otherwise(0))
    return spelled.groupBy("canonical").agg(rows(F.col("q")).alias("q_rows"), rows(~F.col("q")).alias("plain_rows"))


def symbol_candidates(tables: dict[str, DataFrame]) -> DataFrame:
    """The symbols that a table holds in both spellings, one row each: what a repair would merge."""
    found = [_spellings(df).where("q_rows > 0 and plain_rows > 0").select(F.lit(name).alias("table_name"), F.col("canonical").alias("symbol"), "q_rows", "plain_rows") for name, df in tables.items()]
    return stack(found)


def symbol_normalization(tables: dict[str, DataFrame]) -> DataFrame:
    """Q-prefixed rows per table, and how many of their symbols also exist in canonical spelling."""
    parts = []
    for name, df in tables.items():
        parts.append(_spellings(df).agg(
            F.coalesce(F.sum("q_rows"), F.lit(0)).alias("q_prefix_rows"), F.count_if((F.col("q_rows") > 0) & (F.col("plain_rows") > 0)).alias("canonical_duplicates")
        ).select(F.lit(name).alias("table_name"), "q_prefix_rows", "canonical_duplicates"))
    return stack(parts).withColumn("status", ladder([(F.col("q_prefix_rows") > 0, "FAIL_SYMBOL_NORMALIZATION")]))


def market_ranking(rankings: DataFrame, master: DataFrame) -> DataFrame:
    """Per market and type of the latest date: rows, rows without master, market mismatches, Q prefixes."""
    listed = master.select("symbol", F.coalesce("market", F.lit("UNKNOWN")).alias("m"))
    rows = jn.latest(rankings).join(listed, "symbol", "left")
    q, unknown = is_q_symbol(F.col("symbol")), F.col("m").isNull()
    wrong = ~unknown & (F.col("market") != "KOSPI200") & (F.col("m") != F.col("market"))
    per = rows.groupBy("market", "rank_type").agg(
        F.count(F.lit(1)).alias("row_count"), F.count_if(unknown).alias("no_master_rows"), F.count_if(wrong).alias("market_mismatch_rows"), F.count_if(q).alias("q_prefix_rows"))
    status = ladder([
        (F.col("q_prefix_rows") > 0, "FAIL_SYMBOL_NORMALIZATION"),
        ((F.col("market") == "KOSPI") & (F.col("market_mismatch_rows") > 0), "FAIL_RANKING_MARKET_MISMATCH"),
    ])
    return per.withColumn("status", status)


def missing_rankings(rankings: DataFrame, expected: list[tuple[str, str]]) -> Column:
    """Comma list of the expected (market, type) pairs the latest date lacks."""
    have = jn.latest(rankings).agg(F.collect_set(F.concat_ws(":", "market", "rank_type")).alias("s")).scalar()
    wanted = F.array(*[F.lit(f"{m}:{t}") for m, t in expected])
    return F.array_join(F.sort_array(F.array_except(wanted, have)), ",")


def market_master(master: DataFrame, kosdaq_minimum: int = 1000, etf_minimum: int = 100) -> DataFrame:
    market = mk.standard_market(F.col("market"))
    counted = master.withColumn("m", market).agg(
        *[F.count_if(F.col("m") == m).alias(m.lower()) for m in MARKETS], F.count_if(~F.coalesce(F.col("m").isin(*MARKETS), F.lit(False))).alias("unknown_market"),
        (F.count("symbol") - F.count_distinct("symbol")).alias("duplicate_symbols"), F.count_if(is_q_symbol(F.col("symbol"))).alias("q_prefix"))
    return counted.withColumn("status", ladder([
        (F.col("q_prefix") > 0, "FAIL_SYMBOL_NORMALIZATION"), (F.col("kosdaq") < kosdaq_minimum, "FAIL_KOSDAQ_MASTER"),
        (F.col("etf") < etf_minimum, "WARN_ETF_MASTER"), (F.col("etn") == 0, "WARN_ETN_MASTER"),
    ]))


def day_market_counts(prices: DataFrame, master: DataFrame, day: DataFrame) -> DataFrame:
    """Total, valid and zero-volume rows per market of one day, as one row."""
    rows = with_market(prices.where(F.col("base_date") == day.scalar()), master)
    ok = px.valid_row()
    zero = ~ok & F.col("close_price").isNotNull() & ((F.coalesce("volume", F.lit(0)) <= 0) | (F.coalesce("trading_value", F.lit(0)) <= 0))
    cols = []
    for m in MARKETS:
        mine = F.col("m") == m
        cols += [F.count_if(mine).alias(f"{m.lower()}_total"), F.count_if(mine & ok).alias(f"{m.lower()}_valid"), F.count_if(mine & zero).alias(f"{m.lower()}_zero")]
    return rows.agg(*cols)


def price_coverage_by_market(prices, master, open_days, target, kospi: int = KOSPI_READY, kosdaq: int = KOSDAQ_READY) -> DataFrame:
    day = goal_day(open_days, target)
    counts = day_market_counts(prices, master, day)
    source = F.coalesce("source", F.lit("UNKNOWN"))
    mix = prices.where(F.col("base_date") == day.scalar()).groupBy(source.alias("s")).agg(F.count(F.lit(1)).alias("n"))
    mix_text = mix.agg(F.array_join(F.array_sort(F.collect_list(F.concat_ws("=", "s", F.col("n").cast("string")))), ",").alias("t")).scalar()
    short = (F.col("kospi_valid") < kospi) | (F.col("kosdaq_valid") < kosdaq)
    zeros = reduce(lambda a, b: a + b, [F.col(f"{m.lower()}_zero") for m in MARKETS])
    ready = lambda col, need, yes, no: F.when(F.col(col) >= need, yes).otherwise(no)
    return counts.select(
        "*", ready("kospi_valid", kospi, "KOSPI_PRICE_READY", "FAIL_KOSPI_PRICE_COVERAGE").alias("kospi_readiness"),
        ready("kosdaq_valid", kosdaq, "KOSDAQ_PRICE_READY", "FAIL_KOSDAQ_PRICE_COVERAGE").alias("kosdaq_readiness"),
        ready("etf_valid", 1, "ETF_PRICE_READY", "WARN_ETF_PRICE_COVERAGE").alias("etf_readiness"), ready("etn_valid", 1, "ETN_PRICE_READY", "WARN_ETN_PRICE_COVERAGE").alias("etn_readiness"),
        mix_text.alias("source_mix"), ladder([(short, "FAIL_INSUFFICIENT_STOCK_PRICE_ROWS"), (zeros > 0, "WARN_OPEN_MARKET_ZERO_VOLUME_ROWS")]).alias("status"),
    )


def stock_valid(prices, master, day: DataFrame) -> DataFrame:
    """Valid stock rows per stock market of one day, as one row."""
    rows = with_market(prices.where((F.col("base_date") == day.scalar()) & px.valid_row()), master)
    stock = F.col("a") == "STOCK"
    return rows.agg(F.count_if(stock & (F.col("m") == "KOSPI")).alias("kospi_rows"), F.count_if(stock & (F.col("m") == "KOSDAQ")).alias("kosdaq_rows"))


def full_market_coverage(prices, master, open_days, target, kospi: int = KOSPI_READY, kosdaq: int = KOSDAQ_READY) -> DataFrame:
    day = goal_day(open_days, target)
    a, b = F.col("kospi_rows") >= kospi, F.col("kosdaq_rows") >= kosdaq
    return stock_valid(prices, master, day).select(
        day.scalar().alias("goal_day"), "kospi_rows", "kosdaq_rows", (a & b).alias("full_market_price_ready"),
        ladder([(a & b, "SUCCESS"), (~a & ~b, "WARN_KR_STOCK_PRICE_COVERAGE")], "WARN_PARTIAL_KR_STOCK_PRICE_COVERAGE").alias("status"),
    )


def failed_count(message: Column) -> Column:
    """The number behind ``failed_symbols_count=`` in a run-log message, 0 if absent."""
    found = F.regexp_extract(message, r"failed_symbols_count=([0-9]+)", 1)
    return F.coalesce(F.when(found != "", found).try_cast("long"), F.lit(0).cast("long"))


def universe_coverage(logs, snapshots, ratios, prices, target, job: str = "daily_kis_universe_pipeline") -> DataFrame:
    """Detail universe of the job's latest run date: raw, valid, snapshot and ratio counts, failures of the log."""
    mine = logs.where((F.col("job_name") == job) & (F.col("target_date") <= lit_date(target)))
    last = mine.agg(F.max("target_date").alias("d"), F.max_by("error_message", F.struct("target_date", "run_id")).alias("msg"), F.max_by("status", F.struct("target_date", "run_id")).alias("log_status"))
    day = last.select("d").scalar()
    detail = (F.col("base_date") == day) & (F.col("source") == "KIS_DETAIL")
    raw = px.canonical(prices.where(detail)).select("symbol").distinct()
    valid = px.canonical(prices.where((F.col("base_date") == day) & px.valid_row())).select("symbol").distinct().join(raw, "symbol", "left_semi")
    counted = last.select(
        F.col("d").alias("run_date"), "log_status", failed_count(F.col("msg")).alias("logged_failures"), size(raw).alias("detail_success_count"), size(valid).alias("price_valid_count"),
        size(snapshots.where(detail)).alias("snapshot_success_count"), size(ratios.where(detail)).alias("ratio_success_count"),
    ).withColumn("universe_count", F.greatest("detail_success_count", "snapshot_success_count", "ratio_success_count"))
    gap = F.col("universe_count") - F.col("detail_success_count")
    return counted.withColumn("failed_symbols_count", F.when(F.col("logged_failures") > 0, F.col("logged_failures")).otherwise(gap)).withColumn("status", ladder([
        (F.col("universe_count") == 0, "FAIL_KIS_UNIVERSE_EMPTY"), ((F.col("failed_symbols_count") > 0) | (gap > 0), "WARN_PARTIAL_KIS_UNIVERSE_COVERAGE"),
    ]))


def ranking_source(rankings, master, prices, target, kospi: int = KOSPI_READY, kosdaq: int = KOSDAQ_READY) -> DataFrame:
    """Latest ranking date: counts by source, mismatches, and whether price-based rows of a thin market are present."""
    listed = master.select("symbol", F.coalesce("market", F.lit("UNKNOWN")).alias("m"))
    rows = jn.latest(rankings).join(listed, "symbol", "left")
    vol = F.col("rank_type") == "volume"
    of = lambda m: F.col("market") == m
    counts = rows.agg(
        F.max("base_date").alias("latest_date"),
        *[F.count_if(vol & of(m) & (F.col("source") == s)).alias(f"{m.lower()}_volume_{s.lower()}") for m in mk.STOCK_MARKETS for s in ("KIS", "VALID_PRICE_FALLBACK")],
        *[F.count_if(vol & of(m)).alias(f"{m.lower()}_volume") for m in MARKETS],
        F.count_if(F.col("m").isNotNull() & (F.col("m") != F.col("market"))).alias("mismatch_rows"), F.count_if(is_q_symbol(F.col("symbol"))).alias("q_prefix_rows"),
        *[F.coalesce(F.max(of(m) & (F.col("source") != "KIS")), F.lit(False)).alias(f"{m.lower()}_price_based") for m in mk.STOCK_MARKETS],
    )
    valid = stock_valid(prices, master, jn.latest(rankings).agg(F.max("base_date").alias("d")))
    joined = jn.beside(counts, valid)
    current = F.col("latest_date") == lit_date(target)
    thin_a, thin_b = F.col("kospi_rows") < kospi, F.col("kosdaq_rows") < kosdaq
    return joined.withColumn("stale_days", F.datediff(lit_date(target), "latest_date")).withColumn("status", ladder([
        (current & ((F.col("kospi_price_based") & thin_a) | (F.col("kosdaq_price_based") & thin_b)), "FAIL_STALE_KR_RANKING_PRESENT"),
        (current & (thin_a | thin_b), "OK_SKIPPED_INSUFFICIENT_PRICE_DATA"), (F.col("kosdaq_volume") == 0, "FAIL_KOSDAQ_VOLUME_RANK"),
        (F.col("mismatch_rows") > 0, "FAIL_RANKING_MARKET_MISMATCH"), (F.col("q_prefix_rows") > 0, "FAIL_SYMBOL_NORMALIZATION"), (F.col("kospi_volume") < 1, "WARN_KOSPI_VOLUME_SPARSE"),
    ]))


def ranking_source_date(rankings: DataFrame) -> DataFrame:
    """Latest ranking date: rows whose source date is missing or differs; the landed JSON fills a missing one."""
    stored = F.get_json_object("raw_data", "$.price_base_date").try_cast("date")
    rows = jn.latest(rankings).withColumn("effective", F.coalesce("source_base_date", stored))
    kr, etp = F.col("market").isin(*mk.STOCK_MARKETS), F.col("market").isin(*mk.ETP_MARKETS)
    missing = kr & (F.col("source") == "VALID_PRICE_FALLBACK") & F.col("effective").isNull()
    differs = F.coalesce(F.col("effective") != F.col("base_date"), F.lit(False))
    return rows.agg(
        F.max("base_date").alias("latest_date"), F.count_if(kr & ~missing & differs).alias("kr_stale_ranking_rows"), F.count_if(missing).alias("kr_missing_source_date_rows"),
        F.count_if(etp & differs).alias("etf_etn_fallback_rows"),
    ).withColumn("status", ladder([(F.col("kr_missing_source_date_rows") > 0, "FAIL_RANKING_SOURCE_DATE_MISSING"), (F.col("kr_stale_ranking_rows") > 0, "WARN_STALE_KR_STOCK_RANKING")]))


def _any(cond: Column) -> Column:
    return F.coalesce(F.max(cond), F.lit(False))


def ranking_flags(rows: DataFrame) -> DataFrame:
    kr, kind, broker = F.col("market").isin(*mk.STOCK_MARKETS), F.col("rank_type"), F.col("source") == "KIS"
    return rows.agg(
        _any(broker & (kind == "volume") & kr).alias("kis_volume_ready"), _any(broker & (kind == "trading_value") & kr).alias("kis_trading_value_ready"),
        _any(~broker & (kind == "trading_value") & kr).alias("full_market_trading_value_ready"), _any((kind == "market_cap") & kr).alias("full_market_market_cap_ready"))


def ranking_readiness(rankings: DataFrame) -> DataFrame:
    return ranking_flags(jn.latest(rankings)).withColumn("status", ladder([(~F.col("kis_volume_ready"), "FAIL_KIS_VOLUME_RANKING_NOT_READY")]))


def report_readiness(prices, master, rankings, logs, static_universe, features, open_days, target, kospi: int = KOSPI_READY, kosdaq: int = KOSDAQ_READY) -> DataFrame:
    """Which report sections may be written, and the overall status."""
    goal, day = lit_date(target), goal_day(open_days, target)
    counts = day_market_counts(prices, master, day)
    flags = ranking_flags(rankings.where(F.col("base_date") == day.scalar()))
    log = logs.where((F.col("job_name") == "daily_kis_universe_pipeline") & (F.col("target_date") <= goal)).agg(F.max_by("status", F.struct("target_date", "run_id")).alias("s")).scalar()
    watch = static_universe.where("enabled").select("symbol")
    covered = px.canonical(prices.where((F.col("base_date") == goal) & F.col("source").isin("KIS_DETAIL", "KIS") & px.valid_row())).join(watch, "symbol", "left_semi")
    featured = px.canonical(features.where((F.col("base_date") == goal) & (F.col("symbol") != "GLOBAL")))
    joined = jn.beside(counts, flags).select(
        "*", F.coalesce(log.startswith("SUCCESS") | log.startswith("WARN_PARTIAL"), F.lit(False)).alias("universe_ready"), one(covered, F.count_distinct("symbol")).alias("watchlist_covered"),
        one(featured, F.count_distinct("symbol")).alias("feature_stock_symbols"), ((F.col("kospi_valid") >= kospi) & (F.col("kosdaq_valid") >= kosdaq)).alias("full_market_price_ready"))
    sections = {
        "kis_volume_top": F.col("kis_volume_ready"), "watchlist_signal": F.col("universe_ready"), "etf_etn": (F.col("etf_valid") > 0) | (F.col("etn_valid") > 0),
        "kr_full_market_trading_value_top": F.col("full_market_trading_value_ready") & F.col("full_market_price_ready"),
        "kr_full_market_market_cap_top": F.col("full_market_market_cap_ready") & F.col("full_market_price_ready"),
    }
    allowed = F.concat_ws(",", F.lit("macro"), F.lit("us_market"), *[F.when(ok, n) for n, ok in sections.items()])
    blocked = F.concat_ws(",", *[F.when(~ok, n) for n, ok in sections.items()])
    only = F.col("universe_ready") & F.col("kis_volume_ready") & (F.col("watchlist_covered") > 0) & (F.col("feature_stock_symbols") > 0)
    return joined.select(
        "full_market_price_ready", "universe_ready", "kis_volume_ready", "watchlist_covered", "feature_stock_symbols", only.alias("universe_only_ready"), allowed.alias("allowed_sections"), blocked.alias("blocked_sections"),
        ladder([
            (~F.col("kis_volume_ready") & ~F.col("universe_ready"), "FAIL_REPORT_NOT_READY"), (only & ~F.col("full_market_price_ready"), "WARN_KIS_UNIVERSE_ONLY"),
            (~F.col("full_market_price_ready"), "WARN_KR_STOCK_PRICE_COVERAGE"),
        ]).alias("status"))


# ---- macro, calendar, closed markets ----------------------------------------


def macro_snapshot(wide: DataFrame, series: DataFrame, target, us3y: str = "us3y", series_id: str = "DGS3") -> DataFrame:
    last = wide.orderBy(F.desc("base_date")).limit(1)
    known = series.where((F.col("series_id") == series_id) & (F.col("base_date") <= lit_date(target)))
    value = one(known, F.max_by("value", "base_date"))
    return last.select("base_date", F.col(us3y).alias("us3y"), value.alias("series_value")).withColumn("status", ladder([
        (F.col("series_value").isNull(), "WARN_MACRO_DGS3_MISSING"), (F.col("us3y").isNull(), "WARN_MACRO_US3Y_NULL")]))


def calendar_quality(calendar: DataFrame, target: date) -> DataFrame:
    day, code, goal = F.col("calendar_date"), F.col("exchange_code"), lit_date(target)
    this, following = F.year(day) == target.year, F.year(day) == target.year + 1
    kr, us = code == "XKRX", code == "XNYS"
    manual = (F.col("source") == "manual_override") & (this | following)
    counts = calendar.agg(
        F.count_if(kr & this).alias("xkrx_rows"), F.count_if(kr & following).alias("xkrx_next_rows"), F.count_if(us & this).alias("xnys_rows"), F.count_if(us & following).alias("xnys_next_rows"),
        F.count_if(kr & (day == goal)).alias("xkrx_today_rows"), F.count_if(kr & F.col("is_open") & day.between(F.date_sub(goal, 30), goal)).alias("recent_30d_open_days"),
        F.count_if(kr & F.col("is_open") & day.between(goal, F.date_add(goal, 30))).alias("next_30d_open_days"), F.count_if(kr & this & (F.col("reason") == "holiday")).alias("xkrx_weekday_holidays"),
        F.count_if(us & this & (F.col("reason") == "holiday")).alias("xnys_weekday_holidays"), F.count_if(manual).alias("manual_override_rows"),
        F.count_if(manual & day.between(F.date_sub(goal, 30), F.date_add(goal, 30))).alias("recent_override_rows"), F.count_if(us & (day == goal)).alias("xnys_today_rows"),
        *[out for name, here in (("xkrx", kr), ("xnys", us)) for out in (
            F.max(F.when(here & F.col("is_open") & (day < goal), day)).alias(f"{name}_previous"), F.min(F.when(here & F.col("is_open") & (day > goal), day)).alias(f"{name}_next"),
            F.min(F.when(here & (this | following), day)).alias(f"{name}_first"), F.max(F.when(here & (this | following), day)).alias(f"{name}_last"))])
    return counts.withColumn("status", ladder([
        (F.col("xkrx_rows") < 300, "WARN_MARKET_CALENDAR_INCOMPLETE"), (F.col("xkrx_next_rows") < 300, "WARN_NEXT_YEAR_CALENDAR_INCOMPLETE"), (F.col("xnys_rows") < 300, "WARN_MARKET_CALENDAR_MISSING_XNYS"),
        (F.col("xnys_next_rows") < 300, "WARN_NEXT_YEAR_CALENDAR_INCOMPLETE_XNYS"), (F.col("xkrx_today_rows") == 0, "WARN_TODAY_CALENDAR_MISSING"), (F.col("xkrx_next").isNull(), "WARN_NEXT_TRADING_DAY_MISSING"),
    ]))


def closed_days(calendar: DataFrame, exchange: str, start, end) -> DataFrame:
    return calendar.where((F.col("exchange_code") == exchange) & ~F.col("is_open") & F.col("calendar_date").between(lit_date(start), lit_date(end))).select(F.col("calendar_date").alias("base_date"))


def closed_market_rows(rankings, wide, calendar, target: date, us_fields: list[str]) -> DataFrame:
    start = target - timedelta(days=30)
    kr, us = closed_days(calendar, "XKRX", start, target), closed_days(calendar, "XNYS", start, target)
    filled = F.coalesce(*us_fields).isNotNull()
    known = lambda exchange: size(calendar.where((F.col("exchange_code") == exchange) & F.col("calendar_date").between(lit_date(start), lit_date(target))))
    return row(rankings.sparkSession).select(
        known("XKRX").alias("xkrx_calendar_dates"), known("XNYS").alias("xnys_calendar_dates"),
        size(kr).alias("xkrx_closed_dates"), size(us).alias("xnys_closed_dates"), size(rankings.join(F.broadcast(kr), "base_date", "left_semi")).alias("krx_closed_date_ranking_rows"),
        size(wide.where(filled).join(F.broadcast(us), "base_date", "left_semi")).alias("us_closed_date_rows"),
    ).withColumn("status", ladder([
        (F.col("xkrx_calendar_dates") == 0, "WARN_MARKET_CALENDAR_MISSING_XKRX"), (F.col("xnys_calendar_dates") == 0, "WARN_MARKET_CALENDAR_MISSING_XNYS"), (F.col("krx_closed_date_ranking_rows") > 0, "WARN_KRX_CLOSED_DATE_MARKET_ROWS"), (F.col("us_closed_date_rows") > 0, "WARN_US_CLOSED_DATE_MARKET_ROWS")]))


def invalid_prices(prices, master, calendar, target: date, lookback_days: int = 180, recent_days: int = 30) -> DataFrame:
    """Scan of the look-back: closed-day, zero-close, source-less and carried rows of listed markets.

    ``prices`` has one row per symbol-day for the carry check; only its own dates are joined back.
    """
    start = target - timedelta(days=lookback_days)
    listed = master.where(F.col("market").isin(*MARKETS)).select("symbol")
    rows = px.canonical(prices.where(F.col("base_date").between(lit_date(start), lit_date(target)))).join(listed, "symbol", "left_semi")
    days = calendar.where((F.col("exchange_code") == "XKRX") & F.col("is_open")).select(F.col("calendar_date").alias("base_date"), F.lit(True).alias("open_day"))
    marked = rows.join(F.broadcast(days), "base_date", "left").withColumns({"closed": F.col("open_day").isNull(), "zero": px.zero_close(), "bare": px.no_source()})
    bad = F.col("closed") | F.col("zero") | F.col("bare")
    counts = marked.agg(
        F.count_if("closed").alias("non_trading_day_price_rows"), F.count_if("zero").alias("zero_close_rows"), F.count_if("bare").alias("null_source_rows"),
        F.count_if(bad & (F.col("base_date") >= lit_date(target - timedelta(days=recent_days)))).alias("recent_invalid_rows"), F.count_if(bad).alias("invalid_rows"))
    carried = size(jn.carried_rows(rows.select("symbol", "base_date", "close_price", "volume", "trading_value"), calendar))
    return counts.withColumn("duplicate_weekend_carry_rows", carried).withColumn("status", ladder([(F.col("recent_invalid_rows") > 0, "FAIL_INVALID_PRICE_ROWS"), (F.col("invalid_rows") > 0, "WARN_INVALID_PRICE_ROWS")]))


def _priced_features(features, prices, target) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Feature rows of the date, its symbols with a valid price (of broker detail, if it has any), and the stock symbols of the rows, ``good`` where priced."""
    goal = F.col("base_date") == lit_date(target)
    today = px.canonical(prices.where(goal))
    per = today.groupBy("symbol").agg(F.max(F.col("source") == "KIS_DETAIL").alias("in_detail"), F.max(px.valid_row()).alias("is_valid"))
    any_detail = one(today, _any(F.col("source") == "KIS_DETAIL"))
    good = per.where(F.col("is_valid") & (F.coalesce("in_detail", F.lit(False)) | ~any_detail)).select("symbol", F.lit(1).alias("good"))
    rows = features.where(goal)
    return rows, good, px.canonical(rows.where(F.col("symbol") != "GLOBAL")).select("symbol").distinct().join(good, "symbol", "left")


def features_without_price(features, prices, target) -> DataFrame:
    """The feature symbols of the date without a valid price, a row each."""
    return _priced_features(features, prices, target)[2].where("good is null").select("symbol")


def feature_without_price(features, prices, target) -> DataFrame:
    """How many feature symbols of the date have no valid price among its broker-detail symbols."""
    rows, good, stock = _priced_features(features, prices, target)
    lists = stock.agg(F.count(F.lit(1)).alias("stock_feature_symbols"), F.count_if(F.col("good").isNull()).alias("without_price_count"))
    sums = rows.agg(F.count(F.lit(1)).alias("feature_total_rows"), F.count_if(F.col("symbol") == "GLOBAL").alias("global_feature_rows"))
    return jn.beside(sums, lists).withColumn("detail_valid_price_rows", size(good)).withColumn("status", ladder([
        ((F.col("stock_feature_symbols") == 0) | (F.col("without_price_count") == 0), "SUCCESS"), (F.col("without_price_count") < F.col("stock_feature_symbols"), "WARN_FEATURE_PARTIAL_PRICE_MATCH"),
    ], "WARN_FEATURE_WITHOUT_VALID_PRICE"))


def detail_universe_size(static_universe, rankings, master, universe, hard_limit: int = 500, broad_limit: int = 1000) -> DataFrame:
    return row(master.sparkSession).select(
        size(static_universe.where("enabled")).alias("static_enabled"), one(px.canonical(jn.latest(rankings)), F.count_distinct("symbol")).alias("ranking_symbols"),
        size(master.where("is_active")).alias("active_master"), size(universe).alias("detail_universe"),
    ).withColumn("status", ladder([
        (F.col("detail_universe") > hard_limit, "FAIL_DETAIL_UNIVERSE_TOO_LARGE"), (F.col("active_master") > broad_limit, "WARN_MASTER_ACTIVE_TOO_BROAD"), (F.col("ranking_symbols") == 0, "WARN_RANKING_UNIVERSE_EMPTY")]))


# ---- watchlist and report sources -------------------------------------------


def watchlist_symbols(symbols: DataFrame, prices: DataFrame, calendar: DataFrame, target: date, bounds: dict | None = None, lookback_days: int = 90) -> DataFrame:
    """Per symbol: valid rows, staleness, mixed windows, price warnings, returns, reject counts, status."""
    span = F.col("base_date").between(lit_date(target - timedelta(days=lookback_days)), lit_date(target))
    rows = px.best_source(px.canonical(prices.where(span)).join(symbols.select("symbol"), "symbol", "left_semi"), latest_first=False)
    open_ = cal.open_days(calendar).withColumn("open_day", F.lit(True))
    marked = rows.join(F.broadcast(open_), "base_date", "left").withColumn("ok", F.col("open_day").isNotNull() & px.valid_row(require_source=True))
    rejects = marked.groupBy("symbol").agg(
        F.count_if(F.col("open_day").isNull()).alias("non_trading_rows"), F.count_if(px.zero_close()).alias("zero_close_rows"), F.count_if(px.no_source()).alias("null_source_rows"))
    good = marked.where("ok").withColumns({
        "return_5d": win.return_n(5), "return_20d": win.return_n(20), "mixed": win.source_mixed(5) | win.source_mixed(20), "jump": win.jump_warning(),
        "scale": sn.price_scale_warning(F.col("symbol"), F.col("close_price"), bounds)})
    last = good.groupBy("symbol").agg(
        F.count(F.lit(1)).alias("valid_rows"), F.max("base_date").alias("latest_date"), F.max_by(F.struct("source", "close_price", "return_5d", "return_20d", "mixed", "jump", "scale"), "base_date").alias("r"))
    joined = cal.stale_days(symbols.select("symbol").join(rejects, "symbol", "left").join(last, "symbol", "left"), calendar, target)
    stale = F.when(F.col("latest_date").isNotNull(), F.col("stale_days"))
    warning = F.concat_ws(",", F.when(F.col("r.jump"), "WARN_PRICE_JUMP_ANOMALY"), F.when(F.col("r.scale"), "WARN_PRICE_SCALE_ANOMALY"))
    zero = lambda n: F.coalesce(n, F.lit(0)).alias(n)
    return joined.select(
        "symbol", "latest_date", F.col("r.source").alias("source"), F.col("r.close_price").alias("close_price"), F.col("r.return_5d").alias("return_5d"), F.col("r.return_20d").alias("return_20d"),
        F.coalesce("r.mixed", F.lit(False)).alias("source_mixed"), warning.alias("price_scale_warning"), stale.alias("stale_days"), zero("valid_rows"), zero("non_trading_rows"), zero("zero_close_rows"), zero("null_source_rows"),
    ).withColumn("status", ladder([
        (F.col("price_scale_warning") != "", "WARN_PRICE_SCALE_ANOMALY"), (F.col("source_mixed"), "WARN_FEATURE_SOURCE_MIXED"), (F.col("stale_days") > 3, "WARN_REPORT_SOURCE_STALE")]))


def feature_source(watch: DataFrame, features: DataFrame, target) -> DataFrame:
    """Stored features of the date next to the consistency of their source windows."""
    names_ = ("return_5d", "trading_value_ratio_20d")
    today = px.canonical(features.where(F.col("base_date") == lit_date(target)))
    wide = today.groupBy("symbol").agg(*[F.max(F.when(F.col("feature_name") == n, F.col("feature_value"))).alias(f"stored_{n}") for n in names_])
    return watch.select("symbol", "source_mixed").join(wide, "symbol", "left").select(
        "symbol", *[f"stored_{n}" for n in names_], (~F.col("source_mixed")).alias("calculation_source_consistent"), ladder([(F.col("source_mixed"), "WARN_FEATURE_SOURCE_MIXED")]).alias("status"))


def report_views(static_universe, watch_rows, etf_rows, target) -> DataFrame:
    """Future-dated and stale rows of the two report views."""
    goal = lit_date(target)
    enabled = static_universe.where("enabled").select("symbol", F.lit(True).alias("on"))
    watch = watch_rows.join(enabled, "symbol", "left").agg(
        F.count(F.lit(1)).alias("watchlist_rows"), F.count("on").alias("active_rows"), F.count_if(F.col("on") & (F.col("data_status") == "STALE")).alias("stale_watchlist"), F.count_if(F.col("base_date") > goal).alias("future_watch"))
    stale = (F.coalesce("stale_days", F.lit(0)) > 3) | F.coalesce(F.col("data_status") == "STALE", F.lit(False))
    etf = etf_rows.agg(F.count(F.lit(1)).alias("etf_rows"), F.count_if(stale).alias("stale_sector_etf"), F.count_if(F.col("latest_price_date") > goal).alias("future_etf"))
    return jn.beside(watch, etf).select(
        "watchlist_rows", "active_rows", "etf_rows", "stale_watchlist", "stale_sector_etf", (F.col("future_watch") + F.col("future_etf")).alias("future_date_rows"),
    ).withColumn("status", ladder([(F.col("future_date_rows") > 0, "FAIL_REPORT_SOURCE_QUALITY"), ((F.col("stale_watchlist") > 0) | (F.col("stale_sector_etf") > 0), "WARN_REPORT_SOURCE_STALE")]))


def report_source(watch, views, macro_row, fields: dict[str, str]) -> DataFrame:
    """Macro suspicions, stale and mixed watchlist symbols, stale ETFs and future rows in one status.

    ``watch`` is one row per watchlist symbol, ``views`` and ``macro_row`` one row.
    """
    suspicious = F.array_join(sn.macro_suspicious({k: F.col(v) for k, v in fields.items()}), ",").alias("macro_suspicious")
    w = watch.agg(
        F.count(F.lit(1)).alias("symbols_checked"), F.count_if(F.coalesce("stale_days", F.lit(0)) > 3).alias("stale_watch_symbols"), F.count_if("source_mixed").alias("source_mixed_symbols"),
        F.count_if(F.col("price_scale_warning") != "").alias("scale_warning_symbols"))
    joined = jn.beside(jn.beside(w, views.select("stale_sector_etf", "future_date_rows")), macro_row.select(suspicious))
    return joined.withColumn("status", ladder([
        (F.col("future_date_rows") > 0, "FAIL_REPORT_SOURCE_QUALITY"), (F.col("source_mixed_symbols") > 0, "WARN_FEATURE_SOURCE_MIXED"),
        ((F.col("stale_watch_symbols") > 0) | (F.col("stale_sector_etf") > 0), "WARN_REPORT_SOURCE_STALE"), (F.col("macro_suspicious") != "", "WARN_PRICE_SCALE_ANOMALY")]))


# ---- intraday, jobs, documents ----------------------------------------------


def intraday(rows: DataFrame, day, now: Column, is_open: Column, stale_minutes: int = 90) -> DataFrame:
    """Newest bar per series of a day, invalid count, staleness and the status ladder."""
    today = rows.where(F.col("base_date") == lit_date(day))
    newest = lambda s, n: F.max_by(F.when(F.col("series_id") == s, F.col(n)), F.when(F.col("series_id") == s, F.struct("observed_at", "event_id"))).alias(f"{s.lower()}_{n}")
    counts = today.agg(
        F.max("observed_at").alias("latest_observed_at"), F.count_if(F.col("quality_flag") == "INVALID").alias("invalid_count"),
        *[newest(s, "quality_flag") for s in ("KOSPI", "KOSDAQ", "USDKRW")], newest("KOSPI", "source"), newest("KOSPI", "raw_value"))
    age = F.floor((F.unix_seconds(now) - F.unix_seconds(F.col("latest_observed_at").cast("timestamp"))) / 60)
    k, q, u = F.col("kospi_quality_flag"), F.col("kosdaq_quality_flag"), F.col("usdkrw_quality_flag")
    relabel = (k == "INVALID") & (F.col("kospi_source") == "KIS") & (F.col("kospi_raw_value") > 0)
    status = ladder([
        (u.isNull(), "FAIL_MISSING_INTRADAY_FX"), (relabel, "WARN_RECLASSIFY_NEEDED"), ((k == "INVALID") | (q == "INVALID"), "FAIL_INVALID_INTRADAY_MACRO"), (u == "INVALID", "FAIL_INVALID_INTRADAY_FX"),
        (k == "FALLBACK_YAHOO", "WARN_KOSPI_FALLBACK_YAHOO"), (k == "ANOMALY", "WARN_KOSPI_ANOMALY"), (k == "SOURCE_MISMATCH", "WARN_KOSPI_SOURCE_MISMATCH"),
        (~is_open & (k.isNull() | q.isNull()), "SKIPPED_MARKET_CLOSED"), (k.isNull() | q.isNull(), "WARN_MISSING_INTRADAY_INDEX"), (F.col("stale_minutes") > stale_minutes, "WARN_STALE_INTRADAY_MACRO")])
    return counts.withColumn("stale_minutes", age).withColumn("status", status)


def macro_index_source(snapshots: DataFrame) -> DataFrame:
    """Status of every snapshot date from its index and FX flags."""
    k, s, v = F.col("kospi_quality_flag"), F.col("kospi_source"), F.col("kospi")
    return snapshots.withColumn("status", ladder([
        ((k == "INVALID") & (v.isNull() | (v <= 0)), "FAIL_INVALID_KOSPI"), ((k == "INVALID") & (s == "KIS") & (v > 0), "WARN_RECLASSIFY_NEEDED"),
        ((k == "FALLBACK_YAHOO") | ((s == "YAHOO") & (k != "INVALID")), "WARN_KOSPI_FALLBACK_YAHOO"), (k == "ANOMALY", "WARN_KOSPI_ANOMALY"), (k == "SOURCE_MISMATCH", "WARN_KOSPI_SOURCE_MISMATCH"),
        (F.col("usdkrw_quality_flag") == "STALE", "WARN_STALE_USDKRW")]))


def run_quality(days: DataFrame) -> DataFrame:
    """Status and issue text per run from its totals: symbols, price and supply successes, valid and snapshot-only rows."""
    total = F.greatest("total_symbols", F.lit(1))
    price, supply = F.col("price_success") / total, F.col("supply_success") / total
    fails = [F.col("snapshot_only_rows") > 0, F.col("valid_price_rows") == 0, price < 0.8]
    thin = (price >= 0.8) & (supply < 0.5)
    pair = lambda n: F.concat_ws("/", F.col(n).cast("string"), F.col("total_symbols").cast("string"))
    issues = F.concat_ws(
        "; ", F.when(fails[0], F.concat(F.lit("snapshot_only_price_rows="), F.col("snapshot_only_rows").cast("string"))), F.when(fails[1], F.lit("valid_price_rows=0")),
        F.when(fails[2], F.concat(F.lit("price coverage low: "), pair("price_success"))), F.when(thin, F.concat(F.lit("supply coverage low: "), pair("supply_success"))))
    return days.select("*", ladder([(reduce(lambda a, b: a | b, fails), "FAIL"), (thin, "WARN")]).alias("status"), issues.alias("issues"))


def job_status(counts: DataFrame) -> DataFrame:
    """Status per run by job kind: listing, detail, central_bank or macro."""
    job, done, failed, warned, size_ = F.col("job"), F.col("processed"), F.col("failures"), F.col("warnings"), F.col("universe")
    return counts.withColumn("status", ladder([
        ((job == "listing") & (done >= 2000), "SUCCESS"), ((job == "listing") & (done >= 100), "WARN_PARTIAL_STOCK_PRICE_ROWS"), (job == "listing", "WARN_INSUFFICIENT_STOCK_PRICE_ROWS"),
        ((job == "detail") & (failed > 0) & (done == 0), "FAIL_KIS_UNIVERSE_EMPTY"), ((job == "detail") & ((failed > 0) | (F.col("valid") < F.greatest(F.lit(1), F.floor(size_ / 3)))), "WARN_PARTIAL_KIS_UNIVERSE_COVERAGE"), (job == "detail", "SUCCESS"),
        ((job == "central_bank") & (failed > 0), "WARN"), ((job == "central_bank") & (done > 0), "SUCCESS"), ((job == "central_bank") & (warned > 0), "WARN_NO_NEW_DATA"), (job == "central_bank", "SUCCESS_WITH_NO_NEW_DATA"),
        ((done > 0) & (failed == 0) & (warned == 0), "SUCCESS")], "WARN"))


def zero_row_alarm(tables: dict[str, DataFrame], days: DataFrame) -> DataFrame:
    """Watched tables without a row, for every wanted date."""
    seen = stack([df.groupBy("base_date").agg(F.lit(n).alias("table_name")) for n, df in tables.items()])
    wanted = days.select("base_date", F.explode(F.array(*[F.lit(n) for n in tables])).alias("table_name"))
    return wanted.join(seen, ["base_date", "table_name"], "left_anti")


def consumer_readiness(coverage: DataFrame, watchlist: DataFrame, minimum: int = 2000) -> DataFrame:
    """Two gates: a report can be made; the whole market may be described.

    ``watchlist`` is one row (none without a watchlist); ``coverage`` has no row when nothing is covered.
    """
    counts = ("covered_symbols", "kospi_covered", "kosdaq_covered")
    both = jn.beside(watchlist, coverage.select(*counts)).withColumns({n: F.coalesce(n, F.lit(0)) for n in counts})
    return both.select(
        "base_date", *counts, "watchlist_symbols", "watchlist_symbols_with_price",
        ((F.col("watchlist_symbols") > 0) & (F.col("watchlist_symbols_with_price") > 0)).alias("minimum_report_ready"), (F.col("covered_symbols") > minimum).alias("full_market_coverage_pass"))
