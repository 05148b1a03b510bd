"""Domain tables seen through the supplied star-schema tables.

Every method is a lazy DataFrame over the whole table; Catalyst prunes the
columns and pushes the filters of whatever is built on top.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.times import available_at, is_weekday
from ..operators import calendar as cal
from ..session import dealt

# How the supplied codes stand for domain codes.
SOURCE_BY_LINE = {1: "KIS_DETAIL", 2: "KIS", 3: "KRX", 4: "VALID_PRICE_FALLBACK", 5: "UNKNOWN", 6: "UNKNOWN"}
MARKET_BY_REGION = {0: "KOSPI", 1: "KOSDAQ", 2: "ETF", 3: "ETN"}
MARKET_BY_FLAG = {"A": "KOSPI", "R": "KOSDAQ", "N": "ETF"}
SERIES_BY_PRIORITY = {
    "1-URGENT": "KR_GOVT_10Y",
    "2-HIGH": "KR_GOVT_3Y",
    "3-MEDIUM": "KR_CORP_AA_3Y",
    "4-NOT SPECIFIED": "KR_CORP_BBB_3Y",
    "5-LOW": "USDKRW",
}
WIDE_BY_SERIES = {
    "KR_GOVT_10Y": "gold",
    "KR_GOVT_3Y": "copper",
    "KR_CORP_AA_3Y": "wti",
    "KR_CORP_BBB_3Y": "us10y",
    "USDKRW": "usdkrw",
}
JOB_BY_PRIORITY = {
    "1-URGENT": "daily_stock_pipeline",
    "2-HIGH": "daily_stock_full_price_pipeline",
    "3-MEDIUM": "daily_macro_pipeline",
    "4-NOT SPECIFIED": "daily_kis_universe_pipeline",
    "5-LOW": "daily_ranking_pipeline",
}
STATUS_BY_ORDER = {"F": "SUCCESS", "O": "WARN", "P": "FAIL"}
SERIES_BY_EVENT = {"click": "KOSPI", "view": "KOSDAQ", "purchase": "USDKRW", "signup": "VIX", "error": "WTI"}
FEATURE_BY_LINE = {
    1: "close_price", 2: "return_5d", 3: "moving_avg_5", 4: "moving_avg_20",
    5: "foreign_flow_zscore", 6: "trading_value_ratio_20d", 7: "volume",
}
CALENDAR_OVERRIDES = [
    ("XKRX", "2000-05-06", True, "manual_override_trading_day"),
    ("XKRX", "2001-05-01", False, "labour_day"),
    ("XNYS", "2001-07-04", False, "independence_day"),
    ("XNYS", "2000-12-25", False, "christmas"),
]


TABLE_SCHEMAS = {
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_extendedprice double, "
    "l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
}


def pick(col: Column, mapping: dict, default=None) -> Column:
    """A small fixed mapping as one CASE expression."""
    out = F.lit(default)
    for key, value in mapping.items():
        out = F.when(col == key, F.lit(value)).otherwise(out)
    return out


def code6(col: Column) -> Column:
    """A non-negative number as text of at least six digits."""
    text = col.cast("string")
    return F.when(F.length(text) < 6, F.lpad(text, 6, "0")).otherwise(text)


def hundredths(col: Column) -> Column:
    """A non-negative amount with two decimals as a whole number."""
    return (col * 100 + 0.5).cast("long")


class Landing:
    """The domain tables of one folder; every table is built once per instance and stays lazy."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def table(self, name: str) -> DataFrame:
        reader = self.spark.read
        if name in TABLE_SCHEMAS:  # spares a job that would read the footers
            reader = reader.schema(TABLE_SCHEMAS[name])
        return reader.parquet(f"{self.folder}/{name}.parquet")

    @cached_property
    def _lines(self) -> DataFrame:
        qty = F.col("l_quantity").cast("long")
        cents = hundredths(F.col("l_extendedprice"))
        halves = F.expr("(2 * cents + qty) div (2 * qty)")
        return (
            self.table("lineitem")
            .withColumns({"qty": qty, "cents": cents, "base_date": F.col("l_shipdate").cast("date")})
            .withColumns({
                "unit": halves.cast("double") / F.lit(100.0),
                "code": code6(F.col("l_suppkey")),
                "no_close": (F.col("l_discount") < 0.005) & (F.col("l_tax") < 0.005),
                "source": pick(F.col("l_linenumber"), SOURCE_BY_LINE),
                "disc_pct": hundredths(F.col("l_discount")).cast("int"),
                "tax_pct": hundredths(F.col("l_tax")).cast("int"),
            })
            .withColumn("snap", F.col("no_close") & (F.col("l_returnflag") == "N"))
        )

    @cached_property
    def prices_raw(self) -> DataFrame:
        """Rows of competing sources, with injected defects: several rows per symbol-day."""
        c = F.col
        unless_snap = lambda col: F.when(~c("snap"), col)
        return self._lines.select(
            F.concat(F.when(c("qty") == 50, "Q").otherwise(""), c("code")).alias("symbol"),
            "base_date",
            unless_snap(c("unit")).alias("open_price"),
            unless_snap(c("unit") + 1).alias("high_price"),
            unless_snap(c("unit") - 1).alias("low_price"),
            F.when(~c("no_close"), c("unit")).alias("close_price"),
            unless_snap(F.when(c("tax_pct") >= 8, 0.0).otherwise(c("l_quantity"))).alias("volume"),
            unless_snap(c("l_extendedprice")).alias("trading_value"),
            F.when(c("disc_pct") > 2, c("unit") * c("l_partkey")).alias("market_cap"),
            F.when(c("disc_pct") > 3, c("l_partkey").cast("double")).alias("outstanding_shares"),
            "source",
            F.timestamp_add("MINUTE", F.lit(420) + c("tax_pct"), c("base_date").cast("timestamp")).alias("available_at"),
        )

    @cached_property
    def master(self) -> DataFrame:
        c = F.col
        nation = self.table("nation").select(c("n_nationkey").alias("s_nationkey"), c("n_regionkey"))
        market = pick(c("n_regionkey"), MARKET_BY_REGION)
        # nation has a fixed 25 rows
        return self.table("supplier").join(F.broadcast(nation), "s_nationkey").select(
            code6(c("s_suppkey")).alias("symbol"),
            c("s_name").alias("name"),
            market.alias("market"),
            F.when(market.isin("ETF", "ETN"), market).otherwise("STOCK").alias("asset_type"),
            (c("s_acctbal") > 0).alias("is_active"),
        )

    @cached_property
    def static_universe(self) -> DataFrame:
        c = F.col
        return (
            self.table("supplier").where(c("s_acctbal") > 7000)
            .join(self.master.withColumnRenamed("symbol", "code"), code6(c("s_suppkey")) == c("code"))
            .select(c("code").alias("symbol"), "name", "market", "asset_type", (c("s_acctbal") < 9500).alias("enabled"))
        )

    @cached_property
    def supply(self) -> DataFrame:
        c = F.col
        signed = lambda plus, minus, on: F.sum(
            F.when(c(on) == plus, c("qty")).when(c(on) == minus, -c("qty")).otherwise(0)
        ).cast("double")
        return self._lines.groupBy(c("code").alias("symbol"), "base_date").agg(
            signed("A", "R", "l_returnflag").alias("foreign_net_buy"),
            signed("O", "F", "l_linestatus").alias("institutional_net_buy"),
            F.when(F.max("tax_pct") > 2, F.max("disc_pct").cast("double")).alias("foreign_holding_ratio"),
        )

    @cached_property
    def shorts(self) -> DataFrame:
        c = F.col
        sold = c("l_linestatus") == "F"
        lines = self._lines.select(c("code").alias("symbol"), "base_date", "l_linestatus", "qty", "cents", "tax_pct", "disc_pct")
        return dealt(lines, ["symbol", "base_date"]).groupBy("symbol", "base_date").agg(
            F.sum(F.when(sold, c("qty")).otherwise(0)).alias("short_volume"),
            (F.sum(F.when(sold, c("cents")).otherwise(0)).cast("double") / F.lit(100.0)).alias("short_value"),
            F.when(F.max("tax_pct") >= 7, None).when(F.min("disc_pct") == 0, 0.0).otherwise(1.5).alias("short_ratio"),
        )

    @cached_property
    def snapshots(self) -> DataFrame:
        c = F.col
        return self._lines.groupBy(c("code").alias("symbol"), "base_date").agg(
            F.max(c("unit") * c("l_partkey")).alias("market_cap"),
            F.max("l_partkey").alias("listed_shares"),
            F.max("disc_pct").cast("double").alias("per"),
            F.max("tax_pct").cast("double").alias("pbr"),
            F.min("disc_pct").cast("double").alias("foreign_holding_ratio"),
            F.min(F.when(c("l_linenumber") <= 4, "KIS").otherwise("KIS_DETAIL")).alias("source"),
        )

    @cached_property
    def ratios(self) -> DataFrame:
        c = F.col
        return self._lines.groupBy(c("code").alias("symbol"), "base_date").agg(
            F.max("disc_pct").cast("double").alias("per"),
            F.max("tax_pct").cast("double").alias("pbr"),
            F.when(F.max("l_linenumber") <= 5, F.min("tax_pct").cast("double")).alias("roe"),
            F.min("disc_pct").cast("double").alias("debt_ratio"),
            F.min(F.when(c("l_linenumber") <= 4, "KIS").otherwise("KIS_DETAIL")).alias("source"),
        )

    @cached_property
    def day_bars(self) -> DataFrame:
        """One row of whole numbers per symbol and day, from which landed payloads are written."""
        c = F.col
        return self._lines.groupBy(c("code").alias("symbol"), "base_date").agg(
            F.max(F.expr("cents div qty")).alias("p"), F.sum("qty").alias("vol"), F.sum("cents").alias("val"), F.max("l_partkey").alias("shares"),
            F.min("tax_pct").alias("tx"), F.min("disc_pct").alias("dc"), F.max("l_linenumber").alias("ln"),
        )

    @cached_property
    def macro_series(self) -> DataFrame:
        c = F.col
        cents = F.sum(hundredths(c("o_totalprice"))).cast("double")
        return (
            self.table("orders")
            .groupBy(
                pick(c("o_orderpriority"), SERIES_BY_PRIORITY).alias("series_id"),
                c("o_orderdate").cast("date").alias("base_date"),
            )
            .agg((cents / (F.count(F.lit(1)) * 100).cast("double")).alias("value"))
        )

    @cached_property
    def global_macro(self) -> DataFrame:
        """Wide daily macro table; one column per series."""
        wide = [
            F.max(F.when(F.col("series_id") == series, F.col("value"))).alias(name)
            for series, name in WIDE_BY_SERIES.items()
        ]
        return self.macro_series.groupBy("base_date").agg(*wide)

    @cached_property
    def schedule(self) -> DataFrame:
        """Open days per exchange: weekdays that saw an order (for XNYS, a filled one)."""
        c = F.col
        day = c("o_orderdate").cast("date")
        seen = self.table("orders").where(is_weekday(day)).groupBy(day.alias("calendar_date")).agg(
            F.max(F.when(c("o_orderstatus") == "F", 1)).alias("filled")
        )
        codes = F.when(c("filled") == 1, F.array(F.lit("XKRX"), F.lit("XNYS"))).otherwise(F.array(F.lit("XKRX")))
        return seen.select("calendar_date", F.explode(codes).alias("exchange_code"))

    @cached_property
    def date_range(self) -> DataFrame:
        day = F.col("o_orderdate").cast("date")
        return self.table("orders").agg(F.min(day).alias("first_day"), F.max(day).alias("last_day"))

    @cached_property
    def overrides(self) -> DataFrame:
        rows = ", ".join(
            f"('{e}', DATE'{d}', {str(o).lower()}, '{r}')" for e, d, o, r in CALENDAR_OVERRIDES
        )
        return self.spark.sql(f"SELECT * FROM VALUES {rows} AS t(exchange_code, calendar_date, is_open, reason)")

    @cached_property
    def calendar(self) -> DataFrame:
        built = cal.build(self.date_range, self.schedule, ["XKRX", "XNYS"])
        return cal.apply_overrides(built, self.overrides)

    @cached_property
    def open_days(self) -> DataFrame:
        return cal.open_days(self.calendar, "XKRX")

    @cached_property
    def rankings(self) -> DataFrame:
        """Stored ranking rows, several sources, some stale or with a Q-prefixed symbol."""
        c = F.col
        kind = F.when(c("l_linenumber") <= 2, "volume").when(c("l_linenumber") <= 4, "trading_value").otherwise("market_cap")
        stored = F.when(c("disc_pct") > 5, F.date_sub(c("base_date"), c("disc_pct") - 5)).when(c("disc_pct") > 1, c("base_date"))
        return self._lines.select(
            "base_date",
            pick(c("l_returnflag"), MARKET_BY_FLAG).alias("market"),
            kind.alias("rank_type"),
            (c("tax_pct") * 10 + c("l_linenumber")).cast("long").alias("rank"),
            F.concat(F.when(c("qty") == 50, "Q").otherwise(""), c("code")).alias("symbol"),
            F.when(c("l_linestatus") == "O", "KIS").otherwise("VALID_PRICE_FALLBACK").alias("source"),
            c("l_extendedprice").alias("metric_value"),
            stored.alias("source_base_date"),
            F.when(c("disc_pct") == 1, F.to_json(F.struct(F.date_sub(c("base_date"), 1).alias("price_base_date"))))
            .otherwise("{}").alias("raw_data"),
        )

    @cached_property
    def features(self) -> DataFrame:
        """Stored long features, several rows per key as left by repeated runs; some GLOBAL."""
        c = F.col
        return self._lines.select(
            F.when(c("l_suppkey") == 0, "GLOBAL")
            .otherwise(F.concat(F.when(c("qty") == 50, "Q").otherwise(""), c("code"))).alias("symbol"),
            "base_date",
            pick(c("l_linenumber"), FEATURE_BY_LINE).alias("feature_name"),
            F.when(c("tax_pct") < 8, c("unit")).alias("feature_value"),
        )

    @cached_property
    def run_logs(self) -> DataFrame:
        c = F.col
        return self.table("orders").select(
            c("o_orderkey").alias("run_id"),
            pick(c("o_orderpriority"), JOB_BY_PRIORITY).alias("job_name"),
            c("o_orderdate").cast("date").alias("target_date"),
            pick(c("o_orderstatus"), STATUS_BY_ORDER).alias("status"),
            c("o_custkey").alias("records_processed"),
            F.format_string("universe_count=%d; failed_symbols_count=%d; note", c("o_custkey"), c("o_orderkey") % 7).alias("error_message"),
        )

    @cached_property
    def intraday(self) -> DataFrame:
        c = F.col
        code = F.get_json_object("props", "$.k").cast("int")
        return self.table("events").select(
            c("ts").alias("observed_at"),
            c("ts").cast("date").alias("base_date"),
            pick(c("event_type"), SERIES_BY_EVENT).alias("series_id"),
            (c("value") * 10).alias("value"),
            F.when(code > 20, (code - 50).cast("double") / F.lit(2.0)).alias("change_rate"),
            F.when(code < 60, "KIS").when(code < 80, "YAHOO").otherwise("FALLBACK_DAILY").alias("source"),
            c("event_id"),
        )

    @cached_property
    def filings(self) -> DataFrame:
        c = F.col
        return self.table("documents").select(
            c("doc_id"), code6(c("doc_id")).alias("symbol"), c("text").alias("report_nm"), c("lang"), c("source")
        )

    @cached_property
    def news(self) -> DataFrame:
        """Landed news items: an RFC-2822 date text per item, blank for some."""
        c = F.col
        stamp = F.concat(F.date_format("ts", "EEE, dd MMM yyyy HH:mm:ss"), F.lit(" +0900"))
        return self.table("events").select(
            c("event_id"),
            F.format_string("%06d", c("user_id")).alias("symbol"),
            F.when(c("event_type") == "error", F.lit("not a date")).otherwise(stamp).alias("pub_date"),
        )

    # ---- what the health panels look at besides ----------------------------

    @cached_property
    def listing_updates(self) -> DataFrame:
        """When the master's rows were last written."""
        c = F.col
        return self._lines.where(c("l_linenumber") == 7).groupBy(c("code").alias("symbol")).agg(F.max("base_date").alias("base_date"))

    @cached_property
    def static_updates(self) -> DataFrame:
        return self.listing_updates.join(self.static_universe.select("symbol"), "symbol", "left_semi")

    @cached_property
    def series_updates(self) -> DataFrame:
        c = F.col
        return self.table("orders").where(c("o_orderstatus") == "P").groupBy(pick(c("o_orderpriority"), SERIES_BY_PRIORITY).alias("series_id")).agg(F.max(c("o_orderdate").cast("date")).alias("base_date"))

    @cached_property
    def statements(self) -> DataFrame:
        c = F.col
        return self.day_bars.where("dc <> 10").select(
            "symbol", "base_date", c("val").alias("revenue"), (-c("vol")).alias("operating_income"), c("shares").alias("total_assets"), c("p").alias("total_equity"))

    @cached_property
    def raw_supply(self) -> DataFrame:
        c = F.col
        return self._lines.where(c("l_linestatus") == "O").select(c("code").alias("symbol"), "base_date", "source", "qty")

    @cached_property
    def raw_shorts(self) -> DataFrame:
        c = F.col
        return self._lines.where((c("l_linestatus") == "F") & (c("tax_pct") < 7)).select(c("code").alias("symbol"), "base_date", "source", "qty")

    @cached_property
    def raw_rankings(self) -> DataFrame:
        return self.rankings.where("source = 'KIS'")

    @cached_property
    def raw_ecos(self) -> DataFrame:
        c = F.col
        return self.table("orders").where(c("o_orderstatus") != "P").select(
            pick(c("o_orderpriority"), SERIES_BY_PRIORITY).alias("series_id"), c("o_orderdate").cast("date").alias("base_date"), c("o_totalprice").alias("value"))

    @cached_property
    def breadth(self) -> DataFrame:
        """Stored market breadth, one row a day."""
        c = F.col
        of = lambda flag: F.count_if(c("l_returnflag") == flag)
        volume = lambda flag: F.sum(F.when(c("l_returnflag") == flag, c("qty")).otherwise(0))
        return self._lines.groupBy("base_date").agg(
            of("A").alias("advances"), of("R").alias("declines"), of("N").alias("unchanged"), volume("A").alias("advancing_volume"), volume("R").alias("declining_volume"))

    @cached_property
    def derivatives(self) -> DataFrame:
        """Stored index futures, one row a day."""
        c = F.col
        cents = hundredths(c("o_totalprice"))
        day = c("o_orderdate").cast("date")
        return self.table("orders").groupBy(day.alias("base_date")).agg(
            (F.max(cents).cast("double") / 100).alias("kospi200_futures"), ((F.max(cents) - F.min(cents)).cast("double") / 100).alias("futures_basis"),
            F.count(F.lit(1)).alias("open_interest"), (F.dayofmonth(day) == 14).alias("expiration_flag"))

    @cached_property
    def disclosures(self) -> DataFrame:
        """Landed notices and news by day and source."""
        c = F.col
        return self.table("events").select(c("ts").cast("date").alias("base_date"), F.when(c("event_type") == "click", "NaverNews").otherwise("OpenDart").alias("source"), "event_id")

    @cached_property
    def stock_events(self) -> DataFrame:
        """Notices that became events of a symbol."""
        c = F.col
        return self.table("events").where(c("event_type").isin("purchase", "signup")).select(c("ts").cast("date").alias("base_date"), F.format_string("%06d", "user_id").alias("symbol"), "event_id")
