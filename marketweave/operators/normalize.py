"""Landed payload rows to keyed daily rows, one function per source format.

Payload rows arrive as a struct column ``row`` (and ``header``) of texts; every
rule is a Column expression, so each job is a projection of the landed table.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from ..functions import parsing as ps, times as tm
from ..functions.symbols import clean_text, normalize_symbol
from ..session import staged
from ..sources.payloads import inner_or_whole, parsed, text_of, text_struct
from . import prices as px

# Field names of the landed payloads.
BAR_FIELDS = text_struct("stck_bsop_date", "stck_oprc", "stck_hgpr", "stck_lwpr", "stck_clpr", "acml_vol", "acml_tr_pbmn", "lstn_stcn", "hts_avls")
SHORT_DATES = ("stck_bsop_date", "bsop_date", "trd_dd", "date", "bas_dt", "stck_dt")
SHORT_VOLUMES = ("ssts_cntg_qty", "ssts_vol", "short_volume", "short_sell_qty")
SHORT_VALUES = ("ssts_tr_pbmn", "ssts_amt", "short_value", "short_sell_amt")
SHORT_RATIOS = ("short_sell_vol_rate", "short_ratio", "ssts_rate", "ssts_vol_rlim", "acml_ssts_cntg_qty_rlim", "acml_ssts_tr_pbmn_rlim")
SHORT_FIELDS = text_struct(*SHORT_DATES, *SHORT_VOLUMES, *SHORT_VALUES, *SHORT_RATIOS)
FLOW_FIELDS = {
    "individual_net_buy": "prsn_ntby_qty", "institutional_net_buy": "orgn_ntby_qty", "foreign_net_buy": "frgn_ntby_qty",
    "pension_net_buy": "pnsn_ntby_qty", "corporate_net_buy": "etc_corp_ntby_qty",
}
EVENT_RULES = [
    (("유상증자",), "rights_issue", -0.8, -0.5),
    (("영업실적", "결산실적"), "earnings", 0.5, 0.3),
    (("단일판매", "공급계약"), "contract", 0.6, 0.7),
    (("자기주식",), "buyback", 0.7, 0.8),
]
MARKET_CAP_UNIT = 100_000_000
# Market codes tried for short sales, in order.
SHORT_MARKET_ORDER = {"J": ("J", "Q"), "Q": ("Q", "J")}


def _r(name: str) -> Column:
    return F.col(f"row.{name}")


def price_generic(df: DataFrame) -> DataFrame:
    """Exchange daily row with texts open, high, low, close, ... to a price row of nullable floats."""
    names = {"open_price": "open", "high_price": "high", "low_price": "low", "close_price": "close"}
    same = ("volume", "trading_value", "market_cap", "outstanding_shares")
    return df.select(
        "symbol", "base_date", *[ps.parse_nullable(F.col(s)).alias(t) for t, s in names.items()],
        *[ps.parse_nullable(F.col(c)).alias(c) for c in same],
    )


def price_quote(df: DataFrame) -> DataFrame:
    """Quote payload, nested under ``output`` or flat, dated by its availability."""
    get = lambda n: text_of("quote", f"$.{n}")
    num = lambda n: ps.parse_nullable(get(n))
    return parsed(df).withColumn("quote", inner_or_whole("doc", "$.output")).select(
        get("stck_shrn_iscd").alias("symbol"), F.to_date("available_at").alias("base_date"),
        num("stck_oprc").alias("open_price"), num("stck_hgpr").alias("high_price"), num("stck_lwpr").alias("low_price"),
        num("stck_prpr").alias("close_price"), num("acml_vol").alias("volume"), num("acml_tr_pbmn").alias("trading_value"), "available_at",
    )


_BAR = {"open_price": "stck_oprc", "high_price": "stck_hgpr", "low_price": "stck_lwpr", "close_price": "stck_clpr", "volume": "acml_vol", "trading_value": "acml_tr_pbmn"}


def price_history(rows: DataFrame) -> DataFrame:
    """Period history rows; a row without a date is skipped."""
    day = ps.parse_ymd(_r("stck_bsop_date"))
    return rows.select("symbol", day.alias("base_date"), *[ps.parse_nullable(_r(s)).alias(t) for t, s in _BAR.items()]).where(F.col("base_date").isNotNull())


def price_ohlcv(rows: DataFrame, position: str = "position") -> DataFrame:
    """Broker bars; cap = close x listed shares, else the cap of the previous payload row.

    ``position`` orders a symbol's payloads and ``row_position`` the rows of one.
    ``is_valid`` routes the row: all rows go to the raw table, valid ones also to the
    keyed table.
    """
    shares = ps.parse_int_nullable(ps.first_present(_r("lstn_stcn"), _r("hts_avls")))
    parsed = rows.select(
        "symbol", position, "row_position", ps.parse_ymd(_r("stck_bsop_date")).alias("base_date"),
        *[ps.parse_int_nullable(_r(s)).alias(t) for t, s in _BAR.items()], shares.alias("outstanding_shares"),
    ).withColumn("own_cap", F.when(F.col("outstanding_shares") > 0, F.try_multiply("close_price", "outstanding_shares")))
    upto = Window.partitionBy("symbol").orderBy(position, "row_position").rowsBetween(Window.unboundedPreceding, 0)
    return parsed.withColumn("market_cap", F.last("own_cap", ignorenulls=True).over(upto)).withColumn("is_valid", px.valid_row()).drop("own_cap", position, "row_position")


def price_exchange_stock(df: DataFrame, target: date) -> DataFrame:
    """Exchange daily-trade row with alternative fields; rows without symbol or stock market are dropped."""
    have = {name.lower() for name in df.columns}  # Spark resolves names without regard to case
    alt = lambda *names: ps.first_present(*([F.col(n) for n in names if n.lower() in have] or [F.lit(None).cast("string")]))
    num = lambda *names: ps.parse_nullable(alt(*names))
    label = F.upper(F.btrim(F.coalesce(alt("MKT_ID", "MKT_NM", "mktId", "mktNm"), F.lit(""))))
    named = F.coalesce(F.col("MKT_NM").contains("유가증권"), F.lit(False)) if "mkt_nm" in have else F.lit(False)
    # generated, so that the filters below read code and label instead of repeating them under the projection
    rows = df.select("*", F.inline(F.array(F.struct(clean_text(alt("ISU_SRT_CD", "ISU_CD")).alias("code"), label.alias("label"), named.alias("named"))))).where("code <> ''")
    market = F.when((F.col("label") == "STK") | F.col("label").contains("KOSPI") | F.col("named"), "KOSPI").when((F.col("label") == "KSQ") | F.col("label").contains("KOSDAQ"), "KOSDAQ")
    return rows.select(
        normalize_symbol(F.col("code")).alias("symbol"), alt("ISU_ABBRV", "ISU_NM").alias("name"), market.alias("market"),
        ps.parse_date_any(alt("BAS_DD", "basDd"), F.lit(target).cast("date")).alias("base_date"),
        num("TDD_OPNPRC").alias("open_price"), num("TDD_HGPRC").alias("high_price"), num("TDD_LWPRC").alias("low_price"), num("TDD_CLSPRC").alias("close_price"),
        num("ACC_TRDVOL", "TDD_VLM").alias("volume"), num("ACC_TRDVAL", "TDD_AMT").alias("trading_value"), num("MKTCAP").alias("market_cap"),
        num("LIST_SHRS").alias("outstanding_shares"), num("FLUC_RT").alias("change_rate"), F.lit("KRX_API").alias("source"),
    ).where(F.col("market").isNotNull())


def price_etp(df: DataFrame, target: date) -> DataFrame:
    """ETF/ETN daily row; ``market`` comes with the endpoint."""
    num = lambda n: ps.parse_nullable(F.col(n))
    return df.select(
        normalize_symbol(F.col("ISU_CD")).alias("symbol"), F.col("ISU_NM").alias("name"), "market",
        ps.parse_date_any(F.col("BAS_DD"), F.lit(target).cast("date")).alias("base_date"),
        num("TDD_CLSPRC").alias("close_price"), num("ACC_TRDVOL").alias("volume"), num("ACC_TRDVAL").alias("trading_value"),
        num("MKTCAP").alias("market_cap"), F.lit("KRX").alias("source"),
    )


def price_and_cap(prices: DataFrame, caps: DataFrame) -> DataFrame:
    """Market-cap columns onto bars by (market, ticker, day); unmatched bars keep nulls."""
    return prices.join(caps, ["market", "symbol", "base_date"], "left")


def supply_simple(df: DataFrame) -> DataFrame:
    """Flow row with an 8-digit or ISO date; missing net buys are 0."""
    num = lambda n: F.coalesce(F.col(n).try_cast("double"), F.lit(0.0)).alias(n)
    day = ps.parse_date_any(F.col("base_date"), F.to_date("available_at"))
    return df.select("symbol", day.alias("base_date"), num("foreign_net_buy"), num("institutional_net_buy"), num("individual_net_buy"))


def supply_investor(rows: DataFrame, batch: str = "batch") -> DataFrame:
    """Five net buys per row, 0 for junk; a batch of a symbol that is zero throughout is rejected, other batches stay."""
    parsed = rows.select("symbol", batch, ps.parse_ymd(_r("stck_bsop_date")).alias("base_date"), *[ps.parse_int_zero(_r(s)).alias(t) for t, s in FLOW_FIELDS.items()])
    nonzero = F.greatest(*[F.abs(F.col(t)) for t in FLOW_FIELDS]) > 0
    alive = parsed.groupBy("symbol", batch).agg(F.max(nonzero).alias("any_flow")).where("any_flow").select("symbol", batch)
    return parsed.join(alive, ["symbol", batch], "left_semi")


def _first_date(texts: str) -> Column:
    """First entry of a text array that reads as a date; nearly always that is the first entry."""
    tried = F.get(F.filter(F.transform(texts, lambda t: ps.parse_date_any(t)), lambda d: d.isNotNull()), F.lit(0))
    return F.coalesce(ps.parse_date_any(F.get(texts, F.lit(0))), tried)


def short_selling(rows: DataFrame) -> DataFrame:
    """Short-sale rows dated by the row, else the header, else the request; ``accepted`` is false without a key."""
    pick = lambda names: ps.first_present(*[_r(n) for n in names])
    candidates = F.array(*[F.col(f"{part}.{n}") for part in ("row", "header") for n in SHORT_DATES], F.col("request_date"))
    dated = rows.withColumn("date_texts", F.filter(candidates, lambda t: t != ""))
    return dated.select(
        *[c for c in rows.columns if c not in ("row", "row_position", "header", "request_date", "symbol")], normalize_symbol(F.col("symbol")).alias("symbol"), _first_date("date_texts").alias("base_date"),
        ps.parse_int_zero(pick(SHORT_VOLUMES)).alias("short_volume"), ps.parse_int_zero(pick(SHORT_VALUES)).alias("short_value"),
        ps.parse_nullable(pick(SHORT_RATIOS)).alias("short_ratio"),
    ).withColumn("accepted", (F.col("symbol") != "") & F.col("base_date").isNotNull())


def short_market_fallback(rows: DataFrame) -> DataFrame:
    """Of the market codes tried for a symbol-day keep the first, in attempt order, that gave accepted rows."""
    # parsed once and staged, since both sides of the join read it; a join, not a window: a symbol-day with very many rows can be split
    accepted = staged(rows, "shorts").where("accepted")
    first = accepted.groupBy("symbol", "base_date").agg(F.min("attempt").alias("attempt"))
    return accepted.join(first, ["symbol", "base_date", "attempt"], "left_semi")


def snapshot(df: DataFrame) -> DataFrame:
    """Quote snapshot: cap in units of 100,000,000, ratios, 52-week range, shares, holding ratio; junk is 0."""
    i, d = (lambda n: ps.parse_int_zero(F.col(n))), (lambda n: ps.parse_zero(F.col(n)))
    return df.select(
        normalize_symbol(F.col("symbol")).alias("symbol"), "base_date", F.try_multiply(i("hts_avls"), F.lit(MARKET_CAP_UNIT)).alias("market_cap"),
        d("per").alias("per"), d("pbr").alias("pbr"), i("w52_hgpr").alias("w52_high"), i("w52_lwpr").alias("w52_low"),
        i("lstn_stcn").alias("listed_shares"), d("hts_frgn_ehrt").alias("foreign_holding_ratio"),
    )


def basic_info(df: DataFrame) -> DataFrame:
    """As :func:`snapshot`, with nulls kept; the cap also in won."""
    i, d = (lambda n: ps.parse_int_nullable(F.col(n))), (lambda n: ps.parse_nullable(F.col(n)))
    return df.select(
        normalize_symbol(F.col("symbol")).alias("symbol"), "base_date", ps.first_present(F.col("hts_kor_isnm"), F.col("bstp_kor_isnm")).alias("name"),
        F.try_multiply(i("hts_avls"), F.lit(MARKET_CAP_UNIT)).alias("market_cap"), i("lstn_stcn").alias("outstanding_shares"),
        d("hts_frgn_ehrt").alias("foreign_holding_ratio"), d("per").alias("per"), d("pbr").alias("pbr"),
    )


def financials(df: DataFrame) -> DataFrame:
    """Statement rows; rows without a date are skipped, missing amounts are 0."""
    names = {
        "revenue": "sale_account", "operating_income": "op_prfit", "net_income": "thst_np",
        "total_assets": "total_assets", "total_liabilities": "total_liab", "total_equity": "total_equity",
    }
    return df.select("symbol", ps.parse_ymd(F.col("stck_bsop_date")).alias("base_date"), *[ps.parse_int_zero(F.col(s)).alias(t) for t, s in names.items()]).where(
        F.col("base_date").isNotNull()
    )


def ratios(quotes: DataFrame, stability: DataFrame) -> DataFrame:
    """per/pbr of the quote payload next to roe/debt ratio of the stability payload; null, not 0, on bad input."""
    num = lambda n: ps.parse_nullable(F.col(n))
    left = quotes.select("symbol", "base_date", num("per").alias("per"), num("pbr").alias("pbr"))
    right = stability.select("symbol", "base_date", num("self_cptl_ntin_inrt").alias("roe"), num("lblt_rate").alias("debt_ratio"))
    return right.join(left, ["symbol", "base_date"], "left").select("symbol", "base_date", "per", "pbr", "roe", "debt_ratio")


def ratio_has_values() -> Column:
    return F.coalesce("per", "pbr", "roe", "debt_ratio").isNotNull()


def fred(df: DataFrame) -> DataFrame:
    """Observations of landed series documents; ``.`` means missing."""
    item = text_struct("date", "value")
    document = T.StructType([T.StructField("observations", T.ArrayType(item))])
    rows = df.select("series_id", F.inline_outer(F.from_json("raw_data", document)["observations"]))
    value = F.when(F.col("value") != ".", F.col("value")).try_cast("double")
    return rows.select("series_id", F.col("date").try_cast("date").alias("base_date"), value.alias("value")).where("value is not null and base_date is not null")


def trading_economics(df: DataFrame) -> DataFrame:
    """Indicator rows: the day before ``T``, ``Value`` or ``Last``."""
    get = lambda n: text_of("doc", f"$.{n}")
    day = F.split(get("DateTime"), "T")[0].try_cast("date")
    row = F.struct(day.alias("base_date"), F.coalesce(get("Value"), get("Last")).try_cast("double").alias("value"))
    # a generated row keeps Spark from testing it below the parse, which would parse again
    return parsed(df).select("series_id", F.inline(F.array(row))).where("base_date is not null and value is not null")


def central_bank(df: DataFrame, keep: tuple = ()) -> DataFrame:
    """Rows dated by cycle; blank and ``.`` are null. The raw table keeps nulls, the keyed one drops them."""
    value = F.when(~F.col("data_value").isin("", "."), F.col("data_value")).try_cast("double")
    return df.select(*keep, "series_id", ps.parse_cycle_date(F.col("time"), F.col("cycle")).alias("base_date"), value.alias("value"), F.col("time").alias("time_raw"), "cycle")


def market_close_series(df: DataFrame, start, end) -> DataFrame:
    """Last close of the window per series, dated by its own bar."""
    rows = df.where(F.col("base_date").between(F.lit(start), F.lit(end)) & F.col("value").isNotNull())
    return rows.groupBy("series_id").agg(F.max("base_date").alias("base_date"), F.max_by("value", "base_date").alias("value"))


def futures_options(rows: DataFrame, prefix: str) -> DataFrame:
    """Futures (``futs``) or options (``optn``) bars with open interest; a missing field is 0."""
    num = lambda n: F.coalesce(_r(n).try_cast("double"), F.lit(0.0))
    whole = lambda n: F.coalesce(_r(n).try_cast("long"), F.lit(0).cast("long"))
    return rows.select(
        "symbol", ps.parse_ymd(_r("stck_bsop_date")).alias("base_date"), num(f"{prefix}_oprc").alias("open"), num(f"{prefix}_hgpr").alias("high"),
        num(f"{prefix}_lwpr").alias("low"), num(f"{prefix}_clpr").alias("close"), whole("acml_vol").alias("volume"), whole("open_intrs").alias("open_interest"),
    )


def overseas(rows: DataFrame, exchange: Column) -> DataFrame:
    num = lambda n: F.coalesce(_r(n).try_cast("double"), F.lit(0.0))
    return rows.select(
        "symbol", exchange.alias("exchange"), ps.parse_ymd(_r("xymd")).alias("base_date"), num("open").alias("open"), num("high").alias("high"), num("low").alias("low"),
        num("clos").alias("close"), num("tvol").cast("long").alias("volume"), num("tamt").cast("long").alias("trading_value"),
    )


def bond(df: DataFrame) -> DataFrame:
    num = lambda n: F.coalesce(F.col(n).try_cast("double"), F.lit(0.0))
    return df.select("symbol", "base_date", num("stck_prpr").alias("price"), num("bond_yield").alias("yield_rate"), num("acml_vol").cast("long").alias("volume"))


def derivatives_daily(index_bars: DataFrame, target) -> DataFrame:
    """Index close as futures proxy: the bar of the target date, else the newest earlier one; basis 0, expiry flag."""
    rows = index_bars.where((F.col("base_date") <= F.lit(target)) & F.col("close").isNotNull())
    last = rows.agg(F.max("base_date").alias("base_date"), F.max_by(F.struct("close", "volume"), "base_date").alias("r"))
    return last.where("base_date is not null").select(
        "base_date", F.col("r.close").alias("kospi200_futures"), F.lit(0.0).alias("futures_basis"), F.coalesce("r.volume", F.lit(0)).cast("long").alias("open_interest"),
        F.lit(0.0).alias("night_futures_return"), tm.expiration_flag(F.col("base_date")).alias("expiration_flag"),
    )


def series_master(definitions: DataFrame) -> DataFrame:
    """Series definitions to master rows, the last definition per id."""
    row = F.max_by(F.struct("source", F.coalesce("name", "name_ko").alias("name"), "category", "unit", "frequency"), "seq")
    sid = F.coalesce("series_id", "endpoint")
    return definitions.groupBy(sid.alias("series_id")).agg(row.alias("r")).select("series_id", "r.*", F.lit(True).alias("is_active"))


def source_fallback(rows: DataFrame, order: dict[str, int]) -> DataFrame:
    """Per symbol-day the valid rows' best source in the given order."""
    rank = F.lit(None).cast("int")
    for source, place in order.items():
        rank = F.when(F.col("source") == source, place).otherwise(rank)
    usable = rows.where(px.valid_row_lenient()).withColumn("attempt", rank).where(F.col("attempt").isNotNull())
    keep = Window.partitionBy("symbol", "base_date").orderBy("attempt", F.col("trading_value").desc(), F.col("volume").desc(), F.col("close_price").desc())
    return usable.withColumn("pick", F.row_number().over(keep)).where(F.col("pick") == 1).drop("pick", "attempt")


def disclosure_events(filings: DataFrame, rules: list | None = None) -> DataFrame:
    """Events by title keyword over the whole text; the first rule that matches wins."""
    title, hit = F.col("report_nm"), F.lit(None).cast("int")
    table = rules or EVENT_RULES
    for place in reversed(range(len(table))):
        found = F.lit(False)
        for word in table[place][0]:
            found = found | title.contains(word)
        hit = F.when(found, place).otherwise(hit)
    shapes = F.array(*[F.struct(F.lit(k).alias("event_type"), F.lit(e).alias("event_score"), F.lit(s).alias("sentiment_score")) for _, k, e, s in table])
    others = [c for c in filings.columns if c != "report_nm"]
    # the match is tested before any text is moved on
    return filings.withColumn("rule", hit).where(F.col("rule").isNotNull()).select(*others, F.get(shapes, F.col("rule")).alias("e")).select(*others, "e.*")


def published_at(pub_date: Column) -> Column:
    """Instant of an RFC-2822 date text; null when it cannot be read."""
    body = F.regexp_extract(pub_date, r"^[A-Za-z]{3}, (.+)$", 1)
    return F.try_to_timestamp(F.when(body != "", body), F.lit("dd MMM yyyy HH:mm:ss Z"))


def fresh_news(news: DataFrame, now: Column, hours: int = 12) -> DataFrame:
    """Items published within the window before ``now``."""
    dated = news.withColumn("published_at", published_at(F.col("pub_date")))
    return dated.where(F.col("published_at") >= now - F.expr(f"INTERVAL {hours} HOURS"))


def merge_snapshot_into_price(prices: DataFrame, snapshots: DataFrame) -> DataFrame:
    """Cap and shares of the same day onto valid price rows; other rows are unchanged."""
    snap = snapshots.select("symbol", "base_date", F.col("market_cap").alias("s_cap"), F.col("listed_shares").cast("double").alias("s_shares"), F.lit(True).alias("has_snapshot"))
    ok = px.valid_row_lenient() & F.col("has_snapshot").isNotNull()
    joined = prices.join(snap, ["symbol", "base_date"], "left")
    return joined.withColumns({
        "market_cap": F.when(ok, F.col("s_cap")).otherwise(F.col("market_cap")),
        "outstanding_shares": F.when(ok, F.col("s_shares")).otherwise(F.col("outstanding_shares")),
    }).drop("s_cap", "s_shares", "has_snapshot")


def merge_snapshot_into_supply(supply: DataFrame, snapshots: DataFrame) -> DataFrame:
    snap = snapshots.select("symbol", "base_date", F.col("foreign_holding_ratio").alias("s_ratio"), F.lit(True).alias("has_snapshot"))
    joined = supply.join(snap, ["symbol", "base_date"], "left")
    ratio = F.when(F.col("has_snapshot"), F.col("s_ratio")).otherwise(F.col("foreign_holding_ratio"))
    return joined.withColumn("foreign_holding_ratio", ratio).drop("s_ratio", "has_snapshot")


def history_slice(rows: DataFrame, start, end) -> DataFrame:
    """Back-filled rows of a period, available at 18:00 KST of their day."""
    kept = rows.where(F.col("base_date").between(F.lit(start).cast("date"), F.lit(end).cast("date")))
    return kept.withColumn("available_at", tm.available_at(F.col("base_date"), 18))
