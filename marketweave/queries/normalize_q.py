"""Landed payloads to keyed rows."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import functions as F

from ..operators import normalize as nz, prices as px
from ..sources import payloads as pl
from ..sources.tables import dedupe_last
from .registry import TARGET, query
from .windows_q import panel

def c(name):
    return F.col(name)


def text(col):
    return (F.col(col) if isinstance(col, str) else col).cast("string")


def bar_struct():
    return F.struct(
        F.when(c("dc") == 10, "").otherwise(F.date_format("base_date", "yyyyMMdd")).alias("stck_bsop_date"),
        text("p").alias("stck_oprc"), text(c("p") + 1).alias("stck_hgpr"), text(c("p") - 1).alias("stck_lwpr"),
        F.when(c("tx") == 0, "").otherwise(F.format_number("p", 0)).alias("stck_clpr"), text("vol").alias("acml_vol"), text("val").alias("acml_tr_pbmn"),
        F.when(c("dc") == 0, "").otherwise(text("shares")).alias("lstn_stcn"), F.when((c("dc") == 0) & (c("ln") > 4), "77").otherwise("").alias("hts_avls"),
    )


def landed_bars(L):
    """Landed broker payloads: a list, a single object, or a list with a header object."""
    row = bar_struct()
    raw = F.when(c("ln") <= 2, F.to_json(F.struct(F.array(row).alias("output2")))).when(c("ln") <= 4, F.to_json(F.struct(row.alias("output")))).otherwise(
        F.to_json(F.struct(F.struct(F.lit("19990101").alias("stck_bsop_date")).alias("output1"), F.array(row).alias("output"))))
    return L.day_bars.select("symbol", c("base_date").alias("position"), raw.alias("raw_data"))


def bar_rows(L):
    return pl.payload_rows(landed_bars(L), nz.BAR_FIELDS)


@query("read_raw_payload", """
SELECT symbol, base_date AS position, CASE WHEN tx = 0 THEN '' ELSE format('{:,}', p) END AS close_text, vol::VARCHAR AS volume_text, CASE WHEN ln > 4 THEN '19990101' END AS header_date FROM day_bars""", "position")
def read_raw_payload(L):
    return bar_rows(L).select("symbol", "position", c("row.stck_clpr").alias("close_text"), c("row.acml_vol").alias("volume_text"), c("header.stck_bsop_date").alias("header_date"))


@query("write_raw_payload", "SELECT symbol, base_date, close_price, 'LINE' AS source_label, base_date AS source_base_date FROM panel", "base_date source_base_date")
def write_raw_payload(L):
    kept = pl.keep_payload(panel(L).select("symbol", "base_date", "close_price"), F.lit("LINE"), {"source_base_date": c("base_date")})
    get = lambda p: F.get_json_object("raw_data", p)
    return kept.select(
        get("$.response_row.symbol").alias("symbol"), get("$.response_row.base_date").alias("base_date"), get("$.response_row.close_price").try_cast("double").alias("close_price"),
        get("$.source_label").alias("source_label"), get("$.source_base_date").alias("source_base_date"))


@query("norm_price_generic", """
SELECT symbol, base_date, p::DOUBLE AS open_price, (p + 1)::DOUBLE AS high_price, (p - 1)::DOUBLE AS low_price, CASE WHEN tx > 0 THEN p::DOUBLE END AS close_price, vol::DOUBLE AS volume, val::DOUBLE AS trading_value,
 NULL::DOUBLE AS market_cap, CASE WHEN dc > 0 THEN shares::DOUBLE END AS outstanding_shares FROM day_bars""", "base_date")
def norm_price_generic(L):
    rows = L.day_bars.select("symbol", "base_date", text("p").alias("open"), text(c("p") + 1).alias("high"), text(c("p") - 1).alias("low"),
                             F.when(c("tx") == 0, "n/a").otherwise(F.format_number("p", 0)).alias("close"), text("vol").alias("volume"), text("val").alias("trading_value"),
                             F.lit("-").alias("market_cap"), F.when(c("dc") == 0, "").otherwise(text("shares")).alias("outstanding_shares"))
    return nz.price_generic(rows)


@query("norm_price_quote", "SELECT symbol, base_date, CASE WHEN tx > 0 THEN p::DOUBLE END AS close_price, vol::DOUBLE AS volume, val::DOUBLE AS trading_value FROM day_bars", "base_date")
def norm_price_quote(L):
    body = F.struct(c("symbol").alias("stck_shrn_iscd"), F.when(c("tx") == 0, "").otherwise(F.format_number("p", 0)).alias("stck_prpr"), text("vol").alias("acml_vol"), text("val").alias("acml_tr_pbmn"))
    raw = F.when(c("ln") <= 3, F.to_json(F.struct(body.alias("output")))).otherwise(F.to_json(body))
    at = F.timestamp_add("HOUR", F.lit(7), c("base_date").cast("timestamp"))
    return nz.price_quote(L.day_bars.select(raw.alias("raw_data"), at.alias("available_at"))).select("symbol", "base_date", "close_price", "volume", "trading_value")


@query("norm_price_history", "SELECT symbol, base_date, CASE WHEN tx > 0 THEN p::DOUBLE END AS close_price, vol::DOUBLE AS volume, val::DOUBLE AS trading_value FROM day_bars WHERE dc <> 10", "base_date")
def norm_price_history(L):
    return nz.price_history(bar_rows(L)).select("symbol", "base_date", "close_price", "volume", "trading_value")


@query("norm_price_ohlcv", """
SELECT symbol, CASE WHEN dc <> 10 THEN base_date END AS base_date, CASE WHEN tx > 0 THEN p END AS close_price, vol AS volume, val AS trading_value, sh AS outstanding_shares,
 last_value(CASE WHEN tx > 0 AND sh > 0 THEN p * sh END IGNORE NULLS) OVER (PARTITION BY symbol ORDER BY base_date ROWS UNBOUNDED PRECEDING) AS market_cap, tx > 0 AND p > 0 AND vol > 0 AND val > 0 AS is_valid
FROM (SELECT *, CASE WHEN dc > 0 THEN shares WHEN ln > 4 THEN 77 END AS sh FROM day_bars)""", "base_date")
def norm_price_ohlcv(L):
    return nz.price_ohlcv(bar_rows(L)).select("symbol", "base_date", "close_price", "volume", "trading_value", "outstanding_shares", "market_cap", "is_valid")


_MKT = "CASE WHEN tx % 4 = 0 THEN 'KOSPI' WHEN tx % 4 = 1 THEN 'KOSDAQ' WHEN tx % 4 = 2 THEN 'KOSPI' END"


def exchange_rows(L):
    """Exchange rows; half of them use the alternative fields."""
    code = F.when(c("tx") % 4 == 0, "STK").when(c("tx") % 4 == 1, "KOSDAQ GLOBAL").when(c("tx") % 4 == 2, None).otherwise("KONEX")
    first = c("ln") <= 4
    return L.day_bars.select(
        F.when(first, F.concat(F.lit("Q"), "symbol")).alias("ISU_SRT_CD"), F.when(~first, text(c("symbol").cast("long"))).alias("ISU_CD"),
        F.when(first, code).alias("MKT_ID"), F.when(c("tx") % 4 == 2, "유가증권시장").otherwise(F.when(~first, code)).alias("MKT_NM"),
        F.date_format("base_date", "yyyyMMdd").alias("BAS_DD"), F.format_number("p", 0).alias("TDD_CLSPRC"),
        F.when(c("dc") == 0, "-").otherwise(text("vol")).alias("ACC_TRDVOL"), text("val").alias("TDD_AMT"), F.when(first, text("shares")).alias("LIST_SHRS"),
        text("tx").alias("FLUC_RT"), F.lit("").alias("ISU_ABBRV"), c("symbol").alias("ISU_NM"),
    )


@query("norm_price_exchange_stock", f"""
SELECT symbol, symbol AS name, {_MKT} AS market, base_date, p::DOUBLE AS close_price, CASE WHEN dc > 0 THEN vol::DOUBLE END AS volume, val::DOUBLE AS trading_value,
 CASE WHEN ln <= 4 THEN shares::DOUBLE END AS outstanding_shares, tx::DOUBLE AS change_rate, 'KRX_API' AS source FROM day_bars WHERE tx % 4 <> 3""", "base_date")
def norm_price_exchange_stock(L):
    return nz.price_exchange_stock(exchange_rows(L), TARGET).select("symbol", "name", "market", "base_date", "close_price", "volume", "trading_value", "outstanding_shares", "change_rate", "source")


@query("norm_price_etp", """
SELECT symbol, CASE WHEN ln > 3 THEN 'ETF' ELSE 'ETN' END AS market, CASE WHEN dc = 0 THEN $T ELSE base_date END AS base_date, CASE WHEN tx > 0 THEN p::DOUBLE END AS close_price, vol::DOUBLE AS volume,
 val::DOUBLE AS trading_value, 'KRX' AS source FROM day_bars""", "base_date")
def norm_price_etp(L):
    rows = L.day_bars.select(
        c("symbol").alias("ISU_CD"), F.concat(F.lit("ETF "), "symbol").alias("ISU_NM"), F.when(c("ln") > 3, "ETF").otherwise("ETN").alias("market"),
        F.when(c("dc") == 0, "").otherwise(F.date_format("base_date", "yyyyMMdd")).alias("BAS_DD"), F.when(c("tx") == 0, "-").otherwise(F.format_number("p", 0)).alias("TDD_CLSPRC"),
        text("vol").alias("ACC_TRDVOL"), text("val").alias("ACC_TRDVAL"), F.lit("").alias("MKTCAP"))
    return nz.price_etp(rows, TARGET).select("symbol", "market", "base_date", "close_price", "volume", "trading_value", "source")


@query("norm_price_normalized_record", """
SELECT symbol, base_date, close_price, volume, trading_value, market_cap, source FROM prices_raw WHERE close_price IS NOT NULL AND volume > 0 AND trading_value > 0""", "base_date")
def norm_price_normalized_record(L):
    return L.prices_raw.where(px.valid_row_lenient()).select("symbol", "base_date", "close_price", "volume", "trading_value", "market_cap", "source")


def gapped_snapshots(L):
    """All snapshots; those of a low ratio lack cap, shares and holding ratio."""
    given = lambda n: F.when(c("per") > 2, c(n)).alias(n)
    return L.snapshots.select(*[given(n) if n in ("market_cap", "listed_shares", "foreign_holding_ratio") else n for n in L.snapshots.columns])


@query("join_price_and_cap", """
SELECT b.market, b.symbol, b.base_date, p::DOUBLE AS close_price, s.market_cap, s.listed_shares FROM (SELECT *, 'KOSPI' AS market FROM day_bars WHERE ln <= 4 UNION ALL SELECT *, 'KOSDAQ' FROM day_bars WHERE ln > 4) b
LEFT JOIN (SELECT *, CASE WHEN source = 'KIS' THEN 'KOSPI' ELSE 'KOSDAQ' END AS market FROM (SELECT * REPLACE (CASE WHEN per > 2 THEN market_cap END AS market_cap, CASE WHEN per > 2 THEN listed_shares END AS listed_shares) FROM snapshots)) s ON s.market = b.market AND s.symbol = b.symbol AND s.base_date = b.base_date""", "base_date")
def join_price_and_cap(L):
    bars = L.day_bars.where("ln <= 4").withColumn("market", F.lit("KOSPI")).unionByName(L.day_bars.where("ln > 4").withColumn("market", F.lit("KOSDAQ")))
    caps = gapped_snapshots(L).select(F.when(c("source") == "KIS", "KOSPI").otherwise("KOSDAQ").alias("market"), "symbol", "base_date", "market_cap", "listed_shares")
    return nz.price_and_cap(bars.select("market", "symbol", "base_date", c("p").cast("double").alias("close_price")), caps)


@query("norm_supply_simple", "SELECT symbol, base_date, CASE WHEN dc > 0 THEN vol ELSE 0 END::DOUBLE AS foreign_net_buy, 0.0::DOUBLE AS institutional_net_buy, (-vol)::DOUBLE AS individual_net_buy FROM day_bars", "base_date")
def norm_supply_simple(L):
    rows = L.day_bars.select(
        "symbol", F.when(c("ln") <= 2, F.date_format("base_date", "yyyyMMdd")).when(c("ln") <= 4, text("base_date")).alias("base_date"), F.when(c("dc") > 0, text("vol")).alias("foreign_net_buy"),
        F.lit("x").alias("institutional_net_buy"), text(-c("vol")).alias("individual_net_buy"), F.timestamp_add("HOUR", F.lit(7), c("base_date").cast("timestamp")).alias("available_at"))
    return nz.supply_simple(rows)


@query("norm_supply_investor", """
SELECT symbol, base_date, CASE WHEN dc = 0 THEN 0 ELSE vol END AS individual_net_buy, CASE WHEN dc = 0 THEN 0 ELSE -vol END AS foreign_net_buy, 0 AS pension_net_buy
FROM (SELECT *, max(CASE WHEN dc > 0 AND vol <> 0 AND month(base_date) % 2 = 0 THEN 1 ELSE 0 END) OVER (PARTITION BY symbol, year(base_date), month(base_date)) AS live FROM day_bars) WHERE live = 1""", "base_date", ints="pension_net_buy")
def norm_supply_investor(L):
    """A batch is a symbol's month; those of odd months, and days without discount, hold no flow."""
    live = (c("dc") > 0) & (F.month("base_date") % 2 == 0)
    row = F.struct(F.date_format("base_date", "yyyyMMdd").alias("stck_bsop_date"), F.when(live, F.format_number("vol", 0)).otherwise("0").alias("prsn_ntby_qty"), F.lit("").alias("orgn_ntby_qty"),
                   F.when(live, text(-c("vol"))).otherwise("junk").alias("frgn_ntby_qty"), F.lit("0").alias("pnsn_ntby_qty"), F.lit(None).cast("string").alias("etc_corp_ntby_qty"))
    batch = F.date_format("base_date", "yyyy-MM").alias("batch")
    return nz.supply_investor(L.day_bars.select("symbol", batch, row.alias("row"))).select("symbol", "base_date", "individual_net_buy", "foreign_net_buy", "pension_net_buy")


def landed_shorts(L):
    """Short-sale payloads of two market codes per symbol-day; the first is empty for some."""
    full = F.struct(F.when(c("tx") == 0, "").otherwise(F.date_format("base_date", "yyyy-MM-dd")).alias("bsop_date"), F.when(c("dc") == 0, None).otherwise(text("vol")).alias("ssts_cntg_qty"), text(c("vol") + 1).alias("short_volume"),
                    F.format_number("val", 0).alias("ssts_tr_pbmn"), F.when(c("tx") > 2, text("tx")).alias("short_sell_vol_rate"))
    header = F.struct(F.when(c("dc") > 2, F.date_format("base_date", "yyyyMMdd")).otherwise("").alias("stck_bsop_date"))
    payload = F.to_json(F.struct(header.alias("output1"), F.array(full).alias("output2")))
    empty = F.to_json(F.struct(header.alias("output1"), F.expr("cast(array() as array<string>)").alias("output2")))
    request = F.when(c("dc") > 1, F.date_format("base_date", "yyyyMMdd"))
    both = F.explode(F.array(F.struct(F.lit(0).alias("attempt"), F.when(c("ln") <= 4, c("payload")).otherwise(empty).alias("raw_data")), F.struct(F.lit(1).alias("attempt"), c("payload").alias("raw_data"))))
    return L.day_bars.select("symbol", "base_date", "dc", "ln", request.alias("request_date"), payload.alias("payload")).select("symbol", "request_date", both.alias("b")).select("symbol", "request_date", "b.*")


def shorts(L):
    return nz.short_selling(pl.payload_rows(landed_shorts(L), nz.SHORT_FIELDS))


_SHORT = """sh AS (SELECT symbol, CASE WHEN tx > 0 OR dc > 1 THEN base_date END AS base_date, a AS attempt, CASE WHEN dc = 0 THEN vol + 1 ELSE vol END AS short_volume, val AS short_value, CASE WHEN tx > 2 THEN tx::DOUBLE END AS short_ratio,
 tx > 0 OR dc > 1 AS accepted FROM day_bars, (VALUES (0), (1)) AS t(a) WHERE ln <= 4 OR a = 1)"""


@query("norm_short_selling", f"WITH {_SHORT} SELECT * FROM sh", "base_date", ints="attempt")
def norm_short_selling(L):
    return shorts(L)


@query("norm_short_market_fallback", f"WITH {_SHORT} SELECT s.* FROM sh s WHERE accepted AND attempt = (SELECT min(attempt) FROM sh t WHERE t.accepted AND t.symbol = s.symbol AND t.base_date = s.base_date)", "base_date", ints="attempt")
def norm_short_market_fallback(L):
    return nz.short_market_fallback(shorts(L)).select("symbol", "base_date", "attempt", "short_volume", "short_value", "short_ratio", "accepted")


def quote_rows(L):
    return L.day_bars.select(
        c("symbol").cast("long").cast("string").alias("symbol"), "base_date", F.when(c("tx") == 0, "").otherwise(text("p")).alias("hts_avls"), F.when(c("dc") == 0, "x").otherwise(text(c("dc") / 4)).alias("per"), text("tx").alias("pbr"),
        text(c("p") + 1).alias("w52_hgpr"), text(c("p") - 1).alias("w52_lwpr"), text("shares").alias("lstn_stcn"), F.lit(None).cast("string").alias("hts_frgn_ehrt"), F.lit("").alias("hts_kor_isnm"), F.lit("sector").alias("bstp_kor_isnm"))


@query("norm_snapshot", """
SELECT symbol, base_date, CASE WHEN tx > 0 THEN p * 100000000 ELSE 0 END AS market_cap, dc::DOUBLE / 4 AS per, tx::DOUBLE AS pbr, p + 1 AS w52_high, p - 1 AS w52_low, shares AS listed_shares, 0.0::DOUBLE AS foreign_holding_ratio FROM day_bars""", "base_date")
def norm_snapshot(L):
    return nz.snapshot(quote_rows(L))


@query("norm_basic_info", """
SELECT symbol, base_date, 'sector' AS name, CASE WHEN tx > 0 THEN p * 100000000 END AS market_cap, shares AS outstanding_shares, NULL::DOUBLE AS foreign_holding_ratio, CASE WHEN dc > 0 THEN dc::DOUBLE / 4 END AS per, tx::DOUBLE AS pbr FROM day_bars""", "base_date")
def norm_basic_info(L):
    return nz.basic_info(quote_rows(L))


@query("norm_financials", "SELECT symbol, base_date, val AS revenue, CASE WHEN tx > 0 THEN -vol ELSE 0 END AS operating_income, 0::BIGINT AS net_income, shares AS total_assets, 0::BIGINT AS total_liabilities, p AS total_equity FROM day_bars WHERE dc <> 10", "base_date")
def norm_financials(L):
    rows = L.day_bars.select(
        "symbol", F.when(c("dc") == 10, "").otherwise(F.date_format("base_date", "yyyyMMdd")).alias("stck_bsop_date"), text("val").alias("sale_account"), F.when(c("tx") > 0, text(-c("vol"))).otherwise("").alias("op_prfit"),
        F.lit(None).cast("string").alias("thst_np"), text("shares").alias("total_assets"), F.lit("0").alias("total_liab"), text("p").alias("total_equity"))
    return nz.financials(rows)


@query("norm_ratios", "SELECT symbol, base_date, CASE WHEN tx > 0 THEN dc::DOUBLE END AS per, CASE WHEN tx > 0 THEN tx::DOUBLE END AS pbr, CASE WHEN ln > 3 AND dc > 0 THEN ln::DOUBLE END AS roe, CASE WHEN dc > 0 THEN p::DOUBLE END AS debt_ratio FROM day_bars", "base_date")
def norm_ratios(L):
    quotes = L.day_bars.select("symbol", "base_date", F.when(c("tx") > 0, text("dc")).otherwise("n/a").alias("per"), F.when(c("tx") > 0, text("tx")).alias("pbr"))
    stability = L.day_bars.select("symbol", "base_date", F.when((c("ln") > 3) & (c("dc") > 0), text("ln")).otherwise("").alias("self_cptl_ntin_inrt"), F.when(c("dc") > 0, F.format_number("p", 0)).alias("lblt_rate"))
    return nz.ratios(quotes, stability)


@query("ratio_has_values", "SELECT symbol, base_date, per, pbr, roe FROM (SELECT symbol, base_date, CASE WHEN dc > 2 THEN dc::DOUBLE END AS per, CASE WHEN tx > 2 THEN tx::DOUBLE END AS pbr, CASE WHEN ln > 4 THEN ln::DOUBLE END AS roe FROM day_bars) WHERE coalesce(per, pbr, roe) IS NOT NULL", "base_date")
def ratio_has_values(L):
    rows = L.day_bars.select("symbol", "base_date", F.when(c("dc") > 2, c("dc").cast("double")).alias("per"), F.when(c("tx") > 2, c("tx").cast("double")).alias("pbr"),
                             F.when(c("ln") > 4, c("ln").cast("double")).alias("roe"), F.lit(None).cast("double").alias("debt_ratio"))
    return rows.where(nz.ratio_has_values()).select("symbol", "base_date", "per", "pbr", "roe")


def orders(L):
    return L.table("orders").withColumns({"day": c("o_orderdate").cast("date"), "cents": F.round(c("o_totalprice") * 100).cast("long")})


@query("norm_fred", "SELECT o_orderkey::VARCHAR AS series_id, o_orderdate::DATE AS base_date, round(o_totalprice * 100)::DOUBLE AS value FROM orders WHERE o_orderstatus <> 'P'", "base_date")
def norm_fred(L):
    item = F.struct(text("day").alias("date"), F.when(c("o_orderstatus") == "P", ".").otherwise(text("cents")).alias("value"))
    return nz.fred(orders(L).select(text("o_orderkey").alias("series_id"), F.to_json(F.struct(F.array(item).alias("observations"))).alias("raw_data")))


@query("norm_trading_economics", "SELECT o_orderkey::VARCHAR AS series_id, o_orderdate::DATE AS base_date, CASE WHEN o_orderstatus = 'F' THEN round(o_totalprice * 100)::DOUBLE ELSE o_custkey::DOUBLE END AS value FROM orders WHERE o_orderstatus <> 'P'", "base_date")
def norm_trading_economics(L):
    value = F.when(c("o_orderstatus") == "F", c("cents"))
    raw = F.struct(F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss").alias("DateTime"), value.alias("Value"), F.when(c("o_orderstatus") == "O", c("o_custkey")).alias("Last"))
    return nz.trading_economics(orders(L).select(text("o_orderkey").alias("series_id"), F.to_json(raw).alias("raw_data")))


def ecos_rows(L):
    cycle = F.when(c("o_orderpriority") == "1-URGENT", "D").when(c("o_orderpriority") == "2-HIGH", "DD").when(c("o_orderpriority") == "3-MEDIUM", "M").when(c("o_orderpriority") == "5-LOW", "Q").otherwise("A")
    rows = orders(L).withColumn("cycle", cycle)
    period = F.when(c("cycle").isin("D", "DD"), F.date_format("day", "yyyyMMdd")).when(c("cycle") == "M", F.date_format("day", "yyyyMM")).when(
        c("cycle") == "Q", F.concat(text(F.year("day")), F.lit("Q"), text(F.quarter("day")))).otherwise(text(F.year("day")))
    value = F.when(c("o_orderstatus") == "P", ".").when(c("o_custkey") % 10 == 0, "").otherwise(text("cents"))
    return rows.select("o_orderkey", c("o_orderpriority").alias("series_id"), "cycle", period.alias("time"), value.alias("data_value"))


_ECOS = """ecos AS (SELECT o_orderkey, o_orderpriority AS series_id, CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN o_orderdate::DATE WHEN o_orderpriority = '3-MEDIUM' THEN date_trunc('month', o_orderdate)::DATE
 WHEN o_orderpriority = '5-LOW' THEN date_trunc('quarter', o_orderdate)::DATE ELSE date_trunc('year', o_orderdate)::DATE END AS base_date,
 CASE WHEN o_orderstatus <> 'P' AND o_custkey % 10 <> 0 THEN round(o_totalprice * 100)::DOUBLE END AS value FROM orders)"""


@query("norm_ecos", f"""WITH {_ECOS} SELECT series_id, base_date, value FROM (SELECT *, row_number() OVER (PARTITION BY series_id, base_date ORDER BY o_orderkey DESC) AS rn FROM ecos) WHERE rn = 1 AND value IS NOT NULL""", "base_date")
def norm_ecos(L):
    keyed = nz.central_bank(ecos_rows(L), keep=("o_orderkey",))
    return dedupe_last(keyed, ["series_id", "base_date"], [F.desc("o_orderkey")]).where("value is not null").select("series_id", "base_date", "value")


@query("norm_market_close_series", "SELECT series_id, max(base_date) AS base_date, arg_max(value, base_date) AS value FROM macro_series WHERE base_date BETWEEN $T - 7 AND $T GROUP BY 1", "base_date", "value")
def norm_market_close_series(L):
    return nz.market_close_series(L.macro_series, TARGET - timedelta(days=7), TARGET)


@query("norm_futures_options", """
SELECT symbol, base_date, p::DOUBLE AS open, (p + 1)::DOUBLE AS high, (p - 1)::DOUBLE AS low, CASE WHEN tx > 0 THEN p ELSE 0 END::DOUBLE AS close, vol AS volume, shares AS open_interest, 'futs' AS kind FROM day_bars WHERE ln <= 4
UNION ALL SELECT symbol, base_date, p::DOUBLE, (p + 1)::DOUBLE, (p - 1)::DOUBLE, CASE WHEN tx > 0 THEN p ELSE 0 END::DOUBLE, vol, shares, 'optn' FROM day_bars WHERE ln > 4""", "base_date")
def norm_futures_options(L):
    def rows(prefix, where):
        row = F.struct(F.date_format("base_date", "yyyyMMdd").alias("stck_bsop_date"), text("p").alias(f"{prefix}_oprc"), text(c("p") + 1).alias(f"{prefix}_hgpr"), text(c("p") - 1).alias(f"{prefix}_lwpr"),
                       F.when(c("tx") > 0, text("p")).alias(f"{prefix}_clpr"), text("vol").alias("acml_vol"), text("shares").alias("open_intrs"))
        return nz.futures_options(L.day_bars.where(where).select("symbol", row.alias("row")), prefix).withColumn("kind", F.lit(prefix))

    return rows("futs", "ln <= 4").unionByName(rows("optn", "ln > 4"))


@query("norm_overseas", "SELECT symbol, CASE WHEN ln <= 4 THEN 'NASD' ELSE 'NYSE' END AS exchange, base_date, p::DOUBLE AS open, (p + 1)::DOUBLE AS high, (p - 1)::DOUBLE AS low, p::DOUBLE AS close, vol AS volume, CASE WHEN dc > 0 THEN val ELSE 0 END AS trading_value FROM day_bars", "base_date")
def norm_overseas(L):
    row = F.struct(F.date_format("base_date", "yyyyMMdd").alias("xymd"), text("p").alias("open"), text(c("p") + 1).alias("high"), text(c("p") - 1).alias("low"), text("p").alias("clos"),
                   F.concat(text("vol"), F.lit(".7")).alias("tvol"), F.when(c("dc") > 0, text("val")).alias("tamt"))
    rows = L.day_bars.select("symbol", row.alias("row"), F.when(c("ln") <= 4, "NASD").otherwise("NYSE").alias("x"))
    return nz.overseas(rows, c("x"))


@query("norm_bond", "SELECT symbol, base_date, p::DOUBLE AS price, CASE WHEN tx > 0 THEN tx::DOUBLE / 2 ELSE 0 END AS yield_rate, vol AS volume FROM day_bars", "base_date")
def norm_bond(L):
    return nz.bond(L.day_bars.select("symbol", "base_date", text("p").alias("stck_prpr"), F.when(c("tx") > 0, text(c("tx") / 2)).alias("bond_yield"), text("vol").alias("acml_vol")))


@query("norm_derivatives_daily", """
SELECT base_date, m AS kospi200_futures, 0.0::DOUBLE AS futures_basis, v AS open_interest, 0.0::DOUBLE AS night_futures_return, isodow(base_date) = 4 AND day(base_date) BETWEEN 8 AND 14 AS expiration_flag
FROM (SELECT base_date, max(p)::DOUBLE AS m, sum(vol)::BIGINT AS v FROM day_bars GROUP BY 1) WHERE base_date = (SELECT max(base_date) FROM day_bars WHERE base_date <= DATE '2001-06-14')""", "base_date")
def norm_derivatives_daily(L):
    bars = L.day_bars.groupBy("base_date").agg(F.max("p").cast("double").alias("close"), F.sum("vol").alias("volume"))
    return nz.derivatives_daily(bars, date(2001, 6, 14))


@query("norm_series_master", """
SELECT o_orderpriority AS series_id, arg_max(o_orderstatus, o_orderkey) AS source, arg_max('name ' || o_custkey, o_orderkey) AS name, arg_max(CASE WHEN o_custkey % 2 = 0 THEN 'rates' ELSE 'fx' END, o_orderkey) AS category FROM orders GROUP BY 1""")
def norm_series_master(L):
    name = F.concat(F.lit("name "), text("o_custkey"))
    rows = L.table("orders").select(
        F.when(c("o_orderpriority") != "5-LOW", c("o_orderpriority")).alias("series_id"), c("o_orderpriority").alias("endpoint"), c("o_orderstatus").alias("source"),
        F.when(c("o_custkey") % 3 == 0, name).alias("name"), name.alias("name_ko"), F.when(c("o_custkey") % 2 == 0, "rates").otherwise("fx").alias("category"),
        F.lit("unit").alias("unit"), F.lit("D").alias("frequency"), c("o_orderkey").alias("seq"))
    return nz.series_master(rows).select("series_id", "source", "name", "category")


@query("price_source_fallback", """
SELECT symbol, base_date, source, close_price, trading_value FROM (SELECT *, row_number() OVER (PARTITION BY symbol, base_date ORDER BY CASE source WHEN 'KIS' THEN 0 WHEN 'KRX' THEN 1 END, trading_value DESC, volume DESC, close_price DESC) AS rn
 FROM prices WHERE source IN ('KIS', 'KRX') AND close_price IS NOT NULL AND volume > 0 AND trading_value > 0) WHERE rn = 1""", "base_date")
def price_source_fallback(L):
    return nz.source_fallback(px.canonical(L.prices_raw), {"KIS": 0, "KRX": 1}).select("symbol", "base_date", "source", "close_price", "trading_value")


DEMO_RULES = [(("License", "license"), "rights_issue", -0.8, -0.5), (("copyright", "Copyright"), "earnings", 0.5, 0.3), (("@",), "contract", 0.6, 0.7), (("the ",), "buyback", 0.7, 0.8)]


@query("norm_disclosure_events", """
WITH e AS (SELECT doc_id, symbol, lang, CASE WHEN contains(report_nm, 'License') OR contains(report_nm, 'license') THEN 0 WHEN contains(report_nm, 'copyright') OR contains(report_nm, 'Copyright') THEN 1
 WHEN contains(report_nm, '@') THEN 2 WHEN contains(report_nm, 'the ') THEN 3 END AS r FROM filings)
SELECT doc_id, symbol, lang, ['rights_issue', 'earnings', 'contract', 'buyback'][r + 1] AS event_type, [-0.8::DOUBLE, 0.5, 0.6, 0.7][r + 1] AS event_score, [-0.5::DOUBLE, 0.3, 0.7, 0.8][r + 1] AS sentiment_score FROM e WHERE r IS NOT NULL""")
def norm_disclosure_events(L):
    return nz.disclosure_events(L.filings.drop("source"), DEMO_RULES)


@query("news_freshness_filter", """
SELECT event_id, printf('%06d', user_id) AS symbol, date_trunc('second', ts) - INTERVAL 9 HOUR AS published_at FROM events WHERE event_type <> 'error' AND date_trunc('second', ts) - INTERVAL 9 HOUR >= TIMESTAMP '2024-01-30 09:00:00' - INTERVAL 12 HOUR""", "published_at")
def news_freshness_filter(L):
    return nz.fresh_news(L.news, F.lit("2024-01-30 09:00:00").cast("timestamp")).select("event_id", "symbol", "published_at")


@query("raw_field_presence", """
SELECT base_date, count(*) AS total_rows, count(*) FILTER (WHERE tx > 0) AS valid_close_rows, count(*) AS valid_volume_rows, count(*) FILTER (WHERE dc > 0) AS valid_value_rows FROM day_bars GROUP BY 1""", "base_date")
def raw_field_presence(L):
    nested = F.struct(F.struct(F.when(c("tx") > 0, text("p")).otherwise("").alias("stck_clpr")).alias("response_row"), text("vol").alias("volume"), F.when(c("dc") > 0, text("val")).alias("acml_tr_pbmn"))
    rows = pl.parsed(L.day_bars.select("base_date", F.to_json(nested).alias("raw_data")))
    return rows.groupBy("base_date").agg(
        F.count(F.lit(1)).alias("total_rows"), F.count(pl.field("stck_clpr", "doc", "close_price")).alias("valid_close_rows"),
        F.count(pl.field("acml_vol", "doc", "volume")).alias("valid_volume_rows"), F.count(pl.field("acml_tr_pbmn", "doc", "trading_value")).alias("valid_value_rows"))


@query("merge_snapshot_into_price", """
SELECT p.symbol, p.base_date, p.close_price, CASE WHEN s.symbol IS NOT NULL THEN s.market_cap ELSE p.market_cap END AS market_cap, CASE WHEN s.symbol IS NOT NULL THEN s.listed_shares ELSE p.outstanding_shares END AS outstanding_shares
FROM panel p LEFT JOIN (SELECT * REPLACE (CASE WHEN per > 2 THEN market_cap END AS market_cap, CASE WHEN per > 2 THEN listed_shares END AS listed_shares) FROM snapshots) s ON s.symbol = p.symbol AND s.base_date = p.base_date""", "base_date")
def merge_snapshot_into_price(L):
    return nz.merge_snapshot_into_price(panel(L), gapped_snapshots(L)).select("symbol", "base_date", "close_price", "market_cap", "outstanding_shares")


@query("merge_snapshot_into_supply", """
SELECT p.symbol, p.base_date, p.foreign_net_buy, CASE WHEN s.symbol IS NOT NULL THEN s.foreign_holding_ratio ELSE p.foreign_holding_ratio END AS foreign_holding_ratio
FROM supply p LEFT JOIN (SELECT * REPLACE (CASE WHEN per > 2 THEN foreign_holding_ratio END AS foreign_holding_ratio) FROM snapshots) s ON s.symbol = p.symbol AND s.base_date = p.base_date""", "base_date")
def merge_snapshot_into_supply(L):
    return nz.merge_snapshot_into_supply(L.supply.select("symbol", "base_date", "foreign_net_buy", "foreign_holding_ratio"), gapped_snapshots(L))


@query("backfill_history_slice", "SELECT symbol, base_date, close_price, base_date + INTERVAL 9 HOUR AS available_at FROM prices_raw WHERE base_date BETWEEN DATE '1999-01-01' AND DATE '2000-12-31'", "base_date available_at")
def backfill_history_slice(L):
    return nz.history_slice(L.prices_raw, "1999-01-01", "2000-12-31").select("symbol", "base_date", "close_price", "available_at")
