"""Literal cases of windows, calendar, rankings, macro, signals, and brute-force checks on skewed data."""

import contextlib
import datetime as dt
import io
import json
import random
import re

import pytest

from pyspark.sql import functions as F

from marketweave.functions import parsing as ps, times as tm
from marketweave.operators import aggregates as ag, audits as au, calendar as cal, features as feat, joins as jn, macro as mc, maintenance as mt, normalize as nz, rankings as rk, signals as sg, universe as un, windows as win
from marketweave.queries import QUERIES
from marketweave.sources import payloads as pl

D = dt.date


def test_calendar(spark, collect):
    span = spark.createDataFrame([(D(2026, 1, 1), D(2026, 1, 5))], "first_day date, last_day date")
    schedule = spark.createDataFrame([(D(2026, 1, 2), "XKRX"), (D(2026, 1, 5), "XKRX")], "calendar_date date, exchange_code string")
    built = cal.build(span, schedule, ["XKRX"])
    assert [r[1] for r in collect(built, F.col("calendar_date").cast("string"), "reason")] == ["holiday", "trading_day", "weekend", "weekend", "trading_day"]
    manual = spark.createDataFrame([(D(2026, 1, 1), "XKRX", True, "manual_override_trading_day"), (D(2026, 1, 5), "XKRX", False, "closed")], "calendar_date date, exchange_code string, is_open boolean, reason string")
    fixed = {str(r["calendar_date"]): r for r in cal.apply_overrides(built, manual).collect()}
    assert fixed["2026-01-01"]["is_open"] and fixed["2026-01-01"]["source"] == "manual_override" and str(fixed["2026-01-01"]["open_time"]) == "2026-01-01 00:00:00"
    assert not fixed["2026-01-05"]["is_open"] and fixed["2026-01-05"]["open_time"] is None
    near = {str(r["calendar_date"]): r for r in cal.neighbours(built).collect()}
    assert near["2026-01-04"]["previous_open_day"] == D(2026, 1, 2) and near["2026-01-03"]["next_open_day"] == D(2026, 1, 5) and near["2026-01-05"]["latest_open_day"] == D(2026, 1, 5)
    assert near["2026-01-05"]["previous_open_day"] == D(2026, 1, 2)


def test_calendar_fallbacks_differ(spark, collect):
    empty = spark.createDataFrame([], "calendar_date date, exchange_code string, is_open boolean, reason string, source string")
    one = spark.createDataFrame([(D(2026, 1, 5), "XKRX", False, "holiday", "x")], empty.schema)
    assert len(collect(cal.between(empty, D(2026, 1, 2), D(2026, 1, 8)))) == 5  # no row at all: weekdays
    assert collect(cal.between(one, D(2026, 1, 2), D(2026, 1, 8))) == []  # some row: only what it says
    days = spark.createDataFrame([(D(2026, 1, 5),), (D(2026, 1, 6),), (D(2026, 1, 10),)], "calendar_date date")
    assert [r[1] for r in collect(cal.diagnostic(days, one), F.col("calendar_date").cast("string"), "is_open")] == [False, True, False]


def panel(spark, closes, symbol="005930", sources=None):
    start = D(2026, 1, 5)
    return spark.createDataFrame(
        [(symbol, start + dt.timedelta(days=i), c, (sources or ["KIS"] * len(closes))[i], 100.0 + i, float(i % 3)) for i, c in enumerate(closes)],
        "symbol string, base_date date, close_price double, source string, trading_value double, foreign_net_buy double",
    )


def last(df):
    return df.orderBy(F.desc("base_date")).first()


def test_price_warnings(spark):
    row = last(win.stock_columns(panel(spark, [210000.0, 215000.0, 220000.0, 225000.0, 230000.0, 900000.0])))
    assert row["price_warning"] == "WARN_PRICE_JUMP_ANOMALY"  # the first of both in sorted order
    row = last(win.stock_columns(panel(spark, [900000.0])))
    assert row["price_warning"] == "WARN_PRICE_SCALE_ANOMALY" and row["volatility_20d"] == 0.0 and row["return_5d"] is None
    row = last(win.stock_columns(panel(spark, [110000.0, 111000.0, 109500.0, 110500.0, 112000.0, 250000.0], "058470")))
    assert row["price_warning"] == "WARN_PRICE_JUMP_ANOMALY"


def test_mixed_window_and_returns(spark):
    df = win.stock_columns(panel(spark, [100.0, 101.0, 102.0, 103.0, 104.0, 110.0], sources=["KIS"] * 4 + ["KIS_DETAIL"] * 2))
    row = last(feat.null_mixed(df))
    assert row["mixed_5"] and row["return_5d"] is None and not row["mixed_20"] and row["moving_avg_5"] == 104.0


def test_series_change_uses_oldest_of_few(spark):
    s = spark.createDataFrame([("A", D(2026, 1, i), float(v)) for i, v in ((1, 10), (2, 20), (3, 40))], "series_id string, base_date date, value double")
    row = last(win.lag_change_series(s))
    assert row["chg_1d"] == 1.0 and row["chg_5d"] == 3.0
    assert last(win.lag_change_wide(s, "series_id"))["chg_5d"] is None


def test_union_features_last_producer_wins(spark, collect):
    schema = "symbol string, base_date string, feature_name string, feature_value double"
    a = spark.createDataFrame([("GLOBAL", "d", "x", 1.0), ("5930", "d", "y", float("inf")), ("", "d", "z", 1.0)], schema)
    b = spark.createDataFrame([("GLOBAL", "d", "x", 2.0), ("5930", "d", "w", 3.0)], schema)
    assert collect(feat.union_features(a, b), "symbol", "feature_name", "feature_value") == [("005930", "w", 3.0), ("GLOBAL", "x", 2.0)]


def test_signal_golden_value(spark):
    wide = spark.createDataFrame([("A", 2.0, 1.0, 1.5), ("B", 1.0, 2.0, -1.5), ("C", None, None, None)], "symbol string, moving_avg_5 double, moving_avg_20 double, foreign_flow_zscore double")
    got = {r["symbol"]: (round(r["total_score"], 6), r["signal"]) for r in sg.score(sg.components(wide)).collect()}
    assert got == {"A": (0.465, "HOLD"), "B": (-0.375, "SELL"), "C": (0.0, "HOLD")}


PRICE = "symbol string, base_date date, close_price double, volume double, trading_value double, market_cap double, source string"


def test_rankings_follow_each_market(spark):
    kospi = [(f"{i:06d}", D(2026, 5, 4), 10.0, 10.0 + i, 100.0, 1000.0 + i, "KRX") for i in range(1, 5)]
    prices = spark.createDataFrame(kospi + [("069500", D(2026, 4, 28), 10.0, 5.0, 50.0, 9.0, "KRX")], PRICE)
    master = spark.createDataFrame([(f"{i:06d}", "KOSPI", "STOCK", f"N{i}") for i in range(1, 5)] + [("069500", "ETF", "ETF", "E")], "symbol string, market string, asset_type string, name string")
    day = spark.createDataFrame([(D(2026, 5, 4),)], "d date")
    ranked = rk.price_based(prices, master, day, D(2026, 5, 4)).collect()
    etf = {str(r["source_base_date"]) for r in ranked if r["market"] == "ETF"}
    top = [r["symbol"] for r in ranked if r["market"] == "KOSPI" and r["rank_type"] == "market_cap" and r["rank"] == 1]
    assert etf == {"2026-04-28"} and top == ["000004"] and {r["source"] for r in ranked} == {"VALID_PRICE_FALLBACK"}
    broker = prices.where("symbol <= '000002'").drop("source")
    daily = rk.build_daily(prices, broker, master, day, D(2026, 5, 4), ready_thresholds={"KOSPI": 4, "KOSDAQ": 1}).collect()
    kinds = {(r["market"], r["rank_type"], r["source"]) for r in daily}
    assert kinds == {("KOSPI", "volume", "KIS"), ("KOSPI", "trading_value", "KIS"), ("KOSPI", "market_cap", "VALID_PRICE_FALLBACK"), ("ETF", "volume", "VALID_PRICE_FALLBACK"),
                     ("ETF", "trading_value", "VALID_PRICE_FALLBACK"), ("ETF", "market_cap", "VALID_PRICE_FALLBACK")}
    blocked = rk.build_daily(prices, broker, master, day, D(2026, 5, 4), ready_thresholds={"KOSPI": 5, "KOSDAQ": 1}).where("market = 'KOSPI' and rank_type = 'market_cap'")
    assert blocked.count() == 0


def test_rankings_carry_their_detail(spark):
    target = D(2026, 5, 4)
    prices = spark.createDataFrame([(f"06950{i}", D(2026, 4, 30), 10.0, 5.0 + i, 50.0, 9.0, "KRX") for i in range(3)] + [("000001", target, 10.0, 7.0, 70.0, 9.0, "KRX")], PRICE)
    master = spark.createDataFrame([("000001", "KOSPI", "STOCK", "")] + [(f"06950{i}", "ETF", "ETF", f"E{i}") for i in range(3)], "symbol string, market string, asset_type string, name string")
    broker = spark.createDataFrame(
        [("1", target, 20.0, 200.0, 5.0, -1.5, "landed", '{"acml_vol": "20", "prdy_ctrt": "-1.5"}'), ("069500", target, 3.0, 30.0, None, 0.5, None, "no json")],
        "symbol string, base_date date, volume double, trading_value double, market_cap double, change_rate double, name string, response_row string")
    day = spark.createDataFrame([(D(2026, 4, 30),)], "d date")
    rows = rk.build_daily(prices, broker, master, day, target, thresholds={"KOSPI": 5, "KOSDAQ": 5, "ETF": 2, "ETN": 2})
    got = {(r["market"], r["rank_type"], r["rank"]): r for r in rows.collect()}
    stock, fund = got["KOSPI", "volume", 1], got["ETF", "volume", 1]
    assert (stock["name"], stock["change_rate"], stock["market_cap"], stock["available_at"]) == ("landed", -1.5, None, dt.datetime(2026, 5, 4, 7))
    assert json.loads(stock["raw_data"]) == {
        "response_row": {"acml_vol": "20", "prdy_ctrt": "-1.5"}, "master_market": "KOSPI", "master_asset_type": "STOCK", "source_base_date": "2026-05-04", "ranking_base_date": "2026-05-04"}
    assert (fund["symbol"], fund["change_rate"], fund["market_cap"]) == ("069502", None, 9.0)
    assert json.loads(fund["raw_data"]) == {
        "price_base_date": "2026-04-30", "fallback_reason": "kis_volume_sparse", "original_kis_count": 1, "master_market": "ETF", "master_asset_type": "ETF",
        "source_base_date": "2026-04-30", "ranking_base_date": "2026-05-04"}
    value = json.loads(got["ETF", "trading_value", 1]["raw_data"])
    assert value["fallback_reason"] is None and value["original_kis_count"] is None
    # a dense market keeps its broker rows, whose text need not be JSON
    dense = rk.build_daily(prices, broker, master, day, target, thresholds={"KOSPI": 5, "KOSDAQ": 5, "ETF": 1, "ETN": 2}).where("market = 'ETF' and rank_type = 'volume'").collect()
    assert [(r["symbol"], r["source"], json.loads(r["raw_data"])["response_row"]) for r in dense] == [("069500", "KIS", None)]
    nested = broker.withColumn("response_row", F.struct(F.col("volume").alias("v")))
    assert {json.loads(r["raw_data"])["response_row"]["v"] for r in rk.build_daily(prices, nested, master, day, target).where("market = 'KOSPI' and source = 'KIS'").collect()} == {20.0}


def test_korean_times_in_any_session_zone(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ("UTC", "America/New_York", "Asia/Seoul"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            row = spark.range(1).select(F.unix_seconds(tm.available_at(F.lit(D(2026, 3, 8)))).alias("s"), tm.kst_date(F.timestamp_seconds(F.lit(1772982000))).alias("d"),
                                        tm.kst_date(F.timestamp_seconds(F.lit(1772981999))).alias("e")).first()
            assert (row["s"], row["d"], row["e"]) == (1772953200, D(2026, 3, 9), D(2026, 3, 8))
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_valid_price_date(spark):
    master = spark.createDataFrame([("000001", "KOSPI"), ("000002", "KOSPI")], "symbol string, market string")
    rows = [(s, d, c, 10.0, 10.0, None, "KRX") for s in ("000001", "000002") for d, c in ((D(2026, 4, 30), 5.0), (D(2026, 5, 4), None))]
    days = spark.createDataFrame([(D(2026, 4, 30),), (D(2026, 5, 4),)], "base_date date")
    got = rk.latest_valid_price_date(spark.createDataFrame(rows, PRICE), master, days, D(2026, 5, 5), min_valid_rows=2).first()
    assert str(got["selected_price_base_date"]) == "2026-04-30" and got["market_counts"] == "KOSPI:2" and got["rejected_dates"] == "2026-05-04=0"


def test_us_closed_day_carries(spark):
    wide = spark.createDataFrame([(D(2026, 7, 3), 6000.0, 1.0), (D(2026, 7, 4), None, 2.0)], "base_date date, sp500 double, usdkrw double")
    calendar = spark.createDataFrame([(D(2026, 7, 3), "XNYS", True), (D(2026, 7, 4), "XNYS", False)], "calendar_date date, exchange_code string, is_open boolean")
    got = {str(r["base_date"]): (r["sp500"], r["usdkrw"], str(r["us_data_date"])) for r in mc.carry_us_closed(wide, calendar).collect()}
    assert got["2026-07-04"] == (6000.0, 2.0, "2026-07-03")


def test_short_sale_payloads(spark, collect):
    docs = [
        ("000001", "20260430", 0, '{"output1": {"stck_bsop_date": "20260429"}, "output2": []}'),
        ("000001", "20260430", 1, '{"output1": {}, "output2": [{"bsop_date": "2026-04-29", "ssts_vol": "1,000", "short_ratio": "-"}]}'),
        ("000002", "20260430", 0, '{"output1": [{"stck_bsop_date": "20260428"}], "output2": {"ssts_cntg_qty": "5"}}'),
        ("", "20260430", 0, '{"output": [{"ssts_cntg_qty": "5"}]}'),
    ]
    df = spark.createDataFrame(docs, "symbol string, request_date string, attempt int, raw_data string")
    parsed = nz.short_selling(pl.payload_rows(df, nz.SHORT_FIELDS))
    kept = nz.short_market_fallback(parsed)
    got = collect(kept.withColumn("d", F.col("base_date").cast("string")), "symbol", "d", "attempt", "short_volume", "short_ratio")
    assert got == [("000001", "2026-04-29", 1, 1000, None), ("000002", "2026-04-28", 0, 5, None)]
    assert parsed.where("not accepted").count() == 1


def test_disclosure_rules(spark, collect):
    df = spark.createDataFrame([(1, "주주배정 유상증자 및 공급계약"), (2, "단일판매 공급계약"), (3, "x"), (4, None)], "doc_id int, report_nm string")
    assert collect(nz.disclosure_events(df), "doc_id", "event_type", "event_score") == [(1, "rights_issue", -0.8), (2, "contract", 0.6)]


def test_universe_union(spark, collect):
    schema = "symbol string, name string, market string, category string"
    parts = [spark.createDataFrame([("005930", None, "KOSPI", "static")], schema), spark.createDataFrame([("005930", "S", None, "report_rank"), ("000660", "H", "KOSPI", "report_rank")], schema)]
    got = collect(un.union_sources(parts), "symbol", "name", "market", "source_category")
    assert got == [("000660", "H", "KOSPI", "report_rank"), ("005930", "S", "KOSPI", "report_rank,static")]
    assert [r["symbol"] for r in un.top_universe(un.union_sources(parts), 1).collect()] == ["005930"]


def test_canonical_price_repair(spark, collect):
    schema = "symbol string, base_date string, open_price double, high_price double, low_price double, close_price double, volume double, trading_value double, market_cap double, outstanding_shares double, available_at string"
    rows = [("Q530036", "d", 1.0, 1.0, 1.0, 9.0, 5.0, 900.0, None, None, None), ("530036", "d", 1.0, 1.0, 1.0, 8.0, 5.0, 100.0, 77.0, None, "t"), ("Q550043", "d", None, None, None, 3.0, 1.0, 1.0, 5.0, 6.0, "t")]
    got = collect(mt.canonical_prices(spark.createDataFrame(rows, schema)), "symbol", "close_price", "market_cap", "available_at")
    assert got == [("530036", 9.0, 77.0, "t"), ("550043", 3.0, 5.0, "t")]


def test_report_view_statuses(spark):
    static = spark.createDataFrame([("005930", True), ("000660", True), ("1", False)], "symbol string, enabled boolean")
    watch = spark.createDataFrame([("005930", D(2026, 5, 7), "FRESH"), ("000660", D(2026, 5, 6), "STALE_BUT_USABLE"), ("1", D(2026, 1, 1), "STALE")], "symbol string, base_date date, data_status string")
    etf = spark.createDataFrame([("069500", D(2026, 4, 28), 5, "STALE")], "symbol string, latest_price_date date, stale_days int, data_status string")
    row = au.report_views(static, watch, etf, D(2026, 5, 8)).first()
    assert (row["watchlist_rows"], row["active_rows"], row["stale_watchlist"], row["stale_sector_etf"], row["status"]) == (3, 2, 0, 1, "WARN_REPORT_SOURCE_STALE")


def skewed(n=3000, seed=7):
    """A third of the rows belong to one key."""
    rnd = random.Random(seed)
    keys = ["hot" if rnd.random() < 0.34 else f"k{rnd.randrange(40)}" for _ in range(n)]
    return [(k, i * 37 % n, float(rnd.randrange(1000))) for i, k in enumerate(keys)]


@pytest.mark.parametrize("rows_of_a_block", [10**6, 97])
def test_blocked_lag_matches_brute_force(spark, collect, monkeypatch, rows_of_a_block):
    monkeypatch.setattr(win, "BLOCK_ROWS", rows_of_a_block)
    data = skewed()
    got = collect(win.blocked_lag(spark.createDataFrame(data, "k string, t long, v double"), "k", "t", "v"), "k", "t", "v", "previous")
    want, seen = [], {}
    for k, t, v in sorted(data, key=lambda r: r[1]):
        want.append((k, t, v, seen.get(k)))
        seen[k] = v
    assert got == sorted(want, key=repr)


@pytest.mark.parametrize("rows,partitions", [(4000, 2), (4000, 16), (40_000, 2), (40_000, 16)])
def test_blocks_are_even_at_any_size(spark, tmp_path, rows, partitions):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    try:
        hot = spark.range(rows).select(F.lit("hot").alias("k"), (3600 * 5 + F.col("id") * 3599 % 7919).alias("t"))
        table = hot.unionByName(spark.range(400).select(F.concat(F.lit("k"), (F.col("id") % 9).cast("string")).alias("k"), F.col("id").alias("t")))
        table.write.parquet(str(tmp_path / "t"))
        cut = win.in_blocks(spark.read.parquet(str(tmp_path / "t")), ["k"], "t", target=500)
        sizes = [r["count"] for r in cut.where("k = 'hot'").groupBy("block").count().collect()]
        assert max(sizes) <= 1000 and rows / 1000 <= len(sizes) <= rows / 250 and sum(sizes) == rows
        assert cut.where("k <> 'hot'").select("k", "block").distinct().count() == 9
        ranges = cut.where("k = 'hot'").groupBy("block").agg(F.min("t").alias("lo"), F.max("t").alias("hi")).orderBy("block").collect()
        assert all(a["hi"] < b["lo"] for a, b in zip(ranges, ranges[1:]))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_one_instant_of_one_key_is_cut_on(spark):
    rows = [("hot", 7, i * 31 % 3000) for i in range(3000)] + [("hot", i, i) for i in range(600)] + [(None, 7, i) for i in range(800)]
    frame = spark.createDataFrame(rows, "k string, t long, seq long").withColumn("at", F.struct("t", "seq"))
    cut = win.in_blocks(frame, ["k"], "at", target=200)
    sizes = {(r["k"], r["block"]): r["count"] for r in cut.groupBy("k", "block").count().collect()}
    assert max(sizes.values()) <= 400 and sum(sizes.values()) == len(rows)
    spans = cut.groupBy("k", "block").agg(F.min("at").alias("lo"), F.max("at").alias("hi")).where("k = 'hot'").orderBy("block").collect()
    assert all(a["hi"] <= b["lo"] for a, b in zip(spans, spans[1:]))
    # within what ties leave open: rows of one (t, seq) stay together
    assert len(spans) >= 10


@pytest.mark.parametrize("rows_of_a_block", [10**6, 83])
def test_asof_many_matches_brute_force(spark, collect, monkeypatch, rows_of_a_block):
    monkeypatch.setattr(win, "BLOCK_ROWS", rows_of_a_block)
    data = skewed(2000, 11)
    obs, asks = [r for r in data if r[2] < 500], [r for r in data if r[2] >= 500]
    obs += [(k, t, v + 1000) for k, t, v in obs[::3]]  # a second observation of the same instant is the later one
    seen = spark.createDataFrame([(*o, i) for i, o in enumerate(obs)], "k string, at long, value double, seq long")
    asked = spark.createDataFrame([(k, t, i) for i, (k, t, _) in enumerate(asks)], "k string, at long, decision_id long")
    got = collect(jn.asof_many(seen, asked, "k"), "decision_id", "known_value")
    want = []
    for i, (k, t, _) in enumerate(asks):
        before = [o for o in obs if o[0] == k and o[1] <= t]
        want.append((i, max(before, key=lambda o: (o[1], obs.index(o)))[2] if before else None))
    assert got == sorted(want, key=repr)


def test_rows_of_one_payload_keep_their_order(spark):
    bar = lambda day, close, shares: f'{{"stck_bsop_date": "{day}", "stck_clpr": "{close}", "lstn_stcn": "{shares}", "acml_vol": "1", "acml_tr_pbmn": "1"}}'
    first = f'{{"output2": [{bar("20260505", 10, "")}, {bar("20260504", 20, 5)}, {bar("20260501", 30, "")}]}}'
    second = f'{{"output2": [{bar("20260508", "1e30", 7)}, {bar("20260507", 40, "")}, {bar("20260506", "9000000000000000000", 9)}]}}'
    frame = spark.createDataFrame([("005930", 1, first), ("005930", 2, second)], "symbol string, position int, raw_data string")
    rows = pl.payload_rows(frame, nz.BAR_FIELDS)
    assert sorted((r["position"], r["row_position"], r["row"]["stck_bsop_date"]) for r in rows.collect()) == [
        (1, 0, "20260505"), (1, 1, "20260504"), (1, 2, "20260501"), (2, 0, "20260508"), (2, 1, "20260507"), (2, 2, "20260506")]
    caps = {str(r["base_date"]): (r["close_price"], r["market_cap"]) for r in nz.price_ohlcv(rows.repartition(3)).collect()}
    assert caps == {
        "2026-05-05": (10, None), "2026-05-04": (20, 100), "2026-05-01": (30, 100),
        "2026-05-08": (None, 100), "2026-05-07": (40, 100), "2026-05-06": (9000000000000000000, 100),  # junk neither aborts nor carries
    }


def test_a_zero_batch_goes_alone(spark):
    row = "row struct<stck_bsop_date:string,prsn_ntby_qty:string,orgn_ntby_qty:string,frgn_ntby_qty:string,pnsn_ntby_qty:string,etc_corp_ntby_qty:string>"
    flow = lambda day, n: (day, str(n), "", "junk", "0", None)
    frame = spark.createDataFrame([("A", 1, flow("20260501", 0)), ("A", 1, flow("20260502", 0)), ("A", 2, flow("20260503", 0)), ("A", 2, flow("20260504", 7)), ("B", 1, flow("20260501", 0))], f"symbol string, batch int, {row}")
    assert sorted((r["symbol"], str(r["base_date"])) for r in nz.supply_investor(frame).collect()) == [("A", "2026-05-03"), ("A", "2026-05-04")]


def test_a_universe_beyond_the_hard_limit_is_refused(spark):
    frame = spark.createDataFrame([("005930", "static")], "symbol string, source_category string")
    for limit in (0, 501):
        with pytest.raises(ValueError):
            un.top_universe(frame, limit)


def test_fills_never_look_ahead_over_all_history(spark):
    wide = spark.createDataFrame([(dt.date(2026, 5, d), 2.0 if d >= 5 else None, 4.0) for d in range(1, 9)], "base_date date, gold double, wti double")
    early = feat.macro_wide_change(wide).where("feature_name = 'macro_gold_1d_chg'")
    assert min(r["base_date"] for r in early.collect()) == dt.date(2026, 5, 6)


def test_coverage_of_the_newest_day(spark):
    """Against plain sets: a hot symbol, unknown symbols, rows without a day or symbol, symbols whose newest row doesn't count."""
    random.seed(3)
    names = [f"{i:06d}" for i in range(3000)]
    active = spark.createDataFrame([(s,) for s in names + names[:5] + [None]], "symbol string")
    days = [D(2026, 5, 4), D(2026, 5, 6), None]
    rows = [(s, random.choice(days), i % 7 != 0) for i, s in enumerate(names + names)] + [("000001", random.choice(days), None) for _ in range(5000)] + [("zz", days[1], True), (None, days[1], True)]
    for part in (rows, [r for r in rows if r[1] != days[1] or not r[2]], [r for r in rows if r[1] is None], []):
        got = au.covered_stats(spark.createDataFrame(part, "symbol string, base_date date, ok boolean"), active, F.lit(days[0]), F.col("ok")).first()
        newest = max((r[1] for r in part if r[1]), default=None)
        covered = len({r[0] for r in part if r[1] and r[1] == newest and r[2]} & set(names))
        assert tuple(got) == (len(part), newest, sum(r[1] == days[0] for r in part), covered)


def test_freshness_reads_a_table_once(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([("A", D(2026, 5, 4), 1.0, 1.0, 1.0), ("B", D(2026, 5, 4), None, 1.0, 1.0), ("B", D(2026, 5, 3), 1.0, 1.0, 1.0)], "symbol string, base_date date, close_price double, volume double, trading_value double").write.parquet(path)
    table = spark.read.parquet(path)
    active = spark.createDataFrame([("A",), ("B",), ("C",)], "symbol string")
    tables = {"p": (table, "prices"), "r": (table.where("symbol = 'none'"), "ratios"), "k": (table, "krx")}
    rows = au.table_freshness(tables, active, D(2026, 5, 4), F.lit(True))
    got = {r["table_name"]: tuple(r)[1:] for r in rows.collect()}
    assert got["p"] == (3, D(2026, 5, 4), 2, 1 / 3, 2, 0, "WARN_COVERAGE") and got["k"] == (3, D(2026, 5, 4), 2, None, None, 0, "SUCCESS")
    assert got["r"] == (0, None, 0, 0.0, 3, None, "FAIL_EMPTY")
    closed = {r["table_name"]: r["status"] for r in au.table_freshness(tables, active, D(2026, 5, 5), F.lit(False)).collect()}
    assert closed == {"p": "OK_CLOSED_MARKET_NO_ROWS", "r": "FAIL_EMPTY", "k": "OK_CLOSED_MARKET_NO_ROWS"}
    one = au.table_freshness({"p": (table, "prices")}, active, D(2026, 5, 4), F.lit(True))
    assert one._jdf.queryExecution().optimizedPlan().toString().count("parquet") == 1


def test_payload_fields_share_one_parse(spark, collect):
    texts = [
        '{"response_row":{"close":"1,2","x":7},"volume":3,"extra":{"deep":[1]}}', '{"response_row":{"close":" "},"close_price":"9"}', '{"response_row":"text","close":5.5}',
        '{"output":null,"close":4}', '{"output":{"close":8}}', "[1]", "no json", "", None,
    ]
    docs = pl.parsed(spark.createDataFrame(list(enumerate(texts)), "i int, raw_data string"))
    got = docs.select("i", pl.field("close", "doc", "close_price").alias("close"), pl.field("volume").alias("volume"), pl.text_of("doc", "$.extra.deep[0]").alias("deep"), F.try_variant_get(pl.inner_or_whole("doc", "$.output"), "$.close", "int").alias("whole"))
    assert collect(got, "i", "close", "volume", "deep", "whole") == [
        (0, "1,2", "3", "1", None), (1, " ", None, None, None), (2, "5.5", None, None, 5), (3, "4", None, None, 4), (4, None, None, None, 8),
        (5, None, None, None, None), (6, None, None, None, None), (7, None, None, None, None), (8, None, None, None, None),
    ]
    quote = docs.drop("doc").select("raw_data", F.lit("2026-05-08 07:00:00").cast("timestamp").alias("available_at"))
    series = docs.drop("doc").select(F.col("i").cast("string").alias("series_id"), "raw_data")
    for df in (got, nz.price_quote(quote), nz.trading_economics(series)):
        assert df._jdf.queryExecution().optimizedPlan().toString().count("parseJson") == 1


def test_joint_macro_features_equal_their_producers(spark):
    rng, days = random.Random(5), [D(2026, 1, 1) + dt.timedelta(days=i) for i in range(40)]
    some = lambda: rng.choice([None, 0.0, 1.0, 2.5, 4.0])
    wide = spark.createDataFrame([(d, some(), some(), some(), some()) for d in days], "base_date date, gold double, copper double, wti double, us10y double")
    ids = ["USDKRW", "KR_GOVT_10Y", "Base Rate"]
    series = spark.createDataFrame([(i, d, some()) for i in ids for d in days if rng.random() < 0.8], "series_id string, base_date date, value double")
    rows = lambda *dfs: sorted(tuple(r) for df in dfs for r in df.select("base_date", "feature_name", "feature_value").collect())
    for causal in (True, False):
        for day in days[::7]:
            on = lambda df: df.where(F.col("base_date") == F.lit(day))  # noqa: B023, E731
            assert rows(feat.wide_macro_features(wide, day, causal)) == rows(on(feat.macro_ratios(wide, causal)), on(feat.macro_wide_change(wide, causal)))
        joint = feat.series_macro_features(series, causal)
        assert rows(joint) == rows(feat.macro_series_change(series, causal), feat.fx_rate_change(series), feat.rate_bp_change(series))
        assert joint._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1


def _method_bytes(df):
    """The largest generated method of a plan; Java compiles none beyond 8,000 bytes."""
    with contextlib.redirect_stdout(io.StringIO()) as out:
        df.explain("codegen")
    return max(int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", out.getvalue()))


@pytest.mark.parametrize("name", ["norm_snapshot", "norm_price_exchange_stock", "norm_price_ohlcv"])
def test_normalised_rows_stay_compilable(spark, name):
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # an adaptive plan shows no generated code before it runs
    try:
        assert _method_bytes(QUERIES[name](spark, "/root/testdata/sf0.001")) < 8000
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)


def test_parsing_names_its_input_once():
    for rule in (ps.parse_nullable, ps.parse_int_zero, ps.parse_date_any):
        assert str(rule(F.col("landed"))).count("landed") == 1


def test_parsing_of_odd_texts(spark):
    texts = ["1,234.5", "12\n", " 7 ", "-", "", None, "1d", "NaN", ".5", "5.", "1e400", "12 3", "\n7"]
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = [r[0] for r in frame.orderBy("i").select(ps.parse_nullable(F.col("t"))).collect()]
    assert got == [1234.5, 12.0, 7.0, None, None, None, None, None, 0.5, 5.0, float("inf"), None, None]
    days = ["2026-04-29T10", "20260429", "20a6-04-291234567", "x2026/04/29y", "2026-02-30", "2026042", "00000101", None]
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(days)], "i int, t string")
    got = [r[0] for r in frame.orderBy("i").select(ps.parse_date_any(F.col("t")).cast("string")).collect()]
    assert got == ["2026-04-29", "2026-04-29", None, "2026-04-29", None, None, "0000-01-01", None]


def test_short_payloads_are_parsed_before_the_fallback(spark):
    rows = QUERIES["norm_short_market_fallback"](spark, "/root/testdata/sf0.001")
    with contextlib.redirect_stdout(io.StringIO()) as out:
        rows.explain()
    assert "from_json" not in out.getvalue()


def test_pivoted_features_take_one_shuffle(spark, collect):
    rows = [("a", 1, "x", 1.0), ("a", 1, "x", 3.0), ("a", 1, "y", None), ("a", 2, "z", 5.0), (None, 1, "y", 2.0), ("b", 1, None, 7.0)]
    wide = ag.pivot_features(spark.createDataFrame(rows, "symbol string, day int, feature_name string, feature_value double"), ["symbol", "day"], ["x", "y"])
    plan = wide._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == plan.count("REPARTITION_BY_NUM") == 1  # nothing combined before the shuffle, parts not joined after it
    assert collect(wide, "symbol", "day", "x", "y") == sorted([("a", 1, 3.0, None), ("a", 2, None, None), (None, 1, None, 2.0), ("b", 1, None, None)], key=repr)
