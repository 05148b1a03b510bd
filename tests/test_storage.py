"""Keyed writes to stored tables and the daily jobs on top of them."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from marketweave.plans import jobs
from marketweave.queries import QUERIES
from marketweave.schemas import SCHEMAS
from marketweave.sources import tables as tb

D = dt.date
PRICE = "symbol string, base_date date, close_price double, volume double, trading_value double, source string, available_at timestamp"
AT = dt.datetime(2026, 5, 8, 7)


def price(symbol, day, close, seq=0):
    return (symbol, day, close, 10.0, 100.0, "KIS", AT + dt.timedelta(minutes=seq))


def test_upsert_rewrites_touched_partitions_only(spark, tmp_path, collect):
    store = jobs.Store(spark, str(tmp_path))
    table, order = "normalized_stock_prices_daily", [F.desc("available_at")]
    first = [price("5930", D(2026, 5, 7), 1.0), price("000660", D(2026, 5, 7), 2.0), price("000660", D(2026, 5, 8), 3.0), price("", D(2026, 5, 8), 9.0)]
    store.upsert(table, spark.createDataFrame(first, PRICE), order)
    untouched = {p.name: p.stat().st_mtime_ns for p in (tmp_path / table / "base_date=2026-05-07").glob("*.parquet")}
    second = [price("Q005930", D(2026, 5, 8), 4.0), price("000660", D(2026, 5, 8), 5.0), price("000660", D(2026, 5, 8), 6.0, 1), (("000001", D(2026, 5, 8), None, 1.0, 1.0, "KIS", AT))]
    store.upsert(table, spark.createDataFrame(second, PRICE), order)
    got = collect(store.read(table), "symbol", F.col("base_date").cast("string"), "close_price")
    assert got == [("000660", "2026-05-07", 2.0), ("000660", "2026-05-08", 6.0), ("005930", "2026-05-07", 1.0), ("005930", "2026-05-08", 4.0)]
    assert untouched == {p.name: p.stat().st_mtime_ns for p in (tmp_path / table / "base_date=2026-05-07").glob("*.parquet")}


def test_state_of_stored_tables_comes_from_footers(spark, tmp_path, collect):
    store, names = jobs.Store(spark, str(tmp_path)), ["normalized_stock_prices_daily", "normalized_macro_series", "feature_store_daily"]
    rows = [price(f"{i:06d}", D(2026, 5, 1 + i % 7), float(i)) for i in range(1, 100)]
    store.overwrite(names[0], spark.createDataFrame(rows, PRICE))
    before = spark.conf.get("spark.sql.sources.useV1SourceList")
    tb.clear(spark, store.path(names[0]), SCHEMAS[names[0]], "base_date", "2026-05-07")
    tb.clear(spark, store.path(names[2]), SCHEMAS[names[2]], "base_date", "2026-05-07")
    state = store.state(names, D(2026, 5, 6))
    plan = state._jdf.queryExecution().executedPlan().toString()
    assert "PushedAggregation: [COUNT(*)" in plan and "PushedGroupBy: [base_date]" in plan
    got = {r["table_name"]: (r["latest_date"], r["row_count"], r["target_count"], r["lag_days"]) for r in state.collect()}
    held = store.read(names[0])
    assert got[names[0]] == (D(2026, 5, 6), held.count(), held.where("base_date = '2026-05-06'").count(), 0)
    assert got[names[1]] == got[names[2]] == (None, 0, 0, None)
    assert spark.conf.get("spark.sql.sources.useV1SourceList") == before
    assert "BatchScan" not in store.read(names[0])._jdf.queryExecution().executedPlan().toString()


def test_frame_rewrites(spark, collect):
    schema = "k string, d string, v double"
    target = spark.createDataFrame([("a", "1", 1.0), ("b", "1", 2.0), ("c", None, None)], schema)
    changes = spark.createDataFrame([("b", "1", 9.0), ("z", "1", 8.0)], schema)
    assert collect(tb.upsert(target, changes, ["k"]), "k", "v") == [("a", 1.0), ("b", 9.0), ("c", None), ("z", 8.0)]
    assert collect(tb.insert_ignore(target, changes, ["k"]), "k", "v") == [("a", 1.0), ("b", 2.0), ("c", None), ("z", 8.0)]
    assert collect(tb.update_where(target, changes, ["k"], ["v"]), "k", "v") == [("a", 1.0), ("b", 9.0), ("c", None)]
    assert collect(tb.delete_where(target, {"d": "1"}, {"v": 2.0}), "k") == [("b",), ("c",)]
    assert collect(tb.reject_missing_keys(target, ["k", "d"]), "k", "reject_reason") == [("a", None), ("b", None), ("c", "missing d")]
    with pytest.raises(ValueError):
        tb.align_schema(target, SCHEMAS["normalized_macro_series"], strict=True)
    with pytest.raises(ValueError):
        tb.delete_where(target)


def stocked(spark, tmp_path, days=70):
    """A store with an open calendar, one rising stock and its flows."""
    store = jobs.Store(spark, str(tmp_path))
    start, end = D(2026, 2, 2), D(2026, 2, 2) + dt.timedelta(days=days)
    weekdays = [start + dt.timedelta(days=i) for i in range(days + 1) if (start + dt.timedelta(days=i)).weekday() < 5]
    span = spark.createDataFrame([(start, end)], "first_day date, last_day date")
    schedule = spark.createDataFrame([(d, "XKRX") for d in weekdays], "calendar_date date, exchange_code string")
    manual = spark.createDataFrame([], "calendar_date date, exchange_code string, is_open boolean, reason string")
    jobs.calendar_job(store, span, schedule, manual, ["XKRX"])
    rows = [(s, d, 100.0 + i, 10.0, 1000.0 + i, "KIS", AT) for s in ("005930", "000660") for i, d in enumerate(weekdays)]
    store.upsert("normalized_stock_prices_daily", spark.createDataFrame(rows, PRICE), [F.desc("available_at")])
    flows = spark.createDataFrame([("005930", d, float(i % 4)) for i, d in enumerate(weekdays)], "symbol string, base_date date, foreign_net_buy double")
    store.upsert("normalized_stock_supply_daily", flows, [F.desc("foreign_net_buy")])
    series = spark.createDataFrame([("USDKRW", d, 1300.0 + i) for i, d in enumerate(weekdays)], "series_id string, base_date date, value double")
    store.upsert("normalized_macro_series", series, [F.desc("value")])
    return store, weekdays


def test_feature_job_replaces_its_slice(spark, tmp_path, collect):
    store, weekdays = stocked(spark, tmp_path)
    target = weekdays[-1]
    master = spark.createDataFrame([("005930", "KOSPI"), ("000660", "KOSPI")], "symbol string, market string")
    universe = spark.createDataFrame([("005930",)], "symbol string")
    wide = spark.createDataFrame([(d, 10.0 + i, 5.0, 2.0) for i, d in enumerate(weekdays)], "base_date date, gold double, copper double, wti double")
    for _ in range(2):  # the second run finds its own slice
        assert jobs.feature_job(store, universe, master, wide, target, minimum=2) == "SUCCESS"
    got = {(r["symbol"], r["feature_name"]): r["feature_value"] for r in store.read("feature_store_daily").collect()}
    n = len(weekdays)
    assert got["005930", "close_price"] == 100.0 + n - 1 and abs(got["005930", "return_5d"] - ((100.0 + n - 1) / (100.0 + n - 6) - 1)) < 1e-12
    assert got["GLOBAL", "copper_gold_ratio"] == 5.0 / (10.0 + n - 1) and ("GLOBAL", "USDKRW_1D_CHG_PCT") in got and ("000660", "close_price") not in got
    assert len(got) == store.read("feature_store_daily").count()
    assert store.read("pipeline_run_logs").where("status = 'SUCCESS'").count() == 2
    assert jobs.feature_job(store, universe, master, wide, target, minimum=50) == "SKIPPED_INSUFFICIENT_PRICE_DATA"


def test_jobs_log_what_they_made(spark, tmp_path, collect):
    store, weekdays = stocked(spark, tmp_path)
    target = weekdays[-1]
    master = spark.createDataFrame([("005930", "KOSPI"), ("000660", "KOSPI")], "symbol string, market string")
    universe = spark.createDataFrame([("005930",)], "symbol string")
    wide = spark.createDataFrame([(d, 10.0 + i, 5.0, 2.0) for i, d in enumerate(weekdays)], "base_date date, gold double, copper double, wti double")
    assert jobs.feature_job(store, universe, master, wide, target, minimum=2) == "SUCCESS"
    logged = lambda: [r["records_processed"] for r in store.read("pipeline_run_logs").orderBy("records_processed").collect()]
    held = store.read("feature_store_daily")
    first, macro = held.count(), held.where("symbol = 'GLOBAL'").count()
    assert logged() == [first] and 0 < macro < first
    # nobody to compute and no macro rows: the rows of before count for nothing
    store.overwrite("normalized_macro_series", store.read("normalized_macro_series").withColumn("value", F.lit(None).cast("double")))
    assert jobs.feature_job(store, universe.limit(0), master, wide.limit(0), target, minimum=2) == "WARN"
    assert logged() == [0, first] and store.read("feature_store_daily").count() == macro


def test_rows_counted_while_they_are_written(spark, tmp_path):
    rows = spark.range(1000).select(F.col("id").alias("k"), (F.col("id") % 3).alias("base_date"), (F.col("id") < 10).alias("made"))
    assert tb.store_counted(rows, "made", str(tmp_path / "t")) == 10
    assert tb.store_counted(rows.where("k < 0"), "made", str(tmp_path / "u")) == 0
    stored = spark.read.parquet(str(tmp_path / "t"))
    assert stored.count() == 1000 and sorted(stored.columns) == ["base_date", "k"]


def test_ranking_job_gates_on_the_calendar(spark, tmp_path):
    store, weekdays = stocked(spark, tmp_path)
    master = spark.createDataFrame([("005930", "KOSPI", "STOCK", "S"), ("000660", "KOSPI", "STOCK", "H")], "symbol string, market string, asset_type string, name string")
    broker = store.read("normalized_stock_prices_daily").select("symbol", "base_date", "volume", "trading_value", "market_cap")
    saturday = weekdays[-1] + dt.timedelta(days=(5 - weekdays[-1].weekday()) % 7)
    assert jobs.ranking_job(store, broker, master, saturday) == "SKIPPED_MARKET_CLOSED"
    status = jobs.ranking_job(store, broker, master, weekdays[-1], min_valid_rows=1, ready_thresholds={"KOSPI": 1, "KOSDAQ": 0})
    rows = store.read("normalized_market_rankings_daily").collect()
    assert status == "SUCCESS" and {(r["rank_type"], r["source"]) for r in rows} == {("volume", "KIS"), ("trading_value", "KIS")}
    assert store.read("pipeline_run_logs").where("status = 'SKIPPED_MARKET_CLOSED'").count() == 1  # the full status is kept
    # stored rows can be read point in time, raw rows have the detail of the same ranks
    assert {r["available_at"] for r in rows} == {dt.datetime.combine(weekdays[-1], dt.time(7))}
    raw = {(r["market"], r["rank_type"], r["raw_rank"], r["symbol"]): json.loads(r["raw_data"]) for r in store.read("raw_market_rankings").collect()}
    assert set(raw) == {(r["market"], r["rank_type"], r["rank"], r["symbol"]) for r in rows}
    assert all(d["ranking_base_date"] == str(weekdays[-1]) and d["response_row"]["volume"] == 10.0 for d in raw.values())
    assert store.read("pipeline_run_logs").where("status = 'SUCCESS'").first()["records_processed"] == len(rows)


def test_calendar_job_keeps_days_outside_its_period(spark, tmp_path):
    store = jobs.Store(spark, str(tmp_path))
    manual = spark.createDataFrame([], "calendar_date date, exchange_code string, is_open boolean, reason string")
    for first, last in ((D(2026, 1, 1), D(2026, 3, 31)), (D(2026, 4, 1), D(2026, 4, 30)), (D(2026, 3, 31), D(2026, 4, 2))):
        span = spark.createDataFrame([(first, last)], "first_day date, last_day date")
        schedule = spark.createDataFrame([(first, "XKRX")], "calendar_date date, exchange_code string")
        jobs.calendar_job(store, span, schedule, manual, ["XKRX", "XNYS"])
    rows = store.read("market_trading_calendar").where("exchange_code = 'XKRX'").collect()
    assert len(rows) == 120 and min(r["calendar_date"] for r in rows) == D(2026, 1, 1)
    assert {r["calendar_date"] for r in rows if r["is_open"]} == {D(2026, 1, 1), D(2026, 3, 31)}  # the last run closes 1 April


def test_ranking_job_replaces_its_slices_only(spark, tmp_path):
    store, weekdays = stocked(spark, tmp_path)
    target, table = weekdays[-1], "normalized_market_rankings_daily"
    old = [(target, m, "volume", 1, s, "KIS") for m, s in (("KOSPI200", "005930"), ("KOSPI", "999999"))] + [(weekdays[-2], "KOSPI", "volume", 1, "888888", "KIS")]
    store.upsert(table, spark.createDataFrame(old, "base_date date, market string, rank_type string, rank long, symbol string, source string"), [F.col("symbol")])
    master = spark.createDataFrame([("005930", "KOSPI", "STOCK", "S")], "symbol string, market string, asset_type string, name string")
    broker = store.read("normalized_stock_prices_daily").select("symbol", "base_date", "volume", "trading_value", "market_cap")
    jobs.ranking_job(store, broker, master, target, min_valid_rows=1)
    kept = {(r["base_date"], r["market"], r["symbol"]) for r in store.read(table).collect()}
    assert kept == {(target, "KOSPI200", "005930"), (target, "KOSPI", "005930"), (weekdays[-2], "KOSPI", "888888")}
    # nothing to rank any more: the slices go, index members and other dates stay
    jobs.ranking_job(store, broker.limit(0), master.limit(0), target, min_valid_rows=1)
    assert {(r["base_date"], r["market"]) for r in store.read(table).collect()} == {(target, "KOSPI200"), (weekdays[-2], "KOSPI")}
    assert store.read("raw_market_rankings").count() == 0


def test_an_empty_ranking_clears_the_date(spark, tmp_path):
    store, weekdays = stocked(spark, tmp_path)
    target, table = weekdays[-1], "normalized_market_rankings_daily"
    old = spark.createDataFrame([(d, "KOSPI", "volume", 1, "999999", "KIS") for d in weekdays[-2:]], "base_date date, market string, rank_type string, rank long, symbol string, source string")
    store.upsert(table, old, [F.col("symbol")])
    nobody = spark.createDataFrame([], "symbol string, market string, asset_type string, name string")
    broker = store.read("normalized_stock_prices_daily").select("symbol", "base_date", "volume", "trading_value", "market_cap")
    assert jobs.ranking_job(store, broker, nobody, target, min_valid_rows=1) == "SKIPPED_INSUFFICIENT_PRICE_DATA"
    assert [r["base_date"] for r in store.read(table).collect()] == [weekdays[-2]]


def test_upsert_reads_the_touched_days_only(spark, tmp_path, monkeypatch):
    store = jobs.Store(spark, str(tmp_path))
    table, order = "normalized_stock_prices_daily", [F.desc("available_at")]
    days = [D(2026, 3, 1) + dt.timedelta(days=i) for i in range(20)]
    store.upsert(table, spark.createDataFrame([price("005930", d, 1.0) for d in days], PRICE), order)
    read, seen = tb.upsert, []

    def spied(target, changes, keys):
        seen.extend(target.inputFiles() and [p for p in target._jdf.queryExecution().executedPlan().toString().splitlines() if "PartitionFilters" in p])
        return read(target, changes, keys)

    monkeypatch.setattr(tb, "upsert", spied)
    store.upsert(table, spark.createDataFrame([price("005930", days[3], 2.0)], PRICE), order)
    assert any("base_date" in p.split("PartitionFilters: [")[1].split("]")[0] for p in seen)
    assert store.read(table).count() == 20 and store.read(table).where("close_price = 2.0").count() == 1


def test_a_table_without_a_path_is_empty(spark, tmp_path):
    assert tb.read(spark, str(tmp_path / "none"), SCHEMAS["stocks_master"]).count() == 0


def test_insert_ignore_joins_no_parts(spark):
    plan = QUERIES["insert_ignore"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == plan.count("REPARTITION_BY_NUM") == 2  # one shuffle of each side, whose parts AQE leaves apart
