"""The status document on small tables: order of panels, cuts, empty tables."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from marketweave.operators import status as st

D1, D2 = dt.date(2026, 5, 7), dt.date(2026, 5, 8)


def panel(df):
    return json.loads(df.select(F.to_json(F.struct("panel"), {"ignoreNullFields": "false"})).first()[0])["panel"]


def test_static_list_is_cut_before_it_is_collected(spark):
    rows = [(f"{i:06d}", f"n{i}", "KOSPI", "STOCK", i % 3 > 0) for i in range(500)]
    universe = spark.createDataFrame(rows, "symbol string, name string, market string, asset_type string, enabled boolean").repartition(7)
    updates = spark.createDataFrame([("000001", D1), ("000002", D2)], "symbol string, base_date date")
    got = panel(st.static_summary(universe, updates, limit=20))
    assert (got["enabled_count"], got["disabled_count"], got["latest_updated_at"]) == (333, 167, "2026-05-08")
    assert [s["symbol"] for s in got["symbols"]] == [f"{i:06d}" for i in range(20)]
    plan = st.first_rows(universe, "symbol", 20)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan


def test_newest_day_is_counted_in_one_pass(spark, tmp_path):
    spark.createDataFrame([("a", D1, 0.0), ("a", D2, 1.0), ("b", D2, 0.0)], "symbol string, base_date date, per double").write.parquet(str(tmp_path / "r"))
    table = spark.read.parquet(str(tmp_path / "r"))
    counted = st.newest_counts(table, n=F.count(F.lit(1)), zero=F.count_if(F.col("per") == 0))
    assert tuple(counted.first()) == (D2, 2, 1)
    plan = counted._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 or plan.count("Scan parquet") == 1
    assert tuple(st.newest_counts(table.limit(0), n=F.count(F.lit(1))).first()) == (None, None)


def test_samples_keep_unknown_symbols_and_own_statement_days(spark):
    master = spark.createDataFrame([("a", "A", "KOSPI", "STOCK", True)], "symbol string, name string, market string, asset_type string, is_active boolean")
    prices = spark.createDataFrame([("a", D1, 5.0, 1.0, 1.0, None, None), ("c", D2, 7.0, 1.0, 1.0, 9.0, 1.0)], "symbol string, base_date date, close_price double, volume double, trading_value double, market_cap double, outstanding_shares double")
    supply = spark.createDataFrame([("a", D2, 1.0, 2.0, None)], "symbol string, base_date date, foreign_net_buy double, institutional_net_buy double, foreign_holding_ratio double")
    shorts = spark.createDataFrame([], "symbol string, base_date date, short_volume long, short_value double, short_ratio double")
    statements = spark.createDataFrame([("a", D1, 10), ("a", D2, 11), ("c", D1, 3)], "symbol string, base_date date, revenue long")
    ratios = spark.createDataFrame([("c", D2, 1.0, 2.0, 3.0, 4.0)], "symbol string, base_date date, per double, pbr double, roe double, debt_ratio double")
    got = {r["symbol"]: r for r in panel(st.samples(("a", "c", "zz"), master, prices, supply, shorts, statements, ratios))}
    assert got["a"]["price_date"] is None and got["a"]["foreign_net_buy"] == 1.0 and got["a"]["revenue"] == 11
    assert got["c"]["close_price"] == 7.0 and got["c"]["debt_ratio"] == 4.0 and got["c"]["name"] is None and got["c"]["revenue"] == 3
    assert set(got["zz"].values()) == {"zz", None}


def test_runs_come_newest_first(spark):
    logs = spark.createDataFrame([("j2", D1, "OK", 5), ("j1", D2, "OK", 1), ("j1", D2, "FAIL", 9), ("j1", D2, "OK", 3), ("j0", dt.date(2026, 4, 1), "OK", 2)], "job_name string, target_date date, status string, records_processed long")
    got = [(r["target_date"], r["job_name"], r["status"], r["occurrences"], r["max_records_processed"]) for r in panel(st.pipeline_health(logs, D2))]
    assert got == [("2026-05-08", "j1", "FAIL", 1, 9), ("2026-05-08", "j1", "OK", 2, 3), ("2026-05-07", "j2", "OK", 1, 5)]


def test_document_has_all_panels_in_order(spark):
    panels = {name: spark.range(1).select(F.struct(F.lit(None).cast("string").alias("x")).alias("panel")) for name in st.PANELS}
    text = st.document(panels).first()[0]
    assert list(json.loads(text)) == list(st.PANELS) and len(st.PANELS) == 17 and '"x":null' in text
    panels.pop("freshness")
    with pytest.raises(ValueError):
        st.document(panels)
