"""Literal cases of the scalar rules and row predicates."""

import pytest
from pyspark.sql import functions as F

from marketweave.functions import markets as mk, parsing as ps, sanity as sn, symbols as sy, times as tm
from marketweave.operators import prices as px


def values(spark, data, schema, expr):
    return [r[0] for r in spark.createDataFrame(data, schema).select(expr.alias("v")).collect()]


def test_symbols(spark):
    raw = ["Q530036", " q550043 ", "530036", "0000Z0", "0167Z0", "5930", None, "", "0012345678", "00123456"]
    out = values(spark, [(s,) for s in raw], "s string", sy.normalize_symbol(F.col("s")))
    assert out == ["530036", "550043", "530036", "0000Z0", "0167Z0", "005930", "", "", "0012345678", "00123456"]
    assert values(spark, [("Q530036",), ("530036",), (None,)], "s string", sy.is_q_symbol(F.col("s"))) == [True, False, False]


def test_markets(spark):
    data = [("KOSPI", "PLUS Hanwha Group"), ("KOSPI", "YG PLUS"), ("KOSPI", "KODEX 200"), ("Q", "리노공업"), ("KOSPI", "TIGER ETN"), (None, None)]
    out = values(spark, data, "m string, n string", mk.listing_market(F.col("m"), F.col("n")))
    assert out == ["ETF", "KOSPI", "ETF", "KOSDAQ", "ETN", None]
    labels = values(spark, [("x KOSDAQ global",), ("konex",), (None,), ("other",)], "m string", mk.market_label(F.col("m")))
    assert labels == ["KOSDAQ", "KONEX", "", "OTHER"]
    wins = values(spark, [("KOSPI", "ETF"), ("ETN", "ETF"), ("KOSPI", "Q"), (None, "J")], "a string, b string", mk.prefer_market(F.col("a"), F.col("b")))
    assert wins == ["ETF", "ETN", "KOSPI", "KOSPI"]
    order = values(spark, [("KIS_DETAIL",), ("kis",), ("KRX",), ("VALID_PRICE_FALLBACK",), ("KRX_API",), (None,)], "s string", mk.source_priority(F.col("s")))
    assert order == [0, 1, 2, 3, 4, 4]


def test_parsing(spark):
    texts = [("",), (None,), ("not-a-number",), ("0",), ("1,234.5",), ("-",), (" 7 ",), ("1d",)]
    assert values(spark, texts, "t string", ps.parse_nullable(F.col("t"))) == [None, None, None, 0.0, 1234.5, None, 7.0, None]
    assert values(spark, texts, "t string", ps.parse_int_zero(F.col("t"))) == [0, 0, 0, 0, 1234, 0, 7, 0]
    dates = values(spark, [("2026-04-29T01:02",), ("20260429",), ("2026/04/29",), ("2026-13-01 x",), ("abc",)], "t string", ps.parse_date_any(F.col("t")).cast("string"))
    assert dates == ["2026-04-29", "2026-04-29", "2026-04-29", None, None]
    cycles = [("20240424", "D"), ("202404", "M"), ("2024Q3", "Q"), ("2024", "A"), ("2024", "X")]
    assert values(spark, cycles, "t string, c string", ps.parse_cycle_date(F.col("t"), F.col("c")).cast("string")) == ["2024-04-24", "2024-04-01", "2024-07-01", "2024-01-01", None]


def test_index_quality(spark):
    data = [(7822.24, 4.32, None, None), (0.0, None, None, None), (15000.0, 92.0, None, None), (7822.0, None, None, 7000.0), (130.0, None, 100.0, None), (130.0, 1.0, 100.0, None)]
    flag = sn.classify_index_quality(F.col("v"), F.col("c"), F.col("p"), F.col("s"))
    assert values(spark, data, "v double, c double, p double, s double", flag) == ["OK", "INVALID", "ANOMALY", "SOURCE_MISMATCH", "ANOMALY", "OK"]


def test_times(spark):
    at = values(spark, [("2026-05-08",)], "d string", tm.available_at(F.col("d").cast("date")).cast("string"))
    assert at == ["2026-05-08 07:00:00"]
    flags = values(spark, [("2026-05-14",), ("2026-05-07",), ("2026-05-15",)], "d string", tm.expiration_flag(F.col("d").cast("date")))
    assert flags == [True, False, False]


@pytest.mark.parametrize("row, plain, sourced", [
    ((0.0, 10.0, 1000.0, "KIS"), False, False), ((100.0, 10.0, 1000.0, "KIS"), True, True), ((100.0, 10.0, 1000.0, None), True, False), ((232500.0, 0.0, 0.0, "KIS"), False, False),
])
def test_valid_row(spark, row, plain, sourced):
    df = spark.createDataFrame([row], "close_price double, volume double, trading_value double, source string")
    got = df.select(px.valid_row().alias("a"), px.valid_row(True).alias("b")).first()
    assert (got["a"], got["b"]) == (plain, sourced)


def test_source_priority_opposite_ties(spark, collect):
    schema = "symbol string, base_date string, source string, close_price double, available_at string"
    df = spark.createDataFrame([
        ("1", "2026-05-08", "KIS", 100.0, "1"), ("1", "2026-05-08", "KIS_DETAIL", 101.0, "1"), ("1", "2026-05-08", "KIS_DETAIL", 102.0, "2"), ("1", "2026-05-08", None, 99.0, "9"),
    ], schema)
    assert collect(px.best_source(df), "close_price") == [(102.0,)]
    assert collect(px.best_source(df, latest_first=False), "close_price") == [(101.0,)]
