"""Index, macro and price sanity rules as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Sanity bounds of the market-data domain.
INTRADAY_BOUNDS = {
    "KOSPI": (100, 100000),
    "KOSDAQ": (50, 50000),
    "USDKRW": (500, 5000),
    "DXY": (30, 300),
    "SP500": (100, 100000),
    "NASDAQ": (500, 200000),
    "SOX": (100, 100000),
    "VIX": (1, 500),
    "WTI": (5, 1000),
    "BRENT": (5, 1000),
}
MACRO_BOUNDS = {
    "sp500": (2000, 15000),
    "nasdaq": (5000, 40000),
    "sox": (1000, 20000),
    "brent": (20, 200),
    "wti": (20, 200),
    "us10y": (0, 10),
    "us3y": (0, 10),
}
PRICE_SCALE_BOUNDS = {
    "005930": (50000, 500000),
    "000660": (200000, 3000000),
    "071050": (50000, 500000),
    "278470": (100000, 1000000),
    "058470": (50000, 500000),
}
JUMP_UP, JUMP_DOWN, JUMP_MIN_HISTORY = 1.8, 0.55, 5


def change_rate(current: Column, previous: Column) -> Column:
    """Percent change; null when either side is null or the previous value is 0."""
    return F.when(previous != 0, (current / previous - F.lit(1.0)) * F.lit(100.0))


def index_hard_invalid(value: Column) -> Column:
    v = value.cast("double")
    bad = F.isnan(v) | (v == float("inf")) | (v <= 0)
    return F.coalesce(bad, F.lit(True))


def classify_index_quality(
    value: Column,
    source_change: Column | None = None,
    previous: Column | None = None,
    secondary: Column | None = None,
    anomaly_pct: float = 20.0,
    mismatch_pct: float = 10.0,
) -> Column:
    """INVALID, then ANOMALY, then SOURCE_MISMATCH, then OK."""
    null = F.lit(None).cast("double")
    given = null if source_change is None else source_change
    prior = null if previous is None else F.when(previous > 0, previous)
    other = null if secondary is None else F.when(secondary > 0, secondary)
    move = F.coalesce(given, change_rate(value, prior))
    gap = F.abs(value / other - F.lit(1.0)) * F.lit(100.0)
    return (
        F.when(index_hard_invalid(value), F.lit("INVALID"))
        .when(F.abs(move) > anomaly_pct, F.lit("ANOMALY"))
        .when(gap > mismatch_pct, F.lit("SOURCE_MISMATCH"))
        .otherwise(F.lit("OK"))
    )


def _bounds_case(key: Column, bounds: dict, side: int) -> Column:
    out = F.lit(None).cast("double")
    for name, pair in bounds.items():
        out = F.when(key == name, F.lit(float(pair[side]))).otherwise(out)
    return out


def intraday_out_of_bounds(series: Column, value: Column, bounds: dict | None = None) -> Column:
    table = bounds or INTRADAY_BOUNDS
    low, high = _bounds_case(series, table, 0), _bounds_case(series, table, 1)
    return index_hard_invalid(value) | F.coalesce(~value.between(low, high), F.lit(False))


def macro_suspicious(fields: dict[str, Column], bounds: dict | None = None) -> Column:
    """Sorted-by-definition array of the macro fields outside their range."""
    table = bounds or MACRO_BOUNDS
    hits = [
        F.when(~col.between(*table[name]), F.lit(name))
        for name, col in fields.items()
        if name in table
    ]
    return F.array_compact(F.array(*hits))


def price_scale_warning(symbol: Column, close: Column, bounds: dict | None = None) -> Column:
    table = bounds or PRICE_SCALE_BOUNDS
    low, high = _bounds_case(symbol, table, 0), _bounds_case(symbol, table, 1)
    return F.coalesce((close != 0) & ~close.between(low, high), F.lit(False))
