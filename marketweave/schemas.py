"""Table keys and schemas of the keyed daily tables."""

from __future__ import annotations

from pyspark.sql import types as T

_S, _D, _N, _TS, _B, _L = T.StringType(), T.DateType(), T.DoubleType(), T.TimestampType(), T.BooleanType(), T.LongType()


def _struct(**fields) -> T.StructType:
    return T.StructType([T.StructField(k, v) for k, v in fields.items()])


PRICES = _struct(
    symbol=_S, base_date=_D, open_price=_N, high_price=_N, low_price=_N, close_price=_N,
    volume=_N, trading_value=_N, market_cap=_N, outstanding_shares=_N, source=_S, available_at=_TS,
)
SUPPLY = _struct(
    symbol=_S, base_date=_D, individual_net_buy=_N, institutional_net_buy=_N, foreign_net_buy=_N,
    pension_net_buy=_N, corporate_net_buy=_N, foreign_holding_ratio=_N, available_at=_TS,
)
SHORTS = _struct(symbol=_S, base_date=_D, short_volume=_N, short_value=_N, short_ratio=_N, source=_S, available_at=_TS)
FEATURES = _struct(
    symbol=_S, base_date=_D, feature_name=_S, feature_value=_N, available_at=_TS,
    data_quality_flag=_S, source_consistency_status=_S,
)
RANKINGS = _struct(
    base_date=_D, market=_S, rank_type=_S, rank=_L, symbol=_S, name=_S, volume=_N, trading_value=_N,
    market_cap=_N, change_rate=_N, metric_value=_N, source=_S, source_base_date=_D, available_at=_TS,
)
RAW_RANKINGS = _struct(
    source=_S, base_date=_D, market=_S, rank_type=_S, symbol=_S, name=_S, raw_rank=_L, raw_data=_S, available_at=_TS,
)
MASTER = _struct(symbol=_S, name=_S, market=_S, asset_type=_S, is_active=_B, updated_at=_TS)
MACRO_SERIES = _struct(series_id=_S, base_date=_D, value=_N, available_at=_TS)
CALENDAR = _struct(
    calendar_date=_D, exchange_code=_S, is_open=_B, open_time=_TS, close_time=_TS, timezone=_S, reason=_S, source=_S,
)
RUN_LOG = _struct(job_name=_S, target_date=_D, status=_S, records_processed=_L, error_message=_S)
INTRADAY = _struct(
    observed_at=_TS, base_date=_D, series_id=_S, value=_N, change_rate=_N, source=_S, quality_flag=_S, quality_detail=_S,
)

SCHEMAS = {
    "normalized_stock_prices_daily": PRICES,
    "normalized_stock_supply_daily": SUPPLY,
    "normalized_stock_short_selling": SHORTS,
    "feature_store_daily": FEATURES,
    "normalized_market_rankings_daily": RANKINGS,
    "raw_market_rankings": RAW_RANKINGS,
    "stocks_master": MASTER,
    "normalized_macro_series": MACRO_SERIES,
    "market_trading_calendar": CALENDAR,
    "pipeline_run_logs": RUN_LOG,
    "normalized_macro_intraday": INTRADAY,
}

# The columns that identify one row of each table.
KEYS = {
    "raw_stock_prices_daily": ["source", "symbol", "base_date"],
    "raw_stock_supply_daily": ["source", "symbol", "base_date"],
    "raw_stock_short_selling": ["source", "symbol", "base_date"],
    "raw_market_rankings": ["source", "base_date", "market", "rank_type", "symbol"],
    "raw_macro_series": ["source", "series_id", "base_date"],
    "raw_ecos_macro_daily": ["series_id", "date"],
    "normalized_stock_prices_daily": ["symbol", "base_date"],
    "normalized_stock_supply_daily": ["symbol", "base_date"],
    "normalized_stock_short_selling": ["symbol", "base_date"],
    "normalized_stock_snapshots_daily": ["symbol", "base_date"],
    "normalized_market_rankings_daily": ["base_date", "market", "rank_type", "rank", "symbol"],
    "normalized_stock_fundamentals": ["symbol", "base_date"],
    "normalized_stock_fundamentals_ratios": ["symbol", "base_date"],
    "normalized_stock_events_daily": ["symbol", "base_date", "event_type"],
    "normalized_macro_series": ["series_id", "base_date"],
    "normalized_macro_intraday": ["observed_at", "series_id", "source"],
    "normalized_global_macro_daily": ["base_date"],
    "market_breadth_daily": ["base_date"],
    "normalized_derivatives_daily": ["base_date"],
    "market_trading_calendar": ["calendar_date", "exchange_code"],
    "feature_store_daily": ["symbol", "base_date", "feature_name"],
    "stocks_master": ["symbol"],
    "static_stock_universe": ["symbol"],
    "macro_series_master": ["series_id"],
}

# Tables that refuse unknown columns.
STRICT_TABLES = {
    "normalized_global_macro_daily",
    "normalized_stock_prices_daily",
    "normalized_stock_supply_daily",
    "normalized_stock_short_selling",
    "normalized_macro_series",
    "feature_store_daily",
}
