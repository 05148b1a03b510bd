"""Market, asset-type and name rules as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Market codes, name markers and weights of the market-data domain.
STOCK_MARKETS = ("KOSPI", "KOSDAQ")
ETP_MARKETS = ("ETF", "ETN")
MASTER_MARKETS = STOCK_MARKETS + ETP_MARKETS
KOSPI_ALIASES = ("J", "STOCK", "KS", "KSE")
KOSDAQ_ALIASES = ("Q", "KQ")
ETF_NAME_PREFIXES = ("KODEX", "TIGER", "RISE", "ACE", "SOL", "HANARO", "KOSEF", "TIMEFOLIO")
NON_COMMON_MARKERS = ("ETF", "ETN", "SPAC", "REIT", "PREFERRED", "1우", "2우", "3우", "우B", "우C")
SOURCE_ORDER = ("KIS_DETAIL", "KIS", "KRX", "VALID_PRICE_FALLBACK")


def _upper(col: Column) -> Column:
    return F.upper(F.btrim(col.cast("string")))


def standard_market(col: Column, unknown: Column | None = None) -> Column:
    """Market aliases to one spelling; unknown text gives null, or ``unknown`` when passed."""
    text = _upper(col)
    known = (
        F.when(text.isin(*MASTER_MARKETS, "KOSPI200"), text)
        .when(text.isin(*KOSPI_ALIASES), F.lit("KOSPI"))
        .when(text.isin(*KOSDAQ_ALIASES), F.lit("KOSDAQ"))
        .when(text == "T", F.lit("ETF"))
    )
    return known if unknown is None else F.coalesce(known, F.when(text != "", unknown))


def market_label(col: Column) -> Column:
    """Exchange label that merely contains a market name."""
    text = F.coalesce(_upper(col), F.lit(""))
    out = text
    for name in ("KONEX", "ETF", "KOSDAQ", "KOSPI"):
        out = F.when(text.contains(name), F.lit(name)).otherwise(out)
    return out


def is_etf_name(name: Column) -> Column:
    text = F.coalesce(_upper(name), F.lit(""))
    prefixed = text.rlike("^(" + "|".join(ETF_NAME_PREFIXES) + "|PLUS )")
    return ~text.contains("ETN") & (prefixed | text.contains(" ETF") | (text == "ETF"))


def market_from_name(name: Column) -> Column:
    return F.when(F.upper(name).contains("ETN"), F.lit("ETN")).when(is_etf_name(name), F.lit("ETF"))


def listing_market(market: Column, name: Column) -> Column:
    """Market of a listed product: its name decides for ETF/ETN, then the alias table."""
    text = _upper(market)
    alias = (
        F.when(text.isin(*MASTER_MARKETS), text)
        .when(text.isin(*KOSPI_ALIASES), F.lit("KOSPI"))
        .when(text.isin(*KOSDAQ_ALIASES, "KOSDAQ GLOBAL"), F.lit("KOSDAQ"))
    )
    return F.coalesce(market_from_name(name), alias)


def asset_type_of(market: Column, name: Column) -> Column:
    resolved = listing_market(market, name)
    return F.when(resolved.isin(*ETP_MARKETS), resolved).otherwise(F.lit("STOCK"))


def is_common_stock(name: Column) -> Column:
    text = F.coalesce(F.upper(name), F.lit(""))
    marked = text.rlike("|".join(NON_COMMON_MARKERS))
    return (text == "") | (market_from_name(name).isNull() & ~marked)


def prefer_standard(old: Column, fresh: Column) -> Column:
    """Of two standard markets: ETF/ETN from either side wins, then the old one, then the fresh one."""
    etp = lambda col: F.when(col.isin(*ETP_MARKETS), col)
    return F.coalesce(etp(old), etp(fresh), old, fresh)


def prefer_market(existing: Column, new: Column) -> Column:
    """As :func:`prefer_standard` for markets in any spelling."""
    blank = F.lit("")
    return prefer_standard(listing_market(existing, blank), listing_market(new, blank))


def source_priority(source: Column) -> Column:
    """0 is best; a source outside the known order ranks last."""
    text = _upper(F.coalesce(source, F.lit("UNKNOWN")))
    out = F.lit(len(SOURCE_ORDER))
    for rank, name in reversed(list(enumerate(SOURCE_ORDER))):
        out = F.when(text == name, F.lit(rank)).otherwise(out)
    return out
