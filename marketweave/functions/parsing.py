"""Text to number, date and first-present rules as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def blank_to_null(col: Column, *also: str) -> Column:
    """Null for null, ``''`` and the extra markers."""
    text = col.cast("string")
    return F.when(~text.isin("", *also), text)


# the whole text if it is a number; each rule below names its input once, since Spark evaluates it as often as it is named
_NUMBER = r"(?s)^(?=[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$).*"


def parse_nullable(col: Column) -> Column:
    """Number with thousands separators; blank, ``-`` and junk give null."""
    text = F.btrim(F.replace(col.cast("string"), F.lit(","), F.lit("")))
    return F.get(F.regexp_extract_all(text, F.lit(_NUMBER), F.lit(0)), F.lit(0)).try_cast("double")


def parse_int_nullable(col: Column) -> Column:
    """As :func:`parse_nullable`, truncated toward zero; null beyond 64 bits."""
    return parse_nullable(col).try_cast("long")


def parse_zero(col: Column) -> Column:
    return F.coalesce(parse_nullable(col), F.lit(0.0))


def parse_int_zero(col: Column) -> Column:
    return F.coalesce(parse_int_nullable(col), F.lit(0).cast("long"))


def parse_date_any(col: Column, fallback: Column | None = None) -> Column:
    """ISO prefix, or the first eight digits of any text; else null or ``fallback``."""
    # an ISO prefix keeps its eight places, of which one that is no digit leaves too few
    flat = F.regexp_replace(F.btrim(col.cast("string")), r"^(.{4})-(.{2})-((?s:.{2}))(?s:.*)$", "$1$2$3")
    digits = F.regexp_replace(flat, "[^0-9]", "")
    parsed = F.regexp_replace(digits, "^(?:(....)(..)(..))?.*$", "$1-$2-$3").try_cast("date")
    return parsed if fallback is None else F.coalesce(parsed, fallback)


def parse_ymd(col: Column) -> Column:
    """``YYYYMMDD`` to date; blank gives null."""
    return F.try_to_date(blank_to_null(col), "yyyyMMdd")


def parse_cycle_date(period: Column, cycle: Column) -> Column:
    """First day of a period written by cycle: D/DD ``YYYYMMDD``, M ``YYYYMM``, Q ``YYYYQn``, A ``YYYY``."""
    text, kind = F.btrim(period), F.upper(cycle)
    year = F.substring(text, 1, 4)
    quarter_month = (F.substring(text, -1, 1).try_cast("int") - 1) * 3 + 1
    return (
        F.when(kind.isin("D", "DD"), F.try_to_date(text, "yyyyMMdd"))
        .when(kind == "M", F.try_to_date(F.concat(text, F.lit("01")), "yyyyMMdd"))
        .when(kind == "Q", F.try_to_date(F.concat(year, F.lpad(quarter_month.cast("string"), 2, "0"), F.lit("01")), "yyyyMMdd"))
        .when(kind == "A", F.try_to_date(F.concat(year, F.lit("0101")), "yyyyMMdd"))
    )


def first_present(*cols: Column, default: Column | None = None) -> Column:
    """First candidate that is neither null nor empty."""
    picks = [blank_to_null(c) for c in cols]
    return F.coalesce(*picks, *([] if default is None else [default.cast("string")]))
