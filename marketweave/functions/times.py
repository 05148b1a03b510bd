"""Availability instants, KST dates and staleness as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

KST = "Asia/Seoul"


def available_at(base_date: Column, hour: int = 16, minute: int = 0) -> Column:
    """Instant of a KST wall-clock time on ``base_date``, whatever the session's zone."""
    return F.concat(base_date.cast("string"), F.lit(f" {hour:02d}:{minute:02d}:00 {KST}")).cast("timestamp")


def kst_date(instant: Column) -> Column:
    return F.to_date(F.convert_timezone(None, F.lit(KST), instant.cast("timestamp").cast("timestamp_ntz")))


def expiration_flag(day: Column) -> Column:
    """Second Thursday of a month."""
    return (F.weekday(day) == 3) & F.dayofmonth(day).between(8, 14)


def staleness_days(latest: Column, target: Column) -> Column:
    return F.datediff(target, latest)


def is_weekday(day: Column) -> Column:
    return F.weekday(day) < 5
