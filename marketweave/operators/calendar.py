"""Trading calendar: one row per exchange and date, and what follows from it.

A calendar has at most (days x exchanges) rows whatever the size of the price
tables, so it may be broadcast and may be windowed by exchange.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.times import is_weekday

# Exchange time zones and session hours.
SESSIONS = {"XKRX": ("Asia/Seoul", "09:00:00", "15:30:00"), "XNYS": ("America/New_York", "09:30:00", "16:00:00")}
FALLBACK_NAMES = {"XKRX": "KRX", "XNYS": "US", "XNAS": "US"}


def spine(date_range: DataFrame, column: str = "calendar_date") -> DataFrame:
    """Every date of a one-row (first_day, last_day) frame."""
    return date_range.select(F.explode(F.sequence("first_day", "last_day")).alias(column))


def _session(exchange: Column, day: Column, which: int) -> Column:
    out = F.lit(None).cast("timestamp")
    for code, session in SESSIONS.items():
        wall = F.concat(day.cast("string"), F.lit(f" {session[which]}")).cast("timestamp")
        out = F.when(exchange == code, F.to_utc_timestamp(wall, session[0])).otherwise(out)
    return out


def build(date_range: DataFrame, schedule: DataFrame, exchanges: list[str]) -> DataFrame:
    """Status of every date: open when scheduled, else weekend or holiday."""
    days = spine(date_range).withColumn("exchange_code", F.explode(F.array(*[F.lit(e) for e in exchanges])))
    listed = schedule.select("calendar_date", "exchange_code", F.lit(True).alias("listed"))
    day, code, is_open = F.col("calendar_date"), F.col("exchange_code"), F.col("listed").isNotNull()
    zone = F.lit(None).cast("string")
    for name, session in SESSIONS.items():
        zone = F.when(code == name, F.lit(session[0])).otherwise(zone)
    return days.join(listed, ["calendar_date", "exchange_code"], "left").select(
        "calendar_date",
        "exchange_code",
        is_open.alias("is_open"),
        F.when(is_open, _session(code, day, 1)).alias("open_time"),
        F.when(is_open, _session(code, day, 2)).alias("close_time"),
        F.coalesce(zone, F.lit("UTC")).alias("timezone"),
        F.when(is_open, "trading_day").when(is_weekday(day), "holiday").otherwise("weekend").alias("reason"),
        F.lit("schedule").alias("source"),
    )


def apply_overrides(calendar: DataFrame, overrides: DataFrame) -> DataFrame:
    """Manual rows replace status, reason and source; a closed day has no session times."""
    manual = overrides.select(
        "calendar_date", "exchange_code",
        F.col("is_open").alias("m_open"), F.col("reason").alias("m_reason"), F.lit(True).alias("manual"),
    )
    day, code, hit = F.col("calendar_date"), F.col("exchange_code"), F.col("manual").isNotNull()
    is_open = F.coalesce("m_open", "is_open")
    return calendar.join(F.broadcast(manual), ["calendar_date", "exchange_code"], "left").select(
        "calendar_date",
        "exchange_code",
        is_open.alias("is_open"),
        F.when(is_open, F.when(hit, _session(code, day, 1)).otherwise(F.col("open_time"))).alias("open_time"),
        F.when(is_open, F.when(hit, _session(code, day, 2)).otherwise(F.col("close_time"))).alias("close_time"),
        "timezone",
        F.coalesce("m_reason", "reason").alias("reason"),
        F.when(hit, "manual_override").otherwise(F.col("source")).alias("source"),
    )


def open_days(calendar: DataFrame, exchange: str = "XKRX") -> DataFrame:
    return calendar.where((F.col("exchange_code") == exchange) & F.col("is_open")).select(
        F.col("calendar_date").alias("base_date")
    )


def summary(calendar: DataFrame) -> DataFrame:
    day, is_open = F.col("calendar_date"), F.col("is_open")
    manual = F.when(F.col("source") == "manual_override", day.cast("string"))
    return calendar.groupBy("exchange_code").agg(
        F.count(F.lit(1)).alias("total_days"),
        F.count_if(is_open).alias("open_days"),
        F.count_if(~is_open).alias("closed_days"),
        F.count_if(F.col("reason") == "weekend").alias("weekend_days"),
        F.count_if(F.col("reason") == "holiday").alias("weekday_holidays"),
        F.min(F.when(is_open, day)).alias("first_open_day"),
        F.max(F.when(is_open, day)).alias("last_open_day"),
        F.count(manual).alias("override_count"),
        F.array_join(F.array_sort(F.collect_list(manual)), ",").alias("override_dates"),
    )


def diagnostic(days: DataFrame, calendar: DataFrame, exchange: str = "XKRX") -> DataFrame:
    """Calendar status of each wanted date; Monday to Friday is assumed where no row exists."""
    rows = calendar.where(F.col("exchange_code") == exchange).drop("exchange_code")
    missing, weekday = F.col("is_open").isNull(), is_weekday(F.col("calendar_date"))
    guess = F.when(weekday, "weekday_fallback_open").otherwise("weekday_fallback_closed")
    return days.join(rows, "calendar_date", "left").select(
        "calendar_date",
        F.lit(exchange).alias("exchange_code"),
        F.coalesce("is_open", weekday).alias("is_open"),
        F.when(missing, guess).otherwise(F.col("reason")).alias("reason"),
        "source",
        missing.alias("calendar_fallback_used"),
    )


def neighbours(status: DataFrame) -> DataFrame:
    """Previous, next and latest-on-or-before open day of every date of one gap-free status frame."""
    by_day = Window.partitionBy("exchange_code").orderBy("calendar_date")
    hit = F.when(F.col("is_open"), F.col("calendar_date"))
    before = F.last(hit, ignorenulls=True).over(by_day.rowsBetween(Window.unboundedPreceding, -1))
    upto = F.last(hit, ignorenulls=True).over(by_day.rowsBetween(Window.unboundedPreceding, 0))
    after = F.first(hit, ignorenulls=True).over(by_day.rowsBetween(1, Window.unboundedFollowing))
    return status.select(
        "calendar_date", "exchange_code",
        before.alias("previous_open_day"), after.alias("next_open_day"), upto.alias("latest_open_day"),
    )


def between(calendar: DataFrame, start, end, exchange: str = "XKRX") -> DataFrame:
    """Open days of a range; weekdays only when the exchange has no row at all in it."""
    rows = calendar.where((F.col("exchange_code") == exchange) & F.col("calendar_date").between(F.lit(start), F.lit(end)))
    known = rows.where("is_open").select("calendar_date")
    days = calendar.sparkSession.range(1).select(
        F.explode(F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"))).alias("calendar_date")
    )
    blind = rows.agg(F.count(F.lit(1)).alias("n"))
    fallback = days.where(is_weekday(F.col("calendar_date"))).where(blind.scalar() == 0)
    return known.unionByName(fallback)


def gate(status: DataFrame) -> DataFrame:
    """Skip decision and its reason text per (exchange, date)."""
    code, day = F.col("exchange_code"), F.col("calendar_date").cast("string")
    tail = F.concat_ws(" ", code, day, F.coalesce("reason", F.lit("holiday")), F.concat(F.lit("source="), F.coalesce("source", F.lit("None"))))
    return status.select(
        "calendar_date",
        "exchange_code",
        (~F.col("is_open")).alias("skip"),
        F.when(F.col("calendar_fallback_used") & F.col("is_open"), "MARKET_OPEN")
        .when(F.col("calendar_fallback_used"), F.concat(F.lit("MARKET_CLOSED: "), F.concat_ws(" ", code, day, F.lit("weekday_fallback"))))
        .when(F.col("is_open"), F.concat(F.lit("MARKET_OPEN: "), tail))
        .otherwise(F.concat(F.lit("MARKET_CLOSED: "), tail)).alias("gate_reason"),
    )


def open_day_index(calendar: DataFrame, exchange: str = "XKRX") -> DataFrame:
    """Running number of open days up to and including each calendar date."""
    by_day = Window.partitionBy("exchange_code").orderBy("calendar_date")
    return calendar.where(F.col("exchange_code") == exchange).select(
        "calendar_date",
        F.col("is_open").alias("day_is_open"),
        F.sum(F.col("is_open").cast("int")).over(by_day).alias("open_index"),
    )


def stale_days(latest: DataFrame, calendar: DataFrame, target, exchange: str = "XKRX") -> DataFrame:
    """Open days in [latest_date, target] minus 1, floor 0; -1 when the latest date is ahead of the target."""
    index = open_day_index(calendar, exchange)
    goal = F.lit(target).cast("date")
    at_target = index.where(F.col("calendar_date") <= goal).agg(F.max("open_index").alias("n"))
    opened = index.select(
        F.col("calendar_date").alias("latest_date"),
        (F.col("open_index") - F.col("day_is_open").cast("int")).alias("before_latest"),
    )
    span = at_target.scalar() - F.col("before_latest")
    return latest.join(F.broadcast(opened), "latest_date", "left").select(
        *latest.columns,
        F.when(F.col("latest_date") > goal, -1).otherwise(F.greatest(span - 1, F.lit(0))).cast("long").alias("stale_days"),
    )


def last_n_window(calendar: DataFrame, target, n: int, exchange: str = "XKRX") -> DataFrame:
    """First and last of the newest ``n`` open days on or before the target."""
    days = open_days(calendar, exchange).where(F.col("base_date") <= F.lit(target).cast("date"))
    return days.orderBy(F.desc("base_date")).limit(n).agg(
        F.min("base_date").alias("start_date"), F.max("base_date").alias("end_date"), F.count(F.lit(1)).alias("open_days")
    )
