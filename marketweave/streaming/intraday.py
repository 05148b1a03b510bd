"""Structured Streaming jobs for intraday snapshots and news.

Bars are merged into a stored table by key (``sink.py``), without state, so that
late corrections count. The other jobs have state bounded by the watermark;
each of their batches is written under its own batch id, so a batch that runs
again after a failure overwrites itself, and readers take the last batch per key.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..functions.sanity import classify_index_quality, intraday_out_of_bounds
from ..operators.normalize import published_at
from ..session import landing_dir, shared_dir
from ..sources import tables as tb
from ..sources.tables import dedupe_last
from .sink import KeyedSink

INTRADAY_DELAY = "2 hours"
NEWS_DELAY = "12 hours"
STALE_GAP = "90 minutes"
# The series that the broker quotes, and the sources in the order that wins.
BROKER_SERIES = ("KOSPI", "KOSDAQ")
SOURCES = ("KIS", "YAHOO", "FALLBACK_DAILY")


def read_files(spark: SparkSession, folder: str, name: str, schema: T.StructType, files_per_batch: int = 50) -> DataFrame:
    """New parquet files of a folder, a bounded number per batch."""
    return spark.readStream.schema(schema).option("pathGlobFilter", name).option("maxFilesPerTrigger", files_per_batch).parquet(folder)


def _last_of(source: str, *order: str) -> Column:
    """Value and change rate of a source's last bar that has a value."""
    given = (F.col("source") == source) & F.col("value").isNotNull()
    return F.max_by(F.struct("value", "change_rate"), F.when(given, F.struct(*order))).alias(source)


def _record() -> dict[str, Column]:
    """The record of a series from the last bar of each source: the broker's, else Yahoo's, else the daily one.

    The broker's value is held against Yahoo's. A Yahoo value stands in for a series
    that the broker quotes, and is judged by its own change for the others. A value
    out of bounds is taken out and kept as a detail.
    """
    kis, yahoo, daily = (F.col(s) for s in SOURCES)
    picked = F.coalesce(kis, yahoo, daily)
    source = F.when(kis.isNotNull(), SOURCES[0]).when(yahoo.isNotNull(), SOURCES[1]).otherwise(SOURCES[2])
    bad = intraday_out_of_bounds(F.col("series_id"), picked["value"])
    other = F.when(kis.isNotNull(), F.coalesce(yahoo, daily)["value"])
    judged = classify_index_quality(picked["value"], picked["change_rate"], secondary=other)
    stands_in = F.col("series_id").isin(*BROKER_SERIES)
    flag = F.when(bad, "INVALID").when(kis.isNotNull(), judged).when(yahoo.isNull(), SOURCES[2]).when(stands_in, "FALLBACK_YAHOO").otherwise(judged)
    detail = F.struct(other.alias("yahoo_fallback_val"), F.when(bad, picked["value"]).alias("raw_value"))
    return {
        "source": source, "value": F.when(~bad, picked["value"]), "change_rate": F.when(~bad, picked["change_rate"]),
        "quality_flag": flag, "quality_detail": F.to_json(detail),
    }


def ingest(bars: DataFrame) -> DataFrame:
    """One record per (observed_at, series_id) from bars (observed_at, series_id, source, value, change_rate, seq).

    The last bar of a source by ``seq`` wins, so a correction within the watermark
    replaces what was there; run it in update mode. Older repairs are left to the batch upsert.
    """
    held = bars.withWatermark("observed_at", INTRADAY_DELAY).groupBy("observed_at", "series_id").agg(*[_last_of(s, "seq") for s in SOURCES])
    return held.select("observed_at", "series_id", *[c.alias(n) for n, c in _record().items()])


def resolve(bars: DataFrame, width: str = "10 minutes") -> DataFrame:
    """The record of each series and tumbling window, from the newest bar of each source.

    The aggregate is partial before the shuffle, so a busy series sends one row per task and window.
    """
    newest = [_last_of(s, "observed_at", "seq") for s in SOURCES]
    windows = bars.withWatermark("observed_at", INTRADAY_DELAY).groupBy(F.window("observed_at", width).alias("w"), "series_id").agg(*newest, F.count(F.lit(1)).alias("bars"))
    return windows.select(F.col("w.start").alias("window_start"), "series_id", *[c.alias(n) for n, c in _record().items()], "bars")


BARS = T.StructType([
    T.StructField("observed_at", T.TimestampType()), T.StructField("base_date", T.DateType()), T.StructField("series_id", T.StringType()), T.StructField("source", T.StringType()),
    T.StructField("value", T.DoubleType()), T.StructField("change_rate", T.DoubleType()), T.StructField("seq", T.LongType()),
])


def bar_sink(spark: SparkSession, root: str, every: int = 20) -> KeyedSink:
    """The stored bars, one for each (observed_at, series_id, source): the last one by ``seq`` that has a value, if any has."""
    return KeyedSink(spark, root, BARS, ["observed_at", "series_id", "source"], [F.col("value").isNull().asc(), F.desc("seq")], every=every)


def merge_bars(bars: DataFrame, sink: KeyedSink, checkpoint: str) -> None:
    """Merge what has arrived into the stored bars and stop. ``ingest`` of ``sink.read()`` gives their records."""
    dated = bars.withColumn("base_date", F.to_date("observed_at"))
    query = dated.writeStream.foreachBatch(sink.write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def stale_alarms(bars: DataFrame, clock: DataFrame | None = None) -> DataFrame:
    """Instants at which a series had been silent for the stale gap: the ends of its sessions.

    ``clock`` is a stream of instants (``tick``), such as a rate source's. It moves the
    watermark as bars do, so a session also ends when no series sends anything any more.
    """
    named = bars.select("observed_at", "series_id", F.lit(1).alias("bar"))
    if clock is not None:
        named = named.unionByName(clock.select(F.col("tick").cast("timestamp").alias("observed_at"), F.lit(None).cast("string").alias("series_id"), F.lit(None).cast("int").alias("bar")))
    sessions = named.withWatermark("observed_at", INTRADAY_DELAY).groupBy(F.session_window("observed_at", STALE_GAP).alias("s"), "series_id").agg(F.count("bar").alias("bars"))
    # the clock's own session goes only here: a filter on its rows would move below the watermark
    return sessions.where("bars > 0").select("series_id", F.col("s.start").alias("first_observed_at"), F.col("s.end").alias("alarm_at"), "bars")


def silent_series(bars: DataFrame, expected: DataFrame, now: Column, gap: str = STALE_GAP, days: int = 7) -> DataFrame:
    """The expected series without a bar in the gap before ``now``, with their last bar of the days before; those that never sent have none.

    Only the days looked at are read. A bar of the future is no bar yet.
    """
    recent = bars.where((F.col("base_date") >= F.date_sub(F.to_date(now), days)) & (F.col("observed_at") <= now))
    last = recent.groupBy("series_id").agg(F.max("observed_at").alias("last_observed_at"))
    held = expected.select("series_id").distinct().join(last, "series_id", "left")
    silent = F.col("last_observed_at").isNull() | (F.col("last_observed_at") + F.expr(f"INTERVAL {gap}") < now)
    return held.where(silent).select("series_id", "last_observed_at", now.alias("noticed_at"), F.floor((F.unix_seconds(now) - F.unix_seconds("last_observed_at")) / 60).cast("long").alias("stale_minutes"))


ALARMS = T.StructType([
    T.StructField("series_id", T.StringType()), T.StructField("last_observed_at", T.TimestampType()), T.StructField("noticed_at", T.TimestampType()), T.StructField("stale_minutes", T.LongType()),
    T.StructField("alarm_day", T.DateType()),
])


def alarm_on_ticks(clock: DataFrame, sink: KeyedSink, expected: DataFrame, path: str, checkpoint: str, days: int = 7) -> None:
    """At every tick that has arrived: alarms of series that are silent by then, one for each silence, however many ticks find it.

    Nothing need arrive but the clock. Ticks are handled in order; one that is handled again finds its alarms there.
    """
    spark = clock.sparkSession

    def at_ticks(batch: DataFrame, batch_id: int) -> None:
        for (tick,) in batch.select(F.col("tick").cast("timestamp")).distinct().orderBy("tick").collect():  # the clock's instants, a few for each batch
            sink.refresh()
            recent = sink.read(F.col("base_date") >= F.date_sub(F.to_date(F.lit(tick)), days))
            found = silent_series(recent, expected, F.lit(tick), days=days).withColumn("alarm_day", F.to_date(F.coalesce("last_observed_at", F.lit("1970-01-01").cast("timestamp"))))
            known = tb.read(spark, path, ALARMS).select("series_id", "last_observed_at")
            again = found["series_id"].eqNullSafe(known["series_id"]) & found["last_observed_at"].eqNullSafe(known["last_observed_at"])
            found.join(known, again, "left_anti").write.mode("append").partitionBy("alarm_day").parquet(path)

    query = clock.writeStream.foreachBatch(at_ticks).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def fresh_news(news: DataFrame, now) -> DataFrame:
    """News published within twelve hours before ``now``, one row per item."""
    dated = news.withColumn("published_at", published_at(F.col("pub_date"))).where(F.col("published_at").isNotNull())
    unique = dated.withWatermark("published_at", NEWS_DELAY).dropDuplicatesWithinWatermark(["event_id"])
    return unique.where(F.col("published_at") >= now - F.expr("INTERVAL 12 HOURS"))


def run_available(stream: DataFrame, mode: str = "append", path: str | None = None, checkpoint: str | None = None) -> str:
    """Process what has arrived and stop; returns the folder of the written batches."""
    spark, run = stream.sparkSession, uuid.uuid4().hex
    target = path or landing_dir(spark, "streams", run, "rows")

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{target}/batch_id={batch_id}")

    state = checkpoint or shared_dir(spark, "streams", run, "state")
    query = stream.writeStream.outputMode(mode).foreachBatch(write).option("checkpointLocation", state).trigger(availableNow=True).start()
    query.awaitTermination()
    return target


def written(spark: SparkSession, path: str, schema: T.StructType, keys: list[str]) -> DataFrame:
    """Rows of the written batches, the last batch per key."""
    with_batch = T.StructType([*schema.fields, T.StructField("batch_id", T.LongType())])
    rows = spark.read.schema(with_batch).parquet(path)
    return dedupe_last(rows, keys, [F.desc("batch_id")]).drop("batch_id")
