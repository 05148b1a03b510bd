"""Stream jobs over several file batches: late rows, repeats, restarts."""

import datetime as dt
import os
import random

from pyspark.sql import functions as F

from marketweave.streaming import intraday as st

SCHEMA = "observed_at timestamp, series_id string, source string, value double, change_rate double, seq long"
T0 = dt.datetime(2026, 5, 8, 0, 0)


def at(minutes):
    return T0 + dt.timedelta(minutes=minutes)


def land(spark, folder, name, rows):
    spark.createDataFrame([r if len(r) == 6 else (*r, i) for i, r in enumerate(rows)], SCHEMA).coalesce(1).write.mode("append").parquet(f"{folder}/{name}")


def stream(spark, folder):
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"{folder}/*")


def test_ingest_corrections_and_restart(spark, tmp_path):
    folder, root, state = str(tmp_path / "in"), str(tmp_path / "bars"), str(tmp_path / "state")
    land(spark, folder, "a", [
        (at(0), "KOSPI", "KIS", 7822.24, 4.32, 1), (at(0), "KOSPI", "KIS", 7822.24, 4.32, 1), (at(0), "KOSDAQ", "KIS", 0.0, None, 2), (at(0), "KOSDAQ", "YAHOO", 900.0, None, 3),
        (at(5), "VIX", "YAHOO", 30.0, 92.0, 4), (at(6), "KOSPI", "YAHOO", 7800.0, 50.0, 5), (at(7), "KOSPI", "KIS", 7800.0, 1.0, 6), (at(7), "KOSPI", "YAHOO", 6900.0, 1.0, 7)])
    st.merge_bars(stream(spark, folder), st.bar_sink(spark, root), state)
    land(spark, folder, "b", [(at(600), "VIX", "YAHOO", 33.0, 1.0, 8)])
    st.merge_bars(stream(spark, folder), st.bar_sink(spark, root), state)
    land(spark, folder, "c", [  # ten hours late
        (at(0), "KOSPI", "KIS", 7900.0, 5.0, 10), (at(5), "VIX", "YAHOO", 31.0, 2.0, 11), (at(8), "USDKRW", "FALLBACK_DAILY", 1400.0, 1.0, 12), (at(8), "USDKRW", "KIS", None, 1.0, 13)])
    st.merge_bars(stream(spark, folder), st.bar_sink(spark, root), state)
    records = st.ingest(st.bar_sink(spark, root).read())
    rows = {(r["series_id"], r["observed_at"]): (r["source"], r["value"], r["quality_flag"], r["quality_detail"]) for r in records.collect()}
    assert rows == {
        ("KOSPI", at(0)): ("KIS", 7900.0, "OK", "{}"), ("KOSDAQ", at(0)): ("KIS", None, "INVALID", '{"yahoo_fallback_val":900.0,"raw_value":0.0}'), ("VIX", at(5)): ("YAHOO", 31.0, "OK", "{}"),
        ("KOSPI", at(6)): ("YAHOO", 7800.0, "FALLBACK_YAHOO", "{}"), ("KOSPI", at(7)): ("KIS", 7800.0, "SOURCE_MISMATCH", '{"yahoo_fallback_val":6900.0}'),
        ("USDKRW", at(8)): ("FALLBACK_DAILY", 1400.0, "FALLBACK_DAILY", "{}"), ("VIX", at(600)): ("YAHOO", 33.0, "OK", "{}"),
    }


def batch_of(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).coalesce(1).withColumn("base_date", F.to_date("observed_at"))


def held(sink):
    return sorted((r["series_id"], r["observed_at"], r["source"], r["value"], r["seq"]) for r in sink.read().collect())


def test_many_batches_and_a_restart(spark, tmp_path):
    rng, root, want, rows = random.Random(7), str(tmp_path / "bars"), {}, []
    batches = 200 if os.environ.get("CHECK_ALL") else 48
    for n in range(batches):
        for _ in range(rng.randrange(1, 4)):
            minute, series, seq = rng.randrange(0, 6000), rng.choice(["KOSPI", "VIX"]), rng.randrange(10**5)
            value = None if rng.random() < 0.1 else float(rng.randrange(1000))
            key = (series, at(minute), "KIS")
            rows.append((at(minute), series, "KIS", value, None, seq, n))
            if key not in want or (value is not None, seq) >= (want[key][0] is not None, want[key][1]):
                want[key] = (value, seq)
    landed = spark.createDataFrame(rows, SCHEMA + ", n int").withColumn("base_date", F.to_date("observed_at"))
    landed.coalesce(1).write.parquet(str(tmp_path / "landed"))
    landed = spark.read.parquet(str(tmp_path / "landed"))
    sink = st.bar_sink(spark, root, every=8)
    for n in range(batches):
        if n == 21:  # a restart that hands out the last batch again
            sink = st.bar_sink(spark, root, every=8)
            sink.write(batch_of(spark, [(at(1), "KOSPI", "KIS", -1.0, None, 10**6)]), 20)
        sink.write(landed.where(F.col("n") == n).drop("n"), n)
    assert sorted((*k, *v) for k, v in want.items()) == held(sink) == held(st.bar_sink(spark, root))
    # a read takes the table and at most every deltas, whatever the number of batches
    assert (sink.upto, sink.noted, sink.generation) == (batches - 1, [], batches // 8)
    assert [f for f in (tmp_path / "bars" / "deltas").iterdir() if not f.name.startswith(".")] == []
    assert len(list((tmp_path / "bars" / "ledger").iterdir())) == 1
    pruned = sink.read(F.col("base_date") == F.lit(T0.date()))
    assert sorted(r["observed_at"] for r in pruned.collect()) == sorted(k[1] for k in want if k[1].date() == T0.date())


def test_a_crash_after_the_merge_repeats_it(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "bars")
    sink = st.bar_sink(spark, root, every=2)
    sink.write(batch_of(spark, [(at(0), "KOSPI", "KIS", 1.0, None, 1)]), 0)
    note = sink._note

    def fail(generation, mode, upto, noted):
        if mode == "overwrite":
            raise RuntimeError("lost")
        note(generation, mode, upto, noted)

    monkeypatch.setattr(sink, "_note", fail)
    try:
        sink.write(batch_of(spark, [(at(0), "KOSPI", "KIS", 2.0, None, 2), (at(1500), "VIX", "KIS", 3.0, None, 3)]), 1)
    except RuntimeError:
        pass
    again = st.bar_sink(spark, root, every=2)
    assert (again.upto, again.noted) == (-1, [0, 1])
    want = [("KOSPI", at(0), "KIS", 2.0, 2), ("VIX", at(1500), "KIS", 3.0, 3)]
    assert held(again) == want
    again.compact()
    assert held(again) == held(st.bar_sink(spark, root)) == want and again.upto == 1


def test_a_delta_that_was_not_noted_is_written_again(spark, tmp_path):
    sink = st.bar_sink(spark, str(tmp_path / "bars"))
    batch_of(spark, [(at(0), "KOSPI", "KIS", 9.0, None, 9)]).write.parquet(sink._delta(0))  # crashed before its note
    assert held(sink) == []
    sink.write(batch_of(spark, [(at(0), "KOSPI", "KIS", 1.0, None, 1)]), 0)
    assert held(sink) == [("KOSPI", at(0), "KIS", 1.0, 1)]


def test_resolve_keeps_the_best_source_of_a_window(spark, tmp_path):
    folder = str(tmp_path / "in")
    land(spark, folder, "a", [(at(1), "KOSPI", "YAHOO", 7000.0, None), (at(2), "KOSPI", "KIS", 7800.0, None), (at(3), "USDKRW", "YAHOO", 1400.0, 0.1), (at(4), "KOSDAQ", "KIS", 1.0, None)])
    land(spark, folder, "b", [(at(9), "KOSPI", "YAHOO", 7700.0, None), (at(11), "KOSPI", "FALLBACK_DAILY", 7200.0, None)])
    out = st.resolve(stream(spark, folder))
    got = {(r["series_id"], r["window_start"]): (r["source"], r["value"], r["quality_flag"], r["bars"]) for r in st.written(spark, st.run_available(out, "update"), out.schema, ["window_start", "series_id"]).collect()}
    assert got == {
        ("KOSPI", at(0)): ("KIS", 7800.0, "OK", 3), ("KOSPI", at(10)): ("FALLBACK_DAILY", 7200.0, "FALLBACK_DAILY", 1),
        ("USDKRW", at(0)): ("YAHOO", 1400.0, "OK", 1), ("KOSDAQ", at(0)): ("KIS", None, "INVALID", 1),
    }


def test_stale_alarm_fires_after_the_gap(spark, tmp_path):
    folder = str(tmp_path / "in")
    land(spark, folder, "a", [(at(0), "KOSPI", "KIS", 1.0, None), (at(60), "KOSPI", "KIS", 1.0, None), (at(400), "VIX", "KIS", 1.0, None)])
    out = st.stale_alarms(stream(spark, folder))
    got = st.written(spark, st.run_available(out), out.schema, ["series_id", "first_observed_at"]).collect()
    assert [(r["series_id"], r["alarm_at"], r["bars"]) for r in got] == [("KOSPI", at(150), 2)]


def tick(spark, folder, name, minutes):
    spark.createDataFrame([(at(minutes),)], "tick timestamp").coalesce(1).write.parquet(f"{folder}/{name}")


def test_stale_alarm_comes_when_nothing_arrives_any_more(spark, tmp_path):
    folder, clock, out, state = (str(tmp_path / n) for n in ("in", "clock", "out", "state"))
    land(spark, folder, "a", [(at(0), "KOSPI", "KIS", 1.0, None), (at(60), "KOSPI", "KIS", 1.0, None), (at(70), "VIX", "KIS", 1.0, None)])
    tick(spark, clock, "a", 61)

    def run():
        ticks = spark.readStream.schema("tick timestamp").parquet(f"{clock}/*")
        frame = st.stale_alarms(stream(spark, folder), ticks)
        st.run_available(frame, path=out, checkpoint=state)
        return sorted((r["series_id"], r["alarm_at"], r["bars"]) for r in st.written(spark, out, frame.schema, ["series_id", "first_observed_at"]).collect())

    assert run() == []
    tick(spark, clock, "b", 271)  # only the clock goes on
    assert run() == [("KOSPI", at(150), 2)]
    tick(spark, clock, "c", 2000)
    assert run() == [("KOSPI", at(150), 2), ("VIX", at(160), 1)]


def test_ticks_alarm_once_for_each_silence(spark, tmp_path):
    folder, clock, root, alarms = (str(tmp_path / n) for n in ("in", "clock", "bars", "alarms"))
    expected = spark.createDataFrame([("KOSPI",), ("VIX",), ("GOLD",), ("VIX",)], "series_id string")
    sink = st.bar_sink(spark, root)

    def run():
        ticks = spark.readStream.schema("tick timestamp").parquet(f"{clock}/*")
        st.alarm_on_ticks(ticks, st.bar_sink(spark, root), expected, alarms, str(tmp_path / "clock_state"))
        found = spark.read.schema(st.ALARMS).parquet(alarms).collect()
        return sorted(((r["series_id"], r["last_observed_at"], r["noticed_at"], r["stale_minutes"]) for r in found), key=repr)

    sink.write(batch_of(spark, [(at(0), "KOSPI", "KIS", 1.0, None, 1), (at(30), "VIX", "KIS", 1.0, None, 2), (at(5000), "VIX", "KIS", 1.0, None, 3), (at(9), "OTHER", "KIS", 1.0, None, 4)]), 0)
    tick(spark, clock, "a", 90)
    first = [("GOLD", None, at(90), None)]
    assert run() == first  # ninety minutes to the minute are no silence yet
    tick(spark, clock, "b", 91)
    tick(spark, clock, "c", 100)
    second = first + [("KOSPI", at(0), at(91), 91)]
    assert run() == second
    sink.write(batch_of(spark, [(at(99), "KOSPI", "KIS", 2.0, None, 5)]), 1)  # it spoke again, and fell silent again
    tick(spark, clock, "d", 250)
    assert run() == sorted([*second, ("KOSPI", at(99), at(250), 151), ("VIX", at(30), at(250), 220)], key=repr)


def test_news_window(spark, tmp_path):
    folder = str(tmp_path / "in")
    rows = [(1, "Fri, 08 May 2026 08:00:00 +0900"), (2, "Thu, 07 May 2026 08:00:00 +0900"), (3, "soon"), (4, None), (1, "Fri, 08 May 2026 08:00:00 +0900")]
    spark.createDataFrame(rows, "event_id long, pub_date string").write.parquet(folder + "/a")
    news = spark.readStream.schema("event_id long, pub_date string").parquet(folder + "/*")
    out = st.fresh_news(news, F.lit("2026-05-08 00:00:00").cast("timestamp")).select("event_id", "published_at")
    got = st.written(spark, st.run_available(out), out.schema, ["event_id"]).collect()
    assert [(r["event_id"], str(r["published_at"])) for r in got] == [(1, "2026-05-07 23:00:00")]
