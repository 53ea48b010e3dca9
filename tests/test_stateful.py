"""Keyed state: order and sliding alerts against batch, over restarts; tables of changes."""

import random

import numpy as np
import pandas as pd
from instants import at
from pyspark.sql import functions as F

from gaugeworks.operators import alerts, windows
from gaugeworks.schemas import ALERT
from gaugeworks.sources import changes, lake, sinks
from gaugeworks.streaming import stateful

ARRIVING = "city_id STRING, poll_timestamp TIMESTAMP, temp DOUBLE, aqi INT, pm2_5 DOUBLE, arrival_ts TIMESTAMP"


def arriving(spark, rows):
    """(city, time, temp, aqi, arrival) rows."""
    return spark.createDataFrame([(c, t, temp, aqi, 2.0, a) for c, t, temp, aqi, a in rows], ARRIVING)


def feed(spark, folder, parts, start_job):
    for part in parts:
        sinks.publish(part, folder("topic"))
        query = start_job(lake.decode(lake.folder_stream(spark, folder("topic")), part.schema), folder("checkpoint"))
        query.awaitTermination()
        assert query.exception() is None


def same(a, b):
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def table(spark, path):
    return changes.newest(spark, path, ALERT, ["id"], [F.col("detected_at").desc()])


def cities_at_their_own_pace():
    rng = random.Random(11)
    rows = []
    for city, pace in (("fast", 1.0), ("slow", 0.2), ("late", 0.5), ("silent", 0.01)):
        for n in range(60):
            arrival = at(0, int(n * 100 * pace) + rng.randrange(30), rng.randrange(10**6))
            delay = rng.choice([0, 5, 45, 400]) if city == "late" else rng.choice([0, 0, 20])
            values = rng.choice([None, rng.randrange(200) / 8]), rng.choice([None, 1, 5])
            rows.append((city, arrival - (at(0, delay) - at(0)), *values, arrival))
    return sorted(rows, key=lambda r: r[4])


def adjusted(events):
    whole = windows.adjust_late(events, "poll_timestamp", "arrival_ts")
    return windows.adjust_out_of_order(whole, "poll_timestamp", "arrival_ts", ["city_id"])


def test_stateful_alerts_equal_batch_over_restarts(spark, folder):
    rows = cities_at_their_own_pace()
    cuts = [0, 20, len(rows) // 3, len(rows) // 2, len(rows)]
    parts = [arriving(spark, rows[a:b]) for a, b in zip(cuts, cuts[1:])]
    feed(spark, folder, parts, lambda e, c: stateful.stateful_alerts_job(e, folder("alerts"), c, "arrival_ts", None, 2))
    whole = adjusted(arriving(spark, rows))
    clock = whole.groupBy("city_id").agg(F.max("poll_timestamp").alias("clock"))
    due = alerts.anomaly_alerts(whole).join(clock, "city_id").filter("detected_at <= clock")
    want = alerts.newest_alerts(due).select(*ALERT.fieldNames())
    assert want.count() > 20 and same(table(spark, folder("alerts")), want)
    assert len(changes.batches(spark, folder("alerts"))) == len(parts)


def test_events_in_order_equal_batch_over_restarts(spark, folder):
    rows = cities_at_their_own_pace()
    parts = [arriving(spark, rows[a : a + 50]) for a in range(0, len(rows), 50)]
    feed(spark, folder, parts, lambda e, c: stateful.order_job(e, ["temp"], folder("ordered"), c, "arrival_ts", None, 2))
    columns = ["city_id", "poll_timestamp", "temp"]
    got = spark.read.schema("city_id STRING, poll_timestamp TIMESTAMP, temp DOUBLE").parquet(folder("ordered"))
    assert same(got.select(*columns), adjusted(arriving(spark, rows)).select(*columns))


def test_a_batch_gives_changed_windows_only(spark, folder):
    minutes = [("a", at(m), 20.0, 5, at(m)) for m in range(60)]
    straggler = [("a", at(58, 40), 20.0, 1, at(59, 30)), ("b", at(0), 1.0, 5, at(59, 40))]
    parts = [arriving(spark, minutes), arriving(spark, straggler)]
    feed(spark, folder, parts, lambda e, c: stateful.stateful_alerts_job(e, folder("alerts"), c, "arrival_ts", None, 2))
    second = spark.read.parquet(f"{folder('alerts')}/changes/batch=1")
    # The straggler is moved to 58:40 at the latest, within the tolerance of the clock (59:00): its own
    # instant is new, and no later window changes by it. City b starts.
    assert sorted((r.city_id, r.detected_at) for r in second.collect()) == [("a", at(58, 40)), ("b", at(54, 40))]


def test_rows_without_time_or_city_are_in_no_window(spark, folder):
    rows = [("a", at(0), 1.0, 5, at(0)), ("a", None, 1.0, 5, at(1)), (None, at(0), 1.0, 5, at(1)), ("a", at(2), None, None, None)]
    feed(spark, folder, [arriving(spark, rows)], lambda e, c: stateful.stateful_alerts_job(e, folder("t"), c, "arrival_ts", None, 1))
    assert {r.detected_at for r in table(spark, folder("t")).collect()} == {at(0), at(2)}


def test_windows_of_a_busy_city_against_counting():
    rng = np.random.default_rng(4)
    times = np.sort(rng.integers(0, 3_000, 400)).astype(np.int64)
    events = np.column_stack([times.view(np.float64), rng.integers(0, 50, (400, 3)).astype(float)])
    events[rng.random(400) < 0.3, 1] = np.nan
    swept = stateful.SlidingWindows(100, 7, 10)._swept(events, 500, 2_000)
    ends = sorted({t for t in [*times, *(times + 100)] if 500 <= t <= 2_000})
    want = []
    for t in ends:
        inside = events[(times > t - 100) & (times <= t)]
        if len(inside):
            known = inside[~np.isnan(inside[:, 1]), 1]
            want.append((t, known.max() if len(known) else None, known.min() if len(known) else None, inside[:, 2].max()))
    got = [
        (e, None if np.isnan(a) else a, None if np.isnan(b) else b, c)
        for e, a, b, c in swept[["_end", "window_max_temp", "window_min_temp", "window_max_aqi"]].to_numpy().tolist()
    ]
    assert got == [tuple(None if v is None else float(v) for v in w) for w in want]


def test_changes_are_merged_and_read_alike(spark, folder):
    path = folder("t")
    read = lambda: {(r.id, r.value) for r in changes.newest(spark, path, schema, ["id"]).collect()}
    make = lambda rows: spark.createDataFrame(rows, "id STRING, value INT").withColumn("day", F.to_date(F.lit("2024-03-01")))
    schema = make([("a", 1)]).select("id", "day", "value").schema
    assert read() == set() and changes.compact(spark, path, schema, ["id"], F.col("day")) == 0
    changes.append_changes(make([("a", 1), ("b", 1)]), path, 0)
    changes.append_changes(make([("a", 9)]), path, 1)
    changes.append_changes(make([("a", 2), ("c", 2)]), path, 1)  # the batch again
    assert read() == {("a", 2), ("b", 1), ("c", 2)}
    assert changes.compact(spark, path, schema, ["id"], F.col("day")) == 2
    assert changes.batches(spark, path) == [] and read() == {("a", 2), ("b", 1), ("c", 2)}
    changes.append_changes(make([("b", 3)]), path, 2)
    assert read() == {("a", 2), ("b", 3), ("c", 2)}


def test_a_compaction_that_was_cut_off(spark, folder, monkeypatch):
    path = folder("t")
    make = lambda rows: spark.createDataFrame(rows, "id STRING, day STRING, value INT")
    schema = make([("a", "x", 1)]).schema
    changes.append_changes(make([("a", "x", 1), ("b", "y", 1)]), path, 0)
    changes.append_changes(make([("a", "x", 2)]), path, 1)
    with monkeypatch.context() as broken:
        broken.setattr(changes, "delete", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        try:
            changes.compact(spark, path, schema, ["id"], F.col("day"))
        except RuntimeError:
            pass
    want = {("a", 2), ("b", 1)}
    assert {(r.id, r.value) for r in changes.newest(spark, path, schema, ["id"]).collect()} == want
    assert changes.compact(spark, path, schema, ["id"], F.col("day")) == 2
    assert {(r.id, r.value) for r in changes.newest(spark, path, schema, ["id"]).collect()} == want


def test_an_incomplete_batch_is_not_read(spark, folder):
    path = folder("t")
    make = lambda rows: spark.createDataFrame(rows, "id STRING, value INT")
    changes.append_changes(make([("a", 1)]), path, 0)
    make([("b", 1)]).write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(f"{path}/changes/batch=1")
    assert changes.batches(spark, path) == [0]


def test_only_what_stays_in_reach_is_stored():
    """A long batch of a key costs its state as many writes as panes stay in reach, not as it spans."""
    minute = 60_000_000
    panes, writes = {}, []

    class Panes:
        values = lambda self: panes.values()
        keys = lambda self: iter(list(panes))
        containsKey = lambda self, key: key in panes
        getValue = lambda self, key: panes[key]
        removeKey = lambda self, key: panes.pop(key)

        def updateValue(self, key, value):
            writes.append(key)
            panes[key] = value

    class Clock:
        at = None
        exists = lambda self: self.at is not None
        get = lambda self: self.at

        def update(self, value):
            self.at = value

    processor = stateful.SlidingWindows(15 * minute, minute // 2, minute)
    processor.panes, processor.clock = Panes(), Clock()
    for begin in (0, 2000 * minute):
        times = np.arange(begin, begin + 1000 * minute, minute // 2)
        rows = pd.DataFrame({"at_us": times, "arrived_us": times, "temp": 1.0, "aqi": 1.0, "pm2_5": 1.0})
        list(processor.handleInputRows(("a",), iter([rows]), None))
        reach = int(times[-1]) - minute // 2 - 15 * minute
        assert sorted(k for k, in panes) == list(range((reach + 1) // minute, int(times[-1]) // minute + 1))
        assert sum(len(v[0]) for v in panes.values()) == 4 * 8 * 2 * len(panes)
    assert len(writes) == 2 * len(panes)
