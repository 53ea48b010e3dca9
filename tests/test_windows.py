"""Window semantics on small frames, and against a brute-force count."""

import datetime as dt
import random

import pytest
from instants import at
from pyspark.sql import functions as F

from gaugeworks.functions.stats import count, maximum, mean, minimum
from gaugeworks.operators import windows
from gaugeworks.operators.alerts import AnomalyRule, anomaly_alerts, newest_alerts, rolling_averages

MINUTE = dt.timedelta(minutes=1)


def alert_rows(frame):
    return {(r.city_id, r.detected_at): r for r in frame.collect()}


def test_hopping_covers_five_windows_and_skips_nulls(spark, readings):
    rows = rolling_averages(readings([("a", at(1), 10.0, 2), ("a", at(1), None, 4)])).orderBy("window_end_time").collect()
    assert [r.window_end_time for r in rows] == [at(2), at(4), at(6), at(8), at(10)]
    assert {(r.avg_temp, r.min_temp, r.avg_aqi, r.observation_count) for r in rows} == {(10.0, 10.0, 3.0, 2)}


def test_hopping_all_null_gives_null_and_counts_rows(readings):
    row = rolling_averages(readings([("a", at(1), None, None)])).first()
    assert (row.avg_temp, row.max_temp, row.avg_aqi, row.observation_count) == (None, None, None, 1)


def test_hopping_closed_side(readings):
    events = readings([("a", at(10), 1.0, 1)])
    left = [r.window_end_time for r in rolling_averages(events).collect()]
    right = [r.window_end_time for r in rolling_averages(events, closed="right").collect()]
    assert sorted(left) == [at(m) for m in (12, 14, 16, 18, 20)]
    assert sorted(right) == [at(m) for m in (10, 12, 14, 16, 18)]


@pytest.mark.parametrize(
    "size,slide",
    [
        ("10 minutes", "2 minutes"),
        ("10 minutes", "4 minutes"),
        ("20 minutes", "2 minutes"),
        ("31 minutes", "3 minutes"),
        ("3 minutes", "5 minutes"),
    ],
)
def test_hopping_equals_native_windows(spark, readings, size, slide):
    rng = random.Random(1)
    times = [at(0, rng.randrange(7200), rng.randrange(10**6)) for _ in range(300)]
    events = readings([(rng.choice("ab"), t, rng.random(), 1) for t in times])
    stats = [minimum("temp", "lo"), maximum("temp", "hi"), count("n")]
    ours = windows.hopping(events, "poll_timestamp", size, slide, ["city_id"], stats, end="end")
    if size == "3 minutes":
        # The built-in window does not leave gaps; keep the windows that start on a slide boundary.
        start = F.unix_seconds("poll_timestamp") - F.unix_seconds("poll_timestamp") % 300
        native = (
            events.withColumn("s", start)
            .filter(F.unix_seconds("poll_timestamp") - F.col("s") < 180)
            .groupBy("city_id", "s")
            .agg(F.min("temp").alias("lo"), F.max("temp").alias("hi"), F.count("*").alias("n"))
            .select("city_id", "lo", "hi", "n", F.timestamp_seconds(F.col("s") + 180).alias("end"))
        )
    else:
        native = (
            events.groupBy("city_id", F.window("poll_timestamp", size, slide).alias("w"))
            .agg(F.min("temp").alias("lo"), F.max("temp").alias("hi"), F.count("*").alias("n"))
            .select("city_id", "lo", "hi", "n", F.col("w.end").alias("end"))
        )
    assert ours.count() > 0
    assert ours.exceptAll(native).isEmpty() and native.exceptAll(ours).isEmpty()


def test_empty_input_gives_no_windows(readings):
    nothing = readings([]).limit(0)
    assert rolling_averages(nothing).isEmpty()
    assert anomaly_alerts(nothing).isEmpty()


def test_alert_cases(readings):
    events = readings(
        [
            ("normal", at(0), 20.0, 2), ("normal", at(5), 21.0, 3),
            ("swing", at(0), 10.0, 2), ("swing", at(5), 18.1, 2),
            ("exact", at(0), 10.0, 2), ("exact", at(5), 18.0, 2),
            ("air", at(0), 20.0, 5),
            ("both", at(0), 10.0, 5), ("both", at(5), 19.0, 1),
            ("no_air", at(0), 10.0, None), ("no_air", at(5), 19.0, None),
        ]
    )
    found = alert_rows(anomaly_alerts(events))
    flags = {(c, t): (r.temperature_swing_triggered, r.aqi_threshold_triggered) for (c, t), r in found.items()}
    assert flags == {
        ("swing", at(5)): (True, False),
        ("air", at(0)): (False, True),
        ("both", at(0)): (False, True),
        ("both", at(5)): (True, True),
        ("no_air", at(5)): (True, False),
    }
    swing = found["swing", at(5)]
    assert swing.id == f"swing-{int((at(5) - dt.datetime(1970, 1, 1)).total_seconds())}"
    assert (swing.window_min_temp, swing.window_max_temp) == (10.0, 18.1)
    assert found["no_air", at(5)].window_max_aqi is None


def test_event_leaves_after_exactly_fifteen_minutes(readings):
    found = alert_rows(anomaly_alerts(readings([("a", at(0), 10.0, 1), ("a", at(15), 19.0, 1)])))
    assert found == {}
    close = alert_rows(anomaly_alerts(readings([("a", at(0, 0, 1), 10.0, 1), ("a", at(15), 19.0, 1)])))
    assert list(close) == [("a", at(15))]


def test_departure_can_raise_an_alert(readings):
    found = alert_rows(anomaly_alerts(readings([("a", at(0), 10.0, 1), ("a", at(4), 11.0, 5)])))
    assert set(found) == {("a", at(4)), ("a", at(15))}
    assert found["a", at(15)].window_min_temp == 11.0


def test_arrival_and_departure_at_one_instant_are_one_evaluation(readings):
    events = readings([("a", at(0), 10.0, 5), ("a", at(5), 11.0, 5), ("a", at(15), 30.0, 5), ("a", at(15), 30.5, 5)])
    assert [t for _, t in sorted(alert_rows(anomaly_alerts(events)))] == [at(0), at(5), at(15), at(20)]


def brute_force(rows, size=15 * MINUTE):
    out = set()
    for city in {c for c, *_ in rows}:
        own = [r for r in rows if r[0] == city]
        for t in {r[1] for r in own} | {r[1] + size for r in own}:
            inside = [r for r in own if t - size < r[1] <= t]
            if not inside:
                continue
            temps = [r[2] for r in inside if r[2] is not None]
            airs = [r[3] for r in inside if r[3] is not None]
            hi, lo = (max(temps), min(temps)) if temps else (None, None)
            out.add((city, t, hi, lo, max(airs) if airs else None, len(inside), sum(airs) if airs else None))
    return out


@pytest.mark.parametrize("splits", [1, 3, 15, 90])
def test_sliding_equals_brute_force_with_a_hot_city(readings, splits):
    rng = random.Random(splits)
    rows = []
    for _ in range(500):
        city = "hot" if rng.random() < 0.6 else rng.choice(["a", None])
        # Whole minutes make many ties, and exits that meet entries; the long gap spans several spans.
        t = at(rng.choice([rng.randrange(60), rng.randrange(1380, 1500), 60 * 24 * rng.randrange(9)]))
        if rng.random() < 0.5:
            t = t + dt.timedelta(microseconds=rng.randrange(60_000_000))
        rows.append((city, t, rng.choice([None, round(rng.uniform(0, 30), 1)]), rng.choice([None, 1, 3, 5])))
    stats = [maximum("temp", "hi"), minimum("temp", "lo"), maximum("aqi", "air"), count("n"), mean("aqi", "avg")]
    got = windows.sliding(readings(rows), "poll_timestamp", "15 minutes", ["city_id"], stats, end="at", splits=splits)
    found = {
        (r.city_id, r.at, r.hi, r.lo, r.air, r.n, None if r.avg is None else round(r.avg, 9)) for r in got.collect()
    }
    want = set()
    for city, t, hi, lo, air, n, total in brute_force(rows):
        airs = [r for r in rows if r[0] == city and t - 15 * MINUTE < r[1] <= t and r[3] is not None]
        want.add((city, t, hi, lo, air, n, round(total / len(airs), 9) if airs else None))
    assert found == want


def test_late_events_are_moved_to_the_limit(spark):
    rows = [(1, at(0), at(4, 59)), (2, at(0), at(5)), (3, at(0), at(7)), (4, at(0), None)]
    frame = spark.createDataFrame(rows, "n INT, ts TIMESTAMP, arrived TIMESTAMP")
    moved = {r.n: r.ts for r in windows.adjust_late(frame, "ts", "arrived").collect()}
    assert moved == {1: at(0), 2: at(0), 3: at(2), 4: at(0)}


def test_out_of_order_events_are_moved_to_the_limit(spark):
    rows = [
        ("a", 1, at(10), at(10)),
        ("a", 2, at(9, 31), at(10, 1)),
        ("a", 3, at(9, 29), at(10, 2)),
        ("a", 4, at(1), at(12)),
        ("b", 5, at(1), at(12)),
        ("c", 6, at(10), at(10)),
        ("c", 7, at(1), at(10)),
    ]
    frame = spark.createDataFrame(rows, "city_id STRING, n INT, ts TIMESTAMP, arrived TIMESTAMP")
    moved = windows.adjust_out_of_order(frame, "ts", "arrived", ["city_id"], into="adjusted")
    got = {r.n: r.adjusted for r in moved.collect()}
    assert got == {1: at(10), 2: at(9, 31), 3: at(9, 30), 4: at(9, 30), 5: at(1), 6: at(10), 7: at(1)}


def test_out_of_order_equals_brute_force(spark):
    rng = random.Random(5)
    rows = []
    for n in range(400):
        arrived = at(0, rng.randrange(600))
        rows.append(("hot" if rng.random() < 0.7 else None, n, arrived - dt.timedelta(seconds=rng.randrange(120)), arrived))
    frame = spark.createDataFrame(rows, "city_id STRING, n INT, ts TIMESTAMP, arrived TIMESTAMP")
    got = {r.n: r.ts for r in windows.adjust_out_of_order(frame, "ts", "arrived", ["city_id"]).collect()}
    for city, n, ts, arrived in rows:
        earlier = [r[2] for r in rows if r[0] == city and r[3] < arrived]
        limit = max(earlier) - dt.timedelta(seconds=30) if earlier else ts
        assert got[n] == max(ts, limit)


def test_newest_alert_wins_within_a_second(readings):
    alerts = anomaly_alerts(readings([("a", at(0, 0, 100), 1.0, 5), ("a", at(0, 0, 900), 2.0, 5)]))
    kept = newest_alerts(alerts).filter(F.col("detected_at") < F.lit(at(1))).collect()
    assert [(r.window_max_temp, r.detected_at) for r in kept] == [(2.0, at(0, 0, 900))]


def test_order_of_input_does_not_matter(readings):
    rng = random.Random(9)
    rows = [(rng.choice("ab"), at(0, rng.randrange(5000)), rng.uniform(0, 30), rng.randint(1, 5)) for _ in range(200)]
    shuffled = rng.sample(rows, len(rows))
    rule = AnomalyRule(swing=5.0, aqi=4)
    one, two = (anomaly_alerts(readings(r), rule=rule) for r in (rows, shuffled))
    assert one.exceptAll(two).isEmpty() and two.exceptAll(one).isEmpty() and not one.isEmpty()


def test_a_row_without_time_is_given_none(spark):
    rows = [("a", None, at(9)), ("a", at(0), at(9)), ("a", at(9), at(9))]
    events = spark.createDataFrame(rows, "city_id STRING, t TIMESTAMP, arrived TIMESTAMP")
    late = windows.adjust_late(events, "t", "arrived")
    assert sorted((r.t for r in late.collect()), key=str) == sorted([None, at(4), at(9)], key=str)
    ordered = windows.adjust_out_of_order(late, "t", "arrived", ["city_id"])
    assert sum(r.t is None for r in ordered.collect()) == 1
    assert windows.tumbling(late, "t", "1 minute", ["city_id"], [count("n")]).agg(F.sum("n")).first()[0] == 2
