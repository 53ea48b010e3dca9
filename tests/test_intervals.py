"""Interval joins against counting, their plan, and the streaming form over restarts."""

import random

from instants import at
from pyspark.sql import functions as F

from gaugeworks.functions.stats import count, maximum, mean
from gaugeworks.operators import alerts, intervals
from gaugeworks.sources import lake
from gaugeworks.streaming import jobs, members

EVENTS, WINDOWS = "city_id STRING, poll_timestamp TIMESTAMP, n INT", "city_id STRING, detected_at TIMESTAMP, w INT"


def sides(seed):
    rng = random.Random(seed)
    events = [(rng.choice("ab"), at(rng.randrange(100), rng.choice([0, 0, 7]), rng.choice([0, 1])), n) for n in range(120)]
    windows = [(rng.choice("abc"), at(rng.randrange(120), rng.choice([0, 7]), rng.choice([0, 1])), w) for w in range(60)]
    return events + [(None, at(1), 500), ("a", None, 501)], windows + [(None, at(2), 500), ("a", None, 501)]


def counted(events, windows):
    size = at(15) - at(0)
    return sorted(
        (w, n) for c, t, n in events for d, e, w in windows if c and c == d and t and e and e - size < t <= e
    )


def test_contents_equal_counting(spark):
    events, windows = sides(1)
    out = intervals.contents(
        spark.createDataFrame(windows, WINDOWS), spark.createDataFrame(events, EVENTS), ["city_id"], "detected_at", "poll_timestamp", "15 minutes"
    )
    assert out.columns == ["city_id", "detected_at", "w", "poll_timestamp", "n"]
    got = sorted((r.w, r.n) for r in out.collect())
    assert got == counted(events, windows) and len(got) > 100


def test_anomalies_equal_the_linear_form(spark, readings):
    rng = random.Random(2)
    events = readings([(rng.choice("ab"), at(0, rng.randrange(9000)), rng.choice([None, rng.randrange(90) / 4]), rng.choice([None, 1, 5])) for _ in range(150)])
    one, other = intervals.anomalies_by_contents(events), alerts.anomaly_alerts(events)
    assert one.exceptAll(other).isEmpty() and other.exceptAll(one).isEmpty() and one.count() > 20


def test_plan_has_no_nested_loop(spark, readings):
    plan = intervals.anomalies_by_contents(readings([("a", at(0), 1.0, 5)]))._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "CartesianProduct" not in plan and "_bucket" in plan


def test_streams_over_restarts(spark, folder):
    events, windows = sides(3)
    events = [r for r in events if r[1]]
    dated = lambda rows, low, high: [r for r in rows if r[1] is not None and at(low) <= r[1] < at(high)]
    for low, high in ((0, 50), (50, 200)):
        spark.createDataFrame(dated(events, low, high), EVENTS).write.mode("append").parquet(folder("e"))
        spark.createDataFrame(dated(windows, low, high), WINDOWS).write.mode("append").parquet(folder("w"))
        pairs = intervals.stream_contents(
            lake.folder_stream(spark, folder("w"), WINDOWS), lake.folder_stream(spark, folder("e"), EVENTS),
            ["city_id"], "detected_at", "poll_timestamp", "15 minutes",
        )
        query = jobs.start(pairs, folder("c"), state_partitions=2, fmt="parquet", path=folder("out"))
        query.awaitTermination()
        assert query.exception() is None
    got = spark.read.schema("w INT, n INT").parquet(folder("out")).select(F.col("w"), F.col("n"))
    assert sorted(map(tuple, got.collect())) == counted(events, windows)


def test_statistics_equal_those_of_the_listed_pairs(spark):
    events, windows = sides(4)
    windows = spark.createDataFrame(windows + windows[:5], WINDOWS)
    events = spark.createDataFrame(events + events[:9], EVENTS)
    named = (["city_id"], "detected_at", "poll_timestamp", "15 minutes")
    stats = [count("held"), maximum("n", "most"), mean("n", "middle")]
    listed = intervals.contents(windows.select("city_id", "detected_at").distinct(), events, *named)
    wanted = listed.groupBy("city_id", "detected_at").agg(*[s.aggregate() for s in stats])
    got = intervals.contents(windows, events, *named, stats)
    assert got.columns == wanted.columns and got.count() > 20
    assert got.exceptAll(wanted).isEmpty() and wanted.exceptAll(got).isEmpty()


def test_no_pair_is_made_for_statistics(spark, readings):
    """Twice the events in as much time are twice the rows anywhere in the plan, not four times the pairs."""
    plan = intervals.anomalies_by_contents(readings([("a", at(0), 1.0, 5)]))._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan


def test_statistics_of_streams_over_restarts(spark, folder):
    """Windows ahead of their events, events ahead of their windows, a window sent again, and a batch run twice."""
    events, windows = sides(5)
    named, stats = (("city_id",), "detected_at", "poll_timestamp", "15 minutes"), (count("held"), maximum("n", "most"))
    handler = members.WindowContents(folder("out"), folder("memory"), *named, stats)
    cut = lambda rows, low, high: [r for r in rows if r[1] is not None and at(low) <= r[1] < at(high)]
    sent = [(cut(events, 0, 40), cut(windows, 0, 55)), (cut(events, 40, 75), cut(windows, 55, 70)[:1] + cut(windows, 50, 70)), (cut(events, 75, 200), cut(windows, 70, 200))]
    for some_events, some_windows in sent:
        spark.createDataFrame(some_events, EVENTS).write.mode("append").parquet(folder("e"))
        spark.createDataFrame(some_windows, WINDOWS).write.mode("append").parquet(folder("w"))
        both = intervals.stream_contents(
            lake.folder_stream(spark, folder("w"), WINDOWS), lake.folder_stream(spark, folder("e"), EVENTS), *named, stats=stats
        )
        twice = lambda batch, n: (handler(batch, n), handler(batch, n))
        query = jobs.start(both, folder("c"), twice)
        query.awaitTermination()
        assert query.exception() is None
    got = members.contents_table(spark, folder("out"), ["city_id"], "detected_at", stats)
    listed = intervals.contents(spark.createDataFrame(windows, WINDOWS).select("city_id", "detected_at").distinct(), spark.createDataFrame(events, EVENTS), *named)
    wanted = listed.groupBy("city_id", "detected_at").agg(*[s.aggregate() for s in stats])
    assert got.exceptAll(wanted).isEmpty() and wanted.exceptAll(got).isEmpty() and got.count() > 20
    kept = spark.read.schema(both.schema).parquet(f"{folder('memory')}/slot=0")
    assert 0 < kept.count() < 90  # of some 180 rows
