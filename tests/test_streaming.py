"""Streams against their batch counterparts, restarts, and cities that fall behind."""

import random

from instants import at
from pyspark.sql import functions as F

from gaugeworks.operators import alerts, windows
from gaugeworks.schemas import ALERT, BRONZE, ROLLING
from gaugeworks.sources import lake, sinks
from gaugeworks.streaming import jobs, sliding

ARRIVING = (
    "city_id STRING, poll_timestamp TIMESTAMP, temp DOUBLE, humidity INT, aqi INT, pm2_5 DOUBLE, pm10 DOUBLE, "
    "arrival_ts TIMESTAMP"
)


def arriving(spark, rows):
    """(city, time, temp, aqi, arrival) rows."""
    return spark.createDataFrame([(c, t, temp, 50, aqi, 1.0, 2.0, a) for c, t, temp, aqi, a in rows], ARRIVING)


def feed(spark, folder, parts, start_job):
    """Publishes the parts one after the other and lets the query catch up after each."""
    for part in parts:
        sinks.publish(part, folder("topic"))
        schema = part.schema
        query = start_job(lake.decode(lake.folder_stream(spark, folder("topic")), schema), folder("checkpoint"))
        query.awaitTermination()
        assert query.exception() is None


def same(a, b):
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_rolling_stream_equals_batch(spark, folder, readings):
    rng = random.Random(3)
    parts = [
        readings([(rng.choice("ab"), at(30 * n, rng.randrange(1700)), rng.randrange(300) / 4, rng.randint(1, 5)) for _ in range(40)])
        for n in range(3)
    ]
    feed(spark, folder, parts, lambda e, c: jobs.rolling_job(jobs.event_time(e), folder("t"), c, None))
    whole = parts[0].unionByName(parts[1]).unionByName(parts[2])
    got = spark.read.parquet(folder("t")).select(*ROLLING.fieldNames())
    # Events of the last five minutes before a part may be passed by the watermark only across parts.
    assert same(got, alerts.rolling_averages(whole).select(*ROLLING.fieldNames()))


def test_silent_city_loses_nothing_under_the_late_policy(spark, folder):
    quick = [("quick", at(m), 20.0, 1, at(m)) for m in range(60)]
    held_back = [("slow", at(m), 20.0, 1, at(90)) for m in range(10)]
    parts = [arriving(spark, quick), arriving(spark, held_back)]
    feed(
        spark, folder, parts, lambda e, c: jobs.rolling_job(jobs.event_time(e, arrival="arrival_ts"), folder("t"), c, None)
    )
    slow = spark.read.parquet(folder("t")).filter("city_id = 'slow'")
    assert slow.agg(F.max("observation_count")).first()[0] == 10
    assert slow.agg(F.min("window_end_time")).first()[0] == at(86)


def test_alert_stream_equals_batch(spark, folder):
    """Cities move at their own pace; each part continues from the checkpoint and the kept events."""
    rng = random.Random(1)
    rows = []
    for city, pace in (("fast", 1.0), ("slow", 0.2), ("late", 0.5)):
        for n in range(60):
            arrival = at(0, int(n * 100 * pace) + rng.randrange(30), rng.randrange(10**6))
            delay = rng.choice([0, 5, 45, 400]) if city == "late" else 0
            rows.append((city, arrival - (at(0, delay) - at(0)), rng.choice([None, rng.randrange(200) / 8]), rng.choice([None, 1, 5]), arrival))
    rows.sort(key=lambda r: r[4])
    cuts = [0, len(rows) // 4, len(rows) // 2, len(rows)]
    parts = [arriving(spark, rows[a:b]) for a, b in zip(cuts, cuts[1:])]
    handler = sliding.SlidingAlerts(folder("alerts"), folder("memory"), arrival="arrival_ts", splits=5)
    feed(spark, folder, parts, lambda e, c: sliding.alerts_job(e, handler, c, None))

    whole = windows.adjust_late(arriving(spark, rows), "poll_timestamp", "arrival_ts")
    whole = windows.adjust_out_of_order(whole, "poll_timestamp", "arrival_ts", ["city_id"])
    clock = whole.groupBy("city_id").agg(F.max("poll_timestamp").alias("clock"))
    due = alerts.anomaly_alerts(whole).join(clock, "city_id").filter("detected_at <= clock")
    want = alerts.newest_alerts(due).select(*ALERT.fieldNames())
    got = spark.read.parquet(folder("alerts")).select(*ALERT.fieldNames())
    assert want.count() > 20 and same(got, want)
    assert got.count() == got.select("id").distinct().count()


def test_alert_batch_can_run_again(spark, folder, readings):
    handler = sliding.SlidingAlerts(folder("alerts"), folder("memory"))
    batches = [readings([("a", at(0), 1.0, 5)]), readings([("a", at(3), 12.0, 1)]), readings([("b", at(1), 1.0, 5)])]
    for n, batch in enumerate(batches):
        handler(batch, n)
        handler(batch, n)
    got = {(r.city_id, r.detected_at) for r in spark.read.parquet(folder("alerts")).collect()}
    assert got == {("a", at(0)), ("a", at(3)), ("b", at(1))}


def test_alert_stream_without_arrival_moves_stragglers(spark, folder, readings):
    handler = sliding.SlidingAlerts(folder("alerts"), folder("memory"))
    handler(readings([("a", at(60), 10.0, 1)]), 0)
    handler(readings([("a", at(0), 19.0, 1)]), 1)
    got = {r.detected_at for r in spark.read.parquet(folder("alerts")).collect()}
    assert got == {at(60)}  # moved to 59:30, so both readings are in the window that ends at 60:00


def test_passthrough_keeps_every_column(spark, folder):
    event = spark.createDataFrame([("a", at(0))], "city_id STRING, poll_timestamp TIMESTAMP")
    event = event.withColumn("ingestion_date", F.to_date("poll_timestamp"))
    event = event.withColumns({f.name: F.lit(None).cast(f.dataType) for f in BRONZE.fields if f.name not in event.columns})
    sinks.publish(event, folder("topic"))
    stream = lake.decode(lake.folder_stream(spark, folder("topic")), BRONZE)
    jobs.passthrough_job(stream, folder("raw"), folder("c"), None).awaitTermination()
    landed = spark.read.text(folder("raw"))
    assert landed.count() == 1
    body = landed.first().value
    assert all(f'"{n}"' in body for n in BRONZE.fieldNames() if n != "ingestion_date")
    raw = lake.read_raw_days(spark, folder("raw"), "2024-03-01").first()
    assert (raw.city_id, raw.poll_timestamp, str(raw.ingestion_date)) == ("a", at(0), "2024-03-01")


def test_several_queries_over_one_stream(spark, folder):
    event = spark.createDataFrame([("a", at(0), 1.0, 5), ("a", at(1), 1.0, 5)], "city_id STRING, poll_timestamp TIMESTAMP, temp DOUBLE, aqi INT")
    event = event.withColumn("ingestion_date", F.to_date("poll_timestamp"))
    event = event.withColumns({f.name: F.lit(None).cast(f.dataType) for f in BRONZE.fields if f.name not in event.columns})
    sinks.publish(event, folder("topic"), in_order=True)
    records = lake.folder_stream(spark, folder("topic"))
    once = {"rolling": None, "alerts": None, "raw": None}
    running = sliding.start_all(lake.decode(records, BRONZE, keep=("key",)), folder("lake"), every=once)
    running.append(jobs.console(records.select("key"), folder("c3")))
    jobs.await_any(spark, 60)
    for query in running:
        query.awaitTermination()
        assert query.exception() is None
    spark.streams.resetTerminated()
    assert spark.read.parquet(folder("lake/alerts")).count() == 2
    assert spark.read.parquet(folder("lake/rolling")).count() == 5
    assert lake.read_raw_days(spark, folder("lake/raw"), "2024-03-01").count() == 2


def test_city_stays_in_one_partition(spark, folder, readings):
    sinks.publish(readings([(c, at(n), 1.0, 1) for c in "abcdefgh" for n in range(3)]), folder("topic"))
    per_city = spark.read.parquet(folder("topic")).groupBy("key").agg(F.count_distinct("partition").alias("n"))
    assert {r.n for r in per_city.collect()} == {1} and per_city.count() == 8
