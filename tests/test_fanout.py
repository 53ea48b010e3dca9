"""One read for several sinks: restarts, failures between and inside sinks, one scan of the input."""

import random

import pytest
from instants import at
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from gaugeworks.operators import alerts
from gaugeworks.schemas import BRONZE, ROLLING
from gaugeworks.sources import lake, sinks
from gaugeworks.streaming import fanout


def bronze(spark, rows):
    thin = spark.createDataFrame(rows, "city_id STRING, poll_timestamp TIMESTAMP, temp DOUBLE, aqi INT")
    thin = thin.withColumn("ingestion_date", F.to_date("poll_timestamp"))
    return thin.withColumns({f.name: F.lit(None).cast(f.dataType) for f in BRONZE.fields if f.name not in thin.columns})


def handler(folder, **more):
    kinds = {
        "raw": fanout.raw_sink(folder("raw")),
        "dead": fanout.dead_letter_sink(folder("dead")),
        "rolling": fanout.rolling_sink(folder("rolling")),
    }
    return fanout.FanOut(folder("ledger"), kinds | more)


def run(spark, folder, sinks_of):
    query = fanout.fan_out_job(lake.folder_stream(spark, folder("topic")), BRONZE, sinks_of, folder("c"), ("key",), None)
    try:
        query.awaitTermination()
    except StreamingQueryException as error:
        spark.streams.resetTerminated()  # else whoever waits for any query next is told of this one
        return error
    return None


def check(spark, folder, events, dead):
    raw = spark.read.schema("city_id STRING").json(folder("raw"))
    assert sorted(r.city_id for r in raw.collect()) == sorted(r.city_id for r in events.collect())
    got = spark.read.schema("value STRING, reason STRING").parquet(folder("dead"))
    assert sorted((r.value or "", r.reason) for r in got.collect()) == sorted(dead)
    windows, want = fanout.rolling_table(spark, folder("rolling")), alerts.rolling_averages(events).select(*ROLLING.fieldNames())
    assert windows.exceptAll(want).isEmpty() and want.exceptAll(windows).isEmpty()


def test_each_row_once_though_a_sink_fails(spark, folder):
    rng = random.Random(6)
    parts = [bronze(spark, [(rng.choice("ab"), at(rng.randrange(40)), rng.randrange(80) / 4, 1) for _ in range(30)]) for _ in range(3)]
    assert fanout.rolling_table(spark, folder("rolling")) is None
    failing = {"left": 2, "seen": []}

    def flaky(parsed, batch_id):
        failing["seen"].append(batch_id)
        if failing["left"]:
            failing["left"] -= 1
            raise RuntimeError("lost")

    for k, part in enumerate(parts):
        sinks.publish(part, folder("topic"))
        spark.createDataFrame([("k", "{cut"), ("k", None)], "key STRING, value STRING").withColumn("partition", F.lit(0)).write.mode(
            "append"
        ).parquet(folder("topic"))
        while run(spark, folder, handler(folder, last=flaky)) is not None:
            pass
    events = parts[0].unionByName(parts[1]).unionByName(parts[2])
    check(spark, folder, events, [("{cut", "not readable as JSON"), ("", "no body")] * 3)
    assert failing["seen"] == [0, 0, 0, 1, 2]  # the first batch ran three times, and only its last sink did again


def test_a_sink_that_was_cut_off_writes_again(spark, folder):
    events = bronze(spark, [("a", at(m), 1.0, 1) for m in range(20)])
    sinks.publish(events, folder("topic"))
    parsed = lake.parse(spark.read.parquet(folder("topic")), BRONZE, ("key",))
    whole = handler(folder)
    whole.sinks["raw"](parsed, 0)  # written, but lost before the ledger knew
    whole.sinks["rolling"](parsed, 0)
    assert run(spark, folder, whole) is None
    check(spark, folder, events, [])
    days = lake.read_raw_days(spark, folder("raw"), "2024-03-01")
    assert days.count() == 20 and "batch" not in days.columns


def test_input_is_read_once(spark, folder):
    """However many sinks there are, a batch's records leave the topic once."""
    sinks.publish(bronze(spark, [("a", at(m), 1.0, 1) for m in range(50)]), folder("topic"))
    read = spark.sparkContext.accumulator(0)

    def counted(value):
        read.add(1)
        return value

    records = lake.folder_stream(spark, folder("topic"))
    records = records.withColumn("value", F.udf(counted, "string").asNondeterministic()("value"))
    query = fanout.fan_out_job(records, BRONZE, handler(folder), folder("c"), ("key",), None)
    query.awaitTermination()
    assert query.exception() is None and read.value == 50


@pytest.mark.parametrize("value", ['{"temp":"warm","city_id":"a"}', "3", '{"city_id":"a"}', "", " ", "nope", None, '{"city_id":"a"'])
def test_readable_is_json(spark, value):
    records = spark.createDataFrame([("a", value)], "key STRING, value STRING")
    kept, aside = lake.decode(records, BRONZE).count(), lake.unreadable(records).count()
    assert (kept, aside) == ((1, 0) if value in ('{"temp":"warm","city_id":"a"}', "3", '{"city_id":"a"}') else (0, 1))
