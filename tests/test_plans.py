"""Properties of the physical plans that matter on a large cluster."""

import re
from datetime import date, timedelta

import pytest
from instants import at
from pyspark.sql import functions as F

from gaugeworks.operators import alerts, daily, gate, monitor, responses, windows
from gaugeworks.plans import catalog
from gaugeworks.schemas import RESPONSE_LOG
from gaugeworks.sources import lake, sinks


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(df):
    return len(re.findall(r"Exchange hashpartitioning", plan(df)))


@pytest.fixture
def stored(spark, folder, readings):
    rows = readings([(c, at(1440 * d), 20.0, 2) for c in "ab" for d in range(3)])
    wide = rows.withColumn("ingestion_date", F.to_date("poll_timestamp")).withColumn("raw_payload_json", F.lit("x"))
    sinks.overwrite_partitions(wide, folder("events"))
    return spark.read.parquet(folder("events"))


def test_gold_of_a_day_is_one_scan_of_a_week_and_one_shuffle(stored):
    gold = plan(daily.gold_day(stored, "2024-03-02"))
    assert gold.count("FileScan") == 1 and gold.count("Exchange") == 1
    scan = next(line for line in gold.splitlines() if "FileScan" in line)
    assert "PartitionFilters: [isnotnull(ingestion_date" in scan
    assert "raw_payload_json" not in scan


def test_day_reader_prunes_partitions(spark, stored, folder):
    scan = plan(lake.read_days(spark, folder("events"), "2024-03-01", "2024-03-02"))
    assert "PartitionFilters: [isnotnull(ingestion_date" in scan
    assert lake.read_days(spark, folder("events"), "2024-03-01", "2024-03-02").count() == 4


def test_windows_combine_before_the_shuffle(stored):
    hopping = plan(alerts.rolling_averages(stored))
    assert hopping.count("Exchange") == 1 and "partial_max" in hopping


def test_many_windows_per_event_are_built_from_panes(stored):
    hour = plan(windows.hopping(stored, "poll_timestamp", "1 hour", "1 minute", ["city_id"], alerts.rolling_stats()))
    lines = hour.splitlines()
    explode = next(i for i, line in enumerate(lines) if "Generate explode" in line)
    assert any("partial_max" in line for line in lines[explode:])
    assert hour.count("Exchange") == 2 and "Expand" not in hour


def test_sliding_never_groups_by_city_alone(stored):
    for splits in (1, 15):
        text = plan(alerts.anomaly_alerts(stored, splits=splits))
        keys = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", text)
        assert keys and all(k.count("#") == 2 for k in keys)  # city and a slice of time
        assert "Join" not in text and "CartesianProduct" not in text


def test_order_adjustment_moves_one_row_per_instant(stored):
    events = stored.withColumn("arrival_ts", F.col("poll_timestamp"))
    text = plan(windows.adjust_out_of_order(events, "poll_timestamp", "arrival_ts", ["city_id"]))
    first = next(line for line in reversed(text.splitlines()) if "Exchange hashpartitioning" in line)
    below = text.splitlines()[text.splitlines().index(first) + 1]
    assert "partial_max" in below
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_instants_are_computed_once(stored):
    # The newest events arrive first, so that older ones have to be moved.
    events = stored.withColumn("arrival_ts", F.timestamp_seconds(F.lit(2 * 10**9) - F.unix_seconds("poll_timestamp")))
    for frame, scans in (
        (windows.adjust_out_of_order(events, "poll_timestamp", "arrival_ts", ["city_id"]), 2),
        (alerts.anomaly_alerts(stored), 1),
    ):
        frame.collect()
        final = frame._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
        assert final.count("FileScan") == scans and "ReusedExchange" in final


def test_aggregates_hash_rather_than_sort(spark, stored):
    empty = spark.createDataFrame([], RESPONSE_LOG)
    frames = (
        daily.gold_day(stored, "2024-03-02"),
        daily.gold_range(stored, "2024-03-01", "2024-03-03"),
        alerts.rolling_averages(stored),
        responses.response_outcomes(empty),
        responses.poll_summary(empty),
    )
    assert not any("SortAggregate" in plan(f) or "ObjectHashAggregate" in plan(f) for f in frames)


def test_no_broadcast_is_forced():
    import pathlib

    import gaugeworks

    root = pathlib.Path(gaugeworks.__file__).parent
    optional = root / "llm"  # broadcasts tables of a checked or given size
    text = "\n".join(p.read_text() for p in root.rglob("*.py") if optional not in p.parents)
    assert "broadcast(" not in text and "localCheckpoint" not in text and "crossJoin" not in text


def test_gate_filters_reach_the_scan(stored):
    ready = stored.withColumn("observation_timestamp", F.col("poll_timestamp"))
    good, _ = gate.split_required(ready)
    assert re.search(r"PushedFilters: \[IsNotNull\(city_id\), IsNotNull\(poll_timestamp\), IsNotNull\(temp\), IsNotNull\(aqi\)", plan(good))


def test_load_signals_are_one_scan_and_one_shuffle(spark, folder):
    log = spark.createDataFrame(
        [(at(0), "x", "y", 1.0, 1.0)],
        "TimeGenerated TIMESTAMP, ResourceProvider STRING, MetricName STRING, Average DOUBLE, Maximum DOUBLE",
    )
    log.write.parquet(folder("log"))
    signals = plan(monitor.load_signals(spark.read.parquet(folder("log"))))
    assert signals.count("FileScan") == 1 and signals.count("Exchange") == 1 and "Sort " not in signals


def test_parts_of_a_stream_hold_every_row_with_a_time_once(spark):
    """Each part is read from what was written for it, whatever it takes to compute the rows."""
    days = [None, "2024-01-01", "2024-01-01", "2024-01-03", "2024-01-05", "2024-01-09", "2024-02-01"]
    rows = spark.createDataFrame([(n, d) for n, d in enumerate(days)], "n INT, day STRING").withColumn("at", F.to_timestamp("day"))
    part = catalog.least_part(F.col("at"), date(2024, 1, 1), timedelta(days=2))
    parts = catalog.in_parts(spark, rows, part)
    assert [sorted(r.n for r in p.collect()) for p in parts] == [[1, 2], [3], [4, 5, 6]]
    assert all(p.columns == rows.columns for p in parts)
    found = plan(parts[1])
    assert "PartitionFilters: [isnotnull(_part" in found and "gettimestamp" not in found


def test_parts_of_a_table_in_time_order_are_dealt_out_evenly(spark):
    rows = spark.range(0, 3000, 1, 3).withColumn("at", F.timestamp_seconds(F.col("id") * 60 + 1704067200))
    parts = catalog.in_parts(spark, rows, F.floor(F.col("id") / 1000).cast("int"))
    pieces = [r["count"] for r in parts[1].groupBy(F.input_file_name()).count().collect()]
    assert len(pieces) == spark.sparkContext.defaultParallelism and sum(pieces) == 1000 and max(pieces) < 2 * min(pieces)
