"""Newest alerts without a sort of the range, and one city's alerts without reading the others'."""

import pytest
from instants import at
from pyspark.sql import functions as F

from gaugeworks.operators import serving
from gaugeworks.schemas import ALERT
from gaugeworks.sources import sinks


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def alerts(spark):
    rows = [
        (f"id-{i:03}", f"city_{i % 8}", 9.0, 1.0, 8.0, 1, 1.0, True, False, None if i == 5 else at(i // 3)) for i in range(90)
    ]
    return spark.createDataFrame(rows, ALERT)


def test_newest_alerts(alerts):
    listed = [r.id for r in serving.recent_alerts(alerts).collect()]
    assert listed[0] == "id-087" and listed[-1] == "id-005" and len(listed) == 90
    for n in (0, 1, 7, 500):
        assert [r.id for r in serving.recent_alerts(alerts, newest=n).collect()] == listed[:n]
    bounded, whole = plan_of(serving.recent_alerts(alerts, newest=7)), plan_of(serving.recent_alerts(alerts))
    assert "TakeOrderedAndProject" in bounded and "rangepartitioning" not in bounded and "rangepartitioning" in whole


def test_alerts_of_a_city_skip_files(spark, alerts, folder):
    """Clustered files cover ranges of cities, so the rest of them has no row group that is read."""
    path = folder("alerts")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sinks.clustered(alerts.where("detected_at IS NOT NULL"), "city_id", "id").write.parquet(path)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    stored = spark.read.schema(ALERT).parquet(path)
    bounds = stored.groupBy(F.input_file_name()).agg(F.min("city_id").alias("low"), F.max("city_id").alias("high"))
    ranges = [(r.low, r.high) for r in bounds.collect()]
    assert len(ranges) > 1 and sum(low <= "city_3" <= high for low, high in ranges) == 1
    found = serving.alerts_for_city(stored, "city_3")
    assert "EqualTo(city_id,city_3)" in plan_of(found)
    assert found.count() == alerts.where("city_id = 'city_3' AND detected_at IS NOT NULL").count()
