"""Task times of the window operators when one city sends a third of all rows on a single day.

    python skew_check.py [scale-dir]

Thirty shifted copies of the events are written below the work folder. Per stage the median and the
longest task are printed, read from Spark's event log.
"""

from __future__ import annotations

import json
import sys
import tempfile
import time
from collections import defaultdict
from pathlib import Path

from pyspark.sql import functions as F

from gaugeworks.operators import daily, serving, windows
from gaugeworks.operators.alerts import anomaly_alerts, rolling_averages
from gaugeworks.plans.adapters import sensor_events
from gaugeworks.session import build_session, work_dir


def skewed(spark, sf_dir: str):
    events = sensor_events(spark, sf_dir, spread=True).withColumn("c", F.explode(F.sequence(F.lit(0), F.lit(29))))
    hot = F.col("c") < 10
    seconds = (F.col("event_id") * 10 + F.col("c")) * F.lit(0.0864)
    one_day = F.lit("2024-01-10").cast("timestamp_ntz") + F.make_dt_interval(secs=seconds)
    shifted = F.col("poll_timestamp") + F.make_dt_interval(secs=F.col("c") * 7)
    path = work_dir(spark, "skewed")
    events = events.withColumn("city_id", F.when(hot, "hot").otherwise(F.concat_ws("_", "city_id", "c")))
    events = events.withColumn("poll_timestamp", F.when(hot, one_day).otherwise(shifted))
    events = events.withColumn("arrival_ts", F.col("poll_timestamp") + F.make_dt_interval(mins=F.col("humidity") % 10))
    events.withColumn("ingestion_date", F.to_date("poll_timestamp")).drop("c").write.parquet(path)
    return spark.read.parquet(path)


def main(sf_dir: str) -> None:
    log = tempfile.mkdtemp(prefix="gaugeworks-events-")
    spark = build_session(
        "local[8]",
        spark__sql__shuffle__partitions=32,
        spark__sql__adaptive__coalescePartitions__enabled="false",
        spark__driver__memory="16g",
        spark__eventLog__enabled="true",
        spark__eventLog__dir=f"file:{log}",
        spark__eventLog__compress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    events = skewed(spark, sf_dir)
    queries = {
        "hopping": lambda: rolling_averages(events),
        "sliding, splits=1": lambda: anomaly_alerts(events, splits=1),
        "sliding, splits=15": lambda: anomaly_alerts(events),
        "out of order": lambda: windows.adjust_out_of_order(events, "poll_timestamp", "arrival_ts", ["city_id"]),
        "current readings": lambda: serving.current_readings(events),
        "gold backfill": lambda: daily.gold_range(events, "2024-01-01", "2024-01-30"),
    }
    print(f"{events.count()} rows, {events.filter(F.col('city_id') == 'hot').count()} of one city")
    for warm in (True, False):
        for name, make in queries.items():
            spark.sparkContext.setJobGroup("warm" if warm else name, name)
            begin = time.perf_counter()
            make().write.format("noop").mode("overwrite").save()
            if not warm:
                print(f"{name}: {time.perf_counter() - begin:.1f}s")
    spark.stop()

    group, tasks = {}, defaultdict(list)
    for file in Path(log).rglob("*"):
        if not file.is_file() or file.name.startswith("."):
            continue
        for line in file.read_text().splitlines():
            event = json.loads(line)
            if event["Event"] == "SparkListenerJobStart":
                for stage in event["Stage IDs"]:
                    group.setdefault(stage, event["Properties"].get("spark.jobGroup.id"))
            elif event["Event"] == "SparkListenerTaskEnd":
                info = event["Task Info"]
                tasks[event["Stage ID"]].append(info["Finish Time"] - info["Launch Time"])
    for stage, times in sorted(tasks.items()):
        times.sort()
        if group.get(stage) in queries and len(times) >= 32:
            print(f"{group[stage]}: {len(times)} tasks, median {times[len(times) // 2]} ms, longest {times[-1]} ms")


if __name__ == "__main__":
    main(sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1")
