"""Sliding-window alerts on a stream, with a clock of its own for every city.

Spark's watermark is one for the whole stream: while one city lags, either all wait or its events are
dropped. Here no watermark is used. Each micro-batch joins the events still in reach, kept in a small
written table, and recomputes the evaluations that the new events change with the same distributed
operator as the batch job. A busy city is spread over tasks like in batch, which a state object per
city could not do, and nothing lives only in the memory of an executor.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from gaugeworks.functions.times import as_time, epoch_micros, micros
from gaugeworks.operators.alerts import ALERT_STATS, ALERT_WINDOW, AnomalyRule
from gaugeworks.operators.windows import adjust_late, adjust_out_of_order, moved_up, sliding
from pyspark.sql.types import StructField, StructType
from gaugeworks.sources.sinks import upsert
from gaugeworks.streaming.jobs import (
    ALERT_TRIGGER,
    LATE_TOLERANCE,
    ROLLING_TRIGGER,
    event_time,
    passthrough_job,
    rolling_job,
    start,
)

# --- Fixed value: how far events of a city may be out of order ---
ORDER_TOLERANCE = "30 seconds"


@dataclass(frozen=True)
class SlidingAlerts:
    """Batch handler. ``alerts`` is the table of alert documents, ``memory`` a folder for the events
    in reach, written alternately to two slots: a batch reads the slot of the batch before it and
    writes the other, so running it again gives the same result."""

    alerts: str
    memory: str
    rule: AnomalyRule = AnomalyRule()
    time: str = "poll_timestamp"
    arrival: str | None = None
    splits: int = 15

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        columns = ["city_id", self.time, "temp", "aqi", "pm2_5"]
        kept = StructType([StructField(c, batch.schema[c].dataType) for c in columns])
        before = self._slot(batch_id - 1)
        known = (
            spark.read.schema(kept).parquet(before) if batch_id > 0 else spark.createDataFrame([], kept)
        )
        fresh = self._adjusted(batch, known).select(*columns)
        both = self._in_reach(known).withColumn("fresh", F.lit(False))
        both = both.unionByName(fresh.withColumn("fresh", F.lit(True)))
        both.write.mode("overwrite").parquet(self._slot(batch_id))
        events = spark.read.schema(both.schema).parquet(self._slot(batch_id))

        changed = self._changed(events)
        of_changed = events.join(changed.select("city_id"), "city_id", "left_semi")
        windows = sliding(
            of_changed, self.time, ALERT_WINDOW, ["city_id"], ALERT_STATS, end="detected_at", splits=self.splits
        )
        at = epoch_micros("detected_at")
        due = windows.join(changed, "city_id").filter((at >= F.col("_from")) & (at <= F.col("_to")))
        rows = self.rule.apply(due).withColumn("detected_date", F.to_date("detected_at")).persist()
        try:
            upsert(rows, self.alerts, ["id"], "detected_date", [F.col("detected_at").desc()], ["city_id", "id"])
        finally:
            rows.unpersist()

    def _slot(self, batch_id: int) -> str:
        return f"{self.memory.rstrip('/')}/slot={batch_id % 2}"

    def _latest(self, events: DataFrame) -> DataFrame:
        return events.groupBy("city_id").agg(F.max(epoch_micros(self.time)).alias("_seen"))

    def _adjusted(self, batch: DataFrame, known: DataFrame) -> DataFrame:
        """Late arrivals first, then events out of order within their city. Without an arrival column
        only the city's clock at the end of the batch before is known. Either way no event is moved
        to before the reach of the kept events."""
        clock = self._latest(known)
        if self.arrival is None:
            limit = F.col("_seen") - micros(ORDER_TOLERANCE)
            moved = as_time(moved_up(self.time, limit), batch, self.time)
            return batch.join(clock, "city_id", "left").withColumn(self.time, moved)
        punctual = adjust_late(batch, self.time, self.arrival, LATE_TOLERANCE)
        return adjust_out_of_order(punctual, self.time, self.arrival, ["city_id"], ORDER_TOLERANCE, seen=clock)

    def _in_reach(self, events: DataFrame) -> DataFrame:
        """Events a later evaluation can still contain. The latest event of a city is always one, so
        the table also holds each city's clock."""
        reach = micros(ALERT_WINDOW) + micros(ORDER_TOLERANCE)
        recent = epoch_micros(self.time) > F.col("_seen") - reach
        return events.join(self._latest(events), "city_id").filter(recent).drop("_seen")

    def _changed(self, events: DataFrame) -> DataFrame:
        """Per city with new events, the span of instants whose evaluation is new or different: from
        its first new event, or from where its clock stood, to where its clock stands now. Departures
        later than that wait until the city's time reaches them."""
        t = epoch_micros(self.time)
        return (
            events.groupBy("city_id")
            .agg(
                F.max(t).alias("_to"),
                F.min(F.when(F.col("fresh"), t)).alias("_first"),
                F.max(F.when(~F.col("fresh"), t)).alias("_clock"),
            )
            .filter(F.col("_first").isNotNull())
            .select("city_id", F.least(F.col("_first"), F.col("_clock") + 1).alias("_from"), "_to")
        )


def alerts_job(
    events: DataFrame, handler: SlidingAlerts, checkpoint: str, every: str | None = ALERT_TRIGGER
) -> StreamingQuery:
    return start(events, checkpoint, handler, "append", every, "anomaly_alerts")


def start_all(
    events: DataFrame, root: str, arrival: str | None = None, every: dict[str, str | None] | None = None
) -> list[StreamingQuery]:
    """The three queries over one stream of bronze events, with tables and checkpoints below ``root``:
    rolling averages, anomaly alerts, and the raw events the daily batch starts from."""
    every = {"rolling": ROLLING_TRIGGER, "alerts": ALERT_TRIGGER, "raw": ALERT_TRIGGER} | (every or {})
    root = root.rstrip("/")
    handler = SlidingAlerts(f"{root}/alerts", f"{root}/alert_memory", arrival=arrival)
    return [
        rolling_job(event_time(events, arrival=arrival), f"{root}/rolling", f"{root}/checkpoints/rolling", every["rolling"]),
        alerts_job(events, handler, f"{root}/checkpoints/alerts", every["alerts"]),
        passthrough_job(events, f"{root}/raw", f"{root}/checkpoints/raw", every["raw"]),
    ]
