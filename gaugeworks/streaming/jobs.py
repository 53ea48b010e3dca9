"""Streaming queries over one event stream: rolling averages, passthrough, duplicates, pairing.

Every query has its own checkpoint. Sinks that hold keyed rows are written by upsert, so a batch that
is run again after a failure leaves the same table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from gaugeworks.operators.alerts import ROLLING_SIZE, ROLLING_SLIDE, rolling_stats
from gaugeworks.operators.windows import adjust_late
from gaugeworks.schemas import BRONZE, ROLLING, conform
from gaugeworks.sources.lake import read_or_none, unreadable
from gaugeworks.sources.sinks import upsert

# --- Fixed values: tolerance and trigger intervals ---
LATE_TOLERANCE = "5 minutes"
ROLLING_TRIGGER = "2 minutes"
ALERT_TRIGGER = "1 minute"

DROPPED = "query STRING, batch BIGINT, operator INT, rows BIGINT"
DROPPED_KEYS = ("query", "batch", "operator")


def start(
    df: DataFrame,
    checkpoint: str,
    each_batch: Callable[[DataFrame, int], None] | None = None,
    mode: str = "append",
    every: str | None = None,
    name: str | None = None,
    state_partitions: int | None = None,
    **sink,
) -> StreamingQuery:
    """Starts a query. Without ``every`` it handles what is available and stops.

    ``state_partitions`` is the number of partitions its state is kept in; a checkpoint keeps the
    number it began with. A query takes its settings when it starts, so the session's own number is
    put back right after.
    """
    if state_partitions:
        spark, setting = df.sparkSession, "spark.sql.shuffle.partitions"
        usual = spark.conf.get(setting)
        spark.conf.set(setting, state_partitions)
        try:
            return start(df, checkpoint, each_batch, mode, every, name, **sink)
        finally:
            spark.conf.set(setting, usual)
    writer = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
    writer = writer.queryName(name) if name else writer
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    if each_batch is not None:
        return writer.foreachBatch(each_batch).start()
    partition = sink.pop("partition", None)
    writer = writer.partitionBy(partition) if partition else writer
    return writer.format(sink.pop("fmt")).options(**sink).start()


def event_time(events: DataFrame, time: str = "poll_timestamp", arrival: str | None = None) -> DataFrame:
    """Event time with the late policy applied.

    With an arrival column, late events are moved to five minutes before their arrival, and events
    from a clock that runs ahead back to their arrival, so that no city moves the watermark past
    another. The watermark trails the newest event by the same five minutes, so as long as
    records are read in arrival order nothing falls behind it: a city that was silent and catches up
    loses nothing. Without an arrival, Spark drops what the watermark has passed.
    """
    if arrival is None:
        return events.withWatermark(time, LATE_TOLERANCE)
    adjusted = adjust_late(events, time, arrival, LATE_TOLERANCE)
    held = F.when(F.col(time).isNotNull(), F.least(F.col(time), F.col(arrival)))
    return adjusted.withColumn(time, held).withWatermark(time, LATE_TOLERANCE)


def rolling_windows(events: DataFrame, time: str = "poll_timestamp") -> DataFrame:
    """Rolling averages as a streaming aggregation. Group state is spread by city and window."""
    window = F.window(time, ROLLING_SIZE, ROLLING_SLIDE)
    grouped = events.groupBy("city_id", window).agg(*[s.aggregate() for s in rolling_stats()])
    return conform(grouped.withColumn("window_end_time", F.col("window.end")), ROLLING)


PARTITION_FORMATS = {"day": "yyyy-MM-dd", "hour": "yyyy-MM-dd-HH"}


def upsert_each(
    path: str, keys: list[str], time: str, by: str = "day", partition: str = "period"
) -> Callable[[DataFrame, int], None]:
    """A batch handler that merges rows into a table with one partition per day or hour of a time
    column. A batch rewrites the periods it touches, so a table of many rows per day wants hours."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        rows = batch.withColumn(partition, F.date_format(time, PARTITION_FORMATS[by])).persist()
        try:
            upsert(rows, path, keys, partition)
        finally:
            rows.unpersist()

    return handle


def rolling_job(
    events: DataFrame,
    table: str,
    checkpoint: str,
    every: str | None = ROLLING_TRIGGER,
    by: str = "hour",
    state_partitions: int | None = None,
) -> StreamingQuery:
    """Keeps the table of rolling averages up to date; a window changes until its time has passed."""
    handle = upsert_each(table, ["city_id", "window_end_time"], "window_end_time", by)
    windows = rolling_windows(events)
    return start(windows, checkpoint, handle, "update", every, "rolling_averages", state_partitions)


def passthrough_job(events: DataFrame, folder: str, checkpoint: str, every: str | None = ALERT_TRIGGER) -> StreamingQuery:
    """Every event as it came, all bronze columns, as JSON by ingestion date. No event time."""
    rows = events.select(*BRONZE.fieldNames())
    return start(
        rows,
        checkpoint,
        every=every,
        name="raw_passthrough",
        partition="ingestion_date",
        fmt="json",
        path=folder,
        ignoreNullFields="false",
        timestampFormat="yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    )


def dead_letter_job(records: DataFrame, folder: str, checkpoint: str, every: str | None = ALERT_TRIGGER) -> StreamingQuery:
    """Records whose body is no JSON, as they came, by day of arrival: set aside, never dropped."""
    arrival = "timestamp" if "timestamp" in records.columns else None
    return start(
        unreadable(records, arrival),
        checkpoint,
        every=every,
        name="dead_letters",
        partition="ingestion_date",
        fmt="json",
        path=folder,
        ignoreNullFields="false",
    )


def without_duplicates(
    events: DataFrame, keys: tuple[str, ...] = ("city_id", "observation_timestamp"), time: str = "poll_timestamp"
) -> DataFrame:
    """Drops re-published observations that follow within the watermark."""
    return events.withWatermark(time, LATE_TOLERANCE).dropDuplicatesWithinWatermark(list(keys))


def paired_payloads(weather: DataFrame, air: DataFrame, within: str = "5 minutes") -> DataFrame:
    """Joins the two payload streams of a city and poll cycle; state older than ``within`` is freed."""
    w = weather.withWatermark("weather_at", LATE_TOLERANCE)
    a = air.select(
        F.col("cycle_id").alias("_cycle"), F.col("city_id").alias("_city"), "air_pollution", "air_at"
    ).withWatermark("air_at", LATE_TOLERANCE)
    bound = F.expr(f"INTERVAL {within}")
    same = (F.col("cycle_id") == F.col("_cycle")) & (F.col("city_id") == F.col("_city"))
    near = (F.col("air_at") >= F.col("weather_at") - bound) & (F.col("air_at") <= F.col("weather_at") + bound)
    return w.join(a, same & near).select(
        "cycle_id", "city_id", F.greatest("weather_at", "air_at").alias("poll_timestamp"), "weather", "air_pollution"
    )


def dropped(query: StreamingQuery) -> list[tuple[int, int, int]]:
    """(batch, position of the stateful operator, rows) of what fell behind the watermark, for the batches the query
    still remembers. For an aggregation a row is a group of a batch, such as a city's window, and not an event."""
    found = []
    for progress in query.recentProgress:
        for position, operator in enumerate(progress["stateOperators"]):
            if rows := operator["numRowsDroppedByWatermark"]:
                found.append((progress["batchId"], position, rows))
    return found


def note_dropped(spark: SparkSession, query: StreamingQuery, folder: str, name: str) -> None:
    """Adds ``dropped`` to a table of counters, as many as batches that dropped something. A batch that is noted
    again counts once when the table is read."""
    rows = [(name, batch, position, count) for batch, position, count in dropped(query)]
    if rows:
        spark.createDataFrame(rows, DROPPED).write.mode("append").parquet(folder)


def dropped_counts(spark: SparkSession, folder: str) -> DataFrame:
    """(query, batch, operator, rows) as noted, once for each batch and operator."""
    found = read_or_none(spark, folder, StructType.fromDDL(DROPPED))
    return spark.createDataFrame([], DROPPED) if found is None else found.dropDuplicates(list(DROPPED_KEYS))


def console(df: DataFrame, checkpoint: str, mode: str = "append", every: str | None = None) -> StreamingQuery:
    return start(df, checkpoint, mode=mode, every=every, fmt="console")


def await_any(spark: SparkSession, timeout: int | None = None) -> bool | None:
    """Waits for any running query to end; several queries share one input this way."""
    return spark.streams.awaitAnyTermination(timeout) if timeout else spark.streams.awaitAnyTermination()
