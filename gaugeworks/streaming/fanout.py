"""One read of the event topic, several tables: every batch is parsed once and handed to each sink.

A ledger holds, for each sink, the batches it has taken. A batch that runs again after a failure skips
the sinks that had finished; the one that was cut off writes the same folder again. So each row is in each
table once, wherever the driver or an executor was lost.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from gaugeworks.functions.stats import merged_parts, part_columns, raw_parts, results
from gaugeworks.operators.alerts import ROLLING_SIZE, ROLLING_SLIDE, rolling_stats
from gaugeworks.operators.windows import adjust_late
from gaugeworks.schemas import BRONZE, ROLLING, conform
from gaugeworks.sources.changes import append_changes, batches
from gaugeworks.sources.lake import events_of, exists, parse
from gaugeworks.streaming.jobs import ALERT_TRIGGER, LATE_TOLERANCE, start

Sink = Callable[[DataFrame, int], None]


@dataclass(frozen=True)
class FanOut:
    """Batch handler: hands the parsed records to the sinks in order, each at most once a batch."""

    ledger: str
    sinks: dict[str, Sink] = field(default_factory=dict)

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        waiting = [name for name in self.sinks if not exists(spark, self._entry(name, batch_id))]
        if not waiting:
            return
        parsed = batch.persist()
        try:
            for name in waiting:
                self.sinks[name](parsed, batch_id)
                self._note(spark, name, batch_id)
        finally:
            parsed.unpersist()

    def _entry(self, name: str, batch_id: int) -> str:
        return f"{self.ledger.rstrip('/')}/{name}/{batch_id}"

    def _note(self, spark: SparkSession, name: str, batch_id: int) -> None:
        path = spark._jvm.org.apache.hadoop.fs.Path(self._entry(name, batch_id))
        path.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(path)


def raw_sink(folder: str, schema: StructType = BRONZE) -> Sink:
    """Events as they came, as JSON by ingestion date and batch; a batch replaces its own folders."""

    def write(parsed: DataFrame, batch_id: int) -> None:
        events = events_of(parsed, schema).withColumn("batch", F.lit(batch_id))
        writer = events.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer = writer.option("ignoreNullFields", "false").option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")
        writer.partitionBy("ingestion_date", "batch").json(folder)

    return write


def dead_letter_sink(folder: str) -> Sink:
    """Records whose body is no JSON, with their text, a folder for each batch."""

    def write(parsed: DataFrame, batch_id: int) -> None:
        reason = F.when(F.col("value").isNull(), "no body").otherwise("not readable as JSON").alias("reason")
        kept = [c for c in parsed.columns if c not in ("event", "readable")]
        parsed.where(~F.col("readable")).select(*kept, reason).write.mode("overwrite").parquet(f"{folder.rstrip('/')}/batch={batch_id}")

    return write


def events_sink(schema: StructType, handle: Sink, keep: tuple[str, ...] = ()) -> Sink:
    """A batch handler of decoded events, such as ``SlidingAlerts``, as a sink."""
    return lambda parsed, batch_id: handle(events_of(parsed, schema, keep), batch_id)


def rolling_sink(table: str, schema: StructType = BRONZE, time: str = "poll_timestamp", arrival: str | None = None) -> Sink:
    """Parts of the rolling averages of a batch: sums, counts and extremes of each window its events fall in.

    Parts of different batches add up when read (``rolling_table``), so no state and no watermark is
    needed, no event is too late, and a batch writes in proportion to its own windows.
    """

    def write(parsed: DataFrame, batch_id: int) -> None:
        events = events_of(parsed, schema, (arrival,) if arrival and arrival not in schema.fieldNames() else ())
        if arrival:
            events = adjust_late(events, time, arrival, LATE_TOLERANCE)
        window = F.window(time, ROLLING_SIZE, ROLLING_SLIDE).alias("_window")
        parts = events.groupBy("city_id", window).agg(*raw_parts(rolling_stats()))
        names = [name for name, _ in part_columns(rolling_stats())]
        append_changes(parts.select("city_id", F.col("_window.end").alias("window_end_time"), *names), table, batch_id)

    return write


def rolling_table(spark: SparkSession, table: str) -> DataFrame | None:
    """The rolling averages of all batches; ``None`` before the first."""
    if not (which := batches(spark, table)):
        return None
    parts = spark.read.option("basePath", f"{table}/changes").parquet(*[f"{table}/changes/batch={n}" for n in which])
    merged = parts.groupBy("city_id", "window_end_time").agg(*merged_parts(rolling_stats()))
    return conform(merged.select("city_id", *results(rolling_stats()), "window_end_time"), ROLLING)


def fan_out_job(
    records: DataFrame,
    schema: StructType,
    handler: FanOut,
    checkpoint: str,
    keep: tuple[str, ...] = (),
    every: str | None = ALERT_TRIGGER,
) -> StreamingQuery:
    """Reads and parses the topic once for all sinks of the handler."""
    return start(parse(records, schema, keep), checkpoint, handler, "append", every, "fan_out")
