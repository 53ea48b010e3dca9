"""Interval joins of two streams whose pairs are only counted: what each window holds, without a row per pair.

Windows and events that meet grow with the square of the events per window. Here a micro-batch joins what is
new with what is still in reach by running aggregates (``intervals.content_parts``), and writes parts of the
statistics of each window it changes. Parts of different batches add up when the table is read.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeworks.functions.stats import Stat, merged_parts, results
from gaugeworks.functions.times import epoch_micros, micros
from gaugeworks.operators.intervals import content_parts
from gaugeworks.sources.changes import append_changes, batches


@dataclass(frozen=True)
class WindowContents:
    """Batch handler for both sides in one stream, as ``intervals.stream_contents`` gives them for statistics.

    New windows meet the events in reach and the new ones; windows that were there before meet the new events,
    so each pair counts once, whichever side comes first. ``memory`` holds both sides in reach in two slots that
    take turns: a batch reads the slot of the batch before it, so running it again gives the same. Each side
    has a mark ``late`` behind its newest row, and the lower one frees rows as in the listing form: events
    once ``size`` older, windows that end at or before it. A window is one of its keys and end.
    """

    table: str
    memory: str
    keys: tuple[str, ...]
    end: str
    time: str
    size: str
    stats: tuple[Stat, ...]
    late: str = "5 minutes"

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark, fresh = batch.sparkSession, batch.withColumn("_fresh", F.lit(True))
        before = self._slot(batch_id - 1)
        known = spark.read.schema(batch.schema).parquet(before) if batch_id > 0 else batch.limit(0)
        both = known.withColumn("_fresh", F.lit(False)).unionByName(fresh).persist()
        try:
            windows, events = both.where(F.col(self.end).isNotNull()), both.where(F.col(self.time).isNotNull())
            named = (list(self.keys), self.end, self.time, self.size, self.stats)
            one = [*self.keys, self.end]
            old = windows.where("NOT _fresh").select(*one)
            added = windows.where("_fresh").select(*one).join(old, one, "left_anti")
            # No window that was there ends later than this, so events after it are not looked at again.
            last, *newest = both.agg(
                F.max(F.when(~F.col("_fresh"), epoch_micros(self.end))),
                F.max(epoch_micros(self.end)),
                F.max(epoch_micros(self.time)),
            ).first()
            parts = content_parts(added, events.drop(self.end), *named)
            if last is not None:
                reached = events.where(F.col("_fresh") & (epoch_micros(self.time) <= last)).drop(self.end)
                parts = parts.unionByName(content_parts(old, reached, *named))
            append_changes(parts, self.table, batch_id)
            self._in_reach(both, newest).drop("_fresh").write.mode("overwrite").parquet(self._slot(batch_id))
        finally:
            both.unpersist()

    def _slot(self, batch_id: int) -> str:
        return f"{self.memory.rstrip('/')}/slot={batch_id % 2}"

    def _in_reach(self, both: DataFrame, newest: list[int | None]) -> DataFrame:
        if None in newest:
            return both
        mark = min(newest) - micros(self.late)
        return both.where((epoch_micros(self.end) > mark) | (epoch_micros(self.time) > mark - micros(self.size)))


def contents_table(
    spark: SparkSession, table: str, keys: Sequence[str], end: str, stats: Sequence[Stat]
) -> DataFrame | None:
    """(keys, end, statistics) of all batches; ``None`` before the first."""
    if not (which := batches(spark, table)):
        return None
    parts = spark.read.option("basePath", f"{table}/changes").parquet(*[f"{table}/changes/batch={n}" for n in which])
    return parts.groupBy(*keys, end).agg(*merged_parts(stats)).select(*keys, end, *results(stats))
