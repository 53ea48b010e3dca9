"""Interval joins: events that lie in windows of time, in batch and between two streams."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gaugeworks.functions.stats import Stat, merged_parts, part_columns, raw_parts, results
from gaugeworks.functions.times import as_time, epoch_micros, floor_to, micros
from gaugeworks.operators.alerts import ALERT_STATS, ALERT_WINDOW, AnomalyRule


def contents(
    windows: DataFrame, events: DataFrame, keys: Sequence[str], end: str, time: str, size: str, stats: Sequence[Stat] | None = None
) -> DataFrame:
    """Windows beside each event in (end - size, end] of the same keys: all columns of both, keys once.

    With ``stats``, each window (keys, end) that holds an event, once, beside the statistics of all it holds:
    the rows that grouping the pairs would give, without the pairs (``content_parts``).

    An event falls in one bucket of time as long as a window, and a window touches two, so the join is one
    of equal keys and buckets with a test behind it. No pair further apart than two windows is looked at.
    A busy key is spread over its buckets. Null keys or times match nothing; repeated rows give repeated
    pairs. Column names of the two sides other than the keys must differ.
    """
    if stats is not None:
        return content_parts(windows, events, keys, end, time, size, stats).select(*keys, end, *results(stats))
    spread, placed = bucketed(windows, events, end, time, size)
    at, then = epoch_micros(end), epoch_micros(time)
    inside = (then > at - micros(size)) & (then <= at)
    return spread.join(placed, [*keys, "_bucket"]).where(inside).drop("_bucket")


def bucketed(windows: DataFrame, events: DataFrame, end: str, time: str, size: str) -> tuple[DataFrame, DataFrame]:
    """Both sides with the bucket of time they can meet in; a window has a row for each of its two."""
    width, at = micros(size), epoch_micros(end)
    touched = F.array_distinct(F.array(floor_to(at - width + 1, width), floor_to(at, width)))
    spread = windows.where(F.col(end).isNotNull()).withColumn("_bucket", F.explode(touched))
    return spread, events.where(F.col(time).isNotNull()).withColumn("_bucket", floor_to(epoch_micros(time), width))


def content_parts(
    windows: DataFrame, events: DataFrame, keys: Sequence[str], end: str, time: str, size: str, stats: Sequence[Stat]
) -> DataFrame:
    """(keys, end, parts of the statistics) of the events in each window that holds any, once for a window.

    In the buckets of ``bucketed`` a window holds the last events of the earlier bucket, those after
    end - size, and the first ones of the later, those up to its end. So it meets two rows: a running
    aggregate in reverse and one in time order. Events of one instant are combined first. Work is linear in
    events and windows, however many events a window holds; a task holds a key's bucket at most.
    """
    keys, width, parts = list(keys), micros(size), part_columns(stats)
    names, known = [name for name, _ in parts], [F.col(k).isNotNull() for k in keys]
    placed = (
        events.where(F.col(time).isNotNull())
        .groupBy(*keys, epoch_micros(time).alias("_at"))
        .agg(*raw_parts(stats))
        .select(*keys, "_at", F.lit(None).cast("long").alias("_end"), F.lit(1).alias("_n"), *names)
    )
    ends = windows.where(F.col(end).isNotNull()).select(*keys, epoch_micros(end).alias("_end")).distinct()
    # The row at an end looks back in its bucket, the one at end - size ahead in the bucket before.
    both = ends.withColumn("_at", F.explode(F.array(F.col("_end"), F.col("_end") - width)))
    rows = placed.unionByName(both, allowMissingColumns=True).withColumn("_bucket", floor_to(F.col("_at"), width))
    for there in known:
        rows = rows.where(there)
    bucket = Window.partitionBy(*keys, "_bucket")
    back = bucket.orderBy("_at").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    ahead = bucket.orderBy(F.col("_at").desc()).rangeBetween(Window.unboundedPreceding, -1)
    looks_back = F.col("_at") == F.col("_end")
    counted = [*parts, ("_n", "sum")]
    met = rows.select(
        *keys,
        "_end",
        *[F.when(looks_back, getattr(F, how)(n).over(back)).otherwise(getattr(F, how)(n).over(ahead)).alias(n) for n, how in counted],
    ).where("_end IS NOT NULL AND _n > 0")
    merged = met.groupBy(*keys, "_end").agg(*merged_parts(stats))
    return merged.select(*keys, as_time(F.col("_end"), windows, end).alias(end), *names)


def instants(events: DataFrame, keys: Sequence[str], time: str, size: str, end: str) -> DataFrame:
    """(keys, end): the instants at which an event enters or leaves a window of ``size``, once each."""
    both = F.array(F.col(time), F.col(time) + F.expr(f"INTERVAL {size}"))
    return events.where(F.col(time).isNotNull()).select(*keys, F.explode(both).alias(end)).distinct()


def anomalies_by_contents(
    events: DataFrame, time: str = "poll_timestamp", rule: AnomalyRule = AnomalyRule()
) -> DataFrame:
    """Anomaly alerts from the contents of each window, all of its events counted. ``alerts.anomaly_alerts``
    gives the same rows without a join; where the members themselves are wanted, ``contents`` lists them."""
    windows = instants(events, ["city_id"], time, ALERT_WINDOW, "detected_at")
    held = events.select("city_id", time, "temp", "aqi", "pm2_5")
    return rule.apply(contents(windows, held, ["city_id"], "detected_at", time, ALERT_WINDOW, ALERT_STATS))


def stream_contents(
    windows: DataFrame, events: DataFrame, keys: Sequence[str], end: str, time: str, size: str, late: str = "5 minutes",
    stats: Sequence[Stat] | None = None,
) -> DataFrame:
    """``contents`` of two streams: a pair is given as soon as both sides are there, whichever comes first.

    Both carry a watermark ``late`` behind their newest row, and the interval bounds how long the other side
    is awaited, so state is freed: events once ``size`` old by the windows' watermark, windows once the
    events' watermark has passed their end.

    With ``stats``, the rows of both that these need, as one stream: a window lacks a time, an event an end.
    ``streaming.members.WindowContents`` joins them batch by batch, without listing pairs.
    """
    if stats is not None:
        needed = [c for c in dict.fromkeys(s.column for s in stats) if c and c != time]
        return windows.select(*keys, end).unionByName(events.select(*keys, time, *needed), allowMissingColumns=True)
    windows, events = bucketed(windows.withWatermark(end, late), events.withWatermark(time, late), end, time, size)
    keys = [*keys, "_bucket"]
    events = events.withColumnsRenamed({k: f"_{k}" for k in keys})
    bound = F.expr(f"INTERVAL {size}")
    same = (F.col(time) > F.col(end) - bound) & (F.col(time) <= F.col(end))
    for k in keys:
        same = same & (F.col(k) == F.col(f"_{k}"))
    return windows.join(events, same).drop("_bucket", *[f"_{k}" for k in keys])
