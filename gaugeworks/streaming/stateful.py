"""Event-time order and sliding alerts as keyed state: a clock and a window of its own for every city.

Spark's watermark is one for the whole stream, and timers that follow it would tie every city to the
newest one. So no watermark and no timer is used here. The state of a city holds how far its own time has
come; an event that leaves a window is due when that time passes it. A silent city keeps its state as it is.

State is read and written for the cities of a batch only. Handing a city's events to one task is what
limits this form: see ``SlidingWindows`` for figures, and ``streaming.sliding`` for the one that spreads
a city over tasks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from gaugeworks.functions.times import epoch_micros, micros
from gaugeworks.operators.alerts import ALERT_WINDOW, AnomalyRule
from gaugeworks.operators.windows import adjust_late
from gaugeworks.session import ship
from gaugeworks.sources.changes import append_each
from gaugeworks.streaming.jobs import ALERT_TRIGGER, LATE_TOLERANCE, start
from gaugeworks.streaming.sliding import ORDER_TOLERANCE

NEVER = -(2**62)
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def in_order(frames: Iterator[pd.DataFrame]) -> pd.DataFrame:
    """The rows of a key in a batch by arrival; those that arrive at one instant by event time."""
    whole = pd.concat(list(frames), ignore_index=True)
    return whole.sort_values(["arrived_us", "at_us"], kind="stable", ignore_index=True)


def moved(at: np.ndarray, seen: int, tolerance: int) -> np.ndarray:
    """Times that trail the latest earlier one by more than the tolerance, moved up to that limit."""
    return np.maximum(at, np.maximum(np.maximum.accumulate(at), seen) - tolerance)


class KeptInOrder(StatefulProcessor):
    """Moves the events of a key that are too far out of order; its state is the latest time so far."""

    def __init__(self, tolerance: int) -> None:
        self.tolerance = tolerance

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.latest = handle.getValueState("latest", "at LONG")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        frame = in_order(rows)
        seen = self.latest.get()[0] if self.latest.exists() else NEVER
        at = frame["at_us"].to_numpy(dtype=np.int64)
        frame["at_us"] = moved(at, seen, self.tolerance)
        if at.max() > seen:
            self.latest.update((int(at.max()),))
        yield frame

    def close(self) -> None:
        pass


VALUES = ("temp", "aqi", "pm2_5")


class SlidingWindows(StatefulProcessor):
    """Evaluates the window (t - size, t] of a key at each instant t at which an event enters or leaves.

    State: the key's clock, and its events in reach, packed by pane of time, so that a batch appends to
    the panes it touches and removes those that no later window can contain; what a long batch has left
    behind at its end is not stored at all. A batch gives the
    evaluations it changes: those from its first event, or from where the clock stood, up to where the
    clock stands now, without those whose values stay the same. Windows are swept once, in time order,
    with the running extremes that pandas keeps for windows of time.

    The events of a key in reach are held in memory by one task. Measured on one core: with a million
    events in reach (1,100 a second for 15 minutes) the state takes 32 MB, and a batch of a minute 1.9 s
    and 640 MB; with 100,000 it takes 0.2 s.
    """

    def __init__(self, size: int, tolerance: int, pane: int) -> None:
        self.size, self.tolerance, self.pane = size, tolerance, pane

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.clock = handle.getValueState("clock", "at LONG")
        self.panes = handle.getMapState("panes", "pane LONG", "packed BINARY")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        frame = in_order(rows)
        seen = self.clock.get()[0] if self.clock.exists() else NEVER
        at = moved(frame["at_us"].to_numpy(dtype=np.int64), seen, self.tolerance)
        fresh = np.column_stack([at.view(np.float64), *(frame[c].to_numpy(dtype=np.float64) for c in VALUES)])
        until = max(seen, int(at.max()))
        known = self._kept()
        yield self._changed(key[0], known, fresh, seen, min(int(at.min()), seen + 1), until)
        reach = until - self.tolerance - self.size
        self._forget(reach)
        later = ~self._left(at // self.pane, reach)
        self._keep(fresh[later], at[later] // self.pane)
        if until > seen:
            self.clock.update((until,))

    def close(self) -> None:
        pass

    def _kept(self) -> np.ndarray:
        packed = [np.frombuffer(value[0]).reshape(-1, 1 + len(VALUES)) for value in self.panes.values()]
        return np.concatenate([np.empty((0, 1 + len(VALUES))), *packed])

    def _keep(self, fresh: np.ndarray, panes: np.ndarray) -> None:
        order = np.argsort(panes, kind="stable")
        each, begins = np.unique(panes[order], return_index=True)
        for pane, some in zip(each.tolist(), np.split(fresh[order], begins[1:])):
            rows = some.tobytes()
            known = self.panes.getValue((pane,)) if self.panes.containsKey((pane,)) else None
            self.panes.updateValue((pane,), ((bytes(known[0]) if known else b"") + rows,))

    def _left(self, panes, reach: int):
        """Whether all of a pane is at or before ``reach``, and so in no later window."""
        return (panes + 1) * self.pane <= reach + 1

    def _forget(self, reach: int) -> None:
        for (pane,) in list(self.panes.keys()):
            if self._left(pane, reach):
                self.panes.removeKey((pane,))

    def _swept(self, events: np.ndarray, begin: int, until: int) -> pd.DataFrame:
        """The windows that end in begin..until, by their end in microseconds."""
        at = events[:, 0].copy().view(np.int64)
        reached = at >= begin - self.size  # one that leaves at the very beginning is an instant there
        events, at = events[reached], at[reached]
        ends = np.concatenate([at, at + self.size])
        values = np.concatenate([events[:, 1:], np.full((len(at), len(VALUES)), np.nan)])
        order = np.argsort(ends, kind="stable")
        table = pd.DataFrame(values[order], columns=VALUES, index=pd.to_datetime(ends[order], unit="us"))
        table["entered"] = np.repeat([1.0, np.nan], len(at))[order]
        window = table.rolling(pd.Timedelta(self.size, "us"), min_periods=1)
        highest, lowest = window.max(), window["temp"].min()
        out = pd.DataFrame(
            {
                "_end": ends[order],
                "window_max_temp": highest["temp"].to_numpy(),
                "window_min_temp": lowest.to_numpy(),
                "window_max_aqi": highest["aqi"].to_numpy(),
                "window_max_pm2_5": highest["pm2_5"].to_numpy(),
                "_filled": highest["entered"].notna().to_numpy(),
            }
        )
        # The last row of an instant has seen everything that enters or leaves at it.
        out = out.drop_duplicates("_end", keep="last")
        return out[out["_filled"] & out["_end"].between(begin, until)].drop(columns="_filled")

    def _changed(self, city: str, known: np.ndarray, fresh: np.ndarray, seen: int, begin: int, until: int) -> pd.DataFrame:
        now = self._swept(np.concatenate([known, fresh]), begin, until)
        if begin <= seen:
            before = self._swept(known, begin, seen)
            both = now.merge(before.assign(_was=True), how="left")  # on all values; unknown equals unknown
            now = both[both["_was"].isna()].drop(columns="_was")
        return now.assign(city_id=city)


SWEPT = (
    "_end LONG, window_max_temp DOUBLE, window_min_temp DOUBLE, window_max_aqi DOUBLE, window_max_pm2_5 DOUBLE, city_id STRING"
)


def prepared(events: DataFrame, time: str, arrival: str | None) -> DataFrame:
    """Events with a time under the late policy, and arrival and event time in microseconds beside them.
    Without an arrival, event time stands for it."""
    ship(events.sparkSession.sparkContext)
    if arrival:
        events = adjust_late(events, time, arrival, LATE_TOLERANCE)
    arrived = F.coalesce(epoch_micros(arrival), epoch_micros(time)) if arrival else epoch_micros(time)
    return events.withColumns({"at_us": epoch_micros(time), "arrived_us": arrived}).where("at_us IS NOT NULL AND city_id IS NOT NULL")


def kept_in_order(
    events: DataFrame, columns: list[str], time: str = "poll_timestamp", arrival: str | None = None
) -> DataFrame:
    """(city_id, time, columns as double): the stream of events after both event-time adjustments.

    The running latest time of a city is state, so the adjustment goes on over batches and restarts.
    Events without a time or a city are in no window and are left out.
    """
    numbers = [F.col(c).cast("double").alias(c) for c in columns]
    rows = prepared(events, time, arrival).select("city_id", "at_us", "arrived_us", *numbers)
    schema = ", ".join(["city_id STRING", "at_us LONG", "arrived_us LONG", *(f"{c} DOUBLE" for c in columns)])
    ordered = rows.groupBy("city_id").transformWithStateInPandas(KeptInOrder(micros(ORDER_TOLERANCE)), schema, "Append", "None")
    return ordered.select("city_id", F.timestamp_micros("at_us").alias(time), *columns)


def order_job(
    events: DataFrame,
    columns: list[str],
    folder: str,
    checkpoint: str,
    arrival: str | None = None,
    every: str | None = ALERT_TRIGGER,
    state_partitions: int | None = None,
) -> StreamingQuery:
    """Events in order as a stream of their own, written once each: what windows that aggregate read.

    Spark aggregates behind another stateful operator only in append mode, which holds every window back
    until the watermark has passed it. Two queries keep windows up to date while they are open.
    """
    with_rocksdb(events)
    rows = kept_in_order(events, columns, arrival=arrival)
    return start(rows, checkpoint, every=every, name="events_in_order", state_partitions=state_partitions, fmt="parquet", path=folder)


def sliding_alerts(
    events: DataFrame, arrival: str | None = None, time: str = "poll_timestamp", rule: AnomalyRule = AnomalyRule()
) -> DataFrame:
    """The stream of alert documents: each as it is first due, and again when an event that was out of
    order changes it. Adding events never ends an alert, so nothing has to be taken back."""
    numbers = [F.col(c).cast("double").alias(c) for c in VALUES]
    rows = prepared(events, time, arrival).select("city_id", "at_us", "arrived_us", *numbers)
    processor = SlidingWindows(micros(ALERT_WINDOW), micros(ORDER_TOLERANCE), micros("1 minute"))
    windows = rows.groupBy("city_id").transformWithStateInPandas(processor, SWEPT, "Append", "None")
    windows = windows.withColumn("window_max_aqi", F.col("window_max_aqi").cast("int"))
    return rule.apply(windows.withColumn("detected_at", F.timestamp_micros("_end")))


def stateful_alerts_job(
    events: DataFrame,
    table: str,
    checkpoint: str,
    arrival: str | None = None,
    every: str | None = ALERT_TRIGGER,
    state_partitions: int | None = None,
) -> StreamingQuery:
    """Keeps a change table of alerts up to date (``sources.changes``); a batch writes what it changes."""
    with_rocksdb(events)
    handle = append_each(table)
    return start(
        sliding_alerts(events, arrival), checkpoint, handle, "append", every, "stateful_alerts", state_partitions
    )


def with_rocksdb(df: DataFrame) -> None:
    """Map and list state live in RocksDB only; a query takes the setting when it starts."""
    df.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
