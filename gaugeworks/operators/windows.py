"""Time windows per sensor: hopping, tumbling, sliding, and the two event-time adjustments.

Raw rows are aggregated on the map side, per window or per small time slice (pane), before they are
shuffled, and no task is ever given all rows of a sensor: one that sends a third of the data is
spread over windows, panes or spans of time like the rest.
"""

from __future__ import annotations

from collections.abc import Sequence
from math import gcd

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gaugeworks.functions.stats import Stat, combine, merged_parts, part_columns, raw_parts, results
from gaugeworks.functions.times import as_time, epoch_micros, floor_to, micros


def hopping(
    df: DataFrame,
    time: str,
    size: str,
    slide: str,
    keys: Sequence[str],
    stats: Sequence[Stat],
    end: str = "window_end_time",
    closed: str = "left",
    multiplied: int = 8,
) -> DataFrame:
    """Windows of ``size`` that start every ``slide``; one row per key and non-empty window.

    ``closed="left"`` takes events in [start, end), ``"right"`` those in (start, end]. With up to
    ``multiplied`` windows per event, rows are multiplied by the built-in window and combined on the map
    side right away, in one shuffle; with more, panes are aggregated first and multiplied after that.
    Both give the same rows, and which one runs depends on the shape of the windows only.
    """
    at = F.col(time) - F.expr("INTERVAL 1 MICROSECOND") if closed == "right" else F.col(time)
    if micros(slide) <= micros(size) <= multiplied * micros(slide):
        windows = df.groupBy(*keys, F.window(at, size, slide).alias("_window")).agg(*raw_parts(stats))
        return windows.select(*keys, *results(stats), F.col("_window.end").alias(end))
    return _hopping_by_panes(df, at, time, micros(size), micros(slide), keys, stats, end)


def _hopping_by_panes(df, at: Column, time: str, size: int, slide: int, keys, stats, end: str) -> DataFrame:
    pane = gcd(size, slide)
    panes = (
        df.filter(F.col(time).isNotNull())
        .groupBy(*keys, floor_to(epoch_micros(at), pane).alias("_pane"))
        .agg(*raw_parts(stats))
    )
    x = F.col("_pane")
    first, last = floor_to(x - size, slide) + slide, floor_to(x, slide)
    if slide > size:
        panes = panes.filter(first <= last)  # panes in the gap between two windows
    windows = (
        panes.withColumn("_start", F.explode(F.sequence(first, last, F.lit(slide).cast("long"))))
        .groupBy(*keys, "_start")
        .agg(*merged_parts(stats))
    )
    return windows.select(*keys, *results(stats), as_time(F.col("_start") + size, df, time).alias(end))


def tumbling(df: DataFrame, time: str, size: str, keys: Sequence[str], stats: Sequence[Stat], **named) -> DataFrame:
    """Windows that neither overlap nor leave gaps."""
    return hopping(df, time, size, size, keys, stats, **named)


def sliding(
    df: DataFrame,
    time: str,
    size: str,
    keys: Sequence[str],
    stats: Sequence[Stat],
    end: str = "window_end_time",
    splits: int = 15,
) -> DataFrame:
    """One row per key and instant at which an event enters or leaves the window (t - size, t].

    Works on instants, with events of equal key and time combined first. Time is cut into panes of
    ``size / splits``. For an evaluation at t in pane p the window consists of

    * the events of pane p up to t: a running aggregate over the pane, in time order;
    * all of panes p - splits + 1 .. p - 1: one row at the start of pane p, see ``_earlier_panes``;
    * the events of pane p - splits after t - size. An event at s leaves at s + size, which lies in
      pane p, so these are the leave rows of pane p later than t: a running aggregate in reverse.

    Work is linear in the number of instants. The largest task holds one key and one pane, at most
    one enter and one leave row for each tick of the clock, however many events the key has.
    """
    size = micros(size)
    if size % splits:
        raise ValueError("splits must divide the window size")
    width = size // splits
    keys, counted = list(keys), [*stats, Stat("_events", "count")]
    parts = part_columns(counted)

    instants = (
        df.filter(F.col(time).isNotNull()).groupBy(*keys, epoch_micros(time).alias("_at")).agg(*raw_parts(counted))
    )
    carried = [F.col(name) for name, _ in parts]
    enter = F.struct(F.col("_at"), F.lit(_ENTER).alias("_kind"))
    leave = F.struct((F.col("_at") + size).alias("_at"), F.lit(_LEAVE).alias("_kind"))
    rows = (
        instants.select(*keys, *carried, F.explode(F.array(enter, leave)).alias("_c"))
        .select(*keys, "_c.*", *carried)
        .withColumn("_pane", floor_to(F.col("_at"), width))
    )
    if splits > 1:
        rows = rows.unionByName(_earlier_panes(instants, keys, parts, width, splits))

    pane = Window.partitionBy(*keys, "_pane")
    until_now = pane.orderBy("_at").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    same_time = pane.orderBy("_at").rangeBetween(Window.currentRow, Window.currentRow)
    after_now = pane.orderBy(F.col("_at").desc()).rangeBetween(Window.unboundedPreceding, -1)
    entered, leaving = F.col("_kind") != _LEAVE, F.col("_kind") == _LEAVE

    def over(how, name, which, frame):
        return getattr(F, how)(F.when(which, F.col(name))).over(frame)

    swept = rows.select(
        *keys,
        "_at",
        "_kind",
        F.count_if(F.col("_kind") == _ENTER).over(same_time).alias("_arrivals"),
        *[over(how, name, entered, until_now).alias(f"{name}_a") for name, how in parts],
        *[over(how, name, leaving, after_now).alias(f"{name}_b") for name, how in parts],
    )
    # An instant at which one event enters and another leaves is one evaluation, not two.
    evaluated = swept.filter((F.col("_kind") == _ENTER) | (leaving & (F.col("_arrivals") == 0)))
    merged = evaluated.select(
        *keys,
        "_at",
        *[combine(how, [F.col(f"{name}_a"), F.col(f"{name}_b")]).alias(name) for name, how in parts],
    ).filter(F.col("__events") > 0)
    return merged.select(*keys, *results(stats), as_time(F.col("_at"), df, time).alias(end))


_ENTER, _LEAVE, _EARLIER = 0, 1, 2


def _earlier_panes(instants: DataFrame, keys: list[str], parts, width: int, splits: int) -> DataFrame:
    """For every pane with a change, the merged parts of the ``splits - 1`` panes before it, as one
    row dated at the start of the pane.

    Panes are grouped into spans so that a long history spreads over tasks: a span holds at most
    ``96 * splits`` panes of a key. A pane whose reach ends in the next span is copied there.
    """
    span, reach = width * splits * 96, width * (splits - 1)
    panes = instants.groupBy(*keys, floor_to(F.col("_at"), width).alias("_pane")).agg(
        *[getattr(F, how)(name).alias(name) for name, how in parts]
    )
    pane = F.col("_pane")
    left = pane + width * splits

    def row(at, in_span, role, filled):
        values = [(F.col(n) if filled else F.lit(None)).alias(n) for n, _ in parts]
        return F.struct(at.alias("_pane"), floor_to(in_span, span).alias("_span"), F.lit(role).alias("_role"), *values)

    spread = (
        panes.select(
            *keys,
            F.explode(
                F.array(
                    row(pane, pane, _ENTER, True),
                    row(left, left, _LEAVE, False),
                    row(pane, pane + reach, _EARLIER, True),
                )
            ).alias("_r"),
        )
        .select(*keys, "_r.*")
        .filter((F.col("_role") != _EARLIER) | (F.col("_span") > pane))
    )
    in_span = Window.partitionBy(*keys, "_span").orderBy("_pane")
    before = in_span.rangeBetween(-reach, -width)
    here = in_span.rangeBetween(Window.currentRow, Window.currentRow)
    return (
        spread.select(
            *keys,
            "_pane",
            "_role",
            F.count_if(F.col("_role") == _ENTER).over(here).alias("_filled"),
            *[getattr(F, how)(name).over(before).alias(name) for name, how in parts],
        )
        .filter((F.col("_role") == _ENTER) | ((F.col("_role") == _LEAVE) & (F.col("_filled") == 0)))
        .filter(F.col("__events") > 0)
        .select(*keys, pane.alias("_at"), F.lit(_EARLIER).alias("_kind"), *[F.col(n) for n, _ in parts], "_pane")
    )


def adjust_late(df: DataFrame, time: str, arrival: str, tolerance: str = "5 minutes", into: str | None = None) -> DataFrame:
    """Event times older than ``tolerance`` at arrival are moved up to that limit, not dropped. A row
    without a time gets none."""
    return df.withColumn(into or time, as_time(moved_up(time, epoch_micros(arrival) - micros(tolerance)), df, time))


def moved_up(time: str, limit: Column) -> Column:
    """The later of an event's time and a limit, in microseconds; null for an event without a time."""
    return F.when(F.col(time).isNotNull(), F.greatest(epoch_micros(time), limit))


def adjust_out_of_order(
    df: DataFrame,
    time: str,
    arrival: str,
    keys: Sequence[str],
    tolerance: str = "30 seconds",
    into: str | None = None,
    span: str = "1 minute",
    seen: DataFrame | None = None,
) -> DataFrame:
    """Event times that trail the key's latest earlier-arrived event by more than ``tolerance`` are
    moved up to that limit. Events arriving at the same instant count as sorted by event time.

    The limit depends only on key and arrival instant, so it is computed on one row per instant: a
    running maximum inside each ``span`` of arrival time that starts from the maximum of all spans
    before it. Only instants at which some event really moves are joined back to the rows; how that
    join runs is left to the planner, which broadcasts only below its size limit and splits a skewed
    key. ``seen`` may hold, per key, the latest event time (``_seen``, microseconds) of rows handled
    before this frame.
    """
    keys, tolerance, width, target = list(keys), micros(tolerance), micros(span), into or time
    instants = (
        df.groupBy(*keys, epoch_micros(arrival).alias("_arrived"))
        .agg(F.max(epoch_micros(time)).alias("_max"), F.min(epoch_micros(time)).alias("_min"))
        .withColumn("_span", floor_to(F.col("_arrived"), width))
    )
    # Both uses of the instants need the same columns, so that Spark computes them once.
    spans = instants.groupBy(*keys, "_span").agg(F.max("_max").alias("_max"), F.min("_min").alias("_min"))
    if seen is not None:
        before_all = seen.select(*keys, F.lit(-(2**62)).alias("_span"), F.col("_seen").alias("_max"))
        spans = spans.unionByName(before_all.withColumn("_min", F.col("_max")))
    earlier_spans = Window.partitionBy(*keys).orderBy("_span").rowsBetween(Window.unboundedPreceding, -1)
    carried = spans.select(
        *keys,
        F.col("_span").alias("_arrived"),
        F.max("_max").over(earlier_spans).alias("_max"),
        "_min",
        "_span",
        F.lit(False).alias("_real"),
    )
    before = (
        Window.partitionBy(*keys, "_span").orderBy("_arrived", "_real").rowsBetween(Window.unboundedPreceding, -1)
    )
    moved = (
        instants.withColumn("_real", F.lit(True))
        .unionByName(carried)
        .withColumn("_limit", F.max("_max").over(before) - tolerance)
        .filter(F.col("_real") & (F.col("_limit") > F.col("_min")))
        .select(*[F.col(k).alias(f"_k_{k}") for k in keys], F.col("_arrived").alias("_k_arrived"), "_limit")
    )
    same = epoch_micros(arrival) == F.col("_k_arrived")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    adjusted = as_time(moved_up(time, F.col("_limit")), df, time)
    columns = df.columns if target in df.columns else [*df.columns, target]
    return df.join(moved, same, "left").withColumn(target, adjusted).select(*columns)
