"""Queries behind reports and tiles."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeworks.operators.keep import first_per_key

TREND_DAYS = 30


def trend(gold: DataFrame, as_of: str | date | None = None, days: int = TREND_DAYS) -> DataFrame:
    """Daily averages from ``days`` before ``as_of`` (default: today in UTC), by city and date."""
    today = F.current_date() if as_of is None else F.lit(as_of).cast("date")
    return (
        gold.filter(F.col("date") >= F.date_sub(today, days))
        .select("city_id", "date", "avg_temp", "avg_aqi", "rolling_7day_avg_temp")
        .orderBy("city_id", "date")
    )


def alerts_for_city(alerts: DataFrame, city_id: str) -> DataFrame:
    return alerts.filter(F.col("city_id") == city_id)


def recent_alerts(
    alerts: DataFrame, since: str | datetime | None = None, until: str | datetime | None = None, newest: int | None = None
) -> DataFrame:
    """Alerts of a time range, newest first, ties by id; all of them, or the ``newest`` so many. With a
    number each task keeps that many and one task merges them, so the range is not sorted."""
    kept = alerts
    for bound, keep in ((since, lambda c, b: c >= b), (until, lambda c, b: c < b)):
        if bound is not None:
            kept = kept.filter(keep(F.col("detected_at"), F.lit(bound).cast(alerts.schema["detected_at"].dataType)))
    listed = kept.orderBy(F.col("detected_at").desc(), "id")
    return listed if newest is None else listed.limit(newest)


def current_readings(events: DataFrame, time: str = "poll_timestamp", ties: tuple[str, ...] = ()) -> DataFrame:
    """Temperature and air index of each city's latest event."""
    order = [F.col(time).desc(), *ties, "temp", "aqi"]
    return first_per_key(events.select("city_id", time, "temp", "aqi", *ties), ["city_id"], order).drop(*ties)


def sparkline(rolling: DataFrame, value: str = "avg_temp", end: str = "window_end_time") -> DataFrame:
    """The rolling average of each city as one ordered series per day. A day holds a fixed number of
    windows, so a series stays small however long the history is."""
    point = F.struct(F.col(end).alias("at"), F.col(value).alias("value"))
    return rolling.groupBy("city_id", F.to_date(end).alias("date")).agg(
        F.sort_array(F.collect_list(point)).alias("points")
    )
