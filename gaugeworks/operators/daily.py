"""Daily statistics per city and the trailing seven-day mean."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gaugeworks.functions.stats import Stat, count, maximum, mean, minimum, raw_parts, results
from gaugeworks.functions.times import resolve_run_date, trailing_start
from gaugeworks.schemas import GOLD, conform

TRAILING_DAYS = 7


def daily_stats_columns() -> list[Stat]:
    return [
        mean("temp", "avg_temp"),
        minimum("temp", "min_temp"),
        maximum("temp", "max_temp"),
        mean("humidity", "avg_humidity"),
        mean("aqi", "avg_aqi"),
        maximum("aqi", "max_aqi"),
        mean("pm2_5", "avg_pm2_5"),
        mean("pm10", "avg_pm10"),
        count("observation_count"),
    ]


def daily_stats(
    df: DataFrame, keys: tuple[str, ...] = ("city_id",), day: str = "ingestion_date", stats: list[Stat] | None = None
) -> DataFrame:
    """One row per key and day."""
    stats = stats or daily_stats_columns()
    return df.groupBy(*keys, F.col(day).alias("date")).agg(*[s.aggregate() for s in stats])


def trailing_mean(
    df: DataFrame,
    column: str,
    name: str,
    keys: tuple[str, ...] = ("city_id",),
    day: str = "ingestion_date",
    days: int = TRAILING_DAYS,
) -> DataFrame:
    """For every key and day with data, the mean over all rows of that day and the days before it.

    Rows count equally, so this is not a mean of daily means: daily sums and counts are added up.
    The frame runs over one row per key and day.
    """
    stat = mean(column, name)
    per_day = df.groupBy(*keys, F.col(day).alias("date")).agg(*raw_parts([stat]))
    frame = Window.partitionBy(*keys).orderBy(F.unix_date("date")).rangeBetween(1 - days, 0)
    summed = per_day.select(*keys, "date", *[F.sum(n).over(frame).alias(n) for n, _, _ in stat.parts()])
    return summed.select(*keys, "date", *results([stat]))


def gold_day(silver: DataFrame, run_date: str | date) -> DataFrame:
    """Gold rows of one day from a single scan of the trailing week and a single shuffle: the day's
    statistics look only at rows of that day, the rolling mean at all. Cities silent on the day get
    no row."""
    day, start = resolve_run_date(run_date), trailing_start(run_date, TRAILING_DAYS)
    on_day = F.col("ingestion_date") == F.lit(day)
    stats = daily_stats_columns()
    week = silver.filter(F.col("ingestion_date").between(F.lit(start), F.lit(day)))
    rows = (
        week.groupBy("city_id")
        .agg(
            *[s.aggregate(on_day) for s in stats],
            mean("temp", "rolling_7day_avg_temp").aggregate(),
        )
        .filter(F.col("observation_count") > 0)
        .withColumn("date", F.lit(day))
    )
    return conform(rows, GOLD)


def gold_day_joined(silver: DataFrame, run_date: str | date) -> DataFrame:
    """The same rows in two passes: the day's statistics, left-joined to the week's mean."""
    day, start = resolve_run_date(run_date), trailing_start(run_date, TRAILING_DAYS)
    stats = daily_stats(
        silver.filter(F.col("ingestion_date") == F.lit(day)), stats=daily_stats_columns()
    )
    rolling = (
        silver.filter(F.col("ingestion_date").between(F.lit(start), F.lit(day)))
        .groupBy("city_id")
        .agg(mean("temp", "rolling_7day_avg_temp").aggregate())
    )
    return conform(stats.join(rolling, "city_id", "left"), GOLD)


def gold_range(silver: DataFrame, first: str | date, last: str | date) -> DataFrame:
    """Gold rows for every day of a range (a backfill) in one pass over the data: one row per city
    and day is aggregated, and the trailing week is a frame over those."""
    first_day, last_day = resolve_run_date(first), resolve_run_date(last)
    stats = daily_stats_columns()
    rolling = mean("temp", "rolling_7day_avg_temp")
    per_day = (
        silver.filter(F.col("ingestion_date").between(F.lit(trailing_start(first_day, TRAILING_DAYS)), F.lit(last_day)))
        .groupBy("city_id", F.col("ingestion_date").alias("date"))
        .agg(*raw_parts([*stats, rolling]))
    )
    frame = Window.partitionBy("city_id").orderBy(F.unix_date("date")).rangeBetween(1 - TRAILING_DAYS, 0)
    for name, _, _ in rolling.parts():
        per_day = per_day.withColumn(name, F.sum(name).over(frame))
    rows = per_day.filter(F.col("date") >= F.lit(first_day)).select("city_id", "date", *results([*stats, rolling]))
    return conform(rows, GOLD)
