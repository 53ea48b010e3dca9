"""Event-time helpers. The session time zone must be UTC (see ``session.pin_utc``)."""

from __future__ import annotations

from datetime import date, datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_UNIT_SECONDS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400}


def micros(duration: str | timedelta) -> int:
    """A duration such as ``"15 minutes"`` in microseconds."""
    if isinstance(duration, timedelta):
        return duration // timedelta(microseconds=1)
    amount, unit = duration.split()
    return int(amount) * _UNIT_SECONDS[unit.rstrip("s")] * 1_000_000


def epoch_micros(column: str | Column) -> Column:
    """Microseconds since 1970 of a zoned or plain timestamp column."""
    column = F.col(column) if isinstance(column, str) else column
    return F.unix_micros(column.cast("timestamp"))


def as_time(value: Column, df: DataFrame, like: str) -> Column:
    """Microseconds back to the timestamp type of ``df[like]``."""
    return F.timestamp_micros(value).cast(df.schema[like].dataType)


def floor_to(value: Column, step: int) -> Column:
    """The largest multiple of ``step`` not above ``value``; whole-number arithmetic throughout."""
    return value - F.pmod(value, F.lit(step))


def epoch_seconds(column: str | Column) -> Column:
    column = F.col(column) if isinstance(column, str) else column
    return F.unix_seconds(column.cast("timestamp"))


def resolve_run_date(run_date: str | date | None = None) -> date:
    """The day to process: the given one, or today in UTC when none is given."""
    if not run_date:
        return datetime.now(timezone.utc).date()
    return run_date if isinstance(run_date, date) else date.fromisoformat(run_date)


def trailing_start(run_date: str | date | None, days: int = 7) -> date:
    """First day of the window of ``days`` days that ends with ``run_date``."""
    return resolve_run_date(run_date) - timedelta(days=days - 1)
