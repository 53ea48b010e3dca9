"""The daily batch: raw events to bronze, silver and gold."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from gaugeworks.functions.times import resolve_run_date, trailing_start
from gaugeworks.operators import daily, gate
from gaugeworks.operators.flatten import is_no_json
from gaugeworks.schemas import CORRUPT
from gaugeworks.session import pin_utc
from gaugeworks.sources.lake import read_days, read_raw_days
from gaugeworks.sources.sinks import clear_days, days_of, replace_days, upsert


@dataclass(frozen=True)
class Paths:
    raw: str
    bronze: str
    silver: str
    quarantine: str
    gold: str
    unreadable: str

    @classmethod
    def under(cls, root: str) -> Paths:
        names = ("raw", "bronze", "silver", "quarantine", "gold", "unreadable")
        return cls(*[f"{root.rstrip('/')}/{n}" for n in names])


@dataclass(frozen=True)
class StageResult:
    stage: str
    status: str
    counters: dict[str, int] = field(default_factory=dict)


Day = str | date | None


def _days(run_date: Day, through: Day) -> tuple[date, date]:
    first = resolve_run_date(run_date)
    return first, resolve_run_date(through) if through else first


def bronze(spark: SparkSession, paths: Paths, run_date: Day = None, through: Day = None) -> StageResult:
    """Lands raw events as Parquet. A value of the wrong type is null, its event stays. Lines that are no
    JSON go to a folder of their own, under the same day; they cost a second scan only when there are
    any."""
    first, last = _days(run_date, through)
    raw = read_raw_days(spark, paths.raw, first, last)
    if raw is None or raw.isEmpty():
        return StageResult("bronze", "zero_events")
    readable = ~is_no_json(CORRUPT)
    seen = Observation()
    lines = raw.observe(seen, F.count(F.lit(1)).alias("rows_in"), F.count_if(~readable).alias("unreadable"))
    written = replace_days(lines.filter(readable).drop(CORRUPT), paths.bronze, first, last)
    counters = dict(seen.get) | {"rows_out": written["rows"]}
    # All columns are kept: a reader that skips some would not notice what is wrong with them.
    bad = raw.filter(~readable).withColumnRenamed(CORRUPT, "line").withColumn("reason", F.lit("unreadable line"))
    _set_aside(bad, paths.unreadable, first, last, counters["unreadable"])
    return StageResult("bronze", "written", counters)


def _set_aside(bad: DataFrame, path: str, first: date, last: date, rows: int) -> None:
    if rows:
        replace_days(bad, path, first, last)
    else:
        clear_days(bad, path, first, last)


def silver(spark: SparkSession, paths: Paths, run_date: Day = None, through: Day = None) -> StageResult:
    """Cleans bronze. Counters come out of the writing job itself; ``rows_in`` and ``quarantined`` are
    taken before the shuffle, where a lost executor can make a repeated task count again."""
    first, last = _days(run_date, through)
    landed = read_days(spark, paths.bronze, first, last)
    if landed is None or landed.isEmpty():
        return StageResult("silver", "zero_rows")
    converted = gate.convert(landed)
    gate.check_columns(converted)
    seen = Observation()
    counted = converted.observe(
        seen, F.count(F.lit(1)).alias("rows_in"), F.count_if(gate.is_incomplete()).alias("quarantined")
    )
    good, _ = gate.split_required(counted)
    rows = gate.to_silver(good)
    if first != last:
        # Otherwise each task would write a file for each day. Large days are split, small ones merged.
        rows = rows.hint("rebalance", "ingestion_date")
    written = replace_days(rows, paths.silver, first, last)
    counters = dict(seen.get) | {"rows_out": written["rows"]}
    counters["good"] = counters["rows_in"] - counters["quarantined"]
    counters["duplicates_removed"] = counters["good"] - counters["rows_out"]
    _, bad = gate.split_required(converted)
    _set_aside(gate.with_reason(bad), paths.quarantine, first, last, counters["quarantined"])
    return StageResult("silver", "written", counters)


def gold(spark: SparkSession, paths: Paths, run_date: Day = None, through: Day = None) -> StageResult:
    """Aggregates silver by city and day and merges it into gold."""
    first, last = _days(run_date, through)
    history = read_days(spark, paths.silver, trailing_start(first), last)
    if history is None or history.filter(F.col("ingestion_date") >= F.lit(first)).isEmpty():
        return StageResult("gold", "zero_rows")
    rows = daily.gold_day(history, first) if first == last else daily.gold_range(history, first, last)
    touched = sorted(days_of(first, last))
    merged = upsert(rows, paths.gold, ["city_id", "date"], "date", cluster=["city_id"], partitions=touched)
    return StageResult("gold", "merged", {"rows_merged": merged})


def run_daily(spark: SparkSession, paths: Paths, run_date: Day = None, through: Day = None) -> list[StageResult]:
    """The three stages for one day, each only after the one before found something to do.

    With ``through`` the days run_date..through are handled together, one job per stage, with the
    same result as day by day; meant for backfills.
    """
    pin_utc(spark)
    first, last = _days(run_date, through)
    results: list[StageResult] = []
    for stage in (bronze, silver, gold):
        results.append(stage(spark, paths, first, last))
        if results[-1].status.startswith("zero"):
            break
    return results


def status_frame(spark: SparkSession, results: list[StageResult]) -> DataFrame:
    """Stage results as rows, for a run log."""
    return spark.createDataFrame(
        [(r.stage, r.status, r.counters) for r in results], "stage STRING, status STRING, counters MAP<STRING, BIGINT>"
    )
