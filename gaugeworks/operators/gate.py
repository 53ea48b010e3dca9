"""From bronze to silver: conversion, the required-field gate, counters."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeworks.operators.keep import deduplicate
from gaugeworks.schemas import CRITICAL_FIELDS, SILVER, SILVER_REQUIRED, conform


class SchemaValidationError(Exception):
    """A required column is missing from the whole batch: the producer and the schema disagree."""


def convert(bronze: DataFrame) -> DataFrame:
    """Adds the observation time and types the date. Runs before the gate, which checks both."""
    return bronze.withColumn("observation_timestamp", F.timestamp_seconds("dt")).withColumn(
        "ingestion_date", F.to_date("ingestion_date")
    )


def is_incomplete(required: tuple[str, ...] = SILVER_REQUIRED) -> Column:
    return reduce(or_, [F.col(c).isNull() for c in required])


def check_columns(df: DataFrame, required: tuple[str, ...] = SILVER_REQUIRED) -> None:
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise SchemaValidationError(f"required column(s) missing from the batch: {missing}")


def split_required(df: DataFrame, required: tuple[str, ...] = SILVER_REQUIRED) -> tuple[DataFrame, DataFrame]:
    """(complete rows, rows lacking a required value). Together they are exactly the input."""
    check_columns(df, required)
    return df.filter(~is_incomplete(required)), df.filter(is_incomplete(required))


def with_reason(bad: DataFrame, required: tuple[str, ...] = SILVER_REQUIRED) -> DataFrame:
    """Names the missing values of a quarantined row."""
    missing = [F.when(F.col(c).isNull(), F.lit(c)) for c in required]
    return bad.withColumn("reason", F.concat(F.lit("missing "), F.concat_ws(",", *missing)))


def to_silver(good: DataFrame, across_days: bool = False, order: tuple[str, ...] = ("poll_timestamp",)) -> DataFrame:
    """Complete rows, one per city and observation, with the silver columns.

    A run handles one ingestion date, so an observation polled on both sides of midnight stays twice
    when days are processed apart. ``across_days=False`` gives that result for several days at once.
    Only silver columns and the order are read: rows equal in those are interchangeable, and the raw
    payload, by far the widest bronze column, stays out of the scan and the shuffle.
    """
    keys = ("city_id", "observation_timestamp") + (() if across_days else ("ingestion_date",))
    needed = [*SILVER.fieldNames(), *[c for c in order if c not in SILVER.fieldNames()]]
    return conform(deduplicate(good.select(*needed), keys, order), SILVER)


def quality_counters(
    bronze: DataFrame, required: tuple[str, ...] = SILVER_REQUIRED, by: tuple[str, ...] = ("ingestion_date",)
) -> DataFrame:
    """Rows in, quarantined, kept and duplicate per batch, in one pass.

    Rows are counted per observation first, so duplicates need no distinct count of their own.
    """
    converted = convert(bronze)
    check_columns(converted, required)
    keys = ["city_id", "observation_timestamp", *[b for b in by if b not in ("city_id", "observation_timestamp")]]
    bad = is_incomplete(required)
    per_key = converted.groupBy(*keys).agg(F.count("*").alias("_n"), F.count_if(bad).alias("_bad"))
    counted = per_key.groupBy(*by).agg(
        F.sum("_n").alias("rows_in"),
        F.sum("_bad").alias("quarantined"),
        F.sum(F.col("_n") - F.col("_bad")).alias("good"),
        F.count_if(F.col("_n") > F.col("_bad")).alias("after_dedup"),
    )
    return counted.withColumn("duplicates_removed", F.col("good") - F.col("after_dedup")).withColumn(
        "quarantined_pct", F.round(100.0 * F.col("quarantined") / F.col("rows_in"), 1)
    )


def critical_field_warnings(
    events: DataFrame, fields: tuple[str, ...] = CRITICAL_FIELDS, by: tuple[str, ...] = ("city_id",)
) -> DataFrame:
    """How often each critical field is missing, for groups in which any is."""
    missing = [F.count_if(F.col(f).isNull()).alias(f"missing_{f}") for f in fields]
    return (
        events.groupBy(*by)
        .agg(F.count("*").alias("events"), *missing)
        .filter(reduce(or_, [F.col(f"missing_{f}") > 0 for f in fields]))
    )
