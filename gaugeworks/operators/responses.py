"""What became of the API calls of each poll cycle, read from a log of responses."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeworks.functions.stats import count
from gaugeworks.operators.windows import tumbling

# --- Fixed values: retry policy and rate limit of the API ---
RETRYABLE = (429, 500, 502, 503, 504)
MAX_ATTEMPTS = 3
CALLS_PER_MINUTE = 60
ERROR_TEXT_LENGTH = 200


def outcome(status: Column, attempts: Column) -> Column:
    """How a call ended, from the status of its last attempt; no status means a network error."""
    exhausted = attempts >= MAX_ATTEMPTS
    return (
        F.when(status == 200, "ok")
        .when(status.isNull(), F.when(exhausted, "network_error").otherwise("pending_retry"))
        .when(status.isin(*RETRYABLE), F.when(exhausted, "retries_exhausted").otherwise("pending_retry"))
        .when(status == 401, "unauthorized")
        .otherwise("failed_fast")
    )


def response_outcomes(responses: DataFrame) -> DataFrame:
    """One row per cycle, city and endpoint, by all its attempts, however many were made. Only
    fixed-width values are aggregated."""
    return (
        responses.groupBy("cycle_id", "city_id", "endpoint")
        .agg(F.max("attempt").alias("attempts"), F.max_by("status", "attempt").alias("last_status"))
        .withColumn("outcome", outcome(F.col("last_status"), F.col("attempts")))
    )


def failure_details(responses: DataFrame) -> DataFrame:
    """Responses that ended a call at once, with their body and the start of it for a log line. A
    rejected key concerns every city, not only the one it was seen for."""
    status = F.col("status")
    return responses.filter(status.isNotNull() & (status != 200) & ~status.isin(*RETRYABLE)).select(
        "cycle_id",
        "city_id",
        "endpoint",
        "status",
        F.substring("body", 1, ERROR_TEXT_LENGTH).alias("error_text"),
        "body",
        (status == 401).alias("concerns_all_cities"),
    )


def city_polls(responses: DataFrame) -> DataFrame:
    """One row per cycle and city: did both calls succeed?"""

    def last(endpoint: str) -> Column:
        of = F.col("endpoint") == endpoint
        return F.max_by(F.when(of, F.col("status")), F.when(of, F.col("attempt")))

    polled = (
        responses.groupBy("cycle_id", "city_id")
        .agg(F.count("*").alias("calls"), last("weather").alias("_weather"), last("air_pollution").alias("_air"))
    )
    both = F.coalesce((F.col("_weather") == 200) & (F.col("_air") == 200), F.lit(False))
    return polled.select("cycle_id", "city_id", "calls", both.alias("succeeded"))


def poll_summary(responses: DataFrame) -> DataFrame:
    """Cities succeeded out of total per cycle."""
    return (
        city_polls(responses)
        .groupBy("cycle_id")
        .agg(
            F.count("*").alias("cities"),
            F.count_if("succeeded").alias("cities_succeeded"),
            F.count_if(~F.col("succeeded")).alias("cities_failed"),
            F.sum("calls").alias("calls"),
        )
    )


def failed_cities(responses: DataFrame) -> DataFrame:
    """The cities that failed, one row each: a list per cycle would grow with the fleet."""
    return city_polls(responses).filter(~F.col("succeeded")).select("cycle_id", "city_id")


def rate_budget(responses: DataFrame, limit: int = CALLS_PER_MINUTE) -> DataFrame:
    """Calls per minute against the limit."""
    return tumbling(responses, "responded_at", "1 minute", [], [count("calls")], end="minute_end").withColumn(
        "over_budget", F.col("calls") > limit
    )
