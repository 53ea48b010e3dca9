"""The ingest job: recorded API answers to published events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeworks.operators import flatten, responses
from gaugeworks.session import pin_utc
from gaugeworks.sources import lake, sinks


def ingest(
    spark: SparkSession,
    recorded: str,
    target: str,
    aside: str,
    cities: DataFrame | None = None,
    servers: str | None = None,
) -> DataFrame:
    """Pairs the answers of each city and cycle, makes events of them and publishes those.

    ``recorded`` is a folder of JSON answers, ``target`` a topic, or a folder if there are no servers.
    Pairs with an unreadable payload are appended to ``aside`` by day with their texts and a reason, so
    that one bad answer stops nothing. Gives the summary of each poll cycle.
    """
    log = lake.read_responses(pin_utc(spark), recorded)
    named = flatten.with_city(flatten.pair_payloads(log), lake.read_cities(spark) if cities is None else cities)
    sinks.publish(flatten.flatten(named), target, servers)
    bad = flatten.malformed(named).withColumn("ingestion_date", F.to_date("poll_timestamp"))
    bad.write.mode("append").partitionBy("ingestion_date").json(aside)
    return responses.poll_summary(log)
