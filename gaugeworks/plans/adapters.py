"""Readings and logs of the sensor domain, derived from general-purpose tables.

Only expressions that both engines of a comparison can state are used, and every row of the input
table is kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeworks.session import pin_utc


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return pin_utc(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def sensor_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as readings of twelve cities; every fifth reading lacks its temperature."""
    k = F.get_json_object("props", "$.k").cast("int")
    return table(spark, sf_dir, "events").select(
        "event_id",
        F.concat(F.lit("city_"), (F.col("user_id") % 12).cast("string")).alias("city_id"),
        F.col("ts").alias("poll_timestamp"),
        (F.floor(F.unix_seconds(F.col("ts").cast("timestamp")) / 600) * 600).cast("long").alias("dt"),
        F.when(F.col("event_type") != "error", F.col("value")).alias("temp"),
        k.alias("humidity"),
        (k % 5 + 1).cast("int").alias("aqi"),
        (F.col("value") / 10).alias("pm2_5"),
        (F.col("value") / 5).alias("pm10"),
        F.to_date("ts").alias("ingestion_date"),
        (F.col("ts") + F.make_dt_interval(mins=k % 10)).alias("arrival_ts"),
        "event_type",
    )


def weather_text() -> Column:
    """A weather payload per event. Coordinates are given, missing, null, or half null, by turns."""
    k = F.col("humidity")
    lat, lon = F.col("event_id") % 90, F.col("event_id") % 180
    coord = (
        F.when(k % 4 == 0, F.format_string('"coord":{"lat":%d.5,"lon":%d.25},', lat, lon))
        .when(k % 4 == 1, F.lit(""))
        .when(k % 4 == 2, F.lit('"coord":null,'))
        .otherwise(F.format_string('"coord":{"lat":null,"lon":%d.25},', lon))
    )
    sky = F.when(k % 5 == 0, F.lit("[]")).otherwise(
        F.concat(F.lit('[{"main":"'), "event_type", F.lit('","description":"'), F.upper("event_type"), F.lit('"}]'))
    )
    temp = F.coalesce(F.col("temp").cast("string"), F.lit("null"))
    extra = F.when(F.col("event_type") == "view", F.lit(',"uvi":{"now":3}')).otherwise(F.lit(""))
    return F.concat(
        F.lit("{"),
        coord,
        F.lit('"weather":'),
        sky,
        F.lit(',"main":{"temp":'),
        temp,
        F.lit(',"humidity":'),
        k.cast("string"),
        F.lit('},"dt":'),
        F.col("dt").cast("string"),
        extra,
        F.lit("}"),
    )


def air_text() -> Column:
    """An air payload per event; the index is written as 4.0, and every tenth list is empty."""
    filled = F.concat(
        F.lit('{"coord":[50.0,50.0],"list":[{"main":{"aqi":'),
        F.col("aqi").cast("string"),
        F.lit('.0},"components":{"pm2_5":'),
        F.col("pm2_5").cast("string"),
        F.lit(',"pm10":'),
        F.col("pm10").cast("string"),
        F.lit("}}]}"),
    )
    return F.when(F.col("humidity") % 10 == 9, F.lit('{"list":[]}')).otherwise(filled)


def payload_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One pair of payload texts per event; every hundredth weather payload is cut off."""
    weather = F.when(F.col("event_id") % 100 == 99, F.lit('{"coord":{"lat":1.0')).otherwise(weather_text())
    return sensor_events(spark, sf_dir).select(
        "event_id",
        F.concat(F.lit("city_"), F.col("event_id").cast("string")).alias("city_id"),
        "poll_timestamp",
        weather.alias("weather"),
        air_text().alias("air_pollution"),
    )


def drifting_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payloads with fields that no column is made from: below seven levels for purchases, only in the
    second list element for clicks, among elements of several kinds for some errors."""
    kind = F.col("event_type")
    deep = F.lit(',"deep":{"a":{"b":{"c":{"d":{"e":{"f":1}}}}}}}')
    whole = weather_text()
    weather = F.when(kind == "purchase", F.concat(F.substring(whole, 1, F.length(whole) - 1), deep)).otherwise(whole)
    second = F.when(kind == "click", F.lit(',{"late":{"by":1}}]}')).when(
        (kind == "error") & (F.col("humidity") % 10 == 5), F.lit(',7,null,[{"odd":1}]]}')
    )
    air, filled = air_text(), F.col("humidity") % 10 != 9
    listed = F.when(filled & second.isNotNull(), F.concat(F.substring(air, 1, F.length(air) - 2), second)).otherwise(air)
    return sensor_events(spark, sf_dir).select("city_id", "poll_timestamp", weather.alias("weather"), listed.alias("air_pollution"))


def changing_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A weather payload per event, some unlike what is declared: the time is a text for signups, the visibility
    a list for some clicks, and every hundredth payload is cut off."""
    kind, whole = F.col("event_type"), weather_text()
    quoted = F.regexp_replace(whole, r'"dt":(\d+)', r'"dt":"$1"')
    listed = F.concat(F.substring(whole, 1, F.length(whole) - 1), F.lit(',"visibility":[1]}'))
    text = (
        F.when(F.col("event_id") % 100 == 99, F.lit('{"coord":{"lat":1.0'))
        .when(kind == "signup", quoted)
        .when((kind == "click") & (F.col("humidity") % 10 == 5), listed)
        .otherwise(whole)
    )
    return sensor_events(spark, sf_dir).select("ingestion_date", text.alias("weather"))


def response_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Attempts of a fleet of a hundred cities, one city and cycle per event. The kind of event tells
    how its two calls went."""
    calls = {
        "click": [("weather", [200]), ("air_pollution", [200])],
        "view": [("weather", [429, 200]), ("air_pollution", [503, 500, 200])],
        "purchase": [("weather", [200]), ("air_pollution", [500, 502, 504, 200])],
        "signup": [("weather", [None, None, None]), ("air_pollution", [500, 502, 504])],
        "error": [("weather", [401])],
    }
    attempts = None
    for kind, endpoints in calls.items():
        rows = [
            F.struct(
                F.lit(endpoint).alias("endpoint"),
                F.lit(n).cast("int").alias("attempt"),
                F.lit(status).cast("int").alias("status"),
            )
            for endpoint, statuses in endpoints
            for n, status in enumerate(statuses, 1)
        ]
        chosen = F.col("event_type") == kind
        attempts = F.when(chosen, F.array(*rows)) if attempts is None else attempts.when(chosen, F.array(*rows))
    message = F.repeat(F.lit("no "), 90)
    failed = F.concat(
        F.lit('{"cod":'), F.col("c.status").cast("string"), F.lit(',"message":"'), message, F.lit('"}')
    )
    body = (
        F.when((F.col("c.status") == 200) & (F.col("c.endpoint") == "weather"), weather_text())
        .when(F.col("c.status") == 200, air_text())
        .otherwise(failed)
    )
    return (
        sensor_events(spark, sf_dir)
        .withColumn("c", F.explode(attempts))
        .select(
            "event_id",
            F.floor(F.col("event_id") / 100).alias("cycle_id"),
            F.concat(F.lit("city_"), (F.col("event_id") % 100).cast("string")).alias("city_id"),
            "c.endpoint",
            "c.attempt",
            "c.status",
            body.alias("body"),
            F.col("poll_timestamp").alias("responded_at"),
        )
    )


def city_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations as cities."""
    return table(spark, sf_dir, "nation").select(
        F.concat(F.lit("city_"), F.col("n_nationkey").cast("string")).alias("city_id"),
        F.col("n_name").alias("name"),
        (F.col("n_nationkey") + F.lit(0.5)).alias("lat"),
        (F.col("n_regionkey") + F.lit(0.25)).alias("lon"),
    )


def broker_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("event_type")
    return table(spark, sf_dir, "events").select(
        F.col("ts").alias("TimeGenerated"),
        F.when(kind == "signup", "OTHER").otherwise("MICROSOFT.EVENTHUB").alias("ResourceProvider"),
        F.when(kind.isin("view", "click"), "ConsumerLag").otherwise(kind).alias("ActivityName_s"),
        F.element_at(
            F.array(F.lit("$Default"), F.lit("stream-analytics-local-emulation"), F.lit("other")),
            (F.col("user_id") % 3 + 1).cast("int"),
        ).alias("ChildEntityName_s"),
        F.concat(F.lit("hub_"), (F.col("user_id") % 5).cast("string")).alias("EntityName_s"),
        (F.col("user_id") % 4).cast("string").alias("PartitionId_s"),
        (F.col("value") * 10).alias("Count_d"),
    )


def metric_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("event_type")
    return table(spark, sf_dir, "events").select(
        F.col("ts").alias("TimeGenerated"),
        F.when(kind == "signup", "OTHER").otherwise("MICROSOFT.STREAMANALYTICS").alias("ResourceProvider"),
        F.when(kind.isin("view", "click"), "ResourceUtilization")
        .when(kind == "error", "BacklogedInputEvents")
        .otherwise(kind)
        .alias("MetricName"),
        F.col("value").alias("Average"),
        F.when(F.col("user_id") % 2 == 0, F.lit(0.0)).otherwise(F.col("value")).alias("Maximum"),
    )


def pipeline_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as pipeline runs; status F has failed."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("RunId"),
        F.when(F.col("o_custkey") % 2 == 0, "pl_daily_batch_trigger").otherwise("other").alias("PipelineName"),
        F.when(F.col("o_orderstatus") == "F", "Failed").otherwise("Succeeded").alias("Status"),
        F.col("o_orderdate").cast("timestamp_ntz").alias("TimeGenerated"),
        F.col("o_orderdate").cast("timestamp_ntz").alias("Start"),
        (F.col("o_orderdate").cast("timestamp_ntz") + F.expr("INTERVAL 1 HOUR")).alias("End"),
        F.col("o_orderpriority").alias("Parameters"),
    )


def activity_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as activity runs of their order."""
    names = F.array(*[F.lit(n) for n in ("bronze_ingest", "silver_clean_dedup", "gold_aggregate_zorder", "other")])
    ship = F.col("l_shipdate").cast("timestamp_ntz")
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("PipelineRunId"),
        F.element_at(names, F.col("l_linenumber") % 4 + 1).alias("ActivityName"),
        F.when(F.col("l_returnflag") == "A", "Failed")
        .when(F.col("l_returnflag") == "R", "TimedOut")
        .otherwise("Succeeded")
        .alias("Status"),
        ship.alias("Start"),
        ship.alias("End"),
        F.col("l_linenumber").cast("string").alias("ErrorCode"),
        F.concat(F.lit("part "), F.col("l_partkey").cast("string")).alias("ErrorMessage"),
    )


def bronze_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All thirty bronze columns for every event; the ones the tables lack are null."""
    from gaugeworks.schemas import BRONZE, conform

    have = sensor_events(spark, sf_dir).withColumn("poll_timestamp", F.col("poll_timestamp").cast("timestamp"))
    lacking = [f for f in BRONZE.fields if f.name not in have.columns]
    filled = have.withColumns({f.name: F.lit(None).cast(f.dataType) for f in lacking})
    return conform(filled.withColumn("source", F.col("event_type")), BRONZE)
