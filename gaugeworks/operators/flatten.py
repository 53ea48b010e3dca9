"""API payloads to flat events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeworks.schemas import AIR_PAYLOAD, BRONZE, EVENT_SOURCE, SCHEMA_VERSION, WEATHER_PAYLOAD, conform

_PARSE = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}
ISO_MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"


def pair_payloads(responses: DataFrame, within: tuple[str, ...] = ("cycle_id", "city_id")) -> DataFrame:
    """The weather and the air payload of a city in one poll cycle; both must have succeeded.

    One conditional aggregation, so the response log is read and shuffled once rather than joined
    with itself. A group holds the attempts of one city in one cycle, so little would combine ahead of
    the shuffle: rows are dealt out first and their wide bodies sorted once, after it.
    """
    ok = F.col("status") == 200

    def body(endpoint: str) -> Column:
        of = F.col("endpoint") == endpoint
        return F.max_by(F.when(of, F.col("body")), F.when(of, F.col("attempt")))

    return (
        responses.filter(ok)
        .repartition(*within)
        .groupBy(*within)
        .agg(
            F.max("responded_at").alias("poll_timestamp"),
            body("weather").alias("weather"),
            body("air_pollution").alias("air_pollution"),
        )
        .filter(F.col("weather").isNotNull() & F.col("air_pollution").isNotNull())
    )


def with_city(df: DataFrame, cities: DataFrame) -> DataFrame:
    """Attaches name and coordinates of the city. No broadcast hint: the planner broadcasts the
    dimension only while its size is below the limit."""
    named = cities.select(
        "city_id",
        F.col("name").alias("city_name"),
        F.col("lat").alias("city_lat"),
        F.col("lon").alias("city_lon"),
    )
    return df.join(named, "city_id", "left")


def is_no_json(corrupt: str) -> Column:
    """Whether a corrupt-record column holds text that is not JSON, rather than a value of a wrong type."""
    return F.col(corrupt).isNotNull() & F.try_parse_json(corrupt).isNull()


def parse_payloads(paired: DataFrame) -> DataFrame:
    """Adds the parsed payloads, and ``malformed`` with the name of an unreadable one.

    A field of the wrong type is null and the rest of its payload stays; only text that is no JSON at
    all is malformed, which is looked into just for payloads that did not parse cleanly.

    The one-element explode keeps later filters on the parsed payload above the parsing; pushed below
    it they would parse every payload a second time.
    """
    both = F.struct(
        F.from_json("weather", WEATHER_PAYLOAD, _PARSE).alias("_w"),
        F.from_json("air_pollution", AIR_PAYLOAD, _PARSE).alias("_a"),
    )
    parsed = paired.withColumn("_p", F.explode(F.array(both))).select(*paired.columns, "_p._w", "_p._a")
    return parsed.withColumn(
        "malformed",
        F.when(is_no_json("_w._corrupt"), F.lit("weather")).when(is_no_json("_a._corrupt"), F.lit("air_pollution")),
    )


def flatten(paired: DataFrame) -> DataFrame:
    """The 30-column event of every readable pair.

    ``paired`` has city_id, poll_timestamp and the two payload texts, optionally the columns of
    ``with_city``. A missing or null parent gives null, as does an empty list.
    """
    return event_columns(parse_payloads(paired).filter(F.col("malformed").isNull()))


def malformed(paired: DataFrame) -> DataFrame:
    """Pairs with an unreadable payload, kept aside so that they never stop the others."""
    bad = parse_payloads(paired).filter(F.col("malformed").isNotNull())
    return bad.select(
        "city_id",
        "poll_timestamp",
        F.concat(F.lit("unreadable payload: "), "malformed").alias("reason"),
        F.col("weather").alias("weather_text"),
        F.col("air_pollution").alias("air_pollution_text"),
    )


def compact(payload: str) -> Column:
    """JSON text without the white space between its tokens; strings, order and numbers stay."""
    return F.regexp_replace(payload, r'("(?:[^"\\]++|\\.)*+")|\s++', "$1")


def event_columns(parsed: DataFrame) -> DataFrame:
    w, a = "_w", F.get("_a.list", F.lit(0))
    sky = F.get(f"{w}.weather", F.lit(0))

    def coordinate(name: str) -> Column:
        fallback = F.col(f"city_{name}") if f"city_{name}" in parsed.columns else F.lit(None)
        given = F.coalesce(F.map_contains_key(f"{w}.coord", F.lit(name)), F.lit(False))
        return F.when(given, F.try_element_at(f"{w}.coord", F.lit(name))).otherwise(fallback)

    columns = {
        "city_id": F.col("city_id"),
        "poll_timestamp": F.col("poll_timestamp").cast("timestamp"),
        "source": F.lit(EVENT_SOURCE),
        "schema_version": F.lit(SCHEMA_VERSION),
        "ingestion_date": F.to_date("poll_timestamp"),
        "dt": F.col(f"{w}.dt"),
        "lat": coordinate("lat"),
        "lon": coordinate("lon"),
        "visibility": F.col(f"{w}.visibility"),
        "wind_speed": F.col(f"{w}.wind.speed"),
        "wind_deg": F.col(f"{w}.wind.deg"),
        "clouds_all": F.col(f"{w}.clouds.all"),
        "weather_main": sky["main"],
        "weather_description": sky["description"],
        "aqi": a["main"]["aqi"],
        "raw_payload_json": F.concat(
            F.lit('{"weather":'), compact("weather"), F.lit(',"air_pollution":'), compact("air_pollution"), F.lit("}")
        ),
    }
    for name in ("temp", "feels_like", "temp_min", "temp_max", "pressure", "humidity"):
        columns[name] = F.col(f"{w}.main.{name}")
    for name in ("co", "no", "no2", "o3", "so2", "pm2_5", "pm10", "nh3"):
        columns[name] = a["components"][name]
    return conform(parsed.select(*[c.alias(n) for n, c in columns.items()]), BRONZE)


def to_wire(events: DataFrame, key: str = "city_id") -> DataFrame:
    """Events as (key, value): one JSON object with a constant key set, nulls included, keyed so that
    all events of a city share a partition and keep their order."""
    value = F.to_json(
        F.struct(*events.columns),
        {"ignoreNullFields": "false", "timestampFormat": ISO_MICROS},
    )
    return events.select(F.col(key).cast("string").alias("key"), value.alias("value"))
