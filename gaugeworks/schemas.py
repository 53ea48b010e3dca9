"""Record shapes and the fixed values that go with them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BooleanType,
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

_TYPES = {
    "STRING": StringType(),
    "TIMESTAMP": TimestampType(),
    "DATE": DateType(),
    "BIGINT": LongType(),
    "INT": IntegerType(),
    "DOUBLE": DoubleType(),
    "BOOLEAN": BooleanType(),
}


def _flat(columns: str) -> StructType:
    """A schema from ``name TYPE [NOT NULL], ...``; unlike a DDL parse it needs no session."""
    fields = [column.split() for column in columns.split(",")]
    return StructType([StructField(name, _TYPES[kind], not rest) for name, kind, *rest in fields])


# --- Fixed values: column names, types and constants other systems depend on -----------------

SCHEMA_VERSION = "1.0"
EVENT_SOURCE = "azure-function-timer"

BRONZE = _flat(
    """
    city_id STRING, poll_timestamp TIMESTAMP, source STRING, schema_version STRING,
    ingestion_date DATE, dt BIGINT, lat DOUBLE, lon DOUBLE, temp DOUBLE, feels_like DOUBLE,
    temp_min DOUBLE, temp_max DOUBLE, pressure INT, humidity INT, visibility INT,
    wind_speed DOUBLE, wind_deg INT, clouds_all INT, weather_main STRING,
    weather_description STRING, aqi INT, co DOUBLE, no DOUBLE, no2 DOUBLE, o3 DOUBLE, so2 DOUBLE,
    pm2_5 DOUBLE, pm10 DOUBLE, nh3 DOUBLE, raw_payload_json STRING
    """
)

SILVER = _flat(
    """
    city_id STRING NOT NULL, observation_timestamp TIMESTAMP NOT NULL, ingestion_date DATE NOT NULL,
    temp DOUBLE NOT NULL, feels_like DOUBLE, pressure INT, humidity INT, wind_speed DOUBLE,
    wind_deg INT, clouds_all INT, weather_main STRING, weather_description STRING,
    aqi INT NOT NULL, co DOUBLE, no DOUBLE, no2 DOUBLE, o3 DOUBLE, so2 DOUBLE, pm2_5 DOUBLE,
    pm10 DOUBLE, nh3 DOUBLE
    """
)

GOLD = _flat(
    """
    city_id STRING NOT NULL, date DATE NOT NULL, avg_temp DOUBLE, min_temp DOUBLE, max_temp DOUBLE,
    avg_humidity DOUBLE, avg_aqi DOUBLE, max_aqi INT, avg_pm2_5 DOUBLE, avg_pm10 DOUBLE,
    observation_count INT, rolling_7day_avg_temp DOUBLE
    """
)

ROLLING = _flat(
    """
    city_id STRING, avg_temp DOUBLE, min_temp DOUBLE, max_temp DOUBLE, avg_humidity DOUBLE,
    avg_aqi DOUBLE, avg_pm2_5 DOUBLE, avg_pm10 DOUBLE, observation_count BIGINT,
    window_end_time TIMESTAMP
    """
)

ALERT = _flat(
    """
    id STRING, city_id STRING, window_max_temp DOUBLE, window_min_temp DOUBLE, temp_swing DOUBLE,
    window_max_aqi INT, window_max_pm2_5 DOUBLE, temperature_swing_triggered BOOLEAN,
    aqi_threshold_triggered BOOLEAN, detected_at TIMESTAMP
    """
)

CITY = _flat("city_id STRING, name STRING, lat DOUBLE, lon DOUBLE")

STREAM_EVENT = _flat(
    """
    city_id STRING, poll_timestamp TIMESTAMP, temp DOUBLE, humidity INT, aqi INT, pm2_5 DOUBLE,
    pm10 DOUBLE
    """
)

# Only the payload fields that become event columns; numbers are read as double because the API
# writes integers as 4.0 at times. ``coord`` is a map so that a key holding null differs from a
# missing key.
WEATHER_PAYLOAD = """
    coord MAP<STRING, DOUBLE>,
    weather ARRAY<STRUCT<main: STRING, description: STRING>>,
    main STRUCT<temp: DOUBLE, feels_like: DOUBLE, temp_min: DOUBLE, temp_max: DOUBLE,
                pressure: DOUBLE, humidity: DOUBLE>,
    visibility DOUBLE, wind STRUCT<speed: DOUBLE, deg: DOUBLE>, clouds STRUCT<`all`: DOUBLE>,
    dt DOUBLE, _corrupt STRING
    """

AIR_PAYLOAD = """
    list ARRAY<STRUCT<main: STRUCT<aqi: DOUBLE>,
                      components: STRUCT<co: DOUBLE, no: DOUBLE, no2: DOUBLE, o3: DOUBLE,
                                         so2: DOUBLE, pm2_5: DOUBLE, pm10: DOUBLE, nh3: DOUBLE>>>,
    _corrupt STRING
    """

RESPONSE_LOG = _flat(
    """
    cycle_id BIGINT, city_id STRING, endpoint STRING, attempt INT, status INT, body STRING,
    responded_at TIMESTAMP
    """
)

BROKER_LOG = _flat(
    """
    TimeGenerated TIMESTAMP, ResourceProvider STRING, ActivityName_s STRING,
    ChildEntityName_s STRING, EntityName_s STRING, PartitionId_s STRING, Count_d DOUBLE
    """
)

METRIC_LOG = _flat(
    """
    TimeGenerated TIMESTAMP, ResourceProvider STRING, MetricName STRING, Average DOUBLE,
    Maximum DOUBLE
    """
)

PIPELINE_RUN_LOG = _flat(
    """
    RunId STRING, PipelineName STRING, Status STRING, TimeGenerated TIMESTAMP, Start TIMESTAMP,
    End TIMESTAMP, Parameters STRING
    """
)

ACTIVITY_RUN_LOG = _flat(
    """
    PipelineRunId STRING, ActivityName STRING, Status STRING, Start TIMESTAMP, End TIMESTAMP,
    ErrorCode STRING, ErrorMessage STRING
    """
)

SILVER_REQUIRED = ("city_id", "observation_timestamp", "temp", "aqi")
CRITICAL_FIELDS = ("temp", "aqi")

CITIES = (
    ("hyderabad", "Hyderabad", 17.385, 78.4867),
    ("vijayawada", "Vijayawada", 16.5062, 80.648),
    ("bengaluru", "Bengaluru", 12.9716, 77.5946),
    ("mumbai", "Mumbai", 19.076, 72.8777),
    ("delhi", "Delhi", 28.7041, 77.1025),
    ("chennai", "Chennai", 13.0827, 80.2707),
    ("kolkata", "Kolkata", 22.5726, 88.3639),
    ("pune", "Pune", 18.5204, 73.8567),
    ("ahmedabad", "Ahmedabad", 23.0225, 72.5714),
    ("jaipur", "Jaipur", 26.9124, 75.7873),
    ("lucknow", "Lucknow", 26.8467, 80.9462),
    ("kochi", "Kochi", 9.9312, 76.2673),
)

# --- End of fixed values ----------------------------------------------------------------------

CORRUPT = "_corrupt_record"


def wire(schema: StructType, corrupt: bool = True) -> StructType:
    """The schema to parse JSON text with: whole numbers as double (a ``4.0`` would otherwise be
    lost), plus a column for lines that do not parse."""
    fields = [
        StructField(f.name, DoubleType() if isinstance(f.dataType, (IntegerType, LongType)) else f.dataType)
        for f in schema.fields
    ]
    return StructType(fields + ([StructField(CORRUPT, StringType())] if corrupt else []))


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Exactly the columns of ``schema``, in order and cast; values that do not fit become null."""
    return df.select(
        *[
            F.col(f.name) if df.schema[f.name].dataType == f.dataType else F.col(f.name).try_cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )


def schema_diff(df: DataFrame, expected: StructType) -> list[tuple[str, str, str | None, str | None]]:
    """Differences as (field, 'missing' | 'extra' | 'type', expected type, found type)."""
    found = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    wanted = {f.name: f.dataType.simpleString() for f in expected.fields}
    rows = [(n, "missing", t, None) for n, t in wanted.items() if n not in found]
    rows += [(n, "extra", None, t) for n, t in found.items() if n not in wanted]
    rows += [(n, "type", t, found[n]) for n, t in wanted.items() if n in found and found[n] != t]
    return sorted(rows)


def schema_report(spark: SparkSession, df: DataFrame, expected: StructType) -> DataFrame:
    """``schema_diff`` as a frame, for a report or an alert."""
    return spark.createDataFrame(
        schema_diff(df, expected), "field STRING, difference STRING, expected STRING, found STRING"
    )
