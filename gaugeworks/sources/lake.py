"""Reading: lake folders, tables over them, the city dimension, logs, and event streams."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from gaugeworks.functions.times import resolve_run_date
from gaugeworks.schemas import BRONZE, CITIES, CITY, CORRUPT, RESPONSE_LOG, wire

TOPIC = "weather-events"


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder is there, on whatever file system the path names."""
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark._jsc.hadoopConfiguration()).exists(found)


def delete(spark: SparkSession, path: str) -> None:
    """Removes a folder, if it is there."""
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    found.getFileSystem(spark._jsc.hadoopConfiguration()).delete(found, True)


def read_or_none(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame | None:
    """A Parquet folder, or nothing when it has not been written yet."""
    if not exists(spark, path):
        return None
    return (spark.read if schema is None else spark.read.schema(schema)).parquet(path)


def read_raw_days(
    spark: SparkSession, root: str, first: str | date | None, last: str | date | None = None
) -> DataFrame | None:
    """The JSON events in the folders of the days first..last as bronze columns, plus the text of any
    line that does not parse. The date is that of the folder, so an unreadable line keeps its day.
    ``None`` without a folder."""
    low = resolve_run_date(first)
    high = resolve_run_date(last) if last else low
    days = [low + timedelta(days=n) for n in range((high - low).days + 1)]
    folders = [f"{root.rstrip('/')}/ingestion_date={day}" for day in days]
    folders = [f for f in folders if exists(spark, f)]
    if not folders:
        return None
    lines = (
        spark.read.schema(wire(BRONZE))
        .option("basePath", root)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .json(folders)
    )
    columns = [F.col(f.name).try_cast(f.dataType).alias(f.name) for f in BRONZE.fields]
    return lines.select(*columns, CORRUPT)


def read_days(
    spark: SparkSession,
    path: str,
    first: str | date,
    last: str | date | None = None,
    column: str = "ingestion_date",
    merge_schema: bool = False,
) -> DataFrame | None:
    """The days first..last, both included, of a folder partitioned by date; only their partitions
    are read. ``None`` when the folder does not exist."""
    low, high = resolve_run_date(first), resolve_run_date(last or first)
    if not exists(spark, path):
        return None
    days = spark.read.option("mergeSchema", str(merge_schema).lower()).parquet(path)
    day = F.col(column)
    return days.filter(day == F.lit(low) if low == high else day.between(F.lit(low), F.lit(high)))


def read_cities(spark: SparkSession, path: str | None = None) -> DataFrame:
    """The city dimension from a JSON array file, or the built-in one."""
    if path is None:
        return spark.createDataFrame(CITIES, CITY)
    return spark.read.schema(CITY).option("multiLine", True).json(path)


def read_responses(spark: SparkSession, path: str) -> DataFrame:
    """Recorded API responses, one JSON object per attempt."""
    numbers = spark.read.schema(wire(RESPONSE_LOG, corrupt=False)).json(path)
    return numbers.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in RESPONSE_LOG.fields])


def read_log(spark: SparkSession, path: str, schema: StructType, fmt: str = "parquet") -> DataFrame:
    """An exported log or metric table."""
    return spark.read.schema(schema).format(fmt).load(path)


def external_table(
    spark: SparkSession,
    name: str,
    path: str,
    schema: StructType,
    fmt: str = "parquet",
    partitioned_by: tuple[str, ...] = (),
) -> DataFrame:
    """A table with declared columns over existing files, replacing an external one of the same name;
    the files stay when the table goes."""
    if spark.catalog.tableExists(name) and spark.catalog.getTable(name).tableType != "EXTERNAL":
        raise ValueError(f"{name} holds its own data and is not replaced")
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    partitions = f"PARTITIONED BY ({', '.join(partitioned_by)})" if partitioned_by else ""
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(f"CREATE TABLE {name} ({columns}) USING {fmt} {partitions} LOCATION '{path}'")
    if partitioned_by:
        spark.sql(f"MSCK REPAIR TABLE {name}")
    return spark.table(name)


def lake_view(spark: SparkSession, name: str, path: str) -> DataFrame:
    """A view over a folder whose partition columns come from its paths; a filter on them prunes."""
    spark.read.parquet(path).createOrReplaceTempView(name)
    return spark.table(name)


def kafka_stream(spark: SparkSession, servers: str, topic: str = TOPIC, **options: str) -> DataFrame:
    """(key, value, timestamp) from a broker, from the earliest record on. Needs Spark's Kafka package."""
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
        .options(**options)
    )
    return reader.load().select(F.col("key").cast("string"), F.col("value").cast("string"), "timestamp")


_RECORD = StructType([StructField("key", StringType()), StructField("value", StringType())])


def folder_stream(
    spark: SparkSession, path: str, schema: StructType = _RECORD, fmt: str = "parquet", files_per_batch: int | None = None
) -> DataFrame:
    """A folder read as a stream of files, oldest first; by default of published (key, value) records."""
    reader = spark.readStream.schema(schema).format(fmt)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)


def parse(records: DataFrame, schema: StructType, keep: tuple[str, ...] = ()) -> DataFrame:
    """(value, event, readable, and what to ``keep``): the JSON body of (key, value) records, parsed once.

    A body is readable if it is JSON; a field of a wrong type is null and the rest of the event stays. Only
    records that did not parse cleanly are looked at again. The explode keeps filters above the parsing.
    """
    text = F.col("value").cast("string")
    body = F.from_json(text, wire(schema), {"columnNameOfCorruptRecord": CORRUPT})
    others = [c for c in keep if c != "value"]
    parsed = records.select(text.alias("value"), *others, F.explode(F.array(F.struct(body.alias("event")))).alias("_p"))
    doubtful = F.col("_p.event").isNull() | F.col(f"_p.event.{CORRUPT}").isNotNull()
    readable = F.when(F.col("value").isNull(), F.lit(False)).when(doubtful, F.try_parse_json("value").isNotNull())
    return parsed.select("value", *others, F.col("_p.event").alias("event"), readable.otherwise(F.lit(True)).alias("readable"))


def events_of(parsed: DataFrame, schema: StructType, keep: tuple[str, ...] = ()) -> DataFrame:
    """The readable records of ``parse`` as columns, cast; what does not fit is null."""
    events = parsed.where("readable").select("event.*", *keep)
    return events.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema.fields], *keep)


def decode(records: DataFrame, schema: StructType, keep: tuple[str, ...] = ()) -> DataFrame:
    """The JSON body of (key, value) records as columns, with record columns to ``keep`` beside them,
    such as the broker's ``timestamp``, which is the time of arrival. Records that are no JSON are those
    of ``unreadable``."""
    return events_of(parse(records, schema, keep), schema, keep)


def unreadable(records: DataFrame, arrival: str | None = None) -> DataFrame:
    """(key, value, reason, ingestion_date) of the records whose body is no JSON, under the day of
    arrival, or of handling where the arrival is not known."""
    value = F.col("value").cast("string")
    broken = records.filter(F.col("value").isNull() | F.try_parse_json(value).isNull())
    day = F.to_date(arrival) if arrival else F.current_date()
    return broken.select(
        F.col("key").cast("string").alias("key"),
        value.alias("value"),
        F.when(value.isNull(), "no body").otherwise("not readable as JSON").alias("reason"),
        day.alias("ingestion_date"),
    )
