"""Writing: day partitions that can be rerun, keyed upserts, keyed publishing."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from gaugeworks.operators.flatten import to_wire
from gaugeworks.operators.keep import first_per_key
from gaugeworks.sources.lake import delete, exists

# --- Fixed value: partitions of the event topic ---
TOPIC_PARTITIONS = 4


def clustered(df: DataFrame, *columns: str) -> DataFrame:
    """Rows ranged and sorted by the columns, so that a file covers a narrow range of them and a
    filter can skip files by their minimum and maximum. Ranges are sampled, so no key is too big
    when later columns tell its rows apart."""
    return df.repartitionByRange(*columns).sortWithinPartitions(*columns)


def append(df: DataFrame, path: str, partition: str = "ingestion_date") -> None:
    df.write.mode("append").partitionBy(partition).parquet(path)


def overwrite_partitions(df: DataFrame, path: str, partition: str = "ingestion_date") -> None:
    """Replaces the partitions present in ``df`` and leaves the others, so a rerun changes nothing."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(partition).parquet(path)


def replace_days(
    df: DataFrame, path: str, first: date, last: date, partition: str = "ingestion_date", **counters: Column
) -> dict[str, int]:
    """Makes ``df`` the whole content of the days first..last, and counts on the way.

    A day an earlier run had written but ``df`` has no rows for becomes empty. The result holds the
    number of ``rows`` written and the aggregates given by name; both come out of the writing job.
    """
    seen = Observation()
    counted = df.observe(
        seen,
        F.count(F.lit(1)).alias("rows"),
        F.collect_set(partition).alias("_days"),
        *[c.alias(n) for n, c in counters.items()],
    )
    overwrite_partitions(counted, path, partition)
    result = dict(seen.get)
    for day in days_of(first, last) - set(result.pop("_days")):
        clear_day(df, path, day, partition)
    return result


def days_of(first: date, last: date) -> set[date]:
    return {first + timedelta(days=n) for n in range((last - first).days + 1)}


def clear_days(empty: DataFrame, path: str, first: date, last: date, partition: str = "ingestion_date") -> None:
    for day in days_of(first, last):
        clear_day(empty, path, day, partition)


def clear_day(empty: DataFrame, path: str, day: date, partition: str = "ingestion_date") -> None:
    """Empties one day's partition if an earlier run wrote it."""
    leaf = f"{path.rstrip('/')}/{partition}={day}"
    if exists(empty.sparkSession, leaf):
        empty.drop(partition).limit(0).write.mode("overwrite").parquet(leaf)


def touched(rows: DataFrame, partition: str) -> list:
    """The partitions ``rows`` falls in: as many values as folders it will write."""
    return [r[0] for r in rows.select(partition).distinct().collect()]


def _leaf(path: str, partition: str, value) -> str:
    name = "__HIVE_DEFAULT_PARTITION__" if value is None else str(value)
    return f"{path.rstrip('/')}/{partition}={name}"


def _pending(path: str) -> str:
    return f"{path.rstrip('/')}/_pending"


def finish_pending(spark: SparkSession, path: str, schema: StructType, partition: str) -> None:
    """Completes an upsert that ended between writing its merged partitions and putting them in place."""
    if exists(spark, f"{_pending(path)}/_SUCCESS"):
        overwrite_partitions(spark.read.schema(schema).parquet(_pending(path)), path, partition)
    delete(spark, _pending(path))


def upsert(
    rows: DataFrame,
    path: str,
    keys: list[str],
    partition: str,
    newest: list[Column] | None = None,
    cluster: list[str] | None = None,
    partitions: list | None = None,
) -> int:
    """MERGE by key: a row replaces the stored one of the same key, others are added, and stored rows
    that ``rows`` lacks stay.

    Only the folders of partitions that ``rows`` touches are listed, read and rewritten. Stored and new
    rows are united and one per key is kept, new before stored, or the first under ``newest``. The key
    must determine the partition. One writer per table is assumed. Returns how many new rows the table
    now holds. ``rows`` is read more than once unless ``partitions`` says which ones it touches.

    The merged partitions are written whole to a folder beside the table first and put in place
    from there. A driver lost in between leaves them behind, and the next upsert completes the work, so
    no stored row is lost.
    """
    spark = rows.sparkSession
    finish_pending(spark, path, rows.schema, partition)
    if partitions is None:
        partitions = touched(rows, partition)
    if not partitions:
        return 0
    leaves = [leaf for leaf in (_leaf(path, partition, v) for v in partitions) if exists(spark, leaf)]
    both = rows.withColumn("_new", F.lit(1))
    if leaves:
        stored = spark.read.schema(rows.schema).option("basePath", path).parquet(*leaves)
        both = both.unionByName(stored.withColumn("_new", F.lit(0)))
    merged = first_per_key(both, keys, [*(newest or []), F.col("_new").desc()])
    ranged = clustered(merged, partition, *(cluster or keys))
    ranged.write.mode("overwrite").partitionBy(partition).parquet(_pending(path))
    written = spark.read.schema(merged.schema).parquet(_pending(path))
    count = written.where("_new = 1").count()
    finish_pending(spark, path, rows.schema, partition)
    return count


def create_if_absent(df: DataFrame, table: str, partition: str | None = None) -> bool:
    """Creates a managed table from ``df`` unless one exists. True when it was created."""
    if df.sparkSession.catalog.tableExists(table):
        return False
    writer = df.write.format("parquet")
    (writer.partitionBy(partition) if partition else writer).saveAsTable(table)
    return True


def publish(
    events: DataFrame, target: str, servers: str | None = None, in_order: bool = False, time: str = "poll_timestamp"
) -> None:
    """Events as keyed JSON records, to a broker topic or, without one, appended to a folder.

    The key is the city, so a city's events share a partition. ``in_order`` also sends each city's
    events from one task, oldest first: right for the few events of a poll cycle, not for a history in
    which one city may hold most rows. Consumers go by event time either way.
    """
    if in_order:
        events = events.repartition("city_id").sortWithinPartitions(time)
    records = to_wire(events)
    if servers:
        records.write.format("kafka").option("kafka.bootstrap.servers", servers).option("topic", target).save()
    else:
        partition = F.pmod(F.xxhash64("key"), F.lit(TOPIC_PARTITIONS)).cast("int")
        records.withColumn("partition", partition).write.mode("append").parquet(target)
