"""Keyed tables as a base and the changes since: a batch writes its own rows only.

    table/base/<partition>=.../    merged rows, one per key
    table/changes/batch=<n>/       the rows of batch n, whole or not there

Reading unites both and keeps the newest row of a key. ``compact`` merges changes into the base, of which
it rewrites the partitions that they touch, and then removes them. A batch that runs again replaces its
own folder. A compaction that is cut off leaves rows in both places, which reads the same, and the next one
completes it. One writer and one compaction at a time are assumed; either may run beside readers that
list the folders before the changes are removed.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from gaugeworks.operators.keep import first_per_key
from gaugeworks.sources.lake import delete, exists
from gaugeworks.sources.sinks import upsert

_BATCH = "batch"


def _base(path: str) -> str:
    return f"{path.rstrip('/')}/base"


def _changes(path: str) -> str:
    return f"{path.rstrip('/')}/changes"


def append_changes(rows: DataFrame, path: str, batch_id: int) -> None:
    """The rows of a batch in a folder of their own, which a rerun of the batch replaces."""
    rows.write.mode("overwrite").parquet(f"{_changes(path)}/{_BATCH}={batch_id}")


def append_each(path: str) -> Callable[[DataFrame, int], None]:
    """A batch handler that appends what a batch changes."""
    return lambda batch, batch_id: append_changes(batch, path, batch_id)


def batches(spark: SparkSession, path: str) -> list[int]:
    """The batches whose changes are complete and not yet merged."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(_changes(path))
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(folder):
        return []
    names = [s.getPath().getName() for s in files.listStatus(folder)]
    found = [int(n.partition("=")[2]) for n in names if n.startswith(f"{_BATCH}=")]
    return sorted(n for n in found if exists(spark, f"{_changes(path)}/{_BATCH}={n}/_SUCCESS"))


def _read_changes(spark: SparkSession, path: str, schema: StructType, which: list[int]) -> DataFrame:
    folders = [f"{_changes(path)}/{_BATCH}={n}" for n in which]
    full = StructType([*schema.fields, StructField(_BATCH, LongType())])
    return spark.read.schema(full).option("basePath", _changes(path)).parquet(*folders)


def newest(
    spark: SparkSession, path: str, schema: StructType, keys: list[str], order: list[Column] | None = None
) -> DataFrame:
    """The table: one row per key, first by ``order``, then by batch, the merged rows being the oldest."""
    rows = spark.createDataFrame([], StructType([*schema.fields, StructField(_BATCH, LongType())]))
    if exists(spark, _base(path)):
        base = spark.read.schema(schema).parquet(_base(path)).select(*schema.fieldNames())
        rows = rows.unionByName(base.withColumn(_BATCH, F.lit(-1).cast("long")))
    if which := batches(spark, path):
        rows = rows.unionByName(_read_changes(spark, path, schema, which))
    return first_per_key(rows, keys, [*(order or []), F.col(_BATCH).desc()]).select(*schema.fieldNames())


def compact(
    spark: SparkSession,
    path: str,
    schema: StructType,
    keys: list[str],
    partition: Column,
    order: list[Column] | None = None,
    cluster: list[str] | None = None,
    name: str = "period",
) -> int:
    """Merges all complete changes into the base, partitioned by ``partition``, which the key has to
    determine. Returns how many batches were merged."""
    which = batches(spark, path)
    if not which:
        return 0
    last = first_per_key(_read_changes(spark, path, schema, which), keys, [*(order or []), F.col(_BATCH).desc()])
    rows = last.select(*schema.fieldNames()).withColumn(name, partition)
    upsert(rows, _base(path), keys, name, order, cluster)
    for n in which:
        delete(spark, f"{_changes(path)}/{_BATCH}={n}")
    return len(which)
