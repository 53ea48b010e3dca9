"""Copies of replaced partitions, so that an upsert can be taken back.

    table/<partition>=.../                        the table
    table/_history/version=<n>/data/<partition>=.../   what stood there before version n
    table/_history/version=<n>/touched/           the partitions that version n wrote

Only what an upsert replaces is copied, by Spark, so its cost is that of the upsert. A version counts from the moment
its list of touched partitions is complete, which is before the table changes; an upsert that was cut off
can therefore be taken back like any other. Readers of the table do not see the folder, as its name
begins with an underscore. One writer per table is assumed. This is no transaction log: there is nothing to
read an old version from without restoring it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from gaugeworks.sources.lake import delete, exists
from gaugeworks.sources.sinks import _leaf, _pending, finish_pending, touched, upsert

_TOUCHED = "value STRING, existed BOOLEAN"


def _history(path: str) -> str:
    return f"{path.rstrip('/')}/_history"


def _version(path: str, n: int) -> str:
    return f"{_history(path)}/version={n}"


def versions(spark: SparkSession, path: str) -> list[int]:
    """The versions that can be taken back, oldest first."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(_history(path))
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(folder):
        return []
    found = [int(s.getPath().getName().partition("=")[2]) for s in files.listStatus(folder)]
    return sorted(n for n in found if exists(spark, f"{_version(path, n)}/touched/_SUCCESS"))


def upsert_kept(rows: DataFrame, path: str, keys: list[str], partition: str, **options) -> int:
    """``sinks.upsert``, with the partitions that it replaces kept. Returns the number of the version."""
    spark = rows.sparkSession
    finish_pending(spark, path, rows.schema, partition)
    past = versions(spark, path)
    n = past[-1] + 1 if past else 0
    delete(spark, _version(path, n))  # a copy that was cut off
    values = touched(rows, partition)
    leaves = {value: _leaf(path, partition, value) for value in values}
    there = {value for value, leaf in leaves.items() if exists(spark, leaf)}
    if there:
        stored = spark.read.schema(rows.schema).option("basePath", path).parquet(*[leaves[v] for v in there])
        stored.write.partitionBy(partition).parquet(f"{_version(path, n)}/data")
    listed = [(None if v is None else str(v), v in there) for v in values]
    spark.createDataFrame(listed, _TOUCHED).write.parquet(f"{_version(path, n)}/touched")
    upsert(rows, path, keys, partition, partitions=values, **options)
    return n


def changed(spark: SparkSession, path: str) -> DataFrame:
    """(version, value, existed): which partitions each version wrote, and whether they were there before."""
    schema = StructType.fromDDL(f"{_TOUCHED}, version INT")
    past = versions(spark, path)
    if not past:
        return spark.createDataFrame([], schema)
    parts = [
        spark.read.schema(_TOUCHED).parquet(f"{_version(path, n)}/touched").withColumn("version", F.lit(n)) for n in past
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def restore(spark: SparkSession, path: str, schema: StructType, partition: str, version: int) -> int:
    """Takes back ``version`` and all later ones; returns how many partitions changed.

    A partition gets the copy of the oldest of these versions that wrote it, or goes if it was new then.
    The copies are put in place like an upsert, and only then is the history cut, so a restore that was cut off
    is run again.
    """
    undone = [n for n in versions(spark, path) if n >= version]
    if version not in undone:
        raise ValueError(f"no version {version} is kept for {path}")
    finish_pending(spark, path, schema, partition)
    # As many values as folders these versions wrote.
    rows = changed(spark, path).where(F.col("version") >= version).collect()
    first: dict[str | None, tuple[int, bool]] = {}
    for row in sorted(rows, key=lambda r: r.version):
        first.setdefault(row.value, (row.version, row.existed))
    copies = None
    for n in undone:
        leaves = [_leaf(f"{_version(path, n)}/data", partition, value) for value, (v, existed) in first.items() if v == n and existed]
        # A partition that an upsert of nothing but emptied rows left without files has no copy.
        leaves = [leaf for leaf in leaves if exists(spark, leaf)]
        if leaves:
            part = spark.read.schema(schema).option("basePath", f"{_version(path, n)}/data").parquet(*leaves)
            copies = part if copies is None else copies.unionByName(part)
    if copies is not None:
        copies.write.mode("overwrite").partitionBy(partition).parquet(_pending(path))
        finish_pending(spark, path, copies.schema, partition)
    for value, (n, existed) in first.items():
        if not existed or not exists(spark, _leaf(f"{_version(path, n)}/data", partition, value)):
            delete(spark, _leaf(path, partition, value))
    for n in reversed(undone):
        delete(spark, _version(path, n))
    return len(first)


def forget(spark: SparkSession, path: str, before: int) -> None:
    """Removes the copies of all versions below ``before``; later ones can still be taken back."""
    for n in versions(spark, path):
        if n < before:
            delete(spark, _version(path, n))
