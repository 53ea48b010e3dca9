"""Session settings the jobs rely on, and the shared folder they may write to."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from functools import cache
from pathlib import Path

from pyspark import SparkContext
from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Window state of a large fleet belongs on disk, not on the heap; only its changes are uploaded.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # Recording the Python call site of every column costs more than planning the query.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, app: str = "gaugeworks", **conf: str) -> SparkSession:
    """A session with the defaults above. Keyword names use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = DEFAULTS | {k.replace("__", "."): str(v) for k, v in conf.items()}
    for key, value in settings.items():
        builder = builder.config(key, value)
    return pin_utc(builder.getOrCreate())


def pin_utc(spark: SparkSession) -> SparkSession:
    """All event times are UTC, so casts between zoned and plain timestamps must use UTC."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


@cache
def ship(context: SparkContext) -> None:
    """Sends this package to the executors, once for an application, for the jobs that run Python there.
    The archive lies with the driver, from which executors fetch it."""
    package = Path(__file__).resolve().parent
    folder = tempfile.mkdtemp()
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    context.addPyFile(shutil.make_archive(f"{folder}/{package.name}_jobs", "zip", package.parent, package.name))


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder for checkpoints and written tables.

    It lies below ``spark.checkpoint.dir``, which every executor can reach. A temporary folder
    serves only a local session that leaves the setting out.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        base = _local_base()
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


@cache
def _local_base() -> str:
    return tempfile.mkdtemp(prefix="gaugeworks-")
