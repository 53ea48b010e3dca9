"""What the operators of this subpackage share: reading tables, cutting lineage, hashing words."""

from __future__ import annotations

import atexit
import shutil
import tempfile
from functools import cache
from pathlib import Path

import numpy as np
from pyspark import SparkContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeworks.session import work_dir


@cache
def ship(context: SparkContext) -> None:
    """Sends this package to the executors, once for an application, as --py-files does."""
    package = Path(__file__).resolve().parents[1]
    folder = tempfile.mkdtemp()  # the driver's own; executors fetch the archive from the driver
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    context.addPyFile(shutil.make_archive(f"{folder}/{package.name}", "zip", package.parent, package.name))


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table, whole."""
    ship(spark.sparkContext)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str, *by: str) -> DataFrame:
    """The rows, written below the shared checkpoint folder and read back.

    A written table survives the loss of an executor, and what follows does not compute it again.
    """
    spark = df.sparkSession
    path = work_dir(spark, name)
    writer = df.write
    (writer.partitionBy(*by) if by else writer).parquet(path, compression="zstd")
    return spark.read.schema(df.schema).parquet(path)


def text_of(column: str = "text") -> Column:
    """The text, with null taken as empty."""
    return F.coalesce(F.col(column), F.lit(""))


def mixed(h: np.ndarray) -> np.ndarray:
    """The finalizer of a 64-bit hash: every input bit moves about half of the output bits."""
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INVERSE = np.uint64(pow(int(_BASE), -1, 2**64))
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: A random-looking 64-bit value for each byte, capital letters having that of the small ones.
_BYTE = mixed(np.arange(1, 257, dtype=np.uint64))
_LOWER = _BYTE.copy()
_LOWER[65:91] = _BYTE[97:123]


class Powers:
    """Powers of the base and of its inverse modulo 2**64, grown on demand."""

    def __init__(self) -> None:
        self.up = np.ones(1, dtype=np.uint64)
        self.down = np.ones(1, dtype=np.uint64)

    def reach(self, n: int) -> None:
        if len(self.up) < n:
            size = 1 << (n - 1).bit_length()
            self.up = np.cumprod(np.concatenate(([np.uint64(1)], np.full(size - 1, _BASE))), dtype=np.uint64)
            self.down = np.cumprod(
                np.concatenate(([np.uint64(1)], np.full(size - 1, _BASE_INVERSE))), dtype=np.uint64
            )


_POWERS = Powers()


def word_hashes(data: np.ndarray, lower: bool = True) -> np.ndarray:
    """A 64-bit hash of every word of a text given as UTF-8 bytes; words end at ASCII white space."""
    n = len(data)
    if not n:
        return np.empty(0, dtype=np.uint64)
    gap = np.concatenate(([True], _SPACE[data], [True]))
    edge = np.flatnonzero(gap[1:] != gap[:-1])
    start, end = edge[::2], edge[1::2]
    _POWERS.reach(n + 1)
    total = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum((_LOWER if lower else _BYTE)[data] * _POWERS.up[:n], out=total[1:])
    return mixed((total[end] - total[start]) * _POWERS.down[start] + (end - start).astype(np.uint64))


def shingle_hashes(words: np.ndarray, width: int) -> np.ndarray:
    """Sorted distinct hashes of all runs of ``width`` words; the whole sequence if it is shorter."""
    n = len(words)
    if not n:
        return words
    width = min(width, n)
    out = np.zeros(n - width + 1, dtype=np.uint64)
    for k in range(width):
        out = mixed(out * _BASE + words[k : n - width + 1 + k])
    return np.unique(out)


def byte_hashes(data: np.ndarray, width: int) -> np.ndarray:
    """A 64-bit hash of every run of ``width`` bytes."""
    n = len(data)
    _POWERS.reach(n + 1)
    total = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(_BYTE[data] * _POWERS.up[:n], out=total[1:])
    return mixed((total[width:] - total[:-width]) * _POWERS.down[: n - width + 1])


def low_bits(hashes: np.ndarray, buckets: int) -> np.ndarray:
    """32 bits that tell the hashes of a bucket apart, but for a few in a million.

    The bucket is the hash times the number of buckets, whole part; these are bits of the rest.
    """
    return ((hashes * np.uint64(buckets)) >> np.uint64(32)).astype("<u4")
