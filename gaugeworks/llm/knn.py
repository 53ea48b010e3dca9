"""Exact top-k search by a Voronoi kNN join (operator 4)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gaugeworks.llm.common import stored

#: Queries and candidates that one local search holds.
QUERY_BLOCK = 4_000
DATA_BLOCK = 40_000
#: Exact integers of a double.
EXACT = 2**53


def matrix(column: pa.Array, dim: int) -> np.ndarray:
    """A list column as rows of ``dim`` numbers; missing trailing components are zero."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    lengths = pa.compute.list_value_length(column).to_numpy(zero_copy_only=False)
    if len(lengths) and (lengths == dim).all():
        return flat.reshape(-1, dim)
    out = np.zeros((len(lengths), dim), dtype=np.int64)
    out[np.arange(dim) < lengths[:, None]] = flat
    return out


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Integer inner products; by floating point where that is exact."""
    top = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * max(1, a.shape[1])
    if top < EXACT:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return a @ b.T


def quantized(vectors: DataFrame, factor: int) -> DataFrame:
    """(vec_id, v) of the vectors that take part, each component x as floor(factor * x)."""
    good = F.col("embedding").isNotNull() & F.forall(
        "embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    )
    return vectors.where(good).select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.transform("embedding", lambda x: F.floor(F.lit(factor) * x.cast("double")).cast("long")).alias("v"),
    )


def search(vectors: DataFrame, k: int = 10, every: int = 100, factor: int = 1024, pivots: int = 16) -> DataFrame:
    """For each query the ``k`` other rows of highest inner product: query_id, rank, vec_id, score.

    Queries are the rows whose vec_id is divisible by ``every``. All rows are cut into Voronoi cells
    around ``pivots`` rows chosen by a hash. A cell's summary is its ``k + 1`` members nearest to the
    pivot. Scored against the summaries, a query gets a floor under its k-th best score. A cell of
    queries with pivot p, radius r and least floor f needs a vector c only if p.c + r |c| >= f, as no
    query of the cell scores higher with c; only then c is sent there, and the cells are solved locally
    in blocks of bounded size. Of equal vectors only those with the k + 1 smallest ids can be in a
    result. What the driver collects, pivots, summaries and a bound for each cell, has a size set by
    ``pivots`` and ``k`` alone.

    Null vectors and those with null, NaN or infinite components take no part. Rows without an id
    are left out, as ids order ties and tell rows apart; rows that repeat a query's id are not its
    candidates, and repeated queries count once. Vectors of different lengths are compared as if
    the shorter ended in zeros. Other columns are not read.
    """
    spark = vectors.sparkSession
    clean = quantized(vectors, factor).where("vec_id IS NOT NULL")
    copies = W.partitionBy("v").orderBy("vec_id")
    data = stored(
        clean.withColumn("copy", F.row_number().over(copies)).where(F.col("copy") <= k + 1).drop("copy"), "knn-data"
    )
    asked = clean.where(F.col("vec_id") % every == 0).dropDuplicates(["vec_id", "v"])
    out = "query_id long, rank int, vec_id long, score long"
    heads = data.orderBy(F.xxhash64("v"), "vec_id").select("v").limit(pivots).collect()  # a parameter bounds it
    dim = data.agg(F.max(F.size("v"))).first()[0] or 0
    if not heads or not dim:
        return scoreless(data, asked, k, out)
    p = np.zeros((len(heads), dim), dtype=np.int64)
    for i, row in enumerate(heads):
        p[i, : len(row.v)] = row.v
    p = np.unique(p, axis=0).astype(np.float64)

    def nearest(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        v = v.astype(np.float64)
        square = (v**2).sum(1)[:, None] - 2 * v @ p.T + (p**2).sum(1)
        cell = square.argmin(1)
        return cell, np.sqrt(((v - p[cell]) ** 2).sum(1))

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cell, far = nearest(matrix(batch.column("v"), dim))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(cell, pa.int32()), pa.array(far, pa.float64())], ["vec_id", "v", "cell", "far"]
            )

    closest = W.partitionBy("cell").orderBy("far", "vec_id")
    summary = (
        data.mapInArrow(cells, "vec_id long, v array<long>, cell int, far double")
        .withColumn("place", F.row_number().over(closest))
        .where(F.col("place") <= k + 1)
        .select("vec_id", "v")
        .collect()  # pivots * (k + 1) rows at most
    )
    known_ids = np.array([row.vec_id for row in summary], dtype=np.int64)
    known = np.zeros((len(summary), dim), dtype=np.int64)
    for i, row in enumerate(summary):
        known[i, : len(row.v)] = row.v

    def floors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = matrix(batch.column("v"), dim)
            cell, far = nearest(v)
            score = products(v, known).astype(np.float64)
            ids = batch.column("vec_id").to_numpy()
            score[ids[:, None] == known_ids] = -np.inf
            least = np.sort(score, axis=1)[:, -k] if len(known) >= k else np.full(len(v), -np.inf)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *map(pa.array, (cell.astype(np.int32), far, least))],
                ["vec_id", "v", "cell", "far", "least"],
            )

    queries = stored(
        asked.mapInArrow(floors, "vec_id long, v array<long>, cell int, far double, least double"), "knn-queries"
    )
    bounds = (
        queries.groupBy("cell")
        .agg(F.max("far").alias("far"), F.min("least").alias("least"), F.count("*").alias("n"))
        .collect()  # a row per cell
    )
    if not bounds:
        return spark.createDataFrame([], out)
    index = np.array([b.cell for b in bounds])
    center, radius = p[index], np.array([b.far for b in bounds])
    least = np.array([b.least for b in bounds])
    query_blocks = {b.cell: -(-b.n // QUERY_BLOCK) for b in bounds}
    data_blocks = max(1, -(-data.count() // DATA_BLOCK))

    def needed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = matrix(batch.column("v"), dim).astype(np.float64)
            reach = v @ center.T + np.sqrt((v**2).sum(1))[:, None] * radius
            who, where = np.nonzero(reach * (1 + 1e-9) + 1e-6 + np.abs(reach) * 2e-9 >= least)
            for g in np.unique(where):
                rows = batch.take(pa.array(who[where == g]))
                cell = int(index[g])
                for block in range(query_blocks[cell]):
                    yield pa.RecordBatch.from_arrays(
                        [*rows.columns, *(pa.array(np.full(rows.num_rows, x, dtype=np.int32)) for x in (cell, block))],
                        ["vec_id", "v", "cell", "block"],
                    )

    sent = data.mapInArrow(needed, "vec_id long, v array<long>, cell int, block int").withColumn(
        "part", F.pmod(F.xxhash64("vec_id"), F.lit(data_blocks)).cast("int")
    )
    blocks = F.create_map(*[F.lit(x) for item in query_blocks.items() for x in item])
    wanted = queries.select(
        "vec_id",
        "v",
        "cell",
        F.pmod(F.xxhash64("vec_id"), blocks[F.col("cell")]).cast("int").alias("block"),
        F.explode(F.sequence(F.lit(0), F.lit(data_blocks - 1))).alias("part"),
    )

    def solve(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(left) and len(right):
            right = right.sort_values("vec_id", kind="stable")
            ids = right["vec_id"].to_numpy()
            rows = padded(right["v"], dim)
            for begin in range(0, len(left), 256):
                some = left.iloc[begin : begin + 256]
                scores = products(padded(some["v"], dim), rows)
                for query, score in zip(some["vec_id"].to_numpy(), scores, strict=True):
                    other = np.flatnonzero(ids != query)
                    score = score[other]
                    if len(other) > k:
                        bar = np.partition(score, len(score) - k)[len(score) - k]
                        other, score = other[score >= bar], score[score >= bar]
                    best = np.argsort(-score, kind="stable")[:k]
                    found.append(pd.DataFrame({"query_id": query, "vec_id": ids[other[best]], "score": score[best]}))
        return pd.concat(found) if found else pd.DataFrame({"query_id": [], "vec_id": [], "score": []}, dtype="int64")

    keys = ["cell", "block", "part"]
    solved = (
        wanted.groupBy(*keys).cogroup(sent.groupBy(*keys)).applyInPandas(solve, "query_id long, vec_id long, score long")
    )
    return ranked(solved, k)


def padded(column: pd.Series, dim: int) -> np.ndarray:
    out = np.zeros((len(column), dim), dtype=np.int64)
    for i, v in enumerate(column):
        out[i, : len(v)] = v
    return out


def ranked(pairs: DataFrame, k: int) -> DataFrame:
    """The first ``k`` rows of each query by score, ties to the smaller id."""
    order = W.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return (
        pairs.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def scoreless(data: DataFrame, asked: DataFrame, k: int, schema: str) -> DataFrame:
    """The result where no vector has a component: the smallest other ids, all with score 0."""
    first = data.orderBy("vec_id").limit(k + 1).select("vec_id", F.lit(0).cast("long").alias("score"))
    pairs = asked.select(F.col("vec_id").alias("query_id")).join(F.broadcast(first), F.expr("query_id != vec_id"))
    return ranked(pairs, k).to(asked.sparkSession.createDataFrame([], schema).schema)
