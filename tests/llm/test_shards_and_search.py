import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from gaugeworks.llm import knn, shards


def test_shards(documents, corpus, no_documents):
    rows = shards.assign(documents, 4).collect()
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in rows) == Counter(
        (key, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for key, t in corpus
    )
    slots = defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
        assert r.law == "rows" and r.grown_shard is None
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    sizes = [len(slots[s]) for s in range(4)]
    assert max(sizes) - min(sizes) <= 1 and sum(sizes) == len(corpus)
    assert len({r.shard for r in rows if 100 <= (r.doc_id or 0) < 104}) == 1  # equal texts, together
    assert shards.assign(no_documents).count() == 0


def test_a_group_larger_than_a_shard(spark):
    docs = spark.createDataFrame([(i, "same" if i < 50 else f"text {i}") for i in range(60)], "doc_id long, text string")
    rows = shards.assign(docs, 6).collect()
    assert Counter(r.shard for r in rows) == {s: 10 for s in range(6)}
    assert len({r.shard for r in rows if r.doc_id < 50}) <= 6


def brute(rows, k, every):
    good = []
    for key, v in rows:
        if v is not None and key is not None and all(x is not None and np.isfinite(x) for x in v):
            good.append((key, [int(np.floor(1024 * float(np.float32(x)))) for x in v]))
    out = []
    for key, v in good:
        if key % every == 0:
            scores = [(-sum(a * b for a, b in zip(v, w, strict=False)), other) for other, w in good if other != key]
            out += [(key, rank + 1, other, -s) for rank, (s, other) in enumerate(sorted(scores)[:k])]
    return sorted(out)


@pytest.mark.parametrize("dim", [3, 16])
def test_search(spark, dim):
    rng = np.random.default_rng(dim)
    rows = [(i, rng.normal(size=dim).astype(np.float32).tolist()) for i in range(300)]
    rows += [(1000 + i, rows[7][1]) for i in range(30)]  # ties, more than k
    rows += [(2000, None), (2001, [None] + [0.5] * (dim - 1)), (2002, [float("nan")] * dim), (2003, [float("inf")] * dim)]
    rows += [(2004, [0.0] * dim), (2005, [0.25]), (2006, []), (None, [1.0] * dim)]
    table = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<float>, cell string")
    got = sorted(map(tuple, knn.search(table, every=20).collect()))
    assert got == brute(rows, 10, 20)


def test_search_of_few(spark):
    schema = "vec_id long, embedding array<float>"
    assert knn.search(spark.createDataFrame([], schema)).count() == 0
    assert knn.search(spark.createDataFrame([(0, [1.0])], schema)).count() == 0
    three = spark.createDataFrame([(0, [1.0]), (100, [2.0]), (101, [2.0])], schema)
    want = [(0, 1, 100, 2 * 1024**2), (0, 2, 101, 2 * 1024**2), (100, 1, 101, 4 * 1024**2), (100, 2, 0, 2 * 1024**2)]
    assert sorted(map(tuple, knn.search(three).collect())) == want
    hollow = spark.createDataFrame([(0, []), (1, []), (2, [])], schema)
    assert sorted(map(tuple, knn.search(hollow).collect())) == [(0, 1, 1, 0), (0, 2, 2, 0)]
