import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from gaugeworks.llm import benchmarks


def shingles(words):
    return Counter(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else Counter()


def brute(docs, items):
    """Best similarity of a window of item size, for all pairs of 0.8 or more."""
    out = {}
    for key, text in docs:
        words = re.findall(r"[^\W_]+", (text or "").lower())
        for item, wanted in items:
            want = re.findall(r"[^\W_]+", (wanted or "").lower())
            if not want or not words:
                continue
            other = shingles(want)
            best = 0
            for i in range(max(1, len(words) - len(want) + 1)):
                own = shingles(words[i : i + len(want)])
                best = max(best, sum((own & other).values()) / sum((own | other).values()))
            if best >= 0.8:
                out[key, item] = round(best, 6)
    return out


@pytest.fixture(scope="module")
def planted(prose, corpus):
    items = [(i, prose(30 + 4 * i, 5000 + i)) for i in range(6)]
    items += [(10, "Just three words"), (11, ""), (12, None), (13, items[0][1]), (14, "so so so so so so so so"), (None, prose(33, 77))]
    rows = list(corpus)
    for i, (_, text) in enumerate(items[:6]):
        words = text.split()
        edited = [*words[:2], "edit", *words[3:]]
        rows.append((1000 + i, prose(50, i + 60) + " " + text + " " + prose(9, i)))
        rows.append((1010 + i, prose(20, i + 70) + "\n" + " ".join(edited).upper().replace(" ", "!! ")))
        rows.append((1020 + i, prose(20, i + 80) + " " + " ".join(words[: len(words) // 2])))
    rows += [(1100, "and then just THREE words, no more"), (1101, "so " * 30), (1102, rows[-3][1]), (1102, rows[-3][1])]
    return rows, items


def test_windows(spark, planted):
    rows, items = planted
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id): r.similarity for r in benchmarks.report(docs, bench).collect()}
    want = brute(rows, items)
    assert set(got) == set(want) and len(got) >= 12
    assert all(abs(got[k] - want[k]) < 1e-6 for k in got)
    held = {key for key, _ in got}
    assert sorted((r.doc_id for r in benchmarks.clean(docs, bench).collect()), key=repr) == sorted(
        (key for key, _ in rows if key not in held), key=repr
    )


def test_all_prints_within_the_radius_meet(spark):
    import random

    rng = random.Random(3)
    prints = [(i, 7, rng.getrandbits(64) - 2**63) for i in range(8)]
    near = []
    for i, size, value in prints:
        for flips in (0, 5, 19, 20, 21, 30):
            other = value
            for bit in rng.sample(range(64), flips):
                other ^= 1 << bit if bit < 63 else -(1 << 63)
            near.append((100 * i + flips, size, other))
    windows = spark.createDataFrame(near, "window long, size int, simhash long")
    items = spark.createDataFrame(prints, "item long, size int, simhash long")
    got = {tuple(r) for r in benchmarks.hamming_pairs(windows, items, 20).collect()}
    assert got == {(w, i) for w, _, x in near for i, _, y in prints if bin((x ^ y) & (2**64 - 1)).count("1") <= 20}


def test_no_python_in_the_plan(documents, spark):
    bench = spark.createDataFrame([(1, "any item of a benchmark set, long enough")], "item_id long, text string")
    plan = benchmarks.clean(documents, bench)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_empty_tables(documents, no_documents, spark):
    none = spark.createDataFrame([], "item_id long, text string")
    assert benchmarks.report(documents, none).count() == 0
    assert benchmarks.clean(documents, none).count() == documents.count()
    assert benchmarks.report(no_documents, none).count() == 0


def test_fingerprints_follow_the_majority(spark):
    rows = spark.createDataFrame([(1, -1, 2), (1, 0, 1), (2, 5, 1), (2, 5, 1), (2, 3, 1)], "k int, hash long, weight long")
    assert dict(benchmarks.fingerprints(rows, "k").select("k", F.col("simhash")).collect()) == {1: -1, 2: 5}
