import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F
from test_benchmarks import brute
from test_duplicates import plain_components, plain_lines

import corpus_pipeline
from gaugeworks.llm import bpe, quality


@pytest.fixture(scope="module")
def tables(spark, prose, corpus, tmp_path_factory):
    """documents with junk in them, labels and a benchmark, as files."""
    rng = random.Random(8)
    items = [(i, prose(35 + i, 4000 + i)) for i in range(5)]
    docs = [(k, t) for k, t in corpus if k is None or k != 400 or t]
    docs += [(500 + i, prose(60, 700 + i)) for i in range(120)]
    docs += [(700 + i, " ".join(w.upper() + "!!" for w in prose(50, 800 + i).split())) for i in range(60)]
    docs += [(800 + i, prose(30, 3000 + i) + "\n" + items[i % 5][1] + "\n" + prose(20, 3100 + i)) for i in range(8)]
    labels = [(k, int(k < 700), 0) for k, _ in docs if k is not None and 500 <= k < 760 and rng.random() < 0.6]
    labels += [(None, 1, 0), (501, None, None)]
    folder = tmp_path_factory.mktemp("tables")
    full = [(k, t, rng.choice(("en", "de")), f"s{rng.randrange(4)}", None if t is None else len(t)) for k, t in docs]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(full, schema).repartition(3).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return str(folder), docs, items


def test_held_out_accuracy(spark, tables):
    """Unlabelled rows of both kinds are told apart, and the result is the same each time."""
    folder, _, _ = tables
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    scored = quality.score(docs.withColumn("score", docs.source), labels)
    assert scored.columns == [*docs.columns, *quality.SCORES, "keep"]
    rows = scored.collect()
    assert len(rows) == docs.count()
    known = {r.doc_id for r in labels.collect()}
    new = [r for r in rows if r.doc_id is not None and r.doc_id >= 500 and r.doc_id not in known and r.doc_id < 800]
    assert len(new) > 50 and sum(r.keep == (r.doc_id < 700) for r in new) >= 0.97 * len(new)
    again = quality.score(docs, labels).collect()
    pick = lambda rows: sorted(((r.doc_id, r.text, r.score) for r in rows), key=repr)
    assert pick(rows) == pick(again)


def test_training_equals_a_plain_version(spark, tables):
    """Bounds that bind: which rows train and teach in each round, and the weights that come out."""
    folder, _, _ = tables
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    absent = spark.createDataFrame([(10**6 + i, i % 2, 0) for i in range(500)], labels.schema)
    model = quality.train(docs, labels.unionByName(absent), labelled=60, pseudo=12, rounds=2, confident=0.8)

    rows = {r._id: bytes(r.features) for r in quality.views_of(docs.dropDuplicates(["doc_id"])).collect()}
    given = {r.doc_id: r.quality for r in labels.collect() if r.doc_id in rows and r.quality is not None}
    ids = spark.createDataFrame([(k,) for k in rows], "_id long")
    hashed = {r[0]: (r[1], r[2]) for r in ids.select("_id", F.xxhash64("_id"), F.pmod(F.xxhash64("_id", F.lit(1)), F.lit(4))).collect()}
    first = lambda keys, n: sorted(keys, key=lambda k: (hashed[k][0], k))[:n]
    base = {k: (given[k], given[k], hashed[k][1] == 0) for k in first(given, 60)}
    counts = Counter(v[0] for v in base.values() if not v[2])

    def fit(sample):
        order = sorted(sample, key=lambda k: (k, rows[k]))
        views = quality.restored([rows[k] for k in order])
        return quality.fit_views(*views, np.array([sample[k][:2] for k in order]), np.array([sample[k][2] for k in order]))

    want = fit(base)
    for _ in range(2):
        free = [k for k in rows if k not in given]
        said = [quality.sigmoid(m) for m in want.margins(*quality.restored([rows[k] for k in free]))]
        taught = {}
        for view, p in enumerate(said):
            for value, n in counts.items():
                sure = [k for k, x in zip(free, p) if (x >= 0.8 if value else x <= 1 - 0.8)]
                for k in first(sure, max(1, round(12 * n / sum(counts.values())))):
                    taught.setdefault(k, [-1, -1])[1 - view] = value
        assert taught
        want = fit(base | {k: (*v, False) for k, v in taught.items()})
    for name in ("content", "metadata", "calibration", "combined"):
        assert np.allclose(getattr(model, name), getattr(want, name), atol=1e-4), name


def test_labels_of_absent_documents_use_nothing_up(spark, tables):
    folder, _, _ = tables
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    absent = spark.createDataFrame([(10**6 + i, i % 2, 0) for i in range(500)], labels.schema)
    scored = quality.score(docs, labels.unionByName(absent), labelled=80)
    assert scored.where("score < 1").count() > 100
    assert all(r.keep and r.score == 1 for r in quality.score(docs, absent).collect())


def test_without_labels_everything_is_kept(documents, no_documents, spark):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    rows = quality.score(documents, none).collect()
    assert len(rows) == documents.count() and all(r.keep and r.score == 1 for r in rows)
    assert quality.score(no_documents, none).count() == 0


def test_stages_against_brute_force(spark, tables):
    folder, rows, items = tables
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    quality_stage, line_stage, near_stage, clean_stage, token_stage = (f for _, f in corpus_pipeline.STAGES)

    def pairs(frame):
        return sorted(((r.doc_id, r.text) for r in frame.collect()), key=repr)

    def written(frame, name):
        path = f"{folder}/{name}"
        frame.write.mode("overwrite").parquet(path)
        return spark.read.parquet(path)

    good = written(quality_stage(spark, docs, folder), "good")
    assert good.columns == docs.columns
    left = pairs(good)
    assert not any(k is not None and 700 <= k < 760 for k, _ in left)
    assert {k for k, _ in rows if k is not None and 500 <= k < 700} <= {k for k, _ in left}

    fresh = written(line_stage(spark, good, folder), "fresh")
    want = [(k, t) for k, t, _, gone in plain_lines(left) if not gone or t.strip(" \n")]
    assert fresh.columns == docs.columns and pairs(fresh) == sorted(want, key=repr)
    assert all(r.n_chars == len(r.text) for r in fresh.collect() if r.text is not None)

    near = written(near_stage(spark, fresh, folder), "near")
    left = pairs(fresh)
    sets, top = plain_components(left, 5, 4, 5)
    want = [r for r, s in zip(left, sets, strict=True) if not s]
    for t in set(top):
        if members := [r for r, s, u in zip(left, sets, top, strict=True) if s and u == t]:
            want.append(min(members, key=lambda r: (r[0] is None, r[0] or 0)))
    assert near.columns == docs.columns and pairs(near) == sorted(want, key=repr)

    clean = written(clean_stage(spark, near, folder), "clean")
    left = pairs(near)
    held = {k for k, _ in brute(left, items)}
    assert held and pairs(clean) == [r for r in left if r[0] not in held]

    ranks = bpe.codec(public_tokenizers.path("byte_bpe_50k.tiktoken")).ranks
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    got = sorted(((r.doc_id, list(r.token_ids)) for r in token_stage(spark, clean, folder).collect()), key=repr)
    assert got == sorted(((k, library.encode_ordinary(t or "")) for k, t in pairs(clean)), key=repr)


def test_the_whole_pipeline(spark, tables):
    """``run`` on all stages equals the stages by hand; further columns and empty tables go through."""
    folder, _, _ = tables
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, folder).write.mode("overwrite").parquet(f"{folder}/by-hand-{k}")
        docs = spark.read.parquet(f"{folder}/by-hand-{k}")
    rows = lambda frame: sorted(((r.doc_id, r.n_tokens, list(r.token_ids), r.decoded_sha256) for r in frame.collect()), key=repr)
    got = corpus_pipeline.run(spark, folder)
    assert got.columns == ["doc_id", "n_tokens", "token_ids", "decoded_sha256"] and rows(got) == rows(docs)


def test_the_whole_pipeline_on_empty_tables_with_more_columns(spark, tables, tmp_path):
    folder, _, _ = tables
    for name in ("documents", "labels", "benchmark"):
        table = spark.read.parquet(f"{folder}/{name}.parquet").limit(0)
        table.withColumn("_given", F.lit("x")).withColumn("spans", F.lit(1)).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
