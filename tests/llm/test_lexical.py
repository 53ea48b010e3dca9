import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from gaugeworks.llm import lexical

ITEMS = "item_id long, text string, row long, terms string"


def terms(text):
    found = re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", text or "")
    return [re.sub("[A-Z]", lambda m: m[0].lower(), t) for t in found]


def brute(docs, items, top):
    held = [(key, Counter(terms(t))) for key, t in docs]
    sizes = [sum(c.values()) for _, c in held]
    n_docs, n_terms = sum(n > 0 for n in sizes), sum(sizes)
    df = Counter(t for _, c in held for t in c)
    asked = {}
    for key, text in items:
        if key is not None:
            asked.setdefault(key, set()).update(terms(text))
    out = []
    for key, wanted in asked.items():
        scores = []
        for (doc, c), n in zip(held, sizes, strict=True):
            if n:
                m = 50 + 50 * n * n_docs // n_terms
                score = sum(
                    math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 20 * m))
                    for t in wanted
                    if t in c
                )
                if score > 0:
                    scores.append((-score, doc is None, doc or 0))
        for rank, (score, none, doc) in enumerate(sorted(scores)[:top], 1):
            out.append((key, rank, None if none else doc, -score))
    return sorted(out, key=str)


def run(spark, docs, items, top=lexical.TOP):
    documents = spark.createDataFrame([(k, t, "b", 1) for k, t in docs], "doc_id long, text string, block string, row long")
    table = spark.createDataFrame([(k, t, 1, "x") for k, t in items], ITEMS)
    out = lexical.search(documents.repartition(3), table, top)
    assert dict(out.dtypes) == {"item_id": "bigint", "rank": "int", "doc_id": "bigint", "score": "bigint"}
    return sorted(map(tuple, out.collect()), key=str)


@pytest.mark.parametrize(("bundle", "block", "top"), [(128, 2048, 50), (3, 40, 5), (1, 7, 2)])
def test_equals_brute_force(spark, monkeypatch, corpus, prose, bundle, block, top):
    monkeypatch.setattr(lexical, "BUNDLE", bundle)
    monkeypatch.setattr(lexical, "BLOCK", block)
    rng = random.Random(5)
    rare = [f"rare{i}" for i in range(60)]
    docs = corpus + [(1000 + i, prose(30 + i % 7, 600 + i) + " " + " ".join(rng.choices(rare, k=3))) for i in range(150)]
    docs += [(2000 + i, "the same Étude, THE SAME") for i in range(9)] + [(None, "the same"), (None, "the same")]
    items = [(i, prose(6, 700 + i) + " " + rng.choice(rare)) for i in range(8)]
    items += [(50, "The SAME étude"), (51, None), (52, ""), (53, "nowhere..."), (54, docs[40][1]), (None, "the same")]
    items += [(55, "rare1 rare2"), (55, "rare3"), (55, "rare3")]
    assert run(spark, docs, items, top) == brute(docs, items, top)


def test_empty_tables(spark, corpus):
    assert run(spark, [], [(1, "a")]) == []
    assert run(spark, corpus, []) == []
    assert run(spark, [(1, None), (2, " .,")], [(1, "a")]) == []
    assert run(spark, [(1, "a")], [(1, "a")]) == brute([(1, "a")], [(1, "a")], 50)


def test_a_saturated_filter_changes_nothing(spark, monkeypatch, corpus):
    items = [(i, t) for i, t in corpus[:12]]
    want = run(spark, corpus, items)
    monkeypatch.setattr(lexical, "FILTER", 3)
    assert run(spark, corpus, items) == want == brute(corpus, items, 50)


@pytest.mark.parametrize("text", ["", "a", "aB1é_x\x00y", "  x", "x ", "É é", "\U0001f600a b", "a" * 3000])
def test_terms(text):
    hashes = lexical.term_hashes(np.frombuffer(text.encode(), dtype=np.uint8))
    words = terms(text)
    assert len(hashes) == len(words) and len(set(hashes.tolist())) == len(set(words))
    if words:
        assert hashes[0] == lexical.term_hashes(np.frombuffer(words[0].encode(), dtype=np.uint8))[0]
