import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from gaugeworks.llm import trie

TURNS = "conv_id long, turn long, role string, text string, node string, above long"


def remainder(c, n):
    return c - int(c / n) * n


def brute(rows):
    given = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            given[c].append((turn is not None, turn or 0, role or "", text or ""))
    given = {c: [t[2:] for t in sorted(ts)] for c, ts in given.items()}
    members, ends = defaultdict(list), defaultdict(list)
    for c, own in given.items():
        h = zlib.crc32(str(c).encode()) % 9
        path = tuple(given.get(c - remainder(c, 5), [])[:h] + own[h:])
        for d in range(len(path) + 1):
            members[path[:d]].append(c)
        ends[path].append(c)
    children = defaultdict(list)
    for p in members:
        if p:
            children[p[:-1]].append(p)
    leaves, saved = {}, {}
    for p in sorted(members, key=len, reverse=True):
        leaves[p] = sum(leaves[q] for q in children[p]) or 1
        own = (len(members[p]) - 1) * len(p[-1][1].encode()) if p else 0
        saved[p] = own + sum(saved[q] for q in children[p])
    return sorted(
        (
            min(m), len(p), min(members[p[:-1]]) if p else -(10**9), len(m), len(children[p]), leaves[p], saved[p],
            hashlib.sha256(",".join(map(str, sorted(ends[p]))).encode()).hexdigest(),
        )
        for p, m in members.items()
    )


def got(spark, rows):
    table = spark.createDataFrame([(*r, "n", 1) for r in rows], TURNS).repartition(3)
    out = trie.nodes(table)
    assert out.columns == [
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"
    ]
    assert [t for _, t in out.dtypes] == ["bigint"] * 7 + ["string"]
    return sorted(tuple(-(10**9) if v is None else v for v in r) for r in out.collect())


def made(seed):
    """Families that share beginnings, copies, ties in turn, nulls, repeated rows, negative and missing ids."""
    rng = random.Random(seed)
    rows = []
    for c in [*range(0, 40), *range(-7, 0), 1001, 1003, 20_000, 20_001, 9_000_000_000]:
        kind = rng.randrange(4)
        for t in range(rng.randrange(1, 12)):
            text = f"turn {t} é" if kind < 2 else rng.choice(["same", f"own {c} {t}", "", None])
            rows.append((c, rng.choice([t, t, None, 3]), rng.choice(["user", "assistant", None]) if kind else "user", text))
    rows += [(77, 1, "user", "twice"), (77, 1, "user", "twice"), (None, 1, "user", "of none"), (78, None, None, None)]
    return rows


@pytest.mark.parametrize(("seed", "band", "block"), [(1, 16, 1024), (2, 2, 3), (3, 3, 2)])
def test_equals_brute_force(spark, monkeypatch, seed, band, block):
    monkeypatch.setattr(trie, "BAND", band)
    monkeypatch.setattr(trie, "BLOCK", block)
    monkeypatch.setattr(trie, "IDS", 2 if seed > 1 else 4096)
    rows = made(seed)
    assert got(spark, rows) == brute(rows)


def test_a_long_conversation_among_copies(spark, monkeypatch):
    monkeypatch.setattr(trie, "BAND", 4)
    monkeypatch.setattr(trie, "IDS", 16)
    rows = [(c, t, "user", f"t{t}") for c in (0, 5, 10) for t in range(90 + c)]
    rows += [(1000 + 5 * c, t, "user", f"t{t}") for c in range(60) for t in range(3)]
    assert got(spark, rows) == brute(rows)


def test_only_turnless_and_empty(spark):
    alone = [(c, 0, "user", "x") for c in (3, 8, 9)]  # their leads are absent; some lose their only turn
    assert got(spark, alone) == brute(alone)
    assert got(spark, []) == []
    assert got(spark, [(None, 0, "user", "x")]) == []
