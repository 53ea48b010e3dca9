"""Operators 2, 8 and 10 against brute force."""

import hashlib
import itertools
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pytest

from gaugeworks.llm import lines, similar, suffixes


def plain_rest(texts, length):
    starts = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    for t in texts:
        gone = [False] * len(t)
        for i in range(len(t) - length + 1):
            if starts[t[i : i + length]] > 1:
                gone[i : i + length] = [True] * length
        spans = sum(g and (i == 0 or not gone[i - 1]) for i, g in enumerate(gone))
        yield len(t), sum(gone), spans, hashlib.sha256(bytes(b for b, g in zip(t, gone, strict=True) if not g)).hexdigest()


@pytest.mark.parametrize("shard", [suffixes.SHARD, 3000])
def test_repeated_strings(documents, corpus, monkeypatch, shard):
    monkeypatch.setattr(suffixes, "SHARD", shard)  # a small one splits anchors over shards
    got = sorted((tuple(r) for r in suffixes.digests(documents).collect()), key=repr)
    rest = plain_rest([(t or "").encode() for _, t in corpus], 200)
    want = sorted(((key, *r) for (key, _), r in zip(corpus, rest, strict=True)), key=repr)
    assert got == want


def test_repeated_strings_of_nothing(no_documents):
    assert suffixes.digests(no_documents).count() == 0


def plain_lines(rows):
    rows = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, hashlib.md5((r[1] or "").encode()).digest()))
    first, out = {}, []
    for key, text in rows:
        if text is None:
            out.append((key, None, 0, 0))
            continue
        parts = text.split("\n")
        full = [i for i, x in enumerate(parts) if x.strip(" ")]
        gone = set()
        for k in range(max(1, len(full) - 2) if full else 0):
            at = full[k : k + 3]
            me = (key, hashlib.md5(text.encode()).digest(), at[0])
            if first.setdefault(tuple(parts[i] for i in at), me) != me:
                gone |= set(range(at[0], at[-1] + 1))
        out.append((key, "\n".join(x for i, x in enumerate(parts) if i not in gone), len(parts), len(gone)))
    return sorted(out, key=repr)


def test_line_windows(documents, corpus, no_documents):
    done = lines.deduplicate(documents)
    assert done.columns == [*(c for c in documents.columns if c != "n_lines"), "n_lines", "n_removed"]
    assert done.first()._given == "g"
    got = done.select("doc_id", "text", "n_lines", "n_removed").collect()
    assert sorted(map(tuple, got), key=repr) == plain_lines(corpus)
    assert any(r.n_removed for r in got)
    assert lines.deduplicate(no_documents).count() == 0


def plain_sets(rows, width):
    for _, text in rows:
        words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        words = words.translate({9: 32, 10: 32, 11: 32, 12: 32, 13: 32}).split(" ")
        words = [w for w in words if w]
        size = min(width, len(words))
        yield {tuple(words[i : i + size]) for i in range(len(words) - size + 1)} if words else set()


def plain_components(rows, width, num, den):
    sets = list(plain_sets(rows, width))
    top = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and den * both >= num * len(sets[i] | sets[j]) and top[i] != top[j]:
                top = [top[j] if t == top[i] else t for t in top]
    return sets, top


@pytest.mark.parametrize(("width", "num", "den"), [(3, 9, 10), (5, 4, 5)])
def test_components(documents, corpus, width, num, den):
    sets, top = plain_components(corpus, width, num, den)
    least = defaultdict(lambda: None)
    for (key, _), t in zip(corpus, top, strict=True):
        least[t] = key if least[t] is None else min(least[t], least[t] if key is None else key)
    want = [(key, len(s), least[t]) for (key, _), s, t in zip(corpus, sets, top, strict=True)]
    got = [tuple(r) for r in similar.groups(documents, width, f"{num}/{den}").collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_small_sets_meet_by_subsets(spark):
    """Sets of up to 19 tokens that lack one, and ones that lack two of a longer one."""
    words = [f"w{i}" for i in range(40)]
    rows = [(i, " ".join(words[:n])) for i, n in enumerate((10, 11, 12, 20, 21, 22, 23, 24, 25))]
    rows += [(50 + i, " ".join(words[20 : 20 + n])) for i, n in enumerate((19, 20, 2, 1))]
    sets, top = plain_components(rows, 1, 9, 10)
    got = dict(similar.groups(spark.createDataFrame(rows, "doc_id long, text string"), 1).select("doc_id", "component_id").collect())
    assert got == {key: min(k for (k, _), u in zip(rows, top, strict=True) if u == t) for (key, _), t in zip(rows, top, strict=True)}


def test_hot_lists_are_compared_by_blocks(spark, prose, monkeypatch):
    """Many variants of one text: some within reach of each other, some not."""
    monkeypatch.setattr(similar, "SHORT_LIST", 4)
    monkeypatch.setattr(similar, "BLOCK", 5)
    monkeypatch.setattr(similar, "PIVOT_TOKENS", 300)  # a popular pivot is dealt out over groups
    base = prose(120, 1).split()
    rows = []
    for i in range(40):
        text = list(base)
        for k in range(i % 5):
            text[(7 * i + 23 * k) % 110] = f"v{i % 13}x{k}"
        rows.append((i, " ".join(text)))
    _, top = plain_components(rows, 3, 9, 10)
    assert len(set(top)) > 2
    got = dict(similar.groups(spark.createDataFrame(rows, "doc_id long, text string")).select("doc_id", "component_id").collect())
    assert got == {i: min(j for j, u in enumerate(top) if u == t) for i, t in enumerate(top)}


@pytest.mark.parametrize("threshold", ["9/10", "4/5"])
def test_linked_sets_meet_in_lists(spark, threshold):
    """Every linked pair shares a list, first within reach, and has sketches close enough; a set has fewer entries
    than two whole prefixes."""
    rule, rng = similar.Rule(Fraction(threshold)), np.random.default_rng(3)
    rows = []
    for n in (1, 2, 5, 9, 10, 18, 19, 20, 21, 40, 60, 61, 90, 400):
        base = rng.integers(0, 2**63, n, dtype=np.uint64)
        for gone, more in ((0, 0), (0, 1), (1, 0), (1, 1), (2, 2), (n // 20, 0), (n // 20, n // 20), (n // 9, 0), (0, n // 9)):
            tokens = np.unique(np.append(rng.permutation(base)[: n - gone], rng.integers(0, 2**63, more, dtype=np.uint64)))
            rows.append((len(rows), len(tokens), len(tokens), bytearray(tokens.tobytes())))
    sets = spark.createDataFrame([r for r in rows if r[1]], "id long, n long, v long, tokens binary")
    token_sets = {i: set(np.frombuffer(bytes(x), dtype="<u8").tolist()) for i, n, _, x in rows if n}
    for light in (0, similar.one_apart(rule)):
        found = {r.id: r for r in similar.lists(sets, rule, light).collect()}
        if not light:
            assert all(len(r.lists) == rule.prefix(r.n) + rule.index_prefix(r.n) for r in found.values())
            assert sum(len(r.lists) for r in found.values()) < 0.85 * sum(2 * rule.prefix(r.n) for r in found.values())
        linked = 0
        for i, j in itertools.combinations(token_sets, 2):
            x, y = token_sets[i], token_sets[j]
            if not rule.links(len(x & y), len(x), len(y)):
                continue
            linked += 1
            mine, other = ({e.key: e for e in found[k].lists} for k in (i, j))
            assert any(
                (mine[k].own or other[k].own)
                and rule.num * (len(x) + len(y)) <= (rule.num + rule.den) * min(len(x) - mine[k].pos, len(y) - other[k].pos)
                for k in mine.keys() & other.keys()
            )
            differ = sum(((p ^ q) % 2**64).bit_count() for p, q in zip(found[i].sketch, found[j].sketch, strict=True))
            assert differ <= len(x) + len(y) - 2 * rule.overlap(len(x), len(y))
        assert linked > 100


def test_tokens_of_unlike_sets_are_not_fetched(spark, prose, monkeypatch):
    """Texts of two passages, each of which is in many: they meet in long lists, but none links."""
    monkeypatch.setattr(similar, "SHORT_LIST", 4)
    monkeypatch.setattr(similar, "BLOCK", 5)
    kept = {}

    def stored(df, name, *by, write=similar.stored):
        kept.setdefault(name, []).append(out := write(df, name, *by))
        return out

    monkeypatch.setattr(similar, "stored", stored)
    passages = [prose(100, 700 + i) for i in range(9)]
    rows = [(k, f"{x} {y}") for k, (x, y) in enumerate(itertools.combinations(passages, 2))]
    got = dict(similar.groups(spark.createDataFrame(rows, "doc_id long, text string")).select("doc_id", "component_id").collect())
    assert got == {k: k for k, _ in rows}
    assert kept["similar-sets"][0].count() == len(rows)
    assert kept["remaining"][0].where("length > 4").count() > 100
    assert kept["meeting"][0].count() == 0
    assert all(pairs.count() == 0 for pairs in kept["pairs"])


def test_chains_are_one_component(spark):
    edges = spark.createDataFrame([(bytes([i]), bytes([i + 1])) for i in range(40)], "a binary, b binary")
    assert {bytes(r.component) for r in similar.components(edges).collect()} == {b"\0"}


def test_one_row_of_each_group_stays(documents, corpus, no_documents):
    sets, top = plain_components(corpus, 5, 4, 5)
    order = lambda r: (r[0] is None, r[0] or 0)
    want = [r for r, s in zip(corpus, sets, strict=True) if not s]
    for t in set(top):
        if members := [r for r, s, u in zip(corpus, sets, top, strict=True) if s and u == t]:
            want.append(min(members, key=order))
    left = similar.representatives(documents)
    assert left.columns == documents.columns
    assert sorted((tuple(r)[:2] for r in left.collect()), key=repr) == sorted(want, key=repr)
    assert similar.representatives(no_documents).count() == 0
