import hashlib
import math
import random
import re
from collections import Counter

from gaugeworks.llm import privacy

# The patterns as they are asked for, tried from the left without tricks.
PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def passes(kind, match):
    digits = re.sub(r"[^0-9]", "", match)
    if kind == "ip":
        return all(int(x) <= 255 for x in match.split("."))
    if kind == "card":
        doubled = [int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(digits))]
        return 16 <= len(digits) <= 19 and sum(doubled) % 10 == 0
    return kind == "email" or 8 <= len(digits) <= 15


def brute(text):
    return [(k, *m.span()) for k, p in PLAIN.items() for m in re.finditer(p, text) if passes(k, m[0])]


def test_base_spans():
    rng = random.Random(4)
    parts = "a _ @ . b- 1 2 25 0 + ( x@y.z 1.2.3.4 256 é".split() + [" ", "4111 1111-1111 1111", "\n", "+49 (0)30 1234567"]
    for _ in range(15_000):
        text = "".join(rng.choice(parts) for _ in range(rng.choice((3, 9, 30))))
        assert privacy.base_spans(text) == brute(text)


def test_long_runs_take_linear_time():
    for text in ("1" * 300_000, "a" * 300_000, "a." * 100_000 + "@", "+1" + "(" * 200_000, "1 " * 150_000, "a@" * 100_000):
        assert isinstance(privacy.base_spans(text), list)


def test_query_and_terms(spark, prose):
    rows = [(i, f"{prose(30, i)}\nwrite to zanzibar of the common office at boss@corp.example today\n{prose(12, i)}") for i in range(6)]
    rows += [(10 + i, prose(40, 60 + i) + " common office") for i in range(30)]
    rows += [(50, None), (51, ""), (52, "call +49 30 1234567, or 10.0.0.1"), (52, "x@y.z"), (None, "a@b.cd" * 3000)]
    docs = spark.createDataFrame([(*r, "s", "t") for r in rows], "doc_id long, text string, spans string, _row string").repartition(3)
    got = sorted(map(tuple, privacy.digests(docs).collect()), key=repr)
    by_id = {}
    for key, text in rows:
        base = brute(text or "")
        listed = ",".join(f"{k}:{a}:{b}" for k, a, b in base)
        by_id.setdefault(key, []).append(
            tuple(sum(k == kind for k, _, _ in base) for kind in PLAIN) + (hashlib.sha256(listed.encode()).hexdigest(), listed)
        )
    assert sorted((r[0], *r[1:6]) for r in got if r[0] is not None) == sorted(
        (key, *v[:5]) for key, many in by_id.items() if key is not None for v in many
    )
    texts = dict(rows)
    for r in got:
        assert any(r[6].startswith(v[5]) for v in by_id[r[0]])
        more = [s.split(":") for s in r[6].split(",") if s.split(":")[0] in ("general", "remove")]
        found = {(kind, texts[r[0]][int(a) : int(b)]) for kind, a, b in more}
        if r[0] is not None and r[0] < 6:
            assert ("remove", "zanzibar") in found and not {w for _, w in found} & {"common", "office"}
        else:
            assert not found
    assert privacy.digests(docs.limit(0)).count() == 0


def test_every_pair_is_judged_by_distinct_texts(spark, prose):
    def expected(texts, reach=6):
        near = {x: [(x[a:b], w.lower(), at) for a, b, w, at in mentions(x, reach)] for x in texts}
        n_t = Counter(w for x in near for w in set(privacy.WORD.findall(x.lower())))
        n_e = Counter(e for found in near.values() for e in {e for e, _, _ in found})
        n_te = Counter(pair for found in near.values() for pair in {(e, t) for e, t, _ in found})
        out = {}
        for x, found in near.items():
            for e, t, at in found:
                p_e = n_e[e] / len(near)
                pmi = math.log((n_te[e, t] + 2 * p_e) / (n_t[t] + 2) / p_e)
                if pmi > 0 and pmi >= 0.8 * -math.log(p_e):
                    out.setdefault(x, set()).add(("remove" if n_t[t] == n_te[e, t] else "general", *at))
        return out

    def mentions(text, reach):
        for _, a, b in (spans := brute(text)):
            left, right = text.rfind("\n", 0, a) + 1, text.find("\n", b) % (len(text) + 1)
            words = list(privacy.WORD.finditer(text, left, a))[-reach:] + list(privacy.WORD.finditer(text, b, right))[:reach]
            for w in words:
                if not any(w.start() < e and s < w.end() for _, s, e in spans):
                    yield a, b, w[0], w.span()

    single = "ask quillfeather at solo@corp.example shan"
    twice = [f"{prose(9, 700 + i)}\nthe marrowbone desk, pair@corp.example, shan" for i in range(2)]
    copied = [f"{prose(5, 800 + i)} copy{'abc'[i]}word mail copy{i}@corp.example" for i in range(3)]
    plain = [prose(25, i) for i in range(400)]
    for others in (plain, plain[:40]):
        # in the short table one text is too little to judge by, and eight copies of it are no more
        texts = [*others, single, *twice, *copied * 8, None]
        docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
        more = {
            r.doc_id: {(s.kind, s.start, s.end) for s in r.spans if s.kind in ("general", "remove")}
            for r in privacy.find(docs).collect()
        }
        want = expected([t or "" for t in texts])
        assert more == {i: want.get(t or "", set()) for i, t in enumerate(texts)}
        of_single = {single[a:b] for _, a, b in more[len(others)]}
        assert ("quillfeather" in of_single) == (others is plain) and "shan" not in of_single
        assert all(bool(more[i]) == (others is plain) for i, t in enumerate(texts) if t in copied)


def test_neighbours_by_words_to_the_ends_of_the_line():
    def near(text, reach=2):
        return [(r["term"], r["start"], r["end"]) for r in privacy.neighbours(text, privacy.base_spans(text), reach)]

    gap, long = " " * 300, "x" * 400
    text = f"above\none two{gap}a@b.cd{gap}three four five\nbelow"
    assert [t for t, _, _ in near(text)] == ["one", "two", "three", "four"]
    assert [t for t, _, _ in near(f"{long} a@b.cd {long}y")] == [long, long + "y"]
    assert near("a@b.cd") == near("12 a@b.cd .") == [(None, None, None)]
    # a word that runs into a mention is none of the line's words beside it, nor is one inside a mention
    assert [t for t, _, _ in near("öff éaaa@b.cd weit", 3)] == ["öff", "weit"]
    assert [t for t, _, _ in near("see 1.2.3.4 a@b.cd", 3)] == ["see", "see"]
    assert [t for t, _, _ in near("x@y.zz\n\nfar x@y.zz")] == [None, "far"]


def test_many_mentions_in_one_line_take_linear_time():
    text = "word a@b.cd " * 30_000
    rows = privacy.neighbours(text, privacy.base_spans(text), 6)
    assert len(rows) > 100_000 and {r["term"] for r in rows} == {"word"}


def test_entities_without_neighbours_count(spark, prose):
    """The entity stands alone in nine of ten texts, so the one with a word beside it discloses little."""
    plain = [prose(25, i) for i in range(60)]
    for alone in (0, 40):
        texts = [*plain, *["x@corp.example\n" + prose(5, 900 + i) for i in range(alone)], "zanzibar x@corp.example"]
        found = privacy.find(spark.createDataFrame([(t,) for t in texts], "text string"), share=0.6).collect()
        n_e, n = alone + 1, len(texts)
        pmi = math.log((1 + 2 * n_e / n) / 3 / (n_e / n))
        assert any(s.kind == "remove" for r in found for s in r.spans) == (pmi > 0 and pmi >= -0.6 * math.log(n_e / n)) == (not alone)


def test_masks_without_a_key(spark):
    rows = [(None, "mail x@y.z", 1, "s"), (None, "mail x@y.z", 1, "s"), (7, None, 2, "s"), (7, "", 3, "s")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _whole int, spans string")
    got = privacy.sanitise(docs)
    assert got.columns == ["doc_id", "text", "_whole"] and got.limit(0).count() == 0
    want = [(None, "mail [EMAIL]", 1)] * 2 + [(7, None, 2), (7, "", 3)]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)


def test_masks(spark):
    assert privacy.masked("ask x@y.z or zed", [("email", 4, 9), ("remove", 13, 16)]) == "ask [EMAIL] or "
    docs = spark.createDataFrame([(1, "mail x@y.z", "k"), (2, None, "k")], "doc_id long, text string, extra string")
    assert sorted(map(tuple, privacy.sanitise(docs).collect())) == [(1, "mail [EMAIL]", "k"), (2, None, "k")]
