import re
from collections import Counter

import pytest

from gaugeworks.llm import rules


def counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    runs = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    times = Counter(runs)
    covered = {i + d for i, r in enumerate(runs) if times[r] > 1 for d in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    n, again = len(words), len(covered)
    return (
        n,
        sum(map(len, words)),
        len(re.findall(r"[#*$%&|<>]", text)),
        len(lines) - len(set(lines)),
        again,
        n < 50 or 100 * again > 50 * n,
    )


def test_counts_equal_brute_force(documents, corpus):
    got = Counter(tuple(r)[:7] for r in rules.verdicts(documents).collect())
    assert got == Counter((key, *counts(t)) for key, t in corpus)


@pytest.mark.parametrize(
    "text",
    [
        "a a a a", "a b c a b c", "a b c d a b c", "a b a b a", "x y", "x y z", "\t\n", "é ü ö é ü ö",
        "w " * 3000, " ".join(f"w{i % 700}" for i in range(2100)), "  a b c a b c",
        "*\n* \n*\n x\nx\n x", "\x00 \x1c \x00", "a|b|<c>&%$#*",
    ],
)
def test_repeats_and_odd_texts(spark, text):
    row = rules.verdicts(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert tuple(row)[1:7] == counts(text)


def test_table_of_thresholds(spark):
    fine = " ".join(f"word{i} the river{i}" for i in range(30)) + "."
    cases = {
        "fine": (fine, []),
        "symbols": (fine.replace("river", "###"), ["symbols"]),
        "stop": (fine.replace("the", "xqz"), ["stop_words"]),
        "lines": ("\n".join([fine, *["same again"] * 4]), ["same_lines"]),
        "long": (" ".join(f"the x{'y' * 50}{i}" for i in range(40)), ["word_length"]),
        "list": ("\n".join(f"- the item{i} of {i}" for i in range(30)), ["list_lines"]),
        "cut": ("\n".join(f"the item{i} of {i} ..." for i in range(30)), ["cut_lines"]),
        "loud": (fine.replace(" the", "! the"), ["exclamations"]),
        "short": ("the short text", ["few_words"]),
    }
    docs = spark.createDataFrame([(k, t) for k, (t, _) in cases.items()], "kept string, text string")
    rows = {r.text: r for r in rules.judge(docs).collect()}
    for text, broken in cases.values():
        assert rows[text].broken == broken and rows[text].kept == (not broken)
    loose = rules.judge(docs, [rules.Rule("any", "n_words", low=0)], base=[rules.Rule("none", "n_words", high=10**9)])
    assert all(r.kept for r in loose.collect())


def test_given_columns_stay(documents, no_documents):
    judged = rules.judge(documents.withColumn("kept", documents.lang).withColumnRenamed("spans", "_0"))
    assert judged.columns[:7] == ["doc_id", "text", "lang", "source", "n_chars", "_given", "_0"]
    assert judged.schema["kept"].dataType.simpleString() == "boolean"
    assert judged.where("text IS NULL").select("n_words", "kept").distinct().collect() == [(0, False)]
    assert rules.judge(no_documents).count() == 0 and rules.verdicts(no_documents).count() == 0


def test_no_user_function_and_no_shuffle(documents):
    plan = rules.verdicts(documents.coalesce(1))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and plan.count("Exchange") <= 1  # the fixture's own
