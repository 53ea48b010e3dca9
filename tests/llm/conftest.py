import random

import pytest

from gaugeworks.llm.common import ship

DOCS = "doc_id long, text string, lang string, source string, n_chars long, _given string, spans string, n_lines string"
WORDS = [a + b for a in ("sha", "tor", "lin", "mek", "dov", "pra", "uni", "öst") for b in ("n", "ra", "mil", "ket", "ös", "vi")]


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    ship(spark.sparkContext)


@pytest.fixture(scope="session")
def prose():
    """Texts of random words, the same for the same seed."""

    def make(count, seed, per_line=9):
        rng = random.Random(seed)
        words = [rng.choice(WORDS) + rng.choice(("", "", ",", ".")) for _ in range(count)]
        return "\n".join(" ".join(words[i : i + per_line]) for i in range(0, count, per_line))

    return make


@pytest.fixture(scope="session")
def corpus(prose):
    """(doc_id, text) with copies, near copies, a shared passage, nulls, empty and long texts, repeated rows."""
    passage, base = prose(60, 900), prose(150, 901)
    rows = [(i, prose(20 + 7 * i, i)) for i in range(30)]
    rows += [(100 + i, base) for i in range(4)]
    rows += [(120 + i, base.replace(base.split()[40 + 5 * i], f"changed{i}", 1)) for i in range(6)]
    rows += [(150 + i, prose(40, 50 + i) + "\n" + passage + "\n" + prose(15, 80 + i)) for i in range(5)]
    rows += [(200, None), (201, None), (202, ""), (203, "  \n \n"), (204, "one"), (205, "one"), (206, "two words")]
    rows += [(300, "x" * 5000), (301, "ab" * 2500), (302, prose(6000, 7)), (303, "é" * 300 + "é" * 300)]
    rows += [(400, prose(40, 400)), (400, prose(40, 400)), (None, prose(30, 401)), (None, prose(30, 401)), (None, None)]
    return rows


@pytest.fixture(scope="session")
def documents(spark, corpus):
    """The corpus as a table with further columns, some of them named like internal ones."""
    rows = [(i, t, "en", "s", None if t is None else len(t), "g", "s", "n") for i, t in corpus]
    return spark.createDataFrame(rows, DOCS).repartition(3)


@pytest.fixture(scope="session")
def no_documents(spark):
    return spark.createDataFrame([], DOCS)
