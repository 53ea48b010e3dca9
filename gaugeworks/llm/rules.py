"""Quality rules: a table of thresholds compiled into one projection (operator 13)."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeworks.llm.common import text_of

WORD = r"[^\x20\x09-\x0D]+"
GAP = r"[\x20\x09-\x0D]+"
SYMBOL = r"[#*$%&|<>]"

# --- Fixed values: frequent short words of English, French, German and Spanish ---
STOP_WORDS = (
    "the and of to a in is that it was for on with this as be are by from at "
    "de la et le des les un en du pour une est que qui par au sur dans pas avec "
    "der die und von den das zu mit sich auf nicht für ein im ist dem eine als "
    "el se y los del para las no es con su una por al"
).split()


@dataclass(frozen=True)
class Rule:
    """``low <= 1000 * part / whole <= high``; a bound that is None holds for everything.

    ``part`` and ``whole`` name measures; a ``whole`` of None compares ``part`` itself, not thousandths.
    It is decided in whole numbers. A text without any ``whole`` meets the rule.
    """

    name: str
    part: str
    whole: str | None = None
    low: int | None = None
    high: int | None = None

    def broken(self) -> Column:
        value = F.col(self.part) * (1 if self.whole is None else 1000)
        scale = F.lit(1) if self.whole is None else F.col(self.whole)
        tests = [value < self.low * scale] if self.low is not None else []
        tests += [value > self.high * scale] if self.high is not None else []
        return reduce(Column.__or__, tests, F.lit(False))


#: The first two are the base; the others are the verdict of the table.
BASE = (
    Rule("few_words", "n_words", low=50),
    Rule("repeated_words", "n_repeat_words", "n_words", high=500),
)
RULES = (
    Rule("word_length", "word_chars", "n_words", low=2000, high=12000),
    Rule("symbols", "n_symbols", "n_words", high=100),
    Rule("exclamations", "n_marks", "n_words", high=200),
    Rule("stop_words", "n_stop_words", "n_words", low=20),
    Rule("same_lines", "n_dup_lines", "n_lines", high=300),
    Rule("list_lines", "n_list_lines", "n_lines", high=900),
    Rule("cut_lines", "n_cut_lines", "n_lines", high=300),
)
MEASURES = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
    "n_marks", "n_stop_words", "n_lines", "n_list_lines", "n_cut_lines",
)


def _count(items: str, test) -> Column:
    return F.size(F.filter(items, test)).cast("long")


def _without(pattern: str) -> Column:
    """How many characters of the text the pattern takes."""
    return (F.char_length("_text") - F.char_length(F.regexp_replace("_text", pattern, ""))).cast("long")


def measure(rows: DataFrame) -> DataFrame:
    """The columns of ``rows`` but ``_text``, and the measures of that column as long.

    Everything is an expression over one row, so nothing is shuffled and no user function runs. Arrays
    are dropped as soon as they are counted.
    """
    kept = [c for c in rows.columns if c != "_text"]
    bare = F.btrim("_text", F.lit(" \t\n\x0b\f\r"))
    rows = rows.select(
        *kept,
        F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, GAP)).alias("_words"),
        F.filter(F.split("_text", "\n"), lambda line: line.rlike(WORD)).alias("_lines"),
        F.length(F.bin(F.char_length("_text"))).alias("_bits"),  # what a place in the text needs
        _without(SYMBOL).alias("n_symbols"),
        _without("[!?]").alias("n_marks"),
    )
    # A number for each run of three words: its place below, as much of its hash as fits above. Sorted,
    # runs that may be equal are neighbours; those few are compared by their words.
    run = "transform(sequence(0, size(_words) - 3), i -> shiftleft(xxhash64(get(_words, i), get(_words, i + 1), get(_words, i + 2)), _bits) | i)"
    rows = rows.select(
        *kept,
        "n_symbols",
        "n_marks",
        F.size("_words").cast("long").alias("n_words"),
        F.char_length(F.array_join("_words", "")).cast("long").alias("word_chars"),
        _count("_words", lambda w: F.lower(w).isin(STOP_WORDS)).alias("n_stop_words"),
        F.size("_lines").cast("long").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        _count("_lines", lambda x: x.rlike(r"^[\x20\x09-\x0D]*[-*•]")).alias("n_list_lines"),
        _count("_lines", lambda x: x.rlike(r"(\.\.\.|…)[\x20\x09-\x0D]*$")).alias("n_cut_lines"),
        "_words",
        "_bits",
        F.when(F.size("_words") >= 3, F.sort_array(F.expr(run))).alias("_runs"),
    )
    counted = [c for c in rows.columns if c not in ("_words", "_bits", "_runs")]
    high = F.expr("transform(_runs, r -> shiftright(r, _bits))").alias("_high")
    rows = rows.select(*counted, "_words", "_bits", "_runs", high)
    twins = F.expr("filter(sequence(0, size(_high) - 2), k -> get(_high, k) = get(_high, k + 1))")
    recurs = F.size(F.array_distinct("_high")) < F.size("_high")
    rows = rows.select(*counted, "_words", "_bits", "_runs", F.when(recurs, twins).alias("_twins"))
    near = "array_distinct(flatten(transform(_twins, k -> slice(_runs, k + 1, 2))))"
    place = "CAST(r & (shiftleft(1L, _bits) - 1) AS INT)"
    words = f"concat_ws(' ', slice(_words, {place} + 1, 3))"
    rows = rows.select(*counted, F.expr(f"sort_array(transform({near}, r -> struct({words} AS run, {place} AS at)))").alias("_placed"))
    same = lambda p, k: F.coalesce(p["run"] == F.get("_placed", k)["run"], F.lit(False))
    again = F.filter("_placed", lambda p, k: same(p, k - 1) | same(p, k + 1))
    rows = rows.select(*counted, F.sort_array(F.transform(again, lambda p: p["at"])).alias("_at"))
    covered = F.transform("_at", lambda x, k: F.least(F.lit(3), F.coalesce(F.get("_at", k + 1) - x, F.lit(3))))
    repeated = F.coalesce(F.aggregate(covered, F.lit(0), lambda a, b: a + b), F.lit(0))
    return rows.select(*counted, repeated.cast("long").alias("n_repeat_words"))


def judge(docs: DataFrame, rules: Sequence[Rule] = RULES, text: str = "text", base: Sequence[Rule] = BASE) -> DataFrame:
    """``docs`` with the measures (long), base_failed, broken (names of the rules that a text breaks) and kept.

    A null text counts as empty: all measures are 0, the base fails and the row is not kept. Each row
    is judged by itself, so repeated rows and rows without an id are judged alike; an empty table gives
    an empty one. Columns of ``docs`` with the names of results are replaced, all others passed on.
    """
    added = (*MEASURES, "base_failed", "broken", "kept")
    # Given columns travel under numbers, as their names may clash; what the caller leaves out is not read.
    given = [F.col(f"`{c}`").alias(f"_{i}") for i, c in enumerate(docs.columns)]
    counted = measure(docs.select(*given, text_of(text).alias("_text")))
    every = (*base, *rules)
    failed = reduce(Column.__or__, [r.broken() for r in base], F.lit(False))
    return counted.select(
        *[F.col(f"_{i}").alias(c) for i, c in enumerate(docs.columns) if c not in added],
        *MEASURES,
        failed.alias("base_failed"),
        F.array_compact(F.array(*[F.when(r.broken(), F.lit(r.name)) for r in every])).cast("array<string>").alias("broken"),
        (~reduce(Column.__or__, [r.broken() for r in every], F.lit(False))).alias("kept"),
    )


def verdicts(docs: DataFrame) -> DataFrame:
    """The counts and verdict of every document, as the query returns them."""
    return judge(docs.select("doc_id", "text")).select(
        F.col("doc_id").cast("long").alias("doc_id"),
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
    )


def _sql(rules: Sequence[Rule]) -> str:
    parts = []
    for r in rules:
        value, scale = (r.part, "1") if r.whole is None else (f"1000 * {r.part}", r.whole)
        parts += [f"{value} < {r.low} * {scale}"] if r.low is not None else []
        parts += [f"{value} > {r.high} * {scale}"] if r.high is not None else []
    return " OR ".join(parts)


SQL = rf"""
    WITH texts AS (
        SELECT row_number() OVER () AS k, doc_id, coalesce(text, '') AS text FROM documents
    ), split AS (
        SELECT *, regexp_extract_all(text, '{WORD}') AS words,
            list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '{WORD}')) AS lines
        FROM texts
    ), placed AS (
        SELECT k, unnest(words) AS w, unnest(range(len(words))) AS i FROM split
    ), runs AS (
        SELECT k, i, w, lead(w, 1) OVER p AS w2, lead(w, 2) OVER p AS w3 FROM placed WINDOW p AS (PARTITION BY k ORDER BY i)
    ), again AS (
        SELECT k, i FROM runs WHERE w3 IS NOT NULL
        QUALIFY count(*) OVER (PARTITION BY k, w, w2, w3) > 1
    ), covered AS (
        SELECT k, count(DISTINCT i + d) AS n_repeat_words FROM again, (VALUES (0), (1), (2)) o(d) GROUP BY k
    ), counted AS (
        SELECT s.doc_id, len(words) AS n_words,
            CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
            CAST(length(text) - length(regexp_replace(text, '{SYMBOL}', '', 'g')) AS BIGINT) AS n_symbols,
            CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
            coalesce(c.n_repeat_words, 0) AS n_repeat_words,
            length(text) - length(regexp_replace(text, '[!?]', '', 'g')) AS n_marks,
            len(list_filter(words, lambda x: lower(x) IN ({", ".join(f"'{w}'" for w in STOP_WORDS)}))) AS n_stop_words,
            len(lines) AS n_lines,
            len(list_filter(lines, lambda x: regexp_matches(x, '^[\x20\x09-\x0D]*[-*•]'))) AS n_list_lines,
            len(list_filter(lines, lambda x: regexp_matches(x, '(\.\.\.|…)[\x20\x09-\x0D]*$'))) AS n_cut_lines
        FROM split s LEFT JOIN covered c USING (k)
    )
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
        {_sql(BASE)} AS base_failed, NOT ({_sql((*BASE, *RULES))}) AS kept
    FROM counted
"""
