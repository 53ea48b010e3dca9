"""Line deduplication by overlapping windows of three lines (operator 8)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeworks.llm.common import stored, text_of

WINDOW = 3


def later_windows(docs: DataFrame) -> DataFrame:
    """(doc_id, digest, spans): per text the windows, as (first line, last line), that came before.

    A window is three consecutive lines that are not blank; a text with fewer has one window, all of
    them. Of equal windows the first by doc_id, digest and place stays.
    """
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.unhex(F.md5(text_of())).alias("digest"),
        F.split(text_of(), "\n").alias("lines"),
    )
    numbered = F.transform("lines", lambda x, i: F.struct(i.alias("at"), x.alias("line")))
    full = rows.select("doc_id", "digest", F.filter(numbered, lambda s: F.trim(s["line"]) != "").alias("full"))
    last = F.greatest(F.size("full") - WINDOW + 1, F.lit(1))

    def window(k):
        part = F.slice("full", k, F.lit(WINDOW))
        return F.struct(
            F.unhex(F.md5(F.concat_ws("\n", F.transform(part, lambda s: s["line"])))).alias("hash"),
            F.element_at(part, 1)["at"].alias("first"),
            F.element_at(part, -1)["at"].alias("last"),
        )

    windows = stored(
        full.where(F.size("full") > 0)
        .select("doc_id", "digest", F.explode(F.transform(F.sequence(F.lit(1), last), window)).alias("w"))
        .select("doc_id", "digest", "w.hash", "w.first", "w.last"),
        "line-windows",
    )
    # Rows without an id come last. Counting combines ahead of the shuffle, however common a window is.
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "digest", "first")
    known = (
        windows.groupBy("hash")
        .agg(F.count("*").alias("times"), F.min(place).alias("kept"))
        .where("times > 1")
        .select("hash", "kept")
    )
    here = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "digest", "first")
    return (
        windows.join(known, "hash")
        .where(~here.eqNullSafe(F.col("kept")))
        .groupBy("doc_id", "digest")
        .agg(F.collect_set(F.struct("first", "last")).alias("spans"))  # at most the lines of one text
    )


def deduplicate(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` without later occurrences of repeated three-line windows, and n_lines, n_removed (long).

    The lines that later windows cover, merged where windows overlap, go, with blank lines between
    them. A null text stays null and has no lines; an empty text has one, which is blank and stays.
    Blank lines (spaces only) are part of no window. Rows that repeat both doc_id and text are
    treated alike, so the first occurrence may be in each of them; rows without doc_id come last.
    Columns n_lines and n_removed of ``docs`` are replaced, all others are passed on.
    """
    kept = docs.drop("n_lines", "n_removed")
    names = kept.columns
    found = stored(later_windows(kept.select("doc_id", F.col(text).alias("text"))), "later-windows")
    # Names of given columns may clash, so they travel in one struct; the text travels once, beside it.
    others = [F.col(f"`{c}`") for c in names if c != text]
    whole = kept.select(
        F.struct(*others).alias("_given"),  # doc_id is among them
        F.col("doc_id").cast("long").alias("_id"),
        F.unhex(F.md5(text_of(text))).alias("_digest"),
        F.col(text).alias("_text"),
    )
    hit = found.select(F.col("doc_id").alias("_other"), F.col("digest").alias("_same"), "spans")
    joined = whole.join(hit.hint("merge"), F.expr("_id <=> _other AND _digest = _same"), "left").select("_given", "_text", "spans")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for big in batches:
            for begin in range(0, big.num_rows, 256):
                batch = big.slice(begin, 256)
                out = [
                    without(value, spans)
                    for value, spans in zip(batch.column("_text").to_pylist(), batch.column("spans").to_pylist(), strict=True)
                ]
                texts, lines, removed = zip(*out, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("_given"),
                        pa.array(texts, pa.string()),
                        pa.array(lines, pa.int64()),
                        pa.array(removed, pa.int64()),
                    ],
                    ["_given", "_text", "n_lines", "n_removed"],
                )

    given = joined.schema["_given"]
    done = joined.mapInArrow(run, f"_given {given.dataType.simpleString()}, _text string, n_lines long, n_removed long")
    columns = [F.col("_text" if c == text else f"_given.`{c}`").alias(c) for c in names]
    return done.select(*columns, "n_lines", "n_removed")


def without(text: str | None, spans: list[dict] | None) -> tuple[str | None, int, int]:
    if text is None:
        return None, 0, 0
    lines = text.split("\n")
    if not spans:
        return text, len(lines), 0
    edge = np.zeros(len(lines) + 1, dtype=np.int64)
    for s in spans:
        edge[s["first"]] += 1
        edge[s["last"] + 1] -= 1
    covered = np.cumsum(edge[:-1]) > 0
    return "\n".join(x for x, gone in zip(lines, covered.tolist(), strict=True) if not gone), len(lines), int(covered.sum())


SQL = """
    WITH lines AS (
        SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
            unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS pos
        FROM documents
    ), filled AS (
        SELECT *, row_number() OVER w AS k, count(*) OVER (PARTITION BY doc_id) AS n,
            lead(line, 1) OVER w AS line2, lead(line, 2) OVER w AS line3,
            lead(pos, 1) OVER w AS pos2, lead(pos, 2) OVER w AS pos3
        FROM lines WHERE trim(line) <> '' WINDOW w AS (PARTITION BY doc_id ORDER BY pos)
    ), windows AS (
        SELECT doc_id, pos AS first, coalesce(pos3, pos2, pos) AS last, concat_ws(chr(10), line, line2, line3) AS part
        FROM filled WHERE k <= greatest(n - 2, 1)
    ), later AS (
        SELECT doc_id, first, last FROM windows
        QUALIFY row_number() OVER (PARTITION BY part ORDER BY doc_id, first) > 1
    ), marked AS (
        SELECT l.*, EXISTS (SELECT 1 FROM later w WHERE w.doc_id = l.doc_id AND l.pos BETWEEN w.first AND w.last) AS gone
        FROM lines l
    )
    SELECT doc_id, coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '') AS text,
        count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_removed
    FROM marked GROUP BY doc_id
"""
