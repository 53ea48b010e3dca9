"""Ranked lexical search by bundles of items that pass through the owners of terms (operator 12)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gaugeworks.llm.common import _BASE, _LOWER, _POWERS, mixed, stored, text_of

TOP = 50
#: Items in a bundle, and documents in a block: together the limit of what one group holds.
BUNDLE, BLOCK = 128, 2048
#: Bits of the filter that keeps terms of no item out of the shuffles. A full filter costs time, not results.
FILTER = 20
#: Owners in their order. A term belongs to the first whose share of the documents it does not exceed.
OWNERS = (1 / 256, 1 / 64, 1 / 16, 1.0)

#: Bytes of a term: digits, letters, and all of a character beyond ASCII.
_TERM = np.zeros(256, dtype=bool)
_TERM[48:58] = _TERM[65:91] = _TERM[97:123] = _TERM[128:] = True


def term_hashes(data: np.ndarray) -> np.ndarray:
    """A 64-bit hash of every term of a text given as UTF-8 bytes, with repeats, A-Z as a-z."""
    n = len(data)
    inside = np.zeros(n + 2, dtype=bool)
    inside[1:-1] = _TERM[data]
    edge = np.flatnonzero(inside[1:] != inside[:-1])
    start, end = edge[::2], edge[1::2]
    if not len(start):
        return np.empty(0, dtype=np.uint64)
    _POWERS.reach(n + 1)
    total = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(_LOWER[data] * _POWERS.up[:n], out=total[1:])
    return mixed((total[end] - total[start]) * _POWERS.down[start] + (end - start).astype(np.uint64) * _BASE)


def looked_up(terms: np.ndarray, places: np.ndarray) -> np.ndarray:
    """What a filter says of terms; its places are told by the highest bits of a term."""
    high = np.uint64(65 - len(places).bit_length())
    return places[(terms.view(np.uint64) >> high).astype(np.int64)]


def counted(rows: DataFrame, wanted: np.ndarray | None = None) -> DataFrame:
    """The rows (long columns and ``text``) with n, terms and tfs for the text: how many terms it has, its
    distinct ones and their counts. With ``wanted``, a filter of ``2**FILTER`` places, the latter two hold
    those that pass it; ``n`` counts all."""
    keys = [c for c in rows.columns if c != "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for begin in range(0, whole.num_rows, 512):
                batch = whole.slice(begin, 512)
                sizes, terms, tfs = [], [], []
                for text in batch.column("text"):
                    found = term_hashes(np.frombuffer(text.as_buffer() or b"", dtype=np.uint8))
                    sizes.append(len(found))
                    if wanted is not None:
                        found = found[looked_up(found, wanted)]
                    own, times = np.unique(found, return_counts=True)
                    terms.append(own.view(np.int64))
                    tfs.append(times)
                columns = [*(batch.column(k) for k in keys), pa.array(sizes, pa.int64()), lists(terms), lists(tfs)]
                yield pa.RecordBatch.from_arrays(columns, [*keys, "n", "terms", "tfs"])

    schema = ", ".join(f"{k} long" for k in keys)
    return rows.mapInArrow(run, f"{schema}, n long, terms array<bigint>, tfs array<bigint>")


def lists(arrays: list[np.ndarray]) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, arrays)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(arrays).astype(np.int64)))


def filtered(terms: DataFrame, value: Column) -> np.ndarray:
    """The filter: for every place the bits of ``value`` of its terms. At most ``2**FILTER`` rows are collected."""
    out = np.zeros(1 << FILTER, dtype=np.int64)
    place = F.shiftrightunsigned("term", 64 - FILTER).alias("place")
    rows = terms.groupBy(place).agg(F.bit_or(value.cast("long")).alias("value")).toPandas()
    out[rows["place"].to_numpy(dtype=np.int64)] = rows["value"].to_numpy(dtype=np.int64)
    return out


def dealt(docs: DataFrame, owners: np.ndarray) -> DataFrame:
    """The postings of documents (block, row, doc_id, terms, parts), a row for each owner that has some."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            terms, parts = batch.column("terms"), batch.column("parts")
            doc = np.repeat(np.arange(batch.num_rows), pc.list_value_length(terms).to_numpy())
            term, part = terms.flatten().to_numpy(), parts.flatten().to_numpy()
            whose = looked_up(term, owners)
            for k in range(len(OWNERS)):
                mine = whose >> k & 1 == 1  # some places are shared; a term of another owner finds no item
                ends = np.searchsorted(doc[mine], np.arange(batch.num_rows + 1)).astype(np.int32)
                out = pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(batch.num_rows, k), pa.int64()),
                        *(batch.column(c) for c in ("block", "row", "doc_id")),
                        *(pa.ListArray.from_arrays(pa.array(ends), pa.array(x[mine])) for x in (term, part)),
                    ],
                    ["owner", "block", "row", "doc_id", "terms", "parts"],
                )
                yield out.filter(pa.array(np.diff(ends) > 0))

    return docs.mapInArrow(run, "owner long, block long, row long, doc_id long, terms array<bigint>, parts array<bigint>")


ACCUMULATORS = "bundle long, block long, item long, row long, doc_id long, score long"


def visited(key: tuple, held: pa.Table, postings: pa.Table) -> pa.Table:
    """What a bundle carries on for a block of documents after it has met an owner's postings there.

    ``held`` has a row for each item, with its ``terms`` and ``weights`` of this owner and the least score
    it goes on with (``need``), and a row for each accumulator.
    """
    plan = held.filter(pc.is_valid(held["terms"])).sort_by("item").combine_chunks()
    have = held.filter(pc.is_valid(held["row"])).combine_chunks()
    postings = postings.combine_chunks()
    items, need = plan["item"].to_numpy(), plan["need"].to_numpy()
    wanted, weight = (plan[c].combine_chunks().flatten().to_numpy() for c in ("terms", "weights"))
    item_of = np.repeat(np.arange(len(items)), pc.list_value_length(plan["terms"]).to_numpy())
    order = np.argsort(wanted, kind="stable")
    wanted, weight, item_of = wanted[order], weight[order], item_of[order]

    rows = np.concatenate([postings["row"].to_numpy(), have["row"].to_numpy()])
    ids = pa.chunked_array([*postings["doc_id"].chunks, *have["doc_id"].chunks], pa.int64()).combine_chunks()
    rows, source, where = np.unique(rows, return_index=True, return_inverse=True)
    doc_of = np.repeat(where[: len(postings)], pc.list_value_length(postings["terms"]).to_numpy())
    term, part = (postings[c].combine_chunks().flatten().to_numpy() for c in ("terms", "parts"))

    # At most the items of a bundle times the documents of a block.
    score = np.zeros((len(items), len(rows)), dtype=np.int64)
    score[np.searchsorted(items, have["item"].to_numpy()), where[len(postings) :]] = have["score"].to_numpy()
    first, last = (np.searchsorted(wanted, term, side) for side in ("left", "right"))
    asked = np.flatnonzero(last > first)
    for begin in range(0, len(asked), 1 << 14):  # a posting is repeated for each item that asks for its term
        some = asked[begin : begin + (1 << 14)]
        times = last[some] - first[some]
        which = np.repeat(some, times)
        entry = np.arange(len(which)) - np.repeat(np.cumsum(times) - times, times) + first[which]
        np.add.at(score, (item_of[entry], doc_of[which]), weight[entry] * part[which])

    item, at = np.nonzero((score > 0) & (score >= need[:, None]))
    bundle, block = (k.as_py() for k in key)
    return pa.table(
        {
            "bundle": np.full(len(item), bundle, dtype=np.int64),
            "block": np.full(len(item), block, dtype=np.int64),
            "item": items[item].astype(np.int64),
            "row": rows[at].astype(np.int64),
            "doc_id": ids.take(pa.array(source[at])),
            "score": score[item, at],
        }
    )


def ranked(scores: DataFrame, top: int) -> DataFrame:
    """The ``top`` best of each item with their rank. Each task sends its own best only."""
    best = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last(), "row")
    return scores.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)


def search(documents: DataFrame, items: DataFrame, top: int = TOP) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``top`` best documents for each item, by whole-number scores.

    Terms are split among owners, rare terms first. A bundle of items visits one owner after the other
    and carries, for each block of documents, its accumulators: the scores so far. After each visit an
    item's ``top``-th best score so far is a bound from below; a document that cannot reach it with all
    that the remaining owners could add is dropped, which never changes the result.

    A null text has no term. Documents without doc_id are documents, ranked last among equals and
    returned with null; repeated rows are documents of their own. Items without item_id are left out;
    rows with one item_id are one item with the terms of all. Empty tables give an empty result.
    Further columns are not read. Terms are told apart by 64-bit hashes.
    """
    texts = items.where("item_id IS NOT NULL").select(F.col("item_id").cast("long").alias("item"), text_of().alias("text"))
    asked = stored(counted(texts).select("item", F.explode("terms").alias("term")).distinct(), "search-asked")
    rows = documents.select(
        F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text")
    )
    docs = stored(counted(rows, filtered(asked, F.lit(1)) > 0), "search-documents")
    total = docs.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    n_docs, n_terms, blocks = total[0], max(1, total[1]), max(1, -(-total[2] // BLOCK))
    m = F.expr(f"50 + (50 * n * {n_docs}L) div {n_terms}L").alias("m")
    parts = F.expr("transform(tfs, tf -> (1000000000L * tf) div (1000 * tf + 20 * m))").alias("parts")
    block = F.pmod(F.xxhash64("row"), F.lit(blocks)).alias("block")
    docs = docs.where(F.size("terms") > 0).select(block, "row", "doc_id", "terms", "tfs", m)
    docs = docs.select("block", "row", "doc_id", "terms", parts)

    found = docs.select(F.explode(F.arrays_zip("terms", "parts")).alias("e")).select("e.terms", "e.parts")
    known = found.groupBy(F.col("terms").alias("term")).agg(F.count("*").alias("df"), F.max("parts").alias("most"))
    weight = F.floor(1000 * F.log((F.lit(2.0 * n_docs) + 2) / (2 * F.col("df") + 1))).cast("long")
    owner = F.lit(len(OWNERS) - 1)
    for k in reversed(range(len(OWNERS) - 1)):
        owner = F.when(F.col("df") <= int(OWNERS[k] * n_docs), F.lit(k)).otherwise(owner)
    terms = known.select("term", weight.alias("weight"), "most", owner.alias("owner")).where("weight > 0")
    terms = stored(terms.join(asked.select("term").distinct(), "term"), "search-terms")
    bundles = max(1, -(-asked.select("item").distinct().count() // BUNDLE))
    bundle = F.pmod(F.xxhash64("item"), F.lit(bundles)).alias("bundle")
    plans = stored(asked.join(terms, "term").withColumn("bundle", bundle), "search-plans")
    postings = stored(dealt(docs, filtered(terms, F.expr("shiftleft(1L, owner)"))), "search-postings", "owner")

    state = None
    for k in range(len(OWNERS)):
        mine = F.col("owner") == k
        rest = F.coalesce(F.sum(F.when(F.col("owner") > k, F.col("weight") * F.col("most"))), F.lit(0))
        plan = plans.groupBy("bundle", "item").agg(
            F.collect_list(F.when(mine, F.struct("term", "weight"))).alias("own"), rest.alias("rest")
        )
        reached = F.lit(0).cast("long")
        if state is not None:
            bound = ranked(state, top).where(F.col("rank") == top).select("item", F.col("score").alias("reached"))
            plan, reached = plan.join(bound, "item", "left"), F.coalesce("reached", F.lit(0))
        empty = [F.lit(None).cast("long").alias(c) for c in ("row", "doc_id", "score")]
        held = plan.select(
            "bundle",
            F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))).alias("block"),
            "item",
            *empty,
            F.col("own.term").alias("terms"),
            F.col("own.weight").alias("weights"),
            (reached - F.col("rest")).alias("need"),
        )
        if state is not None:
            held = held.unionByName(state, allowMissingColumns=True)
        there = postings.where(mine).select(
            F.explode(F.sequence(F.lit(0).cast("long"), F.lit(bundles - 1).cast("long"))).alias("bundle"),
            "block", "row", "doc_id", "terms", "parts",
        )
        visit = held.groupBy("bundle", "block").cogroup(there.groupBy("bundle", "block")).applyInArrow(visited, ACCUMULATORS)
        state = stored(visit, f"search-visit-{k}")
    return ranked(state, top).select(F.col("item").alias("item_id"), "rank", "doc_id", "score")


SQL = r"""
    WITH words AS (
        SELECT row_number() OVER () AS k, doc_id, unnest(regexp_extract_all(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
        FROM documents
    ), held AS (
        SELECT k, any_value(doc_id) AS doc_id, term, count(*) AS tf FROM words GROUP BY k, term
    ), sizes AS (
        SELECT k, count(*) AS n FROM words GROUP BY k
    ), total AS (
        SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM sizes
    ), weights AS (
        SELECT term, CAST(floor(1000 * ln((2.0::DOUBLE * docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
        FROM held, total GROUP BY term, docs
    ), asked AS (
        SELECT DISTINCT item_id, unnest(regexp_extract_all(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
        FROM benchmark
    ), scored AS (
        SELECT item_id, k, any_value(doc_id) AS doc_id,
            CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * docs) // terms)))) AS BIGINT) AS score
        FROM asked JOIN held USING (term) JOIN weights USING (term) JOIN sizes USING (k), total GROUP BY item_id, k
    )
    SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id, k) AS INTEGER) AS rank, doc_id, score
    FROM scored WHERE score > 0 AND item_id IS NOT NULL QUALIFY rank <= 50
"""
