"""Removal of repeated byte strings by sharded suffix arrays (operator 2)."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeworks.llm.common import byte_hashes, low_bits, stored, text_of

#: Bytes of the pieces whose hashes select anchors.
GRAM = 32
#: Anchors a task gathers before it deals them out, and anchors of one bucket on average.
GATHERED = 2_000_000
BUCKET_ANCHORS = 2_000_000
#: Bytes of text in the suffix array of one shard.
SHARD = 2 << 20
#: Ranges by which the strings of shards that share an anchor are merged.
RANGES = 32
NOBODY = 0xFFFFFFFF


def anchors(data: np.ndarray, ends: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, places, hashes): starts of all strings of ``length`` bytes inside one text, the place of
    each string's anchor, and the hashes of pieces by place.

    The anchor is the piece of ``GRAM`` bytes with the least hash, the first of equals, so equal strings
    have equal anchors at equal offsets. ``ends`` are the ends of the texts joined in ``data``.
    """
    n, width = len(data), length - GRAM + 1
    none = np.empty(0, dtype=np.int64)
    if n < length:
        return none, none, np.empty(0, dtype=np.uint64)
    hashes = byte_hashes(data, GRAM)
    key = (hashes & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(hashes), dtype=np.uint64)
    # The least of every window, from running minima within blocks of the window's width.
    pad = -len(key) % width
    block = np.concatenate([key, np.full(pad, np.uint64(2**64 - 1))]).reshape(-1, width)
    forward = np.minimum.accumulate(block, axis=1).ravel()
    backward = np.minimum.accumulate(block[:, ::-1], axis=1)[:, ::-1].ravel()
    count = n - length + 1
    least = np.minimum(backward[:count], forward[width - 1 : width - 1 + count])
    inside = np.ones(count + length, dtype=bool)
    for end in ends:  # strings that begin in the last bytes of a text would cross its end
        inside[max(0, end - length + 1) : end] = False
    starts = np.flatnonzero(inside[:count])
    return starts, (least[starts] & np.uint64(0xFFFFFFFF)).astype(np.int64), hashes


def joined(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    ends = np.cumsum([len(t) for t in texts])
    return np.frombuffer(b"".join(texts), dtype=np.uint8), ends


def dealt_anchors(batches: Iterator[pa.RecordBatch], length: int, buckets: int) -> Iterator[dict]:
    """Rows of three kinds: 0 a text (part, row, digest); 1 anchors of a bucket; 2 anchors of a text that
    occur twice in its part, and so are known to be repeated. A part holds a text once.
    """
    task = TaskContext.get().partitionId() << 20
    part = task

    def flush() -> Iterator[dict]:
        hashes, row, place = (np.concatenate(x) for x in zip(*found, strict=True))
        order = np.argsort(hashes, kind="stable")
        hashes, row, place = hashes[order], row[order], place[order]
        start = np.flatnonzero(np.concatenate(([True], hashes[1:] != hashes[:-1])))
        run = np.diff(np.append(start, len(hashes)))
        yield from hits(part, row[np.repeat(run > 1, run)], place[np.repeat(run > 1, run)])
        first, who = hashes[start], np.where(run > 1, NOBODY, row[start]).astype("<u4")
        bucket = ((first >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
        cut = np.searchsorted(bucket, np.arange(buckets + 1, dtype=np.uint64))
        low, where = low_bits(first, buckets), place[start].astype("<u4")
        for b in range(buckets):
            if cut[b] < cut[b + 1]:
                piece = slice(cut[b], cut[b + 1])
                arrays = (x[piece].tobytes() for x in (low, who, where))
                yield {"kind": 1, "part": part, "bucket": b} | dict(zip(("hashes", "owners", "places"), arrays, strict=True))

    found, size, seen = [], 0, set()
    for whole in batches:
        for begin in range(0, whole.num_rows, 256):
            batch = whole.slice(begin, 256)
            new = [
                (digest, text)
                for digest, text in zip(batch.column("digest").to_pylist(), batch.column("text"), strict=True)
                if len(text.as_buffer() or b"") >= length and digest not in seen and not seen.add(digest)
            ]
            if not new:
                continue
            first_row = len(seen) - len(new)
            for i, (digest, _) in enumerate(new):
                yield {"kind": 0, "part": part, "row": first_row + i, "digest": digest}
            data, ends = joined([t.as_buffer().to_pybytes() for _, t in new])
            _, place, hashes = anchors(data, ends, length)
            place = np.unique(place)
            row = np.searchsorted(ends, place, side="right")
            begins = ends - np.array([len(t.as_buffer()) for _, t in new])
            found.append((hashes[place], row + first_row, place - begins[row]))
            size += len(place)
            if size > GATHERED:
                yield from flush()
                found, size, seen, part = [], 0, set(), part + 1
    if found:
        yield from flush()


def hits(part: int, row: np.ndarray, place: np.ndarray) -> Iterator[dict]:
    """Places by row, packed."""
    order = np.lexsort((place, row))
    row, place = row[order], place[order].astype("<u4")
    for at in np.split(np.arange(len(row)), np.flatnonzero(np.diff(row)) + 1) if len(row) else ():
        yield {"kind": 2, "part": part, "row": int(row[at[0]]), "places": place[at].tobytes()}


SCHEMA = pa.schema(
    [("part", pa.int64()), ("row", pa.int64()), ("digest", pa.binary()), ("bucket", pa.int32())]
    + [("hashes", pa.binary()), ("owners", pa.binary()), ("places", pa.binary()), ("kind", pa.int32())]
)


def packed(rows: Iterator[dict], schema: pa.Schema, bytes_at_once: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Rows as batches of bounded size."""
    some, size = [], 0
    for row in rows:
        some.append(row)
        size += 50 + sum(len(v) for v in row.values() if isinstance(v, bytes))
        if size > bytes_at_once or len(some) >= 5000:
            yield pa.RecordBatch.from_pylist(some, schema)
            some, size = [], 0
    if some:
        yield pa.RecordBatch.from_pylist(some, schema)


def repeated_anchors(texts: DataFrame, length: int, buckets: int) -> DataFrame:
    """(digest, places): packed places of each text's anchors that occur anywhere else."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return packed(dealt_anchors(batches, length, buckets), SCHEMA)

    def meet(pdf: pd.DataFrame) -> pd.DataFrame:
        low, owner, place = (
            np.concatenate([np.frombuffer(x, dtype="<u4") for x in pdf[c]]) for c in ("hashes", "owners", "places")
        )
        part = np.repeat(pdf["part"].to_numpy(), [len(x) // 4 for x in pdf["hashes"]])
        order = np.argsort(low, kind="stable")
        low, owner, place, part = low[order], owner[order], place[order], part[order]
        start = np.flatnonzero(np.concatenate(([True], low[1:] != low[:-1])))
        run = np.diff(np.append(start, len(low)))
        many = np.repeat(np.logical_or.reduceat(owner == NOBODY, start) | (run > 1), run) & (owner != NOBODY)
        out = []
        for p in np.unique(part[many]):
            mine = many & (part == p)
            out += hits(int(p), owner[mine].astype(np.int64), place[mine])
        return pd.DataFrame(out, columns=["part", "row", "places"])

    kinds = "part long, row long, digest binary, bucket int, hashes binary, owners binary, places binary, kind int"
    table = stored(texts.select("digest", "text").mapInArrow(run, kinds), "anchors", "kind")
    met = (
        table.where("kind = 1")
        .select("part", "bucket", "hashes", "owners", "places")
        .groupBy("bucket")
        .applyInPandas(meet, "part long, row long, places binary")
    )
    every = met.unionByName(table.where("kind = 2").select("part", "row", "places"))
    return (
        table.where("kind = 0")
        .select("part", "row", "digest")
        .join(every, ["part", "row"])
        .groupBy("digest")
        .agg(F.collect_list("places").alias("places"))  # at most the places of one text for each of its copies' parts
    )


PIECE = pa.schema(
    [("digest", pa.binary()), ("begin", pa.int64()), ("anchor", pa.int64()), ("piece", pa.binary()), ("strings", pa.int64())]
    + [("bytes", pa.binary())]
)


def pieces(texts: DataFrame, length: int) -> DataFrame:
    """(digest, begin, anchor, piece, strings, bytes): text around each repeated anchor.

    A piece holds the ``strings`` consecutive strings that have the anchor, from ``begin`` on. ``piece``
    is the digest of its bytes, which only the first row of a task with that digest carries.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        known: set[bytes] = set()
        for whole in batches:
            for begin in range(0, whole.num_rows, 256):
                batch = whole.slice(begin, 256)
                raw = [t.as_buffer().to_pybytes() for t in batch.column("text")]
                data, ends = joined(raw)
                begins = ends - np.array([len(t) for t in raw])
                starts, place, hashes = anchors(data, ends, length)
                told = [
                    np.concatenate([np.frombuffer(x, dtype="<u4") for x in places]).astype(np.int64) + b
                    for places, b in zip(batch.column("places").to_pylist(), begins, strict=True)
                ]
                wanted = np.zeros(len(data) + 1, dtype=bool)
                wanted[np.concatenate(told)] = True
                keep = wanted[place]
                starts, place = starts[keep], place[keep]
                new = np.flatnonzero(np.concatenate(([True], (place[1:] != place[:-1]) | (np.diff(starts) != 1))))
                row = np.searchsorted(ends, starts[new], side="right")
                last = np.append(new[1:], len(starts)) - 1
                digests = batch.column("digest").to_pylist()
                for k, a, b, r in zip(new, starts[new], starts[last], row, strict=True) if len(starts) else ():
                    text = data[a : b + length].tobytes()
                    piece = hashlib.md5(text).digest()
                    yield {
                        "digest": digests[r],
                        "begin": int(a - begins[r]),
                        "anchor": int(hashes[place[k]].view(np.int64)),
                        "piece": piece,
                        "strings": int(b - a + 1),
                        "bytes": None if piece in known else text,
                    }
                    known.add(piece)
                if len(known) > 1_000_000:
                    known.clear()  # some bytes are then sent twice

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return packed(cut(batches), PIECE)

    return stored(
        texts.mapInArrow(
            run, "digest binary, begin long, anchor long, piece binary, strings long, bytes binary"
        ),
        "pieces",
    )


def suffix_order(data: np.ndarray, room: np.ndarray, length: int) -> np.ndarray:
    """Positions with ``length`` bytes of room in the order of their first ``length`` bytes.

    Refinement after Larsson and Sadakane: ranks by the first 8 bytes, then by twice as many in each
    step, taking the rank of what follows as the key; groups of one are sorted and left alone.
    """
    n = len(data)
    padded = np.concatenate([data, np.zeros(8, dtype=np.uint8)])
    key = np.zeros(n, dtype=np.uint64)
    for k in range(8):
        key = (key << np.uint64(8)) | padded[k : k + n]
    order = np.flatnonzero(room >= 8)
    order = order[np.argsort(key[order], kind="stable")]
    rank = np.zeros(n, dtype=np.int64)

    def regroup(at: np.ndarray, slots: np.ndarray, fresh: np.ndarray) -> np.ndarray:
        """Ranks of positions in sorted order, given where groups begin; the mask of groups of several."""
        first = np.flatnonzero(fresh)
        size = np.diff(np.append(first, len(at)))
        rank[at] = np.repeat(slots[first], size)
        return np.repeat(size > 1, size)

    slots = np.arange(len(order))
    sorted_key = key[order]
    several = regroup(order, slots, np.concatenate(([True], sorted_key[1:] != sorted_key[:-1])))
    active, slots = order[several], slots[several]
    depth = 8
    while depth < length and len(active):
        step = min(depth, length - depth)
        alive = room[active] >= depth + step  # shorter ones are not asked for their rank any more
        active, own = active[alive], rank[active[alive]]
        slots = slots[alive]
        follow = rank[active + step]
        by = np.lexsort((follow, own))
        active, own, follow = active[by], own[by], follow[by]
        fresh = np.concatenate(([True], (own[1:] != own[:-1]) | (follow[1:] != follow[:-1])))
        # A group keeps its slots: the first of a subgroup is as far from the group's first as in the order.
        begin = np.flatnonzero(np.concatenate(([True], own[1:] != own[:-1])))
        size = np.diff(np.append(begin, len(own)))
        slots = own + np.arange(len(own)) - np.repeat(begin, size)
        several = regroup(active, slots, fresh)
        active, slots = active[several], slots[several]
        depth += step
    starts = np.flatnonzero(room >= length)
    return starts[np.argsort(rank[starts], kind="stable")]


def common_prefixes(data: np.ndarray, begins: np.ndarray, counts: np.ndarray, order: np.ndarray, length: int) -> np.ndarray:
    """For each position of the order, how many bytes it has in common with the one before it, up to ``length``.

    Kasai's rule, for all pieces at once: if this position has h bytes in common with its predecessor, the
    next one has h - 1 or more with its own. That holds where what follows the predecessor stands
    in the order, ahead of the next position; else comparing begins anew.
    """
    place = np.full(len(data) + 1, -1, dtype=np.int64)
    place[order] = np.arange(len(order))
    before = np.concatenate(([-1], order[:-1])) if len(order) else order
    shared = np.zeros(len(order), dtype=np.int64)
    padded = np.concatenate([data, np.zeros(length + 8, dtype=np.uint8)])
    height = np.zeros(len(begins), dtype=np.int64)
    for t in range(int(counts.max(initial=0))):
        lane = np.flatnonzero(counts > t)
        at = begins[lane] + t
        other = before[place[at]]
        h = np.maximum(height[lane] - 1, 0)
        if t:
            follows = place[before[place[at - 1]] + 1]  # place[0] if there is no predecessor; then h is 0
            h[(follows < 0) | (follows >= place[at])] = 0
        h[other < 0] = 0
        going = np.flatnonzero(other >= 0)
        while len(going):
            a, b = at[going], other[going]
            same = (h[going] < length) & (padded[a + h[going]] == padded[b + h[going]])
            going = going[same]
            h[going] += 1
        height[lane] = h
        shared[place[at]] = np.minimum(h, length)
    return shared


def repeats(texts: list[bytes], strings: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(piece, offset, repeated, first): all strings of a shard in suffix order.

    ``repeated`` tells strings that occur twice or more, ``first`` the first of each set of equals.
    """
    data, ends = joined(texts)
    sizes = np.array([len(t) for t in texts])
    begins = ends - sizes
    room = np.repeat(ends, sizes) - np.arange(len(data))
    order = suffix_order(data, room, length)
    equal = common_prefixes(data, begins, strings, order, length) >= length
    repeated = equal | np.append(equal[1:], False)[: len(equal)]
    piece = np.searchsorted(ends, order, side="right")
    return piece, order - begins[piece], repeated, ~equal


def runs(offsets: np.ndarray) -> bytes:
    """Sorted offsets as pairs (first, last), packed."""
    first = np.concatenate(([True], np.diff(offsets) != 1))
    last = np.append(first[1:], True)
    return np.stack([offsets[first], offsets[last]], axis=1).astype("<u4").tobytes()


def repeated_strings(found: DataFrame, length: int) -> DataFrame:
    """(piece, runs): in each distinct piece the strings that occur in others or twice in it.

    Pieces are sharded by anchor, as equal strings have equal anchors. An anchor with more text than a
    shard takes is split over several; their sorted strings are then merged range by range with
    binary searches in one another.
    """
    distinct = found.where("bytes IS NOT NULL").select("anchor", "piece", "strings", "bytes")
    sizes = stored(distinct.groupBy("anchor").agg(F.sum(F.octet_length("bytes")).alias("size")), "anchor-sizes")
    total = sizes.agg(F.sum("size")).first()[0] or 0
    shards = int(total // SHARD) + 1
    large = sizes.where(F.col("size") > SHARD).select("anchor", F.ceil(F.col("size") / SHARD).cast("int").alias("splits"))
    placed = distinct.join(large, "anchor", "left").select(
        "*",
        F.pmod(F.xxhash64("anchor"), F.lit(shards)).cast("int").alias("shard"),
        F.when(F.col("splits").isNotNull(), F.pmod(F.xxhash64("piece"), "splits") + 1).otherwise(0).cast("int").alias("split"),
    )

    columns = ["piece", "runs", "anchor", "string", "offset", "split"]
    kinds = {"anchor": "Int64", "offset": "Int64", "split": "Int32"}

    def solve(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.drop_duplicates("piece")
        split = int(pdf["split"].iloc[0])
        if not split:
            # The strings of a piece have one anchor at different offsets, so no two are equal: a piece
            # that is alone with its anchor repeats nothing.
            pdf = pdf[pdf.groupby("anchor")["piece"].transform("size") > 1]
        if not len(pdf):
            return pd.DataFrame(columns=columns).astype(kinds)
        texts, names = list(pdf["bytes"]), pdf["piece"].to_numpy()
        piece, offset, repeated, first = repeats(texts, pdf["strings"].to_numpy(), length)
        out = []
        order = np.lexsort((offset[repeated], piece[repeated]))
        which, where = piece[repeated][order], offset[repeated][order]
        for at in np.split(np.arange(len(which)), np.flatnonzero(np.diff(which)) + 1) if len(which) else ():
            out.append((names[which[at[0]]], runs(where[at]), None, None, None, None))
        if split:
            anchor = pdf["anchor"].to_numpy()
            for k in np.flatnonzero(first):
                p, o = piece[k], int(offset[k])
                string = hashlib.md5(texts[p][o : o + length]).digest()
                lone = None if repeated[k] else o
                out.append((names[p], None, int(anchor[p]), string, lone, split))
        return pd.DataFrame(out, columns=columns).astype(kinds)

    solved = stored(
        placed.groupBy("shard", "split", F.when(F.col("split") > 0, F.col("anchor")).otherwise(0))
        .applyInPandas(solve, "piece binary, runs binary, anchor long, string binary, offset long, split int"),
        "solved",
    )

    def merge(pdf: pd.DataFrame) -> pd.DataFrame:
        sides = {s: np.sort(g["string"].to_numpy().astype("S16")) for s, g in pdf.groupby("split")}
        lone = pdf[pdf["offset"].notna()]
        string = lone["string"].to_numpy().astype("S16")
        known = np.zeros(len(lone), dtype=bool)
        for s, side in sides.items():
            at = np.minimum(np.searchsorted(side, string), len(side) - 1)
            known |= (side[at] == string) & (lone["split"].to_numpy() != s)
        hit = lone[known]
        return pd.DataFrame(
            {"piece": hit["piece"], "runs": [np.array([[o, o]], dtype="<u4").tobytes() for o in hit["offset"].astype(int)]}
        )

    # S16 drops zero bytes at the end of a digest on both sides alike, so equality is not changed.
    crossing = (
        solved.where("string IS NOT NULL")
        .withColumn("range", F.pmod(F.xxhash64("string"), F.lit(RANGES)))
        .groupBy("anchor", "range")
        .applyInPandas(merge, "piece binary, runs binary")
    )
    return solved.where("runs IS NOT NULL").select("piece", "runs").unionByName(crossing)


def removed(length: int):
    """Per text its digest, bytes, removed bytes, spans and what is kept, from the runs of its strings."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for begin in range(0, whole.num_rows, 256):
                batch = whole.slice(begin, 256)
                out = []
                for text, found in zip(batch.column("text"), batch.column("found").to_pylist(), strict=True):
                    data = np.frombuffer(text.as_buffer() or b"", dtype=np.uint8)
                    edge = np.zeros(len(data) + 1, dtype=np.int64)
                    for one in found or ():
                        pairs = np.frombuffer(one["runs"], dtype="<u4").reshape(-1, 2).astype(np.int64) + one["begin"]
                        np.add.at(edge, pairs[:, 0], 1)
                        np.add.at(edge, pairs[:, 1] + length, -1)
                    gone = np.cumsum(edge[:-1]) > 0
                    spans = int(np.count_nonzero(gone[1:] & ~gone[:-1]) + (len(gone) > 0 and bool(gone[0])))
                    out.append((len(data), int(gone.sum()), spans, data[~gone].tobytes()))
                columns = [batch.column("digest"), *map(pa.array, zip(*out, strict=True))]
                yield pa.RecordBatch.from_arrays(columns, ["digest", "n_bytes", "n_removed", "n_spans", "kept"])

    return run


def deduplicate(docs: DataFrame, length: int = 200) -> DataFrame:
    """(digest, n_bytes, n_removed, n_spans, kept) for every distinct text, ``digest`` being its MD5.

    Each byte goes that a string of ``length`` bytes covers which also begins anywhere else, in the
    text itself or another; matches do not cross texts and are judged on the input. A text that
    several rows have goes whole if it is that long.

    Null counts as the empty text; nothing is removed from texts shorter than ``length``. Rows that
    repeat a text are counted, and the text is handled once.

    1. A string's anchor, its piece of least hash, is equal for equal strings. One pass finds
       the anchors that occur twice or more; only text around those goes on.
    2. Text around each such anchor is sharded by anchor. Each shard sorts its strings in a suffix array
       and finds equals by common prefixes; split anchors are merged by binary search.
    3. Runs of repeated strings go back to the texts.
    """
    rows = docs.select(F.unhex(F.md5(text_of())).alias("digest"), text_of().cast("binary").alias("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = 8 + size // 80 // BUCKET_ANCHORS
    copies = rows.groupBy("digest").agg(F.count("*").alias("copies"))
    # A map-side combine leaves one row of a text per task, however many rows repeat it.
    texts = rows.dropDuplicates(["digest"])
    marked = stored(repeated_anchors(rows, length, buckets), "repeated-anchors")
    found = pieces(texts.join(marked, "digest"), length)
    shared = (
        found.groupBy("piece")
        .agg(F.count("*").alias("times"), F.max("strings").alias("strings"))
        .where("times > 1")
        .select("piece", F.col("strings").alias("upto"))
    )
    solved = repeated_strings(found, length)
    # A piece that occurs twice is repeated from end to end.
    per_piece = (
        found.select("digest", "begin", "piece")
        .join(solved, "piece")
        .select("digest", F.struct("begin", "runs").alias("one"))
        .unionByName(
            found.select("digest", "begin", "piece")
            .join(shared, "piece")
            .select("digest", F.struct("begin", ends("upto").alias("runs")).alias("one"))
        )
    )
    found_runs = stored(per_piece.groupBy("digest").agg(F.collect_list("one").alias("found")), "runs")
    done = texts.join(found_runs, "digest", "left").mapInArrow(
        removed(length), "digest binary, n_bytes long, n_removed long, n_spans long, kept binary"
    )
    many = copies.where("copies > 1").select("digest")
    return done.join(many.withColumn("copied", F.lit(True)), "digest", "left").select(
        "digest",
        "n_bytes",
        F.when(gone(length), F.col("n_bytes")).otherwise(F.col("n_removed")).alias("n_removed"),
        F.when(gone(length), F.lit(1)).otherwise(F.col("n_spans")).cast("long").alias("n_spans"),
        F.when(gone(length), F.lit(b"")).otherwise(F.col("kept")).alias("kept"),
    )


def gone(length: int):
    return F.col("copied").isNotNull() & (F.col("n_bytes") >= length)


def ends(column: str):
    """The run from the first string to the last of so many, packed as ``runs`` packs it."""
    last = F.col(column) - 1
    low = [F.shiftright(last, 8 * k).bitwiseAND(F.lit(255)) for k in range(4)]
    return F.concat(F.lit(b"\0\0\0\0"), *[F.unhex(F.lpad(F.hex(b), 2, "0")) for b in low])


def digests(docs: DataFrame) -> DataFrame:
    """Per row doc_id, n_bytes, n_removed, n_spans and the SHA-256 of what is kept."""
    done = deduplicate(docs).select("digest", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.unhex(F.md5(text_of())).alias("digest"))
    return rows.join(done, "digest").select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
