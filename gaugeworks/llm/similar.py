"""Size-aware Jaccard join of word n-grams, and the groups its links form (operator 10)."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeworks.llm.common import low_bits, mixed, shingle_hashes, stored, text_of, word_hashes

#: Tokens a task gathers before it deals them out, and tokens of one bucket on average.
GATHERED = 4_000_000
BUCKET_TOKENS = 2_000_000
#: Sets in a block that is compared with another block in one task.
BLOCK = 256
#: Lists up to this length are compared pair by pair, longer ones block by block.
SHORT_LIST = 32
#: Tokens of sets that one task compares with a pivot, on average.
PIVOT_TOKENS = 500_000
#: Columns of the incidence matrix that are multiplied at once.
COLUMNS = 4096
#: Places of a set's sketch.
SKETCH = 512


class Rule:
    """Arithmetic of the link rule: intersection >= threshold * union, in whole numbers."""

    def __init__(self, threshold: Fraction) -> None:
        self.num, self.den = threshold.numerator, threshold.denominator

    def least(self, n):
        """Tokens that a set of n shares with any set it links with."""
        return -(-self.num * n // self.den)

    def overlap(self, n, m):
        """Tokens that linked sets of n and m share."""
        return -(-self.num * (n + m) // (self.num + self.den))

    def extra(self, n):
        """Tokens by which the first sieve's prefix of a set is longer than needed for one in common."""
        return n // 10

    def prefix(self, n):
        return n - self.least(n) + 1

    def index_prefix(self, n):
        """Length of the prefix in which a set of n meets any set it links with that is not smaller."""
        return n - self.overlap(n, n) + 1

    def links(self, both, n, m):
        return self.den * both >= self.num * (n + m - both)


def dealt(
    batches: Iterator[pa.RecordBatch], sets, buckets: int
) -> Iterator[tuple[list[dict], list[tuple[int, bytes, bytes]]]]:
    """Per gathered part of a task: its rows, and its tokens by bucket.

    ``sets`` turns a batch into rows, each with ``class`` (equal for equal sets) and ``tokens``, which
    is taken out. Tokens are dealt out by 32 bits; the few that fall together are taken for shared, which
    only keeps a set that could be dropped. A token that two classes of the part hold is known to be shared: their rows count it
    in ``common``, and it is dealt out without a row. Any other is dealt out with the number of its row.
    """
    rows, tokens, size = [], [], 0

    def part():
        owner = np.repeat(np.arange(len(rows), dtype=np.uint32), [len(t) for t in tokens])
        token = np.concatenate([np.empty(0, dtype=np.uint64), *tokens])
        _, group = np.unique([r["class"] for r in rows], return_inverse=True)
        order = np.argsort(token, kind="stable")
        token, owner = token[order], owner[order]
        start = np.flatnonzero(np.concatenate(([True], token[1:] != token[:-1])))
        run = np.diff(np.append(start, len(token)))
        kind = group[owner]
        # Equal sets stand together or not; a run is shared if its least and greatest class differ.
        shared = np.minimum.reduceat(kind, start) != np.maximum.reduceat(kind, start)
        common = np.bincount(owner[np.repeat(shared, run)], minlength=len(rows))
        for row, n in zip(rows, common.tolist(), strict=True):
            row["common"] = n
        # Copies in a part stand for each other: only the first of a run is dealt out.
        first, who = token[start], np.where(shared, np.uint32(0xFFFFFFFF), owner[start])
        bucket = ((first >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
        cut = np.searchsorted(bucket, np.arange(buckets + 1, dtype=np.uint64))
        out = []
        for b in range(buckets):
            if cut[b] < cut[b + 1]:
                # In the order of rows, whose numbers then compress to little.
                piece = cut[b] + np.argsort(who[cut[b] : cut[b + 1]], kind="stable")
                out.append((b, low_bits(first[piece], buckets).tobytes(), who[piece].astype("<u4").tobytes()))
        return rows, out

    for whole in batches:
        for begin in range(0, whole.num_rows, 256):
            for row in sets(whole.slice(begin, 256)):
                tokens.append(row.pop("tokens"))
                size += len(tokens[-1])
                rows.append(row)
            if size > GATHERED:
                yield part() if size else (rows, [])
                rows, tokens, size = [], [], 0
    if rows:
        if size:
            yield part()
        else:
            for row in rows:
                row["common"] = 0
            yield rows, []


def common_counts(pieces: DataFrame) -> DataFrame:
    """(part, row, common): tokens of a row that occur in other parts as well, or twice in its own.

    A bucket holds each token once per part at most, so its size does not depend on how often a
    token occurs in a part.
    """

    def meet(pdf: pd.DataFrame) -> pd.DataFrame:
        token = np.concatenate([np.frombuffer(x, dtype="<u4") for x in pdf["tokens"]])
        owner = np.concatenate([np.frombuffer(x, dtype="<u4") for x in pdf["owners"]])
        part = np.repeat(pdf["part"].to_numpy(), [len(x) // 4 for x in pdf["tokens"]])
        order = np.argsort(token, kind="stable")
        token, owner, part = token[order], owner[order], part[order]
        start = np.flatnonzero(np.concatenate(([True], token[1:] != token[:-1])))
        run = np.diff(np.append(start, len(token)))
        many = np.logical_or.reduceat(owner == 0xFFFFFFFF, start) | (run > 1)
        hit = np.repeat(many, run) & (owner != 0xFFFFFFFF)
        found = pd.DataFrame({"part": part[hit], "row": owner[hit].astype(np.int64)})
        return found.groupby(["part", "row"], as_index=False).size().rename(columns={"size": "common"})

    return (
        pieces.groupBy("bucket")
        .applyInPandas(meet, "part long, row long, common long")
        .groupBy("part", "row")
        .agg(F.sum("common").alias("common"))
    )


ROWS = "part long, row long, doc_id long, h long, class binary, n long, common long"


def sieve(frame: DataFrame, make, buckets: int, name: str, wide: str = "") -> tuple[DataFrame, DataFrame]:
    """The rows that ``make`` makes of batches of ``frame``, with ``common``: tokens that others hold; and
    beside them (part, row, and the columns of ``wide``), which take no part in the counting and its joins.

    Rows and dealt-out tokens of all tasks are written in one pass, as two kinds of a table.
    """
    fields = ", ".join(filter(None, (ROWS, wide)))
    columns = [f.split() for f in fields.split(", ")]
    pieces = "kind int, bucket int, tokens binary, owners binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        for count, (rows, dealt_out) in enumerate(dealt(batches, make, buckets)):
            part = (task << 20) + count
            for i, row in enumerate(rows):
                row |= {"part": part, "row": i, "kind": 0}
            more = [
                {"part": part, "kind": 1, "bucket": bucket, "tokens": tokens, "owners": owners}
                for bucket, tokens, owners in dealt_out
            ]
            for some in [rows[i : i + 1000] for i in range(0, len(rows), 1000)] + [[x] for x in more]:
                yield pa.RecordBatch.from_pylist(some, schema)

    kinds = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
    schema = pa.schema([(n, kinds[k]) for n, k in columns + [f.split() for f in pieces.split(", ")]])
    both = stored(frame.mapInArrow(run, f"{fields}, {pieces}"), name, "kind")
    found = common_counts(both.where("kind = 1").select("part", "bucket", "tokens", "owners"))
    rows_of = both.where("kind = 0")
    counted = (
        rows_of.select(*[f.split()[0] for f in ROWS.split(", ")])
        .withColumnRenamed("common", "_own")
        .join(found, ["part", "row"], "left")
        .withColumn("common", F.col("_own") + F.coalesce("common", F.lit(0)))
        .drop("_own")
    )
    return counted, rows_of.select("part", "row", *[n for n, _ in columns[len(ROWS.split(", ")) :]])


def sets_of(batch: pa.RecordBatch, width: int) -> Iterator[tuple[dict, np.ndarray]]:
    """Each row without its text, and the set of its text in the order of hashes."""
    texts = batch.column("text")
    for i, row in enumerate(batch.select(["doc_id", "h"]).to_pylist()):
        tokens = shingle_hashes(word_hashes(np.frombuffer(texts[i].as_buffer() or b"", dtype=np.uint8)), width)
        yield row | {"class": hashlib.md5(tokens.tobytes()).digest(), "n": len(tokens)}, tokens


def components(edges: DataFrame) -> DataFrame:
    """(id, component): the smallest id that each end of an edge reaches, by hash-min with shortcuts.

    Labels are written each round; rounds go on until nothing changes, and shortcuts make their
    number logarithmic on long chains.
    """
    both = stored(
        edges.selectExpr("a AS id", "b AS other").unionByName(edges.selectExpr("b AS id", "a AS other")).distinct(),
        "edges",
    )
    labels = stored(both.groupBy("id").agg(F.least(F.min("other"), F.col("id")).alias("component")), "labels")
    while True:
        heard = both.join(labels.withColumnRenamed("id", "other"), "other").groupBy("id").agg(
            F.min("component").alias("heard")
        )
        step = labels.join(heard, "id").select(
            "id", F.least("component", "heard").alias("component"), F.col("component").alias("was")
        )
        far = step.selectExpr("id AS component", "component AS root")
        new = stored(
            step.join(far, "component", "left").select(
                "id", F.coalesce("root", "component").alias("component"), "was"
            ),
            "labels",
        )
        labels = new.select("id", "component")
        if new.where("component != was").isEmpty():
            return labels


def sketch_of(tokens: np.ndarray) -> np.ndarray:
    """For each of ``SKETCH`` places, whether an odd number of tokens falls there, as 64-bit numbers."""
    odd = np.bincount((tokens % np.uint64(SKETCH)).astype(np.int64), minlength=SKETCH) & 1
    return np.packbits(odd.astype(bool)).view("<i8")


def lists(sets: DataFrame, rule: Rule, light: int) -> DataFrame:
    """(id, n, v, sketch, lists): a row per set, with the lists (key, pos, own) by which sets that may link meet.
    ``pos`` counts the tokens ahead.

    Light sets, of up to ``light`` tokens, meet by a common subset: itself and all that lack one token.
    Heavy sets meet in the inverted lists of the tokens of their prefix, the smallest hashes; light
    sets that are large enough to link with a heavy one are in those lists as well. A key belongs to
    a size class, and holds sets of that class (``own``) and of the one below it, so a list holds sets of similar
    size only. Two sets of the class below meet in its own lists as well; and being smaller than any
    set of the class, they need the shorter prefix only that sets no larger than their partner need.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, ahead, own, sketches, ends = [], [], [], [], [0]
            for value in batch.column("tokens"):
                tokens = np.frombuffer(value.as_buffer(), dtype="<u8")
                n = len(tokens)
                sketches.append(sketch_of(tokens))
                total = ends[-1]
                if n <= light:
                    whole = tokens.sum(dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
                    subset = np.append(whole - tokens * np.uint64(0x9E3779B97F4A7C15), whole)
                    keys.append(subset ^ np.uint64(0x5555555555555555))
                    ahead.append(np.zeros(len(subset), dtype=np.int64))
                    own.append(np.ones(len(subset), dtype=bool))
                    total += len(subset)
                if n >= rule.least(light + 1):
                    level = int(np.floor(np.log(n) / np.log(rule.den / rule.num) + 1e-9))
                    for near, length in ((level, rule.prefix(n)), (level + 1, rule.index_prefix(n))):
                        keys.append(tokens[:length] + np.uint64(near * 0x2545F4914F6CDD1D % 2**64))
                        ahead.append(np.arange(length))
                        own.append(np.full(length, near == level))
                        total += length
                ends.append(total)
            entries = pa.StructArray.from_arrays(
                [
                    pa.array(np.concatenate([np.empty(0, dtype=np.uint64), *keys]).view(np.int64)),
                    pa.array(np.concatenate([np.empty(0, dtype=np.int64), *ahead])),
                    pa.array(np.concatenate([np.empty(0, dtype=bool), *own])),
                ],
                ["key", "pos", "own"],
            )
            words = np.concatenate([np.empty(0, dtype=np.int64), *sketches])
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.select(["id", "n", "v"]).columns,
                    pa.ListArray.from_arrays(np.arange(0, len(words) + 1, SKETCH // 64, dtype=np.int32), pa.array(words)),
                    pa.ListArray.from_arrays(np.array(ends, dtype=np.int32), entries),
                ],
                ["id", "n", "v", "sketch", "lists"],
            )

    return sets.select("id", "n", "v", "tokens").mapInArrow(
        run,
        "id long, n long, v long, sketch array<long>, lists array<struct<key: long, pos: long, own: boolean>>",
    )


def entries(found: DataFrame, labels: DataFrame | None = None) -> DataFrame:
    """(id, n, v, key, pos, own): the lists of all sets, entry by entry; with labels also the component of the set.

    Labels are joined with sets, which are far fewer than their entries.
    """
    if labels is None:
        return found.select("id", "n", "v", F.inline("lists"))
    named = found.select("id", "n", "v", "lists").join(labels, "id", "left")
    return named.select("id", "n", "v", F.coalesce("component", "id").alias("component"), F.inline("lists"))


def possible(rule: Rule, left: str = "", right: str = "_2") -> Column:
    """Whether two sets may link by their sizes n and the numbers v of tokens that any others hold."""
    n, m, v, w = f"n{left}", f"n{right}", f"v{left}", f"v{right}"
    return F.expr(
        f"{rule.num} * greatest({n}, {m}) <= {rule.den} * least({n}, {m}) "
        f"AND {rule.num} * ({n} + {m}) <= {rule.num + rule.den} * least({v}, {w})"
    )


def near(pairs: DataFrame, found: DataFrame, rule: Rule) -> DataFrame:
    """The pairs (a, b, n) without those whose sketches tell that they do not link. Nothing that links is lost.

    Each token that only one of two sets has changes one place of a sketch, so sketches differ in no
    more places than sets in tokens; linked sets differ in n + m - 2 * overlap at most.
    """
    sketches = found.select(F.col("id").alias("a"), F.col("sketch").alias("x"))
    others = found.select(F.col("id").alias("b"), F.col("n").alias("m"), F.col("sketch").alias("y"))
    differ = "aggregate(zip_with(x, y, (p, q) -> bit_count(p ^ q)), 0, (s, k) -> s + k)"
    most = f"n + m - 2 * (({rule.num} * (n + m) + {rule.num + rule.den - 1}) div {rule.num + rule.den})"
    return pairs.join(sketches, "a").join(others, "b").where(f"{differ} <= {most}").select("a", "b", "n")


def verified(pairs: DataFrame, found: DataFrame, sets: DataFrame, rule: Rule) -> DataFrame:
    """Those of the pairs (a, b) whose sets link; ``n`` is the size of a's. The set of ``b`` is sent to the
    sets of its ``a``s, for pairs that the sketches in ``found`` leave.

    The members of a popular ``b`` are dealt out by their counted tokens, ``PIVOT_TOKENS`` a group, and each
    group gets b's set once.
    """
    pairs = stored(near(pairs, found, rule), "pairs")
    groups_of = pairs.groupBy("b").agg(F.ceil(F.sum("n") / PIVOT_TOKENS).alias("salts"))
    salt = F.pmod(F.xxhash64("a"), F.col("salts")).cast("int")
    dealt_out = pairs.join(groups_of, "b").select("a", "b", salt.alias("salt"))
    left = dealt_out.join(sets.select(F.col("id").alias("a"), F.col("tokens").alias("x")), "a")
    right = (
        dealt_out.select(F.col("b").alias("pivot"), F.col("salt").alias("deal"))
        .distinct()
        .join(sets.select(F.col("id").alias("pivot"), F.col("tokens").alias("y")), "pivot")
    )

    def compare(x: pd.DataFrame, y: pd.DataFrame) -> pd.DataFrame:
        if not len(x) or not len(y):
            return x[["a", "b"]].iloc[:0]
        mine = np.frombuffer(y["y"].iloc[0], dtype="<u8")
        keep = []
        for value in x["x"]:
            other = np.frombuffer(value, dtype="<u8")
            at = np.searchsorted(mine, other)
            both = int((mine[np.minimum(at, len(mine) - 1)] == other).sum())
            keep.append(rule.links(both, len(mine), len(other)))
        return x.loc[keep, ["a", "b"]]

    return left.groupBy("b", "salt").cogroup(right.groupBy("pivot", "deal")).applyInPandas(compare, "a long, b long")


def block_links(members: DataFrame, found: DataFrame, sets: DataFrame, rule: Rule) -> DataFrame:
    """Links between sets of one list that are not in one component yet, found block by block.

    ``members`` has key, id, n, v, pos, own, component and ``rest``: false for the list's largest component, whose
    sets need not be compared with each other. Blocks hold up to about ``BLOCK`` sets, and each task
    compares two of them, so no task grows with the length of the list. Two blocks are compared by the
    sketches in ``found`` first; tokens are fetched for the sets only that this leaves with a partner.
    """
    sizes = members.groupBy("key").agg(
        F.ceil(F.sum(F.col("rest").cast("int")) / BLOCK).cast("int").alias("rests"),
        F.ceil(F.sum((~F.col("rest")).cast("int")) / BLOCK).cast("int").alias("mains"),
    )
    h = F.xxhash64("id")
    placed = members.join(sizes, "key").withColumn(
        "block", F.when(F.col("rest"), F.pmod(h, "rests")).otherwise(F.pmod(h, F.greatest("mains", F.lit(1))) + F.col("rests")).cast("int")
    )
    with_rest = F.sequence(F.lit(0), F.col("rests") - 1)
    with_all = F.sequence(F.lit(0), F.col("rests") + F.col("mains") - 1)
    copies = placed.withColumn("other", F.explode(F.when(F.col("rest"), with_all).otherwise(with_rest))).select(
        "key",
        F.least("block", "other").alias("i"),
        F.greatest("block", "other").alias("j"),
        "block",
        "id",
        "component",
        "n",
        "v",
        "pos",
        "own",
    )

    def may_link(pdf: pd.DataFrame) -> np.ndarray:
        n, v, pos, own = (pdf[c].to_numpy() for c in ("n", "v", "pos", "own"))
        group, block = pd.factorize(pdf["component"])[0], pdf["block"].to_numpy()
        may = (
            (rule.num * np.maximum.outer(n, n) <= rule.den * np.minimum.outer(n, n))
            & (rule.num * np.add.outer(n, n) <= (rule.num + rule.den) * np.minimum.outer(v, v))
            & np.not_equal.outer(group, group)
            # Where two sets first meet, what stands ahead in either is not in common; later meetings may go.
            & (rule.num * np.add.outer(n, n) <= (rule.num + rule.den) * np.minimum.outer(n - pos, n - pos))
            & np.logical_or.outer(own, own)
        )
        if block.min() != block.max():
            may &= np.not_equal.outer(block, block)
        a, b = np.nonzero(np.triu(may))
        if len(a):
            words = np.stack(pdf["sketch"].to_list()).view(np.uint64)
            differ = sum(np.bitwise_count(words[a, k] ^ words[b, k]).astype(np.int64) for k in range(words.shape[1]))
            gone = differ > n[a] + n[b] - 2 * rule.overlap(n[a], n[b])
            may[a[gone], b[gone]] = may[b[gone], a[gone]] = False
        return may

    def meeting(pdf: pd.DataFrame) -> pd.DataFrame:
        if len(pdf) < 2 or pdf["component"].nunique() < 2:
            return pdf.iloc[:0]
        return pdf[may_link(pdf).any(1)]

    def compare(pdf: pd.DataFrame) -> pd.DataFrame:
        none = pd.DataFrame({"a": [], "b": []}, dtype=np.int64)
        if len(pdf) < 2:
            return none
        pdf = pdf.sort_values("id")
        n, may = pdf["n"].to_numpy(), may_link(pdf)
        if not may.any():
            return none
        keep = np.flatnonzero(may.any(1))
        may = may[np.ix_(keep, keep)]
        tokens = [np.frombuffer(pdf["tokens"].iloc[k], dtype="<u8") for k in keep]
        _, column, count = np.unique(np.concatenate(tokens), return_inverse=True, return_counts=True)
        row = np.repeat(np.arange(len(keep)), [len(t) for t in tokens])
        useful = count[column] > 1
        _, column = np.unique(column[useful], return_inverse=True)
        row = row[useful]
        both = np.zeros((len(keep), len(keep)), dtype=np.float32)
        for begin in range(0, int(column.max(initial=-1)) + 1, COLUMNS):
            here = (column >= begin) & (column < begin + COLUMNS)
            held = np.zeros((len(keep), COLUMNS), dtype=np.float32)
            held[row[here], column[here] - begin] = 1
            both += held @ held.T
        m = n[keep]
        linked = may & rule.links(both.astype(np.int64), m[:, None], m[None, :])
        a, b = np.nonzero(np.triu(linked))
        ids = pdf["id"].to_numpy()[keep]
        return pd.DataFrame(spanning(ids[a], ids[b]), columns=["a", "b"], dtype=np.int64)

    sketched = copies.join(found.select("id", "sketch"), "id")
    met = stored(sketched.groupBy("key", "i", "j").applyInPandas(meeting, sketched.schema), "meeting")
    return (
        met.join(sets.select("id", "tokens"), "id")
        .groupBy("key", "i", "j")
        .applyInPandas(compare, "a long, b long")
        .distinct()
    )


def spanning(a: np.ndarray, b: np.ndarray) -> list[tuple[int, int]]:
    """As many of the edges as connect what all of them connect."""
    root: dict[int, int] = {}

    def top(x: int) -> int:
        while root.setdefault(x, x) != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    keep = []
    for x, y in zip(a, b, strict=True):
        p, q = top(x), top(y)
        if p != q:
            root[max(p, q)] = min(p, q)
            keep.append((x, y))
    return keep


def light_bound(sizes: list[tuple[int, int, int]], rule: Rule) -> int:
    """The greatest size of light sets, by cost.

    ``sizes`` has (n, sets, entries in inverted lists with more than one set, summed lengths) up to the
    size at which linked sets may lack more than one token of each other. A light set costs its
    subsets, a heavy one the entries it meets in its lists; the bound with the least sum is taken.
    """
    best, light, saved = 0, 0, 0
    for n, sets, met in sorted(sizes):
        saved += met - sets * (n + 1)
        if saved > best:
            best, light = saved, n
    return light


def one_apart(rule: Rule) -> int:
    """The greatest n at which linked sets of at most n tokens lack at most one token of each other."""
    n = 1
    while (n + 1) - rule.overlap(n + 1, rule.least(n + 1)) <= 1:
        n += 1
    return n


def linked(sets: DataFrame, rule: Rule, rounds: int = 2) -> DataFrame:
    """Links (a, b) between the given sets that connect whatever all their links connect."""
    found = stored(lists(sets, rule, light_size(sets, rule)), "similar-lists")
    members, edges = entries(found), None
    for turn in range(rounds):
        if turn:
            labels = components(edges)
            members = still_open(entries(found, labels) if turn == 1 else renamed(members, labels))
        new = stored(verified(star(members, rule, turn), found, sets, rule), "links")
        edges = new if edges is None else edges.unionByName(new)
    labels = components(edges)
    members = still_open(renamed(members, labels) if rounds > 1 else entries(found, labels))
    rest = stored(remaining(members, rule), "remaining")
    short = rest.where(F.col("length") <= SHORT_LIST)
    other = short.select("key", *[F.col(c).alias(f"{c}_2") for c in ("id", "n", "v", "pos", "own", "component")])
    # Where two sets first meet, what stands ahead in either is not in common; later meetings may go.
    first = F.expr(f"{rule.num} * (n + n_2) <= {rule.num + rule.den} * least(n - pos, n_2 - pos_2)")
    pairs = (
        short.join(other, "key")
        .where("id < id_2 AND component != component_2 AND (own OR own_2)")
        .where(possible(rule) & first)
        .select(F.col("id").alias("a"), F.col("id_2").alias("b"), "n")
        .distinct()
    )
    long = rest.where(F.col("length") > SHORT_LIST)
    last = verified(pairs, found, sets, rule).unionByName(block_links(long, found, sets, rule))
    return edges.unionByName(stored(last, "links"))


def light_size(sets: DataFrame, rule: Rule) -> int:
    """The bound of light sets for these sets, by counts of the lists that sets of few tokens are in."""
    bound = one_apart(rule)
    # No set in one list with a set up to the bound is larger than two size classes further.
    reach = bound * rule.den**2 // rule.num**2 + 2
    small = entries(lists(sets.where(F.col("n") <= reach), rule, 0))
    length = small.groupBy("key").agg(F.count("*").alias("length"), F.bool_or("own").alias("any"))
    met = small.where(F.col("n") <= bound).join(length.where("length > 1 AND any"), "key")
    sizes = met.groupBy("n").agg(F.count_distinct("id"), F.sum("length")).collect()  # a row per size up to the bound
    return light_bound([tuple(r) for r in sizes], rule)


def renamed(members: DataFrame, labels: DataFrame) -> DataFrame:
    """The entries with new components."""
    named = members.drop("component").join(labels, "id", "left")
    return named.withColumn("component", F.coalesce("component", "id"))


def still_open(named: DataFrame) -> DataFrame:
    """The entries of lists that hold several components, of entries with components; written, as they are read several times.

    A list without a set of its own size class goes as well: its sets meet in another.
    """
    several = (
        named.groupBy("key")
        .agg(F.min("component").alias("x"), F.max("component").alias("y"), F.bool_or("own").alias("any"))
        .where("x != y AND any")
    )
    return stored(named.join(several.select("key"), "key"), "open")


def star(members: DataFrame, rule: Rule, turn: int) -> DataFrame:
    """For each set the pivot (a, b, and n of a) that it meets in most lists.

    A list's pivot is the set with the fewest tokens of its own: the nearest to the centre of a group
    of near copies. In a later turn it is chosen among those outside the first pivot's component.
    """
    own = F.struct((F.col("n") - F.col("v")).alias("own"), "id", "n", "v")
    if turn:
        centre = members.groupBy("key").agg(F.min_by("component", own).alias("centre"))
        outside = members.join(centre, "key").where("component != centre")
    else:
        outside = members
    pivots = outside.groupBy("key").agg(F.min(own).alias("p"), F.bool_or("own").alias("any"))
    if not turn:
        pivots = pivots.where("any")  # else its sets meet in another list
    pivots = pivots.select("key", F.col("p.id").alias("b"), F.col("p.n").alias("n_2"), F.col("p.v").alias("v_2"))
    met = members.join(pivots, "key").where("id != b").where(possible(rule))
    met = met.groupBy(F.col("id").alias("a"), "n", "b").agg(F.count("*").alias("k"))
    return met.groupBy("a").agg(F.max_by("b", F.struct("k", "b")).alias("b"), F.max("n").alias("n"))


def remaining(members: DataFrame, rule: Rule) -> DataFrame:
    """What is left to compare in lists with several components.

    Sets that cannot link with any size in their list go, then lists with one component. ``rest``
    tells sets outside a list's largest component, ``length`` the sets left in the list.
    """
    span = members.groupBy("key").agg(F.min("n").alias("n_2"), F.max("v").alias("v_2"))
    fit = F.expr(f"{rule.num} * (n + n_2) <= {rule.num + rule.den} * least(v, v_2)")
    able = members.join(span, "key").where(fit).drop("n_2", "v_2")
    parts = able.groupBy("key", "component").agg(F.count("*").alias("size"))
    main = (
        parts.groupBy("key")
        .agg(
            F.max_by("component", F.struct("size", "component")).alias("main"),
            F.count("*").alias("parts"),
            F.sum("size").alias("length"),
        )
        .where("parts > 1")
        .drop("parts")
    )
    return able.join(main, "key").withColumn("rest", F.expr("component != main")).drop("main")


def named_sets(docs: DataFrame, width: int, threshold: str) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, h (a hash of the text), n and component.

    The set of a text are its distinct runs of ``width`` words, capital letters A-Z being small ones and
    words ending at ASCII white space; a shorter text's whole sequence is its one run. Two sets link
    if they have at least ``threshold`` of their union in common. Sets that links connect have one
    component.

    Null and empty texts and texts without words have the empty set and link with nothing. Equal sets
    link, and are handled as one from the start, so copies are never paired. Each row gives a row,
    also where doc_ids are null or repeat. Other columns are not read.

    How links are found without loss:

    1. Sets that link share all but a few tokens, so in each a certain number of its smallest hashes
       has to occur in other sets too. One pass counts that; most sets drop out.
    2. The others are counted in full: a set that links has few tokens of its own.
    3. What is left meets in lists, by subsets or by prefix tokens (see ``lists``).
    4. In each list all sets are compared with the one that has the fewest tokens of its own. Links
       form components.
    5. Lists that still hold several components are compared pair by pair where short, block by
       block where long, skipping pairs in one component and pairs that cannot link by size.
    """
    rule = Rule(Fraction(threshold))
    texts = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text_of()).alias("h"), text_of().alias("text")
    )
    size = texts.select(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = 8 + size // 25 // BUCKET_TOKENS

    def prefixes(batch: pa.RecordBatch) -> Iterator[dict]:
        for row, tokens in sets_of(batch, width):
            n = len(tokens)
            yield row | {"tokens": mixed(tokens[: rule.prefix(n) + rule.extra(n)])}

    def whole_sets(batch: pa.RecordBatch) -> Iterator[dict]:
        for row, tokens in sets_of(batch, width):
            yield row | {"set": tokens.tobytes(), "tokens": mixed(tokens)}

    first = stored(sieve(texts, prefixes, buckets, "sieve")[0].drop("part", "row"), "sieved")
    # Equal sets have one class; the row with the smallest id stands for it.
    heads = (
        first.where("n > 0")
        .groupBy("class")
        .agg(F.min(F.struct("doc_id", "h")).alias("head"), F.max("common").alias("common"), F.max("n").alias("n"))
        .where(F.expr(f"common >= 1 + (n * {rule.num} + {rule.den - 1}) div {rule.den} div 10"))
        .select(F.col("head.doc_id").alias("doc_id_2"), F.col("head.h").alias("h_2"))
        .hint("merge")
    )
    left = texts.join(heads, F.expr("doc_id <=> doc_id_2 AND h = h_2"), "left_semi")
    second, wide = sieve(left, whole_sets, buckets, "second-sieve", "set binary")
    # Rows are chosen, one of each class, before their sets are fetched.
    chosen = (
        second.where(f"common * {rule.den} >= n * {rule.num}")
        .groupBy("class")
        .agg(F.min(F.struct("part", "row", "n", "common")).alias("_r"))
        .select("class", "_r.part", "_r.row", "_r.n", F.col("_r.common").alias("v"))
    )
    # A set is named by its part and row in one number, half as long as its class; a part holds fewer than 2^22 rows.
    name = F.expr("shiftleft(part, 22) + row AS id")
    sets = stored(
        wide.join(chosen, ["part", "row"]).select(name, "class", "n", "v", F.col("set").alias("tokens")), "similar-sets"
    )
    labels = sets.select("id", "class").join(components(linked(sets, rule)), "id").select("class", "component")
    # Bytes of a number are up to 8, those of a class 16.
    return first.join(labels, "class", "left").select(
        "doc_id", "h", "n", F.coalesce(F.unhex(F.hex("component")), "class").alias("component")
    )


def groups(docs: DataFrame, width: int = 3, threshold: str = "9/10") -> DataFrame:
    """Per row of ``docs``: doc_id, n_shingles and component_id, the smallest doc_id that links reach.

    A row without words is a component by itself. One without doc_id has the component of what it
    links with, null if nothing there has an id. For the rest see ``named_sets``.
    """
    named = stored(named_sets(docs, width, threshold), "named-sets")
    least = named.where("n > 0").groupBy("component").agg(F.min("doc_id").alias("least"))
    return named.join(least, "component", "left").select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("least")).otherwise(F.col("doc_id")).alias("component_id"),
    )


def representatives(docs: DataFrame, width: int = 5, threshold: str = "4/5") -> DataFrame:
    """``docs`` with one row of each component: that of the smallest doc_id, rows without one last.

    Rows without words all stay. Rows that repeat both doc_id and text are one. All columns are passed
    on as they are. For the rest see ``named_sets``.
    """
    named = stored(named_sets(docs, width, threshold), "named-sets")
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "h")
    gone = (
        named.where("n > 0")
        .join(named.where("n > 0").groupBy("component").agg(F.min(order).alias("head")), "component")
        .where(~order.eqNullSafe(F.col("head")))
        .select(F.col("doc_id").alias("_other"), F.col("h").alias("_same"))
        .distinct()
        .hint("merge")
    )
    names = docs.columns
    whole = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in names]).alias("_given"),
        F.col("doc_id").cast("long").alias("_id"),
        F.xxhash64(text_of()).alias("_h"),
        (~text_of().rlike(r"[^\x20\x09-\x0D]")).alias("_blank"),
    )
    left = whole.join(gone, F.expr("_id <=> _other AND _h = _same"), "left_anti")
    once = left.where("NOT _blank").dropDuplicates(["_id", "_h"]).unionByName(left.where("_blank"))
    return once.select(*[F.col(f"_given.`{c}`").alias(c) for c in names])
