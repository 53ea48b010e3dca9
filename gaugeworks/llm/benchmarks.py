"""Benchmark decontamination by SimHash windows of item size (operator 1).

DataFrame functions only; no Python runs on the executors.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gaugeworks.llm.common import stored, text_of

WIDTH = 5
BITS = 64
#: Rows up to which a table made of the benchmark is broadcast; a larger one is joined by shuffles.
BROADCAST_ROWS = 100_000


def small(df: DataFrame) -> DataFrame:
    """The table with a broadcast hint if its counted size allows it. It has to be a stored one."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def words_of(text: Column) -> Column:
    """Lower-case words of letters and digits, so that case and punctuation hide nothing."""
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def shingled(words: Column) -> Column:
    """Hashes of all runs of five words, with repetitions; of the whole sequence if it is shorter."""
    last = F.greatest(F.size(words) - WIDTH + 1, F.lit(1))
    return F.transform(
        F.sequence(F.lit(1), last), lambda i: F.xxhash64(F.concat_ws(" ", F.slice(words, i, F.lit(WIDTH))))
    )


def fingerprints(shingles: DataFrame, *keys: str) -> DataFrame:
    """SimHash per key of rows (keys, hash, weight): a bit is set if most of the weight has it set."""
    total = F.sum("weight")
    ones = [F.sum(F.col("weight") * F.expr(f"shiftright(hash, {j}) & 1")) for j in range(BITS)]
    counted = shingles.groupBy(*keys).agg(total.alias("total"), F.array(*ones).alias("ones"))
    bits = [
        F.when(2 * F.col("ones")[j] > F.col("total"), F.lit(1 << j if j < 63 else -(1 << 63))).otherwise(F.lit(0))
        for j in range(BITS)
    ]
    return counted.select(
        *keys, "total", reduce(lambda a, b: a.bitwiseOR(b), [b.cast("long") for b in bits]).alias("simhash")
    )


def blocks(simhash: Column, radius: int) -> Column:
    """The fingerprint cut in radius + 1 blocks, each with its number in front.

    Fingerprints that differ in at most ``radius`` bits agree in one block or more.
    """
    count = radius + 1
    cuts = [BITS * i // count for i in range(count + 1)]
    parts = [
        F.shiftrightunsigned(simhash, a).bitwiseAND(F.lit((1 << (b - a)) - 1)) + F.lit(i << 32)
        for i, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False))
    ]
    return F.array(*parts)


def hamming_pairs(windows: DataFrame, items: DataFrame, radius: int) -> DataFrame:
    """(window, item) of equal size whose fingerprints differ in at most ``radius`` bits: all of them."""
    left = windows.withColumn("block", F.explode(blocks(F.col("simhash"), radius)))
    right = items.select(
        "item", "size", F.col("simhash").alias("wanted"), F.explode(blocks(F.col("simhash"), radius)).alias("block")
    )
    near = F.bit_count(F.col("simhash").bitwiseXOR(F.col("wanted"))) <= radius
    return left.join(right, ["size", "block"]).where(near).select("window", "item").distinct()


def leaks(
    docs: DataFrame, benchmark: DataFrame, radius: int = 20, similarity: float = 0.8, whole: str = "text"
) -> DataFrame:
    """(digest, item, similarity, start, words): windows of texts that agree with benchmark items.

    ``digest`` is the MD5 of a text, ``item`` the MD5 of an item's words, ``start`` the word where the best
    window begins and ``words`` its length, that of the item. The similarity is that of weighted shingles:
    runs of five words with their numbers, the sum of minima over the sum of maxima.

    1. Of an item's distinct words those in the fewest texts stand as anchors. A window of the asked
       similarity lacks at most a fifth of the item's shingles and so at most as many of its distinct
       words; a text with fewer of the anchors cannot hold one.
    2. An anchor found in a text tells where a window would begin. Those windows get a SimHash.
    3. Windows and items of one size meet if their fingerprints differ in at most ``radius`` bits, found
       by blocks without loss. At a similarity of 0.8 about 10 of 64 bits differ, with a deviation of 3.
    4. The exact similarity of what met decides.

    Null and empty texts hold nothing; items without words are found nowhere; equal items and equal
    texts are handled once.
    """
    loss = 1 - similarity
    texts = docs.select(F.md5(text_of(whole)).alias("digest"), text_of(whole).alias("text"))
    items = benchmark.select(words_of(text_of()).alias("words")).where(F.size("words") > 0)
    items = stored(
        items.select(F.md5(F.concat_ws(" ", "words")).alias("item"), "words", F.size("words").alias("size"))
        .dropDuplicates(["item"])
        .withColumn("lacking", F.floor(F.greatest(F.size("words") - WIDTH + 1, F.lit(1)) * loss + 1e-9).cast("int")),
        "benchmark-items",
    )
    spots = items.select("item", "size", "lacking", F.posexplode("words").alias("offset", "word"))
    spots = stored(
        spots.groupBy("item", "lacking", "word").agg(F.collect_list("offset").alias("offsets")), "benchmark-words"
    )
    numbered = texts.withColumn("row", F.monotonically_increasing_id())
    present = numbered.select("row", "digest", F.explode(F.array_distinct(words_of(F.col("text")))).alias("word"))
    known = stored(spots.select("word").distinct(), "vocabulary")
    common = stored(present.join(small(known), "word").groupBy("word").agg(F.count("*").alias("texts")), "word-counts")
    rarest = W.partitionBy("item").orderBy(F.coalesce("texts", F.lit(0)), F.char_length("word").desc(), "word")
    anchors = (
        spots.join(common, "word", "left")
        .withColumn("place", F.row_number().over(rarest))
        .where("place <= 2 * lacking + 2")
    )
    anchors = stored(
        anchors.withColumn("anchors", F.count("*").over(W.partitionBy("item"))).withColumn(
            "need", F.greatest(F.lit(1), F.col("anchors") - F.col("lacking"))
        ),
        "anchors",
    )
    hits = (
        present.join(small(anchors.select("item", "word", "need")), "word")
        .groupBy("row", "digest", "item")
        .agg(F.count("*").alias("found"), F.max("need").alias("need"))
        .where("found >= need")
        .select("digest", "item")
        .distinct()
    )
    hits = stored(hits, "anchored")
    holders = stored(
        texts.join(small(stored(hits.select("digest").distinct(), "held")), "digest", "left_semi")
        .dropDuplicates(["digest"])
        .select("digest", words_of(F.col("text")).alias("words")),
        "holders",
    )

    at = holders.select("digest", F.size("words").alias("length"), F.posexplode("words").alias("pos", "word"))
    starts = (
        at.join(small(anchors.select("item", "word", "offsets")), "word")
        .join(hits, ["digest", "item"])
        .join(small(items.select("item", "size")), "item")
        .select("digest", "size", "length", F.explode("offsets").alias("offset"), "pos")
        .select(
            "digest",
            F.least("size", "length").alias("cut"),
            "size",
            F.greatest(F.lit(0), F.least(F.col("pos") - F.col("offset"), F.col("length") - F.col("size"))).alias("start"),
        )
        .distinct()
    )
    windows = starts.join(holders, "digest").select(
        "digest", "size", "start", F.slice("words", F.col("start") + 1, F.col("cut")).alias("part")
    )
    windows = stored(
        windows.select(F.struct("digest", "size", "start").alias("window"), F.explode(shingled(F.col("part"))).alias("hash"))
        .groupBy("window", "hash")
        .agg(F.count("*").alias("weight")),
        "windows",
    )
    bench = stored(
        items.select("item", "size", F.explode(shingled(F.col("words"))).alias("hash"))
        .groupBy("item", "size", "hash")
        .agg(F.count("*").alias("weight")),
        "benchmark-shingles",
    )
    prints = fingerprints(windows, "window").withColumn("size", F.col("window.size"))
    wanted = stored(fingerprints(bench, "item", "size"), "benchmark-prints")
    near = hamming_pairs(prints, small(wanted), radius)
    both = (
        near.join(windows, "window")
        .join(small(bench.select("item", "hash", F.col("weight").alias("other"))), ["item", "hash"])
        .groupBy("window", "item")
        .agg(F.sum(F.least("weight", "other")).alias("shared"))
    )
    judged = (
        both.join(prints.select("window", "total"), "window")
        .join(small(wanted.select("item", F.col("total").alias("other"))), "item")
        .withColumn("similarity", F.col("shared") / (F.col("total") + F.col("other") - F.col("shared")))
        .where(F.col("similarity") >= similarity)
    )
    best = F.struct("similarity", -F.col("window.start"), "window.size")
    return (
        judged.groupBy("window.digest", "item")
        .agg(F.max(best).alias("best"))
        .select(
            "digest",
            "item",
            F.col("best.similarity").alias("similarity"),
            (-F.col("best.col2")).cast("int").alias("start"),
            F.col("best.size").alias("words"),
        )
    )


def report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document row and item it holds: doc_id, item_id, similarity, start, words.

    Rows that repeat a text, and items that repeat another's words, are listed each. A doc_id or
    item_id may be null. Columns other than ids and texts are not read.
    """
    found = stored(leaks(docs, benchmark), "leaks")
    ids = docs.select("doc_id", F.md5(text_of()).alias("digest"))
    items = benchmark.select("item_id", F.md5(F.concat_ws(" ", words_of(text_of()))).alias("item"))
    return (
        found.join(ids, "digest")
        .join(items, "item")
        .select("doc_id", "item_id", F.round("similarity", 6).alias("similarity"), "start", "words")
    )


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the rows whose text holds a benchmark item. All columns stay as they are."""
    found = stored(leaks(docs, benchmark).select("digest").distinct(), "leaking")
    name = "_digest"
    while name in docs.columns:
        name += "_"
    return (
        docs.withColumn(name, F.md5(text_of()))
        .join(small(found).withColumnRenamed("digest", name), name, "left_anti")
        .select(*[F.col(f"`{c}`") for c in docs.columns])
    )
