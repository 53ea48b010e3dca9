"""The trie of rebuilt conversations, summed up band by band (operator 11)."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gaugeworks.llm.common import stored

#: Conversations in a family, and the limit of what is taken over from its first.
FAMILY, HEAD = 5, 9
#: Depths in a band: a node is spread to at most so many ancestors, and each round covers so many bands.
BAND = 16
#: Turns of a conversation whose prefixes are summed in one group; ids whose text is joined in one row.
BLOCK, IDS = 1024, 4096


def ordered_turns(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conv_id, at, a, b, bytes): the turns by place from 1, each as two hashes and the size of its text.
    Second, (conv_id, n): the number of turns.

    A range sort deals out rows, so that a conversation of any length is spread over tasks. Places are
    counted within a task and shifted by what earlier tasks hold of the conversation.
    """
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", text("role").alias("role"), text("text").alias("text")
    ).where("conv_id IS NOT NULL")
    order = ["conv_id", "turn", "role", "text"]
    # Limits are sampled to the driver, so only the beginnings of texts are among their columns.
    dealt = rows.repartitionByRange("conv_id", "turn", F.left("role", F.lit(16)), F.left("text", F.lit(48)))
    numbered = stored(
        dealt.sortWithinPartitions(*order).select(
            "conv_id",
            F.spark_partition_id().alias("part"),
            F.monotonically_increasing_id().alias("row"),
            F.xxhash64("role", "text").alias("a"),
            F.xxhash64("text", "role", F.lit(1)).alias("b"),
            F.octet_length("text").cast("long").alias("bytes"),
        ),
        "trie-turns",
    )
    pieces = stored(numbered.groupBy("conv_id", "part").agg(F.min("row").alias("first"), F.count("*").alias("n")), "trie-pieces")
    before = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = pieces.select("conv_id", "part", "first", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("shift"))
    at = F.col("row") - F.col("first") + F.col("shift") + 1
    placed = numbered.join(starts, ["conv_id", "part"]).select("conv_id", at.alias("at"), "a", "b", "bytes")
    return placed, pieces.groupBy("conv_id").agg(F.sum("n").alias("n"))


def rebuilt(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conv_id, depth, a, b, bytes, length) for every turn of the rebuilt conversations; second,
    (conv_id, length) for every conversation, those without turns included."""
    turns, sizes = ordered_turns(conversations)
    turns = stored(turns, "trie-placed")
    first = F.col("conv_id") - F.col("conv_id") % FAMILY
    known = sizes.select("conv_id", "n", first.alias("lead"), (F.crc32(F.col("conv_id").cast("string")) % HEAD).alias("h"))
    known = stored(known, "trie-sizes")
    leads = known.select(F.col("conv_id").alias("lead"), F.col("n").alias("lead_n"))
    head = F.when(F.col("lead") == F.col("conv_id"), F.lit(0)).otherwise(F.col("h"))
    plans = known.join(leads, "lead", "left").select(
        "conv_id", "lead", "n", head.alias("h"), F.least(head, F.coalesce("lead_n", F.lit(0))).alias("taken")
    )
    plans = stored(plans.withColumn("length", F.col("taken") + F.greatest(F.col("n") - F.col("h"), F.lit(0))), "trie-plans")
    values = ["a", "b", "bytes", "length"]
    heads = turns.where(F.col("at") < HEAD).withColumnRenamed("conv_id", "lead")
    copied = heads.join(plans.where("h > 0").select("conv_id", "lead", "h", "length"), "lead").where("at <= h")
    own = turns.join(plans.select("conv_id", "h", "taken", "length"), "conv_id").where("at > h")
    rows = copied.select("conv_id", F.col("at").alias("depth"), *values).unionByName(
        own.select("conv_id", (F.col("at") - F.col("h") + F.col("taken")).alias("depth"), *values)
    )
    return stored(rows, "trie-rebuilt"), plans.select("conv_id", "length")


def prefixes(turns: DataFrame) -> DataFrame:
    """(conv_id, depth, ka, kb, bytes, length): 128 bits that stand for the first ``depth`` turns.

    Turns are hashed with their depth and joined by exclusive or, block by block, so that no task needs
    a whole conversation. Two sequences of turns share a key with a chance of 2**-128.
    """
    keys = [F.xxhash64(F.lit(k), "depth", "a", "b").alias(f"m{k}") for k in (1, 2)]
    rows = turns.select("conv_id", "depth", "bytes", "length", *keys, F.expr(f"(depth - 1) div {BLOCK}").alias("block"))
    blocks = rows.groupBy("conv_id", "block").agg(F.bit_xor("m1").alias("t1"), F.bit_xor("m2").alias("t2"))
    earlier = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    carried = blocks.select("conv_id", "block", *[F.bit_xor(f"t{k}").over(earlier).alias(f"c{k}") for k in (1, 2)])
    so_far = Window.partitionBy("conv_id", "block").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    inside = rows.select("conv_id", "block", "depth", "bytes", "length", *[F.bit_xor(f"m{k}").over(so_far).alias(f"p{k}") for k in (1, 2)])
    key = lambda k: F.col(f"p{k}").bitwiseXOR(F.coalesce(f"c{k}", F.lit(0).cast("long")))
    joined = inside.join(carried.where("block > 0"), ["conv_id", "block"], "left")
    return stored(joined.select("conv_id", "depth", key(1).alias("ka"), key(2).alias("kb"), "bytes", "length"), "trie-prefixes")


def paths(named: DataFrame, root: int, unit: int) -> DataFrame:
    """(conv_id, depth, above) of every node below the root whose depth is a multiple of ``unit``.

    ``above`` holds the nodes it hangs from at multiples of ``unit``, by their smallest members, from the
    top of the band of the one directly above. That is a node's own band, or, for the top of a band,
    the band before, so there are at most ``BAND``.
    """
    level = F.expr(f"depth div {unit}")
    rows = named.where((F.col("depth") % unit == 0) & (F.col("depth") > 0)).select(
        "conv_id", "depth", "node", F.expr(f"(depth div {unit} - 1) div {BAND}").alias("band"), F.lit(False).alias("top")
    )
    tops = rows.where(level % BAND == 0).select("conv_id", "depth", "node", (level / BAND).cast("long").alias("band"), F.lit(True).alias("top"))
    begins = rows.where(F.col("depth") == unit).select(
        "conv_id", F.lit(0).cast("long").alias("depth"), F.lit(root).cast("long").alias("node"), "band", F.lit(True).alias("top")
    )
    down = Window.partitionBy("conv_id", "band").orderBy("depth").rowsBetween(Window.unboundedPreceding, -1)
    chained = rows.unionByName(tops).unionByName(begins).withColumn("above", F.collect_list("node").over(down))
    return chained.where(~F.col("top") & (F.col("node") == F.col("conv_id"))).select("conv_id", "depth", "above")


SUMS = ("n_leaves", "saved_tokens")


def summed(rows: DataFrame) -> DataFrame:
    return rows.groupBy("conv_id", "depth").agg(*[F.sum(c).alias(c) for c in SUMS])


def spread(nodes: DataFrame, unit: int, skip: int = 0) -> DataFrame:
    """The sums of nodes, a row for each of the nodes in ``above`` from the ``skip``-th on."""
    first = F.expr(f"(depth div {unit} - 1) div {BAND} * {BAND}")
    each = nodes.select(first.alias("first"), F.posexplode("above").alias("k", "conv_id"), *SUMS).where(F.col("k") >= skip)
    return each.select("conv_id", ((F.col("first") + F.col("k")) * unit).alias("depth"), *SUMS)


def rolled_up(values: DataFrame, named: DataFrame, root: int, deepest: int, unit: int = 1, own: DataFrame | None = None) -> DataFrame:
    """(conv_id, depth, sums): for every node the sums of ``values`` over its subtree.

    Nodes first add to their ancestors within the band. The tops of bands, whose sums now cover a band,
    are the nodes of a trie ``BAND`` times less deep, which is rolled up in the same way; its totals are
    then complete and are added to the band above each top. So there are as many rounds as the depth
    has digits to the base ``BAND``, and nothing is spread over more than a band.
    """
    here = own if own is not None else stored(paths(named, root, unit), f"trie-paths-{unit}")
    level = F.expr(f"depth div {unit}")
    known = here.join(values, ["conv_id", "depth"])
    local = summed(values.unionByName(spread(known.where(level % BAND != 0), unit)))
    if deepest < unit * BAND:
        return local
    local = stored(local, f"trie-local-{unit}")
    is_top = F.col("depth") % (unit * BAND) == 0
    whole = stored(rolled_up(local.where(is_top), named, root, deepest, unit * BAND), f"trie-tops-{unit}")
    below = here.where(level % BAND == 0).join(whole, ["conv_id", "depth"])
    return summed(local.where(~is_top).unionByName(spread(below, unit, skip=1))).unionByName(whole)


def end_digests(ends: DataFrame) -> DataFrame:
    """(conv_id, depth, ends_sha256) of the nodes at which conversations (``member``) end.

    Ids are joined by ranges of ids first. The digest of a node reads these pieces one by one, in order,
    so it needs no more memory than a piece, however many conversations are equal.
    """
    bucket = F.floor(F.col("member") / IDS).alias("bucket")
    ids = F.array_join(F.sort_array(F.collect_list("member")).cast("array<string>"), ",")
    pieces = ends.groupBy("conv_id", "depth", bucket).agg(ids.alias("ids"))
    lined = pieces.repartition("conv_id", "depth").sortWithinPartitions("conv_id", "depth", "bucket")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, digest, done = None, None, []

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([d[0] for d in done], pa.int64()),
                    pa.array([d[1] for d in done], pa.int64()),
                    pa.array([d[2] for d in done], pa.string()),
                ],
                ["conv_id", "depth", "ends_sha256"],
            )

        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("conv_id", "depth", "ids"))
            for conv, depth, text in zip(*columns, strict=True):
                if node == (conv, depth):
                    digest.update(b",")
                else:
                    if node is not None:
                        done.append((*node, digest.hexdigest()))
                    node, digest = (conv, depth), hashlib.sha256()
                digest.update(text.encode())
            if len(done) >= 10_000:
                yield out()
                done = []
        if node is not None:
            done.append((*node, digest.hexdigest()))
        yield out()

    return lined.mapInArrow(run, "conv_id long, depth long, ends_sha256 string")


def nodes(conversations: DataFrame) -> DataFrame:
    """(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256): the trie.

    Rows of ``conversations`` without conv_id belong to none. Turns come in order of turn, null first,
    then role and text; repeated rows are turns of their own. Null role or text is empty. Further
    columns are not read. An empty table gives no node. Remainders of negative ids are those of SQL.
    """
    turns, lengths = rebuilt(conversations)
    if (top := lengths.agg(F.min("conv_id"), F.max("length"), F.count("*")).first())[0] is None:
        top = (-1, 0, 0)  # no conversation, and below no row that names it
    root, deepest, count = top
    every = prefixes(turns)
    same = ["depth", "ka", "kb"]
    found = every.groupBy(*same).agg(F.min("conv_id").alias("node"), F.count("*").alias("n_convs"))
    named = every.join(stored(found, "trie-nodes"), same)  # both sides written, so a frequent beginning can be split
    named = stored(named.select("conv_id", "depth", "node", "n_convs", "bytes", "length"), "trie-named")

    hanging = stored(paths(named, root, 1), "trie-paths-1")
    at_root = lengths.limit(1).select(F.lit(root).cast("long").alias("conv_id"), F.lit(0).cast("long").alias("depth"))
    saved = ((F.col("n_convs") - 1) * F.col("bytes")).alias("saved_tokens")
    own = named.where("node = conv_id").select("conv_id", "depth", "n_convs", saved)
    own = own.unionByName(at_root.select("*", F.lit(count).cast("long").alias("n_convs"), F.lit(0).cast("long").alias("saved_tokens")))
    parent = F.element_at("above", -1)
    children = hanging.groupBy(parent.alias("conv_id"), (F.col("depth") - 1).alias("depth")).agg(F.count("*").alias("n_children"))
    listed = own.join(children, ["conv_id", "depth"], "left").join(
        hanging.select("conv_id", "depth", parent.alias("parent_conv_id")), ["conv_id", "depth"], "left"
    )
    listed = stored(listed.withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("long"))), "trie-listed")
    values = listed.select("conv_id", "depth", (F.col("n_children") == 0).cast("long").alias("n_leaves"), "saved_tokens")
    totals = rolled_up(values, named, root, deepest, own=hanging)
    ends = named.where("depth = length").select(F.col("node").alias("conv_id"), "depth", F.col("conv_id").alias("member"))
    empty = lengths.where("length = 0").select(
        F.lit(root).cast("long").alias("conv_id"), F.lit(0).cast("long").alias("depth"), F.col("conv_id").alias("member")
    )
    digests = end_digests(ends.unionByName(empty))
    rows = listed.drop("saved_tokens").join(totals, ["conv_id", "depth"]).join(digests, ["conv_id", "depth"], "left")
    none = hashlib.sha256(b"").hexdigest()
    return rows.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", *SUMS, F.coalesce("ends_sha256", F.lit(none)).alias("ends_sha256")
    )


SQL = """
    WITH turns AS (
        SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
            row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS at
        FROM conversations WHERE conv_id IS NOT NULL
    ), sizes AS (
        SELECT conv_id, conv_id - conv_id % 5 AS lead, count(*) AS n, xor(list_reduce(
            list_prepend(4294967295, list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))),
            lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), range(8)),
                lambda c, i: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END)
            ), 4294967295) % 9 AS h
        FROM turns GROUP BY conv_id
    ), rebuilt AS (
        SELECT s.conv_id, t.at AS depth, t.role, t.text FROM sizes s JOIN turns t ON t.conv_id = s.lead
        WHERE s.lead <> s.conv_id AND t.at <= s.h
        UNION ALL
        SELECT t.conv_id, t.at - s.h + least(s.h, coalesce(l.n, 0)), t.role, t.text
        FROM sizes s JOIN turns t USING (conv_id) LEFT JOIN sizes l ON l.conv_id = s.lead
        WHERE s.lead <> s.conv_id AND t.at > s.h
        UNION ALL
        SELECT t.conv_id, t.at, t.role, t.text FROM sizes s JOIN turns t USING (conv_id) WHERE s.lead = s.conv_id
    ), whole AS (
        SELECT s.conv_id, coalesce(list({'role': r.role, 'text': r.text} ORDER BY r.depth) FILTER (WHERE r.depth IS NOT NULL), []) AS path
        FROM sizes s LEFT JOIN rebuilt r USING (conv_id) GROUP BY s.conv_id
    ), prefixes AS (
        SELECT conv_id, depth, list_slice(path, 1, depth) AS path, depth = len(path) AS ends
        FROM (SELECT conv_id, path, unnest(range(len(path) + 1)) AS depth FROM whole)
    ), nodes AS (
        SELECT path, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
            coalesce((count(*) - 1) * strlen(path[depth].text), 0) AS saved,
            sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE ends), '')) AS ends_sha256
        FROM prefixes GROUP BY path, depth
    ), links AS (
        SELECT p.path, count(*) AS n_children FROM nodes n JOIN nodes p
        ON n.depth = p.depth + 1 AND list_slice(n.path, 1, p.depth) = p.path GROUP BY p.path
    ), totals AS (
        SELECT a.path, CAST(sum(b.saved) AS BIGINT) AS saved_tokens, count(*) FILTER (WHERE l.path IS NULL) AS n_leaves
        FROM nodes a JOIN nodes b ON b.depth >= a.depth AND list_slice(b.path, 1, a.depth) = a.path
        LEFT JOIN links l ON l.path = b.path GROUP BY a.path
    )
    SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(l.n_children, 0) AS n_children,
        t.n_leaves, t.saved_tokens, n.ends_sha256
    FROM nodes n JOIN totals t ON t.path = n.path LEFT JOIN links l ON l.path = n.path
    LEFT JOIN nodes p ON n.depth > 0 AND p.depth = n.depth - 1 AND p.path = list_slice(n.path, 1, n.depth - 1)
"""
