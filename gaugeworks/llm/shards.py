"""Balanced label propagation: documents to shards of near equal size, few links cut (operator 3)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gaugeworks.llm.common import stored, text_of

#: Rows that one bucket of a running sum holds on average.
BUCKET_ROWS = 20_000


def running(df: DataFrame, keys: list[str], value: str, by: str, buckets: int) -> DataFrame:
    """Adds ``before``: the sum of ``value`` over the rows of the same keys that come earlier.

    Rows come in the order of (bucket, ``by``), the bucket being a hash of ``by``. Sums of buckets are
    summed up first, so the rows of a key are never together in one task.
    """
    cut = df.withColumn("_bucket", F.pmod(F.xxhash64(by), F.lit(buckets)).cast("int"))
    whole = W.partitionBy(*keys) if keys else W.partitionBy(F.lit(0))
    base = (
        cut.groupBy(*keys, "_bucket")
        .agg(F.sum(value).alias("_sum"))
        .withColumn("_base", F.sum("_sum").over(whole.orderBy("_bucket")) - F.col("_sum"))
        .drop("_sum")
    )
    inner = W.partitionBy(*keys, "_bucket").orderBy(by).rowsBetween(W.unboundedPreceding, W.currentRow)
    return (
        cut.withColumn("_upto", F.sum(value).over(inner))
        .join(base, [*keys, "_bucket"])
        .withColumn("before", (F.col("_base") + F.col("_upto") - F.col(value)).cast("long"))
        .drop("_bucket", "_base", "_upto")
    )


def propagate(state: DataFrame, room: list[int], rounds: int, buckets: int) -> DataFrame:
    """Moves members towards the shard that holds most of their group.

    ``state`` counts members: (grp, shard, n). The members of a group are linked with each other, and
    so are alike; a group of any size is at most one row per shard. ``room[s]`` is the number of
    members shard s may hold. In each round a group's members prefer the shard with most of them
    (ties by a hash of group and shard). From shard a to b, as many may move as want to move the
    other way, plus a share of b's free room; only the matrix of demands reaches the driver.
    """
    shards = len(room)
    for turn in range(rounds):
        best = state.groupBy("grp").agg(
            F.max_by("shard", F.struct("n", F.xxhash64("grp", "shard", F.lit(turn)))).alias("target")
        )
        wish = state.join(best, "grp")
        demand, load = [[0] * shards for _ in room], [0] * shards
        for a, b, n in wish.groupBy("shard", "target").agg(F.sum("n")).collect():  # shards squared at most
            load[a] += n
            if a != b:
                demand[a][b] = n
        allowed = {}
        for b in range(shards):
            swaps = [min(demand[a][b], demand[b][a]) for a in range(shards)]
            excess = [demand[a][b] - swaps[a] for a in range(shards)]
            free, total = max(0, room[b] - load[b]), sum(excess)
            for a in range(shards):
                if demand[a][b]:
                    more = excess[a] if total <= free else free * excess[a] // total
                    allowed[a, b] = swaps[a] + more
        if not sum(allowed.values()):
            break
        quota = F.create_map(*[F.lit(x) for (a, b), n in allowed.items() for x in (a * shards + b, n)])
        movers = running(
            wish.where("shard != target").withColumn("way", F.col("shard") * shards + F.col("target")),
            ["way"],
            "n",
            "grp",
            buckets,
        ).withColumn("go", F.greatest(F.lit(0), F.least(F.col("n"), quota[F.col("way")] - F.col("before"))))
        stay = wish.where("shard = target").select("grp", "shard", "n")
        moved = movers.select("grp", F.col("target").alias("shard"), F.col("go").alias("n"))
        left = movers.select("grp", "shard", (F.col("n") - F.col("go")).alias("n"))
        state = stored(
            reduce(DataFrame.unionByName, (stay, moved, left))
            .where("n > 0")
            .groupBy("grp", "shard")
            .agg(F.sum("n").alias("n")),
            "propagation",
        )
    return state


def assign(docs: DataFrame, shards: int = 24, rounds: int = 5) -> DataFrame:
    """Each row of ``docs`` (doc_id, text) with its shard, counts of shards being at most one apart.

    Documents of equal text are linked. Linked ones move by label propagation; the others fill the
    shards up. Returns doc_id, size (UTF-8 bytes of the text plus 8), text_crc32, law ("rows"), shard,
    slot (gapless from 0 in each shard) and grown_shard (null under this law).

    A null text counts as empty, and empty texts as equal. ``doc_id`` may be null or repeated: each
    row is placed by itself. A group too large for a shard fills shards one after the other. Other
    columns are not read.
    """
    text = text_of()
    rows = stored(
        docs.select(
            F.monotonically_increasing_id().alias("row"),
            F.col("doc_id").cast("long").alias("doc_id"),
            (F.octet_length(text) + 8).cast("long").alias("size"),
            F.crc32(F.encode(text, "UTF-8")).cast("long").alias("text_crc32"),
            F.unhex(F.sha2(text, 256)).alias("grp"),
            F.lit(1).cast("long").alias("one"),
        ),
        "shard-rows",
    )
    total = rows.count()
    buckets = max(64, total // BUCKET_ROWS)
    room = [total // shards + (s < total % shards) for s in range(shards)]

    groups = rows.groupBy("grp").agg(F.count("*").alias("members")).where("members > 1")
    member = stored(rows.join(groups.select("grp"), "grp", "left_semi"), "linked-rows")
    single = rows.join(groups.select("grp"), "grp", "left_anti")

    # Members start spread by hash. A shard's share of them never exceeds its room, as the share of
    # shard s is computed from the running number, shard by shard in turn.
    numbered = stored(running(member, ["grp"], "one", "row", buckets), "numbered")
    start = running(
        numbered.groupBy("grp").agg(F.count("*").alias("members")), [], "members", "grp", buckets
    )  # members of all groups in one row of numbers, dealt to the shards in turn
    first = (
        numbered.withColumnRenamed("before", "place")
        .join(start.select("grp", F.col("before").alias("offset")), "grp")
        .groupBy("grp", F.pmod(F.col("offset") + F.col("place"), F.lit(shards)).cast("int").alias("shard"))
        .agg(F.count("*").alias("n"))
    )
    state = propagate(stored(first, "propagation"), room, rounds, buckets)

    held = dict(state.groupBy("shard").agg(F.sum("n")).collect())  # a row per shard
    upto = W.partitionBy("grp").orderBy("shard").rowsBetween(W.unboundedPreceding, W.currentRow)
    ranges = (
        state.withColumn("end", F.sum("n").over(upto))
        .groupBy("grp")
        .agg(F.array_sort(F.collect_list(F.struct("end", "shard"))).alias("ranges"))
    )  # an entry per shard at most
    placed = numbered.join(ranges, "grp").withColumn(
        "shard", F.filter("ranges", lambda r: r["end"] > F.col("before"))[0]["shard"]
    )
    ends, end = [], 0
    for s in range(shards):
        end += room[s] - held.get(s, 0)
        ends.append(end)
    filler = running(single, [], "one", "row", buckets).withColumn(
        "shard", sum((F.col("before") >= e).cast("int") for e in ends)
    )
    columns = ["row", "doc_id", "size", "text_crc32", "one", "shard"]
    both = placed.select(*columns).unionByName(filler.select(*columns))
    return running(stored(both, "placed"), ["shard"], "one", "row", buckets).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        F.col("before").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
