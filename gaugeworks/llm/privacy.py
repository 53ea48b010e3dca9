"""Personal data, and terms that give it away by corpus co-occurrence (operator 6)."""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator
from itertools import accumulate, groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeworks.llm.common import stored, text_of

#: Kinds in the order in which spans are listed; the last two are added by co-occurrence.
KINDS = ("email", "ip", "card", "phone", "general", "remove")
#: Distinct words a task counts before it passes the counts on; sums are the same for any number.
COUNTED = 300_000
#: Bits of the filter that finds texts which may be copies; results are the same for any number.
SLOTS = 2**25

# Fixed value: how many texts' worth of doubt is put on a term before it is taken to point to an entity.
DOUBT = 2

# The patterns of personal data.
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
WORD = re.compile(r"[^\W\d_]{3,}")


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches: around each @ the longest local part that no earlier match took, and a domain."""
    free, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in LOCAL:
            start -= 1
        if start < at and (domain := DOMAIN.match(text, at + 1)):
            free = domain.end()
            yield start, free
        at = text.find("@", max(at + 1, free))


def luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2]))
    return (total + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])) % 10 == 0


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of personal data, by kind and start; positions are code points."""
    found = [("email", *span) for span in emails(text)]
    # A match begins where a run of digits does, so looking behind changes no result; it spares
    # trying every digit of a long run.
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p[-4:]) <= 255 for p in m[0].split(".")):
            found.append(("ip", *m.span()))
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 16:
            digits = m[0].replace(" ", "").replace("-", "")
            if 16 <= len(digits) <= 19 and luhn(digits):
                found.append(("card", *m.span()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 8 <= sum(map(str.isdigit, m[0])) <= 15:
                found.append(("phone", *m.span()))
    return found


def neighbours(text: str, spans: list[tuple[str, int, int]], reach: int) -> list[dict]:
    """For each mention the words up to ``reach`` words before and after it in its line.

    Words are whole words of the line; one that runs into a mention is no neighbour. A mention without
    neighbours gives one row without a term. Each line is read once, however many mentions it has.
    """
    out = []
    ordered = sorted((start, end) for _, start, end in spans)
    starts = [start for start, _ in ordered]
    reached = list(accumulate((end for _, end in ordered), max))  # how far the first mentions reach

    def free(word: re.Match) -> bool:
        before = bisect_left(starts, word.end())
        return not before or reached[before - 1] <= word.start()

    line_end, words, begins, ends = -1, [], [], []
    for _, start, end in sorted(spans, key=lambda s: s[1]):
        if start >= line_end:
            line_end = text.find("\n", start) % (len(text) + 1)
            words = list(WORD.finditer(text, text.rfind("\n", 0, start) + 1, line_end))
            begins, ends = [w.start() for w in words], [w.end() for w in words]
        before, behind = bisect_right(ends, start), bisect_left(begins, end)
        near = [w for w in words[max(0, before - reach) : before] + words[behind : behind + reach] if free(w)]
        entity = hashlib.md5(re.sub(r"[^0-9A-Za-z@.+_%]", "", text[start:end]).lower().encode()).digest()
        out += [{"entity": entity, "term": w[0].lower(), "start": w.start(), "end": w.end()} for w in near]
        if not near:
            out.append({"entity": entity, "term": None, "start": None, "end": None})
    return out


SPAN = T.ArrayType(T.StructType().add("kind", "string").add("start", "long").add("end", "long"))
NEAR = T.ArrayType(
    T.StructType().add("entity", "binary").add("term", "string").add("start", "long").add("end", "long")
)
SPAN_ARROW = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
NEAR_ARROW = pa.list_(
    pa.struct([("entity", pa.binary()), ("term", pa.string()), ("start", pa.int64()), ("end", pa.int64())])
)


def words_of(text: str) -> set[str]:
    """The distinct lower-cased words of a text, each lower-cased by itself as neighbours are."""
    return {word.lower() for word in set(WORD.findall(text))}


def digest_of(text: str) -> bytes:
    return hashlib.md5(text.encode()).digest()


def copied_slots(digests: DataFrame) -> bytes:
    """A bitmap of ``SLOTS`` bits with those set that a digest (first column) of more than one row falls on.

    Its size is fixed, so what the driver holds does not grow with the rows.
    """
    digest = digests.columns[0]
    slot = F.conv(F.hex(F.substring(digest, 1, 4)), 16, 10).cast("long") % SLOTS
    parts = (
        digests.groupBy(digest)
        .count()
        .where("count > 1")
        .select(F.floor(slot / 32768).alias("part"), (slot % 32768).alias("bit"))
        .groupBy("part")
        .agg(F.bitmap_construct_agg("bit").alias("bits"))
    )
    bitmap = np.zeros((SLOTS // 32768, 4096), dtype=np.uint8)
    for part, bits in parts.collect():
        bitmap[part] = np.frombuffer(bits, dtype=np.uint8)
    return bitmap.tobytes()


def document_counts(texts: DataFrame, copied: bytes) -> DataFrame:
    """(term, documents): in how many distinct texts each lower-cased word occurs.

    ``copied`` is the bitmap of ``copied_slots``. Words of a text that it leaves out are summed by the
    task; those of other texts go on with the digest of the text, to be counted once for each digest.
    """
    shared = texts.sparkSession.sparkContext.broadcast(copied)
    names = ["term", "digest", "documents"]

    def rows(terms: list[str], digest: bytes | None, documents: list[int]) -> pa.RecordBatch:
        columns = [pa.array(terms, pa.string()), pa.array([digest] * len(terms), pa.binary()), pa.array(documents, pa.int64())]
        return pa.RecordBatch.from_arrays(columns, names)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, seen = shared.value, set()
        counts: Counter[str] = Counter()
        for whole in batches:
            for start in range(0, whole.num_rows, 256):
                for text in whole.slice(start, 256).column(0).to_pylist():
                    digest = digest_of(text)
                    slot = int.from_bytes(digest[:4], "big") % SLOTS
                    if not bits[slot >> 3] >> (slot & 7) & 1:
                        counts.update(words_of(text))
                    elif digest not in seen:
                        seen.add(digest)
                        words = list(words_of(text))
                        yield rows(words, digest, [1] * len(words))
                if len(counts) > COUNTED:
                    yield rows(list(counts), None, list(counts.values()))
                    counts.clear()
                if len(seen) > COUNTED:
                    seen.clear()
        yield rows(list(counts), None, list(counts.values()))

    return (
        texts.select(text_of().alias("text"))
        .mapInArrow(count, "term string, digest binary, documents long")
        .groupBy("term", "digest")
        .agg(F.sum("documents").alias("documents"))
        .groupBy("term")
        .agg(F.sum(F.when(F.col("digest").isNull(), F.col("documents")).otherwise(1)).alias("documents"))
    )


def find(docs: DataFrame, share: float = 0.8, reach: int = 6) -> DataFrame:
    """The columns of ``docs`` but the text, with ``spans``: (kind, start, end) by kind and start.

    Personal data are the protected entities. A word within ``reach`` words of an entity in the same
    line may give it away. With n distinct texts, n(t) of them holding term t, n(e) entity e and n(t, e)
    both near each other, p(e) = n(e) / n, and p(e | t) = (n(t, e) + d p(e)) / (n(t) + d): a term seen
    in few texts is trusted less, by the ``DOUBT`` d. It discloses log(p(e | t) / p(e)) of the -log p(e)
    bits of the entity. Where that is at least ``share`` of them, the term's occurrences next to the
    entity become spans too: "remove" if the term occurs nowhere else, else "general". Every pair that
    meets is judged, also one of a single text. Counts are those of all documents; n(e) includes texts
    in which the entity has no word beside it. Words are looked for to the ends of the line, however far
    apart and however long they are.

    A null text counts as empty and has no spans. Copies of a text count once, and each row has its
    spans. ``spans`` of ``docs`` itself is replaced.
    Texts are read twice, whole, and never shuffled.
    """
    kept = [c for c in docs.columns if c not in ("text", "spans")]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, 256):
                batch = whole.slice(start, 256)
                digests, spans, near = [], [], []
                for text in batch.column(batch.num_columns - 1).to_pylist():
                    digests.append(digest_of(text))
                    base = base_spans(text)
                    spans.append([dict(zip(("kind", "start", "end"), s, strict=True)) for s in base])
                    near.append(neighbours(text, base, reach) if base else [])
                made = [pa.array(digests, pa.binary()), pa.array(spans, SPAN_ARROW), pa.array(near, NEAR_ARROW)]
                names = [*batch.schema.names[:-1], "_digest", "_spans", "_near"]
                yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *made], names)

    # The names of the given columns may be any, so they travel in one struct.
    given = F.struct(*[F.col(f"`{c}`") for c in kept]) if kept else F.struct(F.lit(None).alias("none"))
    rows = docs.select(F.monotonically_increasing_id().alias("_row"), given.alias("_given"), text_of().alias("_text"))
    made = [T.StructField("_digest", T.BinaryType()), T.StructField("_spans", SPAN), T.StructField("_near", NEAR)]
    found = stored(rows.mapInArrow(scan, T.StructType([*rows.schema[:-1], *made])), "private-spans")
    total = found.select("_digest").distinct().count()
    counts = document_counts(docs, copied_slots(found.select("_digest")))

    near = found.select("_row", "_digest", F.explode("_near").alias("near")).select("_row", "_digest", "near.*")
    entities = near.groupBy("entity").agg(F.count_distinct("_digest").alias("n_e"))
    pairs = near.where("term IS NOT NULL").groupBy("entity", "term").agg(F.count_distinct("_digest").alias("n_te"))
    p_e = F.col("n_e") / F.lit(float(total))
    disclosed = (
        pairs.join(entities, "entity")
        .join(counts.withColumnRenamed("documents", "n_t"), "term")
        .withColumn("pmi", F.log((F.col("n_te") + DOUBT * p_e) / (F.col("n_t") + DOUBT) / p_e))
        .where((F.col("pmi") > 0) & (F.col("pmi") >= -share * F.log(p_e)))
        .select("entity", "term", F.when(F.col("n_t") == F.col("n_te"), "remove").otherwise("general").alias("kind"))
    )
    order = F.create_map(*[F.lit(x) for i, kind in enumerate(KINDS) for x in (kind, i)])
    added = (
        near.join(disclosed, ["entity", "term"])
        .groupBy("_row", "start", "end")
        .agg(F.max("kind").alias("kind"))  # the stricter of two
        .groupBy("_row")
        .agg(F.array_sort(F.collect_list(F.struct(order[F.col("kind")].alias("o"), "start", "end", "kind"))).alias("more"))
    )
    spans = F.concat(
        "_spans",
        F.coalesce(
            F.transform("more", lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"))),
            F.array().cast(SPAN),
        ),
    )
    joined = found.drop("_near", "_digest").join(added, "_row", "left").withColumn("_all", spans)
    return joined.select(*[F.col(f"_given.`{c}`").alias(c) for c in kept], F.col("_all").alias("spans"))


MASKS = {kind: f"[{kind.upper()}]" for kind in KINDS[:4]} | {"general": "[TERM]", "remove": ""}


def masked(text: str, spans: list[tuple[str, int, int]]) -> str:
    """The text with its spans replaced: data by their kind, revealing terms generalised or removed.

    Of overlapping spans the one that begins first stands, the longer of two at one place.
    """
    out, free = [], 0
    for _, group in groupby(sorted(spans, key=lambda s: (s[1], -s[2])), key=lambda s: s[1]):
        kind, start, end = next(group)
        if start >= free:
            out += [text[free:start], MASKS[kind]]
            free = end
    return "".join([*out, text[free:]])


def sanitise(docs: DataFrame, **options: float) -> DataFrame:
    """``docs`` with personal data and revealing terms masked in the text.

    A null text stays null, repeated rows give repeated results, and no column has to be a key. A column
    ``spans`` is dropped; others are passed on, whatever their names.
    """
    names = docs.drop("spans").columns
    whole = "_whole"
    while whole in names:
        whole += "_"
    found = find(docs.withColumn(whole, F.col("text")), **options)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [
                x if x is None else masked(x, [tuple(s.values()) for s in spans or ()])
                for x, spans in zip(batch.column(whole).to_pylist(), batch.column("spans").to_pylist(), strict=True)
            ]
            yield batch.append_column("text", pa.array(texts, pa.string())).select(names)

    return found.mapInArrow(run, docs.drop("spans").schema)


def digests(docs: DataFrame) -> DataFrame:
    """Per document the counts of each kind, a digest of the base spans, and all spans as text."""
    found = find(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"))

    def listed(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def of(*kinds):
        return F.filter("spans", lambda s: s["kind"].isin(*kinds))

    base = of(*KINDS[:4])
    counts = [F.size(of(kind)).cast("long").alias(f"n_{kind}") for kind in KINDS[:4]]
    return found.select(
        "doc_id", *counts, F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans")
    )
