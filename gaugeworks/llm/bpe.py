"""Byte-level BPE with a rank queue made of bitmaps (operator 7)."""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeworks.llm.common import text_of

#: Ranks in a word of the lower bitmap; a rank is found by one find-first-set in each of the two levels.
BITS = 8
WORD = 1 << BITS
#: Distinct pre-tokens and distinct space-separated chunks whose ids a worker remembers. A full memory
#: begins anew; results stay the same.
REMEMBERED = 800_000
#: Longer ones are not remembered.
LONGEST_REMEMBERED = 40


class Codec:
    """Encodes pre-tokens by a table of ranks and decodes ids.

    The queue of pairs waiting to be merged is a bucket of positions for each merge rank under a
    bitmap of two levels: a bit of a lower word tells that a bucket holds positions, a bit of the
    upper word that a lower word is not zero. The lowest rank is two find-first-set steps away,
    whatever the number of positions, so a pre-token takes time in proportion to its length.
    """

    def __init__(self, ranks: dict[bytes, int]) -> None:
        self.ranks = ranks
        self.pieces = {rank: piece for piece, rank in ranks.items()}
        self.low = [0] * (max(ranks.values(), default=0) // WORD + 1)

    def ids(self, piece: bytes) -> list[int]:
        """The ids of one pre-token: the pair of lowest rank is merged first, the leftmost among equals.

        Parts are a linked list of start positions. An entry of a bucket is stale, and skipped, if
        the pair that begins at its position has another rank by now.
        """
        rank_of = self.ranks.get
        if (whole := rank_of(piece)) is not None:
            return [whole]
        low, top, n = self.low, 0, len(piece)
        buckets: dict[int, list[int]] = {}
        after = list(range(1, n + 2))
        before = list(range(-1, n + 1))
        pair = [rank_of(piece[i : i + 2]) for i in range(n - 1)]
        pair += (None, None)
        for i, rank in enumerate(pair):
            if rank is not None:
                if rank in buckets:
                    buckets[rank].append(i)  # ascending, so a heap as it is
                else:
                    buckets[rank] = [i]
                    word = rank >> BITS
                    low[word] |= 1 << (rank & WORD - 1)
                    top |= 1 << word
        while top:
            word = (top & -top).bit_length() - 1
            bits = low[word]
            rank = (word << BITS) + (bits & -bits).bit_length() - 1
            bucket = buckets[rank]
            i = heapq.heappop(bucket)
            if not bucket:
                del buckets[rank]
                low[word] = bits = bits & (bits - 1)
                if not bits:
                    top &= top - 1
            if pair[i] != rank:
                continue
            gone = after[i]
            end = after[i] = after[gone]
            before[end] = i
            pair[gone] = None
            left = before[i]
            fresh = rank_of(piece[i : after[end]]) if end < n else None
            renewed = ((i, fresh),) if left < 0 else ((i, fresh), (left, rank_of(piece[left:end])))
            for at, rank in renewed:
                pair[at] = rank
                if rank is not None:
                    if rank in buckets:
                        heapq.heappush(buckets[rank], at)
                    else:
                        buckets[rank] = [at]
                        word = rank >> BITS
                        low[word] |= 1 << (rank & WORD - 1)
                        top |= 1 << word
        out, i = [], 0
        while i < n:
            end = after[i]
            out.append(self.ranks[piece[i:end]])
            i = end
        return out

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.pieces.__getitem__, ids))


class Memory(dict):
    """Ids, as little-endian bytes, of texts that were met before; filled on demand."""

    def __init__(self, found: Callable[[str], bytes]) -> None:
        self.found = found

    def __missing__(self, key: str) -> bytes:
        value = self.found(key)
        if len(key) <= LONGEST_REMEMBERED:
            if len(self) >= REMEMBERED:
                self.clear()
            self[key] = value
        return value


class Encoder:
    """Cuts texts into pre-tokens and encodes each.

    A text is first cut before every space that a visible character follows. The pattern has to begin
    a new match there, as all byte-level patterns do that let a word own the space in front of it, so
    each chunk can be cut by itself, and frequent chunks need be cut only once.
    """

    def __init__(self, path: str, pattern: str) -> None:
        self.codec = codec(path)
        self.cut = regex.compile(pattern)
        self.tokens = Memory(lambda token: np.array(self.codec.ids(token.encode()), dtype="<u4").tobytes())
        self.chunks = Memory(lambda chunk: b"".join(map(self.tokens.__getitem__, self.cut.findall(chunk))))

    def __call__(self, text: str) -> bytes:
        return b"".join(map(self.chunks.__getitem__, chunks(text)))


def chunks(text: str) -> list[str]:
    """The text cut before each space that is followed by a character that is no white space."""
    first, *rest = text.split(" ")
    out = [first]
    for part in rest:
        if part and not part[0].isspace():
            out.append(" " + part)
        else:
            out[-1] += " " + part
    return out


@cache
def encoder(path: str, pattern: str) -> Encoder:
    return Encoder(path, pattern)


@cache
def codec(path: str) -> Codec:
    """The table of a rank file: lines of a base64 piece and its rank."""
    with open(path, "rb") as file:
        return Codec({base64.b64decode(a): int(b) for a, b in map(bytes.split, file)})


def encode(docs: DataFrame, path: str, pattern: str, text: str = "text") -> DataFrame:
    """The documents with their token ids and the decoded ids.

    Adds ``token_ids`` (array of int; empty for a null or empty text) and ``decoded`` (binary); the
    columns of ``docs`` stay, but for ones with these two names, which are replaced. ``path`` is a
    rank file all executors have and ``pattern`` cuts a text into pre-tokens. Each row is coded by
    itself, so repeated rows give repeated results; a text is held whole, however long, and nothing
    is shuffled.
    """
    kept = docs.drop("token_ids", "decoded")
    more = T.StructType().add("token_ids", T.ArrayType(T.IntegerType())).add("decoded", "binary")
    schema = T.StructType([*kept.schema, *more])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, ids, back in coded(batches, path, pattern, text):
            codes = pa.array([np.frombuffer(x, dtype="<i4") for x in ids], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, codes, pa.array(back, pa.binary())], [*batch.schema.names, "token_ids", "decoded"]
            )

    return kept.mapInArrow(run, schema)


def digests(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """Per document the number of tokens and the SHA-256 of ids and of decoded bytes.

    ``doc_id`` may be null or repeated; each row gives a row.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, ids, back in coded(batches, path, pattern, "text"):
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([len(x) // 4 for x in ids], pa.int64()),
                    pa.array([hashlib.sha256(x).hexdigest() for x in ids]),
                    pa.array([hashlib.sha256(x).hexdigest() for x in back]),
                ],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return docs.select(F.col("doc_id").cast("long"), text_of().alias("text")).mapInArrow(run, schema)


def coded(
    batches: Iterator[pa.RecordBatch], path: str, pattern: str, text: str
) -> Iterator[tuple[pa.RecordBatch, list[bytes], list[bytes]]]:
    """Rows a few at a time with the ids as bytes and the decoded bytes."""
    encoded = encoder(path, pattern)
    decode = encoded.codec.decode
    for whole in batches:
        for start in range(0, whole.num_rows, 256):
            batch = whole.slice(start, 256)
            ids, back = [], []
            for value in batch.column(text).to_pylist():
                ids.append(encoded(value or ""))
                back.append(decode(np.frombuffer(ids[-1], dtype="<u4").tolist()))
            yield batch, ids, back
