"""Quality classifier trained by co-training of two views (operator 9)."""

from __future__ import annotations

import math
import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeworks.llm.common import byte_hashes, stored, text_of, word_hashes

#: Hashed features of the content view, and of each of source and language.
CONTENT = 1024
NAMES = 32
SHAPE = 12


def content_view(data: np.ndarray) -> np.ndarray:
    """Shares of hashed runs of three bytes, as square roots."""
    out = np.zeros(CONTENT, dtype=np.float32)
    if len(data) >= 3:
        # The work per text is bounded by taking the runs of a long text in slices, all of them.
        for begin in range(0, len(data) - 2, 1 << 20):
            part = data[begin : begin + (1 << 20) + 2]
            out += np.bincount((byte_hashes(part, 3) >> np.uint64(54)).astype(np.int64), minlength=CONTENT)
        out = np.sqrt(out / out.sum())
    return out


_UPPER = np.zeros(256, dtype=bool)
_UPPER[65:91] = True
_LOWER = np.zeros(256, dtype=bool)
_LOWER[97:123] = True
_LOWER[128:] = True
_DIGIT = np.zeros(256, dtype=bool)
_DIGIT[48:58] = True


def metadata_view(data: np.ndarray, source: str | None, lang: str | None) -> np.ndarray:
    """Where a document comes from and what shape it has, without its wording."""
    out = np.zeros(SHAPE + 2 * NAMES, dtype=np.float32)
    n = max(1, len(data))
    words = word_hashes(data)
    count = max(1, len(words))
    kinds = np.bincount(data, minlength=256)
    upper, lower, digit = kinds[_UPPER].sum(), kinds[_LOWER].sum(), kinds[_DIGIT].sum()
    space, lines = kinds[[9, 10, 13, 32]].sum(), kinds[10] + 1
    _, repeated = np.unique(words, return_counts=True)
    again = np.count_nonzero(words[1:] == words[:-1])
    out[:SHAPE] = (
        1,
        math.log1p(len(data)) / 10,
        math.log1p(lines) / 5,
        math.log1p(n / lines) / 8,
        upper / n,
        lower / n,
        digit / n,
        (n - upper - lower - digit - space) / n,
        len(repeated) / count,
        repeated.max(initial=0) / count,
        again / count,
        n / count / 20,
    )
    for k, name in enumerate((source, lang)):
        at = SHAPE + k * NAMES + int(word_hashes(np.frombuffer((name or "-").encode(), dtype=np.uint8)).sum() % NAMES)
        out[at] = 1
    return out


def features(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    sources, langs = batch.column("source").to_pylist(), batch.column("lang").to_pylist()
    for text, source, lang in zip(batch.column("text"), sources, langs, strict=True):
        data = np.frombuffer(text.as_buffer() or b"", dtype=np.uint8)
        yield content_view(data), metadata_view(data, source, lang)


def packed(content: np.ndarray, metadata: np.ndarray) -> bytes:
    """Both views of a document in little room: a byte for each content feature, two for the others."""
    return np.rint(255 * np.sqrt(content)).astype(np.uint8).tobytes() + metadata.astype("<f2").tobytes()


def restored(rows: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The views of packed documents. Training and scoring both see documents this way."""
    size = CONTENT + 2 * (SHAPE + 2 * NAMES)
    data = np.frombuffer(b"".join(rows), dtype=np.uint8).reshape(len(rows), size)
    content = np.square(data[:, :CONTENT].astype(np.float32) / 255)
    return content, np.ascontiguousarray(data[:, CONTENT:]).view("<f2").astype(np.float32)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def fit(x: np.ndarray, y: np.ndarray, decay: float, steps: int = 300) -> np.ndarray:
    """Logistic regression by accelerated gradient steps; the last weight is the intercept."""
    x = x.astype(np.float32, copy=False)
    rate = 4 / (float(np.square(x).sum(1).mean()) + 1 + 4 * decay)
    weights = ahead = np.zeros(x.shape[1] + 1)
    for step in range(steps):
        wrong = sigmoid(x @ ahead[:-1].astype(np.float32) + ahead[-1]) - y
        slope = np.append(x.T @ wrong.astype(np.float32) / len(y) + decay * ahead[:-1], wrong.mean())
        new = ahead - rate * slope
        ahead = new + step / (step + 3) * (new - weights)
        weights = new
    return weights


def margin(x: np.ndarray, weights: np.ndarray) -> np.ndarray:
    return x @ weights[:-1] + weights[-1]


@dataclass
class Model:
    """Weights of the two views, their calibration (slope, shift), and how views combine."""

    content: np.ndarray
    metadata: np.ndarray
    mean: np.ndarray
    scale: np.ndarray
    calibration: np.ndarray
    combined: np.ndarray

    def margins(self, content: np.ndarray, metadata: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return margin(content, self.content), margin((metadata - self.mean) / self.scale, self.metadata)

    def scores(self, content: np.ndarray, metadata: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Probability of good quality by the content, by the metadata, and by both."""
        a, b = (m * c[0] + c[1] for m, c in zip(self.margins(content, metadata), self.calibration, strict=True))
        return sigmoid(a), sigmoid(b), sigmoid(margin(np.stack([a, b], axis=1), self.combined))


def fit_views(content: np.ndarray, metadata: np.ndarray, labels: np.ndarray, held: np.ndarray) -> Model:
    """A model of both views. ``labels`` has a column for each, -1 where a row does not train it. Rows
    marked ``held`` train nothing; they calibrate the views and weigh them against each other."""
    mean, scale = metadata.mean(0), metadata.std(0) + 1e-3
    views = [content, (metadata - mean) / scale]
    weights = []
    for view, label in zip(views, labels.T, strict=True):
        rows = (label >= 0) & ~held
        weights.append(fit(view[rows], label[rows], 1e-4))
    test = held if len(np.unique(labels[held, 0])) == 2 else (labels >= 0).all(1) & ~held
    y = labels[test, 0]
    margins = [margin(v[test], w) for v, w in zip(views, weights, strict=True)]
    calibration = np.array([fit(m[:, None], y, 1e-3) for m in margins])
    both = np.stack([m * c[0] + c[1] for m, c in zip(margins, calibration, strict=True)], axis=1)
    return Model(weights[0], weights[1], mean, scale, calibration, fit(both, y, 1e-3))


def fitted(sample: DataFrame) -> Model:
    """The model of (_id, content_label, metadata_label, held, features), a sample of bounded size: one task
    fits it, and only the weights come to the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(list(batches)).sort_by([("_id", "ascending"), ("features", "ascending")])
        labels = np.stack([table[c].to_numpy() for c in ("content_label", "metadata_label")], axis=1)
        held = table["held"].to_numpy(zero_copy_only=False)
        model = fit_views(*restored(table["features"].to_pylist()), labels, held)
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(model)], pa.binary())], ["model"])

    return pickle.loads(sample.repartition(1).mapInArrow(run, "model binary").first().model)


def views_of(docs: DataFrame) -> DataFrame:
    """(_id, features): the packed views of every document that has an id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for begin in range(0, whole.num_rows, 256):
                batch = whole.slice(begin, 256)
                rows = pa.array([packed(*views) for views in features(batch)], pa.binary())
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), rows], ["_id", "features"])

    return prepared(docs).where("doc_id IS NOT NULL").mapInArrow(run, "_id long, features binary")


def sure(rows: DataFrame, model: Model, confident: float) -> DataFrame:
    """(_id, by_content, by_metadata): the rows on which a view is confident, with its label, -1 if it is not."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for begin in range(0, whole.num_rows, 1024):
                batch = whole.slice(begin, 1024)
                views = restored(batch.column("features").to_pylist())
                said = [np.where(p >= confident, 1, np.where(p <= 1 - confident, 0, -1)) for p in map(sigmoid, model.margins(*views))]
                some = (said[0] >= 0) | (said[1] >= 0)
                columns = [batch.column("_id").filter(pa.array(some)), *(pa.array(x[some], pa.int32()) for x in said)]
                yield pa.RecordBatch.from_arrays(columns, ["_id", "by_content", "by_metadata"])

    return rows.mapInArrow(run, "_id long, by_content int, by_metadata int")


def train(
    docs: DataFrame, labels: DataFrame, labelled: int = 6000, pseudo: int = 2000, rounds: int = 3, confident: float = 0.95
) -> Model | None:
    """A co-trained model; None if the labels of documents are not of two kinds.

    At most ``labelled`` labelled documents train it, chosen by a hash of their id among those that
    ``docs`` holds; a quarter of them is held out to calibrate. In each round the two views label all
    other documents, and each teaches the other up to ``pseudo`` of those on which it is ``confident``,
    in the proportion of the classes and chosen by the hash among all of them.
    """
    rows = stored(views_of(docs), "quality-views")
    one = (
        labels.where("doc_id IS NOT NULL AND quality IN (0, 1)")
        .groupBy(F.col("doc_id").cast("long").alias("_id"))
        .agg(F.min("quality").cast("int").alias("_label"))
    )
    one = stored(one.join(rows.select("_id").distinct(), "_id"), "quality-labels")
    by_hash = [F.xxhash64("_id"), F.col("_id")]
    known = one.orderBy(*by_hash).limit(labelled)
    base = rows.join(F.broadcast(known), "_id").dropDuplicates(["_id"])  # bounded by the parameter
    held = (F.pmod(F.xxhash64("_id", F.lit(1)), F.lit(4)) == 0).alias("held")
    base = stored(base.select("_id", *[F.col("_label").alias(c) for c in LABELS], held, "features"), "quality-sample")
    counts = {r[0]: r[1] for r in base.where("NOT held").groupBy("content_label").count().collect()}
    if len(counts) < 2:
        return None
    model = fitted(base)
    for _ in range(rounds):
        told = stored(sure(rows, model, confident).join(one, "_id", "left_anti"), "quality-sure")
        taught = None
        for teacher, pupil in (("by_content", "metadata_label"), ("by_metadata", "content_label")):
            for value, times in sorted(counts.items()):
                most = max(1, round(pseudo * times / sum(counts.values())))
                part = told.where(F.col(teacher) == value).orderBy(*by_hash).limit(most)
                part = part.select("_id", *[F.lit(value if c == pupil else -1).alias(c) for c in LABELS])
                taught = part if taught is None else taught.unionByName(part)
        taught = taught.groupBy("_id").agg(*[F.max(c).alias(c) for c in LABELS])
        more = rows.join(F.broadcast(taught), "_id").dropDuplicates(["_id"])  # bounded by the parameter
        more = more.select("_id", *LABELS, F.lit(False).alias("held"), "features")
        model = fitted(base.unionByName(more))
    return model


def prepared(docs: DataFrame) -> DataFrame:
    """The columns that the views read; ones that ``docs`` lacks are null."""
    extra = [F.col(c).cast("string").alias(c) if c in docs.columns else F.lit(None).cast("string").alias(c) for c in ("source", "lang")]
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"), *extra)


LABELS = ("content_label", "metadata_label")
SCORES = ("content_score", "metadata_score", "score")


def score(docs: DataFrame, labels: DataFrame, threshold: float = 0.5, **bounds: float) -> DataFrame:
    """All rows of ``docs`` with content_score, metadata_score, score and keep.

    Two logistic regressions see a document, one its wording, the other its metadata and shape. They
    train each other (``train``, which takes ``bounds``) and score every row by its whole text. ``score`` is
    the probability of good quality by both; a row is kept from ``threshold`` on, ties included.

    A null text counts as empty; null source or language is a value of its own. Labels that
    contradict each other count as bad; labels of absent documents, or without one, are not used. Of rows
    with one id, one may train. Without labels of both kinds every score is 1. Columns of
    ``docs`` with the names of results are replaced, the others passed on.
    """
    model = train(docs, labels, **bounds)
    names = [c for c in docs.columns if c not in (*SCORES, "keep")]
    given = F.struct(*[F.col(f"`{c}`") for c in names]).alias("_given")
    extra = [F.col(c).cast("string").alias(c) if c in docs.columns else F.lit(None).cast("string").alias(c) for c in ("source", "lang")]
    rows = docs.select(given, text_of().alias("text"), *extra)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for begin in range(0, whole.num_rows, 256):
                batch = whole.slice(begin, 256)
                if model is None:
                    values = [np.ones(batch.num_rows)] * 3
                else:
                    values = model.scores(*restored([packed(*views) for views in features(batch)]))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("_given"), *(pa.array(np.asarray(v, dtype=np.float64)) for v in values)], ["_given", *SCORES]
                )

    schema = T.StructType([rows.schema["_given"], *(T.StructField(s, T.DoubleType()) for s in SCORES)])
    done = rows.mapInArrow(run, schema)
    return done.select(
        *[F.col(f"_given.`{c}`").alias(c) for c in names],
        *[F.round(s, 6).alias(s) for s in SCORES],
        (F.col("score") >= threshold).alias("keep"),
    )
