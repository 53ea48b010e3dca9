"""Documents to clean, unique, tokenized text, stage by stage.

Each stage works on every row it is given, whatever is null in it. A null text counts as an empty one and
stays null until it is tokenized. Rows that repeat an id or a text, also rows without an id, are rows like
others. Further columns are passed on, whatever their names, but the last stage returns its own. An empty
table gives an empty one. All decisions are the same when a stage runs again.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeworks.llm import benchmarks, bpe, lines, quality, similar
from gaugeworks.llm.common import read, ship, stored


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the co-trained classifier accepts, those with a score of just the threshold too.

    Null source or language is a value like others; without labels of both kinds all rows stay.
    """
    ship(spark.sparkContext)
    scored = quality.score(docs, read(spark, sf_dir, "labels"))
    return scored.where("keep").select(*docs.columns)


def fresh_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without later occurrences of three-line windows; n_chars follows the text.

    Of equal windows the first by id, then by a digest of the text, stays; rows without an id come last.
    A document of which nothing but blank lines is left goes, one that was empty or null before stays.
    """
    ship(spark.sparkContext)
    left = lines.deduplicate(docs).where(r"n_removed = 0 OR text RLIKE '[^\\x20\\n]'")
    size = F.when(F.col("n_removed") > 0, F.char_length("text").cast("long")).otherwise(F.col("n_chars"))
    return left.withColumn("n_chars", size).select(*docs.columns)


def unique_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, by five-word shingles at 0.8.

    The one with the smallest id stays, one without an id only if none has one. Documents without
    words are in no group, so all of them stay.
    """
    ship(spark.sparkContext)
    return similar.representatives(docs)


def free_of_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item, by five-word shingles at 0.8 or more.

    Items without text are in no document; rows are judged by their text, whatever their id.
    """
    return benchmarks.clean(docs, read(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token ids of each document, with a digest of what they decode to; no ids for an empty text."""
    ship(spark.sparkContext)
    coded = bpe.encode(
        docs.select("doc_id", "text"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    )
    return coded.select(
        "doc_id",
        F.size("token_ids").cast("long").alias("n_tokens"),
        "token_ids",
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


STAGES = [
    ("quality", good_quality),
    ("lines", fresh_lines),
    ("near_duplicates", unique_documents),
    ("decontamination", free_of_benchmarks),
    ("tokens", tokens),
]

#: A trained classifier and a tokenizer are beyond SQL; tests compare stages with brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to the documents; each is written and reread as the next one's input."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
