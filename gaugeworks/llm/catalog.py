"""The registered queries of this subpackage and the SQL of those that SQL can express."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from gaugeworks.llm import benchmarks, bpe, knn, lexical, lines, pages, privacy, quality, rules, shards, similar, suffixes, trie
from gaugeworks.llm.common import read, text_of


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items in documents, with similarity and place."""
    return benchmarks.report(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without repeated strings of 200 bytes."""
    return suffixes.digests(read(spark, sf_dir, "documents"))


def op3_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 24 shards by balanced label propagation."""
    return shards.assign(read(spark, sf_dir, "documents"))


def op4_voronoi_knn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best other vectors of every hundredth vector."""
    return knn.search(read(spark, sf_dir, "embeddings"))


def op5_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    return pages.texts(read(spark, sf_dir, "pages"))


def op6_privacy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data and terms that reveal it in every document."""
    return privacy.digests(read(spark, sf_dir, "documents"))


def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Byte-level BPE of every document, and back."""
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return bpe.digests(read(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)


def op8_line_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without later occurrences of repeated three-line windows."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return lines.deduplicate(docs).withColumn("text", text_of())


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quality score of every document, and whether it is kept."""
    docs = read(spark, sf_dir, "documents")
    return quality.score(docs, read(spark, sf_dir, "labels")).select("doc_id", *quality.SCORES, "keep")


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of documents whose three-word shingles agree by nine tenths."""
    return similar.groups(read(spark, sf_dir, "documents"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every node of the trie of rebuilt conversations, with sums over its subtree."""
    return trie.nodes(read(spark, sf_dir, "conversations"))


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fifty best documents for every benchmark item."""
    return lexical.search(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op13_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The counts of every document and the verdict of the threshold table."""
    return rules.verdicts(read(spark, sf_dir, "documents"))


QUERIES = {
    "op1_decontamination": op1_decontamination,
    "op2_suffix_dedup": op2_suffix_dedup,
    "op3_shards": op3_shards,
    "op4_voronoi_knn": op4_voronoi_knn,
    "op5_main_text": op5_main_text,
    "op6_privacy": op6_privacy,
    "op7_byte_bpe": op7_byte_bpe,
    "op8_line_windows": op8_line_windows,
    "op9_quality": op9_quality,
    "op10_jaccard_join": op10_jaccard_join,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_lexical_search": op12_lexical_search,
    "op13_quality_rules": op13_quality_rules,
}

ORACLES: dict[str, str] = {
    "op8_line_windows": lines.SQL,
    "op11_prefix_trie": trie.SQL,
    "op12_lexical_search": lexical.SQL,
    "op13_quality_rules": rules.SQL,
    "op4_voronoi_knn": """
        WITH good AS (
            SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
            FROM embeddings
            WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), scored AS (
            SELECT q.vec_id AS query_id, d.vec_id AS vec_id,
                CAST(list_dot_product(CAST(q.v AS DOUBLE[]), CAST(d.v AS DOUBLE[])) AS BIGINT) AS score
            FROM good q JOIN good d ON q.vec_id % 100 = 0 AND q.vec_id <> d.vec_id
        ), ranked AS (
            SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank
            FROM scored
        )
        SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10
    """,
}
