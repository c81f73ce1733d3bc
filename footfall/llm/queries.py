"""The catalogue queries of the training-data operators: one per operator,
over the whole of its table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from footfall.llm.centroids import clustered, clustered_sql
from footfall.llm.decontamination import benchmark_overlap
from footfall.llm.html_text import page_texts
from footfall.llm.language import languages
from footfall.llm.licenses import licenses
from footfall.llm.mixing import mixture, mixture_sql
from footfall.llm.near_copies import near_copies
from footfall.llm.neighbours import nearest_neighbours
from footfall.llm.personal_data import personal_digests
from footfall.llm.phrases import phrase_fingerprints
from footfall.llm.prefix_trie import conversation_trie, conversation_trie_sql
from footfall.llm.secrets import secret_digests
from footfall.llm.toxicity import toxicity_scores
from footfall.sources.tables import read_table


def op1_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class and number of links of every document."""
    return near_copies(read_table(spark, sf_dir, "documents")).select("doc_id", "class_id", "n_links", "n_copies")


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document."""
    return toxicity_scores(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op3_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten nearest vectors of every hundredth one."""
    return nearest_neighbours(read_table(spark, sf_dir, "embeddings"))


def op4_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of every document."""
    return personal_digests(read_table(spark, sf_dir, "documents"))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items that documents hold."""
    found = benchmark_overlap(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "matched", "windows", "coverage", "slots")


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document."""
    return languages(read_table(spark, sf_dir, "documents"))


def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document."""
    return secret_digests(read_table(spark, sf_dir, "documents"))


def op8_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence passages of all documents."""
    return licenses(read_table(spark, sf_dir, "documents"))


def op9_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return page_texts(read_table(spark, sf_dir, "pages"))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents, by epoch, of the weighted mix."""
    return mixture(read_table(spark, sf_dir, "documents")).drop("text_hash")


def op11_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cluster of every vector."""
    return clustered(read_table(spark, sf_dir, "embeddings"))


def op12_phrase_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lempel-Ziv fingerprints of every document and of its edited text."""
    return phrase_fingerprints(read_table(spark, sf_dir, "documents"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nodes of the prefix trie of the rebuilt conversations."""
    return conversation_trie(read_table(spark, sf_dir, "conversations"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_ngram_jaccard, op2_toxicity, op3_nearest_neighbours, op4_personal_data, op5_decontamination,
        op6_language, op7_secrets, op8_licenses, op9_html_text, op10_mixing,
        op11_centroids, op12_phrase_fingerprints, op13_prefix_trie,
    )
}

#: DuckDB SQL where SQL can express the operator; the others are held against
#: brute force, or held-out labels, in tests/llm.
ORACLE_SQL: dict[str, str] = {
    "op10_mixing": mixture_sql(), "op11_centroids": clustered_sql(), "op13_prefix_trie": conversation_trie_sql(),
}
