"""One query per operator over its whole table, with its DuckDB statement where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import conversation, fingerprint, line_dedup, merkle, minhash, mixing, nn_descent, packing, pii, quality, suffix_dedup, toxicity, url_filter
from .common import table


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    """Where the public vocabulary file lies; it is not part of this repository."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calibrated sampling of every document: cell, words, probability and decision."""
    return mixing.calibrated(table(spark, sf_dir, "documents"))


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of every document, plain and disguised."""
    return pii.find_pii(table(spark, sf_dir, "documents"))


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the bytes of 200-byte strings that start anywhere else too."""
    return suffix_dedup.suffix_dedup(table(spark, sf_dir, "documents"))


def op4_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's component of near-duplicates."""
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without its repeated three-line windows."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.line_dedup(docs).selectExpr("doc_id", "n_lines", "n_removed", "coalesce(text, '') as kept_text")


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's url judged by the rules."""
    return url_filter.filter_urls(table(spark, sf_dir, "pages"))


def op6_nn_descent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector's links and component."""
    return nn_descent.near_vectors(table(spark, sf_dir, "embeddings"))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document, learnt from the labels that are not held out."""
    docs = table(spark, sf_dir, "documents")
    return quality.score(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document cut into power-of-two sequences."""
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path())


def op10_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's fingerprint, its edited text's, and the likeness to the next document."""
    return fingerprint.edited_fingerprints(table(spark, sf_dir, "documents"))


def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's leaf, proof and verification in the Merkle manifest of the table."""
    return merkle.document_proofs(table(spark, sf_dir, "documents"))


def op12_conversation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation's faults after damage and its cheapest repair."""
    return conversation.repair(table(spark, sf_dir, "conversations"))


def op13_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document, learnt from voters and the labels that are not held out."""
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_mixing": op1_mixing,
    "op2_pii": op2_pii,
    "op3_suffix_dedup": op3_suffix_dedup,
    "op4_minhash": op4_minhash,
    "op5_line_dedup": op5_line_dedup,
    "op6_nn_descent": op6_nn_descent,
    "op7_quality": op7_quality,
    "op8_packing": op8_packing,
    "op9_url_filter": op9_url_filter,
    "op10_fingerprint": op10_fingerprint,
    "op11_merkle": op11_merkle,
    "op12_conversation": op12_conversation,
    "op13_toxicity": op13_toxicity,
}

ORACLE_SQL: dict[str, str] = {
    "op1_mixing": mixing.ORACLE_SQL,
    "op5_line_dedup": line_dedup.ORACLE_SQL,
    "op9_url_filter": url_filter.ORACLE_SQL,
    "op11_merkle": merkle.ORACLE_SQL,
}
