"""The corpus pipeline: quality, line dedup, near-dedup, source mixing, packing.

``STAGES`` lists (name, function) pairs; each function takes (spark, docs,
sf_dir) and returns a DataFrame.  ``run`` applies them to the documents of
``sf_dir``, each stage's result written as Parquet to the shared folder and
read again.  All stages but the last return the columns that they got; the last
returns the pieces of packed sequences.

SQL cannot express the first stage's network, so there is no ``ORACLE_SQL``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fundlake.llm import line_dedup, minhash, mixing, packing, quality
from fundlake.llm.common import as_column, free_names, staged, table
from fundlake.llm.queries import tokenizer_path

ORACLE_SQL = None


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, learnt from the labels that are not held out, takes as good."""
    return quality.keep_good(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines of repeated three-line windows; ``n_chars`` follows the text."""
    n_removed = free_names(docs, "n_lines", "n_removed")[1]
    out = line_dedup.line_dedup(docs)
    return out.select(*[F.when(as_column(n_removed) > 0, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")).alias(c)
                        if c == "n_chars" else as_column(c) for c in docs.columns])


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return minhash.keep_one(docs)


def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample of the documents with the target shares of sources, languages and topics."""
    return mixing.mix(docs)


def pack_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of power-of-two length that the documents are cut into."""
    return packing.pack(docs, tokenizer_path())


STAGES = [
    ("quality classifier", quality_stage),
    ("line dedup", line_stage),
    ("MinHash near-dedup", near_stage),
    ("mixing sources to target weights", mix_stage),
    ("packing", pack_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), "pipeline-" + name.split()[0].lower())
    return docs
