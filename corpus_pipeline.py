"""The corpus pipeline: quality, near duplicates, repeated passages, mixture, tokens.

Each stage is a function of (spark, docs, sf_dir) over all rows that the stage before
it kept; all but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from keyflow.llm import bpe, mixing, near, quality, substrings
from keyflow.llm.store import written


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    return quality.good_documents(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one with the smallest id, of each group of near duplicates."""
    return near.first_of_class(docs)


def substring_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages of 13 words and more that an earlier document has.

    What stays of a text keeps its white space; a document of which nothing stays goes.
    """
    return substrings.without_duplicates(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mixture takes it."""
    return mixing.mixed_documents(docs)


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each text: their number and digest, and the digest of what they decode to."""
    return bpe.digests(bpe.bpe_columns(docs, bpe.default_path(), keep=("doc_id", "source")))


STAGES = [
    ("quality_classifier", quality_stage),
    ("jaccard_join", near_stage),
    ("substring_dedup", substring_stage),
    ("source_mixing", mixing_stage),
    ("bpe_codec", token_stage),
]

#: A trained classifier and a tokenizer have no SQL form; tests compare each stage
#: with a brute-force version instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
