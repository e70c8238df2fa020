"""A corpus from documents to tokens, stage by stage.

Each stage is a function (spark, docs, sf_dir) -> DataFrame over all that the
stage before it kept; ``run`` writes every stage's result to the shared folder
and reads it again as the next one's documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from adpulse.llm import bpe, common, exact_dedup, mixing, quality_model, queries, simhash


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    return quality_model.good_documents(docs)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of identical texts stays."""
    return exact_dedup.without_copies(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays."""
    return simhash.without_near_duplicates(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources in proportion to their weights, whole epochs repeated."""
    return mixing.mixed_documents(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their token ids and what these decode to."""
    content, pattern = queries.vocabulary()
    return bpe.encode_and_decode(docs, content, pattern)


STAGES = [("quality classifier", quality), ("exact dedup", exact), ("SimHash near-dedup", near),
          ("mixing sources to target weights", mix),
          ("byte-level BPE encoding and decoding", tokens)]

# Trained models, bit distances and byte-pair merges are beyond SQL; the tests
# compare each stage with a plain version instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.documents(spark, sf_dir)
    for k, (_, stage) in enumerate(STAGES):
        docs = common.stored(stage(spark, docs, sf_dir), f"corpus-{k}")
    return docs
