"""From documents to training tokens in five stages.

Every stage takes what its predecessor kept and returns it with the columns of
``documents``; the last returns tokens.  Between stages the rows are written as
Parquet to the shared folder and read again, so a lost executor costs no more
than the stage in hand.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from textmill.llm.common import documents, table
from textmill.llm.exact import keep_exact
from textmill.llm.mixing import keep_mixed
from textmill.llm.quality import keep_good
from textmill.llm.queries import bpe_digests
from textmill.llm.simhash import keep_near
from textmill.storage import materialize


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that the pairwise ranking rejects."""
    return keep_good(docs, table(spark, sf_dir, "labels"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts keep the row with the largest id."""
    return keep_exact(docs)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies keep the document with the smallest id."""
    return keep_near(docs)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeat or leave out documents so that sources come near their targets, in training order."""
    return keep_mixed(docs)


def bpe_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Encode and decode what is left: digests of ids and text, one row per document of the mix."""
    return bpe_digests(docs)


STAGES = [
    ("quality_classifier", quality_classifier),
    ("exact_dedup", exact_dedup),
    ("simhash_near_dedup", simhash_near_dedup),
    ("source_mixing", source_mixing),
    ("bpe_encoding", bpe_encoding),
]

#: The learned and the Python stages have no SQL; tests compare the rows of every stage with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
