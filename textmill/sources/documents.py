"""Document bodies as rows ``(url, text)``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textmill.functions.strings import percent_decoded


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """One row per file below ``path``, read as UTF-8; the URL is the file's."""
    files = spark.read.option("recursiveFileLookup", "true").text(path, wholetext=True)
    return files.select(percent_decoded(F.col("_metadata.file_path")).alias("url"), F.col("value").alias("text"))


def body_stats(docs: DataFrame) -> DataFrame:
    """Size and digest per body: ``(url, n_chars, n_bytes, digest)``."""
    return docs.select(
        "url",
        F.length("text").cast("bigint").alias("n_chars"),
        F.octet_length("text").cast("bigint").alias("n_bytes"),
        F.md5(F.col("text").cast("binary")).alias("digest"),
    )
