"""Annotated-text scan: ``word/TAG word/TAG `` lines back to rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textmill.functions.strings import trimmed


def parse_tagged(bodies: DataFrame, body: str = "body") -> DataFrame:
    """Add ``(sent_idx, pos, tok, tag)`` to the other columns, one row per token.

    A token may hold ``/``: the tag starts after the last one.  Marker lines
    without a tag give no rows.
    """
    rest = [c for c in bodies.columns if c != body]
    lines = bodies.select(*rest, F.posexplode(F.split(F.col(body), "\n")).alias("sent_idx", "_line"))
    words = lines.select(
        *rest, "sent_idx", F.posexplode(F.split(trimmed(F.col("_line")), " ")).alias("pos", "_word")
    )
    name = F.substring_index("_word", "/", -1)
    return words.where(F.contains("_word", F.lit("/"))).select(
        *rest,
        "sent_idx",
        "pos",
        F.substr(F.col("_word"), F.lit(1), F.length("_word") - F.length(name) - 1).alias("tok"),
        name.alias("tag"),
    )


def read_tagged(spark: SparkSession, path: str) -> DataFrame:
    """Token rows of annotated text files, one file per document; adds ``doc``."""
    files = spark.read.option("recursiveFileLookup", "true").text(path, wholetext=True)
    return parse_tagged(files.select(F.col("_metadata.file_path").alias("doc"), F.col("value").alias("body")))
