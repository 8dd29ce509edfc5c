"""Statistics over tags, printed trees and printed dependencies."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textmill.functions import arrow_text as T
from textmill.functions import text as X
from textmill.functions.arrow_parse import edges


def _tagged_tokens(docs: DataFrame) -> DataFrame:
    tokens = F.flatten(F.transform(X.sentence_array(F.col("text")), X.token_array))
    rows = docs.select(F.explode(tokens).alias("tok")).withColumn("w", F.lower("tok"))
    return rows.select("w", X.tag(F.col("tok"), F.col("w")).alias("tag"))


def tag_counts(docs: DataFrame) -> DataFrame:
    return _tagged_tokens(docs).groupBy("tag").agg(F.count(F.lit(1)).alias("n"))


def tag_bigrams(docs: DataFrame) -> DataFrame:
    """Counts of neighbouring tags inside a sentence."""
    tokens = F.transform(X.sentence_array(F.col("text")), X.token_array)
    pairs = docs.select(F.explode(T.neighbouring_tags(tokens)).alias("p"))
    return pairs.groupBy(F.col("p.a").alias("tag1"), F.col("p.b").alias("tag2")).agg(F.count(F.lit(1)).alias("n"))


def tag_lexicon(docs: DataFrame) -> DataFrame:
    """Most frequent tag per lower-cased word: ``(w, tag, n, total, n_tags)``.

    Ties go to the tag first in order.  Counting comes before grouping by word,
    so a word meets its tags (a few dozen at most), never its occurrences.
    """
    counts = (
        _tagged_tokens(docs).groupBy("w", "tag").agg(F.count(F.lit(1)).alias("n"))
    )
    best = counts.groupBy("w").agg(
        F.min(F.struct((-F.col("n")).alias("minus_n"), "tag")).alias("best"),
        F.sum("n").alias("total"),
        F.count(F.lit(1)).alias("n_tags"),
    )
    return best.select("w", F.col("best.tag").alias("tag"), (-F.col("best.minus_n")).alias("n"), "total", "n_tags")


def tree_label_counts(trees: DataFrame, column: str = "tree") -> DataFrame:
    """Counts of the labels in bracketed trees."""
    labels = F.regexp_extract_all(F.col(column), F.lit(r"\(([^() ]+)"), F.lit(1))
    return trees.select(F.explode(labels).alias("label")).groupBy("label").agg(F.count(F.lit(1)).alias("n"))


def tree_tag_words(trees: DataFrame, column: str = "tree") -> DataFrame:
    """Counts of the ``(TAG word)`` leaves in bracketed trees."""
    leaves = F.regexp_extract_all(F.col(column), F.lit(r"\([^() ]+ [^() ]+\)"), F.lit(0))
    leaf = trees.select(F.explode(leaves).alias("leaf"))
    # "(TAG word)": neither part holds a blank or a bracket
    parts = leaf.select(
        F.substr(F.substring_index("leaf", " ", 1), F.lit(2)).alias("tag"),
        F.substring_index(F.substring_index("leaf", " ", -1), ")", 1).alias("word"),
    )
    return parts.groupBy("tag", "word").agg(F.count(F.lit(1)).alias("n"))


def dep_edge_counts(parses: DataFrame, column: str = "deps") -> DataFrame:
    """Counts of ``(rel, head, dep)`` in printed dependencies, one edge per line."""
    parts = parses.select(F.inline(edges(F.col(column))))
    return parts.groupBy("rel", "head", "dep").agg(F.count(F.lit(1)).alias("n"))


def shallow_parses(docs: DataFrame, *keep: str) -> DataFrame:
    """Printed shallow parses per sentence: ``(keep..., sent_idx, tree, deps)``."""
    tokens = F.transform(X.sentence_array(F.col("text")), X.token_array)
    rows = docs.select(*keep, F.posexplode(tokens).alias("sent_idx", "_tokens"))
    tokens = F.col("_tokens")
    return rows.select(*keep, "sent_idx", T.shallow_tree(tokens).alias("tree"), T.dependency_block(tokens).alias("deps"))
