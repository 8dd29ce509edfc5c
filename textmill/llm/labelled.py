"""Labelled rows for the classifiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def held_out(folds: int, fold: int) -> Column:
    """True for rows that no label may be learned from: crc32(doc_id as text) mod ``folds`` is ``fold``."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % folds == fold, F.lit(False))


def labelled_rows(labels: DataFrame, label: str, folds: int, fold: int, most: int, by_class: bool) -> DataFrame:
    """``doc_id, label`` of at most ``most`` labelled rows (of each class if ``by_class``), chosen by a hash
    of the id, never of the held-out fold.  Its size is bounded by ``most``, so it may be broadcast."""
    usable = (
        labels.select("doc_id", F.col(label).cast("int").alias("label"))
        .where(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1) & ~held_out(folds, fold))
        .distinct()
    )
    if not by_class:
        return usable.orderBy(F.xxhash64("doc_id"), "doc_id", "label").limit(most)
    parts = [usable.where(F.col("label") == c).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most) for c in (0, 1)]
    return parts[0].union(parts[1])


def labelled_texts(docs: DataFrame, chosen: DataFrame, copies: int = 2) -> DataFrame:
    """``doc_id, label, text`` of the chosen ids; of rows that share an id, the ``copies`` with the smallest text hashes.

    So the number of rows is bounded by that of ``chosen``, and reruns take the same ones.
    """
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    same = Window.partitionBy("doc_id", "label").orderBy(F.xxhash64("text"))
    return rows.withColumn("_copy", F.row_number().over(same)).where(F.col("_copy") <= copies).select("doc_id", "label", "text")
