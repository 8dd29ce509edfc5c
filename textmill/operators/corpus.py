"""Corpus statistics: terms, stop words, bigrams, collocations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textmill.functions import text as X
from textmill.operators.skew import join_lookup
from textmill.storage import materialize


def term_frequency(docs: DataFrame) -> DataFrame:
    """Occurrences and documents per word: ``(lang, w, tf, df)``.

    A document's words are sorted in its own row, where the first of equal words
    is marked: documents are the sum of the marks.  One shuffle of words counted
    beforehand, no distinct by document.
    """
    sorted_words = docs.select("lang", F.sort_array(X.word_array(F.col("text"))).alias("_words"))
    marks = F.transform(
        "_words",
        lambda w, i: F.struct(
            w.alias("w"), F.when((i == 0) | (F.get("_words", i - 1) != w), 1).otherwise(0).alias("first")
        ),
    )
    rows = sorted_words.select("lang", F.explode(marks).alias("m"))
    return rows.groupBy("lang", F.col("m.w").alias("w")).agg(
        F.count(F.lit(1)).alias("tf"), F.sum("m.first").alias("df")
    )


def document_frequency(docs: DataFrame) -> DataFrame:
    """``(lang, w, df)`` alone."""
    distinct = F.array_distinct(X.word_array(F.col("text")))
    return (
        docs.select("lang", F.explode(distinct).alias("w")).groupBy("lang", "w").agg(F.count(F.lit(1)).alias("df"))
    )


def derived_stopwords(docs: DataFrame, k: int = 20) -> DataFrame:
    """The ``k`` words of most documents per language, ties by word.

    The rank filter is pushed below the shuffle as a group limit: each task
    sends at most ``k`` words per language.
    """
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("df"), "w"))
    return document_frequency(docs).withColumn("rank", rank).where(F.col("rank") <= k)


def content_tokens(docs: DataFrame, stop: DataFrame) -> DataFrame:
    """Word rows ``(doc_id, lang, pos, w)`` without the stop words."""
    words = docs.select("doc_id", "lang", F.posexplode(X.word_array(F.col("text"))).alias("pos", "w"))
    return join_lookup(words, stop.select("lang", "w"), ["lang", "w"], ["doc_id", "pos"], "left_anti")


def bigram_counts(docs: DataFrame, stop: DataFrame | None = None) -> DataFrame:
    """Counts of neighbouring words ``(lang, w1, w2, n)``, none of them in ``stop``.

    Neighbours come from the document's row.  Stop words go after counting,
    where each pair is one row whatever its frequency.
    """
    words = docs.select("lang", X.word_array(F.col("text")).alias("_words"))
    pairs = words.select("lang", F.explode(X.pairs_of(F.col("_words"))).alias("p"))
    counts = pairs.groupBy("lang", F.col("p.a").alias("w1"), F.col("p.b").alias("w2")).agg(
        F.count(F.lit(1)).alias("n")
    )
    if stop is None:
        return counts
    for side in ("w1", "w2"):
        words = stop.select("lang", F.col("w").alias(side))
        counts = join_lookup(counts, words, ["lang", side], ["lang", "w1", "w2"], "left_anti")
    return counts


def _xlogx(x: Column) -> Column:
    return F.when(x > 0, x * F.ln(x)).otherwise(F.lit(0.0))


def log_likelihood(k11: Column, c1: Column, c2: Column, total: Column) -> Column:
    """Dunning's ratio from the joint count, both marginals and the total."""
    cells = _xlogx(k11) + _xlogx(c1 - k11) + _xlogx(c2 - k11) + _xlogx(total - c1 - c2 + k11)
    rows = _xlogx(c1) + _xlogx(total - c1)
    columns = _xlogx(c2) + _xlogx(total - c2)
    return 2.0 * (cells - rows - columns + _xlogx(total))


def collocations(bigrams: DataFrame, k: int, min_count: int = 1) -> DataFrame:
    """The ``k`` strongest bigrams per language by log-likelihood ratio.

    Bigrams seen fewer than ``min_count`` times are not ranked (1: all are).  ``bigrams``
    is read twice: pass a stored or materialized table.  All marginals come from one
    pass; they are joined after the count filter, where little is left.
    """
    word = F.col
    marginals = materialize(
        bigrams.groupingSets([[word("lang"), word("w1")], [word("lang"), word("w2")], [word("lang")]], "lang", "w1", "w2")
        .agg(F.sum("n").alias("c"), F.grouping_id().alias("level")),
        "marginals",
    )
    first = marginals.where("level = 1").select("lang", "w1", F.col("c").alias("c1"))
    second = marginals.where("level = 2").select("lang", "w2", F.col("c").alias("c2"))
    totals = marginals.where("level = 3").select("lang", F.col("c").alias("total"))
    kept = bigrams.where(F.col("n") >= min_count)
    ident = ["lang", "w1", "w2"]
    rows = join_lookup(kept, totals, ["lang"], ident)
    rows = join_lookup(rows, first, ["lang", "w1"], ident)
    rows = join_lookup(rows, second, ["lang", "w2"], ident)
    score = F.round(log_likelihood(*[F.col(c).cast("double") for c in ("n", "c1", "c2", "total")]), 3)
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("llr"), "w1", "w2"))
    scored = rows.select("lang", "w1", "w2", "n", score.alias("llr"))
    return scored.withColumn("rank", rank).where(F.col("rank") <= k)
