"""Connected components by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textmill.storage import materialize


def _stars(edges: DataFrame, large: bool) -> DataFrame:
    """One round: every node sends its neighbours to its smallest one.

    Large: only neighbours above the node.  Small: only neighbours below it, and
    the node itself.  The smallest neighbour comes from an aggregate that
    combines in each task, so no neighbourhood is ever gathered.
    """
    both = edges.select(F.col("a").alias("node"), F.col("b").alias("near"))
    if large:
        both = both.union(edges.select(F.col("b"), F.col("a")))
        least = both.groupBy("node").agg(F.least(F.min("near"), F.col("node")).alias("least"))
        sent = both.where("near > node").join(least, "node").select(F.col("near").alias("a"), F.col("least").alias("b"))
    else:
        least = both.groupBy("node").agg(F.min("near").alias("least"))
        sent = both.join(least, "node").select(F.col("near").alias("a"), F.col("least").alias("b"))
        sent = sent.union(least.select("node", "least"))
    return sent.where("a <> b").distinct()


def components(links: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``links`` (a, b): the smallest node it reaches.

    Edges point from the larger to the smaller node.  Each round is written to the shared folder; the
    rounds end when the edges are stars around the roots and no longer change,
    after about log(longest chain)^2 rounds at most.
    """
    edges = materialize(
        links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(), "links"
    )
    mark = _mark(edges)
    last = None
    while mark != last:
        edges = materialize(_stars(_stars(edges, True), False), "links")
        last, mark = mark, _mark(edges)
    roots = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.union(edges.select(F.col("b"), F.col("b")).distinct())


def _mark(edges: DataFrame) -> tuple:
    """A checksum of the edges: their number and two sums of hashes."""
    h = F.xxhash64("a", "b")
    return tuple(
        edges.agg(
            F.count(F.lit(1)), F.coalesce(F.sum(h.cast("decimal(20,0)")), F.lit(0)), F.coalesce(F.bit_xor(h), F.lit(0))
        ).first()
    )
