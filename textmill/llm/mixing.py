"""Mix sources to target weights along a curriculum that changes over training.

The target of a source is the integral of its weight schedule over training
time.  Documents of a source are taken in a fixed shuffled order; the share of
the target a document's words begin at, sent through the inverse of the
cumulative demand, is the time at which it is trained on; every further pass over
the source goes on from there, so each pass of a document has a time of its own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textmill.llm.common import WORD, shuffle_partitions
from textmill.operators.ordered import slice_rows

WEIGHTS = (5.0, 2.0, 1.0)
#: Slope of a source's schedule 1 + slope * (2 t - 1) over training time t, by rank of the source.
SLOPES = (-0.5, 0.0, 0.5)
SHARE = 1.5
MOST = 2


def _by_rank(values: tuple[float, ...]) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (F.col("rank") % F.lit(len(values)) + 1).cast("int"))


def source_targets(sizes: DataFrame, weights=WEIGHTS, share=SHARE, most=MOST, slopes=SLOPES) -> DataFrame:
    """``key, source_size, target, slope`` from ``key, source, size``.

    One row per source.  ``share`` of all words is dealt by weight; no source
    gets over ``most`` times its size, and what it leaves goes to the others by
    weight.  That ends where every open source has ``level * weight``: sources
    are closed in ascending order of cap by weight, which takes running sums over the
    sources, never over documents.
    """
    total = Window.partitionBy()
    ranked = Window.orderBy(F.asc_nulls_last("source"))
    before = Window.orderBy(F.col("cap") / F.col("weight"), "rank").rowsBetween(Window.unboundedPreceding, -1)
    s = sizes.groupBy("key", "source").agg(F.sum("size").alias("source_size"))
    s = s.withColumn("rank", F.row_number().over(ranked) - 1)
    s = s.select(
        "key",
        "source_size",
        _by_rank(weights).alias("weight"),
        _by_rank(slopes).alias("slope"),
        "rank",
        (F.col("source_size") * most).alias("cap"),
        (F.sum("source_size").over(total) * F.lit(share)).alias("budget"),
    )
    s = s.withColumns(
        {
            "cap_before": F.coalesce(F.sum("cap").over(before), F.lit(0)),
            "weight_left": F.sum("weight").over(total) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)),
        }
    )
    closed = F.col("cap") * F.col("weight_left") <= F.col("weight") * (F.col("budget") - F.col("cap_before"))
    s = s.withColumn("closed", closed)
    open_weight = F.sum(F.when(~F.col("closed"), F.col("weight"))).over(total)
    closed_cap = F.coalesce(F.sum(F.when(F.col("closed"), F.col("cap"))).over(total), F.lit(0))
    level = (F.col("budget") - closed_cap) * F.col("weight") / open_weight
    target = F.when(F.col("closed"), F.col("cap").cast("double")).otherwise(level)
    return s.select("key", "source_size", target.alias("target"), "slope")


def training_time(share: Column, slope: Column) -> Column:
    """The time t in [0, 1] by which ``share`` of the demand is due: the root of
    (1 - slope) t + slope t^2 = share."""
    rest = 1 - slope
    root = (F.sqrt(rest * rest + 4 * slope * share) - rest) / (2 * slope)
    return F.when(slope == 0, share).otherwise(root)


def mix_sources(docs: DataFrame, weights=WEIGHTS, share=SHARE, most=MOST, slopes=SLOPES) -> DataFrame:
    """Decide how many words of each document the mix takes, and when.

    Returns one row per input row, range-sorted by training position: ``doc_id,
    size, source_size, target, taken, position, positions`` (the time of the first
    pass, null if nothing is taken, and of every pass that takes words).  ``size``
    counts words (null text: 0); a source's documents follow each
    other by MD5 of the id, are passed at most ``most`` times, and the last one
    is taken in part, so that the taken words are the whole part of the
    target.  A null source is a source of its own and the last in order; rows
    repeated in all columns share the words due to them in any order; other
    columns are ignored.  An empty table gives an empty result, sizes of zero a target of 0.
    """
    placed = _placed(_sized(docs, []), weights, share, most, slopes)
    times = F.transform("passes", lambda p: p["time"])
    return _in_order(placed.withColumn("position", F.get("passes", F.lit(0))["time"])).select(
        "doc_id", "size", "source_size", "target", "taken", "position", times.alias("positions")
    )


def keep_mixed(docs: DataFrame, weights=WEIGHTS, share=SHARE, most=MOST, slopes=SLOPES) -> DataFrame:
    """The mix as whole documents with all columns of ``docs``, in training order.

    A document is repeated once for each pass that takes at least half of its words, at the time of that pass.
    """
    placed = _placed(_sized(docs, [F.struct("*").alias("row")]), weights, share, most, slopes)
    whole = F.filter("passes", lambda p: p["words"] * 2 >= F.col("size"))
    copies = placed.select("row", "ordinal", F.explode(whole).alias("pass"))
    return _in_order(copies.select("row", "ordinal", F.col("pass.time").alias("position"))).select("row.*")


def _sized(docs: DataFrame, more: list[Column]) -> DataFrame:
    key = F.when(F.col("source").isNull(), F.lit("")).otherwise(F.concat(F.lit("="), F.col("source")))
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("bigint")
    order = F.coalesce(F.md5(F.col("doc_id").cast("string")), F.lit(""))
    return docs.select(
        key.alias("key"), F.col("source"), F.col("doc_id"), size.alias("size"), order.alias("ordinal"), *more
    )


def _placed(rows: DataFrame, weights, share, most, slopes) -> DataFrame:
    partitions = shuffle_partitions(rows.sparkSession)
    cut = slice_rows(rows, ["key"], ["ordinal", "doc_id", "size"], partitions).rows
    per_slice = cut.groupBy("key", "_slice").agg(F.sum("size").alias("words"))
    earlier = Window.partitionBy("key").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_slice.select("key", "_slice", F.coalesce(F.sum("words").over(earlier), F.lit(0)).alias("offset"))
    inside = (
        Window.partitionBy("key", "_slice").orderBy("ordinal", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    )
    targets = source_targets(cut.groupBy("key", "source").agg(F.sum("size").alias("size")), weights, share, most, slopes)
    placed = (
        cut.join(offsets, ["key", "_slice"])
        .join(targets, "key")
        .withColumn("begin", F.col("offset") + F.coalesce(F.sum("size").over(inside), F.lit(0)))
    )
    due = F.floor(F.col("target"))
    begins = [F.col("begin") + F.col("source_size") * p for p in range(most)]
    words = [F.least(F.greatest(due - begin, F.lit(0)), F.col("size")).cast("bigint") for begin in begins]
    times = [training_time(F.least(begin / F.col("target"), F.lit(1.0)), F.col("slope")) for begin in begins]
    passes = [F.when(n > 0, F.struct(n.alias("words"), t.alias("time"))) for n, t in zip(words, times)]
    return placed.withColumns({"taken": sum(words, F.lit(0)).cast("bigint"), "passes": F.array_compact(F.array(*passes))})


def _in_order(rows: DataFrame) -> DataFrame:
    """Rows range-sorted by ``position``."""
    partitions = shuffle_partitions(rows.sparkSession)
    return rows.repartitionByRange(partitions, F.asc_nulls_last("position"), "ordinal").sortWithinPartitions(
        F.asc_nulls_last("position"), "ordinal"
    )
