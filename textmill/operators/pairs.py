"""Template pairs: symmetry, similarity of given pairs, and evaluation."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from textmill.operators.alike import nearest_words
from textmill.operators.skew import join_lookup
from textmill.storage import materialize


def pair_symmetry(pairs: DataFrame) -> DataFrame:
    """Distinct pairs ``(p, q, swapped)`` with their count and their reverses.

    ``reverse_as_is``: the pair with both sides exchanged is present literally,
    which needs the same slot order.  ``reverse_renamed``: it is present after
    exchanging the names X and Y, too.  A pair and its reverse are counted in one
    row, so one aggregate does it; a pair of equal sides is its own reverse.
    """
    turned = F.col("p") > F.col("q")
    rows = (
        pairs.groupBy(F.least("p", "q").alias("a"), F.greatest("p", "q").alias("b"), "swapped")
        .agg(F.count_if(~turned).alias("there"), F.count_if(turned).alias("back"))
        .withColumn("both", (F.col("there") > 0) & ((F.col("back") > 0) | (F.col("a") == F.col("b"))))
    )
    directions = F.inline(
        F.array(
            F.struct(F.col("a").alias("p"), F.col("b").alias("q"), F.col("there").alias("n")),
            F.struct(F.col("b").alias("p"), F.col("a").alias("q"), F.col("back").alias("n")),
        )
    )
    return (
        rows.select("swapped", "both", directions)
        .where("n > 0")
        .select("p", "q", "swapped", "n", (F.col("both") & ~F.col("swapped")).alias("reverse_as_is"), F.col("both").alias("reverse_renamed"))
    )


def _filled(bigrams: DataFrame) -> DataFrame:
    """Each bigram seen from both words: its filler in their slot."""
    after = bigrams.select("lang", F.lit("Y").alias("slot"), F.col("w1").alias("p"), F.col("w2").alias("f"), "n")
    return after.union(bigrams.select("lang", F.lit("X"), "w2", "w1", "n"))


def slot_features(bigrams: DataFrame, words: DataFrame | None = None, least_seen: int = 1) -> DataFrame:
    """``(lang, slot, p, f, mi)``: what fills the slots of words, where that is more than chance.

    The words before a word fill its slot X, the words after it slot Y.  A filler weighs its mutual
    information with word and slot.  Only ``words(lang, p)`` if given, and only bigrams seen ``least_seen`` times; the
    totals are of all.  ``bigrams`` and ``words`` are read several times: pass stored or materialized tables.
    """
    ident = ["lang", "slot", "p", "f"]
    # counted in each task first: a row for each word and place, not for each bigram
    first = bigrams.groupBy("lang", F.col("w1").alias("w")).agg(F.sum("n").alias("c"))
    second = bigrams.groupBy("lang", F.col("w2").alias("w")).agg(F.sum("n").alias("c"))
    # a first word has what follows it in its slot Y, and fills slot X of that
    counted = materialize(first.withColumn("slot", F.lit("Y")).union(second.withColumn("slot", F.lit("X"))), "marginals")
    totals = materialize(counted.where("slot = 'Y'").groupBy("lang").agg(F.sum("c").alias("total")), "totals")
    other = F.when(F.col("slot") == "Y", "X").otherwise("Y")
    per_filler = counted.select("lang", other.alias("slot"), F.col("w").alias("f"), F.col("c").alias("cf"))
    per_path = counted.select("lang", "slot", F.col("w").alias("p"), F.col("c").alias("cp"))
    mine = _filled(bigrams.where(F.col("n") >= least_seen))
    if words is not None:
        mine = join_lookup(mine, words, ["lang", "p"], ident, "left_semi")
        per_path = materialize(join_lookup(per_path, words, ["lang", "p"], ["lang", "slot", "p"], "left_semi"), "paths")
    rows = join_lookup(mine, totals, ["lang"], ident)
    rows = join_lookup(rows, per_path, ["lang", "slot", "p"], ident)
    # a filler meets each word once, so no key is hot
    rows = rows.join(per_filler, ["lang", "slot", "f"])
    weight = F.ln(F.col("n").cast("double") * F.col("total") / (F.col("cp").cast("double") * F.col("cf")))
    return materialize(rows.select(*ident, weight.alias("mi")).where("mi > 0"), "features")


def pair_scores(features: DataFrame, pairs: DataFrame) -> DataFrame:
    """``(lang, p, q, similarity)`` of the given pairs.

    The slot similarity is the weight both words share over the weight both have, and the result the
    geometric mean of both slots (Lin and Pantel).  Work grows with the fillers of the pairs.
    """
    ident = ["lang", "slot", "p", "f"]
    mass = features.groupBy("lang", "slot", "p").agg(F.sum("mi").alias("mass"))
    left = join_lookup(features, pairs, ["lang", "p"], ident)
    other = features.select("lang", "slot", F.col("p").alias("q"), "f", F.col("mi").alias("mi_q"))
    shared = (
        left.join(other, ["lang", "slot", "q", "f"])
        .groupBy("lang", "slot", "p", "q")
        .agg(F.sum(F.col("mi") + F.col("mi_q")).alias("shared"))
    )
    slots = shared.join(mass, ["lang", "slot", "p"]).join(
        mass.select("lang", "slot", F.col("p").alias("q"), F.col("mass").alias("mass_q")), ["lang", "slot", "q"]
    )
    ratio = F.col("shared") / (F.col("mass") + F.col("mass_q"))
    both = slots.groupBy("lang", "p", "q").agg(
        F.max(F.when(F.col("slot") == "X", ratio)).alias("x"), F.max(F.when(F.col("slot") == "Y", ratio)).alias("y")
    )
    score = F.sqrt(F.coalesce("x", F.lit(0.0)) * F.coalesce("y", F.lit(0.0)))
    scored = pairs.join(both.select("lang", "p", "q", score.alias("s")), ["lang", "p", "q"], "left")
    return scored.select("lang", "p", "q", F.round(F.coalesce("s", F.lit(0.0)), 3).alias("similarity"))


def path_similarity(bigrams: DataFrame, pairs: DataFrame) -> DataFrame:
    """Similarity of given word pairs ``(lang, p, q)`` by the company of their two slots.

    ``bigrams`` and ``pairs`` are read several times: pass stored or materialized tables.
    """
    words = pairs.select("lang", "p").unionByName(pairs.select("lang", F.col("q").alias("p"))).distinct()
    return pair_scores(slot_features(bigrams, words), pairs)


def similar_candidates(features: DataFrame, least: float, slot: str = "X") -> DataFrame:
    """``(lang, p, q)``: a superset of the pairs whose similarity can reach ``least``; no pair is missed.

    A similarity of ``least`` needs ``least^2`` in each slot.  Take ``p`` as the word with less weight ``m``: what it can share
    is bounded by its own weights and the highest weight that any word gives each filler, and must reach ``2 m least^2``.  From the
    most common fillers on, those that cannot reach it together are left out; only the rarer rest has to meet the fillers of
    ``q``.  Fillers are ordered by the power of two of the words that have them, so a few sums a word are enough.
    """
    tau = least * least
    rows = features.where(F.col("slot") == slot).select("lang", "p", "f", "mi")
    known = rows.groupBy("lang", "f").agg(F.count(F.lit(1)).alias("words"), F.max("mi").alias("most"))
    # a filler that one word has joins nothing, but it counts for the weight
    level = F.floor(F.log2(F.col("words").cast("double"))).cast("int")
    marked = materialize(
        rows.join(known, ["lang", "f"]).select("lang", "p", "f", "mi", "words", level.alias("level"), (F.col("mi") + F.col("most")).alias("can")),
        "marked",
    )
    weights = materialize(marked.groupBy("lang", "p").agg(F.sum("mi").alias("mass"), F.sum("can").alias("reach")), "weights")
    # a filler of one word cannot be shared
    levels = marked.where("words > 1").groupBy("lang", "p", "level").agg(F.sum("can").alias("can"))
    commoner = Window.partitionBy("lang", "p").orderBy(F.desc("level")).rowsBetween(Window.unboundedPreceding, 0)
    needed = (
        levels.withColumn("tail", F.sum("can").over(commoner))
        .join(weights, ["lang", "p"])
        .where(F.col("tail") >= 2 * tau * F.col("mass"))
        .select("lang", "p", "level", F.col("mass").alias("mass_p"), (F.col("reach") / tau - F.col("mass")).alias("limit"))
    )
    shared = marked.where("words > 1")
    prefix = shared.join(needed, ["lang", "p", "level"]).select("lang", "f", "p", "mass_p", "limit")
    others = shared.select("lang", "f", F.col("p").alias("q")).join(
        weights.select("lang", F.col("p").alias("q"), F.col("mass").alias("mass_q")), ["lang", "q"]
    )
    met = prefix.join(others, ["lang", "f"]).where(
        (F.struct("mass_q", "q") > F.struct("mass_p", "p")) & (F.col("mass_q") <= F.col("limit"))
    )
    return met.select("lang", F.least("p", "q").alias("p"), F.greatest("p", "q").alias("q")).distinct()


def similar_templates(bigrams: DataFrame, k: int, least: float, least_seen: int = 1) -> DataFrame:
    """For every word the ``k`` most similar others of at least ``least``: ``(lang, p, rank, q, similarity)``.

    Ties go to the word first in order.  All words of a language are compared, block by block; see ``nearest_words``.
    """
    if not 0 < least <= 1:
        raise ValueError("least must be above 0 and at most 1")
    return nearest_words(slot_features(bigrams, least_seen=least_seen), k, least)


def threshold_sweep(scored: DataFrame, thresholds: list[float]) -> DataFrame:
    """Confusion counts, precision, recall and F1 of ``score >= threshold``.

    ``scored`` has ``(score, label)`` with label 0 or 1.  Rows shrink to counts
    per band between thresholds in one aggregate; the rest works on one row per
    threshold.
    """
    steps = sorted(thresholds)
    band = F.lit(0)
    for step in steps:
        band = band + F.when(F.col("score") >= step, 1).otherwise(0)
    bands = scored.groupBy(band.cast("bigint").alias("band")).agg(
        F.count_if(F.col("label") == 1).alias("pos"), F.count_if(F.col("label") == 0).alias("neg")
    )
    spark = scored.sparkSession
    grid = spark.createDataFrame([(i, s) for i, s in enumerate([None, *steps])], "band long, threshold double")
    counts = grid.join(bands, "band", "left").na.fill(0, ["pos", "neg"]).withColumn("_all", F.lit(1))
    whole = Window.partitionBy("_all")
    above = whole.orderBy("band").rowsBetween(0, Window.unboundedFollowing)
    rows = counts.select(
        "threshold",
        F.sum("pos").over(above).alias("tp"),
        F.sum("neg").over(above).alias("fp"),
        F.sum("pos").over(whole).alias("all_pos"),
        F.sum("neg").over(whole).alias("all_neg"),
    ).where("threshold is not null")
    rows = rows.select(
        "threshold",
        "tp",
        "fp",
        (F.col("all_pos") - F.col("tp")).alias("fn"),
        (F.col("all_neg") - F.col("fp")).alias("tn"),
    )

    def share(a, b):
        return F.when(b > 0, F.round(a / b, 4))

    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return rows.select(
        "*",
        share(tp, tp + fp).alias("precision"),
        share(tp, tp + fn).alias("recall"),
        share(2 * tp, 2 * tp + fp + fn).alias("f1"),
    )
