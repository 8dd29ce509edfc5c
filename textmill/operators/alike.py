"""The most similar words of every word: all pairs, block against block."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from textmill.operators.skew import join_lookup
from textmill.storage import materialize

#: Words of a block at most, on average, and into how many blocks a language goes if it is smaller.
BLOCK_WORDS = 65_536
BLOCKS, FEWEST_WORDS = 12, 1_000
MAX_TASKS = 4_096
#: Cells and meetings that a step of a task holds, besides those of one word.
STEP = 2_000_000
BLOCK_PAIR = ["lang", "i", "j"]


def _best(a: np.ndarray, b: np.ndarray, t: np.ndarray, k: int, n: int) -> np.ndarray:
    """Where the ``k`` highest ``t`` of each ``a`` are, ties by ``b``, which is below ``n``."""
    order = np.argsort((a * 1001 + (1000 - t)) * n + b)
    a = a[order]
    first = np.flatnonzero(np.r_[True, a[1:] != a[:-1]]) if len(a) else np.zeros(0, np.int64)
    rank = np.arange(len(a)) - np.repeat(first, np.diff(np.r_[first, len(a)]))
    return order[rank < k]


class _Slot:
    """One slot of two blocks: the features of the first by word, of the second by filler."""

    def __init__(self, left: tuple[np.ndarray, ...], right: tuple[np.ndarray, ...], words: int, others: int) -> None:
        row, filler, self.a = (x[np.argsort(left[0], kind="stable")] for x in left)
        column, held, self.b = (x[np.argsort(right[1], kind="stable")] for x in right)
        self.row, self.column = row, column
        self.mass, self.other_mass = np.bincount(row, self.a, words), np.bincount(column, self.b, others)
        self.start = np.searchsorted(held, filler)
        self.size = np.searchsorted(held, filler, "right") - self.start
        self.upto = np.searchsorted(row, np.arange(words + 1))
        self.work = np.bincount(row, self.size, words)

    def shared(self, lo: int, hi: int, others: int) -> np.ndarray:
        """The weight that the words ``lo`` to ``hi`` share with each word of the other block, as one flat array."""
        mine = slice(self.upto[lo], self.upto[hi])
        size = self.size[mine]
        left = np.repeat(np.arange(mine.start, mine.stop), size)
        # a run of places of the second block for each feature
        right = np.arange(len(left)) + np.repeat(self.start[mine] - (np.cumsum(size) - size), size)
        cell = (self.row[left] - lo) * others + self.column[right]
        return np.bincount(cell, self.a[left] + self.b[right], (hi - lo) * others)


def _nearest_of_blocks(table: pa.Table, k: int, least: float) -> pa.Table:
    """``(w, v, t)``: the ``k`` best of the other block for each word of both; ``t`` is the similarity in thousandths."""
    second, slot, w, f, mi = (table[c].to_numpy() for c in ("second", "slot", "w", "f", "mi"))
    same = not second.any()
    words = np.unique(w[~second])
    others = words if same else np.unique(w[second])
    n = len(others)
    slots = []
    for name in ("X", "Y"):
        left = (slot == name) & ~second
        right = left if same else (slot == name) & second
        slots.append(
            _Slot(
                (np.searchsorted(words, w[left]), f[left], mi[left]),
                (np.searchsorted(others, w[right]), f[right], mi[right]),
                len(words),
                n,
            )
        )
    work = np.cumsum(n + slots[0].work + slots[1].work) // STEP
    ends = np.r_[np.flatnonzero(np.diff(work)) + 1, len(words)] if n else []
    found, turned = [], []
    lo = 0
    for hi in map(int, ends):
        shared = [s.shared(lo, hi, n) for s in slots]
        met = np.flatnonzero((shared[0] > 0) & (shared[1] > 0))
        i, j = met // n + lo, met % n
        square = np.ones(len(met))
        for s, both in zip(slots, shared):
            square *= both[met] / (s.mass[i] + s.other_mass[j])
        t = np.minimum(np.floor(np.sqrt(square) * 1000 + 0.5).astype(np.int64), 1000)
        kept = (t / 1000 >= least) & (j > i if same else True)
        i, j, t = i[kept], j[kept], t[kept]
        best = _best(i, j, t, k, n)
        found.append((i[best], j[best], t[best]))
        best = _best(j, i, t, k, len(words))
        turned.append((j[best], i[best], t[best]))
        lo = hi
    parts = []
    for rows, a, b in ((found, words, others), (turned, others, words)):
        i, j, t = (np.concatenate([r[x] for r in rows]) if rows else np.zeros(0, np.int64) for x in range(3))
        best = _best(i, j, t, k, max(len(b), 1))
        parts.append((a[i[best]], b[j[best]], t[best]))
    return pa.table({c: np.concatenate([p[x] for p in parts]).astype(np.int64) for x, c in enumerate(("w", "v", "t"))})


def nearest_words(features: DataFrame, k: int, least: float) -> DataFrame:
    """``(lang, p, rank, q, similarity)`` of ``features(lang, slot, p, f, mi)``: the ``k`` most similar words of each.

    Rare words have few fillers and most of those are common, so nearly all words meet and no index leaves many pairs out.
    The words of a language are dealt into blocks and a task compares two blocks by arrays; of each word it sends
    on the ``k`` best only.  A task holds the features of two blocks and some ``STEP`` cells, and a feature travels once
    for each block of its language.
    """
    ident = ["lang", "slot", "p", "f"]
    words = features.groupBy("lang", "p").agg(F.count_distinct("slot").alias("slots"))
    # numbers in the order of the words; a filler is a word of the other slot, so it has a number, too
    names = materialize(words.orderBy("lang", "p").withColumn("id", F.monotonically_increasing_id()), "names")
    # a word without one of the slots is like no other
    mine = names.where("slots = 2").select("lang", "p", F.col("id").alias("w"))
    rows = join_lookup(features, mine, ["lang", "p"], ident)
    rows = join_lookup(rows, names.select("lang", F.col("p").alias("f"), F.col("id").alias("f_id")), ["lang", "f"], ident)
    blocks = F.greatest(
        F.ceil(F.col("n") / BLOCK_WORDS), F.least(F.lit(BLOCKS), F.ceil(F.col("n") / FEWEST_WORDS))
    )
    dealt = materialize(mine.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).select("lang", blocks.alias("blocks")), "blocks")
    rows = join_lookup(rows, dealt, ["lang"], ident)
    block = F.pmod(F.xxhash64("w"), F.col("blocks"))
    rows = rows.select("lang", "slot", "w", F.col("f_id").alias("f"), "mi", block.alias("block"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    sent = rows.select(
        "lang",
        F.least("block", "other").alias("i"),
        F.greatest("block", "other").alias("j"),
        (F.col("block") > F.col("other")).alias("second"),
        "slot",
        "w",
        "f",
        "mi",
    )
    pairs = dealt.agg(F.sum(F.col("blocks") * (F.col("blocks") + 1) / 2).cast("long")).first()[0] or 1
    met = (
        sent.repartition(min(pairs, MAX_TASKS), *BLOCK_PAIR)
        .groupBy(*BLOCK_PAIR)
        .applyInArrow(lambda table: _nearest_of_blocks(table, k, least), "w long, v long, t long")
    )
    best = Window.partitionBy("w").orderBy(F.desc("t"), "v")
    ranked = materialize(met.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k), "ranked")
    named = join_lookup(ranked, mine.select(F.col("lang"), "p", "w"), ["w"], ["w", "rank"])
    named = join_lookup(named, mine.select(F.col("p").alias("q"), F.col("w").alias("v")), ["v"], ["w", "rank"])
    return named.select("lang", "p", "rank", "q", (F.col("t") / 1000).alias("similarity"))
