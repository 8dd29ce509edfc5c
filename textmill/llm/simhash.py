"""SimHash near-dedup by meet-in-the-middle ball hashing.

Two fingerprints within ``2 r`` bits have a common neighbour within ``r`` bits
of each.  So every distinct fingerprint emits all its variants within ``r``
bits, and fingerprints meet where they share a variant.  A meeting point holds
at most as many fingerprints as a ball of radius ``r`` does (65 for one bit),
whatever the data, and all of them are within ``2 r`` bits of each other: the
sorted neighbours of a meeting point are linked in a chain, which reaches all of
them without emitting all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textmill.llm.common import row_hash
from textmill.llm.components import components
from textmill.storage import materialize

BITS = 64
SHINGLE = 3
MAX_BITS = 2
SEED = 42
#: A-Z to a-z on UTF-8 bytes.
_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
#: Shingles whose bits are counted at a time.
_BLOCK = 1 << 16


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The SimHash of one whole text as a signed 64-bit number; no words: 0."""
    words = (text or "").encode().translate(_LOWER).split()
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    count = max(1, len(words) - shingle + 1)
    first = np.concatenate(([0], ends[: count - 1])).tolist()
    last = (ends[min(shingle, len(words)) - 1 :] - 1).tolist()
    digest = xxhash.xxh64_intdigest
    ones = np.zeros(BITS, np.int64)
    for k in range(0, count, _BLOCK):
        some = [digest(line[a:b], SEED) for a, b in zip(first[k : k + _BLOCK], last[k : k + _BLOCK])]
        bits = np.unpackbits(np.array(some, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > count, bitorder="little").view("<i8")[0])


def fingerprints(rows: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """The columns of ``rows`` with ``fp``, the fingerprint of every whole text, in place of ``text``, the last."""
    others = rows.drop("text").dtypes
    names = [*(name for name, _ in others), "fp"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [fingerprint(t.as_py(), shingle) for t in batch.column(batch.num_columns - 1)]
            yield pa.record_batch([*batch.columns[:-1], pa.array(values, pa.int64())], names)

    return rows.mapInArrow(run, ", ".join([*(f"{name} {kind}" for name, kind in others), "fp bigint"]))


def masks(radius: int) -> list[int]:
    """All ways to flip at most ``radius`` of the bits, as signed numbers."""
    flips = (sum(1 << b for b in chosen) for k in range(radius + 1) for chosen in combinations(range(BITS), k))
    return [m - (1 << BITS) if m >> (BITS - 1) else m for m in flips]


def links(distinct: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """``a, b`` (a < b): links between distinct fingerprints, enough to connect
    all that are within ``max_bits`` (an even number)."""
    if max_bits % 2:
        raise ValueError("max_bits must be even")
    mask = F.explode(F.array(*[F.lit(m).cast("bigint") for m in masks(max_bits // 2)]))
    variants = distinct.select("fp", mask.alias("mask")).select(
        F.col("fp").bitwiseXOR(F.col("mask")).alias("variant"), "fp"
    )
    met = Window.partitionBy("variant").orderBy("fp")
    pairs = variants.select(F.lag("fp").over(met).alias("a"), F.col("fp").alias("b")).where("a is not null")
    return pairs.distinct().where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits)


def near_dedup(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """Link documents whose fingerprints differ in at most ``max_bits`` bits.

    Returns one row per input row: ``doc_id, fingerprint`` (16 hex digits) and
    ``component_id``, the smallest ``doc_id`` that links reach.  Texts are lower-cased (A-Z),
    cut into words and shingles with repeats; a text shorter than a shingle is one
    shingle, a null, empty or blank text has fingerprint zero and links like any other.
    Null ids never name a component that has another id; repeated rows get equal rows, other
    columns are ignored, an empty table gives an empty result.
    """
    marked, named = _components(docs.select("doc_id", "text"), F.col("doc_id"), shingle, max_bits)
    return marked.join(named, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_near(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """``docs`` with one row of each component: that of the smallest ``doc_id``.

    All columns stay.  Rows that share the smallest id, or have none, are told apart by the hash of their text:
    the smallest stays, and rows that repeat both are one.
    """
    hashed = F.xxhash64("text").alias("hashed")
    first = F.struct(F.col("doc_id").isNull().alias("unnamed"), F.col("doc_id").alias("id"), hashed)
    lowest = F.struct("unnamed", F.col("doc_id").alias("id"), "hashed")
    marked = docs.select("doc_id", F.col("doc_id").isNull().alias("unnamed"), hashed, "text")
    named = _components(marked, lowest, shingle, max_bits)[1]
    winners = named.select(F.col("component_id").alias("key")).distinct()
    rows = docs.select(F.struct("*").alias("row"), first.alias("key"))
    won = rows.join(winners, rows.key.eqNullSafe(winners.key), "left_semi")
    twin = Window.partitionBy("key").orderBy(row_hash(docs.schema, "row"))
    return won.withColumn("twin", F.row_number().over(twin)).where("twin = 1").select("row.*")


def _components(rows: DataFrame, name: Column, shingle: int, max_bits: int) -> tuple[DataFrame, DataFrame]:
    """Rows with their fingerprint, and per fingerprint its ``component_id``, the smallest ``name`` of its component."""
    marked = materialize(fingerprints(rows, shingle), "simhash")
    distinct = materialize(marked.groupBy("fp").agg(F.min(name).alias("lowest")), "simhash-distinct")
    roots = components(links(distinct.select("fp"), max_bits))
    rooted = distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn(
        "root", F.coalesce("root", "fp")
    )
    lowest = rooted.groupBy("root").agg(F.min("lowest").alias("component_id"))
    return marked, rooted.join(lowest, "root").select("fp", "component_id")
