"""Importance resampling towards a target distribution by hashed n-gram features.

Texts are lower-cased (A-Z) and every run of separators is collapsed to one space.  One pattern with
boundary lookarounds is then run over the text with overlapping matches: a match starts at every
word and its groups are the words of the n-grams that start there, so the spans go to the CRC as they
are and no list of words is ever built.  The CRC of a longer n-gram goes on from that of the shorter one.

The features of every text are scanned once and kept as two bytes each; counting them and adding up
the gains then only reads numbers.
"""

from __future__ import annotations

import math
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textmill.llm.common import row_slices, share, shared, text_bytes
from textmill.operators.ordered import with_position
from textmill.storage import materialize

BUCKETS = 10_000
LONGEST = 3
LEAST_WORDS = 20
PERCENT = 5
SEED = "42"
#: A-Z to a-z on UTF-8 bytes.
_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
#: Texts of so many bytes are scanned at a time.
_SLICE = 1 << 20


def patterns(longest: int = LONGEST) -> tuple[regex.Pattern, regex.Pattern]:
    """What parts words, and what matches the up to ``longest`` words from a word on, a group for each."""
    more = ""
    for _ in range(longest - 1):
        more = f"(?:( [^ ]++){more})?"
    return regex.compile(rb"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"), regex.compile(f"(?<![^ ])([^ ]++){more}(?![^ ])".encode())


def text_features(text: bytes, separators: regex.Pattern, spans: regex.Pattern, buckets: int) -> tuple[int, array]:
    """The number of words of a text and the buckets of all its n-grams, with repeats."""
    line = separators.sub(b" ", text.translate(_LOWER)).strip(b" ")
    crc, out, words = zlib.crc32, array("I"), 0
    add = out.append
    for match in spans.finditer(line, overlapped=True):
        words += 1
        value = 0
        for part in match.groups():
            if part is None:
                break
            value = crc(part, value)
            add(value % buckets)
    return words, out


def features(texts: DataFrame, buckets: int = BUCKETS, longest: int = LONGEST) -> DataFrame:
    """The columns of ``texts`` with ``n_words, n_features`` and ``packed`` (a bucket in two bytes each)
    in place of ``text``, which is the last column."""
    if buckets > 1 << 16:
        raise ValueError("at most 65,536 buckets")
    others = texts.drop("text").schema.fields
    names = [*(f.name for f in others), "n_words", "n_features", "packed"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tools = patterns(longest)
        for batch in batches:
            column = batch.column(batch.num_columns - 1)
            for a, b in row_slices(column, _SLICE):
                raw, bounds = text_bytes(column.slice(a, b - a))
                words, counts, packed = [], [], []
                for i in range(b - a):
                    n, found = text_features(raw[bounds[i] : bounds[i + 1]].tobytes(), *tools, buckets)
                    words.append(n)
                    counts.append(len(found))
                    packed.append(np.frombuffer(found, np.uint32).astype("<u2").tobytes() if n else b"")
                made = [pa.array(words, pa.int64()), pa.array(counts, pa.int64()), pa.array(packed, pa.binary())]
                yield pa.record_batch([*(c.slice(a, b - a) for c in batch.columns[:-1]), *made], names)

    schema = texts.drop("text").schema
    for name, kind in (("n_words", "long"), ("n_features", "long"), ("packed", "binary")):
        schema = schema.add(name, kind)
    return texts.mapInArrow(run, schema)


def bucket_counts(found: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """How often each bucket occurs in all rows; each task sends one number a bucket, so the bound is ``buckets``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            raw, _ = text_bytes(batch.column(0))
            total += np.bincount(raw.view("<u2"), minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.record_batch([pa.array(at, pa.int64()), pa.array(total[at], pa.int64())], ["bucket", "n"])

    rows = found.select("packed").mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(buckets, np.int64)
    for row in rows.collect():
        out[row["bucket"]] = row["n"]
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """``floor(1000 ln p)`` of each bucket, p the ratio of its smoothed shares in target and corpus."""
    buckets, s_all, t_all = len(corpus), float(corpus.sum()), float(target.sum())
    return np.array(
        [
            math.floor(1000 * math.log((t + 1) * (s_all + buckets) / ((s + 1) * (t_all + buckets))))
            for s, t in zip(corpus.astype(float).tolist(), target.astype(float).tolist())
        ],
        np.int64,
    )


def _weights(found: DataFrame, gain: np.ndarray) -> DataFrame:
    """``found`` with ``weight``, the sum of the gains of its features, in place of ``packed``, the last column."""
    box = share(found.sparkSession, gain)
    schema = found.drop("packed").schema.add("weight", "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gain = shared(box)
        for batch in batches:
            raw, bounds = text_bytes(batch.column(batch.num_columns - 1))
            sums = np.concatenate(([0], np.cumsum(gain[raw.view("<u2")])))
            weight = np.diff(sums[bounds // 2])
            yield pa.record_batch([*batch.columns[:-1], pa.array(weight, pa.int64())], schema.names)

    return found.mapInArrow(run, schema)


def resample(
    docs: DataFrame,
    target: DataFrame,
    buckets: int = BUCKETS,
    longest: int = LONGEST,
    least_words: int = LEAST_WORDS,
    percent: int = PERCENT,
    seed: str = SEED,
) -> DataFrame:
    """Score every document by its likeness to ``target`` and draw the highest ``percent`` of 100.

    Returns one row per input row: ``doc_id, text_hash, n_words, n_features, weight, score, rank``, all long but
    the id.  A feature is a run of 1 to ``longest`` words, its bucket the CRC-32 modulo ``buckets``; ``weight``
    adds up ``floor(1000 ln(share in target / share in docs))`` over the features, shares smoothed by one, and ``score``
    adds Gumbel noise that only ``seed`` and ``doc_id`` decide.  Of the rows with ``least_words`` words or more the
    ``percent`` highest scores are drawn without replacement and ranked from 1, ties to the smaller ``doc_id``.

    A null, empty or blank text has no features, weight 0 and is never drawn unless ``least_words`` is 0.  A null id
    counts as the empty string in the noise and comes after all ids in ties.  Repeated rows are rows like any other; rows
    equal in all but the text rank by weight.  Empty tables, either or both, give weight by smoothing alone.  Other
    columns are ignored.  The largest text needs about ten bytes a feature in one worker.
    """
    rows = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    found = materialize(features(rows, buckets, longest), "features")
    wanted = materialize(features(target.select("text"), buckets, longest), "target-features")
    gain = gains(bucket_counts(found, buckets), bucket_counts(wanted, buckets))
    named = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(named, 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))
    scored = _weights(found, gain).withColumn("score", F.col("weight") + noise)
    scored = materialize(scored.withColumn("fit", F.col("n_words") >= least_words), "scored")
    drawn = percent * scored.where("fit").count() // 100
    line = scored.where("fit").select("*", (-F.col("score")).alias("minus"), F.col("doc_id").isNull().alias("unnamed"))
    order = ["minus", "unnamed", "doc_id", "weight", "n_features"]
    placed = with_position(line, [], order, "place").drop("minus", "unnamed")
    rank = F.when(F.col("place") <= drawn, F.col("place")).cast("long").alias("rank")
    rest = scored.where("not fit").withColumn("place", F.lit(None).cast("long"))
    return placed.unionByName(rest, allowMissingColumns=True).drop("fit").select(
        "doc_id", "text_hash", "n_words", "n_features", "weight", "score", rank
    )


def draw(docs: DataFrame, target: DataFrame, **settings) -> DataFrame:
    """The rows of ``docs`` that ``resample`` draws, all columns; rows equal in id and text are drawn together."""
    picked = resample(docs, target, **settings).where("rank is not null").select(
        F.col("doc_id").alias("id"), "text_hash"
    ).distinct()
    rows = docs.select(F.struct("*").alias("row"), F.col("doc_id").alias("id"), F.xxhash64("text").alias("text_hash"))
    same = rows.id.eqNullSafe(picked.id) & (rows.text_hash == picked.text_hash)
    return rows.join(picked, same, "left_semi").select("row.*")
