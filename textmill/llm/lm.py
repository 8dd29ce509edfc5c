"""Stupid-backoff scores from the corpus's own n-grams.

Documents are put into blocks, written once.  Each block sends its distinct
n-grams with their counts to hash buckets, where the count table of a bucket is
summed; every block gets back the totals of its own n-grams, scores its words and sums them per
document.  A frequent n-gram travels once per block, not once per occurrence.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textmill.llm.common import WORD, row_slices, shuffle_partitions
from textmill.llm.hashing import gram_hashes, mix, row_words, span_hashes
from textmill.storage import materialize

ORDER = 2
BACKOFF = 0.4
BLOCK_BYTES = 12 << 20
#: Bytes that are hashed at a time.
_SLICE = 1 << 20
#: Words that are scored at a time.
_WORDS = 200_000


def _planes(x: np.ndarray) -> bytes:
    """Numbers as compressed byte planes: leading zeros cost nothing."""
    wide = np.ascontiguousarray(x.astype("<u8").view(np.uint8).reshape(-1, 8).T)
    return zstandard.compress(wide.tobytes(), 1)


def _numbers(value: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(value), np.uint8).reshape(8, -1)
    return np.ascontiguousarray(planes.T).view("<u8").reshape(-1)


def _block(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for a, b in row_slices(batch.column(1), BLOCK_BYTES):
            part = batch.slice(a, b - a)
            texts = [b"" if t is None else b" ".join(t.encode().split()) for t in part.column(1).to_pylist()]
            sizes = np.fromiter(map(len, texts), np.int64, len(texts))
            packed = zstandard.compress(b"".join(texts), 3)
            yield pa.record_batch(
                [
                    pa.array([part.column(0).to_pylist()], pa.list_(pa.int64())),
                    pa.array([sizes.tolist()], pa.list_(pa.int64())),
                    pa.array([packed], pa.binary()),
                ],
                ["ids", "sizes", "packed"],
            )


def _words(sizes: list[int], packed: bytes) -> tuple[np.ndarray, np.ndarray]:
    """First word of each document of a block, and the hash of every word."""
    raw = np.frombuffer(zstandard.decompress(packed), np.uint8)
    bounds = np.concatenate(([0], np.cumsum(np.array(sizes, np.int64))))
    firsts, hashes, met, a = [np.zeros(1, np.int64)], [np.zeros(0, np.uint64)], 0, 0
    while a < len(sizes):
        b = max(a + 1, int(np.searchsorted(bounds, bounds[a] + _SLICE, "right")) - 1)
        part = raw[bounds[a] : bounds[b]]
        start, end, first = row_words(part, bounds[a : b + 1] - bounds[a])
        firsts.append(first[1:] + met)
        hashes.append(span_hashes(part, start, end))
        met, a = met + len(start), b
    return np.concatenate(firsts), np.concatenate(hashes)


def _grams(first: np.ndarray, words: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Words at which an n-gram begins that lies in one document, and its hash; its length is part of the hash."""
    room = np.repeat(first[1:], np.diff(first)) - np.arange(len(words))
    begins = np.flatnonzero(room >= n)
    return begins, mix(gram_hashes(words, n)[begins] + np.uint64(n))


def _split(keys: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order of the keys by bucket and value, the buckets in use, and where each begins."""
    bucket = (mix(keys) % np.uint64(buckets)).astype(np.int64)
    order = np.lexsort((keys, bucket))
    used, begin = np.unique(bucket[order], return_index=True)
    return order, used, np.append(begin, len(keys))


def _send(order: int, buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                block, sizes, packed = (c[row].as_py() for c in batch.columns)
                first, words = _words(sizes, packed)
                for n in range(1, order + 1):
                    keys, count = np.unique(_grams(first, words, n)[1], return_counts=True)
                    by, used, cut = _split(keys, buckets)
                    keys, count = keys[by], count[by]
                    parts = [slice(a, b) for a, b in zip(cut.tolist(), cut[1:].tolist())]
                    yield pa.record_batch(
                        [
                            pa.array(used, pa.int32()),
                            pa.array([block] * len(used), pa.int64()),
                            pa.array([n] * len(used), pa.int32()),
                            pa.array([_planes(np.diff(keys[p], prepend=np.uint64(0))) for p in parts], pa.binary()),
                            pa.array([_planes(count[p]) for p in parts], pa.binary()),
                        ],
                        ["bucket", "block", "length", "keys", "counts"],
                    )

    return run


def _total(bucket: pa.Table) -> pa.Table:
    """Sum the counts of one bucket and answer every block in its own order of n-grams."""
    keys = [np.cumsum(_numbers(v), dtype=np.uint64) for v in bucket["keys"].to_pylist()]
    counts = [_numbers(v) for v in bucket["counts"].to_pylist()]
    every, place = np.unique(np.concatenate(keys), return_inverse=True)
    total = np.zeros(len(every), np.uint64)
    np.add.at(total, place, np.concatenate(counts))
    ends = np.cumsum([len(k) for k in keys])
    values = [_planes(total[place[e - len(k) : e]]) for k, e in zip(keys, ends.tolist())]
    return pa.table(
        {
            "block": bucket["block"],
            "bucket": bucket["bucket"],
            "length": bucket["length"],
            "totals": pa.array(values, pa.binary()),
        }
    )


def _scores(first: np.ndarray, places: list[np.ndarray], totals: list[np.ndarray], words_in_all: int, backoff: float):
    """Sum of the words' logarithms per document.

    ``first`` has the first word of each document, ``places`` per n-gram length the n-gram that
    begins at each word (-1: none), ``totals`` the corpus's counts of those.
    """
    n, documents, order = len(places[0]), len(first) - 1, len(places)
    doc = np.repeat(np.arange(documents), np.diff(first))
    # counts without the document's own occurrences
    others = []
    for mine, total in zip(places, totals):
        begins = np.flatnonzero(mine >= 0)
        gram = mine[begins].astype(np.int64)
        where, own = np.unique(doc[begins] * (len(total) + 1) + gram, return_inverse=True, return_counts=True)[1:]
        left = np.zeros(n, np.int64)
        left[begins] = total[gram] - own[where]
        others.append(left)
    rest = words_in_all - np.diff(first)[doc]
    log, open_, at = np.zeros(n), np.ones(n, bool), np.arange(n)
    top = np.minimum(order, at - first[doc] + 1)
    for k in range(order, 0, -1):
        begin = np.maximum(at - k + 1, 0)
        fits = open_ & (top >= k)
        count = np.where(fits, others[k - 1][begin], 0)
        context = rest if k == 1 else others[k - 2][begin]
        hit = fits & (count > 0)
        log[hit] = np.log10(count[hit] / context[hit]) + (top - k)[hit] * np.log10(backoff)
        open_ &= ~hit
    # words that no other document has
    log[open_] = (top - 1)[open_] * np.log10(backoff) - np.log10(rest[open_] + 1.0)
    return np.bincount(doc, log, minlength=documents)


def _score(order: int, buckets: int, words_in_all: int, backoff: float):
    def run(blocks: pa.Table, answers: pa.Table) -> pa.Table:
        ids, sizes, packed = (blocks[c][0].as_py() for c in ("ids", "sizes", "packed"))
        first, words = _words(sizes, packed)
        told = {(k, b): v for k, b, v in zip(*(answers[c].to_pylist() for c in ("length", "bucket", "totals")))}
        places, totals = [], []
        for k in range(1, order + 1):
            begins, grams = _grams(first, words, k)
            keys, mine = np.unique(grams, return_inverse=True)
            place = np.full(len(words), -1, np.int32)
            place[begins] = mine
            total = np.zeros(len(keys), np.int64)
            by, used, cut = _split(keys, buckets)
            for b, start, end in zip(used.tolist(), cut.tolist(), cut[1:].tolist()):
                total[by[start:end]] = _numbers(told[k, b]).astype(np.int64)
            places.append(place)
            totals.append(total)
        sums, a = [], 0
        while a < len(ids):
            b = max(a + 1, int(np.searchsorted(first, first[a] + _WORDS, "right")) - 1)
            x = slice(first[a], first[b])
            sums.append(_scores(first[a : b + 1] - first[a], [p[x] for p in places], totals, words_in_all, backoff))
            a = b
        return pa.table(
            {
                "doc_id": pa.array(ids, pa.int64()),
                "n_words": pa.array(np.diff(first), pa.int64()),
                "log_score": pa.array(np.concatenate(sums), pa.float64()),
            }
        )

    return run


def backoff_scores(docs: DataFrame, order: int = ORDER, backoff: float = BACKOFF) -> DataFrame:
    """Score every whole text by the n-grams of all other documents.

    A word is scored by the longest n-gram (of ``order`` words at most) ending in it
    that another document has: its count by that of its context, times ``backoff`` for
    each shorter step; a word that no other document has counts as 1 in all their words plus one.  Counts are over the
    whole corpus without the document itself, so its own words do not raise its score.

    Returns one row per input row: ``doc_id, n_words, log_score`` (sum of decimal logarithms, 0 without words)
    and ``mean_log_score`` (null without words).  A null text has no words; rows repeated in id or text are documents of
    their own; other columns are ignored; an empty table gives an empty result.
    """
    buckets = 4 * shuffle_partitions(docs.sparkSession)
    blocks = materialize(
        docs.select(F.col("doc_id").cast("bigint"), "text")
        .mapInArrow(_block, "ids array<bigint>, sizes array<bigint>, packed binary")
        .withColumn("block", F.monotonically_increasing_id()),
        "blocks",
    )
    sent = blocks.select("block", "sizes", "packed").mapInArrow(
        _send(order, buckets), "bucket int, block bigint, length int, keys binary, counts binary"
    )
    answers = sent.groupBy("bucket").applyInArrow(_total, "block bigint, bucket int, length int, totals binary")
    words = docs.agg(F.coalesce(F.sum(F.regexp_count("text", F.lit(WORD))), F.lit(0))).first()[0]
    scored = (
        blocks.groupBy("block")
        .cogroup(answers.groupBy("block"))
        .applyInArrow(_score(order, buckets, words, backoff), "doc_id bigint, n_words bigint, log_score double")
    )
    mean = F.when(F.col("n_words") > 0, F.col("log_score") / F.col("n_words"))
    return scored.withColumn("mean_log_score", mean)
