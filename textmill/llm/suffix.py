"""Suffix-array dedup by bucket-pointer refinement.

All places of a shard are put into buckets by their first eight bytes.  A bucket is refined by
sorting its places on the bucket identifiers of a later offset; the new
identifiers are twice as deep and are used for the next round, until the depth
of a window.  Places alone in their bucket are left out, as nothing equals them.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from textmill.llm.passages import HOT_RUNS, Report, Scheme, remove_repeats

WINDOW = 50
GRAM = 20
#: Windows of a run that travels.
MOST = 1 << 16
_FIRST = 8


def _first_buckets(raw: np.ndarray, size: int) -> np.ndarray:
    """The first ``size`` bytes (8 at most) at each place as one number."""
    n = max(0, len(raw) - size + 1)
    out = np.zeros(n, np.uint64)
    for k in range(size):
        out = (out << np.uint64(8)) | raw[k : k + n].astype(np.uint64)
    return out


def _numbered(places: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sort places by their key: the places in order, their bucket from 0 on, and if they share it."""
    order = np.argsort(key)
    key = key[order]
    new = np.ones(len(order), bool)
    new[1:] = key[1:] != key[:-1]
    last = np.append(new[1:], True)[: len(new)]
    return places[order], np.cumsum(new) - 1, ~(new & last)


def refine(raw: np.ndarray, room: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Places whose next ``length`` bytes occur at another place, too, and their bucket.

    ``room`` has the bytes from each place to the end of its run; a place
    counts if it has room for ``length``.
    """
    have = min(_FIRST, length)
    gram = _first_buckets(raw, have)
    places = np.flatnonzero(room[: len(gram)] >= have)
    gram = gram[places]
    places, bucket, shared = _numbered(places, gram)
    del gram
    pointer = np.zeros(len(raw), np.int64)
    pointer[places] = bucket
    used = int(bucket[-1]) + 1 if len(bucket) else 1
    places, bucket = places[shared], bucket[shared]
    while have < length:
        step = min(have, length - have)
        fits = room[places] >= have + step
        places, bucket = places[fits], bucket[fits]
        # the places are in the order of their buckets, so these are numbered anew without sorting
        dense = np.zeros(len(bucket), np.int64)
        np.cumsum(bucket[1:] != bucket[:-1], out=dense[1:])
        places, bucket, shared = _numbered(places, dense * used + pointer[places + step])
        pointer[places] = bucket + used
        used += int(bucket[-1]) + 1 if len(bucket) else 0
        places, bucket = places[shared], bucket[shared]
        have += step
    fits = room[places] >= length
    return places[fits], bucket[fits]


def earlier_by_refinement(raw, begin, size, number, when, length) -> np.ndarray:
    """Which windows of a shard's runs also occur with a smaller ``when``.

    A run is ``size`` bytes from ``begin`` of ``raw`` and holds ``number`` windows.
    """
    room = np.zeros(len(raw), np.int64)
    inside = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
    room[np.repeat(begin, size) + inside] = np.repeat(size, size) - inside
    places, bucket = refine(raw, room, length)
    window = np.repeat(begin - np.cumsum(number) + number, number) + np.arange(int(number.sum()))
    which = np.full(len(raw), -1, np.int64)
    which[window] = np.arange(len(window))
    out = np.zeros(len(window), bool)
    if len(places):
        mine = when[which[places]]
        new = np.ones(len(bucket), bool)
        new[1:] = bucket[1:] != bucket[:-1]
        first = np.flatnonzero(new)
        least = np.repeat(np.minimum.reduceat(mine, first), np.diff(np.append(first, len(bucket))))
        out[which[places]] = least < mine
    return out


def _digest(n_units: int, n_removed: int, n_spans: int, kept: bytes) -> dict:
    return {
        "n_bytes": n_units,
        "n_removed": n_removed,
        "n_spans": n_spans,
        "kept_sha256": hashlib.sha256(kept).hexdigest(),
    }


def _bytes(n_units: int, n_removed: int, n_spans: int, kept: bytes) -> dict:
    return {"n_bytes": n_units, "n_removed": n_removed, "n_spans": n_spans, "kept": kept}


_COUNTS = [("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64())]
DIGEST = Report(
    "struct<n_bytes:bigint, n_removed:bigint, n_spans:bigint, kept_sha256:string>",
    pa.struct([*_COUNTS, ("kept_sha256", pa.string())]),
    _digest,
)
BYTES = Report(
    "struct<n_bytes:bigint, n_removed:bigint, n_spans:bigint, kept:binary>", pa.struct([*_COUNTS, ("kept", pa.binary())]), _bytes
)


def suffix_dedup(
    docs: DataFrame, report: Report = BYTES, window: int = WINDOW, gram: int = GRAM, hot_runs: int = HOT_RUNS
) -> DataFrame:
    """Remove the bytes covered by a string of ``window`` bytes that also starts in a document with a smaller ``doc_id``.

    Texts are UTF-8 bytes; matches never cross documents and are judged on the input.  Returns one row per
    input row: ``doc_id, n_bytes, n_removed, n_spans`` (removed stretches) and
    ``kept``, the bytes left (which may cut a character); with ``DIGEST`` their SHA-256.
    A null text is empty, a null id comes before all others, rows that share an id do not cover each other,
    other columns are ignored, an empty table gives an empty result.
    """
    return remove_repeats(docs, Scheme(False, window, gram, False, earlier_by_refinement, MOST), report, hot_runs)
