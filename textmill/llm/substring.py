"""Substring dedup with a compressed FM-index per shard.

The index of a shard holds the Burrows-Wheeler transform of its runs as a
wavelet matrix of packed bits.  The runs are streamed through it from right to left,
all at a time: a backward step extends every match by one word, and as soon as a match is longer than the
threshold, its interval is widened to that of the threshold (its parent).  A match of the threshold's
length is reported with its interval, and the interval's first occurrence tells
whether the window occurs earlier.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from textmill.llm.hashing import span_hashes, word_spans
from textmill.llm.passages import HOT_RUNS, Report, Scheme, remove_repeats

WINDOW = 20
GRAM = 6
#: Windows of a run that travels: the runs of a shard are streamed together, one step for each word of the longest.
MOST = 128


class BitVector:
    """Packed bits with the number of ones before every word of 64."""

    def __init__(self, bits: np.ndarray):
        n = len(bits)
        padded = np.zeros((n // 64 + 1) * 64, np.uint8)
        padded[:n] = bits
        self.words = np.packbits(padded, bitorder="little").view("<u8")
        self.before = np.concatenate(([0], np.cumsum(np.bitwise_count(self.words), dtype=np.int64)))[:-1].astype(np.int32)
        self.zeros = n - int(bits.sum())

    def ones(self, place: np.ndarray) -> np.ndarray:
        """Ones before each place."""
        word = place >> 6
        low = (np.uint64(1) << (place & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & low)


class FMIndex:
    """Over texts of numbers from 1 on, each ended by a 0.

    Suffixes are sorted by their first ``depth`` numbers or more, which is all
    that patterns of that length need.
    """

    def __init__(self, text: np.ndarray, depth: int):
        n = len(text)
        rank, have = text.astype(np.int64), 1
        while True:
            following = np.zeros(n, np.int64)
            following[: max(0, n - have)] = rank[have:] + 1
            self.suffix = np.argsort(rank * (n + int(rank.max(initial=0)) + 2) + following, kind="stable")
            a, b = rank[self.suffix], following[self.suffix]
            new = np.ones(n, bool)
            new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
            order = np.cumsum(new) - 1
            rank = np.empty(n, np.int64)
            rank[self.suffix] = order
            have *= 2
            if have >= depth or (n and order[-1] == n - 1):
                break
        self.text = text
        symbols = int(text.max(initial=0)) + 1
        self.count = np.concatenate(([0], np.cumsum(np.bincount(text, minlength=symbols))))[:-1]
        sequence = text[self.suffix - 1]
        self.levels: list[BitVector] = []
        self.shifts = list(range(max(1, (symbols - 1).bit_length()) - 1, -1, -1))
        for shift in self.shifts:
            bit = (sequence >> shift) & 1
            self.levels.append(BitVector(bit))
            sequence = np.concatenate((sequence[bit == 0], sequence[bit == 1]))
        every = np.arange(symbols)
        self.base = self.count - self._down(np.zeros(symbols, np.int64), every)

    def _down(self, place: np.ndarray, symbol: np.ndarray) -> np.ndarray:
        """Follow places in the transform through the levels of the wavelet matrix."""
        for shift, level in zip(self.shifts, self.levels):
            ones = level.ones(place)
            place = np.where((symbol >> shift) & 1 == 1, level.zeros + ones, place - ones)
        return place

    def extend(self, place: np.ndarray, symbol: np.ndarray) -> np.ndarray:
        """Bounds of the matches with ``symbol`` put before them."""
        return self.base[symbol] + self._down(place, symbol)

    def parents(self, length: int) -> tuple[np.ndarray, np.ndarray]:
        """Per row of the sorted suffixes: the interval of those that share its first ``length`` numbers."""
        n = len(self.text)
        same = np.ones(max(0, n - 1), bool)
        padded = np.concatenate((self.text, np.full(length, -1, self.text.dtype)))
        for k in range(length):
            symbol = padded[self.suffix + k]
            same &= symbol[1:] == symbol[:-1]
        first = np.flatnonzero(np.concatenate(([True], ~same)))
        size = np.diff(np.append(first, n))
        return np.repeat(first, size), np.repeat(first + size, size)


def matching_intervals(index: FMIndex, begin: np.ndarray, size: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Stream the index's own texts backwards through it.

    Per place of the text: the interval of the suffixes that share the next
    ``length`` numbers, empty where the text ends before.
    """
    low_parent, high_parent = index.parents(length)
    out_low = np.zeros(len(index.text), np.int64)
    out_high = np.zeros(len(index.text), np.int64)
    order = np.argsort(-size, kind="stable")
    begin, size = begin[order], size[order]
    low, high = np.zeros(len(begin), np.int64), np.full(len(begin), len(index.text))
    for step in range(int(size.max(initial=0))):
        live = int(np.searchsorted(-size, -step, "left"))
        low, high = low[:live], high[:live]
        at = begin[:live] + size[:live] - 1 - step
        symbol = index.text[at]
        low, high = index.extend(low, symbol), index.extend(high, symbol)
        if step >= length:
            low, high = low_parent[low], high_parent[low]
        if step >= length - 1:
            out_low[at], out_high[at] = low, high
    return out_low, out_high


def word_codes(raw: np.ndarray, begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The words of all runs as numbers from 1 on, equal words by equal numbers, a 0 after each run."""
    # runs end to end with a blank between them, so that no two words touch
    inside = np.arange(int(size.sum()) + len(size)) - np.repeat(np.cumsum(size + 1) - size - 1, size + 1)
    last = np.repeat(size, size + 1) == inside
    line = np.where(last, 32, raw[np.minimum(np.repeat(begin, size + 1) + inside, max(0, len(raw) - 1))]).astype(np.uint8)
    start, end = word_spans(line)
    hashed = span_hashes(line, start, end)
    width = end - start
    order = np.lexsort((width, hashed))
    new = np.ones(len(order), bool)
    new[1:] = (hashed[order][1:] != hashed[order][:-1]) | (width[order][1:] != width[order][:-1])
    lead = order[np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))]
    # equal hashes are compared byte by byte
    n = width[order]
    cut = np.cumsum(n) - n
    at = np.arange(int(n.sum())) - np.repeat(cut, n)
    differ = line[np.repeat(start[order], n) + at] != line[np.repeat(start[lead], n) + at]
    if differ.any():
        known: dict[bytes, int] = {}
        numbers = np.array([known.setdefault(line[a:b].tobytes(), len(known) + 1) for a, b in zip(start, end)], np.int64)
    else:
        numbers = np.empty(len(order), np.int64)
        numbers[order] = np.cumsum(new)
    run = np.searchsorted(np.cumsum(size + 1), start, "right")
    out = np.zeros(len(start) + len(size), np.int64)
    out[np.arange(len(start)) + run] = numbers
    return out


def earlier_by_fm_index(raw, begin, size, number, when, length) -> np.ndarray:
    """Which windows of a shard's runs also occur with a smaller ``when``.

    A run is ``size`` bytes from ``begin`` of ``raw``, words joined by blanks,
    and holds ``number`` windows.
    """
    words = number + length - 1
    first = np.cumsum(words + 1) - words - 1
    index = FMIndex(word_codes(raw, begin, size), length + 1)
    low, high = matching_intervals(index, first, words, length)
    window = np.repeat(first - np.cumsum(number) + number, number) + np.arange(int(number.sum()))
    order = np.full(len(index.text), np.iinfo(np.int64).max)
    order[window] = when
    heads = np.unique(low[window])
    # the intervals of all windows are apart from each other and sorted by their lower bound
    least = np.minimum.reduceat(order[index.suffix], heads)
    return least[np.searchsorted(heads, low[window])] < when


def _digest(n_units: int, n_removed: int, n_spans: int, kept: bytes) -> dict:
    return {"n_words": n_units, "n_removed": n_removed, "kept_sha256": hashlib.sha256(kept).hexdigest()}


def _text(n_units: int, n_removed: int, n_spans: int, kept: bytes) -> dict:
    return {"n_words": n_units, "n_removed": n_removed, "n_spans": n_spans, "kept": kept.decode()}


DIGEST = Report(
    "struct<n_words:bigint, n_removed:bigint, kept_sha256:string>",
    pa.struct([("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string())]),
    _digest,
)
TEXT = Report(
    "struct<n_words:bigint, n_removed:bigint, n_spans:bigint, kept:string>",
    pa.struct([("n_words", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept", pa.string())]),
    _text,
)


def substring_dedup(
    docs: DataFrame, report: Report = TEXT, window: int = WINDOW, gram: int = GRAM, hot_runs: int = HOT_RUNS
) -> DataFrame:
    """Remove the words covered by a window of ``window`` words that starts earlier, too
    (in a smaller ``doc_id``, or before in the same document).

    Words are runs of other characters than blanks, unchanged; windows are judged on the input.
    Returns one row per input row: ``doc_id, n_words, n_removed, n_spans`` (removed
    stretches) and ``kept``, the words left, joined by one blank; with ``DIGEST`` its SHA-256.
    A null text has no words, a null id comes before all others, windows of rows that share an id are ordered by
    their place alone (so equal rows keep their words), other columns are ignored, an empty
    table gives an empty result.
    """
    return remove_repeats(docs, Scheme(True, window, gram, True, earlier_by_fm_index, MOST), report, hot_runs)
