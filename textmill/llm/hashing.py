"""Rolling hashes of byte and word sequences in numpy."""

from __future__ import annotations

import numpy as np

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit numbers evenly (an invertible finisher)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    if n:
        out[0] = 1
    return np.multiply.accumulate(out) if n else out


def span_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of ``values[start:end]`` for every span; equal spans, equal hashes."""
    n = len(values) + 1
    sums = np.zeros(n, np.uint64)
    np.cumsum((values.astype(np.uint64) + np.uint64(1)) * _powers(_BASE, n - 1), out=sums[1:])
    return mix((sums[ends] - sums[starts]) * _powers(_INVERSE, n)[starts] + (ends - starts).astype(np.uint64))


def gram_hashes(values: np.ndarray, size: int) -> np.ndarray:
    """A 64-bit hash of every run of ``size`` values."""
    n = max(0, len(values) - size + 1)
    out = np.zeros(n, np.uint64)
    have, block, weight = 0, values.astype(np.uint64) + np.uint64(1), _BASE
    width, factor = 1, 1
    # Horner's rule over blocks whose width doubles
    while size >> (width.bit_length() - 1):
        if size & width:
            out = out + block[have : have + n] * np.uint64(factor)
            factor = factor * weight % (1 << 64)
            have += width
        if width * 2 > size:
            break
        block = block[: len(block) - width] + block[width:] * np.uint64(weight)
        weight = weight * weight % (1 << 64)
        width *= 2
    return mix(out)


def word_spans(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of bytes that are not blank."""
    solid = np.concatenate(([False], ~_BLANK[raw], [False]))
    edges = np.flatnonzero(solid[1:] != solid[:-1])
    return edges[::2], edges[1::2]


def row_words(raw: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word starts and ends of all rows of a batch, and the first word of each row.

    ``bounds`` cuts ``raw`` into rows; words never cross rows.
    """
    solid = ~_BLANK[raw]
    before = np.concatenate(([False], solid[:-1]))[: len(raw)]
    cut = np.zeros(len(raw) + 1, bool)
    cut[bounds] = True
    starts = np.flatnonzero(solid & (~before | cut[:-1]))
    after = np.concatenate((solid[1:], [False]))[: len(raw)]
    ends = np.flatnonzero(solid & (~after | cut[1:])) + 1
    return starts, ends, np.searchsorted(starts, bounds)
