"""Find passages that repeat across documents, without comparing documents.

Every window of ``length`` units (words or bytes) is represented by its anchor,
the smallest hash among its runs of ``gram`` units.  Equal windows have equal anchors, and neighbouring
windows mostly share theirs, so a text falls into runs of windows with one
anchor each.

1. Anchors are counted: each batch sends its distinct anchors to hash buckets,
   packed, and documents hear which of theirs occur elsewhere, too.
2. Only those runs, with the text they cover, go to shards by anchor: all equal
   windows meet in one shard.  Equal runs of a batch travel once.
3. An index over each shard (given by the caller) tells the windows that occur
   earlier.  Shards are of a fixed size, their number follows the data.
4. Per document the covered units are removed.

An anchor with very many runs (a passage that countless documents share) is split: its
windows travel one by one and meet by the hash of the whole window.  Such
anchors are those over a millionth of all, so their list is bounded.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from textmill.llm.common import row_slices, share, shared, shuffle_partitions
from textmill.llm.hashing import gram_hashes, mix, row_words, span_hashes
from textmill.storage import materialize

#: Bytes of text per shard, and of text that a task works on at a time.
SHARD_BYTES = 3 << 20
_SLICE = 512 << 10
_FLUSH = 32 << 20
#: Runs of one anchor from which it is split, unless a millionth of all is more.
HOT_RUNS = 20_000
_HOT_SHARE = 1_000_000
#: Anchors travel as the 40 bits above these; the bucket tells some of the rest.
_KEY_SHIFT = np.uint64(24)
_NO_ID = -(1 << 63)


@dataclass(frozen=True)
class Scheme:
    """What a window is.  ``within``: windows that start earlier in the same document count, too; ``most``: windows
    of a run, longer ones are cut."""

    words: bool
    length: int
    gram: int
    within: bool
    index: Callable
    most: int

    def normal(self, text: str | None) -> bytes:
        raw = (text or "").encode()
        return b" ".join(raw.split()) if self.words else raw


@dataclass(frozen=True)
class Report:
    """How the result of one document is returned: a struct in Spark's and Arrow's words, and
    ``make(n_units, n_removed, n_spans, kept)``, which gives its fields."""

    schema: str
    kind: pa.DataType
    make: Callable


@dataclass
class Units:
    """The units of some rows laid end to end, with each unit's bytes and each row's units."""

    raw: np.ndarray
    values: np.ndarray
    begin: np.ndarray
    end: np.ndarray
    first: np.ndarray


def units(scheme: Scheme, texts: list[bytes]) -> Units:
    raw = np.frombuffer(b"".join(texts), np.uint8)
    bounds = np.concatenate(([0], np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)))))
    if not scheme.words:
        at = np.arange(len(raw) + 1)
        return Units(raw, raw, at[:-1], at[1:], bounds)
    begin, end, first = row_words(raw, bounds)
    return Units(raw, span_hashes(raw, begin, end), begin, end, first)


def runs(scheme: Scheme, u: Units) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start unit, number of windows and anchor of every run of windows with one anchor."""
    start, number, key, _ = _runs(scheme, u)
    return start, number, key


def _holds_twice(grams: np.ndarray, start: np.ndarray, reach: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Whether the anchor of a run is found more than once among the ``reach`` grams from its start."""
    order = np.argsort(grams, kind="stable")
    new = np.ones(len(order), bool)
    new[1:] = grams[order][1:] != grams[order][:-1]
    place = (np.cumsum(new) - 1) * len(grams) + order
    at = np.searchsorted(grams[order][new], key) * len(grams) + start
    return np.searchsorted(place, at + reach) - np.searchsorted(place, at) > 1


def _runs(scheme: Scheme, u: Units) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """As ``runs``, and the hashes of all grams."""
    length, width = scheme.length, scheme.length - scheme.gram + 1
    if len(u.values) < length:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    grams = least = gram_hashes(u.values, scheme.gram)
    have = 1
    while have < width:
        step = min(have, width - have)
        least = np.minimum(least[:-step], least[step:])
        have += step
    row_end = np.repeat(u.first[1:], np.diff(u.first))[: len(least)]
    valid = np.arange(len(least)) + length <= row_end
    new = valid.copy()
    new[1:] &= ~valid[:-1] | (least[1:] != least[:-1])
    start = np.flatnonzero(new)
    number = np.add.reduceat(valid.astype(np.int64), start) if len(start) else np.zeros(0, np.int64)
    return start, number, least[start], grams


# packing of arrays into one compressed value


def _pack(*arrays: np.ndarray) -> bytes:
    head = np.array([len(a) * a.itemsize for a in arrays], "<i8").tobytes()
    return zstandard.compress(head + b"".join(a.tobytes() for a in arrays), 1)


def _unpack(value: bytes, *kinds: str) -> list[np.ndarray]:
    raw = zstandard.decompress(value)
    sizes = np.frombuffer(raw, "<i8", len(kinds))
    at, out = 8 * len(kinds), []
    for kind, n in zip(kinds, sizes.tolist()):
        out.append(np.frombuffer(raw, kind, n // np.dtype(kind).itemsize, at))
        at += n
    return out


def _steps(x: np.ndarray) -> np.ndarray:
    return np.diff(x, prepend=x[:1] * 0)


def _short(keys: np.ndarray) -> np.ndarray:
    """The 40 bits of each anchor that travel, as five bytes."""
    return (keys >> _KEY_SHIFT).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5].reshape(-1)


def _long(five: np.ndarray) -> np.ndarray:
    out = np.zeros((len(five) // 5, 8), np.uint8)
    out[:, :5] = five.reshape(-1, 5)
    return out.view("<u8").reshape(-1)


def _groups(sorted_values: np.ndarray) -> np.ndarray:
    """First places of runs of equal values."""
    new = np.ones(len(sorted_values), bool)
    new[1:] = sorted_values[1:] != sorted_values[:-1]
    return np.flatnonzero(new)


def _batch(names: dict[str, tuple]) -> pa.RecordBatch:
    return pa.record_batch([pa.array(v, t) for v, t in names.values()], list(names))


# 1: anchors that occur more than once


def _count_anchors(scheme: Scheme, buckets: int):
    width = scheme.length - scheme.gram + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, keys, twice = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)], [np.zeros(0, bool)]
            did = batch.column(0).fill_null(_NO_ID).to_numpy(zero_copy_only=False)
            for a, b in row_slices(batch.column(1), _SLICE):
                texts = [scheme.normal(t) for t in batch.column(1).slice(a, b - a).to_pylist()]
                u = units(scheme, texts)
                start, number, key, grams = _runs(scheme, u)
                ids.append(did[a:b][np.searchsorted(u.first, start, "right") - 1])
                keys.append(key)
                some = np.zeros(len(key), bool)
                twice.append(_holds_twice(grams, start, number + width - 1, key) if scheme.within and len(key) else some)
            yield _anchor_rows(np.concatenate(ids), np.concatenate(keys), np.concatenate(twice), scheme, buckets)

    return run


def _anchor_rows(ids, keys, twice, scheme: Scheme, buckets: int) -> pa.RecordBatch:
    order = np.lexsort((ids, keys))
    ids, keys, twice = ids[order], keys[order], twice[order]
    if not scheme.within and len(ids):
        # copies inside one document do not count
        new = np.ones(len(ids), bool)
        new[1:] = (keys[1:] != keys[:-1]) | (ids[1:] != ids[:-1])
        ids, keys, twice = ids[new], keys[new], twice[new]
    first = _groups(keys)
    times = np.diff(np.append(first, len(keys)))
    number = times + (np.add.reduceat(twice, first) if len(first) else 0)
    known = np.repeat(number > 1, times)
    mark = (mix(keys) % np.uint64(buckets)).astype(np.int64)
    home = (mix(ids.view(np.uint64)) % np.uint64(buckets)).astype(np.int64)
    out_bucket, out_value = [], []
    some = first[np.argsort(mark[first], kind="stable")]
    count = np.minimum(number[np.argsort(mark[first], kind="stable")], 65_535).astype("<u2")
    mine = np.flatnonzero(known)
    mine = mine[np.lexsort((ids[mine], home[mine]))]
    lead, tail = mark[some], home[mine]
    for b in np.union1d(lead, tail).tolist():
        x = slice(*np.searchsorted(lead, [b, b + 1]))
        y = slice(*np.searchsorted(tail, [b, b + 1]))
        by_id = np.argsort(ids[some[x]], kind="stable")
        s, m = some[x][by_id], mine[y]
        out_bucket.append(b)
        out_value.append(_pack(_short(keys[s]), _steps(ids[s]), count[x][by_id], _short(keys[m]), _steps(ids[m])))
    return _batch({"bucket": (out_bucket, pa.int32()), "value": (out_value, pa.binary())})


def _answer(buckets: int, hot_runs: int):
    """Of one bucket: the documents' anchors that occur twice, and the hot anchors."""

    def run(bucket: pa.Table) -> pa.Table:
        parts = [_unpack(v, "u1", "<i8", "<u2", "u1", "<i8") for v in bucket["value"].to_pylist()]
        keys = np.concatenate([_long(p[0]) for p in parts])
        ids = np.concatenate([np.cumsum(p[1]) for p in parts])
        count = np.concatenate([p[2] for p in parts]).astype(np.int64)
        order = np.argsort(keys, kind="stable")
        keys, ids, count = keys[order], ids[order], count[order]
        first = _groups(keys)
        total = np.add.reduceat(count, first) if len(first) else np.zeros(0, np.int64)
        times = np.diff(np.append(first, len(keys)))
        least = max(hot_runs, int(count.sum()) * buckets // _HOT_SHARE)
        hot = keys[first[total > least]]
        told = np.repeat(total > 1, times) & (count == 1)
        ids = np.concatenate([ids[told], *(np.cumsum(p[4]) for p in parts)])
        keys = np.concatenate([keys[told], *(_long(p[3]) for p in parts)])
        order = np.argsort(ids, kind="stable")
        ids, five = ids[order], keys[order].astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5]
        cut = _groups(ids)
        ends = np.append(cut, len(ids))[1:]
        values = [five[a:b].tobytes() for a, b in zip(cut.tolist(), ends.tolist())]
        did, is_hot = ids[cut].tolist(), [False] * len(cut)
        if len(hot):
            did, is_hot = [*did, 0], [*is_hot, True]
            values.append(hot.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5].tobytes())
        return pa.table(
            {"did": pa.array(did, pa.int64()), "hot": pa.array(is_hot, pa.bool_()), "keys": pa.array(values, pa.binary())}
        )

    return run


# 2: documents that hold such anchors, and their runs


def _compress(scheme: Scheme):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in row_slices(batch.column(1), _SLICE):
                part = batch.slice(a, b - a)
                packed = [zstandard.compress(scheme.normal(t), 1) for t in part.column(1).to_pylist()]
                yield pa.record_batch(
                    [part.column(0), part.column(0).fill_null(_NO_ID), pa.array(packed, pa.binary())],
                    ["doc_id", "did", "packed"],
                )

    return run


def _result(scheme: Scheme, raw: bytes, spans: tuple[np.ndarray, np.ndarray] | None) -> tuple[int, int, int, bytes]:
    """Units, removed units, removed stretches and what is kept of one text."""
    if spans is None or not len(spans[0]):
        if not scheme.words:
            return len(raw), 0, 0, raw
        return len(raw.split()), 0, 0, raw
    u = units(scheme, [raw])
    n = len(u.values)
    start, number = spans
    change = np.bincount(start, minlength=n + 1) - np.bincount(start + number + scheme.length - 1, minlength=n + 1)
    gone = np.cumsum(change[:-1]) > 0
    stretches = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
    if scheme.words:
        kept = b" ".join([raw[a:b] for a, b in zip(u.begin[~gone].tolist(), u.end[~gone].tolist())])
    else:
        kept = u.raw[~gone].tobytes()
    return n, int(gone.sum()), stretches, kept


def _picked(scheme: Scheme, u: Units, keys: list[bytes | None]) -> tuple[np.ndarray, ...]:
    """Row, start, number and anchor of the runs whose anchor is among those of their document."""
    start, number, key = runs(scheme, u)
    row = np.searchsorted(u.first, start, "right") - 1
    # a document's number above the 40 bits of an anchor; a slice has far fewer documents than the rest can tell
    known = [_long(np.frombuffer(k, np.uint8)) | np.uint64(i << 40) for i, k in enumerate(keys) if k]
    mine = (row.astype(np.uint64) << np.uint64(40)) | (key >> _KEY_SHIFT)
    take = np.isin(mine, np.concatenate(known)) if known else np.zeros(len(start), bool)
    return row[take], start[take], number[take], key[take]


def _packed_runs(start: np.ndarray, number: np.ndarray, key: np.ndarray) -> bytes:
    """Runs of one document: the steps between their starts, their windows and anchors."""
    return key.astype("<u8").tobytes() + _steps(start).astype("<u4").tobytes() + number.astype("<u4").tobytes()


def _unpacked_runs(values: list[bytes], first: np.ndarray) -> tuple[np.ndarray, ...]:
    """Row, start, number and anchor of the runs of some rows, whose units begin at ``first``."""
    size = np.array([len(v) // 16 for v in values], np.int64)
    row = np.repeat(np.arange(len(values)), size)
    key = np.frombuffer(b"".join(v[: 8 * n] for v, n in zip(values, size.tolist())), "<u8")
    steps = np.frombuffer(b"".join(v[8 * n : 12 * n] for v, n in zip(values, size.tolist())), "<u4").astype(np.int64)
    number = np.frombuffer(b"".join(v[12 * n :] for v, n in zip(values, size.tolist())), "<u4").astype(np.int64)
    total = np.cumsum(steps)
    begin = np.cumsum(size) - size
    before = np.concatenate(([0], total))[begin]
    return row, total - np.repeat(before, size) + np.repeat(first[: len(values)], size), number, key.astype(np.uint64)


def _text_groups(texts: list[bytes], places: list[int]) -> Iterator[list[int]]:
    """The places in groups with about ``_SLICE`` bytes of text each."""
    group, held = [], 0
    for i in places:
        if group and held + len(texts[i]) > _SLICE:
            yield group
            group, held = [], 0
        group.append(i)
        held += len(texts[i])
    if group:
        yield group


def _settle(scheme: Scheme, report: Report):
    """Results of documents without repeated anchors; the others' texts, with their runs and the bytes of these."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc_id, did, twin, packed, keys = batch.columns
            texts = [zstandard.decompress(z) for z in packed.to_pylist()]
            load, picks = [0] * len(texts), [None] * len(texts)
            heard = keys.to_pylist()
            for part in _text_groups(texts, [i for i, k in enumerate(heard) if k]):
                u = units(scheme, [texts[i] for i in part])
                row, start, number, key = _picked(scheme, u, [heard[i] for i in part])
                size = u.end[start + number + scheme.length - 2] - u.begin[start]
                cuts = np.searchsorted(row, np.arange(len(part) + 1))
                for k, (i, x, y) in enumerate(zip(part, cuts[:-1].tolist(), cuts[1:].tolist())):
                    if y > x:
                        load[i] = int(size[x:y].sum())
                        picks[i] = _packed_runs(start[x:y] - u.first[k], number[x:y], key[x:y])
            rest = [z if p else None for z, p in zip(packed.to_pylist(), picks)]
            done = [None if p else report.make(*_result(scheme, t, None)) for t, p in zip(texts, picks)]
            yield pa.record_batch(
                [
                    doc_id,
                    did,
                    twin,
                    pa.array(rest, pa.binary()),
                    pa.array(picks, pa.binary()),
                    pa.array(load, pa.int64()),
                    pa.array(done, report.kind),
                ],
                ["doc_id", "did", "twin", "packed", "picks", "load", "done"],
            )

    return run


def _first_equal(raw: np.ndarray, begin, size, hashed, order_hi, order_lo) -> np.ndarray:
    """For each run the place of the first run with the same content, else its own."""
    same = np.arange(len(begin))
    if not len(begin):
        return same
    order = np.lexsort((order_lo, order_hi, size, hashed))
    new = np.ones(len(order), bool)
    new[1:] = (hashed[order][1:] != hashed[order][:-1]) | (size[order][1:] != size[order][:-1])
    lead = order[np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))]
    mine, theirs = order[~new], lead[~new]
    if len(mine):
        # equal hashes are compared byte by byte
        n = size[mine]
        cut = np.concatenate(([0], np.cumsum(n)[:-1]))
        inside = np.arange(int(n.sum())) - np.repeat(cut, n)
        differ = raw[np.repeat(begin[mine], n) + inside] != raw[np.repeat(begin[theirs], n) + inside]
        equal = np.add.reduceat(differ, cut) == 0
        same[mine[equal]] = theirs[equal]
    return same


def _emit_runs(scheme: Scheme, shards: int, hot_box):
    """Runs with their text, packed by shard; runs equal to an earlier one of the batch go without text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hot = shared(hot_box)
        held: list[tuple] = []
        size = 0
        for batch in batches:
            did = batch.column(0).to_numpy(zero_copy_only=False)
            twin = batch.column(1).to_numpy(zero_copy_only=False)
            for a, b in row_slices(batch.column(2), _SLICE // 3):
                texts = [zstandard.decompress(z) for z in batch.column(2).slice(a, b - a).to_pylist()]
                u = units(scheme, texts)
                row, start, number, key = _unpacked_runs(batch.column(3).slice(a, b - a).to_pylist(), u.first)
                split = np.isin(key >> _KEY_SHIFT, hot) if len(hot) else np.zeros(0, bool)
                if split.any():
                    n = np.where(split, number, 1)
                    within = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
                    row, start, key, split = (np.repeat(x, n) for x in (row, start, key, split))
                    start, number = start + within, np.where(split, 1, np.repeat(number, n))
                    whole = span_hashes(u.values, start, start + scheme.length)
                    key = np.where(split, mix(whole), key)
                # long runs are cut; the pieces keep their anchor, so equal windows still meet
                n = -(-number // scheme.most)
                if (n > 1).any():
                    piece = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
                    row, key, start, number = (np.repeat(x, n) for x in (row, key, start, number))
                    start, number = start + scheme.most * piece, np.minimum(number - scheme.most * piece, scheme.most)
                begin, end = u.begin[start], u.end[start + number + scheme.length - 2]
                hashed = span_hashes(u.raw, begin, end)
                own = slice(a, b)
                held.append(
                    (u.raw, begin, end - begin, hashed, did[own][row], twin[own][row], start - u.first[row], number, key)
                )
                size += len(u.raw)
                if size > _FLUSH:
                    yield _run_rows(scheme, held, shards)
                    held, size = [], 0
        if held:
            yield _run_rows(scheme, held, shards)

    return run


def _run_rows(scheme: Scheme, held: list[tuple], shards: int) -> pa.RecordBatch:
    shift = np.cumsum([0, *(len(h[0]) for h in held)])
    raw = np.concatenate([h[0] for h in held])
    begin = np.concatenate([h[1] + s for h, s in zip(held, shift)])
    size, hashed, did, twin, start, number, key = (np.concatenate([h[i] for h in held]) for i in range(2, 9))
    lead = _first_equal(raw, begin, size, hashed, did, start)
    # later in the order than an equal run: covered, whatever else there is
    done = (did[lead] < did) | (scheme.within & (did[lead] == did) & (start[lead] < start))
    at = np.where(done, mix(did.view(np.uint64)), mix(key)) % np.uint64(shards)
    order = np.lexsort((start, twin, did, at))
    at, size = at[order].astype(np.int64), np.where(done, 0, size)[order]
    begin, did, twin, start, number = (x[order] for x in (begin, did, twin, start, number))
    cut = _groups(at)
    ends = np.append(cut, len(at))[1:]
    values = []
    for a, b in zip(cut.tolist(), ends.tolist()):
        s = slice(a, b)
        inside = np.arange(int(size[s].sum())) - np.repeat(np.cumsum(size[s]) - size[s], size[s])
        text = raw[np.repeat(begin[s], size[s]) + inside]
        values.append(
            _pack(
                _steps(did[s]), twin[s].astype("<i4"), start[s].astype("<i4"), number[s].astype("<i4"), size[s].astype("<i4"), text
            )
        )
    return _batch({"shard": (at[cut], pa.int64()), "value": (values, pa.binary())})


# 3: the index of a shard


def _covered_runs(scheme: Scheme):
    """Of one shard: the windows that occur earlier, as runs."""

    def run(shard: pa.Table) -> pa.Table:
        parts = [_unpack(v, "<i8", "<i4", "<i4", "<i4", "<i4", "u1") for v in shard["value"].to_pylist()]
        did = np.concatenate([np.cumsum(p[0]) for p in parts])
        twin, start, number, size = (np.concatenate([p[i] for p in parts]).astype(np.int64) for i in range(1, 5))
        raw = np.concatenate([p[5] for p in parts])
        begin = np.cumsum(size) - size
        found = [(did[size == 0], twin[size == 0], start[size == 0], number[size == 0])]
        open_ = np.flatnonzero(size > 0)
        did, twin, start, number, size, begin = (x[open_] for x in (did, twin, start, number, size, begin))
        hashed = span_hashes(raw, begin, begin + size)
        lead = _first_equal(raw, begin, size, hashed, did, start)
        done = (did[lead] < did) | (scheme.within & (did[lead] == did) & (start[lead] < start))
        found.append((did[done], twin[done], start[done], number[done]))
        left = ~done
        did, twin, start, number, size, begin = (x[left] for x in (did, twin, start, number, size, begin))
        if len(did):
            rank = np.unique(did, return_inverse=True)[1]
            seg = np.repeat(np.arange(len(did)), number)
            inside = np.arange(len(seg)) - np.repeat(np.cumsum(number) - number, number)
            place = start[seg] + inside
            del inside
            # windows in the order in which an earlier one covers a later one
            when = (rank[seg].astype(np.int64) << 32) + (place if scheme.within else 0)
            hit = scheme.index(raw, begin, size, number, when, scheme.length)
            new = hit.copy()
            new[1:] &= ~hit[:-1] | (seg[1:] != seg[:-1])
            first = np.flatnonzero(new)
            count = np.add.reduceat(hit.astype(np.int64), first) if len(first) else np.zeros(0, np.int64)
            found.append((did[seg[first]], twin[seg[first]], place[first], count))
        did, twin, start, number = (np.concatenate([f[i] for f in found]) for i in range(4))
        return pa.table(
            {
                "did": pa.array(did, pa.int64()),
                "twin": pa.array(twin, pa.int32()),
                "start": pa.array(start, pa.int32()),
                "number": pa.array(number, pa.int32()),
            }
        )

    return run


# 4: all together


def remove_repeats(docs: DataFrame, scheme: Scheme, report: Report, hot_runs: int = HOT_RUNS) -> DataFrame:
    """Remove from every document the units covered by windows that occur earlier.

    Returns ``doc_id`` and the fields of ``report``, one row per input row.  Windows are judged on the input; a null text is empty; a null id comes
    before all others; rows that share an id are equally early; other columns are ignored.
    """
    spark = docs.sparkSession
    buckets = 4 * shuffle_partitions(spark)
    source = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    marks = source.mapInArrow(_count_anchors(scheme, buckets), "bucket int, value binary")
    told = materialize(
        marks.groupBy("bucket").applyInArrow(_answer(buckets, hot_runs), "did bigint, hot boolean, keys binary"), "anchors"
    )
    # at most a million anchors can each hold a millionth of all
    hot = [_long(np.frombuffer(r["keys"], np.uint8)) for r in told.where("hot").select("keys").collect()]
    hot_box = share(spark, np.concatenate(hot) if hot else np.zeros(0, np.uint64))

    heard = told.where("not hot").groupBy("did").agg(F.array_join(F.collect_list(F.hex("keys")), "").alias("keys"))
    heard = heard.select("did", F.unhex("keys").alias("keys"))
    packed = source.mapInArrow(_compress(scheme), "doc_id bigint, did bigint, packed binary")
    # rows that share an id are told apart by a small number
    same_id = Window.partitionBy("did").orderBy(F.xxhash64("packed"))
    joined = packed.join(heard, "did", "left").withColumn("twin", F.row_number().over(same_id) - 1)
    table = materialize(
        joined.select("doc_id", "did", "twin", "packed", "keys").mapInArrow(
            _settle(scheme, report),
            f"doc_id bigint, did bigint, twin int, packed binary, picks binary, load bigint, done {report.schema}",
        ),
        "texts",
    )
    load = table.agg(F.coalesce(F.sum("load"), F.lit(0))).first()[0]
    shards = max(1, math.ceil(load / SHARD_BYTES))

    open_rows = table.where("packed is not null")
    runs_out = open_rows.select("did", "twin", "packed", "picks").mapInArrow(
        _emit_runs(scheme, shards, hot_box), "shard bigint, value binary"
    )
    spans = (
        runs_out.groupBy("shard")
        .applyInArrow(_covered_runs(scheme), "did bigint, twin int, start int, number int")
        .groupBy("did", "twin")
        .agg(F.collect_list(F.struct("start", "number")).alias("spans"))
    )
    cut = open_rows.select("doc_id", "did", "twin", "packed").join(spans, ["did", "twin"], "left")
    finished = cut.select("doc_id", "packed", "spans").mapInArrow(_finish(scheme, report), f"doc_id bigint, done {report.schema}")
    return table.where("packed is null").select("doc_id", "done").unionByName(finished).select("doc_id", "done.*")


def _finish(scheme: Scheme, report: Report):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done = []
            lists = batch.column(2)
            size = lists.value_lengths().fill_null(0).to_numpy()
            flat = lists.flatten()
            start, number = (flat.field(c).to_numpy().astype(np.int64) for c in ("start", "number"))
            ends = np.cumsum(size)
            for z, a, b in zip(batch.column(1).to_pylist(), (ends - size).tolist(), ends.tolist()):
                done.append(report.make(*_result(scheme, zstandard.decompress(z), (start[a:b], number[a:b]))))
            yield pa.record_batch([batch.column(0), pa.array(done, report.kind)], ["doc_id", "done"])

    return run
