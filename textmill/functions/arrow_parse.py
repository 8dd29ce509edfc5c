"""Printed trees and dependencies back as arrays, by the places of their bytes in a whole Arrow array.

Brackets, blanks and digits are single bytes in UTF-8 that are part of no other character.
"""

from __future__ import annotations

import re
import sys

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F

# workers may not have this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

EDGE = r"([A-Za-z:_]+)\(([^ \n]+)-([0-9]+), ([^ \n]+)-([0-9]+)\)"
EDGES = "array<struct<rel:string,head:string,dep:string>>"


def _bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts, and where each begins and the last ends; a null has none."""
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    texts = pc.fill_null(texts, "")
    ends = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    data = texts.buffers()[2]
    return np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8), ends


def _among(chars: str) -> np.ndarray:
    table = np.zeros(256, bool)
    table[np.frombuffer(chars.encode(), np.uint8)] = True
    return table


def _strings(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, mask: np.ndarray | None = None) -> pa.Array:
    """The texts between ``starts`` and ``ends``, which follow one another."""
    inside = np.zeros(len(data) + 1, np.int8)
    sizes = ends - starts
    some = sizes > 0
    np.add.at(inside, starts[some], 1)
    np.add.at(inside, ends[some], -1)
    kept = data[np.cumsum(inside[:-1], dtype=np.int8).view(bool)] if len(data) else data
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    out = pa.StringArray.from_buffers(len(sizes), pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(kept)))
    return out if mask is None else pc.if_else(pa.array(mask), pa.scalar(None, pa.string()), out)


def _last_before(places: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The last of ``places`` before each of ``at``, -1 for none."""
    found = np.searchsorted(places, at) - 1
    return np.where(found >= 0, places[np.maximum(found, 0)], -1) if len(places) else np.full(len(at), -1)


def printed_edges(texts: pa.Array) -> pa.Array:
    """The ``(rel, head, dep)`` of the lines ``rel(head-i, dep-j)`` of each text."""
    lines = pc.split_pattern(pc.fill_null(texts, ""), "\n")
    data, ends = _bytes(lines.values)
    start, end = ends[:-1], ends[1:]
    size = end - start
    blanks = np.flatnonzero(data == 32)
    at = np.searchsorted(blanks, start)
    blank = np.append(blanks, len(data))[at]
    one = np.searchsorted(blanks, end) - at == 1
    other = np.flatnonzero(~_among("0123456789")[data])
    name_end = np.append(np.flatnonzero(~_among("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz:_")[data]), len(data))
    bracket = name_end[np.searchsorted(name_end, start)]
    padded = np.append(data, 0)
    dash1, dash2 = _last_before(other, blank - 1), _last_before(other, end - 1)
    plain = (
        one & (size > 8) & (padded[blank - 1] == 44) & (padded[end - 1] == 41) & (bracket > start) & (bracket < blank)
        & (padded[bracket] == 40) & (padded[dash1] == 45) & (padded[dash2] == 45) & (dash1 > bracket + 1) & (dash1 < blank - 2)
        & (dash2 > blank + 1) & (dash2 < end - 2)
    )
    at, odd = np.flatnonzero(plain), np.flatnonzero(~plain & (size > 0))
    rel = _strings(data, start[at], bracket[at])
    head = _strings(data, bracket[at] + 1, dash1[at])
    dep = _strings(data, blank[at] + 1, dash2[at])
    extra, places = [], []
    for i in odd.tolist():
        marked = re.sub(EDGE, "\\1\t\\2\t\\4", bytes(data[start[i] : end[i]]).decode())
        if "\t" in marked:
            extra.append((marked.split("\t") + [None])[:3])
            places.append(i)
    if extra:
        rel, head, dep = (pa.concat_arrays([a, pa.array(b, pa.string())]) for a, b in zip((rel, head, dep), zip(*extra)))
        order = np.argsort(np.concatenate([at, places]), kind="stable")
        at = np.concatenate([at, places])[order]
        rel, head, dep = (a.take(pa.array(order)) for a in (rel, head, dep))
    offsets = np.searchsorted(at, lines.offsets.to_numpy()).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.StructArray.from_arrays([rel, head, dep], ["rel", "head", "dep"]))


def edges(printed: Column) -> Column:
    def run(texts: pa.Array) -> pa.Array:
        return printed_edges(texts)

    run.__annotations__ = {"texts": pa.Array, "return": pa.Array}
    return F.arrow_udf(run, EDGES)(printed)


def _by_stack(tree: str) -> list[tuple]:
    """The closed nodes of one tree, also of one whose brackets do not fit: ``(node, parent, depth, label, word, start, end)``."""
    pieces = re.findall(r"\(|\)|[^() \t\n\x0b\f\r]+", tree)
    stack, out, nodes, words = [], [], 0, 0
    for i, p in enumerate(pieces):
        if p == "(":
            following = pieces[i + 1] if i + 1 < len(pieces) else ""
            stack.append([nodes, stack[-1][0] if stack else None, len(stack), "" if following in ("(", ")") else following, None, words])
            nodes += 1
        elif p == ")":
            if stack:
                out.append((*stack.pop(), words))
        elif stack and pieces[i - 1] != "(":
            stack[-1][4] = p if stack[-1][4] is None else stack[-1][4]
            words += 1
    return sorted(out, key=lambda x: x[0])


NODE = ("node", "parent", "depth", "label", "word", "start", "end")


def tree_table(texts: pa.Array) -> tuple[np.ndarray, list[pa.Array]]:
    """The row of each node and the columns ``NODE``, as ``spans.tree_nodes`` has them."""
    data, ends = _bytes(texts)
    n = len(texts)
    is_open, is_close = data == 40, data == 41
    wordy = ~_among("() \t\n\x0b\f\r")[data]
    begins = wordy.copy()
    begins[1:] &= ~wordy[:-1]
    inner = ends[(ends > 0) & (ends < len(data))]
    begins[inner] |= wordy[inner]
    stops = wordy.copy()
    stops[:-1] &= ~wordy[1:]
    stops[inner - 1] |= wordy[inner - 1]
    pieces = np.flatnonzero(is_open | is_close | begins)
    pieces = pieces[(pieces >= ends[0]) & (pieces < ends[-1])]
    opens, closes = is_open[pieces], is_close[pieces]
    row = np.searchsorted(ends, pieces, "right") - 1
    first = np.searchsorted(row, np.arange(n + 1))
    step = np.cumsum(opens.astype(np.int64) - closes)
    before = np.concatenate([[0], step])[first[:-1]]
    depth = step - before[row]
    whole = np.ones(n, bool)
    whole[row[depth < 0]] = False
    some = first[1:] > first[:-1]
    whole[some] &= depth[first[1:][some] - 1] == 0
    # a row whose brackets do not fit is read by itself
    keep = whole[row]
    pieces, opens, closes, row, depth = (a[keep] for a in (pieces, opens, closes, row, depth))
    count = len(pieces)
    word = ~opens & ~closes
    after_open = np.zeros(count, bool)
    after_open[1:] = opens[:-1] & (row[1:] == row[:-1])
    leaf = word & ~after_open & (depth > 0)
    words = np.cumsum(leaf)
    o, c = np.flatnonzero(opens), np.flatnonzero(closes)
    # brackets of one row and depth open and close in turn
    deep = int(depth.max()) + 2 if count else 1
    o_key, c_key = row[o] * deep + depth[o] - 1, row[c] * deep + depth[c]
    o_order, c_order = np.argsort(o_key, kind="stable"), np.argsort(c_key, kind="stable")
    closing = np.empty(len(o), np.int64)
    closing[o_order] = c[c_order]
    node_row = row[o]
    rank = np.arange(len(o))
    per_row = np.searchsorted(node_row, np.arange(n + 1))
    number = rank - per_row[node_row]
    # the last bracket that opened one level up; within a row and level places ascend
    level = o_key[o_order] * (count + 1) + o[o_order]

    def above(at: np.ndarray, rows: np.ndarray, depths: np.ndarray) -> np.ndarray:
        return o_order[np.searchsorted(level, (rows * deep + depths) * (count + 1) + at) - 1]

    d = depth[o] - 1
    parent = np.zeros(len(o), np.int64)
    low = d > 0
    parent[low] = number[above(o[low], node_row[low], d[low] - 1)]
    at = np.flatnonzero(leaf)
    holder = above(at, row[at], depth[at] - 1)
    word_of = np.full(len(o), -1, np.int64)
    word_of[holder[::-1]] = at[::-1]
    word_ends = np.append(np.flatnonzero(stops) + 1, len(data))
    piece_end = word_ends[np.searchsorted(word_ends, pieces, "right")] if count else pieces

    def text_of(which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        found = which >= 0
        # what is absent is an empty piece at the place of its node
        begin = np.where(found, pieces[np.maximum(which, 0)], pieces[o])
        return begin, np.where(found, piece_end[np.maximum(which, 0)], begin)

    following = o + 1
    label = np.where(word[np.minimum(following, max(count - 1, 0))], following, -1) if count else following
    label_text = _strings(data, *text_of(label))
    # words of nodes in the order of the nodes are not in the order of the text where a node has words behind other nodes
    begin, end = text_of(word_of)
    order = np.argsort(begin, kind="stable")
    back = np.empty(len(order), np.int64)
    back[order] = np.arange(len(order))
    word_text = pc.if_else(pa.array(word_of < 0), pa.scalar(None, pa.string()), _strings(data, begin[order], end[order]).take(pa.array(back)))
    columns = [
        pa.array(number.astype(np.int32)), pa.array(parent.astype(np.int32), mask=~low), pa.array(d.astype(np.int32)), label_text, word_text,
        pa.array((words[o] if count else o).astype(np.int32)), pa.array((words[closing] if count else o).astype(np.int32)),
    ]
    if count:
        # words are counted within the row
        base = np.concatenate([[0], words])[np.searchsorted(row, np.arange(n))][node_row]
        columns[5:] = [pa.array((words[x] - base).astype(np.int32)) for x in (o, closing)]
    odd = np.flatnonzero(~whole)
    if len(odd):
        rows = [(i, *x) for i in odd.tolist() for x in _by_stack(bytes(data[ends[i] : ends[i + 1]]).decode())]
        if rows:
            kinds = [c.type for c in columns]
            node_row = np.concatenate([node_row, [r[0] for r in rows]])
            columns = [pa.concat_arrays([c, pa.array([r[k + 1] for r in rows], kinds[k])]) for k, c in enumerate(columns)]
            order = np.argsort(node_row, kind="stable")
            node_row, columns = node_row[order], [c.take(pa.array(order)) for c in columns]
    return node_row, columns
