"""The expressions of ``text`` over whole Arrow arrays.

Lambdas over arrays are interpreted token by token.  These functions look at each different token of a batch
once and print with Arrow's own kernels, so a token costs little.  They take the tokens of sentences (tagged by form here)
or ``(tok, tag)`` pairs, for one sentence a row or for an array of sentences a row.  The values equal those of ``text``, but for
letters that came into Unicode between the tables of Java and Python.
"""

from __future__ import annotations

import sys
import unicodedata
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F

from textmill.constants import CLOSED_CLASS, SHALLOW_RELATIONS, SUFFIX_TAGS

# workers may not have this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

CLOSED = {word: name for name, words in reversed(CLOSED_CLASS.items()) for word in words}
TAGGED = "array<struct<tok:string,tag:string>>"


def tag_by_form(token: str) -> str:
    """``text.tag`` of one token."""
    low, first = token.lower(), token[:1]
    if token in (".", "!", "?"):
        return "."
    if token in (",", ";", ":"):
        return token
    if low in CLOSED:
        return CLOSED[low]
    if not first or unicodedata.category(first)[0] not in "LN":
        return "SYM"
    if token.isascii() and token.isdigit():
        return "CD"
    if first != low[:1]:
        return "NNP"
    return next((name for suffix, name in SUFFIX_TAGS if low.endswith(suffix)), "NN")


def relation_of(tag: str) -> str:
    """``text.relation`` of one tag."""
    if tag in (".", ",", ";", ":", "SYM"):
        return SHALLOW_RELATIONS["PUNCT"]
    return SHALLOW_RELATIONS.get(tag, "dep") if tag != "PUNCT" else "dep"


def each_once(values: pa.Array, fn: Callable, kind: pa.DataType | None = None) -> pa.Array:
    """``fn`` of every value, worked out once for each different one."""
    coded = values.dictionary_encode()
    return pa.array([fn(v) for v in coded.dictionary.to_pylist()], kind or pa.string()).take(coded.indices)


def offsets(lists: pa.Array) -> pa.Array:
    """Where the items of each list begin; an array without lists may come without offsets."""
    return lists.offsets if len(lists) else pa.array([0], pa.int32())


def around(lists: pa.Array, values: pa.Array) -> pa.Array:
    """``values`` in the places of the items of ``lists``."""
    return pa.ListArray.from_arrays(offsets(lists), values, mask=lists.is_null() if lists.null_count else None)


def by_sentence(nested: pa.Array, fn: Callable[[pa.Array], pa.Array]) -> pa.Array:
    """``fn`` of the sentences, which stand in the rows or in arrays of the rows."""
    inner = nested.values
    return around(nested, fn(inner)) if pa.types.is_list(inner.type) else fn(nested)


def parts(items: pa.Array) -> tuple[pa.Array, pa.Array]:
    """Tokens and tags of ``(tok, tag)`` pairs, or of plain tokens by their form."""
    if pa.types.is_struct(items.type):
        return items.field(items.type.get_field_index("tok")), items.field(items.type.get_field_index("tag"))
    return items, each_once(items, tag_by_form)


def joined(*columns) -> pa.Array:
    return pc.binary_join_element_wise(*columns, "")


def pos_lines(sentences: pa.Array) -> pa.Array:
    tok, tag = parts(sentences.values)
    return pc.binary_join(around(sentences, joined(tok, "/", tag, " ")), "")


def trees(sentences: pa.Array) -> pa.Array:
    tok, tag = parts(sentences.values)
    word = pc.if_else(pc.equal(tok, "("), "-LRB-", pc.if_else(pc.equal(tok, ")"), "-RRB-", tok))
    return joined("(ROOT (S ", pc.binary_join(around(sentences, joined("(", tag, " ", word, ")")), " "), "))")


def dependencies(sentences: pa.Array) -> pa.Array:
    tok, tag = parts(sentences.values)
    ends = offsets(sentences).to_numpy().astype(np.int64)
    sizes = np.diff(ends)
    place = np.zeros(len(tok), np.int64)
    place[ends[0] : ends[-1]] = np.arange(ends[-1] - ends[0]) - np.repeat(ends[:-1] - ends[0], sizes)
    last = np.zeros(len(tok), bool)
    last[(ends[1:] - 1)[sizes > 0]] = True
    following = tok.take(pa.array(np.minimum(np.arange(1, len(tok) + 1), max(len(tok) - 1, 0))))
    right = joined(following, "-", pa.array(place + 2).cast(pa.string()))
    name = pc.if_else(pa.array(last), "root", each_once(tag, relation_of))
    head = pc.if_else(pa.array(last), "ROOT-0", right)
    lines = joined(name, "(", head, ", ", tok, "-", pa.array(place + 1).cast(pa.string()), ")")
    return pc.binary_join(around(sentences, lines), "\n")


def tag_pairs(sentences: pa.Array) -> pa.Array:
    """The neighbouring tags of all sentences of a row (an array of sentences), one after the other."""
    inner = sentences.values
    _, tag = parts(inner.values)
    ends = offsets(inner).to_numpy().astype(np.int64)
    starts = np.zeros(len(tag) + 1, bool)
    starts[ends] = True
    inside = np.zeros(len(tag), bool)
    inside[ends[0] : ends[-1]] = True
    second = np.flatnonzero(inside & ~starts[:-1])
    pairs = pa.StructArray.from_arrays([tag.take(pa.array(second - 1)), tag.take(pa.array(second))], ["a", "b"])
    before = np.concatenate([[0], np.cumsum(inside & ~starts[:-1])])
    rows = before[ends[offsets(sentences).to_numpy()]]
    return pa.ListArray.from_arrays(pa.array(rows.astype(np.int32)), pairs)


def _udf(fn: Callable[[pa.Array], pa.Array], kind: str) -> Callable[[Column], Column]:
    def run(values: pa.Array) -> pa.Array:
        return fn(values)

    # the wrapped function keeps these hints, by which Spark tells the kind of function
    run.__annotations__ = {"values": pa.Array, "return": pa.Array}
    return F.arrow_udf(run, kind)


def tagged_array(tokens: Column) -> Column:
    """``text.tagged_array`` of a column, not for use in a lambda."""

    def pairs(lists: pa.Array) -> pa.Array:
        return around(lists, pa.StructArray.from_arrays(parts(lists.values), ["tok", "tag"]))

    return _udf(pairs, TAGGED)(tokens)


def shallow_tree(tokens: Column) -> Column:
    return _udf(trees, "string")(tokens)


def dependency_block(tokens: Column) -> Column:
    return _udf(dependencies, "string")(tokens)


def neighbouring_tags(sentences: Column) -> Column:
    """Array of ``(a, b)``: the neighbours inside each of the sentences of a row."""
    return _udf(tag_pairs, "array<struct<a:string,b:string>>")(sentences)


def body(sentences: Column, method: Column, max_tokens: int) -> Column:
    """The annotated text of the sentences of a row by its method, blank lines included."""

    def guarded(lists: pa.Array) -> pa.Array:
        sizes = pc.list_value_length(lists)
        marker = joined("[SKIPPED LONG SENTENCE: ", sizes.cast(pa.string()), " words]\n")
        return pc.if_else(pc.greater(sizes, max_tokens), marker, joined(trees(lists), "\n\n"))

    def run(nested: pa.Array, methods: pa.Array) -> pa.Array:
        names = np.array([{"POS": 0, "CONSTITUENCY": 1}.get(m, 2) for m in methods.to_pylist()], np.int64)
        lines = (lambda s: joined(pos_lines(s), "\n"), guarded, lambda s: joined(dependencies(s), "\n\n"))
        order = np.argsort(names, kind="stable")
        done = [
            pc.binary_join(by_sentence(nested.take(pa.array(some)), lines[k]), "") for k in range(3) if len(some := order[names[order] == k])
        ]
        back = np.empty(len(order), np.int64)
        back[order] = np.arange(len(order))
        return pa.concat_arrays([pa.array([], pa.string()), *done]).take(pa.array(back))

    run.__annotations__ = {"nested": pa.Array, "methods": pa.Array, "return": pa.Array}
    return F.arrow_udf(run, "string")(sentences, method)


def near_pairs(tokens: Column, window: int) -> Column:
    """Array of ``(i, j, a, b)`` for the tokens of a sentence: the lower-cased words of places at most ``window`` apart, ``i < j``."""

    def run(lists: pa.Array) -> pa.Array:
        words = each_once(lists.values, str.lower)
        ends = offsets(lists).to_numpy().astype(np.int64)
        sizes = np.diff(ends)
        first = np.arange(ends[0], ends[-1])
        place, size = first - np.repeat(ends[:-1], sizes), np.repeat(sizes, sizes)
        step = np.minimum(size - 1 - place, window)
        i = np.repeat(np.arange(len(first)), step)
        before = np.concatenate([[0], np.cumsum(step)])
        away = np.arange(len(i)) - before[i] + 1
        a, at = words.take(pa.array(first[i])), place[i]
        b = words.take(pa.array(first[i] + away))
        pairs = pa.StructArray.from_arrays([pa.array(at.astype(np.int32)), pa.array((at + away).astype(np.int32)), a, b], ["i", "j", "a", "b"])
        return pa.ListArray.from_arrays(pa.array(before[ends - ends[0]].astype(np.int32)), pairs)

    run.__annotations__ = {"lists": pa.Array, "return": pa.Array}
    return F.arrow_udf(run, "array<struct<i:int,j:int,a:string,b:string>>")(tokens)
