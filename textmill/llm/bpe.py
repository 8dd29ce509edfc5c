"""BPE encoding and decoding with a pair occurrence index.

The distinct new words of a batch are laid out as one array of symbols with
links to their neighbours.  An index maps every pair that has a merge to all its
positions; the active ranks are applied in ascending order, each to all its
positions at once, and only the lists of the pairs beside a merge are updated.
"""

from __future__ import annotations

import heapq
import json
import re
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from textmill.llm.common import row_slices, share, shared

#: Words a worker remembers before it starts afresh.
REMEMBER = 300_000
_SLICE = 2 << 20
# White space as the vocabulary's own rules have it, and its word pattern.
_SPACE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_WORD = rf"'s|'t|'re|'ve|'m|'ll|'d|\p{{L}}+|\p{{N}}|[^{_SPACE}\p{{L}}\p{{N}}]+"
_ASCII_WORD = r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^\t-\r a-z0-9]+"


def byte_letters() -> list[str]:
    """The letter that stands for each byte: itself if printable, else the next free one from 256 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    letters = {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(rest)}
    return [letters[b] for b in range(256)]


@dataclass
class Vocabulary:
    """A word-level BPE vocabulary: byte letters, a word end, ranked merges."""

    tokens: list[str]
    specials: dict[str, int]
    first: np.ndarray
    last: np.ndarray
    pairs: np.ndarray
    ranks: np.ndarray
    merged: np.ndarray
    #: words met so far: their ids as little-endian bytes, and their tokens' strings
    ids: dict[str | int, bytes] = field(default_factory=dict)
    shown: dict[str | int, bytes] = field(default_factory=dict)


def read_vocabulary(path: str) -> Vocabulary:
    """Read a tokenizer file of the ``tokenizers`` library (model BPE with a word end)."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    model, end = spec["model"], spec["model"]["end_of_word_suffix"]
    if model["type"] != "BPE" or not end or model["unk_token"] or spec["decoder"]:
        raise ValueError("a BPE vocabulary with a word end, no unknown token and no decoder is wanted")
    vocab = dict(model["vocab"])
    specials = {t["content"]: t["id"] for t in spec["added_tokens"]}
    tokens = [""] * (max([*vocab.values(), *specials.values()]) + 1)
    for token, i in [*vocab.items(), *specials.items()]:
        tokens[i] = token
    merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
    keys = np.array([vocab[a] << 32 | vocab[b] for a, b in merges], np.int64)
    order = np.argsort(keys, kind="stable")
    letters = byte_letters()
    return Vocabulary(
        tokens,
        specials,
        np.array([vocab[c] for c in letters], np.int64),
        np.array([vocab[c + end] for c in letters], np.int64),
        keys[order],
        order.astype(np.int64),
        np.array([vocab[a + b] for a, b in merges], np.int64),
    )


def encode_words(words: list[bytes], v: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all words in one array, and the bounds of each word; words are not empty."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    bounds = np.concatenate(([0], np.cumsum(lengths)))
    raw = np.frombuffer(b"".join(words), np.uint8)
    symbol = v.first[raw]
    ends = bounds[1:] - 1
    symbol[ends] = v.last[raw[ends]]
    size = len(raw)
    after = np.arange(1, size + 1)
    after[ends] = -1
    before = np.arange(-1, size - 1)
    before[bounds[:-1]] = -1
    alive = np.ones(size, bool)

    index: dict[int, list[np.ndarray]] = {}
    active: list[int] = []

    def add(places: np.ndarray) -> None:
        keys = symbol[places] << 32 | symbol[after[places]]
        at = np.minimum(np.searchsorted(v.pairs, keys), len(v.pairs) - 1)
        found = v.pairs[at] == keys
        if not found.any():
            return
        ranks, places = v.ranks[at[found]], places[found]
        order = np.argsort(ranks, kind="stable")
        ranks, places = ranks[order], places[order]
        cuts = np.flatnonzero(ranks[1:] != ranks[:-1]) + 1
        for rank, part in zip(ranks[np.concatenate(([0], cuts))].tolist(), np.split(places, cuts)):
            if rank in index:
                index[rank].append(part)
            else:
                index[rank] = [part]
                heapq.heappush(active, rank)

    halves = np.empty((len(v.ranks), 2), np.int64)
    halves[v.ranks, 0], halves[v.ranks, 1] = v.pairs >> 32, v.pairs & 0xFFFFFFFF
    add(np.flatnonzero(after >= 0))
    while active:
        rank = heapq.heappop(active)
        lists = index.pop(rank)
        places = lists[0] if len(lists) == 1 else np.unique(np.concatenate(lists))
        left, right = halves[rank]
        places = places[alive[places] & (symbol[places] == left) & (after[places] >= 0)]
        places = places[symbol[after[places]] == right]
        if left == right and len(places) > 1:
            # of a run of overlapping places every second one merges, from the left
            joined = np.concatenate(([False], after[places[:-1]] == places[1:]))
            starts = np.flatnonzero(~joined)
            run = np.arange(len(places)) - np.repeat(starts, np.diff(np.append(starts, len(places))))
            places = places[run % 2 == 0]
        if not len(places):
            continue
        gone = after[places]
        nxt = after[gone]
        symbol[places] = v.merged[rank]
        alive[gone] = False
        after[places] = nxt
        has = nxt >= 0
        before[nxt[has]] = places[has]
        prev = before[places]
        beside = np.concatenate((prev[prev >= 0], places[has]))
        if len(beside):
            add(np.unique(beside))
    total = np.concatenate(([0], np.cumsum(alive)))
    return symbol[alive], total[bounds]


def pieces(text: str, v: Vocabulary) -> list[str | int]:
    """The words of a text in order; a special token's own string gives its id."""
    if not any(s in text for s in v.specials):
        return _words(text)
    longest_first = sorted(v.specials, key=len, reverse=True)
    parts = re.split("(" + "|".join(map(re.escape, longest_first)) + ")", text)
    return [w for p in parts for w in ([v.specials[p]] if p in v.specials else _words(p))]


def _words(text: str) -> list[str]:
    if text.isascii():
        return re.findall(_ASCII_WORD, text.lower())
    # each character is lower-cased by itself: no final sigma
    return regex.findall(_WORD, unicodedata.normalize("NFC", text).replace("Σ", "σ").lower())


def encode_texts(texts: list[str], v: Vocabulary) -> tuple[list[bytes], list[str]]:
    """Ids (little-endian unsigned 32-bit numbers) and decoded text of each text."""
    if len(v.ids) > REMEMBER:
        v.ids, v.shown = {}, {}
    split = [pieces(t, v) for t in texts]
    fresh = {w for w in set().union(*split) if w not in v.ids}
    words = [w for w in fresh if isinstance(w, str)]
    if words:
        flat, bounds = encode_words([w.encode() for w in words], v)
        raw, at, numbers = flat.astype("<u4").tobytes(), bounds.tolist(), flat.tolist()
        for w, a, b in zip(words, at, at[1:]):
            v.ids[w] = raw[4 * a : 4 * b]
            v.shown[w] = " ".join([v.tokens[i] for i in numbers[a:b]]).encode()
    for w in fresh:
        if not isinstance(w, str):
            v.ids[w], v.shown[w] = np.array([w], "<u4").tobytes(), v.tokens[w].encode()
    ids, shown = v.ids.__getitem__, v.shown.__getitem__
    return [b"".join(map(ids, doc)) for doc in split], [b" ".join(map(shown, doc)).decode() for doc in split]


def encode_decode(docs: DataFrame, path: str) -> DataFrame:
    """Encode every whole text and decode it again.

    ``path`` names a vocabulary file; it is read on the driver and sent to the
    workers (its size does not depend on the data).  Returns one row per input
    row: ``doc_id, n_tokens, ids`` (little-endian unsigned 32-bit numbers),
    ``decoded`` (the tokens' own strings, joined by blanks).  A null or empty text
    has no tokens and decodes to the empty text; other columns are ignored.
    """
    box = share(docs.sparkSession, read_vocabulary(path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = shared(box)
        for batch in batches:
            for a, b in row_slices(batch.column(1), _SLICE):
                part = batch.slice(a, b - a)
                texts = ["" if t is None else t for t in part.column(1).to_pylist()]
                ids, decoded = encode_texts(texts, vocabulary)
                yield pa.record_batch(
                    [
                        part.column(0),
                        pa.array([len(x) // 4 for x in ids], pa.int64()),
                        pa.array(ids, pa.binary()),
                        pa.array(decoded, pa.string()),
                    ],
                    ["doc_id", "n_tokens", "ids", "decoded"],
                )

    ids = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {ids}, n_tokens bigint, ids binary, decoded string"
    )


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """``doc_id, text`` from ``doc_id, ids``: the strings of the tokens, joined by blanks (null: empty)."""
    box = share(encoded.sparkSession, read_vocabulary(path).tokens)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = shared(box)
        for batch in batches:
            texts = [
                " ".join([tokens[i] for i in np.frombuffer(x or b"", "<u4").tolist()])
                for x in batch.column(1).to_pylist()
            ]
            yield pa.record_batch([batch.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    ids = encoded.schema["doc_id"].dataType.simpleString()
    return encoded.select("doc_id", "ids").mapInArrow(run, f"doc_id {ids}, text string")
