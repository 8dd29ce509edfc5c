"""Toxicity by compression distance.

Two zstandard dictionaries: one is trained on ordinary text; the other holds
the windows that mark toxic text, in front of the same trained background, so
that ordinary words cost both the same.  A window's cost under a dictionary is its compressed length with a fixed
carrier behind it, for alone it would be too short to be compressed at all.
Windows whose cost the toxic dictionary lowers by at least the calibrated share
are hits, and a document with at least the calibrated number of hits is toxic.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textmill.llm.common import share, shared
from textmill.llm.labelled import held_out, labelled_rows, labelled_texts

FOLDS, HELD_FOLD = 3, 1
#: Labelled rows of each class the dictionaries are trained on.
MOST_LABELLED = 3_000
DICTIONARY_BYTES = 16_384
CARRIER_BYTES = 64
#: A window marks toxic text if it is this many times as frequent there as in ordinary text,
#: and so often that chance would give it with odds of less than e^-ODDS among all windows.
RATIO, ODDS = 20, 4
LEVEL = 12
ACCEPT = 0.7
#: Distinct windows a task remembers before it starts afresh.
REMEMBER = 500_000


def windows(text: str | None) -> list[bytes]:
    """The windows of a whole text: its words."""
    return (text or "").encode().split()


@dataclass
class Distance:
    """The dictionaries and the thresholds; compressors are made where they are used."""

    ordinary: bytes
    toxic: bytes
    gain: float = 1.0
    hits: int = 1
    seen: dict[bytes, float] = field(default_factory=dict)
    pair: tuple | None = None

    def __getstate__(self):
        return (self.ordinary, self.toxic, self.gain, self.hits)

    def __setstate__(self, state):
        self.__init__(*state)

    def gains(self, parts: list[bytes]) -> np.ndarray:
        """Per window: the share of its cost that the toxic dictionary saves."""
        carrier = b" " + self.ordinary[-CARRIER_BYTES:]
        if self.pair is None:
            self.pair = [(c, len(c.compress(carrier))) for c in map(_compressor, (self.ordinary, self.toxic))]
        if len(self.seen) > REMEMBER:
            self.seen = {}
        seen, ((plain, a), (toxic, b)) = self.seen, self.pair
        for w in parts:
            if w not in seen:
                text = b" " + w + carrier
                cost = len(plain.compress(text)) - a
                seen[w] = (cost - len(toxic.compress(text)) + b) / max(cost, 1)
        return np.fromiter(map(seen.__getitem__, parts), np.float64, len(parts))

    def score(self, text: str | None) -> float:
        """From 0 to 1; 0.7 where the hits are just enough.  Windows below the
        threshold count less than one hit together."""
        gains = self.gains(windows(text))
        hit = gains >= self.gain
        rest = min(max(0.0, gains[~hit].max(initial=0.0)), 0.9)
        return 1 - math.exp(math.log(1 - ACCEPT) * (int(hit.sum()) + rest) / self.hits)


def _compressor(content: bytes) -> zstandard.ZstdCompressor:
    plain = {"write_content_size": False, "write_checksum": False, "write_dict_id": False}
    if not content:
        return zstandard.ZstdCompressor(
            compression_params=zstandard.ZstdCompressionParameters.from_level(LEVEL, **plain)
        )
    book = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    how = zstandard.ZstdCompressionParameters.from_level(LEVEL, source_size=128, dict_size=len(content), **plain)
    book.precompute_compress(compression_params=how)
    return zstandard.ZstdCompressor(dict_data=book, compression_params=how)


def _trained(texts: list[list[bytes]]) -> bytes:
    """Content of a dictionary trained on texts; the texts themselves if they are too few to train on."""
    samples = [b" ".join(t) for t in texts if t]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except zstandard.ZstdError:
        return b" ".join(samples)[-DICTIONARY_BYTES:]


def fit_distance(texts: list[str | None], label: np.ndarray) -> Distance:
    """Train both dictionaries and calibrate the thresholds on the same rows.

    Without rows of both classes nothing is toxic.
    """
    split = [windows(t) for t in texts]
    toxic = [w for w, y in zip(split, label) if y == 1]
    plain = [w for w, y in zip(split, label) if y == 0]
    background = _trained(plain)
    if not toxic or not plain:
        return Distance(background, background)
    found, beside, ordinary = Counter(), defaultdict(set), Counter()
    for doc in toxic:
        found.update(set(doc))
        for before, w in zip([b"", *doc], doc):
            beside[w].add(before)
    for doc in plain:
        ordinary.update(set(doc))
    least = (math.log(len(found) + 1) + ODDS) / math.log(1 + len(plain) / len(toxic))
    # copies of a text repeat its neighbours, so they do not count twice
    often = {w: min(n, len(beside[w])) for w, n in found.items()}
    marks = [w for w, n in often.items() if n >= least and n * len(plain) > RATIO * ordinary[w] * len(toxic)]
    if not marks:
        return Distance(background, background)
    content = b" " + b" ".join(sorted(marks, key=lambda w: (found[w], w))) + b" "
    model = Distance(background, content + background)
    gains = [model.gains(w) for w in split]
    tried = []
    for gain in np.arange(0.15, 0.9, 0.05):
        counts = np.array([(g >= gain).sum() for g in gains])
        for hits in range(1, 5):
            says = counts >= hits
            tried.append((says[label == 0].mean() + (~says[label == 1]).mean(), hits, gain))
    wrong, hits, _ = min(tried)
    # of thresholds that do equally well, the middle one is the safest
    equal = [g for w, h, g in tried if (w, h) == (wrong, hits)]
    return Distance(model.ordinary, model.toxic, float(equal[len(equal) // 2]), hits)


def train(docs: DataFrame, labels: DataFrame, most: int = MOST_LABELLED) -> Distance:
    """Fit on at most ``most`` labelled rows of each class outside the held-out fold."""
    chosen = labelled_rows(labels, "toxic", FOLDS, HELD_FOLD, most, by_class=True)
    rows = labelled_texts(docs, chosen).toArrow()
    rows = rows.sort_by([("doc_id", "ascending"), ("label", "ascending"), ("text", "ascending")])
    return fit_distance(rows["text"].to_pylist(), rows["label"].to_numpy())


def toxicity_scores(docs: DataFrame, labels: DataFrame, most: int = MOST_LABELLED) -> DataFrame:
    """Score every whole text.

    Returns one row per input row: ``doc_id, held_out, score, predicted`` (1 if
    the score is at least 0.7).  Only the text counts; a null or empty text has no window and scores 0.
    Rows repeated in the id are scored each by its own text; labels that are
    null or not 0 or 1 are not used; other columns are ignored; without labels of both
    kinds nothing is toxic.  An empty table gives an empty result.
    """
    box = share(docs.sparkSession, train(docs, labels, most))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared(box)
        for batch in batches:
            scores = [model.score(t.as_py()) for t in batch.column(1)]
            yield pa.record_batch([batch.column(0), pa.array(scores, pa.float64())], ["doc_id", "score"])

    ids = docs.schema["doc_id"].dataType.simpleString()
    scored = docs.select("doc_id", "text").mapInArrow(run, f"doc_id {ids}, score double")
    return scored.select(
        "doc_id",
        held_out(FOLDS, HELD_FOLD).alias("held_out"),
        "score",
        (F.col("score") >= ACCEPT).cast("int").alias("predicted"),
    )
