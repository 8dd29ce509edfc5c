"""Quality scores learned from preferences (Bradley-Terry).

A document's strength is linear in plain features of its text.  Pairs of a good
and a bad document say which one is preferred; the weights maximise the logistic
likelihood of the preferences, which depends on feature differences only.  The
scores of the training rows then give the threshold: the quantile at the share of bad rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textmill.llm.common import row_slices, text_bytes
from textmill.llm.hashing import row_words, span_hashes
from textmill.llm.labelled import held_out, labelled_rows, labelled_texts

FOLDS, HELD_FOLD = 4, 2
#: Labelled rows the model is fitted on, and good partners of each bad row.
MOST_LABELLED = 20_000
PARTNERS = 12
RIDGE = 1.0
ACCEPT = 0.7
_SLICE = 1 << 20
_MARKS = [b for b in range(33, 127) if not chr(b).isalnum()]


def _classes() -> tuple[np.ndarray, int]:
    kind = np.zeros(256, np.int64)
    kind[ord("a") : ord("z") + 1] = 1
    kind[ord("A") : ord("Z") + 1] = 2
    kind[ord("0") : ord("9") + 1] = 3
    kind[128:] = 4
    kind[[9, 11, 12, 13, 32]] = 5
    kind[10] = 6
    for i, b in enumerate(_MARKS):
        kind[b] = 7 + i
    return kind, 7 + len(_MARKS)


def features(column: pa.Array) -> np.ndarray:
    """One row of numbers per text: shares of byte classes, repetition, word lengths."""
    kind, kinds = _classes()
    out = [np.zeros((0, kinds + 5))]
    for a, b in row_slices(column, _SLICE):
        raw, bounds = text_bytes(column.slice(a, b - a))
        n = b - a
        row = np.repeat(np.arange(n), np.diff(bounds))
        count = np.bincount(row * kinds + kind[raw], minlength=n * kinds).reshape(n, kinds)
        share = np.log1p(100.0 * count / np.maximum(np.diff(bounds), 1)[:, None])
        starts, ends, first = row_words(raw, bounds)
        hashed = span_hashes(raw, starts, ends)
        owner = np.repeat(np.arange(n), np.diff(first))
        words = np.maximum(np.diff(first), 1).astype(float)
        same = np.zeros(len(owner), bool)
        same[1:] = (hashed[1:] == hashed[:-1]) & (owner[1:] == owner[:-1])
        order = np.lexsort((hashed, owner))
        new = np.ones(len(owner), bool)
        new[1:] = (hashed[order][1:] != hashed[order][:-1]) | (owner[order][1:] != owner[order][:-1])
        lengths = (ends - starts).astype(float)
        per_row = lambda x: np.bincount(owner, x, minlength=n) / words
        more = [
            per_row(same),
            np.log(np.maximum(np.bincount(owner[order], new, minlength=n), 1)) / np.log(words + 1),
            np.log1p(per_row(lengths)),
            per_row(lengths > 12),
            np.log1p(words) / 10,
        ]
        out.append(np.column_stack([share, *more]))
    return np.vstack(out)


@dataclass
class Ranking:
    """Weights on centred and scaled features; a raw score of ``cut`` is the border of acceptance."""

    centre: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    cut: float

    def score(self, x: np.ndarray) -> np.ndarray:
        raw = np.clip((x - self.centre) / self.scale, -8, 8) @ self.weights - self.cut
        return 1 / (1 + np.exp(-np.clip(raw + np.log(ACCEPT / (1 - ACCEPT)), -500, 500)))


def fit_ranking(x: np.ndarray, label: np.ndarray, partners: int = PARTNERS, ridge: float = RIDGE) -> Ranking:
    """Newton's method on the logistic loss of the preference pairs.

    With rows of one class only there is no preference: every score is then
    above the border.
    """
    centre = x.mean(axis=0) if len(x) else np.zeros(x.shape[1])
    scale = x.std(axis=0) + 1e-3 if len(x) else np.ones(x.shape[1])
    z = np.clip((x - centre) / scale, -8, 8)
    good, bad = np.flatnonzero(label == 1), np.flatnonzero(label == 0)
    w = np.zeros(x.shape[1])
    if not len(good) or not len(bad):
        return Ranking(centre, scale, w, -1.0)
    draw = np.random.default_rng(7)
    losers = np.repeat(bad, partners)
    difference = z[draw.choice(good, len(losers))] - z[losers]
    for _ in range(30):
        p = 1 / (1 + np.exp(np.clip(difference @ w, -500, 500)))
        slope = difference.T @ p - ridge * w
        bend = (difference * (p * (1 - p))[:, None]).T @ difference + ridge * np.eye(len(w))
        step = np.linalg.solve(bend, slope)
        w = w + step
        if np.abs(step).max() < 1e-6:
            break
    ranked = np.sort(z @ w)
    return Ranking(centre, scale, w, float((ranked[len(bad) - 1] + ranked[len(bad)]) / 2))


def train(docs: DataFrame, labels: DataFrame, most: int = MOST_LABELLED) -> Ranking:
    """Fit on at most ``most`` labelled rows outside the held-out fold; only their features reach the driver."""
    chosen = labelled_rows(labels, "quality", FOLDS, HELD_FOLD, most, by_class=False)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = features(batch.column(2))
            yield pa.record_batch(
                [batch.column(0), batch.column(1), pa.array(list(x), pa.list_(pa.float64()))], ["doc_id", "label", "x"]
            )

    ids = docs.schema["doc_id"].dataType.simpleString()
    rows = (
        labelled_texts(docs, chosen)
        .mapInArrow(run, f"doc_id {ids}, label int, x array<double>")
        .toArrow()
        .sort_by([("doc_id", "ascending"), ("label", "ascending")])
    )
    width = features(pa.array([], pa.string())).shape[1]
    x = rows["x"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
    return fit_ranking(x, rows["label"].to_numpy())


def _scored(docs: DataFrame, model: Ranking, text: str, fields: list[str]) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = pa.array(model.score(features(batch.column(batch.num_columns - 1))), pa.float64())
            yield pa.record_batch([*batch.columns[:-1], score], [*fields, "score"])

    schema = T.StructType([docs.schema[f] for f in fields]).add("score", "double")
    return docs.select(*fields, text).mapInArrow(run, schema)


def quality_scores(docs: DataFrame, labels: DataFrame, most: int = MOST_LABELLED) -> DataFrame:
    """Score every whole text.

    Returns one row per input row: ``doc_id, held_out, score, predicted`` (1 if
    the score is at least 0.7).  Only the text counts; a null text is an empty one, and empty texts
    are scored like others.  Rows repeated in the id are scored each by its own
    text; labels that are null or not 0 or 1 are not used; other columns are ignored; without
    labels of both kinds everything is accepted.  An empty table gives an empty result.
    """
    scored = _scored(docs, train(docs, labels, most), "text", ["doc_id"])
    return scored.select(
        "doc_id",
        held_out(FOLDS, HELD_FOLD).alias("held_out"),
        "score",
        (F.col("score") >= ACCEPT).cast("int").alias("predicted"),
    )


def keep_good(docs: DataFrame, labels: DataFrame, most: int = MOST_LABELLED) -> DataFrame:
    """The rows of ``docs`` that the classifier accepts, with all their columns."""
    model = train(docs, labels, most)
    packed = docs.select(F.struct("*").alias("row"), "text")
    return _scored(packed, model, "text", ["row"]).where(F.col("score") >= ACCEPT).select("row.*")
