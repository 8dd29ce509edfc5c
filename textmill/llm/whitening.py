"""Embedding whitening: covariance of the distinct vectors, its spectral components, broadcast whitening.

Vectors become integers on a grid, so that equal vectors are equal bytes, sums are exact and reruns agree.
Every task centres its vectors before it multiplies them; what the tasks add up are sums per dimension and the
rows of a ``d x d`` matrix, whose size depends on the dimension alone.  ``spectral`` takes the matrix apart, and
the components and the mean, ``d`` numbers each, go to the tasks that whiten the rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textmill.llm.common import share, shared, text_bytes
from textmill.llm.spectral import EPS, eigenvectors
from textmill.storage import materialize

SCALE = 256
#: Grid values beyond this are cut there.
LIMIT = 1 << 62
#: Groups that the tasks' matrix rows are added in before the last sum.
_GROUPS = 64
_LOW = 31


@dataclass(frozen=True)
class Whitening:
    """A fitted transform: ``n`` distinct vectors, their sums, and components by falling eigenvalue."""

    n: int
    sums: tuple[int, ...]
    components: np.ndarray
    eigenvalues: np.ndarray
    trace: float
    identity_error: float

    @property
    def mean(self) -> np.ndarray:
        return np.array([s / self.n for s in self.sums])

    @property
    def explained(self) -> list[float]:
        return (self.eigenvalues / self.trace).tolist()


def grid_vectors(rows: DataFrame, ident: str = "vec_id", column: str = "embedding", scale: int = SCALE) -> DataFrame:
    """``ident, size, x``: ``floor(scale * entry)`` of every entry as 64-bit integers in bytes.

    Rows whose vector is null, or holds a null or an entry that is not finite, are left out.
    """
    found = rows.select(F.col(ident), F.col(column).cast("array<double>").alias("entries"))
    schema = found.select(ident).schema.add("size", "integer").add("x", "binary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.filter(batch.column(1).is_valid())
            entries = batch.column(1)
            values, bounds = entries.flatten(), np.concatenate(([0], np.cumsum(entries.value_lengths().to_numpy())))
            wrong = ~np.isfinite(values.fill_null(np.nan).to_numpy(zero_copy_only=False))
            counted = np.concatenate(([0], np.cumsum(wrong)))
            fine = np.diff(counted[bounds]) == 0
            numbers = np.floor(np.where(wrong, 0, values.fill_null(0).to_numpy(zero_copy_only=False)) * scale)
            # a float of 2^62 is exact, and so is what it becomes
            grid = np.clip(numbers, -float(LIMIT), float(LIMIT)).astype("<i8")
            packed = [grid[a:b].tobytes() for a, b, ok in zip(bounds[:-1], bounds[1:], fine) if ok]
            sizes = pa.array(np.diff(bounds)[fine], pa.int32())
            yield pa.record_batch([batch.column(0).filter(pa.array(fine)), sizes, pa.array(packed, pa.binary())], schema.names)

    return found.mapInArrow(run, schema)


def _matrix(column: pa.Array, size: int) -> np.ndarray:
    raw, _ = text_bytes(column)
    return raw.view("<i8").reshape(-1, size)


def _sums(fit: DataFrame, size: int) -> tuple[int, list[int]]:
    """How many vectors, and their exact sum in each dimension: high and low halves apart, so that none overflows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column(0), size)
            high = x >> _LOW
            low = (x - (high << _LOW)).sum(axis=0)
            made = [np.arange(size), high.sum(axis=0), low, np.full(size, len(x))]
            yield pa.record_batch([pa.array(m, pa.int64()) for m in made], ["dim", "high", "low", "n"])

    parts = fit.select("x").mapInArrow(run, "dim long, high long, low long, n long").groupBy("dim")
    whole = {c: F.sum(F.col(c).cast("decimal(20,0)")).alias(c) for c in ("high", "low", "n")}
    rows = sorted(parts.agg(*whole.values()).collect(), key=lambda r: r["dim"])
    return int(rows[0]["n"]), [(int(r["high"]) << _LOW) + int(r["low"]) for r in rows]


def _added(parts: DataFrame) -> np.ndarray:
    """The sum of matrices that come as rows ``(part, line, numbers)``, added in groups and then as a whole."""

    def add(table: pa.Table) -> pa.Table:
        total = np.zeros(0)
        for batch in table.to_batches():
            flat = batch.column(2).flatten().to_numpy()
            if batch.num_rows:
                total = total + flat.reshape(batch.num_rows, -1).sum(axis=0) if len(total) else flat.reshape(batch.num_rows, -1).sum(axis=0)
        return pa.table(
            {"part": table.column(0).slice(0, 1), "line": table.column(1).slice(0, 1), "numbers": pa.array([total], pa.list_(pa.float64()))}
        )

    schema = "part int, line int, numbers array<double>"
    grouped = parts.groupBy("part", "line").applyInArrow(add, schema)
    whole = grouped.groupBy("line").applyInArrow(add, schema)
    return np.array([r["numbers"] for r in sorted(whole.collect(), key=lambda r: r["line"])])


def _scatter(fit: DataFrame, mean: np.ndarray, by: np.ndarray | None = None) -> np.ndarray:
    """The sum of ``c c'`` over all vectors, ``c`` centred (and carried over by ``by``); below it the sum of ``c``."""
    box, size = share(fit.sparkSession, (mean, by)), len(mean)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mean, by = shared(box)
        total, first = 0.0, None
        for batch in batches:
            x = _matrix(batch.column(0), size)
            if not len(x):
                continue
            first = hash(x[0].tobytes()) % _GROUPS if first is None else first
            centred = x - mean
            centred = centred if by is None else centred @ by
            total = total + np.vstack([centred.T @ centred, centred.sum(axis=0)])
        if first is not None:
            lines = pa.array(np.arange(len(total)), pa.int32())
            yield pa.record_batch(
                [pa.array(np.full(len(total), first), pa.int32()), lines, pa.array(list(total), pa.list_(pa.float64()))],
                ["part", "line", "numbers"],
            )

    return _added(fit.select("x").mapInArrow(run, "part int, line int, numbers array<double>"))


def fit_whitening(grid: DataFrame, most: int | None = None) -> Whitening | None:
    """Fit on every distinct vector of ``grid`` (of ``grid_vectors``, stored) once; None without vectors.

    The vectors of a fit have one length, the most frequent one, the longer of two equally frequent; empty
    vectors count for nothing.  Directions without variance, and those whose variance is lost in the rounding of
    the largest, are no components, so there may be fewer than ``most``.
    """
    sizes = grid.where("size > 0").groupBy("size").agg(F.count(F.lit(1)).alias("n"))
    common = sizes.orderBy(F.desc("n"), F.desc("size")).first()
    if common is None:
        return None
    size = common["size"]
    fit = materialize(grid.where(F.col("size") == size).select("x").distinct(), "fit")
    n, sums = _sums(fit, size)
    mean = np.array([s / n for s in sums])
    covariance = _scatter(fit, mean)[:size] / n
    trace = float(np.trace(covariance))
    values, vectors = eigenvectors(covariance, most)
    real = values > 8 * size * EPS * trace
    values, vectors = values[real], vectors[:, real]
    error = 0.0
    if len(values):
        scatter = _scatter(fit, mean, vectors / np.sqrt(values))
        middle = scatter[-1] / n
        error = float(np.abs(scatter[:-1] / n - np.outer(middle, middle) - np.eye(len(values))).max())
    return Whitening(n, tuple(sums), vectors, values, trace, error)


def whiten(grid: DataFrame, model: Whitening, ident: str = "vec_id") -> DataFrame:
    """``ident, deviation, whitened`` of the rows of ``grid`` that have the length of the fit.

    ``whitened`` has one number a component.  ``deviation`` is the exact sum of ``(n x - S)^2``, null where it
    exceeds a 64-bit integer.
    """
    size, most = len(model.sums), 1 << 63
    box = share(grid.sparkSession, model)
    rows = grid.where(F.col("size") == size).select(ident, "x")
    schema = rows.select(ident).schema.add("deviation", "long").add("whitened", T.ArrayType(T.DoubleType()))
    reach = max(map(abs, model.sums))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared(box)
        by, mean, sums = model.components / np.sqrt(model.eigenvalues), model.mean, list(model.sums)
        for batch in batches:
            x = _matrix(batch.column(1), size)
            top = model.n * int(np.abs(x).max(initial=0)) + reach
            if size * top * top < most:
                deviation = ((model.n * x - np.array(sums)) ** 2).sum(axis=1).tolist()
            else:
                # beyond 64 bits on the way: Python's integers
                exact = ((model.n * x.astype(object) - np.array(sums, object)) ** 2).sum(axis=1)
                deviation = [int(v) if v < most else None for v in exact]
            white = (x - mean) @ by
            made = [pa.array(deviation, pa.int64()), pa.array(list(white), pa.list_(pa.float64()))]
            yield pa.record_batch([batch.column(0), *made], schema.names)

    return rows.mapInArrow(run, schema)


def whiten_embeddings(rows: DataFrame, most: int | None = None, ident: str = "vec_id", column: str = "embedding") -> DataFrame:
    """Whiten a table of vectors: one row per vector and component up to ``most``.

    Returns ``ident, component`` (from 1, by falling eigenvalue), ``n`` (distinct vectors), ``deviation,
    whitened, explained, identity_error``.  Rows with a null vector, a null or a non-finite entry, an empty vector or one
    of another length than the fit's are left out; null and repeated ids are kept as they are, repeated vectors count once in
    the fit.  Other columns are ignored.  An empty table, or vectors that are all equal, give no rows.
    """
    grid = materialize(grid_vectors(rows, ident, column), "grid")
    model = fit_whitening(grid, most)
    if model is None or not len(model.eigenvalues):
        kind = rows.schema[ident].dataType.simpleString()
        return rows.sparkSession.createDataFrame(
            [],
            f"`{ident}` {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double",
        )
    per_component = whiten(grid, model, ident).select(ident, "deviation", F.posexplode("whitened").alias("place", "whitened"))
    explained = F.array(*[F.lit(e) for e in model.explained])
    return per_component.select(
        ident,
        (F.col("place") + 1).alias("component"),
        F.lit(model.n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.get(explained, F.col("place")).alias("explained"),
        F.lit(model.identity_error).alias("identity_error"),
    )
