"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast, cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: A word is a maximal run of characters that are neither blank nor \t \n \v \f \r.
WORD = "[^\\x20\\x09-\\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def share(spark: SparkSession, model) -> Broadcast:
    """Broadcast a fitted model or vocabulary of bounded size; ``shared`` opens it in a task.

    It is pickled by value, as the classes of this package may not be installed there.
    """
    return spark.sparkContext.broadcast({"pickled": cloudpickle.dumps(model)})


def shared(box: Broadcast):
    """The model of ``share``, opened once per worker process."""
    held = box.value
    if "model" not in held:
        held["model"] = cloudpickle.loads(held["pickled"])
    return held["model"]


def row_hash(schema: T.StructType, name: str) -> Column:
    """A hash of the struct column ``name`` that has the columns of ``schema``, whatever their types."""

    def hashable(kind: T.DataType) -> bool:
        if isinstance(kind, T.StructType):
            return all(hashable(f.dataType) for f in kind.fields)
        if isinstance(kind, T.ArrayType):
            return hashable(kind.elementType)
        return not isinstance(kind, (T.MapType, T.VariantType))

    # the hash knows no maps; their text form is the same for the same row
    return F.xxhash64(name) if hashable(schema) else F.xxhash64(F.to_json(name))


def lower_ascii(column):
    """Lower-case A-Z only; null counts as empty."""
    return F.translate(F.coalesce(column, F.lit("")), UPPER, LOWER)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a batch and the bounds of each row (null: empty)."""
    column = column.cast(pa.large_binary()) if not pa.types.is_large_binary(column.type) else column
    if column.null_count:
        column = column.fill_null(b"")
    bounds = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, column.offset * 8)
    data = column.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[bounds[0] : bounds[-1]], bounds - bounds[0]


def row_slices(column: pa.Array, most: int) -> Iterator[tuple[int, int]]:
    """Cut a batch of texts into row ranges of about ``most`` bytes; a row stays whole."""
    sizes = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
    start, held = 0, 0
    for i, n in enumerate(sizes):
        if held and held + n > most:
            yield start, i
            start, held = i, 0
        held += int(n)
    if start < len(sizes):
        yield start, len(sizes)

