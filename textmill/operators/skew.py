"""Joins that hold when one key owns a large share of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textmill.storage import materialize

MAX_BROADCAST_ROWS = 1_000_000
MAX_BROADCAST_BYTES = 64 * 1024 * 1024
HOT_ROWS = 1_000_000
#: Bytes of documents whose different word pairs a task can hold.
PAIRS_BYTES = 8 * 1024 * 1024


def spread(scan: DataFrame, *key: str, part_bytes: int | None = None) -> DataFrame:
    """Use all cores on a table whose files give too few splits.

    A table with at least one split per core, as any large one has, stays as
    it is and is not shuffled.  With ``part_bytes`` there are as many parts as leave each about
    so many bytes of the files, for tasks that count nearly as many different rows as they read:
    beyond their memory they would sort and spill.
    """
    wanted = scan.sparkSession.sparkContext.defaultParallelism
    if part_bytes is not None:
        size = int(scan._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
        wanted = max(wanted, -(-size // part_bytes))
    if scan.rdd.getNumPartitions() >= wanted:
        return scan
    return scan.repartition(wanted, *key)


def fits_broadcast(
    df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS, max_bytes: int = MAX_BROADCAST_BYTES
) -> bool:
    """Measure ``df`` (one distributed aggregate) against the broadcast bounds.

    Nested columns have no simple width: a table with one never fits.
    """
    width = F.lit(8 * len(df.columns)).cast("bigint")
    for field in df.schema.fields:
        if isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType, T.BinaryType, T.VariantType)):
            return False
        if isinstance(field.dataType, T.StringType):
            width = width + F.coalesce(F.octet_length(field.name), F.lit(0)).cast("bigint")
    row = df.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(width), F.lit(0)).alias("b")).first()
    return row["n"] <= max_rows and row["b"] <= max_bytes


def join_lookup(
    facts: DataFrame,
    dim: DataFrame,
    on: list[str],
    ident: list[str],
    how: str = "inner",
    max_rows: int = MAX_BROADCAST_ROWS,
    max_bytes: int = MAX_BROADCAST_BYTES,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Join with a dimension whose size is measured first.

    Within the bounds the dimension is broadcast; beyond them the join goes by
    ``join_hot``.  Pass a stored or materialized ``dim``: it is read twice.
    """
    if fits_broadcast(dim, max_rows, max_bytes):
        return facts.join(F.broadcast(dim), on, how)
    return join_hot(facts, dim, on, ident, how, hot_rows)


def hot_keys(facts: DataFrame, on: list[str], hot_rows: int = HOT_ROWS) -> DataFrame:
    """Every key with more than ``hot_rows`` rows, and into how many parts it goes (``_parts``).

    Twice as many parts as the rows ask for, so that an uneven hash fills none above ``hot_rows``.
    """
    counted = facts.groupBy(*on).agg(F.count(F.lit(1)).alias("_rows")).where(F.col("_rows") > hot_rows)
    return counted.select(*on, F.ceil(2 * F.col("_rows") / hot_rows).cast("int").alias("_parts"))


def salted(facts: DataFrame, hot: DataFrame, on: list[str], ident: list[str]) -> DataFrame:
    """``facts`` with the ``_salt`` of each row: 0, or a part of its hot key.

    The list is broadcast if it measures small; beyond that the rows meet it by a shuffle, in
    which AQE splits the partitions of hot keys, as the list has one row per key.
    """
    flag = F.broadcast(hot) if fits_broadcast(hot) else hot
    salt = F.when(F.col("_parts").isNull(), 0).otherwise(F.pmod(F.xxhash64(*ident), F.col("_parts")))
    return facts.join(flag, on, "left").withColumn("_salt", salt.cast("int")).drop("_parts")


def join_hot(
    facts: DataFrame, dim: DataFrame, on: list[str], ident: list[str], how: str = "inner", hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Shuffle join (inner, left, left_semi, left_anti) salted for hot keys only.

    Keys with more than ``hot_rows`` rows, however many they are, are cut into parts that hold less,
    and their ``dim`` rows repeated for each part.  ``ident`` are columns that tell the fact rows
    apart, so that the salt of a row is the same in every attempt of its task.
    """
    hot = materialize(hot_keys(facts, on, hot_rows), "hot-keys")
    if hot.isEmpty():
        return facts.join(dim, on, how)
    parts = F.sequence(F.lit(0), F.coalesce(F.col("_parts"), F.lit(1)) - 1)
    right = dim.join(hot, on, "left").withColumn("_salt", F.explode(parts)).drop("_parts")
    return salted(facts, hot, on, ident).join(right, [*on, "_salt"], how).drop("_salt")
