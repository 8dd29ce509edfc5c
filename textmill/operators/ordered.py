"""Row order inside a key without putting the key into one task.

A plain window sorts all rows of a key in one task.  Here the rows are range
partitioned by key and order, so a big key spans many slices of equal size, and
the slices of a key (at most one per partition) carry the running totals.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from textmill.storage import materialize


@dataclass(frozen=True)
class Slices:
    """Rows with their slice, and per key and slice what lies before it."""

    rows: DataFrame
    totals: DataFrame
    key: tuple[str, ...]
    order: tuple[str, ...]


def slice_rows(df: DataFrame, key: list[str], order: list[str], slices: int | None = None) -> Slices:
    """Cut ``df`` into equal slices; ``order`` must be unique inside a key.

    ``totals`` holds the rows in all earlier slices of the key (``_before``),
    the rows in this one (``_n``) and the last ``order[0]`` of the earlier
    slices (``_carry``).  The sliced rows are written once, because both
    readers must see the same cuts.
    """
    count = slices or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = materialize(
        df.repartitionByRange(count, *key, *order).withColumn("_slice", F.spark_partition_id()),
        "slices",
    )
    per_slice = rows.groupBy(*key, "_slice").agg(F.count(F.lit(1)).alias("_n"), F.max(order[0]).alias("_last"))
    earlier = Window.partitionBy(*key).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    totals = per_slice.select(
        *key,
        "_slice",
        "_n",
        F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"),
        F.max("_last").over(earlier).alias("_carry"),
    )
    return Slices(rows, totals, tuple(key), tuple(order))


def _inner(s: Slices) -> Window:
    return Window.partitionBy(*s.key, "_slice").orderBy(*s.order)


def with_position(df: DataFrame, key: list[str], order: list[str], out: str) -> DataFrame:
    """Add the 1-based position of each row inside its key."""
    s = slice_rows(df, key, order)
    joined = s.rows.join(s.totals.select(*key, "_slice", "_before"), [*key, "_slice"])
    return joined.withColumn(out, F.col("_before") + F.row_number().over(_inner(s))).drop("_before", "_slice")


def nth_row(df: DataFrame, key: list[str], order: list[str], nth: DataFrame, n_col: str) -> DataFrame:
    """The ``n_col``-th row of each key; ``nth`` has one row per key.

    Only the slice that holds the wanted row is numbered.
    """
    s = slice_rows(df, key, order)
    wanted = (
        s.totals.join(nth, key)
        .where((F.col(n_col) > F.col("_before")) & (F.col(n_col) <= F.col("_before") + F.col("_n")))
        .select(*nth.columns, "_slice", "_before")
    )
    hit = s.rows.join(wanted, [*key, "_slice"])
    return (
        hit.withColumn("_pos", F.col("_before") + F.row_number().over(_inner(s)))
        .where(F.col("_pos") == F.col(n_col))
        .drop("_pos", "_before", "_slice")
    )


def with_previous(df: DataFrame, key: list[str], order: list[str], out: str) -> DataFrame:
    """Add the previous row's ``order[0]`` inside the key, null for the first."""
    s = slice_rows(df, key, order)
    joined = s.rows.join(s.totals.select(*key, "_slice", "_carry"), [*key, "_slice"])
    previous = F.coalesce(F.lag(order[0]).over(_inner(s)), F.col("_carry"))
    return joined.withColumn(out, previous).drop("_carry", "_slice")
