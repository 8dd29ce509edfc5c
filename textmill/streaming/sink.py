"""Run a stream, over what has arrived or on and on, and leave a table behind."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from textmill.session import ROCKSDB
from textmill.storage import scratch_path

#: Stop when all is read that had arrived; for a stream that runs on pass e.g. ``{"processingTime": "10 seconds"}``.
WHAT_HAS_ARRIVED = {"availableNow": True}
PROVIDER = "spark.sql.streaming.stateStore.providerClass"


@contextmanager
def session_conf(spark: SparkSession, settings: dict[str, str]) -> Iterator[None]:
    """Set session options while a stream starts, which keeps them for its run."""
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def start_append(
    stream: DataFrame, table: str, checkpoint: str, fmt: str = "parquet", trigger: dict | None = None
) -> StreamingQuery:
    """Append finished rows to a file table, exactly once; stop when all is read, or run on with another ``trigger``.

    With ``fmt`` "text" a stream of message bodies becomes one message a line.
    """
    spark = stream.sparkSession
    with session_conf(spark, {PROVIDER: ROCKSDB}):
        return (
            stream.writeStream.format(fmt)
            .outputMode("append")
            .option("path", table)
            .option("checkpointLocation", checkpoint)
            .trigger(**(trigger or WHAT_HAS_ARRIVED))
            .start()
        )


def start_batches(
    stream: DataFrame,
    table: str,
    checkpoint: str,
    mode: str,
    step: Callable[[DataFrame], DataFrame] | None = None,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Write each batch's rows (after ``step``) to its own folder of ``table``.

    The folder is named by the batch and overwritten when a batch repeats, so a
    restart never doubles rows.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        out = step(batch) if step else batch
        out.write.mode("overwrite").parquet(f"{table}/batch={batch_id}")

    spark = stream.sparkSession
    with session_conf(spark, {PROVIDER: ROCKSDB}):
        return (
            stream.writeStream.outputMode(mode)
            .foreachBatch(write)
            .option("checkpointLocation", checkpoint)
            .trigger(**(trigger or WHAT_HAS_ARRIVED))
            .start()
        )


def fresh(spark: SparkSession, label: str) -> tuple[str, str]:
    """Table and checkpoint folders of a new run, below the shared folder."""
    base = scratch_path(spark, label)
    return f"{base}/table", f"{base}/checkpoint"


def _batches(spark: SparkSession, table: str) -> tuple[object, dict[int, object]]:
    """The file system and the ``batch=n`` folders of a table that are whole."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(table)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(folder):
        return files, {}
    found = {}
    for status in files.listStatus(folder):
        name, _, number = status.getPath().getName().partition("=")
        if name == "batch" and files.exists(spark._jvm.org.apache.hadoop.fs.Path(status.getPath(), "_SUCCESS")):
            found[int(number)] = status.getPath()
    return files, found


def last_batch(spark: SparkSession, table: str, upto: int | None = None) -> int | None:
    """The last whole batch of a table (not after ``upto``), None if there is none."""
    numbers = [n for n in _batches(spark, table)[1] if upto is None or n <= upto]
    return max(numbers, default=None)


def drop_batches(spark: SparkSession, table: str, upto: int) -> None:
    """Delete the batches up to ``upto``, but for the last whole one among them if no later is there."""
    files, found = _batches(spark, table)
    for number, path in found.items():
        if number <= upto and number != max(found):
            files.delete(path, True)
