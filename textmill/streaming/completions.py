"""Streams of completion messages: counts, dedup, finished jobs, workers."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from textmill import constants as K
from textmill.operators.progress import job_progress_from_counts, needed_workers
from textmill.session import ROCKSDB
from textmill.streaming.sink import PROVIDER, WHAT_HAS_ARRIVED, drop_batches, last_batch, session_conf

KEEP_STATE_MS = 30 * 24 * 3600 * 1000
#: State with an age limit asks for another batch again and again; a run over what has arrived must not.
ONLY_DATA_BATCHES = {"spark.sql.streaming.noDataMicroBatches.enabled": "false"}


def stream_dedup(completions: DataFrame, delay: str) -> DataFrame:
    """First delivery of each message.

    ``delay`` must exceed the longest time between two deliveries of a message;
    it also bounds the state.  The state is spread by message, so one busy job
    does not matter.
    """
    return completions.withWatermark("ts", delay).dropDuplicatesWithinWatermark(["msg_id"])


def start_counts(
    completions: DataFrame,
    delay: str,
    table: str,
    checkpoint: str,
    step: Callable[[DataFrame], DataFrame] | None = None,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Keep the completions per job up to date in one query: dedup and counts, batch after batch.

    The dedup hands each batch its first deliveries; these are counted in each task and added to the counts of the batch
    before.  ``table/counts/batch=n`` holds ``(job_id, done)`` after batch ``n``, and ``table/steps/batch=n`` what ``step`` makes
    of it.  A batch that repeats starts from the same counts again, so a restart never counts twice; counts of batches that
    cannot repeat any more are deleted.
    """
    spark = completions.sparkSession
    once = stream_dedup(completions, delay)
    kind = once.schema["job_id"].dataType.simpleString()

    def write(batch: DataFrame, batch_id: int) -> None:
        counts = batch.groupBy("job_id").agg(F.count(F.lit(1)).alias("done"))
        before = last_batch(spark, f"{table}/counts", batch_id - 1)
        if before is not None:
            old = spark.read.schema(f"job_id {kind}, done long").parquet(f"{table}/counts/batch={before}")
            counts = counts.unionByName(old).groupBy("job_id").agg(F.sum("done").alias("done"))
        counts.write.mode("overwrite").parquet(f"{table}/counts/batch={batch_id}")
        if step:
            now = spark.read.schema(f"job_id {kind}, done long").parquet(f"{table}/counts/batch={batch_id}")
            step(now).write.mode("overwrite").parquet(f"{table}/steps/batch={batch_id}")
        drop_batches(spark, f"{table}/counts", batch_id - 2)

    with session_conf(spark, {PROVIDER: ROCKSDB}):
        return (
            once.writeStream.foreachBatch(write)
            .option("checkpointLocation", checkpoint)
            .trigger(**(trigger or WHAT_HAS_ARRIVED))
            .start()
        )


def current_counts(spark: SparkSession, table: str, kind: str = "bigint") -> DataFrame:
    """``(job_id, done)`` after the last whole batch of ``start_counts``."""
    schema = f"job_id {kind}, done long"
    last = last_batch(spark, f"{table}/counts")
    if last is None:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{table}/counts/batch={last}")


def _fire_once(keep_ms: int) -> StatefulProcessor:
    """State per job: completions so far, and whether the job was announced.

    The state of a job goes ``keep_ms`` after its last message.  The class is
    made here so that it travels to the workers by value.
    """

    class FireOnce(StatefulProcessor):
        def init(self, handle: StatefulProcessorHandle) -> None:
            schema = T.StructType([T.StructField("done", T.LongType()), T.StructField("fired", T.BooleanType())])
            self._state = handle.getValueState("progress", schema, ttlDurationMs=keep_ms)

        def handleInputRows(self, key, rows, timerValues):
            done, fired = tuple(self._state.get()) if self._state.exists() else (0, False)
            total = None
            for frame in rows:
                done += int(frame["k"].sum())
                total = int(frame["total"].iloc[0])
            if not fired and total is not None and done >= total:
                fired = True
                yield pd.DataFrame({"job_id": [key[0]], "total": [total]})
            self._state.update((done, fired))

        def close(self) -> None:
            pass

    return FireOnce()


def job_done_events(
    completions: DataFrame, jobs: DataFrame, delay: str, keep_ms: int = KEEP_STATE_MS
) -> DataFrame:
    """One row ``(job_id, total)`` when a registered job is done, only once.

    Messages are deduplicated by id, then each task counts per job what it
    holds, so the keyed state of a busy job receives one small row per task and
    batch and keeps two values, however many messages the job has.  They are
    forgotten ``keep_ms`` after the job's last message, which must be longer than
    a job may pause and than ``delay``.
    """
    id_type = completions.schema["job_id"].dataType.simpleString()

    def count_part(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts: dict = {}
        for frame in frames:
            for job, k in frame["job_id"].value_counts().items():
                counts[job] = counts.get(job, 0) + int(k)
        yield pd.DataFrame({"job_id": list(counts), "k": list(counts.values())})

    once = stream_dedup(completions, delay).select("job_id")
    partial = once.mapInPandas(count_part, f"job_id {id_type}, k long")
    known = partial.join(jobs.select("job_id", "total"), "job_id")
    return known.groupBy("job_id").transformWithStateInPandas(
        statefulProcessor=_fire_once(keep_ms),
        outputStructType=f"job_id {id_type}, total long",
        outputMode="Append",
        timeMode="ProcessingTime",
    )


def workers_step(jobs: DataFrame, cap: int = K.MAX_WORKERS):
    """Step for ``start_counts``: one row of workers wanted."""

    def step(counts: DataFrame) -> DataFrame:
        return needed_workers(job_progress_from_counts(counts, jobs), cap)

    return step
