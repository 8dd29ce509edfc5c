"""Job progress from completion messages, and the workers it calls for."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from textmill import constants as K
from textmill.functions.numbers import ceil_div, clamp_workers, ratio, seconds_between, time_budget
from textmill.operators.ordered import nth_row, with_position, with_previous
from textmill.operators.skew import join_lookup


def dedup_completions(completions: DataFrame) -> DataFrame:
    """One row per ``msg_id``, at its first delivery.

    All copies of a message carry the same payload; the minima make the choice
    the same in every run.  Copies combine before the shuffle, so a message
    delivered very many times is no hot key.
    """
    return completions.groupBy("msg_id").agg(
        F.min("job_id").alias("job_id"), F.min("success").alias("success"), F.min("ts").alias("ts")
    )


def orphan_completions(completions: DataFrame, jobs: DataFrame) -> DataFrame:
    """Completions (deduplicated) whose job is not registered."""
    return join_lookup(completions, jobs.select("job_id"), ["job_id"], ["msg_id"], "left_anti")


def known_completions(completions: DataFrame, jobs: DataFrame) -> DataFrame:
    """Completions (deduplicated) of registered jobs, with ``total`` and ``n``."""
    registry = jobs.select("job_id", "total", ratio(F.col("n")).alias("n"))
    return join_lookup(completions, registry, ["job_id"], ["msg_id"])


def job_progress(completions: DataFrame, jobs: DataFrame) -> DataFrame:
    """Per registered job: total, n, done, remaining, need, complete.

    Redelivered messages count once; the completions are counted per job before
    they meet the registry, so no join sees a hot job.
    """
    done = completions.groupBy("job_id").agg(F.count_distinct("msg_id").alias("done"))
    return job_progress_from_counts(done, jobs)


def job_progress_from_counts(done: DataFrame, jobs: DataFrame) -> DataFrame:
    """The same from counts ``(job_id, done)`` made elsewhere."""
    rows = jobs.join(done, "job_id", "left").select(
        "job_id", "total", ratio(F.col("n")).alias("n"), F.coalesce("done", F.lit(0)).cast("bigint").alias("done")
    )
    rows = rows.withColumn("remaining", F.greatest(F.col("total") - F.col("done"), F.lit(0)))
    return rows.withColumn("need", ceil_div(F.col("remaining"), F.col("n"))).withColumn(
        "complete", F.col("done") >= F.col("total")
    )


def completed_jobs(progress: DataFrame) -> DataFrame:
    return progress.where("complete").select("job_id", "total", "done")


def pending_tasks(progress: DataFrame) -> DataFrame:
    """Pending per job, and in the row with null job over all."""
    return progress.rollup("job_id").agg(F.sum("remaining").alias("pending"))


def needed_workers(progress: DataFrame, cap: int = K.MAX_WORKERS) -> DataFrame:
    """One row: pending tasks, workers wanted, and the wish within the cap."""
    total = progress.agg(
        F.coalesce(F.sum("remaining"), F.lit(0)).alias("pending"),
        F.coalesce(F.sum("need"), F.lit(0)).alias("wanted"),
    )
    return total.withColumn("target", clamp_workers(F.col("wanted"), cap))


def farm_status(progress: DataFrame, cap: int = K.MAX_WORKERS) -> DataFrame:
    """One gauge row over the jobs that are not complete."""
    active = ~F.col("complete")
    row = progress.agg(
        F.count_if(active).alias("active_jobs"),
        F.coalesce(F.sum("remaining"), F.lit(0)).alias("pending"),
        F.coalesce(F.max(F.when(active, F.col("n"))), F.lit(1)).alias("max_n"),
        F.coalesce(F.sum("need"), F.lit(0)).alias("wanted"),
    )
    return row.withColumn("target", clamp_workers(F.col("wanted"), cap)).withColumn(
        "cap", F.lit(cap).cast("bigint")
    )


def need_trajectory(completions: DataFrame, jobs: DataFrame) -> DataFrame:
    """After each completion of a job: done, remaining, need, change of need.

    Expects deduplicated completions.  What comes after the last task of a job
    is ignored, as the job is gone by then.
    """
    rows = with_position(known_completions(completions, jobs), ["job_id"], ["ts", "msg_id"], "done")
    rows = rows.where(F.col("done") <= F.col("total")).withColumn("remaining", F.col("total") - F.col("done"))
    need = ceil_div(F.col("remaining"), F.col("n"))
    before = ceil_div(F.col("remaining") + 1, F.col("n"))
    return rows.select(
        "job_id", "msg_id", "ts", "done", "remaining", need.alias("need"), (need - before).alias("delta")
    )


def completion_times(completions: DataFrame, jobs: DataFrame) -> DataFrame:
    """The instant of each finished job's last task: its total-th completion."""
    totals = jobs.select("job_id", "total")
    known = join_lookup(completions, totals.select("job_id"), ["job_id"], ["msg_id"], "left_semi")
    last = nth_row(known, ["job_id"], ["ts", "msg_id"], totals, "total")
    return last.select("job_id", "total", F.col("ts").alias("completed_at"))


def capacity_plan(
    completions: DataFrame, jobs: DataFrame, bucket: str = "1 hour", cap: int = K.MAX_WORKERS
) -> DataFrame:
    """Workers to hold per time bucket, and whether that is up, down or hold.

    Completions shrink to counts per job and bucket before anything is ordered;
    a window then sees at most the buckets of the calendar.  Only changes of
    need are summed, so jobs without news in a bucket need no row in it.
    """
    counts = completions.groupBy("job_id", F.window("ts", bucket)["start"].alias("bucket")).agg(
        F.count(F.lit(1)).alias("k")
    )
    registry = jobs.select("job_id", "total", ratio(F.col("n")).alias("n"))
    upto = Window.partitionBy("job_id").orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
    rows = counts.join(registry, "job_id").withColumn("done", F.sum("k").over(upto))

    def need(done):
        return ceil_div(F.greatest(F.col("total") - done, F.lit(0)), F.col("n"))

    change = need(F.col("done")) - need(F.col("done") - F.col("k"))
    per_bucket = rows.groupBy("bucket").agg(F.sum(change).alias("change"))
    # what all jobs need at first: a row before all buckets
    start = registry.agg(F.sum(ceil_div(F.col("total"), F.col("n"))).alias("change"))
    rows = per_bucket.unionByName(start.withColumn("bucket", F.lit(None).cast("timestamp")))
    # one row per bucket of the calendar from here on
    timeline = Window.orderBy(F.asc_nulls_first("bucket"))
    plan = (
        rows.withColumn("wanted", F.sum("change").over(timeline.rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn("target", clamp_workers(F.col("wanted"), cap))
        .withColumn("previous", F.when(F.lag("bucket").over(timeline).isNull(), 0).otherwise(F.lag("target").over(timeline)))
        .where("bucket is not null")
    )
    action = F.when(F.col("target") > F.col("previous"), "up").when(F.col("target") < F.col("previous"), "down")
    return plan.select("bucket", "wanted", "target", action.otherwise("hold").alias("action"))


def timeout_flags(events: DataFrame, key: str, order: list[str], visibility_s) -> DataFrame:
    """Flag the gaps between a key's events that overrun the time budget.

    Adds ``duration_s``, ``budget_s``, ``timed_out`` and ``error``.
    """
    rows = with_previous(events, [key], order, "_previous")
    rows = rows.withColumn("duration_s", seconds_between(F.col("_previous"), F.col(order[0])))
    rows = rows.withColumn("budget_s", time_budget(visibility_s))
    over = F.coalesce(F.col("duration_s") > F.col("budget_s"), F.lit(False))
    return rows.withColumn("timed_out", over).withColumn("error", F.when(over, K.ERR_TIMEOUT)).drop("_previous")
