"""Responses meet their requests on streams, and requests that nobody answered are reported once."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def correlate(requests: DataFrame, responses: DataFrame, deadline_s: int, delay: str) -> DataFrame:
    """Every request with its response: ``(task_id, job_id, sent, answered, success)``.

    ``requests`` has ``(task_id, job_id, ts)``, ``responses`` ``(task_id, success, ts)``.  A response counts from its request's
    instant on and up to ``deadline_s`` later.  A request without one comes out once, with null ``answered``, when the watermark has
    passed its deadline; so does one whose response comes too late.  A response that is delivered again within ``delay`` counts once, and
    responses to nobody's request are forgotten.  The state is spread by task and goes with the watermark.
    """
    sent = requests.select("task_id", "job_id", F.col("ts").alias("sent")).withWatermark("sent", delay)
    answered = (
        responses.select(F.col("task_id").alias("answer_to"), "success", F.col("ts").alias("answered"))
        .withWatermark("answered", delay)
        .dropDuplicatesWithinWatermark(["answer_to"])
    )
    latest = F.col("sent") + F.expr(f"INTERVAL {int(deadline_s)} SECONDS")
    own = (F.col("task_id") == F.col("answer_to")) & (F.col("answered") >= F.col("sent")) & (F.col("answered") <= latest)
    return sent.join(answered, own, "left_outer").select("task_id", "job_id", "sent", "answered", "success")


def missing_results(correlated: DataFrame) -> DataFrame:
    """``(task_id, job_id, sent)`` of the requests without a response in time."""
    return correlated.where("answered is null").select("task_id", "job_id", "sent")


def answered_requests(correlated: DataFrame, owners: DataFrame | None = None) -> DataFrame:
    """The requests with their responses; with ``owners(job_id)`` only those of these jobs."""
    rows = correlated.where("answered is not null")
    return rows if owners is None else rows.join(owners.select("job_id"), "job_id", "left_semi")
