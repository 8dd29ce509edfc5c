"""Task rows: building, validating and routing them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textmill import constants as K
from textmill.functions import envelope
from textmill.functions.numbers import ratio


def task_messages(tasks: DataFrame) -> DataFrame:
    """One JSON message per task: ``(job_id, line_no, body)``."""
    body = envelope.encode_task(F.col("method"), F.col("url"), F.col("job_id"))
    return tasks.select("job_id", "line_no", body.alias("body"))


def with_method_check(tasks: DataFrame) -> DataFrame:
    """Add ``valid`` and ``error``; invalid tasks stay and end as error rows."""
    valid = F.coalesce(F.col("method").isin(*K.METHODS), F.lit(False))
    error = F.when(~valid, F.concat(F.lit(K.ERR_METHOD), F.coalesce("method", F.lit("null"))))
    return tasks.withColumn("valid", valid).withColumn("error", error)


def job_sizes(tasks: DataFrame) -> DataFrame:
    """Tasks per job; jobs without a task do not appear."""
    return tasks.groupBy("job_id").agg(F.count(F.lit(1)).alias("total"))


def route_messages(messages: DataFrame) -> DataFrame:
    """Decode ``(msg_id, body)`` and name where each message goes.

    Routes: task, job, control; or dropped as malformed, no_data, unknown_type.
    A task without payload goes on with its fields as "unknown".
    """
    decoded = messages.select("msg_id", envelope.decode(F.col("body"), envelope.ANY_SCHEMA).alias("m")).select(
        "msg_id", F.col("m.type").alias("type"), "m.data.*"
    )
    kind = F.col("type")
    route = (
        F.when(kind.isNull(), "malformed")
        .when(kind == K.TYPE_TASK, "task")
        .when(kind == K.TYPE_TERMINATE, "control")
        .when((kind == K.TYPE_NEW_JOB) & F.col("inputFileS3Key").isNull(), "no_data")
        .when(kind == K.TYPE_NEW_JOB, "job")
        .otherwise("unknown_type")
    )
    task, job = F.col("route") == "task", F.col("route") == "job"
    unknown = F.lit(K.UNKNOWN)
    return decoded.withColumn("route", route).select(
        "msg_id",
        "route",
        F.when(task, F.coalesce("jobId", unknown)).when(job, F.col("jobId")).alias("job_id"),
        F.when(task, F.coalesce("parsingMethod", unknown)).alias("method"),
        F.when(task, F.coalesce("url", unknown)).alias("url"),
        F.when(job, F.col("inputFileS3Key")).alias("input_key"),
        F.when(job, ratio(F.coalesce("n", F.lit(0)))).alias("n"),
    )


def job_request_messages(jobs: DataFrame) -> DataFrame:
    """One request per job ``(job_id, n)``; a ratio below 1 is no request."""
    key = F.format_string(K.INPUT_KEY, F.col("job_id").cast("string"))
    body = envelope.encode_job(key, F.col("n"), F.col("job_id"))
    return jobs.where("n > 0").select("job_id", body.alias("body"))


def task_result_messages(results: DataFrame) -> DataFrame:
    """One completion message per result row; success and error alike."""
    body = envelope.encode_task_result(F.col("success"), F.col("job_id"))
    return results.select("job_id", "line_no", body.alias("body"))


def decode_completions(messages: DataFrame) -> DataFrame:
    """Completions from ``(msg_id, body, ...)``; messages without payload are dropped.

    Other columns are kept, so it serves a stream as well.
    """
    rest = [c for c in messages.columns if c != "body"]
    decoded = messages.select(*rest, envelope.decode(F.col("body"), envelope.TASK_RESULT_SCHEMA).alias("_m"))
    return decoded.where("_m.data is not null").select(
        *rest, F.col("_m.data.jobId").alias("job_id"), F.coalesce("_m.data.success", F.lit(False)).alias("success")
    )


def reply_address(job_id):
    return F.concat(F.lit(K.REPLY_PREFIX), job_id.cast("string"))


def job_response_messages(done_jobs: DataFrame) -> DataFrame:
    """Response per finished job: ``(reply_to, body)``."""
    key = F.format_string(K.SUMMARY_KEY, F.col("job_id").cast("string"))
    return done_jobs.select(
        reply_address(F.col("job_id")).alias("reply_to"), envelope.encode_response(F.col("job_id"), key).alias("body")
    )


def correlate_responses(responses: DataFrame, own_jobs: DataFrame) -> DataFrame:
    """Responses of the right type, with payload, for the caller's own jobs.

    Copies of a response become one row.
    """
    decoded = responses.select(
        "reply_to", envelope.decode(F.col("body"), envelope.RESPONSE_SCHEMA).alias("m")
    ).select(
        "reply_to",
        F.col("m.type").alias("type"),
        F.col("m.data.jobId").alias("job_id"),
        F.col("m.data.summaryS3Key").alias("summary_key"),
    )
    wanted = decoded.where((F.col("type") == K.TYPE_JOB_DONE) & F.col("job_id").isNotNull())
    wanted = wanted.drop("type").distinct()
    own = own_jobs.select(F.col("job_id").cast("string").alias("job_id"), reply_address(F.col("job_id")).alias("reply_to"))
    return wanted.join(own, ["job_id", "reply_to"], "left_semi").select("job_id", "reply_to", "summary_key")

