"""Result rows, one per task, success or error."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textmill import constants as K
from textmill.functions.strings import output_key


def result_rows(fetched: DataFrame, bucket: str) -> DataFrame:
    """Result metadata of fetched (or annotated) tasks with their ``error``.

    The output URL is null on error, the message null on success.
    """
    key = output_key(F.col("job_id"), F.col("method"), F.col("url"), F.col("line_no"))
    success = F.col("error").isNull()
    return fetched.select(
        "job_id",
        "line_no",
        F.col("url").alias("original_url"),
        F.col("method").alias("parsing_method"),
        F.when(success, F.concat(F.lit(f"s3://{bucket}/"), key)).alias("output_url"),
        success.alias("success"),
        F.col("error").alias("error_message"),
    )


def failure_reason(df: DataFrame) -> DataFrame:
    """Add ``error`` from ``(valid, timed_out, interrupted, cause, method)``.

    Earlier reasons win, in the order a task meets them.
    """
    reason = (
        F.when(~F.col("valid"), F.concat(F.lit(K.ERR_METHOD), F.col("method")))
        .when(F.col("timed_out"), F.lit(K.ERR_TIMEOUT))
        .when(F.col("interrupted"), F.lit(K.ERR_INTERRUPTED))
        .otherwise(F.col("cause"))
    )
    return df.withColumn("error", reason)


def missing_results(tasks: DataFrame, results: DataFrame) -> DataFrame:
    """Tasks that have no result row."""
    return tasks.join(results.select("job_id", "line_no"), ["job_id", "line_no"], "left_anti")
