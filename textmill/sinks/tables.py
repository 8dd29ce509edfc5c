"""Sinks for annotated text, result metadata, summaries and messages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textmill.functions.strings import file_stem
from textmill.storage import remove_partitions

RESULT_NAMES = {
    "line_no": "lineNo",
    "original_url": "originalUrl",
    "parsing_method": "parsingMethod",
    "output_url": "outputS3Url",
    "success": "success",
    "error_message": "errorMessage",
}


def _without_last_newline(name: str) -> Column:
    # the text writer ends each row with one
    return F.regexp_replace(name, r"\n\z", "")


def write_annotated(annotated: DataFrame, path: str, layout: str = "table") -> None:
    """Write bodies as a Parquet table, or as one text object per task.

    Both are partitioned by job and method, and only partitions in hand are
    replaced; ``clear_jobs`` takes away what a job wrote before.  The key holds the line number, so
    two tasks on one file never overwrite each other.  The table's rows are
    rebalanced first, or every task would leave a small file in every job; big
    jobs are cut into several files.  An object per task is a directory per
    task, so prefer the table.
    """
    if layout == "table":
        rows = annotated.hint("rebalance", "job_id", "method")
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
            "job_id", "method"
        ).parquet(path)
        return
    name = F.concat_ws("-", file_stem(F.col("url")), F.col("line_no").cast("string"))
    rows = annotated.select("job_id", "method", name.alias("file"), _without_last_newline("body").alias("body"))
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
        "job_id", "method", "file"
    ).text(path)


def clear_jobs(jobs: DataFrame, *paths: str) -> None:
    """Take away all that the jobs (``job_id``) have written below the paths."""
    for path in paths:
        remove_partitions(path, "job_id", jobs)


def write_results(results: DataFrame, path: str) -> None:
    """Write result metadata as JSON lines partitioned by job.

    The rebalance hint gives each job whole files of advisory size and cuts a
    job that would be too big for one task.
    """
    columns = [F.col(ours).alias(theirs) for ours, theirs in RESULT_NAMES.items()]
    rows = results.select("job_id", *columns).hint("rebalance", "job_id")
    # only the jobs in hand are replaced, so a rerun of one job leaves the others
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("job_id").json(path)


def write_summaries(parts: DataFrame, path: str) -> None:
    """Write summary parts as text; a job's files in name order are its HTML.

    Only the jobs in hand are replaced.
    """
    spark = parts.sparkSession
    count = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = parts.repartitionByRange(count, "job_id", "part_no").sortWithinPartitions("job_id", "part_no")
    rows = rows.select("job_id", _without_last_newline("html").alias("html"))
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("job_id").text(path)


def write_messages(messages: DataFrame, path: str, body: str = "body") -> None:
    """Append messages as one JSON text per line."""
    messages.select(F.col(body).alias("value")).write.mode("append").text(path)
