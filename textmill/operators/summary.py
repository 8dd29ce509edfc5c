"""Job summaries: totals and HTML."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textmill.functions.strings import console_link, html_escape

LINES_PER_PART = 1_000


def summary_stats(results: DataFrame) -> DataFrame:
    """Totals per job and method, per job, per method and over all.

    ``level`` is 0 for job and method, 1 for a job, 2 for a method, 3 for all.
    """
    results = results.withColumnRenamed("parsing_method", "method")
    return results.groupingSets(
        [[F.col("job_id"), F.col("method")], [F.col("job_id")], [F.col("method")], []],
        F.col("job_id"),
        F.col("method"),
    ).agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if("success").alias("successes"),
        F.count_if(~F.col("success")).alias("errors"),
        F.grouping_id().cast("int").alias("level"),
    )


def result_html(results: DataFrame) -> Column:
    """Markup of one result row."""
    url = html_escape(F.col("original_url"))
    task = F.concat(
        F.lit("<b>"), html_escape(F.col("parsing_method")), F.lit('</b>: <a href="'), url, F.lit('">'), url, F.lit("</a> ")
    )
    output = F.concat(F.lit('<a href="'), html_escape(console_link(F.col("output_url"))), F.lit('">[Output]</a>'))
    message = F.concat(F.lit("<i>"), html_escape(F.col("error_message")), F.lit("</i>"))
    return F.concat(
        F.when(F.col("success"), F.lit('<p class="ok">')).otherwise(F.lit('<p class="failed">')),
        task,
        F.when(F.col("success"), output).otherwise(message),
        F.lit("</p>\n"),
    )


HEAD = '<!DOCTYPE html>\n<html lang="en"><head><meta charset="UTF-8"><title>Results</title></head><body>\n'
FOOT = "</body></html>\n"


def summary_parts(results: DataFrame, jobs: DataFrame) -> DataFrame:
    """HTML summary of each job as ordered parts ``(job_id, part_no, html)``.

    Joined by ``part_no`` the parts are the document.  A part holds at most
    ``LINES_PER_PART`` lines, so a job of any size never meets in one row or one
    task.  A job without results gets a head with total 0 and a foot.
    """
    lines = results.select("job_id", "line_no", F.col("success"), result_html(results).alias("html"))
    body = (
        lines.groupBy("job_id", (F.floor(F.col("line_no") / LINES_PER_PART) + 1).cast("bigint").alias("part_no"))
        .agg(F.array_sort(F.collect_list(F.struct("line_no", "html"))).alias("lines"))
        .select("job_id", "part_no", F.array_join(F.transform("lines", lambda x: x["html"]), "").alias("html"))
    )
    totals = results.groupBy("job_id").agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if("success").alias("successes"),
        (F.floor(F.max("line_no") / LINES_PER_PART) + 2).cast("bigint").alias("foot_no"),
    )
    total, good = F.coalesce("total", F.lit(0)), F.coalesce("successes", F.lit(0))
    head = F.concat(
        F.lit(HEAD),
        F.format_string("<p>Total: %d | Success: %d | Errors: %d</p>\n", total, good, total - good),
    )
    frame = (
        jobs.select("job_id")
        .join(totals, "job_id", "left")
        .select(
            "job_id",
            F.inline(
                F.array(
                    F.struct(F.lit(0).cast("bigint").alias("part_no"), head.alias("html")),
                    F.struct(F.coalesce("foot_no", F.lit(1).cast("bigint")).alias("part_no"), F.lit(FOOT).alias("html")),
                )
            ),
        )
    )
    return body.unionByName(frame)
