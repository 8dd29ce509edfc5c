"""Manifest scan: text files of ``method<TAB>url`` lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from textmill.functions.strings import percent_decoded, trimmed
from textmill.operators.skew import fits_broadcast
from textmill.storage import materialize


def _folder(path: str) -> Column:
    """The job a file belongs to; the name of a partition folder is escaped once more."""
    folder = percent_decoded(F.regexp_extract(path, "([^/]*)/[^/]*$", 1))
    value = F.regexp_extract(folder, "^job_id=(.*)$", 1)
    return F.when(folder.startswith("job_id="), percent_decoded(value)).otherwise(folder)


def read_manifest_lines(spark: SparkSession, path: str) -> DataFrame:
    """``(job_id, line_no, line)`` of all files below ``path``.

    Files are split for reading like any text, so a manifest of any size scans
    in parallel.  A line's number is the count of lines in the job's earlier
    splits plus its place in its own split; a job may have several files, which
    count in the order of their names.  The job is the folder that holds the
    file (``input/<job>/input.txt`` or ``job_id=<job>/part-0.txt``).
    """
    raw = materialize(
        spark.read.option("recursiveFileLookup", "true")
        .option("lineSep", "\n")
        .text(path)
        .select(
            F.col("value").alias("line"),
            F.col("_metadata.file_path").alias("_file"),
            F.col("_metadata.file_block_start").alias("_split"),
            F.monotonically_increasing_id().alias("_seq"),
        ),
        "manifest",
    )
    earlier = Window.partitionBy("job_id").orderBy("_file", "_split").rowsBetween(Window.unboundedPreceding, -1)
    splits = (
        raw.groupBy("_file", "_split")
        .agg(F.min("_seq").alias("_first"), F.count(F.lit(1)).alias("_lines"))
        .withColumn("job_id", _folder("_file"))
        .withColumn("_before", F.coalesce(F.sum("_lines").over(earlier), F.lit(0)))
        .drop("_lines")
    )
    if fits_broadcast(splits):
        splits = F.broadcast(splits)
    return raw.join(splits, ["_file", "_split"]).select(
        "job_id",
        (F.col("_before") + F.col("_seq") - F.col("_first")).alias("line_no"),
        "line",
    )


# two tab-separated fields, each with something besides blanks; one match on
# the raw line, so that the filter does not repeat the parsing
VALID_LINE = r"^[^\t]*[^\x00-\x20][^\t]*\t[^\t]*[^\x00-\x20]"


def parse_manifest(lines: DataFrame) -> DataFrame:
    """Tasks ``(job_id, line_no, method, url)`` of the valid lines."""
    fields = lines.where(F.col("line").rlike(VALID_LINE)).select(
        "job_id", "line_no", F.split("line", "\t").alias("_fields")
    )
    return fields.select(
        "job_id",
        "line_no",
        trimmed(F.col("_fields")[0]).alias("method"),
        trimmed(F.col("_fields")[1]).alias("url"),
    )


def manifest_rejects(lines: DataFrame) -> DataFrame:
    """The dropped lines with the reason, ``(job_id, line_no, reason)``.

    Empty fields at the end of a line do not count as fields.
    """
    few = ~F.col("line").rlike(r"\t+[^\t\r]")
    reason = F.when(few, "too few fields").otherwise("empty field")
    rejected = lines.where(~F.col("line").rlike(VALID_LINE))
    return rejected.select("job_id", "line_no", reason.alias("reason"))


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """Tasks ``(job_id, line_no, method, url)`` of all manifests below ``path``."""
    return parse_manifest(read_manifest_lines(spark, path))
