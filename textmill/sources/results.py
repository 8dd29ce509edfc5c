"""Result-metadata scan."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

METADATA_SCHEMA = T.StructType(
    [
        T.StructField("originalUrl", T.StringType()),
        T.StructField("parsingMethod", T.StringType()),
        T.StructField("outputS3Url", T.StringType()),
        T.StructField("success", T.BooleanType()),
        T.StructField("errorMessage", T.StringType()),
        T.StructField("lineNo", T.LongType()),
        T.StructField("job_id", T.StringType()),
    ]
)


def _scan(spark: SparkSession, path: str, file_per_result: bool) -> DataFrame:
    schema = T.StructType([*METADATA_SCHEMA.fields, T.StructField("_corrupt_record", T.StringType())])
    rows = spark.read.schema(schema).option("multiLine", file_per_result).json(path)
    # always true; the reader refuses plans that need the corrupt text alone
    return rows.where("length(coalesce(originalUrl, '')) >= 0")


def read_results(spark: SparkSession, path: str, file_per_result: bool = False) -> DataFrame:
    """Decodable result rows; unknown fields are ignored.

    ``file_per_result`` reads folders with one (maybe indented) object per file
    instead of one object per line.
    """
    rows = _scan(spark, path, file_per_result).where("_corrupt_record is null")
    return rows.select(
        "job_id",
        F.col("lineNo").alias("line_no"),
        F.col("originalUrl").alias("original_url"),
        F.col("parsingMethod").alias("parsing_method"),
        F.col("outputS3Url").alias("output_url"),
        F.coalesce("success", F.lit(False)).alias("success"),
        F.col("errorMessage").alias("error_message"),
    )


def read_result_rejects(spark: SparkSession, path: str, file_per_result: bool = False) -> DataFrame:
    """The undecodable records, as text."""
    rows = _scan(spark, path, file_per_result)
    return rows.where("_corrupt_record is not null").select("job_id", F.col("_corrupt_record").alias("record"))
