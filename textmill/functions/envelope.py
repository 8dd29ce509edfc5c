"""JSON envelopes ``{type, data{...}}`` as columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textmill import constants as K


def _envelope(data: T.StructType) -> T.StructType:
    return T.StructType([T.StructField("type", T.StringType()), T.StructField("data", data)])


TASK_RESULT_SCHEMA = _envelope(
    T.StructType([T.StructField("success", T.BooleanType()), T.StructField("jobId", T.StringType())])
)
RESPONSE_SCHEMA = _envelope(
    T.StructType([T.StructField("jobId", T.StringType()), T.StructField("summaryS3Key", T.StringType())])
)
# one schema that reads every message a worker or coordinator may receive
ANY_SCHEMA = _envelope(
    T.StructType(
        [
            T.StructField("parsingMethod", T.StringType()),
            T.StructField("url", T.StringType()),
            T.StructField("jobId", T.StringType()),
            T.StructField("inputFileS3Key", T.StringType()),
            T.StructField("n", T.IntegerType()),
        ]
    )
)


def encode(kind: str, **data: Column) -> Column:
    """JSON text of an envelope; null fields are kept, as null."""
    body = F.struct(*[value.alias(name) for name, value in data.items()])
    return F.to_json(F.struct(F.lit(kind).alias("type"), body.alias("data")), {"ignoreNullFields": "false"})


def encode_task(method: Column, url: Column, job_id: Column) -> Column:
    return encode(K.TYPE_TASK, parsingMethod=method, url=url, jobId=job_id.cast("string"))


def encode_job(input_key: Column, n: Column, job_id: Column) -> Column:
    return encode(K.TYPE_NEW_JOB, inputFileS3Key=input_key, n=n.cast("int"), jobId=job_id.cast("string"))


def encode_task_result(success: Column, job_id: Column) -> Column:
    return encode(K.TYPE_TASK_RESULT, success=success, jobId=job_id.cast("string"))


def encode_response(job_id: Column, summary_key: Column) -> Column:
    return encode(K.TYPE_JOB_DONE, jobId=job_id.cast("string"), summaryS3Key=summary_key)


def decode(body: Column, schema: T.StructType) -> Column:
    """Struct of an envelope; unknown fields are ignored, bad JSON gives nulls."""
    return F.from_json(body, schema)
