"""Manifests, jobs, documents and messages derived from the given tables.

The given tables hold no job data, so each is read as one: a document is the
target of a manifest line, its source the job; an event is a completion message
of the job named by its user.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textmill.functions.envelope import encode_task_result
from textmill.functions.text import pairs_of, word_array
from textmill.operators.skew import PAIRS_BYTES, spread
from textmill.sources.manifest import parse_manifest

#: Line numbers of the lines without a document start here.
MISSING = 1_000_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def document_method(doc_id: Column) -> Column:
    slot = doc_id % 8
    return (
        F.when(slot <= 2, "POS").when(slot <= 4, "CONSTITUENCY").when(slot <= 6, "DEPENDENCY").otherwise("NER")
    )


def document_url(doc_id: Column) -> Column:
    text = doc_id.cast("string")
    return F.concat(F.lit("https://corpus.example.org/f/"), text, F.lit("/"), text, F.lit("-0.txt"))


def manifest_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One manifest line per document, with the oddities manifests have.

    For every twentieth document there is a further line that names a document which does not exist.
    """
    doc_id = F.col("doc_id")
    method, url = document_method(doc_id), document_url(doc_id)
    line = (
        F.when(doc_id % 50 == 0, F.concat(method, F.lit(" "), url))
        .when(doc_id % 50 == 1, F.concat(F.lit("\t"), url))
        .when(doc_id % 50 == 2, F.concat(method, F.lit("\t"), url, F.lit("\tnote")))
        .otherwise(F.concat(method, F.lit("\t"), url))
    )
    ending = F.when(doc_id % 3 == 0, "\r").otherwise("")
    rows = table(spark, sf_dir, "documents")
    lost = F.concat(method, F.lit("\tmissing/"), doc_id.cast("string"), F.lit(".txt"))
    return rows.select(
        F.col("source").alias("job_id"), doc_id.alias("line_no"), F.concat(line, ending).alias("line")
    ).union(rows.where(doc_id % 20 == 0).select("source", doc_id + MISSING, lost))


def tasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_manifest(manifest_lines(spark, sf_dir))


def docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(url, text)`` of all documents."""
    rows = table(spark, sf_dir, "documents")
    return rows.select(document_url(F.col("doc_id")).alias("url"), "text")


def jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Jobs of the manifest ``(job_id, n)``; some ask for n = 0."""
    sources = table(spark, sf_dir, "documents").select(F.col("source").alias("job_id")).distinct()
    return sources.withColumn("n", F.substring("job_id", 4, 10).cast("int") % 4)


def as_completions(events: DataFrame) -> DataFrame:
    """``(msg_id, job_id, success, ts)`` of events."""
    return events.select(
        F.col("event_id").alias("msg_id"),
        F.col("user_id").alias("job_id"),
        (F.col("event_type") != "error").alias("success"),
        F.col("ts").cast("timestamp").alias("ts"),
    )


def completions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_completions(table(spark, sf_dir, "events"))


def redelivered(completion_rows: DataFrame) -> DataFrame:
    """Completions in which every seventh message arrives twice."""
    return completion_rows.withColumn(
        "_copy", F.explode(F.when(F.col("msg_id") % 7 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    ).drop("_copy")


def event_jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Registry ``(job_id, total, n)`` of the event jobs.

    Half the jobs have a task that never completes; every tenth job is missing.
    """
    events = table(spark, sf_dir, "events").where("user_id % 10 <> 9")
    sizes = events.groupBy(F.col("user_id").alias("job_id")).agg(F.count(F.lit(1)).alias("k"))
    return sizes.select(
        "job_id", (F.col("k") + F.col("job_id") % 2).alias("total"), (F.col("job_id") % 4).alias("n")
    )


def as_messages(events: DataFrame) -> DataFrame:
    """``(msg_id, body)``: a JSON message per event, some broken or empty."""
    event_id, user = F.col("event_id").cast("string"), F.col("user_id").cast("string")
    k = F.get_json_object("props", "$.k").cast("int")
    method = F.when(k % 4 == 0, "POS").when(k % 4 == 1, "CONSTITUENCY").when(k % 4 == 2, "DEPENDENCY").otherwise("NER")
    empty = F.col("event_id") % 10 == 0

    def message(kind: str, data: Column) -> Column:
        payload = F.when(empty, "null").otherwise(data)
        return F.concat(F.lit('{"type":"' + kind + '","sent":1,"data":'), payload, F.lit("}"))

    task = F.concat(
        F.lit('{"parsingMethod":"'), method, F.lit('","url":"https://corpus.example.org/e/'), event_id,
        F.lit('","jobId":"'), user, F.lit('"}'),
    )
    job = F.concat(
        F.lit('{"inputFileS3Key":"input/'), user, F.lit('/input.txt","n":'), (F.col("event_id") % 4).cast("string"),
        F.lit(',"jobId":"'), user, F.lit('"}'),
    )
    kind = F.col("event_type")
    body = (
        F.when(kind == "view", message("urlParseRequest", task))
        .when(kind == "click", message("newTask", job))
        .when(kind == "purchase", F.lit('{"type":"terminate","data":null}'))
        .when(kind == "signup", F.lit('{"type":"ping","data":{}}'))
        .otherwise(F.lit('{"type":'))
    )
    return events.select(F.col("event_id").alias("msg_id"), body.alias("body"))


def as_result_messages(events: DataFrame) -> DataFrame:
    """``(msg_id, body)``: a completion message per event, some broken or empty."""
    body = encode_task_result(F.col("event_type") != "error", F.col("user_id"))
    body = (
        F.when(F.col("event_id") % 10 == 0, '{"type":"urlParseResponse","data":null}')
        .when(F.col("event_type") == "signup", '{"type":"urlParseResponse",')
        .otherwise(body)
    )
    return events.select(F.col("event_id").alias("msg_id"), body.alias("body"))


def as_requests(events: DataFrame) -> DataFrame:
    """``(task_id, job_id, ts)``: every even event is a request."""
    return events.where("event_id % 2 = 0").select(
        F.col("event_id").alias("task_id"), F.col("user_id").alias("job_id"), F.col("ts").cast("timestamp").alias("ts")
    )


def as_responses(events: DataFrame) -> DataFrame:
    """``(task_id, success, ts)``: every odd event answers the one before it, errors answer nothing; every third comes twice."""
    rows = events.where("event_id % 2 = 1 and event_type <> 'error'").select(
        (F.col("event_id") - 1).alias("task_id"),
        (F.col("event_type") != "signup").alias("success"),
        F.col("ts").cast("timestamp").alias("ts"),
        F.explode(F.when(F.col("event_id") % 3 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("_copy"),
    )
    return rows.drop("_copy")


def template_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Template-pair lines ``(doc_id, place, value)`` made of neighbouring words."""
    given = spread(table(spark, sf_dir, "documents"), "doc_id", part_bytes=PAIRS_BYTES)
    words = given.select("doc_id", word_array(F.col("text")).alias("ws"))
    rows = words.select("doc_id", F.posexplode(pairs_of(F.col("ws"))).alias("place", "w"))
    a, b, place = F.col("w.a"), F.col("w.b"), F.col("place")
    p = F.when(place % 4 == 0, F.concat(a, F.lit(" to"))).otherwise(a)
    rhs = F.when(place % 3 == 0, F.concat(F.lit("Y "), b, F.lit(" X"))).otherwise(
        F.concat(F.lit("X "), b, F.lit(" Y"))
    )
    line = F.concat(F.lit("X "), p, F.lit(" Y\t"), rhs, F.when(place % 2 == 0, "\r").otherwise(""))
    return rows.select("doc_id", "place", line.alias("value"))
