"""The registered queries: every operator over the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textmill import constants as K
from textmill.functions import strings as S
from textmill.functions.strings import percent_decoded
from textmill.functions.text import word_array
from textmill.operators import annotate as A
from textmill.operators import boundaries, cky, corpus, eisner, fetch, pairs, progress, results, sessions, spans, summary, tagstats, tasks, viterbi
from textmill.operators.skew import PAIRS_BYTES, spread
from textmill.plans import carriers as C
from textmill.plans.job import run_job
from textmill.sinks import objects
from textmill.sinks import tables as sinks
from textmill.sources import documents, manifest, messages, tagged, wordlists
from textmill.sources import results as result_source
from textmill.storage import materialize, scratch_path
from textmill.streaming import completions as live
from textmill.streaming import correlation, routing, sink
from textmill.streaming import idle as live_idle
from textmill.streaming import sessions as live_sessions

BUCKET = "text-results"
MAX_TOKENS = 20
STOP_WORDS = 20
TOP_COLLOCATIONS = 500
#: Bigrams seen less often are not ranked: the ratio says little about them.
LEAST_SEEN = 5
#: Templates less alike are not listed.
LEAST_ALIKE = 0.3
#: Words seen less often are tagged by rule, not by what was seen.
LEARNED_FROM = 5
#: Documents in a text file.
FILE_ROWS = 1_000
THRESHOLDS = [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]
VISIBILITY_STEP_S = 14_400
#: How long a response may take on the stream.
DEADLINE_S = 240

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def query(fn: Query) -> Query:
    """Register ``fn`` under its name; it runs with the session clock on UTC."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return fn(spark, sf_dir)

    REGISTRY[fn.__name__] = run
    return fn


def _plain_ts(df: DataFrame, *columns: str) -> DataFrame:
    """Timestamps without zone, as the given tables have them."""
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in columns})


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(C.table(spark, sf_dir, "documents"), "doc_id")


def _pair_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents for queries that count word pairs."""
    return spread(C.table(spark, sf_dir, "documents"), "doc_id", part_bytes=PAIRS_BYTES)


# manifests and tasks


@query
def manifest_tasks(spark, sf_dir):
    return C.tasks(spark, sf_dir)


@query
def manifest_rejects(spark, sf_dir):
    return manifest.manifest_rejects(C.manifest_lines(spark, sf_dir))


@query
def manifest_scan(spark, sf_dir):
    """Manifests written as text files per job and scanned back."""
    path = scratch_path(spark, "manifests")
    job = F.concat(F.lit("run 1: "), "job_id").alias("job_id")
    lines = C.manifest_lines(spark, sf_dir).select(job, F.col("line").alias("value"))
    lines.write.partitionBy("job_id").text(path)
    return manifest.read_manifest(spark, path).select("job_id", "method", "url")


@query
def task_messages(spark, sf_dir):
    return tasks.task_messages(C.tasks(spark, sf_dir))


@query
def method_validation(spark, sf_dir):
    checked = tasks.with_method_check(C.tasks(spark, sf_dir))
    return checked.select("job_id", "line_no", "method", "valid", "error")


@query
def route_messages(spark, sf_dir):
    return tasks.route_messages(C.as_messages(C.table(spark, sf_dir, "events")))


@query
def job_requests(spark, sf_dir):
    return tasks.job_request_messages(C.jobs(spark, sf_dir))


@query
def task_result_messages(spark, sf_dir):
    return tasks.task_result_messages(_results(spark, sf_dir))


@query
def decode_completions(spark, sf_dir):
    """Result messages of events; every tenth is empty, those of sign-ups are broken."""
    return tasks.decode_completions(C.as_result_messages(C.table(spark, sf_dir, "events")))


@query
def job_sizes(spark, sf_dir):
    return tasks.job_sizes(C.tasks(spark, sf_dir))


# documents and results


@query
def document_scan(spark, sf_dir):
    bodies = _documents(spark, sf_dir).select(C.document_url(F.col("doc_id")).alias("url"), "text")
    pages = C.table(spark, sf_dir, "pages").select("url", F.col("html").alias("text"))
    return documents.body_stats(bodies.unionByName(pages))


@query
def document_files(spark, sf_dir):
    """Documents written as text files below folders with blanks and colons, read back file by file."""
    path = scratch_path(spark, "files")
    folder = F.concat(F.lit("lang: "), "lang").alias("folder")
    bodies = _documents(spark, sf_dir).select(folder, F.col("text").alias("value"))
    bodies.write.option("maxRecordsPerFile", FILE_ROWS).partitionBy("folder").text(path)
    files = documents.read_documents(spark, path)
    # the partition writer escapes the colon in the folder's own name
    name = percent_decoded(F.regexp_extract("url", "folder=([^/]*)/[^/]*$", 1))
    return files.groupBy(name.alias("folder")).agg(F.sum(F.octet_length("text")).cast("bigint").alias("n_bytes"))


@query
def fetch_or_error(spark, sf_dir):
    return fetch.fetch_or_error(C.tasks(spark, sf_dir), C.docs(spark, sf_dir))


def _results(spark: SparkSession, sf_dir: str) -> DataFrame:
    return results.result_rows(fetch.fetch_or_error(C.tasks(spark, sf_dir), C.docs(spark, sf_dir)), BUCKET)


@query
def result_rows(spark, sf_dir):
    return _results(spark, sf_dir)


@query
def result_scan(spark, sf_dir):
    """Result metadata written as JSON and scanned back."""
    path = scratch_path(spark, "results")
    sinks.write_results(_results(spark, sf_dir), path)
    return result_source.read_results(spark, path)


@query
def missing_results(spark, sf_dir):
    """Tasks left over where every eleventh result was lost."""
    kept = _results(spark, sf_dir).where("line_no % 11 <> 0")
    return results.missing_results(C.tasks(spark, sf_dir), kept)


@query
def failure_reasons(spark, sf_dir):
    """Reason per event task: method, time budget, interruption, cause."""
    k = F.get_json_object("props", "$.k").cast("int")
    events = C.table(spark, sf_dir, "events").select(
        F.col("event_id").alias("msg_id"),
        F.when(k % 5 == 0, "NER").otherwise("POS").alias("method"),
        (F.col("event_type") == "error").alias("timed_out"),
        (F.col("event_type") == "signup").alias("interrupted"),
        F.when(F.col("event_type") == "purchase", F.concat(F.lit("HTTP "), (k + 400).cast("string"))).alias("cause"),
    )
    checked = events.withColumn("valid", F.col("method").isin(*K.METHODS))
    return results.failure_reason(checked).select("msg_id", "method", "error")


@query
def output_keys(spark, sf_dir):
    pages = C.table(spark, sf_dir, "pages")
    job, method = F.concat(F.lit("job"), F.col("page_id") % 7), C.document_method(F.col("page_id"))
    return pages.select(
        "page_id",
        S.file_stem(F.col("url")).alias("stem"),
        S.output_key(job, method, F.col("url")).alias("output_key"),
    )


@query
def object_links(spark, sf_dir):
    doc_id = F.col("doc_id")
    key = S.output_key(F.col("source"), C.document_method(doc_id), C.document_url(doc_id))
    url = (
        F.when(doc_id % 4 == 0, F.concat(F.lit(f"s3://{BUCKET}/"), key))
        .when(doc_id % 4 == 1, F.lit(f"s3://{BUCKET}"))
        .when(doc_id % 4 == 2, C.document_url(doc_id))
    )
    rows = _documents(spark, sf_dir).select("doc_id", url.alias("url"))
    return rows.select(
        "doc_id",
        S.object_bucket(F.col("url")).alias("bucket"),
        S.object_key(F.col("url")).alias("object_key"),
        S.console_link(F.col("url")).alias("link"),
    )


@query
def html_escape(spark, sf_dir):
    texts = _documents(spark, sf_dir).select(F.concat(F.lit("d"), "doc_id").alias("id"), "text")
    pages = C.table(spark, sf_dir, "pages").select(F.concat(F.lit("p"), "page_id").alias("id"), F.col("html").alias("text"))
    return texts.unionByName(pages).select("id", S.html_escape(F.col("text")).alias("escaped"))


@query
def summary_stats(spark, sf_dir):
    return summary.summary_stats(_results(spark, sf_dir))


@query
def summary_html(spark, sf_dir):
    stored = materialize(_results(spark, sf_dir), "results")
    return summary.summary_parts(stored, C.jobs(spark, sf_dir))


@query
def summary_scan(spark, sf_dir):
    """Summaries of all jobs, then of one job again, and all read back as lines."""
    path = scratch_path(spark, "summaries")
    stored = materialize(_results(spark, sf_dir), "results")
    jobs = C.jobs(spark, sf_dir)
    sinks.write_summaries(summary.summary_parts(stored, jobs), path)
    one = "job_id = 'src0'"
    sinks.write_summaries(summary.summary_parts(stored.where(one), jobs.where(one)), path)
    lines = spark.read.schema("value string, job_id string").text(path)
    return lines.groupBy("job_id", F.col("value").alias("line")).agg(F.count(F.lit(1)).alias("n"))


@query
def job_run(spark, sf_dir):
    """Totals in the summaries after a whole run and a second one of two jobs, one of them emptied."""
    out = scratch_path(spark, "run")
    docs = spread(C.docs(spark, sf_dir), "url")
    lines = C.manifest_lines(spark, sf_dir).select("job_id", F.col("line").alias("value"))
    lines.write.partitionBy("job_id").text(f"{out}/manifests")
    run_job(spark, f"{out}/manifests", docs, f"{out}/out")
    empty = spark.createDataFrame([("src0", "nothing valid")], "job_id string, value string")
    again = lines.where("job_id = 'src1'").union(empty)
    again.write.partitionBy("job_id").text(f"{out}/manifests-again")
    run_job(spark, f"{out}/manifests-again", docs, f"{out}/out")
    totals = spark.read.schema("value string, job_id string").text(f"{out}/out/summary").where("value LIKE '<p>Total:%'")
    number = {"total": "Total: ([0-9]+)", "successes": "Success: ([0-9]+)"}
    return totals.select(
        "job_id", *[F.regexp_extract("value", p, 1).cast("bigint").alias(c) for c, p in number.items()]
    )


@query
def job_responses(spark, sf_dir):
    """Responses of finished event jobs that the owner of the even jobs keeps."""
    done = progress.completed_jobs(_progress(spark, sf_dir))
    own = C.event_jobs(spark, sf_dir).where("job_id % 4 = 0").select("job_id")
    return tasks.correlate_responses(tasks.job_response_messages(done), own)


# text


@query
def sentences(spark, sf_dir):
    return A.sentence_rows(_documents(spark, sf_dir), "doc_id")


@query
def tokens(spark, sf_dir):
    return A.token_rows(_documents(spark, sf_dir), "doc_id")


@query
def sentence_stats(spark, sf_dir):
    return A.sentence_stats(_documents(spark, sf_dir), "doc_id", C.document_method(F.col("doc_id")), MAX_TOKENS)


def _fetched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fetch.fetch(C.tasks(spark, sf_dir), spread(C.docs(spark, sf_dir), "url"))


@query
def long_sentence_guard(spark, sf_dir):
    return A.guard_lines(_fetched(spark, sf_dir), MAX_TOKENS)


@query
def annotated_text(spark, sf_dir):
    return A.annotated_text(A.annotate(_fetched(spark, sf_dir), MAX_TOKENS))


@query
def tagged_roundtrip(spark, sf_dir):
    """Annotated text written as a table and parsed back to tagged tokens."""
    path = scratch_path(spark, "annotated")
    pos = _fetched(spark, sf_dir).where("method = 'POS'")
    sinks.write_annotated(A.annotated_text(A.annotate(pos)), path)
    return tagged.parse_tagged(spark.read.parquet(path).select("job_id", "line_no", "body"))


@query
def pos_tags(spark, sf_dir):
    docs = _documents(spark, sf_dir)
    lexicon = materialize(tagstats.tag_lexicon(docs).where("n_tags > 1"), "lexicon")
    return A.pos_tags(A.token_rows(docs, "doc_id"), lexicon, ["doc_id", "sent_idx", "pos"], min_total=LEARNED_FROM)


@query
def annotated_objects(spark, sf_dir):
    """Annotated text as one object per task, read back from the objects after a rerun of two jobs."""
    root = scratch_path(spark, "objects")
    rows = materialize(A.annotated_text(A.annotate(_fetched(spark, sf_dir), MAX_TOKENS)), "annotated")
    objects.write_objects(rows, root)
    again = rows.where("job_id in ('src1', 'src2')")
    objects.write_objects(again.where("line_no % 2 = 0"), root, again.select("job_id"))
    return objects.read_objects(spark, root)


@query
def tree_spans(spark, sf_dir):
    """The nodes of chunk trees of all sentences."""
    sentences = cky.tagged_sentences(_documents(spark, sf_dir), "doc_id")
    trees = sentences.select("doc_id", "sent_idx", spans.chunk_tree(F.col("tagged")).alias("tree"))
    return spans.tree_spans(trees, "doc_id", "sent_idx", arrow=True)


@query
def tree_rules(spark, sf_dir):
    """Which labels stand below which, over the chunk trees."""
    sentences = cky.tagged_sentences(_documents(spark, sf_dir), "doc_id")
    trees = sentences.select("doc_id", "sent_idx", spans.chunk_tree(F.col("tagged")).alias("tree"))
    nodes = materialize(spans.tree_spans(trees, "doc_id", "sent_idx", arrow=True), "spans")
    return spans.rule_counts(nodes, "doc_id", "sent_idx")


@query
def tree_scan(spark, sf_dir):
    """Annotated trees written as a table, read back as nodes."""
    path = scratch_path(spark, "annotated")
    todo = _fetched(spark, sf_dir).where("method = 'CONSTITUENCY'")
    sinks.write_annotated(A.annotated_text(A.annotate(todo, MAX_TOKENS)), path)
    trees = spans.annotated_trees(spark.read.parquet(path), "line_no")
    return spans.tree_spans(trees, "line_no", "sent_idx")


@query
def sentences_learned(spark, sf_dir):
    docs = _documents(spark, sf_dir)
    return boundaries.learned_sentences(docs, boundaries.learn_boundaries(docs), "doc_id")


@query
def pos_viterbi(spark, sf_dir):
    docs = _documents(spark, sf_dir)
    return viterbi.context_tags(docs, viterbi.learn_tagger(docs), "doc_id", arrow=True)


@query
def constituency_cky(spark, sf_dir):
    """Trees of all sentences by a grammar learned from them; no SQL: tests enumerate all trees."""
    sentences = materialize(cky.tagged_sentences(_documents(spark, sf_dir), "doc_id"), "tagged")
    return cky.constituency_trees(sentences, cky.learn_grammar(sentences, 2, MAX_TOKENS), MAX_TOKENS)


@query
def dependency_mst(spark, sf_dir):
    """Best projective trees over learned scores; no SQL: tests try all trees of short sentences."""
    parsed = eisner.dependency_trees(cky.tagged_sentences(_documents(spark, sf_dir), "doc_id"))
    return parsed.select("doc_id", "sent_idx", "deps")


@query
def annotate_custom(spark, sf_dir):
    """Words between blanks by a Python annotator that refuses digits."""

    def loader():
        def annotator(sentence: str) -> str:
            if any(c in "0123456789" for c in sentence):
                raise ValueError("digit in sentence")
            return str(len(sentence.split(" ")))

        return annotator

    A.register_annotator("BLANKS", loader)
    rows = A.annotate_custom(A.sentence_rows(_documents(spark, sf_dir), "doc_id"), "BLANKS")
    return rows.select("doc_id", "sent_idx", "value", "error")


@query
def annotate_plugged(spark, sf_dir):
    """Bodies of constituency tasks by a plugged-in parser, under the built-in rules."""

    def loader():
        return lambda sentence: f"({len(sentence.split(' '))})"

    A.register_annotator("COUNTS", loader)
    fetched = materialize(_fetched(spark, sf_dir).where("method = 'CONSTITUENCY'"), "fetched")
    done = A.annotate_with(fetched, {"CONSTITUENCY": "COUNTS"}, MAX_TOKENS)
    return A.annotated_text(done).select("job_id", "line_no", "body")


@query
def tag_counts(spark, sf_dir):
    return tagstats.tag_counts(_documents(spark, sf_dir))


@query
def tag_bigrams(spark, sf_dir):
    return tagstats.tag_bigrams(_documents(spark, sf_dir))


@query
def tag_lexicon(spark, sf_dir):
    return tagstats.tag_lexicon(_documents(spark, sf_dir))


@query
def tree_label_counts(spark, sf_dir):
    return tagstats.tree_label_counts(tagstats.shallow_parses(_documents(spark, sf_dir)))


@query
def tree_tag_words(spark, sf_dir):
    return tagstats.tree_tag_words(tagstats.shallow_parses(_documents(spark, sf_dir)))


@query
def dep_edge_counts(spark, sf_dir):
    return tagstats.dep_edge_counts(tagstats.shallow_parses(_documents(spark, sf_dir)))


# progress


def _progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    return progress.job_progress(C.redelivered(C.completions(spark, sf_dir)), C.event_jobs(spark, sf_dir))


def _registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    return materialize(C.event_jobs(spark, sf_dir), "jobs")


@query
def dedup_completions(spark, sf_dir):
    return _plain_ts(progress.dedup_completions(C.redelivered(C.completions(spark, sf_dir))), "ts")


@query
def job_progress(spark, sf_dir):
    return _progress(spark, sf_dir)


@query
def orphan_completions(spark, sf_dir):
    orphans = progress.orphan_completions(C.completions(spark, sf_dir), _registry(spark, sf_dir))
    return orphans.select("msg_id", "job_id")


@query
def completed_jobs(spark, sf_dir):
    return progress.completed_jobs(_progress(spark, sf_dir))


@query
def pending_tasks(spark, sf_dir):
    return progress.pending_tasks(_progress(spark, sf_dir))


@query
def needed_workers(spark, sf_dir):
    """Manifest jobs of which two thirds of the tasks are through."""
    rows = C.tasks(spark, sf_dir)
    registry = tasks.job_sizes(rows).join(C.jobs(spark, sf_dir), "job_id")
    done = rows.where("line_no % 3 <> 0").groupBy("job_id").agg(F.count(F.lit(1)).alias("done"))
    return progress.needed_workers(progress.job_progress_from_counts(done, registry), cap=18)


@query
def farm_status(spark, sf_dir):
    return progress.farm_status(_progress(spark, sf_dir))


@query
def need_trajectory(spark, sf_dir):
    once = progress.dedup_completions(C.redelivered(C.completions(spark, sf_dir)))
    return _plain_ts(progress.need_trajectory(once, _registry(spark, sf_dir)), "ts")


@query
def completion_times(spark, sf_dir):
    once = progress.dedup_completions(C.redelivered(C.completions(spark, sf_dir)))
    return _plain_ts(progress.completion_times(once, _registry(spark, sf_dir)), "completed_at")


@query
def capacity_plan(spark, sf_dir):
    once = progress.dedup_completions(C.redelivered(C.completions(spark, sf_dir)))
    return _plain_ts(progress.capacity_plan(once, C.event_jobs(spark, sf_dir)), "bucket")


@query
def timeout_flags(spark, sf_dir):
    events = C.table(spark, sf_dir, "events").select("event_id", "user_id", F.col("ts").cast("timestamp").alias("ts"))
    visibility = (F.col("user_id") % 5) * VISIBILITY_STEP_S
    flags = progress.timeout_flags(events, "user_id", ["ts", "event_id"], visibility)
    return flags.select("event_id", "user_id", "duration_s", "budget_s", "timed_out", "error")


@query
def idle_sessions(spark, sf_dir):
    events = C.table(spark, sf_dir, "events").select("user_id", F.col("ts").cast("timestamp").alias("ts"))
    return _plain_ts(sessions.idle_sessions(events, "user_id"), "session_start", "last_event")


# corpus and pairs


def _stop(spark: SparkSession, sf_dir: str) -> DataFrame:
    return materialize(corpus.derived_stopwords(_documents(spark, sf_dir), STOP_WORDS), "stopwords")


@query
def derived_stopwords(spark, sf_dir):
    return corpus.derived_stopwords(_documents(spark, sf_dir), STOP_WORDS)


@query
def stopword_scan(spark, sf_dir):
    """Derived word lists written as text with CRLF ends and scanned back."""
    path = scratch_path(spark, "wordlists")
    words = corpus.derived_stopwords(_documents(spark, sf_dir), STOP_WORDS)
    lines = words.select("lang", F.concat(F.initcap("w"), F.lit("\r")).alias("value"))
    lines.write.partitionBy("lang").text(path)
    return wordlists.read_stopwords(spark, path)


@query
def content_tokens(spark, sf_dir):
    return corpus.content_tokens(_documents(spark, sf_dir), _stop(spark, sf_dir))


@query
def term_frequency(spark, sf_dir):
    return corpus.term_frequency(_documents(spark, sf_dir))


@query
def bigram_counts(spark, sf_dir):
    return corpus.bigram_counts(_pair_documents(spark, sf_dir), _stop(spark, sf_dir))


@query
def collocations(spark, sf_dir):
    counts = corpus.bigram_counts(_pair_documents(spark, sf_dir), _stop(spark, sf_dir))
    return corpus.collocations(materialize(counts, "bigrams"), TOP_COLLOCATIONS, min_count=LEAST_SEEN)


@query
def pair_scan(spark, sf_dir):
    parsed = wordlists.parse_pairs(C.template_lines(spark, sf_dir))
    return parsed.drop("lhs", "rhs")


@query
def pair_files(spark, sf_dir):
    """Template pairs written as a text file, read back and counted."""
    path = scratch_path(spark, "pairs")
    # lines are five times the documents; a file holds those of a bounded part, so none need be split
    C.template_lines(spark, sf_dir).select("value").write.option("compression", "gzip").text(path)
    return wordlists.read_pairs(spark, path).groupBy("p", "q", "swapped").agg(F.count(F.lit(1)).alias("n"))


@query
def pair_symmetry(spark, sf_dir):
    return pairs.pair_symmetry(wordlists.parse_pairs(C.template_lines(spark, sf_dir)))


@query
def path_similarity(spark, sf_dir):
    """Frequent words of neighbouring rank, scored as templates ``X word Y``."""
    words = _stop(spark, sf_dir)
    after = words.select("lang", (F.col("rank") - 1).alias("rank"), F.col("w").alias("q"))
    given = words.select("lang", "rank", F.col("w").alias("p")).join(after, ["lang", "rank"]).select("lang", "p", "q")
    bigrams = materialize(corpus.bigram_counts(_pair_documents(spark, sf_dir)), "bigrams")
    return pairs.path_similarity(bigrams, materialize(given, "pairs"))


@query
def similar_templates(spark, sf_dir):
    """The five most similar templates ``X word Y`` of every word."""
    bigrams = materialize(corpus.bigram_counts(_pair_documents(spark, sf_dir)), "bigrams")
    return pairs.similar_templates(bigrams, 5, LEAST_ALIKE, LEAST_SEEN)


@query
def threshold_sweep(spark, sf_dir):
    """How well the share of distinct words tells the labelled quality."""
    labels = C.table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label"))
    # only labelled documents are cut into words
    labelled = _documents(spark, sf_dir).select("doc_id", "text").join(labels, "doc_id")
    words = labelled.select("label", word_array(F.col("text")).alias("w"))
    share = F.size(F.array_distinct("w")) / F.size("w")
    scored = words.select("label", F.when(F.size("w") > 0, share).otherwise(0.0).alias("score"))
    return pairs.threshold_sweep(scored, THRESHOLDS)


# streams


def _event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = C.table(spark, sf_dir, "events").schema
    # as a glob the path may be a folder or a lone file
    return messages.read_messages(spark, f"{sf_dir}/events.parque[t]", schema)


def _twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream of completions in which every seventh message comes twice."""
    return C.redelivered(C.as_completions(_event_stream(spark, sf_dir)))


@query
def stream_completions(spark, sf_dir):
    table, checkpoint = sink.fresh(spark, "stream-counts")
    live.start_counts(_twice(spark, sf_dir), "1 hour", table, checkpoint).awaitTermination()
    return live.current_counts(spark, table)


@query
def stream_missing_results(spark, sf_dir):
    """Requests whose response did not come within the deadline."""
    table, checkpoint = sink.fresh(spark, "stream-missing")
    missing = correlation.missing_results(_correlated(spark, sf_dir))
    sink.start_append(missing, table, checkpoint).awaitTermination()
    return _plain_ts(spark.read.schema(missing.schema).parquet(table), "sent")


@query
def stream_responses(spark, sf_dir):
    """Requests of the even jobs with their responses."""
    table, checkpoint = sink.fresh(spark, "stream-responses")
    owners = C.event_jobs(spark, sf_dir).where("job_id % 2 = 0")
    answered = correlation.answered_requests(_correlated(spark, sf_dir), owners)
    sink.start_append(answered, table, checkpoint).awaitTermination()
    return _plain_ts(spark.read.schema(answered.schema).parquet(table), "sent", "answered")


def _correlated(spark: SparkSession, sf_dir: str) -> DataFrame:
    requests = C.as_requests(_event_stream(spark, sf_dir))
    responses = C.as_responses(_event_stream(spark, sf_dir))
    return correlation.correlate(requests, responses, DEADLINE_S, "1 hour")


@query
def stream_idle(spark, sf_dir):
    """Users that were silent for half an hour, raised by timers."""
    table, checkpoint = sink.fresh(spark, "stream-idle")
    events = _event_stream(spark, sf_dir).select("user_id", F.col("ts").cast("timestamp").alias("ts"))
    idle = live_idle.stream_idle(events, "user_id", "1 hour")
    sink.start_append(idle, table, checkpoint).awaitTermination()
    return _plain_ts(spark.read.schema(idle.schema).parquet(table), "active_since", "last_event", "idle_since")


@query
def stream_dedup(spark, sf_dir):
    table, checkpoint = sink.fresh(spark, "stream-dedup")
    twice = C.redelivered(C.as_completions(_event_stream(spark, sf_dir)))
    sink.start_append(live.stream_dedup(twice, "1 hour"), table, checkpoint).awaitTermination()
    return _plain_ts(spark.read.parquet(table), "ts")


@query
def stream_job_done(spark, sf_dir):
    table, checkpoint = sink.fresh(spark, "stream-done")
    twice = C.redelivered(C.as_completions(_event_stream(spark, sf_dir)))
    done = live.job_done_events(twice, _registry(spark, sf_dir), "1 hour")
    with sink.session_conf(spark, live.ONLY_DATA_BATCHES):
        run = sink.start_append(done, table, checkpoint)
    run.awaitTermination()
    return spark.read.schema("job_id long, total long").parquet(table)


@query
def stream_sessions(spark, sf_dir):
    """Sessions the stream closed: those the watermark has passed."""
    table, checkpoint = sink.fresh(spark, "stream-sessions")
    events = _event_stream(spark, sf_dir).select("user_id", F.col("ts").cast("timestamp").alias("ts"))
    with sink.session_conf(spark, live_sessions.LOCAL_MERGE):
        run = sink.start_append(live_sessions.stream_sessions(events, "user_id", "1 hour"), table, checkpoint)
    run.awaitTermination()
    return _plain_ts(spark.read.parquet(table), "session_start", "last_event")


@query
def stream_route(spark, sf_dir):
    table, checkpoint = sink.fresh(spark, "stream-route")
    routing.start_routing(C.as_messages(_event_stream(spark, sf_dir)), table, checkpoint).awaitTermination()
    return spark.read.parquet(table).drop("batch")


@query
def stream_needed_workers(spark, sf_dir):
    table, checkpoint = sink.fresh(spark, "stream-workers")
    step = live.workers_step(_registry(spark, sf_dir))
    live.start_counts(_twice(spark, sf_dir), "1 hour", table, checkpoint, step).awaitTermination()
    # one row per batch: the last one is the state of things
    rows = spark.read.parquet(f"{table}/steps")
    return rows.agg(*[F.max_by(c, "batch").alias(c) for c in ("pending", "wanted", "target")])
