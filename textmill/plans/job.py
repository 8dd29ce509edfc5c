"""A whole run: manifest in, annotated text, result rows and summaries out."""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textmill import constants as K
from textmill.functions.text import sentence_array, tagged_array
from textmill.operators.annotate import annotate, annotate_with, annotated_text
from textmill.operators.boundaries import Boundaries
from textmill.operators.boundaries import sentence_array as learned_cut
from textmill.operators.fetch import fetch
from textmill.operators.results import result_rows
from textmill.operators.summary import summary_parts, summary_stats
from textmill.operators.viterbi import Tagger, tagged_by_context
from textmill.sinks.objects import write_objects
from textmill.sinks.tables import write_annotated, write_results, write_summaries
from textmill.sources.manifest import parse_manifest, read_manifest_lines
from textmill.sources.results import read_results
from textmill.storage import materialize, remove_stale


def run_job(
    spark: SparkSession,
    manifest_path: str,
    docs: DataFrame,
    out: str,
    bucket: str = "text-results",
    max_tokens: int = K.MAX_SENTENCE_TOKENS,
    annotators: dict[str, str] | None = None,
    visibility_s: int | None = None,
    jobs: DataFrame | None = None,
    tagger: Tagger | None = None,
    ends: Boundaries | None = None,
    objects: bool = False,
) -> DataFrame:
    """Process all manifests below ``manifest_path`` against ``docs(url, text)``.

    Writes ``out/annotated``, ``out/results`` and ``out/summary`` and returns
    the summary totals.  What the jobs in hand wrote there before is replaced as a
    whole, that of other jobs stays.  A job whose manifest has no valid line gets a summary with total 0.
    ``annotators`` names registered Python annotators for some methods;
    ``visibility_s`` bounds the time they take for a task.  ``jobs(job_id)`` are
    the jobs that get a summary; without it, those whose manifest has a line
    (Spark does not see empty files).  ``tagger`` (of ``viterbi.learn_tagger``) tags by
    context instead of by form, ``ends`` (of ``boundaries.learn_boundaries``) cuts sentences with the
    abbreviations that were learned.  ``objects`` writes one object per task at its
    exact key (``sinks.objects``) instead of a table.
    """
    tag_tokens = partial(tagged_by_context, tagger=tagger) if tagger else tagged_array
    cut_text = partial(learned_cut, model=ends) if ends else sentence_array
    lines = read_manifest_lines(spark, manifest_path)
    tasks = materialize(parse_manifest(lines), "tasks")
    fetched = fetch(tasks, docs)
    if annotators:
        # errors come up while annotating: store that, as both outputs need it
        budget = max(K.MIN_BUDGET_S, visibility_s - K.VISIBILITY_MARGIN_S) if visibility_s else None
        annotated = annotate_with(materialize(fetched, "fetched"), annotators, max_tokens, budget, tag_tokens, cut_text)
        outcomes = annotated = materialize(annotated, "annotated")
    else:
        # built-in annotators do not fail: outcomes need the URLs, not the text
        annotated, outcomes = annotate(fetched, max_tokens, tag_tokens, cut_text), fetched
    jobs = materialize((jobs if jobs is not None else lines).select("job_id").distinct(), "jobs")
    in_hand = materialize(jobs.union(lines.select("job_id")).distinct(), "in-hand")
    text = annotated_text(annotated)
    if objects:
        write_objects(materialize(text, "bodies"), f"{out}/annotated", in_hand)
    else:
        write_annotated(text, f"{out}/annotated")
    write_results(result_rows(outcomes, bucket), f"{out}/results")
    # what the jobs wrote before and not again goes only now: a run that dies leaves old or new output, never none
    remove_stale(f"{out}/results", in_hand, tasks.select("job_id"))
    results = read_results(spark, f"{out}/results").join(in_hand, "job_id", "left_semi")
    if not objects:
        done = results.where("success").select("job_id", F.col("parsing_method").alias("method"))
        remove_stale(f"{out}/annotated", in_hand, done)
    results = results.join(jobs, "job_id", "left_semi")
    write_summaries(summary_parts(results, jobs), f"{out}/summary")
    remove_stale(f"{out}/summary", in_hand, jobs)
    return summary_stats(results)
