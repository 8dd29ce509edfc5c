import pytest
from pyspark.sql import functions as F

from textmill.operators.results import failure_reason, missing_results, result_rows
from textmill.operators.summary import LINES_PER_PART, summary_parts, summary_stats
from textmill.operators.tasks import correlate_responses, job_response_messages, route_messages, task_messages
from textmill.plans.job import run_job

RESULTS = (
    "job_id string, line_no long, original_url string, parsing_method string, output_url string,"
    " success boolean, error_message string"
)


def test_run_job(spark, tmp_path):
    lines = [f"{m}\thttp://h/{u}.txt" for u in ("one", "two", "gone") for m in ("POS", "CONSTITUENCY", "DEPENDENCY")]
    for job, text in (("j1", "\r\n".join([*lines, "NER\thttp://h/one.txt", ""])), ("j2", "nothing valid\n"), ("j3", "")):
        (tmp_path / "input" / job).mkdir(parents=True)
        (tmp_path / "input" / job / "input.txt").write_bytes(text.encode())
    docs = spark.createDataFrame(
        [("http://h/one.txt", "The dog ran."), ("http://h/two.txt", "A cat. " * 3)], "url string, text string"
    )
    out = str(tmp_path / "out")
    jobs = spark.createDataFrame([("j1",), ("j2",), ("j3",)], "job_id string")
    stats = run_job(spark, str(tmp_path / "input"), docs, out, jobs=jobs)
    total = stats.where("level = 3").collect()[0]
    assert (total.total, total.successes, total.errors) == (10, 6, 4)
    body = spark.read.parquet(f"{out}/annotated").where("method = 'POS' and url = 'http://h/two.txt'").collect()
    assert [r.body for r in body] == ["A/DT cat/NN ./. \n" * 3]
    html = {}
    for path in sorted((tmp_path / "out" / "summary").rglob("part-*.txt")):
        job = path.parent.name.removeprefix("job_id=")
        html[job] = html.get(job, "") + path.read_text()
    assert "Total: 10 | Success: 6 | Errors: 4" in html["j1"] and "Total: 0 " in html["j2"]
    assert html["j3"] == html["j2"]
    assert html["j1"].index("one.txt") < html["j1"].index("two.txt") < html["j1"].index("Document not found")
    assert html["j1"].startswith("<!DOCTYPE html>") and html["j1"].endswith("</body></html>\n")
    assert html["j1"].count("Invalid parsing method: NER") == 1


def test_summary_parts_are_bounded_and_ordered(spark):
    count = 2 * LINES_PER_PART + 5
    rows = spark.range(count).select(
        F.lit("j").alias("job_id"),
        F.col("id").alias("line_no"),
        F.concat(F.lit("u&"), "id").alias("original_url"),
        F.lit("POS").alias("parsing_method"),
        F.lit(None).cast("string").alias("output_url"),
        F.lit(False).alias("success"),
        F.lit("it's").alias("error_message"),
    )
    jobs = spark.createDataFrame([("j",), ("empty",)], "job_id string")
    parts = summary_parts(rows.repartition(5), jobs).collect()
    assert sorted((r.job_id, r.part_no) for r in parts) == [
        ("empty", 0), ("empty", 1), ("j", 0), ("j", 1), ("j", 2), ("j", 3), ("j", 4),
    ]
    text = "".join(r.html for r in sorted(parts, key=lambda r: r.part_no) if r.job_id == "j")
    places = [text.index(f">u&amp;{i}<") for i in (0, 1, LINES_PER_PART, count - 1)]
    assert places == sorted(places) and text.count("it&#39;s") == count


@pytest.mark.parametrize("good, bad", [(3, 0), (9, 0), (2, 1)])
def test_summary_totals(spark, good, bad):
    rows = [("j", i, "u", "POS", "s3://b/k", i < good, None) for i in range(good + bad)]
    row = summary_stats(spark.createDataFrame(rows, RESULTS)).where("level = 1").collect()[0]
    assert (row.total, row.successes, row.errors) == (good + bad, good, bad)


def test_result_keys_hold_the_line(spark):
    df = spark.createDataFrame(
        [("j", 1, "POS", "http://a/f.txt", None), ("j", 2, "POS", "http://b/f.txt", None), ("j", 3, "POS", "x", "why")],
        "job_id string, line_no long, method string, url string, error string",
    )
    rows = result_rows(df, "b").orderBy("line_no").collect()
    assert [r.output_url for r in rows] == ["s3://b/workers-results/j/POS-f-1.txt", "s3://b/workers-results/j/POS-f-2.txt", None]
    assert [(r.success, r.error_message) for r in rows] == [(True, None), (True, None), (False, "why")]
    tasks = df.select("job_id", "line_no", "method", "url")
    assert [r.line_no for r in missing_results(tasks, result_rows(df, "b").where("success")).collect()] == [3]


def test_failure_reason_order(spark):
    df = spark.createDataFrame(
        [(False, True, True, "c"), (True, True, True, "c"), (True, False, True, "c"), (True, False, False, "c"), (True, False, False, None)],
        "valid boolean, timed_out boolean, interrupted boolean, cause string",
    ).withColumn("method", F.lit("m"))
    got = [r.error for r in failure_reason(df).collect()]
    assert got == ["Invalid parsing method: m", "Task Timed Out", "Worker Interrupted", "c", None]


def test_messages_round_trip(spark):
    tasks = spark.createDataFrame([("j", 0, 'P"S', "http://h/ä")], "job_id string, line_no long, method string, url string")
    bodies = task_messages(tasks).select(F.lit(1).alias("msg_id"), "body")
    row = route_messages(bodies).collect()[0]
    assert (row.route, row.job_id, row.method, row.url) == ("task", "j", 'P"S', "http://h/ä")


def test_routes(spark):
    bodies = [
        '{"type":"urlParseRequest","data":null}',
        '{"type":"newTask","data":{"n":3,"jobId":"j"}}',
        '{"type":"newTask","data":{"inputFileS3Key":"k","jobId":"j","new":1}}',
        '{"type":"terminate"}',
        '{"type":"other","data":{}}',
        "{",
        None,
    ]
    df = spark.createDataFrame(list(enumerate(bodies)), "msg_id long, body string")
    rows = route_messages(df).orderBy("msg_id").collect()
    assert [r.route for r in rows] == ["task", "no_data", "job", "control", "unknown_type", "malformed", "malformed"]
    assert (rows[0].job_id, rows[0].method, rows[2].n) == ("unknown", "unknown", 1)


def test_responses_reach_their_owner(spark):
    done = spark.createDataFrame([("mine",), ("other",)], "job_id string")
    own = spark.createDataFrame([("mine",)], "job_id string")
    extra = spark.createDataFrame(
        [("local-app-output-mine", '{"type":"taskComplete","data":null}'), ("local-app-output-mine", '{"type":"x","data":{"jobId":"mine"}}')],
        "reply_to string, body string",
    )
    rows = correlate_responses(job_response_messages(done).unionByName(extra), own).collect()
    assert [tuple(r) for r in rows] == [("mine", "local-app-output-mine", "output/mine_summary.html")]


def test_own_annotator_for_a_method(spark):
    from textmill.operators.annotate import annotate_with, register_annotator

    def loader():
        import time

        def run(sentence):
            if "fail" in sentence:
                raise ValueError("no parse")
            if "sleep" in sentence:
                time.sleep(0.5)
            return "<" + sentence + ">"

        return run

    register_annotator("TEST", loader)
    fetched = spark.createDataFrame(
        [
            ("j", 1, "DEPENDENCY", "u", "one. fail. two.", None),
            ("j", 2, "DEPENDENCY", "u", "one. sleep.", None),
            ("j", 3, "DEPENDENCY", "u", None, "Document not found"),
            ("j", 4, "DEPENDENCY", "u", " ", None),
            ("j", 5, "POS", "u", "Dogs.", None),
        ],
        "job_id string, line_no long, method string, url string, text string, error string",
    )
    rows = annotate_with(fetched, {"DEPENDENCY": "TEST"}, budget_s=0.3).orderBy("line_no").collect()
    assert [(r.line_no, r.body, r.error) for r in rows] == [
        (1, "<one.>\n\n[ERROR: no parse]\n<two.>\n\n", None),
        (2, None, "Task Timed Out"),
        (3, None, "Document not found"),
        (4, "", None),
        (5, "Dogs/NNP ./. \n", None),
    ]


def test_empty_completion_messages_are_dropped(spark):
    from textmill.operators.tasks import decode_completions, task_result_messages

    results = spark.createDataFrame([("j", 1, True), ("j", 2, False)], "job_id string, line_no long, success boolean")
    sent = task_result_messages(results).select(F.col("line_no").alias("msg_id"), "body")
    odd = spark.createDataFrame([(3, '{"type":"x","data":null}'), (4, "{"), (5, '{"data":{"jobId":"j"}}')], sent.schema)
    rows = decode_completions(sent.unionByName(odd)).orderBy("msg_id").collect()
    assert [tuple(r) for r in rows] == [(1, "j", True), (2, "j", False), (5, "j", False)]


def put_manifest(folder, job, *lines):
    (folder / job).mkdir(parents=True)
    (folder / job / "input.txt").write_text("\n".join(lines))


@pytest.mark.parametrize("layout", ["table", "text"])
def test_a_rerun_replaces_its_jobs_and_no_other(spark, tmp_path, layout):
    """Job "a 1" is emptied, "b:2" shrinks, "c" is not in the second run."""
    from textmill.sinks.tables import clear_jobs, write_annotated

    docs = spark.createDataFrame([("u1", "One two."), ("u2", "Three.")], "url string, text string")
    first, second, out = tmp_path / "first", tmp_path / "second", str(tmp_path / "out")
    for job in ("a 1", "b:2", "c"):
        put_manifest(first, job, "POS\tu1", "DEPENDENCY\tu2", "POS\tgone")
    put_manifest(second, "a 1", "nothing valid")
    put_manifest(second, "b:2", "POS\tu2")
    run_job(spark, str(first), docs, out)
    stats = run_job(spark, str(second), docs, out)
    assert [tuple(r) for r in stats.where("level = 1").select("job_id", "total", "successes").collect()] == [("b:2", 1, 1)]
    head = spark.read.schema("value string, job_id string").text(f"{out}/summary").where("value LIKE '<p>Total%'")
    assert {r.job_id: r.value.split(" ")[1] for r in head.collect()} == {"a 1": "0", "b:2": "1", "c": "3"}
    kept = spark.read.schema("line_no long, body string, job_id string, method string").parquet(f"{out}/annotated")
    assert sorted((r.job_id, r.method) for r in kept.collect()) == [("b:2", "POS"), ("c", "DEPENDENCY"), ("c", "POS")]
    # the sink by itself
    rows = spark.createDataFrame(
        [("a", 0, "POS", "x/u1.txt", "A"), ("a", 1, "POS", "x/u2.txt", "B"), ("b", 0, "POS", "x/u1.txt", "C")],
        "job_id string, line_no long, method string, url string, body string",
    )
    path = str(tmp_path / "sink")
    write_annotated(rows, path, layout)
    again = rows.where("job_id = 'a' and line_no = 1")
    clear_jobs(again, path)
    write_annotated(again, path, layout)
    read = spark.read.parquet(path) if layout == "table" else spark.read.text(path).withColumnRenamed("value", "body")
    assert sorted((r.job_id, r.body) for r in read.collect()) == [("a", "B"), ("b", "C")]


def fetched_rows(spark):
    return spark.createDataFrame(
        [
            ("j", 0, "CONSTITUENCY", "u", "A b c d e f. Short one. Next.", None),
            ("j", 1, "CONSTITUENCY", "v", "Fine.", None),
            ("j", 2, "POS", "w", "Plain words.", None),
        ],
        "job_id string, line_no long, method string, url string, text string, error string",
    )


def test_built_in_rules_hold_for_plugged_in_parsers(spark):
    from textmill.operators.annotate import annotate_with, register_annotator

    def loader():
        def parser(sentence):
            if len(sentence.split()) > 3:
                raise AssertionError("the guard let a long sentence through")
            return 7 if sentence == "Next." else f"<{sentence}>"

        return parser

    register_annotator("GUARDED", loader)
    rows = annotate_with(fetched_rows(spark), {"CONSTITUENCY": "GUARDED"}, max_tokens=5).orderBy("line_no").collect()
    assert rows[0].body == "[SKIPPED LONG SENTENCE: 7 words]\n<Short one.>\n\n[ERROR: int instead of text]\n"
    assert rows[1].body == "<Fine.>\n\n" and [r.error for r in rows] == [None, None, None]


def test_a_failing_loader_fails_its_tasks_only(spark):
    from textmill.operators.annotate import annotate_with, register_annotator

    def loader():
        raise OSError("no model here")

    register_annotator("BROKEN", loader)
    rows = annotate_with(fetched_rows(spark), {"CONSTITUENCY": "BROKEN"}).orderBy("line_no").collect()
    assert [r.error for r in rows] == ["Annotator not loaded: no model here"] * 2 + [None]
    assert rows[0].body is None and rows[2].body


def test_the_time_budget_is_of_the_task(spark):
    from textmill.operators.annotate import annotate_with, register_annotator

    def loader():
        import time

        def slow(sentence):
            time.sleep(0.15)
            return sentence

        return slow

    register_annotator("EACH", loader)
    rows = annotate_with(fetched_rows(spark), {"CONSTITUENCY": "EACH"}, budget_s=0.35).orderBy("line_no").collect()
    assert rows[0].error and rows[0].body is None
    assert rows[1].error is None and rows[1].body == "Fine.\n\n"


def test_a_run_that_dies_leaves_the_old_output(spark, tmp_path, monkeypatch):
    from textmill.plans import job

    docs = spark.createDataFrame([("u1", "One two."), ("u2", "Three.")], "url string, text string")
    first, second, out = tmp_path / "first", tmp_path / "second", str(tmp_path / "out")
    put_manifest(first, "a", "POS\tu1", "DEPENDENCY\tu2")
    put_manifest(second, "a", "POS\tu2")

    def state():
        table = spark.read.schema("line_no long, body string, job_id string, method string").parquet(f"{out}/annotated")
        results = spark.read.schema("success boolean, job_id string").json(f"{out}/results")
        return sorted((r.method, r.body) for r in table.collect()), results.count()

    run_job(spark, str(first), docs, out)
    before = state()

    def dies(*_):
        raise RuntimeError("lost")

    for name in ("write_annotated", "write_results"):
        with monkeypatch.context() as patch:
            patch.setattr(job, name, dies)
            with pytest.raises(RuntimeError, match="lost"):
                run_job(spark, str(second), docs, out)
        assert state() == before or name == "write_results"
        # never without output, whatever was written so far
        assert {m for m, _ in state()[0]} == {"POS", "DEPENDENCY"} and state()[1] == 2
    run_job(spark, str(second), docs, out)
    assert [m for m, _ in state()[0]] == ["POS"] and state()[1] == 1


def test_a_run_with_objects(spark, tmp_path):
    from textmill.sinks.objects import read_objects

    docs = spark.createDataFrame([("x/u1.txt", "One two."), ("x/u2.txt", "")], "url string, text string")
    first, second, out = tmp_path / "first", tmp_path / "second", str(tmp_path / "out")
    put_manifest(first, "a", "POS\tx/u1.txt", "POS\tx/u2.txt", "POS\tgone")
    put_manifest(second, "a", "POS\tx/u2.txt")
    run_job(spark, str(first), docs, out, objects=True)
    got = {r.output_key.rpartition("/")[2]: r.body for r in read_objects(spark, f"{out}/annotated").collect()}
    assert sorted(got.values()) == ["", "One/NNP two/NN ./. \n"] and all(k.startswith("POS-u") for k in got)
    run_job(spark, str(second), docs, out, objects=True)
    assert [r.body for r in read_objects(spark, f"{out}/annotated").collect()] == [""]
