import json

from pyspark.sql import functions as F

from textmill.functions.strings import trimmed
from textmill.operators.annotate import annotate, annotated_text
from textmill.sinks.tables import write_annotated, write_messages, write_results, write_summaries
from textmill.sources.documents import read_documents
from textmill.sources.manifest import manifest_rejects, parse_manifest, read_manifest, read_manifest_lines
from textmill.sources.results import read_result_rejects, read_results
from textmill.sources.tagged import parse_tagged, read_tagged
from textmill.sources.wordlists import PAIR_LINE, parse_pairs, read_pairs, read_stopwords


def put(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(text.encode("utf-8"))
    return str(path)


def test_manifest_lines_and_rejects(spark, tmp_path):
    text = (
        "POS\thttp://h/a.txt\r\n"
        "no tab here\r\n"
        "\thttp://h/b.txt\n"
        "POS\t\r\n"
        "POS\t \n"
        " DEPENDENCY \t http://h/c.txt \textra\t\n"
        "\n"
        "\t\thttp://h/d.txt\n"
        "CONSTITUENCY\thttp://h/e.txt"
    )
    put(tmp_path / "j1" / "input.txt", text)
    rows = read_manifest(spark, str(tmp_path)).orderBy("line_no").collect()
    assert [tuple(r) for r in rows] == [
        ("j1", 0, "POS", "http://h/a.txt"),
        ("j1", 5, "DEPENDENCY", "http://h/c.txt"),
        ("j1", 8, "CONSTITUENCY", "http://h/e.txt"),
    ]
    bad = manifest_rejects(read_manifest_lines(spark, str(tmp_path))).orderBy("line_no").collect()
    assert [(r.line_no, r.reason) for r in bad] == [
        (1, "too few fields"),
        (2, "empty field"),
        (3, "too few fields"),
        (4, "empty field"),
        (6, "too few fields"),
        (7, "empty field"),
    ]


def test_line_numbers_over_many_splits(spark, tmp_path):
    for job, count in (("a", 3000), ("b", 1)):
        put(tmp_path / job / "input.txt", "".join(f"POS\thttp://h/{job}/{i}\r\n" for i in range(count)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        tasks = read_manifest(spark, str(tmp_path))
        wrong = tasks.where(F.substring_index("url", "/", -1).cast("long") != F.col("line_no")).count()
        assert (tasks.count(), wrong) == (3001, 0)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_line_numbers_go_on_over_the_files_of_a_job(spark, tmp_path):
    put(tmp_path / "job_id=j" / "part-1.txt", "POS\thttp://h/3\n")
    put(tmp_path / "job_id=j" / "part-0.txt", "POS\thttp://h/0\n\nPOS\thttp://h/2\n")
    rows = read_manifest(spark, str(tmp_path)).collect()
    assert sorted((r.job_id, r.line_no, r.url) for r in rows) == [("j", i, f"http://h/{i}") for i in (0, 2, 3)]


def test_documents_keep_whole_text(spark, tmp_path):
    put(tmp_path / "d" / "x.txt", "Zeile eins.\r\nZwei: größer\n")
    row = read_documents(spark, str(tmp_path)).collect()[0]
    assert row.text == "Zeile eins.\r\nZwei: größer\n" and row.url.endswith("/d/x.txt")


def test_stopwords(spark, tmp_path):
    put(tmp_path / "lang=en" / "w.txt", "The\r\nof\r\n\r\nthe\r\n")
    put(tmp_path / "lang=he" / "w.txt", "של\r\n״\r\n5\r\n")
    rows = {tuple(r) for r in read_stopwords(spark, str(tmp_path)).collect()}
    assert rows == {("en", "the"), ("en", "of"), ("he", "של"), ("he", "״"), ("he", "5")}


def test_pairs(spark, tmp_path):
    path = put(tmp_path / "p.txt", "X grow from Y\tY grow X\r\nX eat Y\tX look at Y\r\nbroken\r\nX Y\tX a Y\r\n")
    rows = read_pairs(spark, path).orderBy("p").collect()
    assert [(r.p, r.q, r.p_verb, r.p_prep, r.q_verb, r.q_prep, r.swapped) for r in rows] == [
        ("eat", "look at", "eat", "", "look", "at", False),
        ("grow from", "grow", "grow", "from", "grow", "", True),
    ]


def test_results_skip_what_cannot_be_read(spark, tmp_path):
    good = {"originalUrl": "u", "parsingMethod": "POS", "outputS3Url": None, "success": False, "errorMessage": "e"}
    put(tmp_path / "job_id=7a" / "1.json", json.dumps({**good, "other": 1}, indent=1))
    put(tmp_path / "job_id=7a" / "2.json", "{oops")
    rows = read_results(spark, str(tmp_path), file_per_result=True).collect()
    assert [(r.job_id, r.original_url, r.success, r.error_message) for r in rows] == [("7a", "u", False, "e")]
    assert read_result_rejects(spark, str(tmp_path), file_per_result=True).collect()[0].record == "{oops"


def test_result_sink_replaces_only_its_jobs(spark, tmp_path):
    def rows(job, good):
        return spark.createDataFrame(
            [(job, 1, "u", "POS", None, good, None)],
            "job_id string, line_no long, original_url string, parsing_method string, output_url string,"
            " success boolean, error_message string",
        )

    path = str(tmp_path / "r")
    write_results(rows("a", False).unionByName(rows("b", False)), path)
    write_results(rows("a", True), path)
    got = {(r.job_id, r.line_no, r.success) for r in read_results(spark, path).collect()}
    assert got == {("a", 1, True), ("b", 1, False)}


def test_tagged_tokens_may_hold_slashes(spark):
    df = spark.createDataFrame([(1, "and/or/CC x/NN \n\n[SKIPPED LONG SENTENCE: 9 words]\ny/NN \n")], "d int, body string")
    rows = parse_tagged(df).orderBy("sent_idx", "pos").collect()
    assert [(r.sent_idx, r.pos, r.tok, r.tag) for r in rows] == [(0, 0, "and/or", "CC"), (0, 1, "x", "NN"), (3, 0, "y", "NN")]


def test_annotated_objects_keep_colliding_keys(spark, tmp_path):
    fetched = spark.createDataFrame(
        [("j", 1, "POS", "http://a/f.txt", "One two.", None), ("j", 2, "POS", "http://b/f.txt", "Three!", None)],
        "job_id string, line_no long, method string, url string, text string, error string",
    )
    path = str(tmp_path / "out")
    write_annotated(annotated_text(annotate(fetched)), path, layout="objects")
    files = sorted(str(p.relative_to(path)) for p in (tmp_path / "out").rglob("*.txt"))
    assert [f.rsplit("/", 1)[0] for f in files] == ["job_id=j/method=POS/file=f-1", "job_id=j/method=POS/file=f-2"]
    words = {r.tok for r in read_tagged(spark, path).collect()}
    assert words == {"One", "two", ".", "Three", "!"}


def test_summary_files_in_name_order_are_the_document(spark, tmp_path):
    parts = spark.createDataFrame(
        [("j", i, f"<{i}>\n") for i in range(40)], "job_id string, part_no long, html string"
    ).repartition(3)
    write_summaries(parts, str(tmp_path / "s"))
    files = sorted((tmp_path / "s" / "job_id=j").glob("part-*.txt"))
    assert "".join(f.read_text() for f in files) == "".join(f"<{i}>\n" for i in range(40))


def test_message_sink(spark, tmp_path):
    write_messages(spark.createDataFrame([('{"type":"x"}',)], "body string"), str(tmp_path / "m"))
    assert [r.value for r in spark.read.text(str(tmp_path / "m")).collect()] == ['{"type":"x"}']


def test_parse_manifest_trims_control_characters(spark):
    df = spark.createDataFrame([("j", 0, "\x01POS \t\x0bhttp://h/a\x00")], "job_id string, line_no long, line string")
    assert [tuple(r) for r in parse_manifest(df).collect()] == [("j", 0, "POS", "http://h/a")]


def test_names_with_blanks_and_signs(spark, tmp_path):
    from textmill.sources.documents import read_documents
    from textmill.sources.manifest import read_manifest

    (tmp_path / "d").mkdir()
    for name in ("a b.txt", "50%.txt", "x+y.txt"):
        (tmp_path / "d" / name).write_text(name)
    got = {r.url.rsplit("/", 1)[1]: r.text for r in read_documents(spark, str(tmp_path / "d")).collect()}
    assert got == {n: n for n in ("a b.txt", "50%.txt", "x+y.txt")}
    rows = spark.createDataFrame([("job: 2/3", "POS\tu")], "job_id string, value string")
    rows.write.partitionBy("job_id").text(str(tmp_path / "m"))
    (tmp_path / "n" / "job one").mkdir(parents=True)
    (tmp_path / "n" / "job one" / "input.txt").write_text("POS\tu")
    for folder, job in (("m", "job: 2/3"), ("n", "job one")):
        assert [r.job_id for r in read_manifest(spark, str(tmp_path / folder)).collect()] == [job]


def test_pair_lines_of_two_bare_sides_need_no_pattern(spark):
    """They are told by their bytes; all others as the pattern says, whatever stands between and behind the sides."""
    lines = [
        "X a Y\tX b Y", "X a Y\tY b X\r", " X a to Y \t\x01X b Y", "X a Y\tX b Y\tnote", "X a Y\tX b Y\tno\rte", "X a Y\tX b Y\tnote\r",
        "X  Y\tX b Y", "X   Y\tX b Y", "X Y\tX b Y", "X a Y", "X a Y\t", "\tX a Y", "X a Y\t\tX b Y", "X a Y\tX b Y\r\r", "X a Y\tX b Y\u2028",
        "X a Y\u0085\tX b Y", "X \u00e9\U0001f600 Y\tY \u00e8 Y", "Z a Y\tX b Y", "X a\rb Y\tX c\u2028d X", "\rX a Y\tX b Y", "X a Y\tX b Y\t", "", None,
    ]
    df = spark.createDataFrame(list(enumerate(lines)), "i int, value string")
    side = F.split("value", "\t")
    kept = df.where(F.col("value").rlike(PAIR_LINE)).select("i", trimmed(side[0]).alias("lhs"), trimmed(side[1]).alias("rhs"))
    want = [tuple(r) for r in kept.orderBy("i").collect()]
    parsed = parse_pairs(df)
    assert [tuple(r) for r in parsed.select("i", "lhs", "rhs").orderBy("i").collect()] == want and len(want) > 8
    plan = parsed._jdf.queryExecution().optimizedPlan().toString()
    assert "THEN true ELSE RLIKE" in plan


def test_pair_lines_are_stored_packed(spark, tmp_path, monkeypatch):
    """The text file of template pairs takes less disk than its lines have bytes, and gives the same rows."""
    from textmill.plans import carriers, queries

    docs = [(i, "the dog saw the cat and the bird " * 50) for i in range(20)]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    monkeypatch.setattr(queries, "scratch_path", lambda spark, label: f"{tmp_path}/{label}")
    got = queries.REGISTRY["pair_files"](spark, str(tmp_path)).collect()
    lines = carriers.template_lines(spark, str(tmp_path))
    want = parse_pairs(lines).groupBy("p", "q", "swapped").count().collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, want))
    n_bytes = sum(len(r["value"]) + 1 for r in lines.collect())
    assert sum(f.stat().st_size for f in (tmp_path / "pairs").glob("part-*")) * 2 < n_bytes
