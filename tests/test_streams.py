import datetime as dt
import time

from textmill.operators.progress import dedup_completions
from textmill.plans import carriers as C
from textmill.sources.messages import read_messages
from textmill.streaming import completions as live
from textmill.streaming import correlation, routing, sink
from textmill.streaming.idle import stream_idle

SCHEMA = "msg_id long, job_id long, success boolean, ts timestamp"
T0 = dt.datetime(2024, 1, 1)


def rows_of(first, last):
    """Messages first..last-1; job 0 holds half of them."""
    return [(i, 0 if i % 2 else i % 10, True, T0 + dt.timedelta(seconds=i)) for i in range(first, last)]


def put(spark, path, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(path)


def stream(spark, path):
    schema = spark.createDataFrame([], SCHEMA).schema
    return read_messages(spark, path, schema, max_files=1)


def test_dedup_over_a_restart(spark, tmp_path):
    source, table, checkpoint = (str(tmp_path / x) for x in ("in", "out", "cp"))
    put(spark, source, rows_of(0, 100) + rows_of(50, 60))
    sink.start_append(live.stream_dedup(stream(spark, source), "1 hour"), table, checkpoint).awaitTermination()
    put(spark, source, rows_of(90, 200))
    sink.start_append(live.stream_dedup(stream(spark, source), "1 hour"), table, checkpoint).awaitTermination()
    got = spark.read.parquet(table)
    assert got.count() == 200 and got.exceptAll(dedup_completions(got)).count() == 0


def test_jobs_are_announced_once_over_a_restart(spark, tmp_path):
    source, table, checkpoint = (str(tmp_path / x) for x in ("in", "out", "cp"))
    jobs = spark.createDataFrame([(0, 100), (2, 20), (4, 21), (6, 5)], "job_id long, total long")

    def run():
        events = live.job_done_events(stream(spark, source), jobs, "1 hour")
        with sink.session_conf(spark, live.ONLY_DATA_BATCHES):
            query = sink.start_append(events, table, checkpoint)
        query.awaitTermination()
        return sorted(tuple(r) for r in spark.read.schema("job_id long, total long").parquet(table).collect())

    put(spark, source, rows_of(0, 100) + rows_of(0, 100))
    assert run() == [(6, 5)]
    put(spark, source, rows_of(80, 200))
    put(spark, source, rows_of(150, 200))
    # job 0 has 100 odd messages and 20 of its own; 2 has 20; 4 lacks one
    assert run() == [(0, 100), (2, 20), (6, 5)]


def test_counts_and_workers_over_a_restart(spark, tmp_path):
    source, table, checkpoint = (str(tmp_path / x) for x in ("in", "t", "c"))
    jobs = spark.createDataFrame([(0, 130, 10), (2, 20, 1)], "job_id long, total long, n long")
    step = live.workers_step(jobs, cap=5)
    for upto in (100, 200):
        put(spark, source, rows_of(upto - 100, upto))
        # what was there before comes once more
        put(spark, source, rows_of(max(0, upto - 150), upto))
        live.start_counts(stream(spark, source), "1 hour", table, checkpoint, step).awaitTermination()
    rows = spark.read.parquet(f"{table}/steps").orderBy("batch").collect()
    assert (rows[-1].pending, rows[-1].wanted, rows[-1].target) == (10, 1, 1)
    assert (rows[0].pending, rows[0].wanted, rows[0].target) == (80, 17, 5)
    counts = {r.job_id: r.done for r in live.current_counts(spark, table).collect()}
    assert counts == {0: 120, 2: 20, 4: 20, 6: 20, 8: 20}
    # only what a repeated batch starts from is kept
    assert len(list((tmp_path / "t" / "counts").glob("batch=*"))) <= 2


def wait_for(check, seconds=60):
    end = time.monotonic() + seconds
    while time.monotonic() < end:
        if check():
            return True
        time.sleep(0.2)
    return False


def test_counts_in_one_query_that_runs_on(spark, tmp_path):
    """Three waves, with redeliveries within and across them, reach a query that never stops by itself."""
    source, table, checkpoint = (str(tmp_path / x) for x in ("in", "t", "c"))
    jobs = spark.createDataFrame([(0, 190, 10), (2, 30, 1)], "job_id long, total long, n long")
    put(spark, source, rows_of(0, 1))
    query = live.start_counts(
        stream(spark, source), "1 hour", table, checkpoint, live.workers_step(jobs, 9), {"processingTime": "200 milliseconds"}
    )
    try:
        for wave, upto in enumerate((100, 200, 300)):
            put(spark, source, rows_of(max(0, upto - 130), upto) + rows_of(upto - 10, upto))

            def counted():
                return sum(r.done for r in live.current_counts(spark, table).collect()) == upto

            assert wait_for(counted), (wave, live.current_counts(spark, table).collect(), query.exception())
            assert query.isActive
        assert {r.job_id: r.done for r in live.current_counts(spark, table).collect()}[0] == 180
        assert wait_for(lambda: any(r.pending == 10 for r in spark.read.parquet(f"{table}/steps").collect()))
    finally:
        query.stop()


def test_a_repeated_batch_counts_once(spark, tmp_path):
    """The driver is lost after a batch was counted and before that was noted: the batch comes again."""
    source, table, checkpoint = (str(tmp_path / x) for x in ("in", "t", "c"))
    for part in ((0, 50), (50, 100)):
        put(spark, source, rows_of(*part))
        live.start_counts(stream(spark, source), "1 hour", table, checkpoint).awaitTermination()
    commits = sorted((tmp_path / "c" / "commits").glob("[0-9]*"), key=lambda p: int(p.name))
    last = int(sorted((tmp_path / "t" / "counts").glob("batch=*"))[-1].name.split("=")[1])
    for path in commits:
        if int(path.name) >= last:
            path.unlink()
            (path.parent / f".{path.name}.crc").unlink(missing_ok=True)
    live.start_counts(stream(spark, source), "1 hour", table, checkpoint).awaitTermination()
    assert sum(r.done for r in live.current_counts(spark, table).collect()) == 100


def test_no_messages_no_counts(spark, tmp_path):
    assert live.current_counts(spark, str(tmp_path / "none")).collect() == []


def test_control_lane_is_written_first(spark, tmp_path):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    source, table = str(tmp_path / "in"), str(tmp_path / "out")
    messages = C.as_messages(events)
    messages.write.parquet(source)
    live_messages = read_messages(spark, source, messages.schema)
    routing.start_routing(live_messages, table, str(tmp_path / "cp")).awaitTermination()
    got = spark.read.parquet(table)
    assert got.count() == events.count()
    assert got.where("(lane = 'control') <> (route = 'control')").count() == 0
    control = max(p.stat().st_mtime for p in (tmp_path / "out" / "lane=control").rglob("_SUCCESS"))
    work = min(p.stat().st_mtime for p in (tmp_path / "out" / "lane=work").rglob("_SUCCESS"))
    assert control <= work


def test_message_stream_to_text(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    bodies = C.as_result_messages(spark.read.parquet("/root/testdata/sf0.001/events.parquet")).select("body")
    bodies.write.parquet(source)
    messages = read_messages(spark, source, bodies.schema)
    sink.start_append(messages, out, str(tmp_path / "cp"), fmt="text").awaitTermination()
    got = spark.read.text(out).withColumnRenamed("value", "body")
    assert got.exceptAll(bodies).count() == 0 and got.count() == bodies.count()


def test_sessions_close_behind_the_watermark(spark, tmp_path):
    from textmill.operators.sessions import idle_sessions
    from textmill.streaming.sessions import stream_sessions

    source, table, checkpoint = (str(tmp_path / x) for x in ("in", "out", "cp"))
    rows = [("a", m) for m in (0, 10, 50, 200)] + [("b", m) for m in (5, 34, 64, 300)]
    df = spark.createDataFrame([(k, T0 + dt.timedelta(minutes=m)) for k, m in rows], "k string, ts timestamp")
    df.write.parquet(source)
    stream = read_messages(spark, source, df.schema)
    sink.start_append(stream_sessions(stream, "k", "1 hour"), table, checkpoint).awaitTermination()
    got = {(r.k, r.session_start, r.last_event, r.n_events) for r in spark.read.parquet(table).collect()}
    limit = T0 + dt.timedelta(minutes=300 - 60 - 30)
    want = {(r.k, r.session_start, r.last_event, r.n_events) for r in idle_sessions(df, "k").collect() if r.last_event <= limit}
    assert got == want and len(got) == 5


REQUEST = "task_id long, job_id long, ts timestamp"
RESPONSE = "task_id long, success boolean, ts timestamp"


def at(minutes):
    return T0 + dt.timedelta(minutes=minutes)


def test_missing_results_over_a_restart(spark, tmp_path):
    """In time, too late, twice, never, to nobody; then a second run that must not report again."""
    asked, answers, table, checkpoint = (str(tmp_path / x) for x in ("q", "r", "out", "cp"))

    def run():
        requests = read_messages(spark, asked, spark.createDataFrame([], REQUEST).schema)
        responses = read_messages(spark, answers, spark.createDataFrame([], RESPONSE).schema)
        rows = correlation.correlate(requests, responses, 600, "30 minutes")
        sink.start_append(rows, table, checkpoint).awaitTermination()
        got = spark.read.schema(rows.schema).parquet(table)
        missing = sorted(r.task_id for r in correlation.missing_results(got).collect())
        found = sorted((r.task_id, r.job_id, r.success) for r in correlation.answered_requests(got).collect())
        return missing, found

    def send(requests, responses):
        spark.createDataFrame(requests, REQUEST).coalesce(1).write.mode("append").parquet(asked)
        spark.createDataFrame(responses, RESPONSE).coalesce(1).write.mode("append").parquet(answers)

    send(
        [(1, 7, at(0)), (2, 7, at(1)), (3, 8, at(2)), (4, 8, at(3)), (5, 9, at(100))],
        [(1, True, at(10)), (2, False, at(2)), (2, False, at(2)), (3, True, at(13)), (99, True, at(5)), (98, True, at(100))],
    )
    # 3 is answered a minute too late, 4 never; of 5 nothing can be said yet
    assert run() == ([3, 4], [(1, 7, True), (2, 7, False)])
    send([(6, 9, at(200))], [(5, True, at(105)), (97, True, at(200))])
    assert run() == ([3, 4], [(1, 7, True), (2, 7, False), (5, 9, True)])
    send([(7, 9, at(400))], [(96, True, at(400))])
    assert run() == ([3, 4, 6], [(1, 7, True), (2, 7, False), (5, 9, True)])
    owners = spark.createDataFrame([(7,)], "job_id long")
    rows = spark.read.schema("task_id long, job_id long, sent timestamp, answered timestamp, success boolean").parquet(table)
    assert {r.task_id for r in correlation.answered_requests(rows, owners).collect()} == {1, 2}


def test_silence_raises_rows(spark, tmp_path):
    """Sessions by hand; late events join them, a gap of exactly 30 minutes parts them, a restart raises nothing twice."""
    source, table, checkpoint = (str(tmp_path / x) for x in ("in", "out", "cp"))
    schema = spark.createDataFrame([], "k string, ts timestamp").schema

    def send(rows):
        spark.createDataFrame([(k, at(m)) for k, m in rows], schema).coalesce(1).write.mode("append").parquet(source)

    def run():
        idle = stream_idle(read_messages(spark, source, schema, max_files=1), "k", "1 hour")
        sink.start_append(idle, table, checkpoint).awaitTermination()
        rows = spark.read.schema(idle.schema).parquet(table).collect()
        return sorted((r.k, r.active_since, r.last_event, r.idle_since, r.n_events) for r in rows)

    def row(k, first, last, n):
        return (k, at(first), at(last), at(last + 30), n)

    send([("a", 0), ("a", 29.5), ("a", 59.5), ("b", 10), ("b", 10), ("a", 100)])
    # the watermark is at 40 now: b fell silent then
    assert run() == [row("b", 10, 10, 2)]
    # an event that comes late joins what was apart: 59.5 and 100 by 80
    send([("a", 80), ("c", 170)])
    got = run()
    assert got == [row("a", 0, 29.5, 2), row("b", 10, 10, 2)]
    send([("c", 400)])
    assert run() == [
        row("a", 0, 29.5, 2), row("a", 59.5, 100, 3), row("b", 10, 10, 2), row("c", 170, 170, 1)
    ]


def test_idle_counts_a_busy_key_in_few_rows(spark, tmp_path):
    source, table, checkpoint = (str(tmp_path / x) for x in ("in", "out", "cp"))
    schema = spark.createDataFrame([], "k long, ts timestamp").schema
    rows = [(1, T0 + dt.timedelta(seconds=i)) for i in range(3000)] + [(2, T0 + dt.timedelta(hours=9))]
    spark.createDataFrame(rows, schema).repartition(3).write.parquet(source)
    idle = stream_idle(read_messages(spark, source, schema), "k", "1 hour")
    sink.start_append(idle, table, checkpoint).awaitTermination()
    (row,) = spark.read.schema(idle.schema).parquet(table).collect()
    assert (row.k, row.n_events, row.last_event) == (1, 3000, T0 + dt.timedelta(seconds=2999))


def test_a_key_has_one_timer():
    """Many stretches of a key wait for one timer, and go together when it rings."""
    import pandas as pd

    from textmill.streaming.idle import _silence

    class Value:
        held = None

        def exists(self):
            return self.held is not None

        def get(self):
            return self.held

        def update(self, value):
            self.held = value

        def clear(self):
            self.held = None

    class Handle:
        def __init__(self):
            self.value, self.timers = Value(), []

        def getValueState(self, *_):
            return self.value

        def registerTimer(self, at):
            self.timers.append(at)

        def deleteTimer(self, at):
            self.timers.remove(at)

    class Now:
        def __init__(self, at):
            self.at = at

        def getCurrentWatermarkInMs(self):
            return self.at

        getExpiryTimeInMs = getCurrentWatermarkInMs

    handle, gap = Handle(), 1_000_000
    keeper = _silence("k", gap)
    keeper.init(handle)
    starts = [i * 5_000_000 for i in range(10)]
    list(keeper.handleInputRows((1,), iter([pd.DataFrame({"first": starts, "last": starts, "n": [1] * 10})]), Now(0)))
    assert handle.timers == [1000]
    handle.timers.remove(1000)
    (out,) = keeper.handleExpiredTimer((1,), Now(21_000), Now(1000))
    assert out["first"].tolist() == starts[:5] and handle.timers == [26_000]
    # an earlier stretch moves the timer
    list(keeper.handleInputRows((1,), iter([pd.DataFrame({"first": [23_000_000], "last": [23_000_000], "n": [1]})]), Now(0)))
    assert handle.timers == [24_000]
