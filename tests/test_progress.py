import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from textmill.operators import progress as P
from textmill.operators.ordered import nth_row, with_position, with_previous
from textmill.operators.sessions import idle_sessions

JOBS = "job_id string, total long, n long"
DONE = "msg_id long, job_id string, success boolean, ts timestamp"
T0 = dt.datetime(2024, 1, 1)


def completions(spark, *counts):
    rows, msg = [], 0
    for job, k in counts:
        for _ in range(k):
            rows.append((msg, job, msg % 2 == 0, T0 + dt.timedelta(seconds=msg)))
            msg += 1
    return spark.createDataFrame(rows, DONE)


@pytest.mark.parametrize(
    "jobs, counts, wanted",
    [
        ([("job1", 10, 1)], [], 10),
        ([("job1", 10, 1)], [("job1", 1)], 9),
        ([("job1", 10, 1), ("job2", 10, 2)], [("job1", 1)], 14),
        ([("job1", 10, 1), ("job2", 10, 2)], [("job1", 9)], 6),
        ([("job1", 10, 1), ("job2", 10, 2)], [("job1", 10)], 5),
        ([("job2", 10, 2)], [("job1", 10)], 5),
        ([("job1", 10, 1), ("job2", 10, 2)], [("job1", 10), ("job2", 10)], 0),
        ([("job3", 10, 3)], [], 4),
    ],
)
def test_workers_wanted(spark, jobs, counts, wanted):
    progress = P.job_progress(completions(spark, *counts), spark.createDataFrame(jobs, JOBS))
    assert P.needed_workers(progress, cap=100).collect()[0].wanted == wanted


def test_cap_and_gauge(spark):
    jobs = spark.createDataFrame([("a", 10, 1), ("b", 2, 4), ("c", 5, 0)], JOBS)
    progress = P.job_progress(completions(spark, ("b", 2), ("x", 3)), jobs)
    row = P.farm_status(progress, cap=6).collect()[0]
    assert (row.active_jobs, row.pending, row.max_n, row.wanted, row.target) == (2, 15, 1, 15, 6)
    empty = P.farm_status(progress.where("false"), cap=6).collect()[0]
    assert (empty.active_jobs, empty.pending, empty.max_n, empty.wanted, empty.target) == (0, 0, 1, 0, 0)


def test_redelivery_does_not_finish_a_job_early(spark):
    once = completions(spark, ("a", 3))
    twice = once.unionByName(once.withColumn("ts", F.col("ts") + F.expr("interval 1 minute")))
    jobs = spark.createDataFrame([("a", 4, 1)], JOBS)
    assert P.completed_jobs(P.job_progress(twice, jobs)).count() == 0
    dedup = P.dedup_completions(twice).orderBy("msg_id").collect()
    assert [(r.msg_id, r.ts) for r in dedup] == [(i, T0 + dt.timedelta(seconds=i)) for i in range(3)]


def hot_events(spark, count=4000, seed=3):
    """One key holds most rows, many of them at the same instant."""
    draw = random.Random(seed)
    rows = []
    for i in range(count):
        key = "hot" if draw.random() < 0.7 else f"k{draw.randrange(50)}"
        when = T0 + dt.timedelta(seconds=draw.choice([0, 0, 5, draw.randrange(86_400)]))
        rows.append((key, when, i))
    draw.shuffle(rows)
    return rows, spark.createDataFrame(rows, "k string, ts timestamp, i long").repartition(7)


def by_key(rows):
    groups = {}
    for row in sorted(rows):
        groups.setdefault(row[0], []).append(row)
    return groups


def test_positions_in_a_hot_key(spark):
    rows, df = hot_events(spark)
    want = {row[2]: n for group in by_key(rows).values() for n, row in enumerate(group, 1)}
    got = with_position(df, ["k"], ["ts", "i"], "n").collect()
    assert {r.i: r.n for r in got} == want and len(got) == len(rows)


def test_previous_in_a_hot_key(spark):
    rows, df = hot_events(spark)
    want = {}
    for group in by_key(rows).values():
        for before, row in zip([None, *group], group):
            want[row[2]] = before and before[1]
    assert {r.i: r.p for r in with_previous(df, ["k"], ["ts", "i"], "p").collect()} == want


def test_nth_row_in_a_hot_key(spark):
    rows, df = hot_events(spark)
    groups = by_key(rows)
    nth = [(k, len(g) if n % 3 else len(g) + 1) for n, (k, g) in enumerate(sorted(groups.items()))]
    want = {(k, n, groups[k][n - 1][2]) for k, n in nth if n <= len(groups[k])}
    got = nth_row(df, ["k"], ["ts", "i"], spark.createDataFrame(nth, "k string, n long"), "n").collect()
    assert {(r.k, r.n, r.i) for r in got} == want and len(got) == len(want)


def test_a_hot_key_spans_slices(spark):
    from textmill.operators.ordered import slice_rows

    rows, df = hot_events(spark)
    sizes = [r["count"] for r in slice_rows(df, ["k"], ["ts", "i"]).rows.groupBy("_slice").count().collect()]
    assert len(sizes) == 4 and max(sizes) < 0.5 * len(rows)


def test_sessions_split_at_exactly_the_gap(spark):
    minutes = [0, 29, 58, 88, 89]  # 88 is exactly 30 after 58
    df = spark.createDataFrame([("u", T0 + dt.timedelta(minutes=m)) for m in minutes], "u string, ts timestamp")
    rows = idle_sessions(df, "u").orderBy("session_start").collect()
    assert [(r.n_events, r.idle_minutes) for r in rows] == [(3, 30), (2, None)]


def test_sessions_against_brute_force(spark):
    rows, df = hot_events(spark, 3000, 9)
    want = set()
    for key, group in by_key(rows).items():
        start = last = None
        n = 0
        for _, when, _ in group:
            if last is None or when - last >= dt.timedelta(minutes=30):
                if last is not None:
                    want.add((key, start, last, n))
                start, n = when, 0
            last, n = when, n + 1
        want.add((key, start, last, n))
    got = idle_sessions(df.select("k", "ts"), "k").collect()
    assert {(r.k, r.session_start, r.last_event, r.n_events) for r in got} == want and len(got) == len(want)


def test_late_completions_are_ignored_by_the_trajectory(spark):
    jobs = spark.createDataFrame([("a", 2, 2)], JOBS)
    rows = P.need_trajectory(completions(spark, ("a", 4)), jobs).orderBy("done").collect()
    assert [(r.done, r.remaining, r.need, r.delta) for r in rows] == [(1, 1, 1, 0), (2, 0, 0, -1)]


def test_capacity_plan_steps(spark):
    done = completions(spark, ("a", 3)).withColumn("ts", F.expr("timestamp'2024-01-01' + make_interval(0,0,0,0,msg_id)"))
    jobs = spark.createDataFrame([("a", 3, 1)], JOBS)
    rows = P.capacity_plan(done, jobs, "1 hour", cap=2).orderBy("bucket").collect()
    assert [(r.wanted, r.target, r.action) for r in rows] == [(2, 2, "up"), (1, 1, "down"), (0, 0, "down")]
