import random
import statistics
from datetime import datetime, timedelta

import pytest

from millrace.operators import runlog

SCHEMA = "run_id string, stage string, status string, duration_seconds double, timestamp timestamp_ntz, row_count bigint, error string"
START = datetime(2024, 1, 1)


@pytest.fixture(scope="module")
def records():
    rng = random.Random(5)
    stages = ["extract"] * 4 + ["load", "quality"]
    return [
        (
            f"r{i // 6:03d}",
            rng.choice(stages),
            rng.choice(["success", "success", "success", "failed"]),
            round(rng.uniform(1, 100), 3),
            START + timedelta(minutes=i),
            rng.choice([None, 0, 10, 500, 1000]),
            None,
        )
        for i in range(400)
    ]


@pytest.fixture(scope="module")
def log(spark, records):
    return spark.createDataFrame(records, SCHEMA).repartition(6)


def last(records, stage, n):
    return [r for r in records if r[1] == stage][-n:]


def test_history_is_the_newest_of_a_stage(log, records):
    got = runlog.stage_history(log, "load", 7).orderBy("timestamp").collect()
    assert [tuple(r) for r in got] == last(records, "load", 7)


def test_stats_use_successes_within_the_window(log, records):
    for r in runlog.stage_stats(log).collect():
        window = last(records, r.stage, 20)
        ok = [x for x in window if x[2] == "success"]
        durations, rows = [x[3] for x in ok], [x[5] or 0 for x in ok]
        assert r.avg_duration == pytest.approx(statistics.mean(durations))
        assert r.std_duration == pytest.approx(statistics.stdev(durations))
        assert r.avg_row_count == pytest.approx(statistics.mean(rows))
        assert r.std_row_count == pytest.approx(statistics.stdev(rows))
        assert r.success_rate == pytest.approx(len(ok) / len(window))


def test_stats_of_a_single_run_and_of_failures_only(spark):
    log = spark.createDataFrame(
        [("a", "x", "success", 5.0, START, 3, None), ("a", "y", "failed", 5.0, START, 3, None)], SCHEMA
    )
    got = {r.stage: tuple(r)[1:] for r in runlog.stage_stats(log).collect()}
    assert got == {"x": (5.0, 0.0, 3.0, 0.0, 1.0), "y": (0.0, 0.0, 0.0, 0.0, 0.0)}


def test_anomalies_are_strictly_outside(spark):
    stats = spark.createDataFrame(
        [("s", 10.0, 2.0, 100.0, 5.0, 1.0), ("flat", 10.0, 0.0, 0.0, 0.0, 1.0)],
        "stage string, avg_duration double, std_duration double, avg_row_count double, "
        "std_row_count double, success_rate double",
    )

    def run(stage, seconds, rows):
        return ("r", stage, "success", seconds, START, rows, None)

    records = spark.createDataFrame(
        [run("s", 16.0, 100), run("s", 16.5, 100), run("s", 3.9, 49), run("s", 10.0, 50),
         run("s", 10.0, 0), run("flat", 99.0, 1), run("other", 99.0, 1)],
        SCHEMA,
    )
    got = sorted((r.metric, r.current_value) for r in runlog.anomalies(records, stats).collect())
    assert got == [("duration", 3.9), ("duration", 16.5), ("row_count", 49.0)]
    text = runlog.anomalies(records, stats).filter("current_value = 16.5").first().message
    assert text == "s: took 16.50 s, usual is 4.00 s to 16.00 s"


def test_dashboard(log, records):
    board = runlog.dashboard(log)
    overall = board.overall.first()
    assert overall.total_executions == len(records)
    good = sum(r[2] == "success" for r in records)
    assert overall.overall_success_rate == pytest.approx(good / len(records))
    for r in board.stages.collect():
        window = last(records, r.stage, 5)
        assert r.last_run.timestamp == window[-1][4]
        assert r.recent_failures == sum(x[2] == "failed" for x in window)
    failures = sorted(tuple(r) for r in board.recent_failures.collect())
    assert failures == sorted(r for r in records[-20:] if r[2] == "failed")


def test_retention_keeps_the_newest(log, records):
    kept = sorted(r.timestamp for r in runlog.retained(log, 50).collect())
    assert kept == [r[4] for r in records[-50:]]


def test_rollup_and_skipped_stages(spark):
    def at(minutes):
        return START + timedelta(minutes=minutes)

    log = spark.createDataFrame(
        [
            ("a", "extract", "success", 1.0, at(0), 1, None),
            ("a", "load", "failed", 1.0, at(2), 1, "boom"),
            ("b", "extract", "success", 1.0, at(0), 1, None),
            ("b", "load", "skipped", 1.0, at(1), 1, None),
        ],
        SCHEMA,
    )
    got = {r.run_id: (r.success, r.stages, r.failed_stages, r.duration_seconds)
           for r in runlog.run_rollup(log).collect()}
    assert got == {"a": (False, 2, 1, 120.0), "b": (True, 2, 0, 60.0)}
    skipped = runlog.skipped_stages(log)
    assert sorted((r.run_id, r.stage, r.status) for r in skipped.collect()) == [
        ("a", "quality", "skipped"), ("a", "transform", "skipped"),
    ]
    both = log.unionByName(skipped)
    assert runlog.run_rollup(both).filter("run_id = 'a'").first().stages == 4
