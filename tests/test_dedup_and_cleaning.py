import random

import pytest
from pyspark.sql import functions as F

from millrace.operators.cleaning import (
    cast_failures,
    cast_step,
    cast_types,
    dedup_step,
    drop_nulls,
    drop_step,
    fill_nulls,
    fill_step,
    filter_step,
    run_steps,
)
from millrace.operators.dedup import deduplicate, newest_per_key


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture(scope="module")
def repeated(spark):
    rng = random.Random(7)
    # One key, and the NULL key, hold most of the rows.
    data = [(rng.choice([1, 1, 1, 2, 3, None, None]), f"v{i}", i) for i in range(500)]
    return spark.createDataFrame(data, "k bigint, v string, seq bigint"), data


@pytest.mark.parametrize("keep", ["first", "last", "anything"])
def test_dedup_matches_positions(repeated, keep):
    df, data = repeated
    expected = {}
    for k, v, seq in data:
        if keep == "last" or k not in expected:
            expected[k] = (k, v, seq)
    assert rows(deduplicate(df, ["k"], ["seq"], keep)) == sorted(expected.values(), key=repr)


def test_dedup_twice_changes_nothing(repeated):
    df, _ = repeated
    once = deduplicate(df, ["k"], ["seq"])
    assert rows(deduplicate(once, ["k"], ["seq"])) == rows(once)


def test_dedup_does_not_depend_on_partitions(spark):
    data = [(i % 5, i % 3, f"v{i % 7}") for i in range(300)]
    schema = "k int, at int, v string"
    one = spark.createDataFrame(data, schema).coalesce(1)
    many = spark.createDataFrame(list(reversed(data)), schema).repartition(8)
    assert rows(deduplicate(one, ["k"], ["at"])) == rows(deduplicate(many, ["k"], ["at"]))


def test_dedup_limits_rows_before_the_shuffle(repeated):
    df, _ = repeated
    plan = deduplicate(df, ["k"], ["seq"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
    assert plan.count("Exchange") == 1


def test_newest_per_key_drops_rows_without_key(spark):
    df = spark.createDataFrame(
        [(1, "2024-01-01", "a"), (1, "2024-02-01", "b"), (None, "2024-03-01", "c")],
        "id int, _loaded_at string, v string",
    )
    assert rows(newest_per_key(df, "id")) == [(1, "2024-02-01", "b")]


def test_cast_types_skips_absent_columns_and_counts_failures(spark):
    df = spark.createDataFrame([("1", "x"), ("z", " "), (None, "7")], "a string, b string")
    types = {"a": "int", "b": "int", "c": "date"}
    assert cast_types(df, types).columns == ["a", "b"]
    assert rows(cast_types(df, types)) == sorted([(1, None), (None, None), (None, 7)], key=repr)
    assert tuple(df.agg(*cast_failures(df, types)).first()) == (1, 1)


def test_fill_and_drop_treat_blanks_as_missing(spark):
    df = spark.createDataFrame([("a", 1), ("  ", 2), (None, None)], "s string, n int")
    assert rows(fill_nulls(df, {"s": "?", "n": 0, "new": True})) == sorted(
        [("a", 1, True), ("?", 2, True), ("?", 0, True)], key=repr
    )
    assert rows(drop_nulls(df, ["s"])) == [("a", 1)]
    assert rows(drop_nulls(df, [])) == rows(df)
    assert rows(drop_nulls(df, ["absent"])) == []


def test_step_counts_come_from_one_run(spark):
    df = spark.createDataFrame(
        [("1", "5", 1), ("1", "6", 2), ("2", "x", 3), ("3", "9", 4)], "id string, n string, seq int"
    )
    run = run_steps(
        df,
        [
            dedup_step(["id"], ["seq"]),
            cast_step({"n": "int"}),
            drop_step(["n"]),
            filter_step(F.col("n") < 9, "small"),
            fill_step({"s": "x"}),
        ],
        checks=lambda out: out.agg(F.count("*").alias("n")),
        count_rows=True,
    )
    assert rows(run.frame) == [("1", 6, 2, "x")]
    assert [(r.step, r.input_count, r.output_count, r.delta) for r in run.counts()] == [
        ("deduplicate", 4, 3, -1),
        ("cast_types", 3, 3, 0),
        ("drop_nulls", 3, 2, -1),
        ("filter(small)", 2, 1, -1),
        ("fill_nulls", 1, 1, 0),
    ]
    assert run.checks.first().n == 1
    with pytest.raises(ValueError, match="count_rows"):
        run_steps(df, []).counts()
