import hashlib
import random
from datetime import datetime

from pyspark.sql import functions as F

from millrace.operators.history import merge_history, no_history, repeated_current

SCHEMA = (
    "customer_id bigint, name string, tier string, _effective_from timestamp_ntz, "
    "_effective_to timestamp_ntz, _is_current boolean, _row_hash string"
)
T0, T1, T2 = datetime(2024, 1, 1), datetime(2024, 2, 1), datetime(2024, 3, 1)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def md5(*parts):
    return hashlib.md5("|".join(str(p) for p in parts).encode()).hexdigest()


def merged(existing, incoming, as_of=T2):
    return merge_history(
        existing, incoming, "customer_id", ["tier", "name"], as_of, incoming_order=["customer_id"]
    )


def test_every_kind_of_change(spark):
    existing = spark.createDataFrame(
        [
            (1, "a", "new", T0, T1, False, "old"),
            (1, "a", "active", T1, None, True, "h1"),
            (2, "b", "new", T0, None, True, "h2"),
            (3, "c", "new", T0, None, True, "h3"),
            (4, "d", "new", T0, T1, False, "h4"),
            (None, "n", "new", T0, None, True, "h5"),
            (6, "f", "new", T0, T1, None, "h6"),
        ],
        SCHEMA,
    )
    incoming = spark.createDataFrame(
        [(1, "a", "loyal"), (2, "b", "new"), (4, "d", "new"), (5, "e", None), (None, "n", "old")],
        "customer_id bigint, name string, tier string",
    )
    assert rows(merged(existing, incoming)) == sorted(
        [
            (1, "a", "new", T0, T1, False, "old"),
            (1, "a", "active", T1, T2, False, "h1"),
            (1, "a", "loyal", T2, None, True, md5("a", "loyal")),
            (2, "b", "new", T0, None, True, "h2"),
            (3, "c", "new", T0, None, True, "h3"),
            (4, "d", "new", T0, T1, False, "h4"),
            (4, "d", "new", T2, None, True, md5("d", "new")),
            (5, "e", None, T2, None, True, md5("e", None)),
            (None, "n", "new", T0, T2, False, "h5"),
            (None, "n", "old", T2, None, True, md5("n", "old")),
            (6, "f", "new", T0, T1, None, "h6"),
        ],
        key=repr,
    )


def test_applying_a_batch_twice_changes_nothing_more(spark):
    rng = random.Random(3)
    existing = spark.createDataFrame(
        [(i, f"n{i}", rng.choice("xyz"), T0, None, True, "h") for i in range(60)], SCHEMA
    )
    batch = spark.createDataFrame(
        [(rng.randrange(90), "n", rng.choice("xyz")) for _ in range(200)],
        "customer_id bigint, name string, tier string",
    )
    once = merged(existing, batch, T1)
    assert rows(merged(once, batch, T2)) == rows(once)
    assert repeated_current(once, "customer_id").count() == 0
    current = {r.customer_id for r in once.filter("_is_current").collect()}
    assert current == set(range(60)) | {r.customer_id for r in batch.collect()}


def test_untracked_changes_are_dropped_and_new_columns_are_added(spark):
    existing = spark.createDataFrame(
        [(1, "a", "new", T0, None, True, "h", "note")], SCHEMA + ", remark string"
    )
    incoming = spark.createDataFrame(
        [(1, "a", "new", 9), (2, "b", "new", 8)],
        "customer_id bigint, name string, tier string, score int",
    )
    got = merged(existing, incoming)
    assert got.columns[-2:] == ["remark", "score"]
    by_key = {r.customer_id: r for r in got.collect()}
    assert (by_key[1].remark, by_key[1].score) == ("note", None)
    assert (by_key[2].remark, by_key[2].score) == (None, 8)


def test_one_shuffle_per_side(spark):
    existing = spark.createDataFrame([(1, "a", "new", T0, None, True, "h")], SCHEMA)
    batch = spark.createDataFrame([(1, "a", "x")], "customer_id bigint, name string, tier string")
    plan = merged(existing, batch)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2


def test_repeated_current_lists_keys(spark):
    df = spark.createDataFrame([(1, True), (1, True), (2, True), (2, False)], "k int, _is_current boolean")
    assert rows(repeated_current(df, "k")) == [(1, 2)]
    assert df.filter(F.col("_is_current")).count() == 3


def test_first_merge_opens_every_row(spark):
    batch = spark.createDataFrame([(1, "a", "x"), (2, "b", None)], "customer_id bigint, name string, tier string")
    got = merged(no_history(batch), batch, T1)
    assert rows(got) == [
        (1, "a", "x", T1, None, True, md5("a", "x")), (2, "b", None, T1, None, True, md5("b", None)),
    ]
    assert rows(merged(got, batch, T2)) == rows(got)


def test_repeated_current_versions_are_closed_not_lost(spark):
    existing = spark.createDataFrame(
        [(1, "a", "x", T0, None, True, "h"), (1, "b", "y", T1, None, True, "h"), (2, "c", "z", T0, None, True, "h")],
        SCHEMA,
    )
    batch = spark.createDataFrame([(1, "b", "y")], "customer_id bigint, name string, tier string")
    got = sorted((r.customer_id, r.name, r._effective_to, r._is_current) for r in merged(existing, batch).collect())
    assert got == [(1, "a", T1, False), (1, "b", None, True), (2, "c", None, True)]
