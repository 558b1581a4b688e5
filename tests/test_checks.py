from datetime import date

import pytest

from millrace.operators import column_tests as ct
from millrace.operators.record_checks import check_completeness, check_freshness, check_unique_key
from millrace.operators.source_checks import (
    Check,
    check_metrics,
    default_checks,
    require_passed,
    results_frame,
    run_checks,
    summarize,
)
from millrace.sources import read_csv


def texts(spark, column, values):
    return spark.createDataFrame([(v,) for v in values], f"`{column}` string")


def result(spark, df, kind, column=None, threshold=None, params=None, **others):
    check = Check("s", kind, column, threshold, params=params or {})
    return run_checks(spark, {"s": df, **others}, [check])[0]


@pytest.mark.parametrize(
    ("values", "threshold", "passed", "rate"),
    [
        (["1", "2", "3"], 0.0, True, 0.0),
        (["", "", ""], 0.0, False, 1.0),
        (["1", "", "3", "4"], 0.3, True, 0.25),
        (["1", None, "3", "4"], 0.1, False, 0.25),
        ([], 0.0, False, 1.0),
        (["  ", "1"], 0.0, False, 0.5),
    ],
)
def test_null_rate(spark, values, threshold, passed, rate):
    r = result(spark, texts(spark, "id", values), "null_rate", "id", threshold)
    assert (r.passed, r.metric_value) == (passed, rate)


def test_null_rate_of_an_absent_column(spark):
    r = result(spark, texts(spark, "name", ["a", "b"]), "null_rate", "id", 0.0)
    assert (r.passed, r.metric_value) == (False, 1.0)
    assert "id is no column" in r.message


@pytest.mark.parametrize(("n", "limit", "passed"), [(100, 10, True), (10, 10, True), (1, 10, False), (0, 1, False)])
def test_row_count_min(spark, n, limit, passed):
    r = result(spark, spark.range(n), "row_count_min", threshold=limit)
    assert (r.passed, r.metric_value) == (passed, float(n))


@pytest.mark.parametrize(
    ("columns", "expected", "passed", "rate"),
    [
        (["id", "name", "email"], ["id", "name", "email"], True, 1.0),
        (["id", "name", "email", "extra"], ["id", "name", "email"], True, 1.0),
        (["id", "name"], ["id", "name", "email"], False, 2 / 3),
        (["id"], [], True, 1.0),
    ],
)
def test_schema_match(spark, columns, expected, passed, rate):
    df = spark.createDataFrame([], ", ".join(f"{c} string" for c in columns))
    r = result(spark, df, "schema_match", params={"expected_columns": expected})
    assert (r.passed, r.metric_value) == (passed, pytest.approx(rate))
    assert ("email" in r.message) == (not passed)
    assert ("surplus" in r.message and "extra" in r.message) == ("extra" in columns)


@pytest.mark.parametrize(
    ("values", "passed", "rate"),
    [(["1", "2", "3"], True, 0.0), (["1", "1", "2"], False, 1 / 3), ([], True, 0.0),
     (["", None, "1"], False, 1 / 3), (["1", " 1"], True, 0.0)],
)
def test_uniqueness(spark, values, passed, rate):
    r = result(spark, texts(spark, "id", values), "uniqueness", "id")
    assert (r.passed, r.metric_value) == (passed, pytest.approx(rate))


@pytest.mark.parametrize(
    ("values", "passed", "rate"),
    [(["active", " inactive "], True, 0.0), (["active", "unknown"], False, 0.5),
     (["active", ""], True, 0.0), (["Active", "active", "", None], False, 0.25), ([], True, 0.0)],
)
def test_accepted_values(spark, values, passed, rate):
    df = texts(spark, "status", values)
    r = result(spark, df, "accepted_values", "status", params={"values": ["active", "inactive"]})
    assert (r.passed, r.metric_value) == (passed, rate)


def test_sample_shows_the_first_five_values(spark):
    df = texts(spark, "status", ["z", "b", "b", "a", "c", "e", "d", "ok"])
    r = result(spark, df, "accepted_values", "status", params={"values": ["ok"]})
    assert r.message.endswith("status: 7 of 8 (87.50%), limit 0.00%, such as a, b, c, d, e")


@pytest.mark.parametrize(
    ("keys", "known", "passed", "rate"),
    [(["1", "2"], ["1", "2", "3"], True, 0.0), (["1", "99", "99"], ["1", "2"], False, 0.5),
     ([], ["1"], True, 0.0), (["10", "20"], ["1", "2"], False, 1.0), (["", " 1 "], ["1", ""], True, 0.0)],
)
def test_referential_integrity(spark, keys, known, passed, rate):
    r = result(
        spark,
        texts(spark, "order_id", keys),
        "referential_integrity",
        "order_id",
        params={"reference_source": "p", "reference_column": "id"},
        p=texts(spark, "id", known),
    )
    assert (r.passed, r.metric_value) == (passed, rate)
    assert ("99" in r.message) == ("99" in keys)


def test_dispatch_of_failures(spark):
    df = texts(spark, "id", ["1"])
    checks = [
        Check("missing", "null_rate", "id", 0.0, "warning"),
        Check("missing", "row_count_min", threshold=1),
        Check("s", "nonexistent", severity="warning"),
        Check("s", "referential_integrity", "id", params={"reference_source": "nope"}),
        Check("s", "null_rate", "id", 0.0),
    ]
    got = run_checks(spark, {"s": df}, checks)
    assert [r.check_name for r in got] == [
        "null_rate:missing.id",
        "row_count_min:missing.*",
        "nonexistent:s",
        "referential_integrity:s.id",
        "null_rate:s.id",
    ]
    assert [r.passed for r in got] == [False, False, False, False, True]
    assert [r.severity for r in got] == ["warning", "error", "error", "error", "error"]
    assert "not found" in got[0].message and "unknown" in got[2].message
    summary = summarize(results_frame(spark, got)).first()
    assert tuple(summary) == (5, 1, 3, 1)
    with pytest.raises(RuntimeError, match="3 critical"):
        require_passed(got)


def test_a_broken_source_does_not_hide_the_others(spark):
    broken = spark.range(3).selectExpr("cast(raise_error('boom') as string) as id")
    checks = [Check("bad", "null_rate", "id", 0.0, "warning"), Check("ok", "null_rate", "id", 0.0)]
    got = run_checks(spark, {"bad": broken, "ok": texts(spark, "id", ["1"])}, checks)
    assert [(r.passed, r.severity) for r in got] == [(False, "error"), (True, "error")]
    assert got[0].check_name == "null_rate:bad" and "exception" in got[0].message


def test_default_suite_on_clean_files(spark, tmp_path):
    statuses = ["placed", "completed", "shipped", "returned", "return_pending"]
    methods = ["credit_card", "bank_transfer", "coupon", "gift_card"]
    files = {
        "orders": ["id,user_id,order_date,status"]
        + [f"{i},{i},2018-01-{i:02d},{statuses[i % 5]}" for i in range(1, 11)],
        "customers": ["id,first_name,last_name"] + [f"{i},F{i},L{i}" for i in range(1, 11)],
        "payments": ["id,order_id,payment_method,amount"]
        + [f"{i},{i},{methods[i % 4]},{i}00" for i in range(1, 11)],
    }
    for name, lines in files.items():
        (tmp_path / f"{name}.csv").write_text("\n".join(lines) + "\n")
    sources = {n: read_csv(spark, str(tmp_path / f"{n}.csv")) for n in files}
    checks = default_checks()
    assert len(checks) == 22
    assert [r.check_name for r in run_checks(spark, sources) if not r.passed] == []


def test_one_scan_per_source(spark, tmp_path):
    path = str(tmp_path / "t")
    texts(spark, "id", ["1", "2"]).write.parquet(path)
    checks = [
        Check("s", "null_rate", "id", 0.0),
        Check("s", "uniqueness", "id"),
        Check("s", "row_count_min", threshold=1),
        Check("s", "accepted_values", "id", params={"values": ["1"]}),
    ]
    plan = check_metrics(spark, {"s": spark.read.parquet(path)}, checks)
    assert plan._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1


def test_completeness(spark):
    df = spark.createDataFrame([("a", 1), (" ", 2), ("c", None), ("d", 4)], "s string, n int")
    r = check_completeness(df, ["s", "n"], 0.5).first()
    assert (r.passed, r.metric_value) == (True, 0.5)
    assert r.message == "complete in s, n: 2 of 4 (50.00%), limit 50.00%"
    assert not check_completeness(df, ["s", "absent"]).first().passed
    empty = check_completeness(df.limit(0), ["s"]).first()
    assert (empty.passed, empty.metric_value, empty.message) == (False, 0.0, "complete in s: nothing to check")


def test_unique_key_counts_nulls_as_equal(spark):
    df = spark.createDataFrame([(1, None), (1, None), (1, "a"), (2, "a")], "a int, b string")
    r = check_unique_key(df, ["a", "b"]).first()
    assert (r.passed, r.metric_value) == (False, 0.25)
    assert check_unique_key(df.limit(0), ["a"]).first().passed


def test_freshness(spark):
    reference = date(2024, 1, 10)
    df = texts(spark, "d", ["2024-01-01", " 2024-01-05 ", "2024-01-09T10:00:00", "bad", None])
    r = check_freshness(df, "d", reference).first()
    assert (r.passed, r.metric_value, r.threshold) == (True, 5.0, 7.0)
    assert not check_freshness(df, "d", reference, max_age_days=4).first().passed
    future = check_freshness(texts(spark, "d", ["2024-01-12"]), "d", reference).first()
    assert (future.passed, future.metric_value) == (True, -2.0)
    for values in (["bad"], []):
        none = check_freshness(texts(spark, "d", values), "d", reference).first()
        assert (none.passed, none.metric_value) == (False, float("inf"))


def test_column_tests_return_failing_rows(spark):
    df = spark.createDataFrame([(1, "a", 5.0), (1, "b", -1.0), (None, None, None)], "k int, v string, x double")
    parent = spark.createDataFrame([(2,), (None,)], "id int")
    assert ct.not_null_failures(df, "k").count() == 1
    assert [tuple(r) for r in ct.unique_failures(df, "k").collect()] == [(1, 2)]
    assert [r.v for r in ct.accepted_values_failures(df, "v", ["a"]).collect()] == ["b"]
    assert ct.relationships_failures(df, "k", parent, "id").count() == 2
    assert [r.x for r in ct.accepted_range_failures(df, "x", min_value=0).collect()] == [-1.0]
    assert ct.accepted_range_failures(df, "x", max_value=5, inclusive=False).count() == 1
    assert ct.accepted_range_failures(df, "x", max_value=5).count() == 0


def test_column_test_suite_counts(spark):
    tests = ct.model_tests()
    kinds = {k: sum(t.test == k for t in tests) for k in {t.test for t in tests}}
    assert kinds == {
        "not_null": 34, "unique": 9, "accepted_values": 3, "relationships": 4, "accepted_range": 6
    }
    models = {
        "stg_customers": spark.createDataFrame(
            [(1, "a", "b"), (1, None, "c")], "customer_id int, first_name string, last_name string"
        ),
        "stg_orders": spark.createDataFrame(
            [(1, 1, "x", 0), (2, 9, "x", 0), (3, 9, None, 0), (4, None, "x", 0)],
            "order_id int, customer_id int, order_status string, ordered_at int",
        ),
    }
    got = {(r.model, r.column_name, r.test): r.failures for r in ct.run_column_tests(models).collect()}
    assert got[("stg_customers", "first_name", "not_null")] == 1
    assert got[("stg_customers", "customer_id", "unique")] == 1
    assert got[("stg_orders", "customer_id", "relationships")] == 2
    assert got[("stg_orders", "order_id", "unique")] == 0
