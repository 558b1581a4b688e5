"""What the plans of checks do: several distinct counts, samples, orphans, rejected rows."""

from datetime import datetime
from uuid import uuid4

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators.column_tests import relationships_failures
from millrace.operators.keyfilter import MOST_WORDS, anti_join, possible, words_for
from millrace.operators.source_checks import Check, check_metrics, failure_samples, run_checks
from millrace.sinks import tables
from millrace.sources import manifest
from millrace.sources.pools import each_source

AT = datetime(2024, 1, 1)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_three_unique_columns_without_an_expand(spark):
    schema = "a bigint, b string, c double, d timestamp, e array<int>, f int"
    rows = [
        (1, "x", 0.0, datetime(2024, 1, 1), [1], 1),
        (2, "", -0.0, datetime(2024, 1, 2), None, 1),
        (None, None, 1.5, None, [], 1),
        (None, "NULL", None, datetime(2024, 1, 1), [1], 1),
        (3, " x", float("nan"), None, [1, 2], 1),
        (4, "x ", float("nan"), None, None, 1),
    ]
    df = spark.createDataFrame(rows, schema)
    checks = [Check("s", "uniqueness", c) for c in ("a", "b", "c", "d", "e", "absent")]
    checks.append(Check("s", "null_rate", "f", 0.0))
    metrics = check_metrics(spark, {"s": df}, checks)
    assert "Expand" not in plan_of(metrics)
    together = {r.check_name: (r.part, r.whole, r.passed) for r in metrics.collect()}
    alone = {}
    for c in checks:  # one by one they are counted in the plain way
        r = check_metrics(spark, {"s": df}, [c]).collect()[0]
        alone[r.check_name] = (r.part, r.whole, r.passed)
    assert together == alone
    assert together["uniqueness:s.a"] == (5, 6, False)
    empty = check_metrics(spark, {"s": df.limit(0)}, checks[:3]).collect()
    assert [(r.part, r.passed) for r in empty] == [(0, True)] * 3


def test_samples_of_ten_failed_checks_come_from_one_job(spark):
    columns = [f"c{i}" for i in range(8)]
    df = spark.range(50).select(*[F.concat(F.lit(f"v{i}-"), F.col("id") + i).alias(c) for i, c in enumerate(columns)])
    parent = spark.createDataFrame([("v0-3",)], "k string")
    params = {"reference_source": "p", "reference_column": "k"}
    checks = [Check("s", "accepted_values", c, params={"values": ["v0-0"]}) for c in columns]
    checks += [Check("s", "referential_integrity", c, params=params) for c in columns[:2]]
    samples = failure_samples({"s": df, "p": parent}, list(enumerate(checks)))
    assert plan_of(samples).count("WindowGroupLimit") == 2
    found = {}
    for r in samples.collect():
        found.setdefault(r.position, []).append(r.key)
    assert {i: sorted(k) for i, k in found.items()} == {
        **{i: sorted(f"v{i}-{n + i}" for n in range(50) if (i, n) != (0, 0))[:5] for i in range(8)},
        8: sorted(f"v0-{n}" for n in range(50) if n != 3)[:5],
        9: sorted(f"v1-{n + 1}" for n in range(50))[:5],
    }
    tracker, group = spark.sparkContext.statusTracker(), uuid4().hex
    spark.sparkContext.setJobGroup(group, "checks")
    try:
        results = run_checks(spark, {"s": df, "p": parent}, checks)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert [r.passed for r in results] == [False] * 10
    assert "such as v7-10, v7-11" in results[7].message
    jobs = len(tracker.getJobIdsForGroup(group))
    one = uuid4().hex
    spark.sparkContext.setJobGroup(one, "one check")
    try:
        run_checks(spark, {"s": df, "p": parent}, checks[:1])
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert jobs < 4 * len(tracker.getJobIdsForGroup(one))


def test_key_filter_keeps_every_row_that_may_be_asked_for(spark):
    df = spark.range(20_000).withColumn("k", F.concat(F.lit("key "), "id"))
    keys = df.filter("id % 1000 = 0").select("k").unionByName(spark.createDataFrame([(None,)], "k string"))
    kept = possible(df, keys, "k", words_for(21))
    ids = {r.id for r in kept.collect()}
    assert kept.columns == df.columns
    assert {i for i in range(20_000) if i % 1000 == 0} <= ids and len(ids) < 400
    assert possible(df, keys.limit(0), "k").count() == 0
    assert possible(df, df, "k", 1).count() == 20_000  # full, and still right
    assert words_for(10**12) == MOST_WORDS


def test_anti_join_is_exact_and_shuffles_what_may_go(spark):
    df = spark.range(9000).select(
        F.when(F.col("id") % 50 != 3, F.struct((F.col("id") % 4000).alias("k"), F.lit(None).cast("string").alias("s"))).alias("key"),
        "id",
    )
    keys = df.filter("id % 1000 = 0").select("key").distinct()
    for words in (1, 256, MOST_WORDS):
        kept = anti_join(df, keys, "key", words)
        gone = {i % 4000 for i in range(0, 9000, 1000)}
        assert sorted(r.id for r in kept.collect()) == [i for i in range(9000) if i % 50 == 3 or i % 4000 not in gone]
        assert kept.columns == df.columns
    assert anti_join(df, keys.limit(0), "key").count() == 9000


def test_only_possible_orphans_are_shuffled(spark):
    settings = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    before = {k: spark.conf.get(k, None) for k in settings}
    for k in settings:
        spark.conf.set(k, "-1")
    try:
        child = spark.range(30_000).select((F.col("id") % 3000).alias("k"), F.col("id").alias("v"))
        parent = spark.range(2990).select(F.col("id").alias("key"))
        orphans = relationships_failures(child, "k", parent, "key")
        rows = orphans.collect()
        plan = plan_of(orphans)
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert sorted(r.v for r in rows) == [i for i in range(30_000) if i % 3000 >= 2990]
    final = plan[: plan.index("== Initial Plan ==")]
    filtered = final.index("BroadcastHashJoin")  # the filter, below the exchange of the join
    assert 0 <= final.index("SortMergeJoin") < final.index("Exchange hashpartitioning") < filtered


@pytest.fixture
def table(spark, tmp_path):
    w = tables.Warehouse(spark, f"w_{uuid4().hex[:8]}", str(tmp_path / "warehouse"))
    tables.create_schema(w)
    tables.create_table(w, "t", [("id", "INTEGER"), ("day", "DATE"), ("ok", "BOOLEAN"), ("note", "VARCHAR")])
    return w


def test_rows_that_do_not_fit_are_set_aside(spark, table, tmp_path):
    rejected = str(tmp_path / "rejected")
    rows = [
        ("1", "2024-01-05", "true", "x"), ("two", "2024-01-05", "true", "y"), ("", None, "", ""),
        ("4", "2024-13-05", "perhaps", "z"), ("5", "2024-02-01", "false", None),
    ]
    batch = spark.createDataFrame(rows, "id string, day string, ok string, note string")
    assert tables.load_append(table, "t", batch, AT, rejected) == 3
    stored = sorted((r.id or 0, str(r.day), r.ok, r.note) for r in spark.table(table.table("t")).collect())
    assert stored == [
        (0, "None", None, ""), (1, "2024-01-05", True, "x"), (5, "2024-02-01", False, None),
    ]
    aside = sorted((r.id, r.day, r._errors, r._loaded_at) for r in spark.read.parquet(rejected).collect())
    assert aside == [("4", "2024-13-05", ["day", "ok"], AT), ("two", "2024-01-05", ["id"], AT)]
    assert tables.load_append(table, "t", batch.limit(0), AT, rejected) == 0
    typed = spark.createDataFrame([(9, "n")], "id bigint, note string")
    assert tables.load_append(table, "t", typed, AT, rejected) == 1
    assert spark.read.parquet(rejected).count() == 2
    with pytest.raises(Exception, match="CANNOT_SAFELY_CAST"):
        tables.load_append(table, "t", batch, AT)
    with pytest.raises(ValueError, match="no columns"):
        tables.load_append(table, "t", batch.withColumn("more", F.lit(1)), AT, rejected)


def test_sources_overlap_in_time_and_fail_apart(spark, tmp_path):
    from threading import Barrier

    meet = Barrier(3, timeout=60)
    spark.sparkContext.setLocalProperty("spark.job.description", "caller")

    def work(n):
        meet.wait()  # only passes if three run at a time
        context = spark.sparkContext
        held = context.getLocalProperty("spark.scheduler.pool"), context.getLocalProperty("spark.job.description")
        return n * spark.range(10).count(), held

    try:
        results = each_source(spark, work, [1, 2, 3], 3)
    finally:
        spark.sparkContext.setLocalProperty("spark.job.description", None)
    assert [r[0] for r in results] == [10, 20, 30]
    assert [r[1] for r in results] == [(f"millrace-{i}", "caller") for i in range(3)]
    assert spark.sparkContext.getLocalProperty("spark.scheduler.pool") is None


def test_sources_with_their_own_layout(spark, tmp_path):
    (tmp_path / "l.json").write_text('{"a": 1}\n{"a": 2}\n')
    (tmp_path / "q.csv").write_text('a,b\n1,"x\ny"\n')
    sources = {
        "lines": manifest.Source(str(tmp_path / "l.json"), json_layout="lines"),
        "wrong": manifest.Source(str(tmp_path / "l.json")),
        "quoted": str(tmp_path / "q.csv"),
        "whole": manifest.Source(str(tmp_path / "q.csv"), multiline=True),
        "none": manifest.Source(None),
    }
    found = manifest.extract_all(spark, sources, str(tmp_path / "land"), AT)
    rows = found.collect()
    assert [r.source_name for r in rows] == list(sources)
    assert [(r.success, r.row_count) for r in rows] == [(True, 2), (False, 0), (True, 1), (True, 1), (False, 0)]
    alone = manifest.extract_all(spark, sources, str(tmp_path / "again"), AT, at_once=1).collect()
    assert [r.checksum for r in alone] == [r.checksum for r in rows]
    assert isinstance(found.schema["row_count"].dataType, T.LongType)
