from datetime import date, datetime
from uuid import uuid4

import pytest
from pyspark.sql import functions as F

from millrace.operators.rules import ORDER_RULES
from millrace.plans import run_flow
from millrace.session import workspace
from millrace.sinks import loading, tables
from millrace.sinks.parquet import append_by_load_date, write_parquet
from millrace.streaming import append_stream

AT, LATER = datetime(2024, 1, 1), datetime(2024, 1, 2)
COLUMNS = [("id", "INTEGER"), ("val", "VARCHAR")]


@pytest.fixture
def warehouse(spark, tmp_path):
    w = tables.Warehouse(spark, f"w_{uuid4().hex[:8]}", str(tmp_path / "warehouse"))
    tables.create_schema(w)
    tables.create_table(w, "test", COLUMNS)
    return w


def batch(spark, *rows):
    return spark.createDataFrame(list(rows), "id bigint, val string")


def content(w, name="test"):
    return sorted(((r.id, r.val, r._loaded_at) for r in w.spark.table(w.table(name)).collect()), key=repr)


def test_create_table_is_empty_and_repeatable(warehouse):
    tables.create_table(warehouse, "test", COLUMNS)
    assert tables.row_count(warehouse, "test") == 0
    assert warehouse.spark.table(warehouse.table("test")).columns == ["id", "val", "_loaded_at"]


def test_reload_replaces(spark, warehouse):
    assert tables.load_overwrite(warehouse, "test", batch(spark, (1, "a")), AT) == 1
    assert tables.load_overwrite(warehouse, "test", batch(spark, (1, "a"), (2, "b")), LATER) == 2
    assert content(warehouse) == [(1, "a", LATER), (2, "b", LATER)]


def test_empty_load_keeps_or_clears(spark, warehouse):
    tables.load_overwrite(warehouse, "test", batch(spark, (1, "a")), AT)
    none = batch(spark, (1, "a")).limit(0)
    assert tables.load_overwrite(warehouse, "test", none, LATER) == 0
    assert tables.row_count(warehouse, "test") == 1
    tables.load_overwrite(warehouse, "test", none, LATER, empty="clear")
    assert tables.row_count(warehouse, "test") == 0


def test_reload_from_itself_is_safe(spark, warehouse):
    tables.load_overwrite(warehouse, "test", batch(spark, (1, "a"), (2, "b")), AT)
    own = spark.table(warehouse.table("test")).drop("_loaded_at").filter("id = 2")
    assert tables.load_overwrite(warehouse, "test", own, LATER) == 1
    assert content(warehouse) == [(2, "b", LATER)]


def test_failed_load_leaves_the_table(spark, warehouse):
    tables.load_overwrite(warehouse, "test", batch(spark, (1, "a")), AT)
    bad = batch(spark, (2, "x")).withColumn("id", F.raise_error(F.lit("boom")).cast("bigint"))
    with pytest.raises(Exception, match="boom"):
        tables.load_overwrite(warehouse, "test", bad, LATER)
    assert content(warehouse) == [(1, "a", AT)]


def test_unknown_columns_are_refused(spark, warehouse):
    with pytest.raises(ValueError, match="has no columns"):
        tables.load_overwrite(warehouse, "test", batch(spark, (1, "a")).withColumn("z", F.lit(1)), AT)


def test_append(spark, warehouse):
    tables.load_append(warehouse, "test", batch(spark, (1, "a")), AT)
    assert tables.load_append(warehouse, "test", batch(spark, (1, "a"), (2, "b")), LATER) == 2
    assert content(warehouse) == [(1, "a", AT), (1, "a", LATER), (2, "b", LATER)]


def test_upserts(spark, warehouse):
    tables.load_overwrite(warehouse, "test", batch(spark, (1, "a"), (2, "b")), AT)
    new = spark.createDataFrame(
        [(2, "first"), (2, "zlast"), (3, "c"), (3, "d"), (None, "n")], "id bigint, val string"
    )
    assert tables.load_upsert(warehouse, "test", new, LATER, ["id"], ["val"], "nothing") == 4
    assert content(warehouse) == sorted(
        [(1, "a", AT), (2, "b", AT), (3, "c", LATER), (None, "n", LATER)], key=repr
    )
    assert tables.load_upsert(warehouse, "test", new, LATER, ["id"], ["val"], "update") == 5
    assert content(warehouse) == sorted(
        [(1, "a", AT), (2, "zlast", LATER), (3, "d", LATER), (None, "n", LATER), (None, "n", LATER)],
        key=repr,
    )


def test_load_source_reports_problems(spark, tmp_path):
    w = tables.Warehouse(spark, f"w_{uuid4().hex[:8]}", str(tmp_path / "w"))
    missing = loading.load_source(w, "orders", str(tmp_path / "nonexistent.csv"), AT)
    assert not missing.success and "not found" in missing.error.lower()
    (tmp_path / "unknown.csv").write_text("a,b\n1,2\n")
    unknown = loading.load_source(w, "unknown", str(tmp_path / "unknown.csv"), AT)
    assert not unknown.success and "no schema" in unknown.error.lower()
    (tmp_path / "orders.csv").write_text("id,user_id,order_date,status\nx,1,2018-01-01,placed\n")
    bad = loading.load_source(w, "orders", str(tmp_path / "orders.csv"), AT)
    assert not bad.success and bad.row_count == 0


def test_load_all_and_verify(spark, tmp_path):
    w = tables.Warehouse(spark, f"w_{uuid4().hex[:8]}", str(tmp_path / "w"))
    texts = {
        "orders": "id,user_id,order_date,status\n1,1,2018-01-01,placed\n2,,2018-01-02,\n",
        "customers": "id,first_name,last_name\n1,Michael,P.\n",
        "payments": "id,order_id,payment_method,amount\n1,1,coupon,1000\n",
    }
    paths = {}
    for name, text in texts.items():
        (tmp_path / f"{name}.csv").write_text(text)
        paths[name] = str(tmp_path / f"{name}.csv")
    results = loading.load_all(w, paths, AT)
    assert [(r.source_name, r.row_count, r.success, r.error) for r in results] == [
        ("orders", 2, True, None), ("customers", 1, True, None), ("payments", 1, True, None),
    ]
    summary = loading.load_summary(loading.results_frame(spark, results)).first()
    assert tuple(summary) == (3, 0, 4)
    rows = spark.table(w.table("orders")).orderBy("id").collect()
    assert tuple(rows[0]) == (1, 1, date(2018, 1, 1), "placed", AT)
    assert (rows[1].user_id, rows[1].status) == (None, None)
    check = loading.verify_load(w, "orders", 3)
    assert (check.rows_match, check.actual_rows) == (False, 2)


def test_compare_content(spark):
    a = batch(spark, (1, "a"), (2, "b"))
    same = loading.compare_content(a, batch(spark, (2, "b"), (1, "a"))).first()
    other = loading.compare_content(a, batch(spark, (2, "b"), (1, "x"))).first()
    fewer = loading.compare_content(a, a.limit(0)).first()
    assert (same.rows_match, same.content_match) == (True, True)
    assert (other.rows_match, other.content_match) == (True, False)
    assert (fewer.rows_match, fewer.content_match) == (False, False)


def test_parquet_folders(spark, tmp_path):
    df = batch(spark, (1, "a"), (2, "b"), (3, "a"))
    plain, parts = str(tmp_path / "plain"), str(tmp_path / "parts")
    assert write_parquet(df, plain, "gzip", "absent") == 3
    for _ in range(2):
        assert write_parquet(df, parts, partition_col="val") == 3
    assert spark.read.parquet(parts).count() == 3
    assert {p.name for p in (tmp_path / "parts").iterdir() if p.is_dir()} == {"val=a", "val=b"}
    assert write_parquet(df.limit(0), plain) == 0
    assert spark.read.parquet(plain).count() == 3


def test_append_by_load_date(spark, tmp_path):
    path = str(tmp_path / "days")
    for at in (AT, LATER):
        append_by_load_date(tables.stamp(batch(spark, (1, "a")), at), path)
    one_day = spark.read.parquet(path).filter(F.col("_loaded_date") == F.lit(date(2024, 1, 2)))
    assert one_day.count() == 1
    plan = one_day._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(_loaded_date" in plan


def test_flow_stops_at_failed_checks(spark, tmp_path):
    texts = {
        "orders": "id,user_id,order_date,status\n1,1,2018-01-01,placed\n",
        "customers": "id,first_name,last_name\n1,Michael,P.\n",
        "payments": "id,order_id,payment_method,amount\n1,1,coupon,1000\n",
    }
    paths = {n: str(tmp_path / f"{n}.csv") for n in texts}
    for n, text in texts.items():
        (tmp_path / f"{n}.csv").write_text(text)
    w = tables.Warehouse(spark, f"w_{uuid4().hex[:8]}", str(tmp_path / "w"))
    result = run_flow(w, paths, str(tmp_path / "marts"), AT)
    assert [c.check_name for c in result.checks if not c.passed] == [
        "row_count_min:orders", "row_count_min:customers", "row_count_min:payments",
    ]
    assert result.tests.count() == 56 and result.tests.filter("not passed").count() == 0
    with pytest.raises(RuntimeError, match="3 critical"):
        run_flow(w, paths, str(tmp_path / "gated"), AT, gate=True)
    assert not (tmp_path / "gated").exists()
    with pytest.raises(RuntimeError, match="Load failed for: orders"):
        run_flow(w, {**paths, "orders": str(tmp_path / "none.csv")}, str(tmp_path / "m"), AT)


def test_stream_splits_and_resumes(spark, tmp_path):
    source, out, bad = (str(tmp_path / n) for n in ("in", "out", "bad"))
    schema = "id string, user_id string, order_date string, status string"

    def land(*rows):
        spark.createDataFrame(list(rows), schema).coalesce(1).write.mode("append").json(source)

    def run():
        stream = spark.readStream.schema(schema).json(source)
        append_stream(stream, out, str(tmp_path / "cp"), ORDER_RULES, bad).awaitTermination()

    land(("1", "1", "2024-01-01", "placed"), ("x", "1", "2024-01-01", "placed"))
    run()
    run()
    land(("2", "1", "2024-01-01", "Shipped"))
    run()
    assert sorted((r.id, r.status) for r in spark.read.parquet(out).collect()) == [(1, "placed"), (2, "shipped")]
    assert [r.id for r in spark.read.parquet(bad).collect()] == ["x"]


def test_workspace_uses_the_checkpoint_setting(spark):
    assert workspace(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))


def test_ignoring_upsert_leaves_stored_files_alone(spark, tmp_path):
    w = tables.Warehouse(spark, "millrace_keep", str(tmp_path / "keep"))
    tables.create_schema(w)
    tables.create_table(w, "t", [("id", "INTEGER"), ("name", "VARCHAR")])
    first = spark.createDataFrame([(1, "a"), (2, "b")], "id long, name string")
    tables.load_overwrite(w, "t", first, AT)
    before = set(spark.table(w.table("t")).inputFiles())
    more = spark.createDataFrame([(2, "c"), (3, "d"), (3, "e"), (None, "n")], "id long, name string")
    assert tables.load_upsert(w, "t", more, AT, ["id"], ["name"], "nothing") == 4
    table = spark.table(w.table("t"))
    assert before < set(table.inputFiles())
    assert sorted((r.id or 0, r.name) for r in table.collect()) == [(0, "n"), (1, "a"), (2, "b"), (3, "d")]
    tables.load_overwrite(w, "t", first, AT)
    assert tables.remove_unused_folders(w, "t") >= 1
    assert tables.remove_unused_folders(w, "t") == 0 and spark.table(w.table("t")).count() == 2
