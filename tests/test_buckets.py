"""Tables and histories in buckets: what a batch rewrites, and what a dying job leaves."""

import random
from datetime import datetime, timedelta
from pathlib import Path
from uuid import uuid4

import pytest
from pyspark.sql import functions as F

from millrace.operators.history import merge_history, no_history
from millrace.sinks import buckets, tables
from millrace.sinks.history import store_history

AT, LATER = datetime(2024, 1, 1), datetime(2024, 1, 2)
COLUMNS = [("id", "INTEGER"), ("val", "VARCHAR")]


@pytest.fixture
def w(spark, tmp_path):
    found = tables.Warehouse(spark, f"w_{uuid4().hex[:8]}", str(tmp_path / "warehouse"))
    tables.create_schema(found)
    return found


def batch(spark, rows):
    return spark.createDataFrame(list(rows), "id bigint, val string")


def content(w, name="test"):
    return sorted(((r.id, r.val, r._loaded_at) for r in w.spark.table(w.table(name)).collect()), key=repr)


def written(w, name="test"):
    """Bytes of data files by version."""
    out = {}
    for file in Path(w.base, name).rglob("*.parquet"):
        version = next(p for p in file.parts if p.startswith("_version="))
        out[int(version.split("=")[1])] = out.get(int(version.split("=")[1]), 0) + file.stat().st_size
    return out


def test_a_batch_rewrites_its_buckets_only(spark, w):
    tables.create_table(w, "test", COLUMNS, keys=["id"], buckets=64)
    many = spark.range(40_000).select("id", F.sha2(F.col("id").cast("string"), 256).alias("val"))
    assert tables.load_upsert(w, "test", many, AT, ["id"]) == 40_000
    state = buckets.bucket_state(w, "test")
    own = buckets.bucket_of(w, "test", state)
    ids = [r.id for r in many.filter(own == 7).limit(3).collect()]
    assert tables.load_upsert(w, "test", batch(spark, [(i, "new") for i in ids]), LATER, ["id"]) == 40_000
    after = buckets.bucket_state(w, "test")
    assert [b for b, v in enumerate(after.versions) if v != state.versions[b]] == [7]
    sizes = written(w)
    assert sizes[2] < sizes[1] / 32  # a 64th, and the overhead of files
    changed = [r for r in content(w) if r[2] == LATER]
    assert sorted(changed) == sorted((i, "new", LATER) for i in ids)


def test_upserts_follow_the_rules_of_plain_tables(spark, w):
    tables.create_table(w, "plain", COLUMNS)
    tables.create_table(w, "test", COLUMNS, keys=["id"], buckets=5)
    draw = random.Random(1)
    for step, kind in enumerate(["update", "nothing", "update", "update", "nothing"]):
        rows = [
            (draw.randrange(30) if draw.random() < 0.9 else None, f"{step}-{i}") for i in range(25)
        ]
        at = AT + timedelta(days=step)
        for name in ("plain", "test"):
            counted = tables.load_upsert(w, name, batch(spark, rows), at, ["id"], ["val"], kind)
            assert counted == tables.row_count(w, name)
        assert content(w, "plain") == content(w)
    before = content(w)
    assert tables.load_upsert(w, "test", batch(spark, rows).limit(0), LATER, ["id"]) == len(before)
    assert tables.remove_unused_folders(w, "test") > 0
    assert content(w) == before and tables.remove_unused_folders(w, "test") == 0


def test_reload_and_refusals(spark, w):
    tables.create_table(w, "test", COLUMNS, keys=["id"], buckets=4)
    tables.create_table(w, "test", COLUMNS, keys=["id"], buckets=4)
    assert content(w) == []
    tables.load_upsert(w, "test", batch(spark, [(1, "a"), (None, "b")]), AT, ["id"])
    assert tables.load_overwrite(w, "test", batch(spark, [(2, "c"), (None, "d")]), LATER) == 2
    assert content(w) == sorted([(2, "c", LATER), (None, "d", LATER)], key=repr)
    assert tables.load_overwrite(w, "test", batch(spark, [(2, "c")]).limit(0), LATER) == 0
    assert len(content(w)) == 2
    tables.load_overwrite(w, "test", batch(spark, [(2, "c")]).limit(0), LATER, empty="clear")
    assert content(w) == []
    with pytest.raises(ValueError, match="has keys"):
        tables.load_append(w, "test", batch(spark, [(1, "a")]), AT)
    with pytest.raises(ValueError, match="has keys"):
        tables.load_upsert(w, "test", batch(spark, [(1, "a")]), AT, ["val"])


def test_a_dying_job_leaves_the_old_state(spark, w, monkeypatch):
    tables.create_table(w, "test", COLUMNS, keys=["id"], buckets=4)
    tables.load_upsert(w, "test", batch(spark, [(1, "a"), (2, "b")]), AT, ["id"])
    before = content(w)

    def dies(*_):
        raise RuntimeError("lost")

    publish = buckets._publish
    monkeypatch.setattr(buckets, "_publish", dies)
    with pytest.raises(RuntimeError, match="lost"):
        tables.load_upsert(w, "test", batch(spark, [(1, "x"), (None, "y")]), LATER, ["id"])
    monkeypatch.setattr(buckets, "_publish", publish)
    assert content(w) == before  # though the files of the batch are there
    failing = batch(spark, [(1, "z")]).withColumn("val", F.raise_error(F.lit("bad row")).cast("string"))
    with pytest.raises(Exception, match="bad row"):
        tables.load_upsert(w, "test", failing, LATER, ["id"])
    assert content(w) == before
    tables.load_upsert(w, "test", batch(spark, [(1, "x")]), LATER, ["id"])
    assert content(w) == [(1, "x", LATER), (2, "b", AT)]


def test_a_batch_may_read_the_table_it_changes(spark, w):
    tables.create_table(w, "test", COLUMNS, keys=["id"], buckets=4)
    tables.load_upsert(w, "test", batch(spark, [(1, "a"), (2, "b")]), AT, ["id"])
    own = spark.table(w.table("test")).drop("_loaded_at").withColumn("val", F.upper("val"))
    tables.load_upsert(w, "test", own, LATER, ["id"])
    assert content(w) == [(1, "A", LATER), (2, "B", LATER)]


def test_stored_history_equals_the_merged_one(spark, w):
    draw = random.Random(2)
    schema = "customer_id bigint, name string, tier string"
    merged = None
    for step in range(5):
        rows = [
            (draw.randrange(25) if draw.random() < 0.95 else None, f"n{draw.randrange(3)}", draw.choice("ab"))
            for _ in range(15)
        ]
        incoming, at = spark.createDataFrame(rows, schema), AT + timedelta(days=step)
        stored = store_history(w, "people", incoming, "customer_id", ["name", "tier"], at, buckets=6)
        merged = merge_history(
            no_history(incoming) if merged is None else merged, incoming, "customer_id", ["name", "tier"], at
        )
        merged = spark.createDataFrame(merged.collect(), merged.schema)
        assert stored.columns == merged.columns
        assert sorted(map(repr, stored.collect())) == sorted(map(repr, merged.collect()))
    assert merged.filter("not _is_current").count() > 5


def test_bytes_do_not_grow_with_closed_versions(spark, w):
    people = spark.range(4000).withColumn("name", F.sha2(F.col("id").cast("string"), 256))
    for step in range(5):
        changed = people.withColumn("tier", F.lit(f"tier {step}"))
        store_history(w, "people", changed, "id", ["tier"], AT + timedelta(days=step), buckets=4)
    sizes = written(w, "people")
    assert max(sizes[v] for v in (3, 4, 5)) < 1.1 * sizes[2]
    few = people.filter("id = 17").withColumn("tier", F.lit("other"))
    history = store_history(w, "people", few, "id", ["tier"], LATER + timedelta(days=9), buckets=4)
    assert written(w, "people")[6] < sizes[1] / 3  # one bucket of four, one closed version
    assert history.count() == 5 * 4000 + 1 and history.filter("_is_current").count() == 4000
    with pytest.raises(ValueError, match="no columns"):
        store_history(w, "people", few.withColumn("more", F.lit(1)), "id", ["tier"], LATER)
    with pytest.raises(ValueError, match="no history by name"):
        store_history(w, "people", few, "name", ["tier"], LATER)
