"""Raw tables in the session catalog, backed by Parquet.

A reload or upsert writes a new folder under the table's base folder and then points
the table at it (``ALTER TABLE ... SET LOCATION``). A plan that reads the table while
it is replaced keeps reading the old folder, and a job that dies half-way leaves the
table as it was.

A table with declared keys is stored in buckets of them (``millrace.sinks.buckets``): an
upsert then rewrites the buckets its keys fall into, not the table.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime
from typing import Literal

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.text import blank_to_null
from millrace.functions.time import utc_literal
from millrace.operators.dedup import deduplicate
from millrace.sinks.buckets import (
    APART,
    BUCKETS,
    BucketState,
    bucket_of,
    bucket_state,
    commit,
    create_bucketed,
    merge_by_key,
    remove_old_versions,
)
from millrace.sources.schemas import LOADED_AT, struct_type

ERRORS = "_errors"


@dataclass(frozen=True)
class Warehouse:
    """A catalog schema and the folder below which its tables keep their data."""

    spark: SparkSession
    schema: str
    base: str

    def table(self, name: str) -> str:
        return f"`{self.schema}`.`{name}`"

    def new_folder(self, name: str) -> str:
        return f"{self.base.rstrip('/')}/{name}/load={uuid.uuid4().hex[:16]}"


def create_schema(w: Warehouse) -> None:
    w.spark.sql(f"CREATE SCHEMA IF NOT EXISTS `{w.schema}` LOCATION '{w.base}'")


def create_table(
    w: Warehouse,
    name: str,
    columns: Sequence[tuple[str, str]],
    keys: Sequence[str] = (),
    buckets: int = BUCKETS,
) -> None:
    """Create an empty table with a ``_loaded_at`` column unless it exists.

    With ``keys`` it is stored in that many buckets of them.
    """
    if w.spark.catalog.tableExists(f"{w.schema}.{name}"):
        return
    if keys:
        create_bucketed(w, name, struct_type(columns), keys, buckets)
        return
    fields = ", ".join(
        f"`{f.name}` {f.dataType.simpleString()}" for f in struct_type(columns).fields
    )
    folder = w.new_folder(name)
    w.spark.sql(f"CREATE TABLE {w.table(name)} ({fields}) USING parquet LOCATION '{folder}'")


def row_count(w: Warehouse, name: str) -> int:
    return w.spark.table(w.table(name)).count()


def stamp(df: DataFrame, loaded_at: datetime) -> DataFrame:
    """One load time for all rows."""
    return df.withColumn(LOADED_AT, utc_literal(loaded_at))


def load_overwrite(
    w: Warehouse,
    name: str,
    df: DataFrame,
    loaded_at: datetime,
    empty: Literal["keep", "clear"] = "keep",
) -> int:
    """Replace the content of a table; returns the rows written.

    With ``empty="keep"`` an empty batch leaves the old rows in place.
    """
    state = bucket_state(w, name)
    if state is not None:
        return _replace_buckets(w, name, state, _fit(w, name, stamp(df, loaded_at)), empty)
    return _replace(w, name, _fit(w, name, stamp(df, loaded_at)), empty)


def load_append(
    w: Warehouse, name: str, df: DataFrame, loaded_at: datetime, rejected: str | None = None
) -> int:
    """Add rows; returns the number added.

    With ``rejected``, a folder, a row with a value that does not fit its column's type does
    not fail the load: it is appended to that folder as it came, with the names of the columns
    in ``_errors`` and the load time. Rows and errors are counted while the others are written;
    only if there are errors is the batch read again, to write them.
    """
    state = bucket_state(w, name)
    if state is not None:
        raise ValueError(f"{w.schema}.{name} has keys {list(state.keys)}; use load_upsert")
    if rejected is not None:
        return _append_fitting(w, name, _fit(w, name, stamp(df, loaded_at)), rejected)
    counted, rows = _observed(_fit(w, name, stamp(df, loaded_at)))
    counted.write.insertInto(f"{w.schema}.{name}")
    return rows.get["n"]


def _append_fitting(w: Warehouse, name: str, batch: DataFrame, rejected: str) -> int:
    fields = w.spark.table(w.table(name)).schema.fields
    types = {f.name: f.dataType for f in batch.schema.fields}

    def present(c: str) -> Column:
        return blank_to_null(F.col(f"`{c}`")) if types[c] == T.StringType() else F.col(f"`{c}`")

    values = {
        f.name: F.col(f"`{f.name}`") if f.dataType == types[f.name] else present(f.name).try_cast(f.dataType)
        for f in fields
    }
    unfit = [
        F.when(present(f.name).isNotNull() & values[f.name].isNull(), F.lit(f.name))
        for f in fields
        if f.dataType != types[f.name]
    ]
    errors = F.array_compact(F.array(*unfit)) if unfit else F.array().cast("array<string>")
    judged = batch.withColumn(ERRORS, errors)
    fits = F.size(ERRORS) == 0
    seen = Observation()
    judged.observe(seen, F.count(F.lit(1)).alias("n"), F.count_if(~fits).alias("errors")).filter(
        fits
    ).select(*[v.alias(n) for n, v in values.items()]).write.insertInto(f"{w.schema}.{name}")
    if seen.get["errors"]:
        judged.filter(~fits).write.mode("append").parquet(rejected)
    return seen.get["n"] - seen.get["errors"]


def load_upsert(
    w: Warehouse,
    name: str,
    df: DataFrame,
    loaded_at: datetime,
    keys: Sequence[str],
    order_by: Sequence[str] = (),
    on_conflict: Literal["update", "nothing"] = "update",
) -> int:
    """Merge a batch by key; returns the rows the table then holds.

    ``update``: a batch row replaces the stored row, the last of repeated keys wins.
    ``nothing``: stored rows stay, the first of repeated keys is inserted.
    NULL keys never conflict, as with a unique constraint.

    ``keys`` are the primary key, so stored keys are unique; stored rows without a key
    take no part in the join. Stored rows are not shuffled when the batch is small enough
    to broadcast by its own file size, which Spark decides.

    A table created with keys rewrites the buckets that the batch touches, for its own keys
    only. Any other table is rewritten as a whole by ``update``.
    """
    target = w.spark.table(w.table(name))
    batch = _fit(w, name, stamp(df, loaded_at))
    missing = F.lit(False)
    for k in keys:
        missing = missing | F.col(k).isNull()
    keyless, keyed = batch.filter(missing), batch.filter(~missing)
    state = bucket_state(w, name)
    if state is not None:
        if tuple(keys) != state.keys:
            raise ValueError(f"{w.schema}.{name} has keys {list(state.keys)}, not {list(keys)}")
        update = on_conflict == "update"
        keyed = deduplicate(keyed, keys, order_by, keep="last" if update else "first")
        merge_by_key(w, name, state, keyed, keyless, update)
        return row_count(w, name)
    if on_conflict == "update":
        keyed = deduplicate(keyed, keys, order_by, keep="last")
        kept = target.filter(~missing).join(keyed.select(*keys), list(keys), "left_anti")
        merged = (
            kept.select(*target.columns).unionByName(target.filter(missing)).unionByName(keyed)
        )
    else:
        keyed = deduplicate(keyed, keys, order_by, keep="first")
        fresh = keyed.join(target.select(*keys), list(keys), "left_anti")
        # Stored rows stay where they are: only the new ones are written.
        added = fresh.select(*target.columns).unionByName(keyless)
        added.write.insertInto(f"{w.schema}.{name}")
        return row_count(w, name)
    return _replace(w, name, merged.unionByName(keyless), "keep")


def remove_unused_folders(w: Warehouse, name: str) -> int:
    """Delete the data folders that the table no longer points to; returns their number.

    Call it when no plan that still reads an older state of the table is running.
    """
    state = bucket_state(w, name)
    if state is not None:
        return remove_old_versions(w, name, state)
    spark = w.spark
    described = spark.sql(f"DESCRIBE FORMATTED {w.table(name)}").filter("col_name = 'Location'")
    path = spark._jvm.org.apache.hadoop.fs.Path
    base = path(f"{w.base.rstrip('/')}/{name}")
    store = base.getFileSystem(spark._jsc.hadoopConfiguration())
    current = store.makeQualified(path(described.first().data_type)).toString()
    old = [f.getPath() for f in store.listStatus(base) if f.getPath().toString() != current]
    for folder in old:
        store.delete(folder, True)
    return len(old)


def _fit(w: Warehouse, name: str, df: DataFrame) -> DataFrame:
    """The columns of the table in its order; columns it does not have are refused."""
    fields = w.spark.table(w.table(name)).schema.fields
    unknown = sorted(set(df.columns) - {f.name for f in fields})
    if unknown:
        raise ValueError(f"{w.schema}.{name} has no columns {unknown}")
    return df.select(
        *[
            F.col(f"`{f.name}`")
            if f.name in df.columns
            else F.lit(None).cast(f.dataType).alias(f.name)
            for f in fields
        ]
    )


def _observed(df: DataFrame) -> tuple[DataFrame, Observation]:
    rows = Observation()
    return df.observe(rows, F.count(F.lit(1)).alias("n")), rows


def _replace_buckets(w: Warehouse, name: str, state: BucketState, df: DataFrame, empty: str) -> int:
    if empty == "keep" and df.isEmpty():
        return 0
    missing = F.lit(False)
    for k in state.keys:
        missing = missing | F.col(k).isNull()
    place = F.when(missing, F.lit(APART)).otherwise(bucket_of(w, name, state))
    counted, rows = _observed(df)
    commit(w, name, state, counted, place, range(len(state.versions)), clear_apart=True)
    return rows.get["n"]


def _replace(w: Warehouse, name: str, df: DataFrame, empty: str) -> int:
    folder = w.new_folder(name)
    counted, rows = _observed(df)
    counted.write.parquet(folder)
    written = rows.get["n"]
    if written > 0 or empty == "clear":
        w.spark.sql(f"ALTER TABLE {w.table(name)} SET LOCATION '{folder}'")
        w.spark.catalog.refreshTable(f"{w.schema}.{name}")
    return written
