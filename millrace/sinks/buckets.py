"""Tables stored in buckets of their key, of which a batch rewrites only those it touches.

The rows of version v and bucket b lie in ``_version=v/_bucket=b``. The table is a view that
names, for every bucket, the version that counts. A batch writes the buckets it touches as a
new version and then replaces the view: one catalog operation, before which readers and a job
that dies see the old state. Bucket ``APART`` is never rewritten; rows are added to it, and all
its versions up to the newest count.

One writer at a time. A writer that died leaves a folder that the next one overwrites.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass, replace
from typing import TYPE_CHECKING

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.session import working_folder

if TYPE_CHECKING:
    from millrace.sinks.tables import Warehouse

BUCKETS = 64
#: The bucket of rows that are only ever added.
APART = -1
_BUCKET, _VERSION, _STATE = "_bucket", "_version", "millrace.buckets"


@dataclass(frozen=True)
class BucketState:
    """Keys, the newest version, the first version of ``APART`` rows, and each bucket's version."""

    keys: tuple[str, ...]
    newest: int
    apart_from: int
    versions: tuple[int, ...]


def create_bucketed(
    w: Warehouse, name: str, schema: T.StructType, keys: Sequence[str], buckets: int = BUCKETS
) -> None:
    """Create an empty table of ``schema`` in buckets of ``keys`` unless it exists."""
    if w.spark.catalog.tableExists(f"{w.schema}.{name}"):
        return
    # One file without rows holds the schema.
    empty = w.spark.createDataFrame([], schema)
    empty.coalesce(1).write.mode("overwrite").parquet(f"{_base(w, name)}/{_VERSION}=0/{_BUCKET}={APART}")
    _publish(w, name, BucketState(tuple(keys), 0, 0, (0,) * buckets), schema.names)


def bucket_state(w: Warehouse, name: str) -> BucketState | None:
    """The state of a table in buckets; None for any other table."""
    if not w.spark.catalog.tableExists(f"{w.schema}.{name}"):
        return None
    if w.spark.catalog.getTable(f"{w.schema}.{name}").tableType != "VIEW":
        return None
    rows = w.spark.sql(f"SHOW TBLPROPERTIES {w.table(name)}").filter(F.col("key") == _STATE).collect()
    if not rows:
        return None
    found = json.loads(rows[0].value)
    return BucketState(tuple(found["keys"]), found["newest"], found["apart_from"], tuple(found["versions"]))


def bucket_of(w: Warehouse, name: str, state: BucketState) -> Column:
    """The bucket of a row by its key columns, in the table's types."""
    types = {f.name: f.dataType for f in w.spark.table(w.table(name)).schema.fields}
    hashed = F.xxhash64(*[F.col(f"`{k}`").cast(types[k]) for k in state.keys])
    return F.pmod(hashed, F.lit(len(state.versions))).cast("int")


def rows_of(w: Warehouse, name: str, state: BucketState, buckets: Sequence[int]) -> DataFrame:
    """The table's rows in some buckets. Only their folders are read."""
    columns = w.spark.table(w.table(name)).columns
    wanted = F.col(_BUCKET).isin(*buckets) if buckets else F.lit(False)
    stored = w.spark.read.parquet(_base(w, name))
    return stored.filter(wanted & F.expr(_counts(state))).select(*[f"`{c}`" for c in columns])


def touched_buckets(batch: DataFrame, bucket: Column) -> list[int]:
    """Buckets that hold keys of a batch: at most as many numbers as there are buckets."""
    return sorted(r[0] for r in batch.select(bucket).distinct().collect())


def commit(
    w: Warehouse,
    name: str,
    state: BucketState,
    rows: DataFrame,
    bucket: Column,
    rewritten: Sequence[int],
    clear_apart: bool = False,
) -> BucketState:
    """Write ``rows`` as the new content of the ``rewritten`` buckets and as more ``APART`` rows.

    ``rewritten`` buckets without rows become empty. ``clear_apart`` drops older ``APART`` rows.
    """
    types = w.spark.table(w.table(name)).schema
    new = state.newest + 1
    placed = rows.select(
        *[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in types.fields], bucket.alias(_BUCKET)
    )
    # Adaptive execution splits a large bucket over several tasks.
    placed.hint("rebalance", F.col(_BUCKET)).write.mode("overwrite").partitionBy(_BUCKET).parquet(
        f"{_base(w, name)}/{_VERSION}={new}"
    )
    versions = [new if b in set(rewritten) else v for b, v in enumerate(state.versions)]
    after = replace(
        state, newest=new, versions=tuple(versions), apart_from=new if clear_apart else state.apart_from
    )
    _publish(w, name, after, types.names)
    return after


def merge_by_key(
    w: Warehouse, name: str, state: BucketState, batch: DataFrame, keyless: DataFrame, update: bool
) -> None:
    """Merge rows with unique keys by key, and add rows without a key.

    ``update``: rows of the batch replace stored ones, else stored ones stay.
    """
    bucket, keys = bucket_of(w, name, state), list(state.keys)
    with working_folder(w.spark, "upsert") as path:
        # Read several times, and it may be a long plan over the table itself.
        batch.withColumn(_BUCKET, bucket).write.parquet(path)
        held = w.spark.read.parquet(path)
        touched = touched_buckets(held, F.col(_BUCKET))
        stored = rows_of(w, name, state, touched)
        new = held.drop(_BUCKET)
        if update:
            merged = stored.join(new.select(*keys), keys, "left_anti").select(*new.columns).unionByName(new)
        else:
            merged = stored.unionByName(new.join(stored.select(*keys), keys, "left_anti").select(*new.columns))
        missing = F.lit(False)
        for k in keys:
            missing = missing | F.col(k).isNull()
        place = F.when(missing, F.lit(APART)).otherwise(bucket)
        commit(w, name, state, merged.unionByName(keyless), place, touched)


def remove_old_versions(w: Warehouse, name: str, state: BucketState) -> int:
    """Delete the folders of buckets that do not count any more; returns their number."""
    spark = w.spark
    path = spark._jvm.org.apache.hadoop.fs.Path
    base = path(_base(w, name))
    store = base.getFileSystem(spark._jsc.hadoopConfiguration())
    removed = 0
    for version in store.listStatus(base):
        number = int(version.getPath().getName().split("=")[1])
        if number == 0:  # holds the schema
            continue
        for bucket in store.listStatus(version.getPath()):
            place = bucket.getPath().getName()
            if not place.startswith(f"{_BUCKET}="):
                continue
            b = int(place.split("=")[1])
            counts = (
                state.apart_from <= number <= state.newest if b == APART else state.versions[b] == number
            )
            if not counts:
                store.delete(bucket.getPath(), True)
                removed += 1
    return removed


def _base(w: Warehouse, name: str) -> str:
    return f"{w.base.rstrip('/')}/{name}"


def _counts(state: BucketState) -> str:
    """SQL: whether the rows of a folder count. It only names partition columns."""
    versions = ",".join(map(str, state.versions))
    return (
        f"({_BUCKET} >= 0 and array({versions})[greatest({_BUCKET}, 0)] = {_VERSION}"
        f" or {_BUCKET} = {APART} and {_VERSION} between {state.apart_from} and {state.newest})"
    )


def _publish(w: Warehouse, name: str, state: BucketState, columns: Sequence[str]) -> None:
    names = ", ".join(f"`{c}`" for c in columns)
    held = json.dumps(
        {
            "keys": state.keys,
            "newest": state.newest,
            "apart_from": state.apart_from,
            "versions": state.versions,
        }
    )
    w.spark.sql(
        f"CREATE OR REPLACE VIEW {w.table(name)} TBLPROPERTIES ('{_STATE}' = '{held}') AS "
        f"SELECT {names} FROM parquet.`{_base(w, name)}` WHERE {_counts(state)}"
    )
