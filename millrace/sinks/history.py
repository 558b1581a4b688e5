"""A type-2 history kept in storage: a batch costs what it changes."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators.history import HistoryColumns, merge_history, no_history
from millrace.session import working_folder
from millrace.sinks.buckets import (
    APART,
    BUCKETS,
    bucket_of,
    bucket_state,
    commit,
    create_bucketed,
    rows_of,
    touched_buckets,
)
from millrace.sinks.tables import Warehouse


def store_history(
    w: Warehouse,
    name: str,
    incoming: DataFrame,
    key: str,
    tracked: Sequence[str],
    as_of: datetime,
    incoming_order: Sequence[str] = (),
    columns: HistoryColumns = HistoryColumns(),
    buckets: int = BUCKETS,
) -> DataFrame:
    """Merge a batch into the stored history ``name`` and return the history.

    Rules are those of ``merge_history``. Current versions lie in buckets of the key, closed
    ones apart. A batch reads and rewrites the current versions of the buckets it touches and
    adds the versions it closes; older closed versions are neither read nor written. The
    first batch sets the columns; later ones may lack some but not bring others.
    """
    spark = w.spark
    first = merge_history(no_history(incoming, columns), incoming, key, tracked, as_of, columns=columns)
    create_bucketed(w, name, first.schema, [key], buckets)
    state = bucket_state(w, name)
    if state is None or state.keys != (key,):
        raise ValueError(f"{w.schema}.{name} is no history by {key}")
    known = spark.table(w.table(name)).columns
    unknown = sorted(set(incoming.columns) - set(known))
    if unknown:
        raise ValueError(f"{w.schema}.{name} has no columns {unknown}")
    bucket = bucket_of(w, name, state)
    with working_folder(spark, "history") as path:
        incoming.write.parquet(path)
        batch = spark.read.schema(incoming.schema).parquet(path)
        touched = touched_buckets(batch, bucket)
        merged = merge_history(
            rows_of(w, name, state, touched), batch, key, tracked, as_of, incoming_order, columns
        )
        place = F.when(F.col(columns.is_current), bucket).otherwise(F.lit(APART))
        commit(w, name, state, merged, place, touched)
    return spark.table(w.table(name))
