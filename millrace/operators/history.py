"""Slowly changing dimension, type 2: keep every version of a row."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.hashing import row_hash
from millrace.functions.time import utc_literal
from millrace.operators.dedup import deduplicate

_KEY, _PLACE, _SUCCESSOR = "_millrace_key", "_millrace_place", "_millrace_successor"


@dataclass(frozen=True)
class HistoryColumns:
    effective_from: str = "_effective_from"
    effective_to: str = "_effective_to"
    is_current: str = "_is_current"
    row_hash: str = "_row_hash"


def no_history(incoming: DataFrame, columns: HistoryColumns = HistoryColumns()) -> DataFrame:
    """An empty history with the columns of a batch: what the first merge starts from."""
    return incoming.limit(0).withColumns(
        {
            columns.effective_from: F.lit(None).cast("timestamp_ntz"),
            columns.effective_to: F.lit(None).cast("timestamp_ntz"),
            columns.is_current: F.lit(None).cast("boolean"),
            columns.row_hash: F.lit(None).cast("string"),
        }
    )


def merge_history(
    existing: DataFrame,
    incoming: DataFrame,
    key: str,
    tracked: Sequence[str],
    as_of: datetime,
    incoming_order: Sequence[str] = (),
    columns: HistoryColumns = HistoryColumns(),
) -> DataFrame:
    """Merge a batch of rows into a version history.

    A new key opens a version. A changed tracked column closes the current version
    (its stored hash stays) and opens a new one. An unchanged row, a key missing from
    the batch and all closed versions pass through.

    Repeated keys in the batch resolve to the last by ``incoming_order``. Of repeated
    current versions the latest by ``effective_from`` stays current; the older ones are
    closed where their successor begins (``repeated_current`` lists the keys beforehand).
    One full outer join does the work: both sides are ranked or deduplicated on the same
    struct key, in which NULL equals NULL, so each side is shuffled once. Store the history
    partitioned by ``is_current``: closed versions then skip the join's scan.
    """
    h = columns
    meta = (h.effective_from, h.effective_to, h.is_current, h.row_hash)
    current_flag = F.col(h.is_current)
    closed = existing.filter((~current_flag) | current_flag.isNull())

    def keyed(df: DataFrame, order: Sequence[str], alias: str) -> DataFrame:
        one = deduplicate(df.withColumn(_KEY, F.struct(F.col(key))), [_KEY], order)
        return one.select(_KEY, F.struct(*[F.col(c) for c in df.columns]).alias(alias))

    newest_first = Window.partitionBy(_KEY).orderBy(
        F.col(h.effective_from).desc_nulls_last(),
        *[F.col(f"`{c}`").desc() for c in existing.columns if c != h.effective_from],
    )
    current = (
        existing.filter(current_flag)
        .withColumn(_KEY, F.struct(F.col(key)))
        .withColumn(_SUCCESSOR, F.lag(h.effective_from).over(newest_first))
        .withColumn(_PLACE, F.row_number().over(newest_first))
        .select(
            _KEY, _SUCCESSOR, _PLACE, F.struct(*[F.col(c) for c in existing.columns]).alias("cur")
        )
    )
    batch = keyed(incoming, list(incoming_order), "inc")

    types = {f.name: f.dataType for f in incoming.schema.fields}
    types.update({f.name: f.dataType for f in existing.schema.fields})
    names = [*existing.columns, *[c for c in incoming.columns if c not in existing.columns]]
    stamp = utc_literal(as_of).cast(types[h.effective_from])

    def pick(source: str, own: Sequence[str], name: str) -> Column:
        if name not in own:
            return F.lit(None).cast(types[name])
        return F.col(f"{source}.`{name}`").cast(types[name])

    opened_values = {
        h.effective_from: stamp,
        h.effective_to: F.lit(None).cast(types[h.effective_to]),
        h.is_current: F.lit(True),
        h.row_hash: row_hash(incoming.schema, tracked, "inc."),
    }
    closing_values = {h.effective_to: stamp, h.is_current: F.lit(False)}

    def version(source: str, own: Sequence[str], overrides: dict[str, Column]) -> Column:
        return F.struct(
            *[
                overrides.get(n, pick(source, own, n)).alias(n)
                for n in names
            ]
        )

    opened = version("inc", [c for c in incoming.columns if c not in meta], opened_values)
    kept = version("cur", existing.columns, {})
    ended = version("cur", existing.columns, closing_values)
    successor = F.col(_SUCCESSOR).cast(types[h.effective_to])
    older = version(
        "cur", existing.columns, {h.effective_to: successor, h.is_current: F.lit(False)}
    )

    same = F.lit(True)
    for c in tracked:
        left = pick("cur", existing.columns, c) if c in types else F.lit(None)
        right = pick("inc", incoming.columns, c) if c in types else F.lit(None)
        same = same & left.eqNullSafe(right)

    versions = (
        F.when(F.col("cur").isNull(), F.array(opened))
        .when(F.col(_PLACE) > 1, F.array(older))
        .when(F.col("inc").isNull() | same, F.array(kept))
        .otherwise(F.array(ended, opened))
    )
    merged = current.join(batch, _KEY, "full_outer").select(F.inline(versions))
    return closed.unionByName(merged.select(*names), allowMissingColumns=True)


def repeated_current(
    history: DataFrame, key: str, columns: HistoryColumns = HistoryColumns()
) -> DataFrame:
    """Keys with more than one current version: ``key, versions``."""
    return (
        history.filter(F.col(columns.is_current))
        .groupBy(key)
        .agg(F.count(F.lit(1)).alias("versions"))
        .filter(F.col("versions") > 1)
    )
