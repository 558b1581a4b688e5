"""Keep one row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

_RANK = "_millrace_rank"


def deduplicate(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str],
    keep: str = "last",
) -> DataFrame:
    """Keep the first or last row per key in the given order; NULL keys form one group.

    A DataFrame has no row position, so the order is an argument. ``read_csv`` gives rows
    their place in the input as a column on request; ordered by it, first and last are those
    of the input. Ties are broken by all remaining columns, which makes the surviving row the
    same on every run.
    Any ``keep`` other than ``"last"`` keeps the first.
    """
    rest = [
        f.name
        for f in df.schema.fields
        if f.name not in keys
        and f.name not in order_by
        and not isinstance(f.dataType, (T.MapType, T.VariantType))
    ]
    pick = F.desc_nulls_last if keep == "last" else F.asc_nulls_first
    return top_row(df, keys, [pick(F.col(f"`{c}`")) for c in [*order_by, *rest]])


def newest_per_key(df: DataFrame, key: str, loaded_at: str = "_loaded_at") -> DataFrame:
    """Newest load of each key; rows without a key are dropped.

    The null test sits below the window so it reaches the scan, and rows without a
    key never meet in one task.
    """
    return deduplicate(df.filter(F.col(key).isNotNull()), [key], [loaded_at], keep="last")


def top_row(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """First row per key in ``order``."""
    return top_rows(df, keys, order, 1)


def top_rows(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int) -> DataFrame:
    """The first ``n`` rows per key in ``order``.

    The filter on the rank directly above ``row_number`` lets Spark keep ``n`` rows per
    key and map task before the shuffle, so a hot key sends at most so many rows per task.
    """
    window = Window.partitionBy(*[F.col(f"`{k}`") for k in keys]).orderBy(*order)
    return (
        df.withColumn(_RANK, F.row_number().over(window))
        .filter(F.col(_RANK) <= n)
        .drop(_RANK)
    )
