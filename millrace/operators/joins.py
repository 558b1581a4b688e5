"""Equi-joins of a large side with hot keys to a side that has one row per key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_KEY = "_millrace_join_key"


def join_splittable(left: DataFrame, right: DataFrame, key: str, how: str = "left") -> DataFrame:
    """Join on ``key`` so that adaptive execution can split a hot key of ``left``.

    Adaptive skew handling needs both inputs to come straight from a shuffle. A right
    side that was deduplicated or aggregated on the key is already partitioned by it,
    skips its shuffle and so switches the handling off: one key with a third of the
    rows would be one task. Joining on a struct of the key gives the right side its own
    shuffle. A right side below the broadcast threshold is still broadcast.

    ``right`` must not hold a NULL key (NULL equals NULL inside a struct).
    """
    keyed_left = left.withColumn(_KEY, F.struct(F.col(key)))
    keyed_right = right.filter(F.col(key).isNotNull()).withColumn(_KEY, F.struct(F.col(key)))
    return keyed_left.join(keyed_right.drop(key), _KEY, how).drop(_KEY)
