"""Ratios with a zero guard, and exact money arithmetic in integer cents."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def rate(part: Column, whole: Column, empty: float = 0.0) -> Column:
    """``part / whole`` as a double, ``empty`` when there is nothing to divide by."""
    return F.coalesce(
        F.try_divide(part.cast("double"), whole.cast("double")), F.lit(float(empty))
    )


def percent_of(part: Column, whole: Column) -> Column:
    """``part / whole`` in percent with two decimals; NULL when ``whole`` is 0."""
    return F.round(F.try_divide(part.cast("double"), whole.cast("double")) * F.lit(100.0), 2)


def cents_to_dollars(cents: Column) -> Column:
    return cents.cast("double") / F.lit(100.0)


def dollars_to_cents(dollars: Column) -> Column:
    """Inverse of ``cents_to_dollars``; exact below 2**51 cents."""
    return F.rint(dollars * F.lit(100.0)).cast("bigint")
