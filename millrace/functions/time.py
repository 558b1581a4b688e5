"""Time values that do not depend on the zone of the session or of the Python process."""

from __future__ import annotations

from datetime import UTC, datetime

from pyspark.sql import Column
from pyspark.sql import functions as F


def utc_literal(at: datetime) -> Column:
    """A ``timestamp_ntz`` literal; a datetime with a zone is moved to UTC first."""
    if at.tzinfo is not None:
        at = at.astimezone(UTC).replace(tzinfo=None)
    return F.lit(at.isoformat(sep=" ")).cast("timestamp_ntz")


def seconds_between(first: Column, last: Column) -> Column:
    """Seconds from one ``timestamp_ntz`` to another, as wall-clock difference."""
    gap = last - first
    units = (("DAY", 86400), ("HOUR", 3600), ("MINUTE", 60), ("SECOND", 1))
    total = F.lit(0).cast("decimal(20,6)")
    for unit, seconds in units:
        total = total + F.extract(F.lit(unit), gap) * F.lit(seconds)
    return total.cast("double")
