"""Whole-record checks on typed frames. Each returns a one-row result frame."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.casts import iso_date
from millrace.functions.numeric import rate
from millrace.functions.report import report, report_column
from millrace.functions.text import is_blank, strip


def _result(name: str, passed: Column, metric: Column, threshold: float, message: Column):
    return [
        F.lit(name).alias("check_name"),
        passed.alias("passed"),
        metric.cast("double").alias("metric_value"),
        F.lit(float(threshold)).alias("threshold"),
        message.alias("message"),
    ]


def check_completeness(
    df: DataFrame, required: Sequence[str], threshold: float = 0.95
) -> DataFrame:
    """Share of rows in which every required column is filled. No rows: failed, 0.0."""
    types = {f.name: f.dataType for f in df.schema.fields}
    filled = F.lit(True)
    for c in required:
        filled = filled & (
            ~is_blank(F.col(f"`{c}`"), types[c]) if c in types else F.lit(False)
        )
    counts = df.agg(F.count(F.lit(1)).alias("n"), F.count_if(filled).alias("complete"))
    n, complete = F.col("n"), F.col("complete")
    share = rate(complete, n)
    text = report_column(f"complete in {', '.join(required)}", complete, n, f"{threshold:.2%}")
    return counts.select(
        *_result(
            "completeness",
            (n > 0) & (share >= threshold),
            share,
            threshold,
            text,
        )
    )


def check_unique_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Share of rows that repeat a composite key; NULLs compare as equal. No rows: passed.

    Two aggregations on the key, both combined before the shuffle, so a key that holds
    much of the data reaches the reducer as one row per map task.
    """
    per_key = df.groupBy(*[F.col(f"`{k}`") for k in keys]).agg(F.count(F.lit(1)).alias("n"))
    counts = per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count(F.lit(1)).alias("unique")
    )
    n, unique = F.col("n"), F.col("unique")
    duplicates = rate(n - unique, n)
    text = report_column(f"repeated in {', '.join(keys)}", n - unique, n)
    return counts.select(
        *_result(
            "uniqueness",
            n == unique,
            duplicates,
            0.0,
            text,
        )
    )


def check_freshness(
    df: DataFrame, date_column: str, reference_date: date, max_age_days: int = 7
) -> DataFrame:
    """Age in days of the newest date. Text counts only as an ISO date.

    No usable date: failed with infinite age. A future date has a negative age, passes.
    """
    dtype = df.schema[date_column].dataType
    raw = F.col(f"`{date_column}`")
    if isinstance(dtype, T.StringType):
        day = iso_date(strip(raw))
    elif isinstance(dtype, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        day = raw.cast("date")
    else:
        day = F.lit(None).cast("date")
    newest = df.agg(F.count(F.lit(1)).alias("n"), F.max(day).alias("newest"))
    age = F.datediff(F.lit(reference_date), F.col("newest"))
    text = F.format_string(
        f"newest {date_column}: %s, %d days old, limit {max_age_days} days",
        F.col("newest").cast("string"), age,
    )
    return newest.select(
        *_result(
            "freshness",
            F.coalesce(age <= max_age_days, F.lit(False)),
            F.coalesce(age.cast("double"), F.lit(float("inf"))),
            float(max_age_days),
            F.when(F.col("n") == 0, F.lit(report(f"newest {date_column}", whole=0)))
            .when(F.col("newest").isNull(), F.lit(f"newest {date_column}: no date among the rows"))
            .otherwise(text),
        )
    )
