"""Configurable checks on raw sources.

``check_metrics`` gives all measurements as one lazy frame with one row per check.
``run_checks`` is the action: it collects that frame (its size is the number of
checks), adds a sample of offending values to failed checks and returns results.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import asdict, dataclass, field
from functools import reduce
from typing import Any

from pyspark.errors import (
    AnalysisException,
    ArithmeticException,
    DateTimeException,
    PySparkException,
)
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.numeric import rate
from millrace.functions.report import report
from millrace.functions.text import is_blank, strip
from millrace.operators.dedup import top_rows
from millrace.operators.rules import ORDER_STATUSES, PAYMENT_METHODS

SAMPLE_SIZE = 5
ROW_CHECKS = ("null_rate", "row_count_min", "schema_match", "uniqueness", "accepted_values")
CHECK_TYPES = (*ROW_CHECKS, "referential_integrity")

METRICS_SCHEMA = (
    "position int, check_name string, source_name string, check_type string, passed boolean, "
    "severity string, metric_value double, threshold double, part bigint, whole bigint, "
    "problem string"
)


@dataclass(frozen=True)
class Check:
    source_name: str
    check_type: str
    column: str | None = None
    threshold: float | None = None
    severity: str = "error"
    params: Mapping[str, Any] = field(default_factory=dict)

    @property
    def name(self) -> str:
        suffix = f".{self.column}" if self.column else ""
        return f"{self.check_type}:{self.source_name}{suffix}"


@dataclass(frozen=True)
class CheckResult:
    check_name: str
    source_name: str
    passed: bool
    severity: str
    message: str
    metric_value: float | None = None
    threshold: float | None = None


RESULT_SCHEMA = (
    "check_name string, source_name string, passed boolean, severity string, "
    "message string, metric_value double, threshold double"
)


def default_checks() -> list[Check]:
    """The standard suite for orders, customers and payments."""
    # Columns, thresholds and severities of the standard suite.
    null_rates = [
        Check("orders", "null_rate", "id", 0.0),
        Check("orders", "null_rate", "user_id", 0.0),
        Check("orders", "null_rate", "order_date", 0.0),
        Check("orders", "null_rate", "status", 0.01, "warning"),
        Check("customers", "null_rate", "id", 0.0),
        Check("customers", "null_rate", "first_name", 0.05),
        Check("customers", "null_rate", "last_name", 0.05),
        Check("payments", "null_rate", "id", 0.0),
        Check("payments", "null_rate", "order_id", 0.0),
        Check("payments", "null_rate", "amount", 0.0),
    ]
    columns = {
        "orders": ["id", "user_id", "order_date", "status"],
        "customers": ["id", "first_name", "last_name"],
        "payments": ["id", "order_id", "payment_method", "amount"],
    }
    return [
        *null_rates,
        *[Check(s, "row_count_min", threshold=10) for s in columns],
        *[Check(s, "schema_match", params={"expected_columns": c}) for s, c in columns.items()],
        *[Check(s, "uniqueness", "id") for s in columns],
        Check("orders", "accepted_values", "status", params={"values": list(ORDER_STATUSES)}),
        Check(
            "payments",
            "accepted_values",
            "payment_method",
            params={"values": list(PAYMENT_METHODS)},
        ),
        Check(
            "payments",
            "referential_integrity",
            "order_id",
            params={"reference_source": "orders", "reference_column": "id"},
        ),
    ]


def _text(df: DataFrame, column: str | None) -> Column:
    """A column as text, blank where NULL; an absent column is blank in every row."""
    if column not in df.columns:
        return F.lit("")
    return F.coalesce(F.col(f"`{column}`").cast("string"), F.lit(""))


def _is_text(df: DataFrame, column: str | None) -> bool:
    return column not in df.columns or isinstance(df.schema[column].dataType, T.StringType)


def _missing(df: DataFrame, column: str | None) -> Column:
    if _is_text(df, column):
        return is_blank(_text(df, column), T.StringType())
    return F.col(f"`{column}`").isNull()


def _distinct(df: DataFrame, column: str | None) -> Column:
    """Number of different raw values; all missing values together are one."""
    if _is_text(df, column):
        return F.count_distinct(_text(df, column))
    c = F.col(f"`{column}`")
    return F.count_distinct(c) + F.coalesce(F.max(c.isNull().cast("int")), F.lit(0))


def _comparable(df: DataFrame, column: str | None) -> Column:
    """Text that differs exactly where values differ; NULL for a missing value that is no text."""
    if _is_text(df, column):
        return _text(df, column)
    c, dtype = F.col(f"`{column}`"), df.schema[column].dataType
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        c = c + F.lit(0.0)  # one zero
    elif isinstance(dtype, T.TimestampType):
        c = F.unix_micros(c)
    elif isinstance(dtype, (T.ArrayType, T.MapType, T.StructType)):
        c = F.to_json(c)
    elif isinstance(dtype, T.BinaryType):
        c = F.hex(c)
    return c.cast("string")


def _distinct_counts(df: DataFrame, columns: Sequence[str | None]) -> DataFrame:
    """One row: what ``_distinct`` counts, for several columns, as ``distinct_<column>``.

    Every row becomes one pair of column number and value per column. Pairs are made distinct
    by an aggregation that is combined before the shuffle, then counted per number.
    """
    pairs = df.select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(i).alias("number"), _comparable(df, c).alias("value")
                    )
                    for i, c in enumerate(columns)
                ]
            )
        )
    )
    per_number = pairs.distinct().groupBy("number").agg(F.count(F.lit(1)).alias("unique"))
    return per_number.agg(
        *[
            F.coalesce(F.max(F.when(F.col("number") == i, F.col("unique"))), F.lit(0)).alias(
                f"distinct_{c}"
            )
            for i, c in enumerate(columns)
        ]
    )


def _violates(df: DataFrame, check: Check) -> Column:
    """True on rows with a non-blank value outside the accepted list (case-sensitive)."""
    value = strip(_text(df, check.column))
    return (value != "") & ~value.isin(*check.params.get("values", []))


def _entry(
    position: int,
    check: Check,
    passed: Column,
    metric: Column,
    part: Column,
    whole: Column,
    problem: Column | None = None,
) -> Column:
    return F.struct(
        F.lit(position).alias("position"),
        F.lit(check.name).alias("check_name"),
        F.lit(check.source_name).alias("source_name"),
        F.lit(check.check_type).alias("check_type"),
        passed.alias("passed"),
        F.lit(check.severity).alias("severity"),
        metric.cast("double").alias("metric_value"),
        F.lit(check.threshold).cast("double").alias("threshold"),
        part.cast("bigint").alias("part"),
        whole.cast("bigint").alias("whole"),
        (F.lit(None) if problem is None else problem).cast("string").alias("problem"),
    )


def _row_metrics(df: DataFrame, checks: Sequence[tuple[int, Check]]) -> DataFrame:
    """All row checks of one source from a single aggregation over a single scan.

    Several columns that must be unique are counted apart, from a second scan of those columns:
    counting them in the same aggregation would multiply complete rows.
    """
    keys = sorted({c.column for _, c in checks if c.check_type == "uniqueness"}, key=str)
    aggregates: dict[str, Column] = {"n": F.count(F.lit(1))}
    for position, c in checks:
        if c.check_type == "null_rate":
            aggregates[f"blank_{c.column}"] = F.count_if(_missing(df, c.column))
        elif c.check_type == "uniqueness" and len(keys) == 1:
            aggregates[f"distinct_{c.column}"] = _distinct(df, c.column)
        elif c.check_type == "accepted_values":
            aggregates[f"bad_{c.column}_{position}"] = F.count_if(_violates(df, c))
    counted = df.agg(*[a.alias(name) for name, a in aggregates.items()])
    if len(keys) > 1:
        both = counted.unionByName(_distinct_counts(df, keys), allowMissingColumns=True)
        counted = both.agg(*[F.max(f"`{c}`").alias(c) for c in both.columns])

    n = F.col("n")
    entries = []
    for position, c in checks:
        limit = float(c.threshold or 0.0)
        if c.check_type == "null_rate":
            blank = F.col(f"`blank_{c.column}`")
            share = rate(blank, n, empty=1.0)
            entries.append(_entry(position, c, (n > 0) & (share <= limit), share, blank, n))
        elif c.check_type == "row_count_min":
            entries.append(_entry(position, c, n >= limit, n, n, F.lit(None)))
        elif c.check_type == "uniqueness":
            unique = F.col(f"`distinct_{c.column}`")
            share = rate(n - unique, n)
            entries.append(_entry(position, c, n == unique, share, unique, n))
        elif c.check_type == "accepted_values":
            bad = F.col(f"`bad_{c.column}_{position}`")
            entries.append(_entry(position, c, bad == 0, rate(bad, n), bad, n))
        else:
            expected = set(c.params.get("expected_columns", []))
            found = len(expected & set(df.columns))
            share = found / len(expected) if expected else 1.0
            entries.append(
                _entry(
                    position,
                    c,
                    F.lit(found == len(expected)),
                    F.lit(share),
                    F.lit(found),
                    F.lit(len(expected)),
                )
            )
    return counted.select(F.inline(F.array(*entries)))


def distinct_keys(df: DataFrame, column: str | None) -> DataFrame:
    """Distinct non-blank stripped values of a column, as ``key``."""
    return df.select(strip(_text(df, column)).alias("key")).filter(F.col("key") != "").distinct()


def orphan_keys(child: DataFrame, column: str | None, parent: DataFrame, parent_column: str):
    """Distinct child keys without a parent row, as ``key``."""
    known = distinct_keys(parent, parent_column)
    return distinct_keys(child, column).join(known, "key", "left_anti")


def _reference_metrics(child: DataFrame, parent: DataFrame, position: int, c: Check) -> DataFrame:
    """Orphan share among the distinct keys, from one join of two distinct key sets."""
    known = distinct_keys(parent, c.params.get("reference_column", "")).withColumn(
        "known", F.lit(True)
    )
    counted = (
        distinct_keys(child, c.column)
        .join(known, "key", "left")
        .agg(F.count(F.lit(1)).alias("keys"), F.count_if(F.col("known").isNull()).alias("orphans"))
    )
    orphans, keys = F.col("orphans"), F.col("keys")
    entry = _entry(position, c, orphans == 0, rate(orphans, keys), orphans, keys)
    return counted.select(F.inline(F.array(entry)))


def _failed_metrics(spark: SparkSession, rows: list[tuple[int, Check, str]]) -> DataFrame:
    return spark.createDataFrame(
        [
            (
                position,
                f"{c.check_type}:{c.source_name}.{c.column or '*'}"
                if problem.startswith("source ")
                else c.name,
                c.source_name,
                c.check_type,
                False,
                "error" if problem.startswith("unknown check type") else c.severity,
                None,
                None if c.threshold is None else float(c.threshold),
                None,
                None,
                problem,
            )
            for position, c, problem in rows
        ],
        METRICS_SCHEMA,
    )


def check_metrics(
    spark: SparkSession, sources: Mapping[str, DataFrame], checks: Sequence[Check]
) -> DataFrame:
    """Measurements of all checks as one lazy frame.

    Each source is scanned once for all of its row checks; each referential check adds
    one join of distinct key sets.
    """
    by_source: dict[str, list[tuple[int, Check]]] = {}
    frames: list[DataFrame] = []
    failed: list[tuple[int, Check, str]] = []
    for position, c in enumerate(checks):
        if c.source_name not in sources:
            failed.append((position, c, report(f"source {c.source_name} not found")))
        elif c.check_type == "referential_integrity":
            parent = c.params.get("reference_source", "")
            if parent not in sources:
                failed.append((position, c, report(f"reference source {parent} not found")))
            else:
                frames.append(
                    _reference_metrics(sources[c.source_name], sources[parent], position, c)
                )
        elif c.check_type in ROW_CHECKS:
            by_source.setdefault(c.source_name, []).append((position, c))
        else:
            failed.append((position, c, report(f"unknown check type {c.check_type}")))
    frames = [_row_metrics(sources[s], cs) for s, cs in by_source.items()] + frames
    if failed or not frames:
        frames.append(_failed_metrics(spark, failed))
    return reduce(DataFrame.unionByName, frames)


def failure_samples(
    sources: Mapping[str, DataFrame], failed: Sequence[tuple[int, Check]]
) -> DataFrame:
    """``position, key``: the first five distinct offending values of each check, in one frame.

    A source is scanned once for all its accepted values; orphans are one difference of key
    sets per check. Tasks keep five values per check before any are brought together.
    """
    by_source: dict[str, list[tuple[int, Check]]] = {}
    found: list[DataFrame] = []
    for position, c in failed:
        if c.check_type == "accepted_values":
            by_source.setdefault(c.source_name, []).append((position, c))
        elif c.check_type == "referential_integrity":
            parent, column = sources[c.params["reference_source"]], c.params.get("reference_column", "")
            orphans = orphan_keys(sources[c.source_name], c.column, parent, column)
            found.append(orphans.select(F.lit(position).alias("position"), "key"))
    for name, checks in by_source.items():
        df = sources[name]
        offending = [
            F.struct(
                F.lit(position).alias("position"),
                F.when(_violates(df, c), strip(_text(df, c.column))).alias("key"),
            )
            for position, c in checks
        ]
        found.append(df.select(F.inline(F.array(*offending))).filter(F.col("key").isNotNull()).distinct())
    return top_rows(
        reduce(DataFrame.unionByName, found), ["position"], [F.col("key").asc()], SAMPLE_SIZE
    )


def _samples(
    sources: Mapping[str, DataFrame], checks: Sequence[Check], measured: Mapping[int, Row]
) -> dict[int, list[str]]:
    """Samples of the failed checks by position: five values each at most, from one job."""
    failed = [
        (i, c)
        for i, c in enumerate(checks)
        if c.check_type in ("accepted_values", "referential_integrity")
        and not measured[i].passed
        and not measured[i].problem
    ]
    samples: dict[int, list[str]] = {}
    if failed:
        for r in failure_samples(sources, failed).collect():
            samples.setdefault(r.position, []).append(r.key)
    return {i: sorted(keys) for i, keys in samples.items()}


#: What the counted part of a check's rows is.
_PARTS = {
    "null_rate": "missing values",
    "uniqueness": "repeated values",
    "accepted_values": "refused values",
    "referential_integrity": "orphans",
}


def _message(
    c: Check, m: Row, sources: Mapping[str, DataFrame], sample: Sequence[str]
) -> str:
    if m.problem:
        return m.problem
    limit = float(c.threshold or 0.0)
    if c.check_type == "row_count_min":
        return report(f"rows in {c.source_name}", m.part, limit=f"{limit:.0f} at least")
    if c.check_type == "schema_match":
        expected = set(c.params.get("expected_columns", []))
        actual = set(sources[c.source_name].columns)
        absent, surplus = sorted(expected - actual), sorted(actual - expected)
        return "; ".join(
            report(f"{kind} columns of {c.source_name}", len(names), sample=names)
            for kind, names in (("missing", absent), ("surplus", surplus))
            if names or kind == "missing"
        )
    part, whole = m.part, m.whole
    if c.check_type == "uniqueness":
        part = whole - part
    elif c.check_type == "null_rate":
        part = round(m.metric_value * whole)
        if c.column not in sources[c.source_name].columns:
            return report(f"{c.column} is no column of {c.source_name}")
    what = f"{_PARTS[c.check_type]} in {c.source_name}.{c.column}"
    return report(what, part, whole, f"{limit:.2%}", sample)


def run_checks(
    spark: SparkSession,
    sources: Mapping[str, DataFrame],
    checks: Sequence[Check] | None = None,
) -> list[CheckResult]:
    """Run the checks and return their results in the given order.

    If the joint job fails over the data or its columns, each check is run alone, so that
    one broken source turns into failed results and the others still report. Failures of the
    cluster are raised.
    """
    checks = default_checks() if checks is None else list(checks)
    try:
        measured = {r.position: r for r in check_metrics(spark, sources, checks).collect()}
        samples = _samples(sources, checks, measured)
        return [
            _to_result(c, measured[i], sources, samples.get(i, [])) for i, c in enumerate(checks)
        ]
    except PySparkException as exc:
        if not _is_about_data(exc):
            raise
        return [_run_alone(spark, sources, c) for c in checks]


def _is_about_data(exc: PySparkException) -> bool:
    """An unresolved plan, or an error that an expression or a reader raises for its input."""
    if isinstance(exc, (AnalysisException, ArithmeticException, DateTimeException)):
        return True
    condition = exc.getCondition() or ""
    return condition.startswith(("CAST_", "INVALID_", "FAILED_READ_FILE", "MALFORMED_", "USER_RAISED"))


def _run_alone(spark: SparkSession, sources: Mapping[str, DataFrame], c: Check) -> CheckResult:
    try:
        m = check_metrics(spark, sources, [c]).collect()[0]
        return _to_result(c, m, sources, _samples(sources, [c], {0: m}).get(0, []))
    except PySparkException as exc:
        if not _is_about_data(exc):
            raise
        return CheckResult(
            check_name=f"{c.check_type}:{c.source_name}",
            source_name=c.source_name,
            passed=False,
            severity="error",
            message=report(f"the check ended in an exception ({exc})"),
        )


def _to_result(
    c: Check, m: Row, sources: Mapping[str, DataFrame], sample: Sequence[str]
) -> CheckResult:
    return CheckResult(
        check_name=m.check_name,
        source_name=m.source_name,
        passed=m.passed,
        severity=m.severity,
        message=_message(c, m, sources, sample),
        metric_value=m.metric_value,
        threshold=m.threshold,
    )


def results_frame(spark: SparkSession, results: Sequence[CheckResult]) -> DataFrame:
    return spark.createDataFrame([Row(**asdict(r)) for r in results], RESULT_SCHEMA)


def summarize(results: DataFrame) -> DataFrame:
    """Counts of passed checks, failed errors and failed warnings."""
    failed = ~F.col("passed")
    return results.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("passed")).alias("passed"),
        F.count_if(failed & (F.col("severity") == "error")).alias("failed_errors"),
        F.count_if(failed & (F.col("severity") == "warning")).alias("failed_warnings"),
    )


def require_passed(results: Sequence[CheckResult]) -> None:
    """Gate: raise when a check of severity error failed."""
    failed = [r.check_name for r in results if not r.passed and r.severity == "error"]
    if failed:
        raise RuntimeError(f"{len(failed)} critical quality check(s) failed: {', '.join(failed)}")
