"""Load CSV sources into raw tables and verify the result."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import asdict, dataclass
from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from millrace.functions.casts import strict_cast
from millrace.functions.hashing import content_hash
from millrace.sinks.tables import (
    Warehouse,
    create_schema,
    create_table,
    load_overwrite,
    row_count,
)
from millrace.sources.pools import each_source
from millrace.sources.files import read_csv
from millrace.sources.schemas import RAW_TABLES, spark_type


@dataclass(frozen=True)
class LoadResult:
    source_name: str
    table_name: str
    row_count: int
    duration_seconds: float
    success: bool
    error: str | None = None


@dataclass(frozen=True)
class LoadVerification:
    table_name: str
    expected_rows: int
    actual_rows: int
    rows_match: bool
    message: str


RESULT_SCHEMA = (
    "source_name string, table_name string, row_count bigint, duration_seconds double, "
    "success boolean, error string"
)


def cast_declared(df: DataFrame, columns: Sequence[tuple[str, str]]) -> DataFrame:
    """Text columns to their declared types; a value that does not fit fails the job.

    Columns without a declaration stay text. A declared column the file lacks is NULL.
    """
    declared = dict(columns)
    extra = [c for c in df.columns if c not in declared]
    return df.select(
        *[
            strict_cast(F.col(f"`{c}`"), spark_type(t)).alias(c)
            if c in df.columns
            else F.lit(None).cast(spark_type(t)).alias(c)
            for c, t in columns
        ],
        *extra,
    )


def verify_load(w: Warehouse, name: str, expected_rows: int) -> LoadVerification:
    """Compare the rows written with the rows the table holds."""
    actual = row_count(w, name)
    table = f"{w.schema}.{name}"
    return LoadVerification(
        table_name=table,
        expected_rows=expected_rows,
        actual_rows=actual,
        rows_match=actual == expected_rows,
        message=f"{table}: {expected_rows} rows written, {actual} found",
    )


def compare_content(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """One row: counts and order-free content hashes of two frames, and whether they agree."""
    columns = sorted(expected.columns)

    def measured(df: DataFrame, side: str) -> DataFrame:
        return df.select(*columns).agg(
            F.lit(side).alias("side"),
            F.count(F.lit(1)).alias("n"),
            content_hash(df.select(*columns)).alias("h"),
        )

    def of(side: str, c: str):
        return F.max(F.when(F.col("side") == side, F.col(c)))

    return (
        measured(expected, "expected")
        .unionByName(measured(actual, "actual"))
        .agg(
            of("expected", "n").alias("expected_rows"),
            of("actual", "n").alias("actual_rows"),
            (of("expected", "n") == of("actual", "n")).alias("rows_match"),
            of("expected", "h").eqNullSafe(of("actual", "h")).alias("content_match"),
        )
    )


def load_source(
    w: Warehouse, source_name: str, path: str, loaded_at: datetime, multiline: bool = False
) -> LoadResult:
    """Read, cast, load and verify one CSV source; failures are reported, not raised.

    ``multiline``: fields may hold line breaks inside quotes.
    """
    started = datetime.now()

    def outcome(rows: int, success: bool, error: str | None = None) -> LoadResult:
        seconds = (datetime.now() - started).total_seconds()
        return LoadResult(source_name, f"{w.schema}.{source_name}", rows, seconds, success, error)

    columns = RAW_TABLES.get(source_name)
    try:
        raw = read_csv(w.spark, path, multiline)
        if columns is None:
            return outcome(0, False, f"No schema defined for source: {source_name}")
        create_schema(w)
        create_table(w, source_name, columns)
        written = load_overwrite(w, source_name, cast_declared(raw, columns), loaded_at)
        check = verify_load(w, source_name, written) if written else None
        # A mismatch is reported but does not undo the load.
        note = None if check is None or check.rows_match else check.message
        return outcome(written, True, note)
    except AnalysisException as exc:
        if exc.getCondition() == "PATH_NOT_FOUND":
            return outcome(0, False, f"Source file not found: {path}")
        return outcome(0, False, str(exc))
    except Exception as exc:
        return outcome(0, False, str(exc))


def load_all(
    w: Warehouse,
    paths: Mapping[str, str],
    loaded_at: datetime,
    multiline: bool = False,
    at_once: int = 3,
) -> list[LoadResult]:
    """Load every declared source that has a path, ``at_once`` of them at a time."""
    create_schema(w)
    names = [name for name in RAW_TABLES if name in paths]
    return each_source(
        w.spark, lambda n: load_source(w, n, paths[n], loaded_at, multiline), names, at_once
    )


def results_frame(spark: SparkSession, results: Sequence[LoadResult]) -> DataFrame:
    return spark.createDataFrame([Row(**asdict(r)) for r in results], RESULT_SCHEMA)


def load_summary(results: DataFrame) -> DataFrame:
    return results.agg(
        F.count_if("success").alias("succeeded"),
        F.count_if(~F.col("success")).alias("failed"),
        F.coalesce(F.sum("row_count"), F.lit(0)).alias("total_rows"),
    )
