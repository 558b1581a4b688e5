"""Statistics, anomalies and rollups over a table of stage runs.

Columns: ``run_id, stage, status, duration_seconds, timestamp, row_count, error, metadata``.
The position of a record in the log is ``(timestamp, run_id, stage)``.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.numeric import rate
from millrace.functions.time import seconds_between
from millrace.session import workspace

RUN_LOG_SCHEMA = (
    "run_id string, stage string, status string, duration_seconds double, "
    "timestamp timestamp_ntz, row_count bigint, error string, metadata map<string,string>"
)
POSITION = ("timestamp", "run_id", "stage")
STATS_WINDOW = 20
RECENT_RUNS = 5
STAGES = ("extract", "load", "transform", "quality")

_AGE = "_millrace_age"


def _newest_first(ties: Sequence[str]):
    return [F.col(c).desc() for c in (*POSITION, *ties)]


def _ties(log: DataFrame) -> list[str]:
    return [c for c in ("duration_seconds", "row_count", "status") if c in log.columns]


def _recent(log: DataFrame, limit: int) -> DataFrame:
    """The newest ``limit`` records of every stage, numbered from 1 (newest).

    The rank filter is applied per map task first, so a stage with most of the log
    sends ``limit`` rows per task.
    """
    window = Window.partitionBy("stage").orderBy(*_newest_first(_ties(log)))
    return log.withColumn(_AGE, F.row_number().over(window)).filter(F.col(_AGE) <= limit)


def stage_history(log: DataFrame, stage: str | None = None, limit: int = STATS_WINDOW) -> DataFrame:
    """The newest records per stage (or of one stage), oldest first."""
    if stage is not None:
        log = log.filter(F.col("stage") == stage)
    return _recent(log, limit).drop(_AGE).orderBy("stage", *POSITION[:2], *_ties(log))


def stage_stats(
    log: DataFrame, limit: int = STATS_WINDOW, stages: Sequence[str] = ()
) -> DataFrame:
    """Per stage: mean and sample deviation over the successes among its newest records.

    ``success_rate`` is relative to all of those records. A deviation of fewer than two
    values is 0. A stage named in ``stages`` without a record has zeros throughout.
    """
    found = _stats(_recent(log, limit))
    if not stages:
        return found
    asked = F.explode(F.array(*[F.lit(s) for s in dict.fromkeys(stages)])).alias("stage")
    absent = log.sparkSession.range(1).select(asked).join(found, "stage", "left_anti")
    zeros = [F.lit(0.0).alias(c) for c in found.columns if c != "stage"]
    return found.unionByName(absent.select("stage", *zeros))


def _stats(recent: DataFrame, *extra) -> DataFrame:
    ok = F.col("status") == "success"
    duration = F.when(ok, F.col("duration_seconds"))
    rows = F.when(ok, F.coalesce(F.col("row_count"), F.lit(0)).cast("double"))

    def or_zero(c):
        return F.coalesce(c, F.lit(0.0))

    return recent.groupBy("stage").agg(
        or_zero(F.avg(duration)).alias("avg_duration"),
        or_zero(F.stddev_samp(duration)).alias("std_duration"),
        or_zero(F.avg(rows)).alias("avg_row_count"),
        or_zero(F.stddev_samp(rows)).alias("std_row_count"),
        rate(F.count_if(ok), F.count(F.lit(1))).alias("success_rate"),
        *extra,
    )


def anomalies(records: DataFrame, stats: DataFrame) -> DataFrame:
    """Records outside the expected range of their stage, one row per finding.

    Duration: strictly outside mean +/- 3 deviations (not below 0), when both are
    positive. Row count: positive but under half the mean.
    """
    mean, dev = F.col("avg_duration"), F.col("std_duration")
    low = F.greatest(F.lit(0.0), mean - 3 * dev)
    high = mean + 3 * dev
    took = F.col("duration_seconds")
    slow = (mean > 0) & (dev > 0) & ((took < low) | (took > high))
    rows = F.col("row_count")
    expected_rows = F.col("avg_row_count") * 0.5
    few = (F.col("avg_row_count") > 0) & (rows > 0) & (rows < expected_rows)

    def finding(metric: str, value, lower, upper, message):
        return F.struct(
            F.lit(metric).alias("metric"),
            value.cast("double").alias("current_value"),
            lower.alias("expected_min"),
            upper.alias("expected_max"),
            message.alias("message"),
        )

    duration_text = F.format_string(
        "%s: took %.2f s, usual is %.2f s to %.2f s", F.col("stage"), took, low, high
    )
    rows_text = F.format_string(
        "%s: %d rows, usual is %.0f and the least is %.0f",
        F.col("stage"), rows, F.col("avg_row_count"), expected_rows,
    )
    found = F.array_compact(
        F.array(
            F.when(slow, finding("duration", took, low, high, duration_text)),
            F.when(few, finding("row_count", rows, expected_rows, F.lit(float("inf")), rows_text)),
        )
    )
    # One row per stage: written first, its size is known and the records are not shuffled.
    path = workspace(stats.sparkSession, "stage-stats")
    stats.coalesce(1).write.parquet(path)
    known = stats.sparkSession.read.schema(stats.schema).parquet(path)
    joined = records.join(known, "stage").filter(slow | few)
    return joined.select(
        *[F.col(c) for c in records.columns if c in POSITION], F.inline(found)
    )


@dataclass(frozen=True)
class Dashboard:
    overall: DataFrame
    stages: DataFrame
    recent_failures: DataFrame


def dashboard(log: DataFrame) -> Dashboard:
    """Health summary: overall rate, per-stage statistics, latest failures."""
    failed = F.col("status") == "failed"
    overall = log.agg(
        F.count(F.lit(1)).alias("total_executions"),
        rate(F.count_if(F.col("status") == "success"), F.count(F.lit(1))).alias(
            "overall_success_rate"
        ),
    )
    last = F.struct(*[F.col(c) for c in log.columns if c != "stage"])
    stages = _stats(
        _recent(log, STATS_WINDOW),
        F.count_if(failed & (F.col(_AGE) <= RECENT_RUNS)).alias("recent_failures"),
        F.min_by(last, F.col(_AGE)).alias("last_run"),
    )
    return Dashboard(overall, stages, newest(log, STATS_WINDOW).filter(failed))


def newest(log: DataFrame, limit: int) -> DataFrame:
    """The newest records of the whole log: a top-n, not a global sort."""
    return log.orderBy(*_newest_first(_ties(log))).limit(limit)


def retained(log: DataFrame, limit: int) -> DataFrame:
    """What compaction keeps: the newest ``limit`` records of the log."""
    return newest(log, limit)


def append_runs(runs: DataFrame, path: str) -> None:
    """Append run records to the log folder, in the columns of ``RUN_LOG_SCHEMA``.

    Other columns are refused: what they hold goes into ``metadata``.
    """
    fields = T.StructType.fromDDL(RUN_LOG_SCHEMA).fields
    unknown = sorted(set(runs.columns) - {f.name for f in fields})
    if unknown:
        raise ValueError(f"the run log has no columns {unknown}; put them into metadata")
    runs.select(
        *[
            (F.col(f.name) if f.name in runs.columns else F.lit(None))
            .cast(f.dataType)
            .alias(f.name)
            for f in fields
        ]
    ).write.mode("append").parquet(path)


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(RUN_LOG_SCHEMA).parquet(path)


def compact_runs(spark: SparkSession, path: str, target: str, limit: int) -> DataFrame:
    """Write the newest records to another folder, to be used from then on."""
    retained(read_runs(spark, path), limit).coalesce(1).write.parquet(target)
    return read_runs(spark, target)


def run_rollup(stages: DataFrame) -> DataFrame:
    """Per run: success iff every stage succeeded or was skipped, and the time it took."""
    first, last = F.min("timestamp"), F.max("timestamp")
    return stages.groupBy("run_id").agg(
        F.bool_and(F.col("status").isin("success", "skipped")).alias("success"),
        F.count(F.lit(1)).alias("stages"),
        F.count_if(F.col("status") == "failed").alias("failed_stages"),
        seconds_between(first, last).alias("duration_seconds"),
    )


def skipped_stages(stages: DataFrame, order: Sequence[str] = STAGES) -> DataFrame:
    """Rows with status ``skipped`` for the stages after the first failed one of a run."""
    place = F.array_position(F.array(*[F.lit(s) for s in order]), F.col("stage"))
    names = F.array(*[F.lit(s) for s in order])
    first_failed = stages.groupBy("run_id").agg(
        F.min(F.when((F.col("status") == "failed") & (place > 0), place)).alias("at"),
        F.max("timestamp").alias("timestamp"),
    )
    return (
        first_failed.filter(F.col("at").isNotNull())
        .select(
            "run_id",
            F.explode(F.slice(names, (F.col("at") + 1).cast("int"), len(order))).alias("stage"),
            F.lit("skipped").alias("status"),
            F.lit(0.0).alias("duration_seconds"),
            "timestamp",
            F.lit(0).cast("bigint").alias("row_count"),
            F.lit(None).cast("string").alias("error"),
        )
    )
