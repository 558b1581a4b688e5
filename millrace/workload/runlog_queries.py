"""Run-log analytics over events taken as stage runs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators import runlog
from millrace.session import workspace
from millrace.workload.registry import query
from millrace.workload.tables import RUN_LOG_SQL
from millrace.workload.tables import run_log as read_log

_ORDER = """timestamp desc, run_id desc, stage desc, duration_seconds desc, row_count desc,
    status desc"""
_STATS = ("avg_duration", "std_duration", "avg_row_count", "std_row_count", "success_rate")

_RECENT_SQL = f"""{RUN_LOG_SQL},
recent as (select * from (select *, row_number() over (partition by stage order by {_ORDER}) as age
  from run_log) where age <= 20),
stats as (
  select stage,
    coalesce(avg(duration_seconds) filter (where status = 'success'), 0) as avg_duration,
    coalesce(stddev_samp(duration_seconds) filter (where status = 'success'), 0) as std_duration,
    coalesce(avg(row_count) filter (where status = 'success'), 0) as avg_row_count,
    coalesce(stddev_samp(row_count) filter (where status = 'success'), 0) as std_row_count,
    cast(count(*) filter (where status = 'success') as double) / count(*) as success_rate,
    count(*) filter (where status = 'failed' and age <= 5) as recent_failures,
    min_by(timestamp, age) as last_timestamp, min_by(status, age) as last_status
  from recent group by stage)"""
_ROUNDED_SQL = ", ".join(f"round({c}, 6) as {c}" for c in _STATS)


def _rounded(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in _STATS})


@query(f"with {_RECENT_SQL} select * exclude (age) from recent")
def run_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runlog.stage_history(read_log(spark, sf_dir))


@query(
    f"""with {_RECENT_SQL} select stage, {_ROUNDED_SQL} from stats
  union all select 'refund', {", ".join(f"0.0::double as {c}" for c in _STATS)}
  where 'refund' not in (select stage from run_log)"""
)
def run_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages of the log, and one that has never run."""
    log = read_log(spark, sf_dir)
    return _rounded(runlog.stage_stats(log, stages=["click", "refund"]))


@query(
    f"""with {_RECENT_SQL}, j as (
  select r.*, greatest(0, avg_duration - 3 * std_duration) as low,
         avg_duration + 3 * std_duration as high, avg_row_count * 0.5 as few, avg_duration,
         std_duration, avg_row_count
  from run_log r join stats s on r.stage = s.stage)
select stage, run_id, timestamp, 'duration' as metric, duration_seconds as current_value,
       round(low, 6) as expected_min
from j where avg_duration > 0 and std_duration > 0
  and (duration_seconds < low or duration_seconds > high)
union all
select stage, run_id, timestamp, 'row_count', cast(row_count as double), round(few, 6)
from j where avg_row_count > 0 and row_count > 0 and row_count < few"""
)
def run_anomalies(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = read_log(spark, sf_dir)
    return runlog.anomalies(log, runlog.stage_stats(log)).select(
        "stage",
        "run_id",
        "timestamp",
        "metric",
        "current_value",
        F.round("expected_min", 6).alias("expected_min"),
    )


@query(
    f"""with {_RECENT_SQL} select stage, {_ROUNDED_SQL}, recent_failures,
  last_timestamp, last_status from stats"""
)
def run_dashboard_stages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(runlog.dashboard(read_log(spark, sf_dir)).stages).select(
        "stage",
        *_STATS,
        "recent_failures",
        F.col("last_run.timestamp").alias("last_timestamp"),
        F.col("last_run.status").alias("last_status"),
    )


@query(
    f"""with {RUN_LOG_SQL} select count(*) as total_executions,
  cast(count(*) filter (where status = 'success') as double) / count(*) as overall_success_rate
  from run_log"""
)
def run_dashboard_overall(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runlog.dashboard(read_log(spark, sf_dir)).overall


@query(
    f"""with {RUN_LOG_SQL} select * from (select * from run_log order by {_ORDER} limit 20)
  where status = 'failed'"""
)
def run_dashboard_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runlog.dashboard(read_log(spark, sf_dir)).recent_failures


@query(f"with {RUN_LOG_SQL} select * from run_log order by {_ORDER} limit 1000")
def run_retained(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runlog.retained(read_log(spark, sf_dir), 1000)


@query(
    f"""with {RUN_LOG_SQL} select *, cast(null as varchar) as error,
  'user ' || row_count as user_note from run_log order by {_ORDER} limit 1000"""
)
def run_log_compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log appended in two parts, then compacted to its newest records."""
    base, log = workspace(spark, "runs"), read_log(spark, sf_dir)
    note = F.concat(F.lit("user "), F.col("row_count").cast("string"))
    log = log.withColumn("metadata", F.create_map(F.lit("note"), note))
    for status in ("failed", "success"):
        runlog.append_runs(log.filter(F.col("status") == status), f"{base}/log")
    compacted = runlog.compact_runs(spark, f"{base}/log", f"{base}/compacted", 1000)
    return compacted.withColumn("user_note", F.col("metadata")["note"]).drop("metadata")


@query(
    f"""with {RUN_LOG_SQL} select run_id, bool_and(status in ('success', 'skipped')) as success,
  count(*) as stages, count(*) filter (where status = 'failed') as failed_stages,
  cast(date_diff('microsecond', min(timestamp), max(timestamp)) as double) / 1000000
    as duration_seconds
  from run_log group by run_id"""
)
def run_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runlog.run_rollup(read_log(spark, sf_dir))


_STAGE_ORDER = ("signup", "click", "purchase", "error")


@query(
    f"""with {RUN_LOG_SQL}, place as (
  select run_id, timestamp, status,
         list_position(['signup', 'click', 'purchase', 'error'], stage) as step_no from run_log),
first_failed as (select run_id,
  min(step_no) filter (where status = 'failed' and step_no > 0) as step_no,
  max(timestamp) as timestamp from place group by run_id)
select run_id, unnest(['signup', 'click', 'purchase', 'error'][step_no + 1:]) as stage,
  'skipped' as status, timestamp
from first_failed where step_no is not null"""
)
def run_skipped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stages that count as skipped after the first failed one of their run."""
    skipped = runlog.skipped_stages(read_log(spark, sf_dir), _STAGE_ORDER)
    return skipped.select("run_id", "stage", "status", "timestamp")
