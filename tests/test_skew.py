"""Hot keys: the plans that keep one key from becoming one task."""

import pytest
from pyspark.sql import functions as F

from millrace.operators.column_tests import relationships_failures
from millrace.operators.joins import join_splittable
from millrace.operators.quantiles import daily_median
from millrace.operators.runlog import anomalies, stage_stats
from millrace.plans.marts import fct_orders
from millrace.plans.staging import stg_customers, stg_orders, stg_payments
from millrace.workload import tables

SETTINGS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16KB",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "4KB",
}


@pytest.fixture
def skew_settings(spark):
    before = {k: spark.conf.get(k, None) for k in SETTINGS}
    for k, v in SETTINGS.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def hot(column="k", rows=40_000):
    """Two rows in three share one key."""
    return F.when(F.col("id") % 3 == 0, F.col("id") % 5000).otherwise(F.lit(7)).alias(column)


@pytest.mark.parametrize("how", ["left", "inner", "left_semi"])
def test_hot_key_is_split(spark, skew_settings, how):
    left = spark.range(0, 40_000, 1, 8).select(hot(), F.sha2(F.col("id").cast("string"), 256).alias("v"))
    ids = spark.range(5000).repartition(8)
    right = ids.groupBy(F.col("id").alias("k")).agg(F.count("*").alias("n"))
    # The aggregated side is partitioned by the key already: a plain join cannot be split.
    assert "skew=true" not in final_plan(left.join(right, "k", how))
    joined = join_splittable(left, right, "k", how)
    assert "skew=true" in final_plan(joined)
    assert joined.count() == 40_000


def test_null_keys_match_nothing(spark):
    left = spark.createDataFrame([(1,), (None,)], "k int")
    right = spark.createDataFrame([(1, "a"), (None, "b")], "k int, v string")
    assert sorted(map(tuple, join_splittable(left, right, "k").collect()), key=repr) == [(1, "a"), (None, None)]


def test_fact_mart_splits_a_hot_customer(spark, skew_settings):
    at = F.lit("2024-01-01").cast("timestamp_ntz").alias("_loaded_at")
    ids = spark.range(0, 40_000, 1, 8)
    orders = ids.select(
        "id", hot("user_id"), F.lit("2024-01-01").cast("date").alias("order_date"),
        F.lit("placed").alias("status"), at,
    )
    customers = spark.range(5000).repartition(8).select(
        "id", F.lit("A").alias("first_name"), F.lit("B").alias("last_name"), at
    )
    payments = ids.select(
        "id", F.lit(1).alias("order_id"), F.lit("coupon").alias("payment_method"),
        F.lit(5).alias("amount"), at,
    )
    fct = fct_orders(stg_orders(orders), stg_payments(payments), stg_customers(customers))
    assert "skew=true" in final_plan(fct)
    assert fct.filter("customer_first_name = 'A'").count() == 40_000
    assert fct.filter("order_id = 1").first().order_total_dollars == 2000.0


def test_anomalies_split_a_hot_stage(spark, skew_settings):
    log = spark.range(0, 40_000, 1, 8).select(
        F.col("id").cast("string").alias("run_id"), hot("k").cast("string").alias("stage"),
        F.lit("success").alias("status"), F.rand(1).alias("duration_seconds"),
        F.timestamp_seconds("id").cast("timestamp_ntz").alias("timestamp"),
        F.col("id").alias("row_count"),
    )
    assert "skew=true" in final_plan(anomalies(log, stage_stats(log)))


def test_orphans_of_a_hot_key_are_split(spark, skew_settings):
    child = spark.range(0, 40_000, 1, 8).select(hot(), F.sha2(F.col("id").cast("string"), 256).alias("v"))
    parent = spark.range(100, 5000).repartition(8).withColumnRenamed("id", "p")
    failures = relationships_failures(child, "k", parent, "p")
    assert "skew=true" in final_plan(failures)
    assert failures.count() == child.filter("k < 100").count()


def test_median_counters_are_combined_before_each_shuffle(spark):
    df = spark.range(0, 50_000, 1, 8).select(
        F.lit("2024-01-01").cast("date").alias("d"), (F.col("id") % 1000).alias("v")
    )
    plan = daily_median(df, "d", "v")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("partial_count") == 2
    assert daily_median(df, "d", "v").first().median == 499.5


def test_filters_and_columns_reach_the_scan(spark):
    sf_dir = "/root/testdata/sf0.001"
    staged = stg_payments(tables.raw_payments(spark, sf_dir)).select("payment_id", "amount_dollars")
    plan = staged._jdf.queryExecution().executedPlan().toString()
    assert "IsNotNull(l_orderkey)" in plan
    assert "l_tax" not in plan and "l_discount" not in plan
