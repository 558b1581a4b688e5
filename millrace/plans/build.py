"""Build the marts from raw tables. Staging and marts are written once and read back."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from millrace.plans.marts import dim_customers, fct_orders, metrics_daily
from millrace.plans.staging import stg_customers, stg_orders, stg_payments


def write_mart(df: DataFrame, path: str) -> DataFrame:
    """Write a mart and read it back.

    Adaptive execution sizes the partitions of the last shuffle, and with them the files.
    """
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def build_marts(
    spark: SparkSession, raw: Mapping[str, DataFrame], base: str
) -> dict[str, DataFrame]:
    """All models by name. ``raw`` holds orders, customers and payments.

    Several marts and their tests read the staged rows: written, each raw table is
    deduplicated once.
    """
    lazy = {
        "stg_orders": stg_orders(raw["orders"]),
        "stg_customers": stg_customers(raw["customers"]),
        "stg_payments": stg_payments(raw["payments"]),
    }
    staged = {name: write_mart(df, f"{base}/{name}") for name, df in lazy.items()}
    orders, customers, payments = staged.values()
    fct = write_mart(fct_orders(orders, payments, customers), f"{base}/fct_orders")
    dim = write_mart(dim_customers(customers, orders, payments), f"{base}/dim_customers")
    # A few thousand days: one sorted file.
    daily_path = f"{base}/metrics_daily"
    metrics_daily(fct).coalesce(1).write.mode("overwrite").parquet(daily_path)
    return {
        **staged,
        "fct_orders": fct,
        "dim_customers": dim,
        "metrics_daily": spark.read.parquet(daily_path),
    }
