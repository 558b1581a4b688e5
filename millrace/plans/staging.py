"""Staging views: newest load per key, typed and renamed. Lazy, nothing is written."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.numeric import cents_to_dollars
from millrace.operators.dedup import newest_per_key


def stg_orders(raw: DataFrame) -> DataFrame:
    """One row per order id."""
    return newest_per_key(raw, "id").select(
        F.col("id").cast("bigint").alias("order_id"),
        F.col("user_id").cast("bigint").alias("customer_id"),
        F.col("status").cast("string").alias("order_status"),
        F.col("order_date").cast("date").alias("ordered_at"),
        F.col("_loaded_at").cast("timestamp_ntz").alias("_loaded_at"),
    )


def stg_customers(raw: DataFrame) -> DataFrame:
    """One row per customer id, names without surrounding spaces."""
    return newest_per_key(raw, "id").select(
        F.col("id").cast("bigint").alias("customer_id"),
        F.trim(F.col("first_name").cast("string")).alias("first_name"),
        F.trim(F.col("last_name").cast("string")).alias("last_name"),
        F.col("_loaded_at").cast("timestamp_ntz").alias("_loaded_at"),
    )


def stg_payments(raw: DataFrame) -> DataFrame:
    """One row per payment id; the raw amount is in cents."""
    return newest_per_key(raw, "id").select(
        F.col("id").cast("bigint").alias("payment_id"),
        F.col("order_id").cast("bigint").alias("order_id"),
        F.col("payment_method").cast("string").alias("payment_method"),
        cents_to_dollars(F.col("amount").cast("bigint")).alias("amount_dollars"),
        F.col("_loaded_at").cast("timestamp_ntz").alias("_loaded_at"),
    )
