"""Fact, dimension and daily marts over the staging views.

Money is summed in integer cents and divided once at the end: the result does not
depend on the order in which Spark adds the rows.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.numeric import cents_to_dollars, dollars_to_cents, percent_of
from millrace.operators.joins import join_splittable
from millrace.operators.quantiles import daily_median

RETURNED = ("returned", "return_pending")


def _payments_by_method(payments: DataFrame) -> DataFrame:
    """Count and cents per (order, method).

    Combined before the shuffle, so an order with a large share of the payments is a
    handful of rows by the time it meets a join.
    """
    return payments.groupBy("order_id", "payment_method").agg(
        F.count(F.lit(1)).alias("payments"),
        F.sum(dollars_to_cents(F.col("amount_dollars"))).alias("cents"),
    )


def _cents_of(method: str) -> Column:
    return F.sum(F.when(F.col("payment_method") == method, F.col("cents")).otherwise(F.lit(0)))


def _dollars_or_zero(cents: str) -> Column:
    return F.coalesce(cents_to_dollars(F.col(cents)), F.lit(0.0))


def _count_or_zero(c: str) -> Column:
    return F.coalesce(F.col(c), F.lit(0))


def in_date_range(
    orders: DataFrame, start_date: date | None = None, end_date: date | None = None
) -> DataFrame:
    """Staged orders placed between two dates, both inclusive; unfiltered by default."""
    if start_date is not None:
        orders = orders.filter(F.col("ordered_at") >= F.lit(start_date))
    if end_date is not None:
        orders = orders.filter(F.col("ordered_at") <= F.lit(end_date))
    return orders


def fct_orders(orders: DataFrame, payments: DataFrame, customers: DataFrame) -> DataFrame:
    """One row per order with its payment totals and customer names.

    Orders and payment totals are unique on order_id. A customer may hold any share of
    the orders, so that join is one adaptive execution can split.
    """
    paid = (
        _payments_by_method(payments)
        .groupBy("order_id")
        .agg(
            F.sum("cents").alias("total_cents"),
            F.sum("payments").alias("payment_count"),
            F.count("payment_method").alias("distinct_payment_methods"),
            _cents_of("credit_card").alias("credit_card_cents"),
            _cents_of("coupon").alias("coupon_cents"),
            _cents_of("bank_transfer").alias("bank_transfer_cents"),
            _cents_of("gift_card").alias("gift_card_cents"),
        )
    )
    names = customers.select(
        "customer_id",
        F.col("first_name").alias("customer_first_name"),
        F.col("last_name").alias("customer_last_name"),
    )
    return (
        orders.join(paid, "order_id", "left")
        .transform(join_splittable, names, "customer_id")
        .select(
            "order_id",
            "customer_id",
            "order_status",
            "ordered_at",
            "customer_first_name",
            "customer_last_name",
            _dollars_or_zero("total_cents").alias("order_total_dollars"),
            _count_or_zero("payment_count").alias("payment_count"),
            "distinct_payment_methods",
            _dollars_or_zero("credit_card_cents").alias("credit_card_amount"),
            _dollars_or_zero("coupon_cents").alias("coupon_amount"),
            _dollars_or_zero("bank_transfer_cents").alias("bank_transfer_amount"),
            _dollars_or_zero("gift_card_cents").alias("gift_card_amount"),
            F.coalesce(F.col("coupon_cents") > 0, F.lit(False)).alias("used_coupon"),
            F.coalesce(F.col("order_status").isin(*RETURNED), F.lit(False)).alias("is_returned"),
            "_loaded_at",
        )
    )


def customer_tier(total_orders: Column) -> Column:
    return (
        F.when(total_orders.isNull(), F.lit("inactive"))
        .when(total_orders == 1, F.lit("new"))
        .when(total_orders.between(2, 4), F.lit("active"))
        .otherwise(F.lit("loyal"))
    )


def dim_customers(customers: DataFrame, orders: DataFrame, payments: DataFrame) -> DataFrame:
    """One row per customer with order and payment totals and a tier.

    ``orders`` is unique on order_id, so its distinct counts are plain counts. Distinct
    methods and the most frequent method come from counts per (customer, method) instead
    of per-customer sets.
    """
    status = F.col("order_status")
    # Staged orders always have an id, so counting rows counts ids.
    ordered = orders.groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("orders_placed"),
        F.min("ordered_at").alias("first_order_at"),
        F.max("ordered_at").alias("most_recent_order_at"),
        F.count_if(status == "completed").alias("completed"),
        F.count_if(status.isin(*RETURNED)).alias("returned"),
    )
    method = F.col("payment_method")
    # Most payments first, then the alphabetically smallest; no method at all last.
    by_frequency = F.struct(
        F.when(method.isNotNull(), -F.col("payments")).otherwise(F.lit(1)), method
    )
    paid = (
        _payments_by_method(payments)
        .join(orders.select("order_id", "customer_id"), "order_id")
        .groupBy("customer_id", "payment_method")
        .agg(F.sum("payments").alias("payments"), F.sum("cents").alias("cents"))
        .groupBy("customer_id")
        .agg(
            F.sum("cents").alias("spent_cents"),
            F.count("payment_method").alias("distinct_payment_methods"),
            F.min(by_frequency).getField("payment_method").alias("preferred_payment_method"),
        )
    )
    return (
        customers.join(ordered, "customer_id", "left")
        .join(paid, "customer_id", "left")
        .select(
            "customer_id",
            "first_name",
            "last_name",
            F.concat("first_name", F.lit(" "), "last_name").alias("full_name"),
            _count_or_zero("orders_placed").alias("total_orders"),
            _count_or_zero("completed").alias("completed_orders"),
            _count_or_zero("returned").alias("returned_orders"),
            "first_order_at",
            "most_recent_order_at",
            _dollars_or_zero("spent_cents").alias("lifetime_spend_dollars"),
            "distinct_payment_methods",
            "preferred_payment_method",
            customer_tier(F.col("orders_placed")).alias("customer_tier"),
            "_loaded_at",
        )
    )


def metrics_daily(fct: DataFrame, calendar: bool = False) -> DataFrame:
    """One row per day with an order, sorted by day. Pass the materialised fact mart.

    ``fct`` is unique on order_id, so the conditional distinct counts are conditional
    counts; only customers are counted distinct. The running totals order days, not
    orders: their single task sees one row per day. ``calendar=True`` also fills the
    days without an order between the first and the last.
    """
    fct = fct.filter(F.col("ordered_at").isNotNull()).withColumn(
        "total_cents", dollars_to_cents(F.col("order_total_dollars"))
    )
    n = F.count(F.lit(1))
    status = F.col("order_status")
    daily = fct.groupBy(F.col("ordered_at").alias("date_day")).agg(
        n.alias("total_orders"),
        F.count_distinct("customer_id").alias("unique_customers"),
        F.sum("total_cents").alias("revenue_cents"),
        F.count_if(status == "completed").alias("completed_orders"),
        F.count_if(status == "placed").alias("placed_orders"),
        F.count_if(status == "shipped").alias("shipped_orders"),
        F.count_if("is_returned").alias("returned_orders"),
        F.count_if("used_coupon").alias("orders_with_coupon"),
        F.sum(dollars_to_cents(F.col("coupon_amount"))).alias("coupon_cents"),
    )
    medians = daily_median(fct, "ordered_at", "total_cents").select(
        F.col("day").alias("date_day"), F.col("median").alias("median_cents")
    )
    so_far = Window.orderBy("date_day").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    orders, revenue = _count_or_zero("total_orders"), _count_or_zero("revenue_cents")
    zero = F.lit(0.0)
    return (
        (_calendar(fct).join(daily, "date_day", "left") if calendar else daily)
        .join(medians, "date_day", "left")
        .select(
            "date_day",
            orders.alias("total_orders"),
            _count_or_zero("unique_customers").alias("unique_customers"),
            cents_to_dollars(revenue).alias("total_revenue_dollars"),
            F.coalesce(
                F.try_divide(cents_to_dollars(F.col("revenue_cents")), F.col("total_orders")), zero
            ).alias("avg_order_value_dollars"),
            F.coalesce(cents_to_dollars(F.col("median_cents")), zero).alias(
                "median_order_value_dollars"
            ),
            _count_or_zero("completed_orders").alias("completed_orders"),
            _count_or_zero("placed_orders").alias("placed_orders"),
            _count_or_zero("shipped_orders").alias("shipped_orders"),
            _count_or_zero("returned_orders").alias("returned_orders"),
            _count_or_zero("orders_with_coupon").alias("orders_with_coupon"),
            _dollars_or_zero("coupon_cents").alias("total_coupon_discount_dollars"),
            F.coalesce(percent_of(F.col("returned_orders"), F.col("total_orders")), zero).alias(
                "return_rate_pct"
            ),
            F.sum(orders).over(so_far).alias("cumulative_orders"),
            cents_to_dollars(F.sum(revenue).over(so_far)).alias("cumulative_revenue_dollars"),
        )
        .orderBy("date_day")
    )


def _calendar(fct: DataFrame) -> DataFrame:
    """Every day from the first to the last order."""
    span = fct.agg(F.min("ordered_at").alias("first"), F.max("ordered_at").alias("last"))
    return span.filter(F.col("first").isNotNull()).select(
        F.explode(F.sequence("first", "last")).alias("date_day")
    )
