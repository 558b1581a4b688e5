"""Staging views and marts."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators.quantiles import daily_median as exact_median
from millrace.plans.build import write_mart
from millrace.plans.marts import dim_customers as build_dim_customers
from millrace.plans.marts import fct_orders as build_fct_orders
from millrace.plans.marts import in_date_range
from millrace.plans.marts import metrics_daily as build_metrics_daily
from millrace.plans.staging import stg_customers as stage_customers
from millrace.plans.staging import stg_orders as stage_orders
from millrace.plans.staging import stg_payments as stage_payments
from millrace.session import workspace
from millrace.workload.registry import query
from millrace.workload.tables import RAW_SQL, raw_customers, raw_orders, raw_payments

START, END = date(1995, 6, 1), date(1995, 12, 31)

STAGING_SQL = f"""{RAW_SQL},
stg_orders as (
  select id as order_id, user_id as customer_id, status as order_status,
         order_date as ordered_at, _loaded_at
  from (select *, row_number() over (partition by id order by _loaded_at desc nulls last,
               user_id desc nulls last, order_date desc nulls last, status desc nulls last) as n
        from raw_orders) where n = 1 and id is not null),
stg_customers as (
  select id as customer_id, trim(first_name) as first_name, trim(last_name) as last_name,
         _loaded_at
  from (select *, row_number() over (partition by id order by _loaded_at desc nulls last,
               first_name desc nulls last, last_name desc nulls last) as n
        from raw_customers) where n = 1 and id is not null),
stg_payments as (
  select id as payment_id, order_id, payment_method,
         cast(amount as double) / 100 as amount_dollars, amount as cents, _loaded_at
  from (select *, row_number() over (partition by id order by _loaded_at desc nulls last,
               order_id desc nulls last, payment_method desc nulls last,
               amount desc nulls last) as n
        from raw_payments) where n = 1 and id is not null)"""


def _dollars(cents: str) -> str:
    return f"cast(coalesce({cents}, 0) as bigint)::double / 100"


_METHODS = ("credit_card", "coupon", "bank_transfer", "gift_card")
_PER_METHOD = ",\n         ".join(
    f"{_dollars(f'sum(cents) filter (payment_method = {m!r})')} as {m}_amount" for m in _METHODS
)

#: Grain: an order. Payments are summed on the way in, so nothing multiplies.
FCT_SQL = f"""{STAGING_SQL},
paid as (
  select order_id, {_dollars("sum(cents)")} as order_total_dollars, count(*) as payment_count,
         count(distinct payment_method) as distinct_payment_methods, {_PER_METHOD},
         coalesce(sum(cents) filter (payment_method = 'coupon') > 0, false) as used_coupon
  from stg_payments group by order_id),
fct_orders as (
  select order_id, customer_id, order_status, ordered_at, first_name as customer_first_name,
         last_name as customer_last_name, distinct_payment_methods,
         coalesce(columns(['order_total_dollars', 'credit_card_amount', 'coupon_amount',
                           'bank_transfer_amount', 'gift_card_amount']), 0.0),
         ifnull(payment_count, 0) as payment_count, ifnull(used_coupon, false) as used_coupon,
         order_status like 'return%' as is_returned, stg_orders._loaded_at
  from stg_orders left join paid using (order_id)
  left join stg_customers using (customer_id))"""


def dim_sql(orders: str) -> str:
    """Grain: a customer. One aggregation over orders, one over (customer, method)."""
    return f"""placed as (
  select customer_id, count(*) as n, min(ordered_at) as oldest, max(ordered_at) as newest,
         count(*) filter (order_status = 'completed') as done,
         count(*) filter (order_status like 'return%') as back
  from {orders} group by customer_id),
by_method as (
  select customer_id, payment_method, count(*) as n, sum(cents) as cents
  from stg_payments semi join {orders} using (order_id)
  join (select order_id, customer_id from {orders}) using (order_id)
  group by customer_id, payment_method),
spent as (
  select customer_id, sum(cents) as cents, count(payment_method) as methods,
         list(payment_method order by n desc, payment_method)
           filter (payment_method is not null)[1] as favourite
  from by_method group by customer_id),
dim_customers as (
  select customer_id, first_name, last_name, first_name || ' ' || last_name as full_name,
         ifnull(n, 0) as total_orders, ifnull(done, 0) as completed_orders,
         ifnull(back, 0) as returned_orders, oldest as first_order_at,
         newest as most_recent_order_at, {_dollars("cents")} as lifetime_spend_dollars,
         methods as distinct_payment_methods, favourite as preferred_payment_method,
         case when n is null then 'inactive' when n < 2 then 'new' when n < 5 then 'active'
              else 'loyal' end as customer_tier, stg_customers._loaded_at
  from stg_customers left join placed using (customer_id) left join spent using (customer_id))"""


def daily_sql(days: str) -> str:
    """Grain: a day. Facts are unique per order, so orders are counted as rows."""
    return f"""priced as (
  select *, cast(round(order_total_dollars * 100) as bigint) as cents,
         cast(round(coupon_amount * 100) as bigint) as coupon_cents
  from fct_orders where ordered_at is not null),
per_day as (
  select ordered_at as date_day, count(*) as n, count(distinct customer_id) as buyers,
         sum(cents) as cents, median(cents::double) as middle, sum(coupon_cents) as off,
         count(*) filter (order_status = 'completed') as done,
         count(*) filter (order_status = 'placed') as waiting,
         count(*) filter (order_status = 'shipped') as sent,
         count(*) filter (is_returned) as back, count(*) filter (used_coupon) as coupons
  from priced group by ordered_at),
metrics_daily as (
  select date_day, ifnull(n, 0) as total_orders, ifnull(buyers, 0) as unique_customers,
         {_dollars("cents")} as total_revenue_dollars,
         ifnull({_dollars("cents")} / n, 0) as avg_order_value_dollars,
         ifnull(middle / 100, 0) as median_order_value_dollars,
         ifnull(done, 0) as completed_orders, ifnull(waiting, 0) as placed_orders,
         ifnull(sent, 0) as shipped_orders, ifnull(back, 0) as returned_orders,
         ifnull(coupons, 0) as orders_with_coupon,
         {_dollars("off")} as total_coupon_discount_dollars,
         ifnull(round(back::double / n * 100, 2), 0) as return_rate_pct,
         cast(ifnull(sum(n) over upto, 0) as bigint) as cumulative_orders,
         {_dollars("sum(cents) over upto")} as cumulative_revenue_dollars
  from ({days}) left join per_day using (date_day)
  window upto as (order by date_day))"""


SPINE_SQL = "select date_day from per_day"
CALENDAR_SQL = """select cast(unnest(range(min(date_day), max(date_day) + interval 1 day,
         interval 1 day)) as date) as date_day from per_day"""


def staged(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Staged orders, payments and customers."""
    return (
        stage_orders(raw_orders(spark, sf_dir)),
        stage_payments(raw_payments(spark, sf_dir)),
        stage_customers(raw_customers(spark, sf_dir)),
    )


@query(f"with {STAGING_SQL} select * from stg_orders")
def stg_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stage_orders(raw_orders(spark, sf_dir))


@query(f"with {STAGING_SQL} select * from stg_customers")
def stg_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stage_customers(raw_customers(spark, sf_dir))


@query(f"with {STAGING_SQL} select * exclude (cents) from stg_payments")
def stg_payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stage_payments(raw_payments(spark, sf_dir))


@query(f"with {FCT_SQL} select * from fct_orders")
def fct_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_fct_orders(*staged(spark, sf_dir))


@query(f"with {STAGING_SQL}, {dim_sql('stg_orders')} select * from dim_customers")
def dim_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, payments, customers = staged(spark, sf_dir)
    return build_dim_customers(customers, orders, payments)


@query(
    f"""with {STAGING_SQL}, in_range as (
  select * from stg_orders where ordered_at between date '{START}' and date '{END}'),
{dim_sql("in_range")} select * from dim_customers"""
)
def dim_customers_date_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half a year of orders: all four tiers occur."""
    orders, payments, customers = staged(spark, sf_dir)
    return build_dim_customers(customers, in_date_range(orders, START, END), payments)


def _written_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The columns of the fact mart the daily rollup reads, written once."""
    fct = build_fct_orders(*staged(spark, sf_dir)).select(
        "order_id",
        "customer_id",
        "order_status",
        "ordered_at",
        "order_total_dollars",
        "coupon_amount",
        "used_coupon",
        "is_returned",
    )
    return write_mart(fct, workspace(spark, "fct_orders"))


@query(f"with {FCT_SQL}, {daily_sql(SPINE_SQL)} select * from metrics_daily")
def metrics_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_metrics_daily(_written_facts(spark, sf_dir))


@query(f"with {FCT_SQL}, {daily_sql(CALENDAR_SQL)} select * from metrics_daily")
def metrics_daily_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_metrics_daily(_written_facts(spark, sf_dir), calendar=True)


@query(
    f"""with {FCT_SQL} select ordered_at as day,
    median(cast(round(order_total_dollars * 100) as double)) as median
    from fct_orders group by ordered_at"""
)
def daily_median(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The exact median on its own."""
    fct = _written_facts(spark, sf_dir).withColumn(
        "cents", F.rint(F.col("order_total_dollars") * 100).cast("bigint")
    )
    return exact_median(fct, "ordered_at", "cents")
