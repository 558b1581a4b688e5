"""The driver's tables as raw orders, customers, payments and run log.

Each frame has a SQL twin of the same name for the oracles. ``messy_*`` are the same
rows as text with bad values: padding, wrong case, unknown words, blanks, NULLs.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.time import utc_literal

LOADED_AT = datetime(2024, 1, 1)
LOADED_AT_SQL = "timestamp '2024-01-01 00:00:00'"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def _status() -> Column:
    s, p = F.col("o_orderstatus"), F.col("o_orderpriority")
    urgent = p.isin("1-URGENT", "2-HIGH")
    return (
        F.when(s == "F", F.lit("completed"))
        .when(s == "O", F.when(urgent, F.lit("shipped")).otherwise(F.lit("placed")))
        .otherwise(F.when(urgent, F.lit("return_pending")).otherwise(F.lit("returned")))
    )


STATUS_SQL = """case when o_orderstatus = 'F' then 'completed'
     when o_orderstatus = 'O' then
       case when o_orderpriority in ('1-URGENT', '2-HIGH') then 'shipped' else 'placed' end
     else case when o_orderpriority in ('1-URGENT', '2-HIGH') then 'return_pending'
               else 'returned' end end"""


def _method() -> Column:
    flag, status = F.col("l_returnflag"), F.col("l_linestatus")
    return (
        F.when(flag == "R", F.lit("coupon"))
        .when(flag == "A", F.lit("gift_card"))
        .when(status == "O", F.lit("credit_card"))
        .otherwise(F.lit("bank_transfer"))
    )


METHOD_SQL = """case when l_returnflag = 'R' then 'coupon'
     when l_returnflag = 'A' then 'gift_card'
     when l_linestatus = 'O' then 'credit_card' else 'bank_transfer' end"""


def raw_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"),
        F.col("o_custkey").alias("user_id"),
        F.col("o_orderdate").cast("date").alias("order_date"),
        _status().alias("status"),
        utc_literal(LOADED_AT).alias("_loaded_at"),
    )


def raw_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"),
        F.concat(F.lit(" "), "c_mktsegment").alias("first_name"),
        F.concat("c_name", F.lit("  ")).alias("last_name"),
        utc_literal(LOADED_AT).alias("_loaded_at"),
    )


def raw_payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as payments. Their ids repeat, with different ship dates."""
    return read(spark, sf_dir, "lineitem").select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"),
        F.col("l_orderkey").alias("order_id"),
        _method().alias("payment_method"),
        F.round(F.col("l_extendedprice") * 100).cast("bigint").alias("amount"),
        F.col("l_shipdate").alias("_loaded_at"),
    )


RAW_SQL = f"""raw_orders as (
  select o_orderkey as id, o_custkey as user_id, cast(o_orderdate as date) as order_date,
         {STATUS_SQL} as status, {LOADED_AT_SQL} as _loaded_at
  from orders),
raw_customers as (
  select c_custkey as id, ' ' || c_mktsegment as first_name, c_name || '  ' as last_name,
         {LOADED_AT_SQL} as _loaded_at
  from customer),
raw_payments as (
  select l_orderkey * 10 + l_linenumber as id, l_orderkey as order_id,
         {METHOD_SQL} as payment_method,
         cast(round(l_extendedprice * 100) as bigint) as amount, l_shipdate as _loaded_at
  from lineitem)"""


def messy_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    p, s = F.col("o_orderpriority"), F.col("o_orderstatus")
    user = F.col("o_custkey").cast("string")
    status = _status()
    return read(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("id"),
        F.when(p == "1-URGENT", F.concat(F.lit(" "), user, F.lit(" ")))
        .when(p == "2-HIGH", F.concat(user, F.lit(".0")))
        .otherwise(user)
        .alias("user_id"),
        F.when((p == "5-LOW") & (s == "P"), F.date_format("o_orderdate", "yyyy/MM/dd"))
        .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
        .alias("order_date"),
        F.when(p == "1-URGENT", F.upper(status))
        .when(p == "2-HIGH", F.concat(F.lit("\t"), status, F.lit(" ")))
        .when((p == "4-NOT SPECIFIED") & (s == "O"), F.lit("unknown"))
        .when((p == "4-NOT SPECIFIED") & (s == "F"), F.lit(""))
        .otherwise(status)
        .alias("status"),
    )


def messy_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    segment = F.col("c_mktsegment")
    return read(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("id"),
        F.when(segment == "MACHINERY", F.lit("   "))
        .when(segment == "BUILDING", F.lit(""))
        .otherwise(segment)
        .alias("first_name"),
        F.when(F.col("c_acctbal") >= 0, F.concat(F.lit(" "), "c_name")).alias("last_name"),
    )


def messy_payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = F.col("l_linenumber")
    cents = F.round(F.col("l_extendedprice") * 100).cast("bigint").cast("string")
    return read(spark, sf_dir, "lineitem").select(
        (F.col("l_orderkey") * 10 + line).cast("string").alias("id"),
        F.col("l_orderkey").cast("string").alias("order_id"),
        F.when(line == 7, F.lit("cash"))
        .when(line == 6, F.upper(_method()))
        .otherwise(_method())
        .alias("payment_method"),
        F.when(line == 5, F.concat(F.lit("-"), cents))
        .when(line == 4, F.concat(cents, F.lit(".5")))
        .otherwise(cents)
        .alias("amount"),
    )


MESSY_SQL = f"""messy_orders as (
  select cast(o_orderkey as varchar) as id,
         case o_orderpriority when '1-URGENT' then ' ' || o_custkey || ' '
              when '2-HIGH' then o_custkey || '.0' else cast(o_custkey as varchar) end as user_id,
         case when o_orderpriority = '5-LOW' and o_orderstatus = 'P'
              then strftime(o_orderdate, '%Y/%m/%d')
              else strftime(o_orderdate, '%Y-%m-%d') end as order_date,
         case when o_orderpriority = '1-URGENT' then upper({STATUS_SQL})
              when o_orderpriority = '2-HIGH' then chr(9) || {STATUS_SQL} || ' '
              when o_orderpriority = '4-NOT SPECIFIED' and o_orderstatus = 'O' then 'unknown'
              when o_orderpriority = '4-NOT SPECIFIED' and o_orderstatus = 'F' then ''
              else {STATUS_SQL} end as status
  from orders),
messy_customers as (
  select cast(c_custkey as varchar) as id,
         case c_mktsegment when 'MACHINERY' then '   ' when 'BUILDING' then ''
              else c_mktsegment end as first_name,
         case when c_acctbal >= 0 then ' ' || c_name end as last_name
  from customer),
messy_payments as (
  select cast(l_orderkey * 10 + l_linenumber as varchar) as id,
         cast(l_orderkey as varchar) as order_id,
         case l_linenumber when 7 then 'cash' when 6 then upper({METHOD_SQL})
              else {METHOD_SQL} end as payment_method,
         case l_linenumber when 5 then '-' || cast(round(l_extendedprice * 100) as bigint)
              when 4 then cast(round(l_extendedprice * 100) as bigint) || '.5'
              else cast(cast(round(l_extendedprice * 100) as bigint) as varchar) end as amount
  from lineitem)"""


def run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as stage runs, one run per day."""
    value = F.col("value")
    return read(spark, sf_dir, "events").select(
        F.date_format("ts", "yyyy-MM-dd").alias("run_id"),
        F.col("event_type").alias("stage"),
        F.when(value < 20, F.lit("failed")).otherwise(F.lit("success")).alias("status"),
        value.alias("duration_seconds"),
        F.col("ts").alias("timestamp"),
        F.col("user_id").alias("row_count"),
    )


RUN_LOG_SQL = """run_log as (
  select strftime(ts, '%Y-%m-%d') as run_id, event_type as stage,
         case when value < 20 then 'failed' else 'success' end as status,
         value as duration_seconds, ts as timestamp, user_id as row_count
  from events)"""


def strip_sql(expression: str) -> str:
    return rf"regexp_replace({expression}, '^\s+|\s+$', '', 'g')"
