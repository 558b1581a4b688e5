"""Dedup, casts, null handling, rule validation and history."""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.hashing import row_hash as hash_of
from millrace.functions.time import utc_literal
from millrace.operators import cleaning
from millrace.operators.dedup import deduplicate
from millrace.operators.history import merge_history
from millrace.operators.history import repeated_current as repeated
from millrace.operators.record_checks import check_completeness
from millrace.operators.rules import CUSTOMER_RULES, ORDER_RULES, PAYMENT_RULES, validate
from millrace.session import workspace
from millrace.sinks.history import store_history
from millrace.sinks.tables import Warehouse, create_schema
from millrace.workload.registry import query
from millrace.workload.tables import (
    MESSY_SQL,
    messy_customers,
    messy_orders,
    messy_payments,
    read,
    strip_sql,
)

# --- dedup -------------------------------------------------------------------------------

_LINE_KEYS = ("l_orderkey", "l_linenumber")
_LINE_REST = (
    "l_partkey",
    "l_suppkey",
    "l_quantity",
    "l_extendedprice",
    "l_discount",
    "l_tax",
    "l_returnflag",
    "l_linestatus",
)


def _dedup_sql(direction: str) -> str:
    order = ", ".join(f"{c} {direction}" for c in ("l_shipdate", *_LINE_REST))
    return f"""select * exclude (n) from (select *, row_number() over (
      partition by {", ".join(_LINE_KEYS)} order by {order}) as n from lineitem) where n = 1"""


@query(_dedup_sql("desc nulls last"))
def dedup_last(spark: SparkSession, sf_dir: str) -> DataFrame:
    return deduplicate(read(spark, sf_dir, "lineitem"), _LINE_KEYS, ["l_shipdate"], "last")


@query(_dedup_sql("asc nulls first"))
def dedup_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    return deduplicate(read(spark, sf_dir, "lineitem"), _LINE_KEYS, ["l_shipdate"], "first")


@query(
    f"""with {MESSY_SQL} select status, id, user_id, order_date from (
    select *, row_number() over (partition by status order by id desc nulls last,
      user_id desc nulls last, order_date desc nulls last) as n from messy_orders) where n = 1"""
)
def dedup_few_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A handful of keys, each with a large share of the rows."""
    df = messy_orders(spark, sf_dir).select("status", "id", "user_id", "order_date")
    return deduplicate(df, ["status"], ["id"], "last")


# --- casts -------------------------------------------------------------------------------


def _cast_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text values, good and bad, one column per target type."""
    p = F.col("o_orderpriority")
    key, price = F.col("o_orderkey").cast("string"), F.col("o_totalprice").cast("string")
    day = F.date_format("o_orderdate", "yyyy-MM-dd")

    def by_priority(urgent, high, medium, unspecified, low):
        return (
            F.when(p == "1-URGENT", urgent)
            .when(p == "2-HIGH", high)
            .when(p == "3-MEDIUM", medium)
            .when(p == "4-NOT SPECIFIED", unspecified)
            .otherwise(low)
        )

    null = F.lit(None).cast("string")
    return read(spark, sf_dir, "orders").select(
        F.col("o_orderkey"),
        by_priority(
            F.concat(F.lit(" +"), key, F.lit("\t")),
            F.concat(key, F.lit(".5")),
            F.lit("  "),
            F.lit("abc"),
            F.concat(key, F.lit("_000")),
        ).alias("i"),
        by_priority(
            F.concat(price, F.lit("f")),
            F.concat(price, F.lit("e2")),
            F.lit(""),
            price,
            F.concat(F.lit("-"), price),
        ).alias("f"),
        by_priority(F.lit("TRUE"), F.lit(" yes "), F.lit("maybe"), F.lit(""), null).alias("b"),
        by_priority(
            day,
            F.date_format("o_orderdate", "yyyy-M-d'x'"),
            F.date_format("o_orderdate", "yyyyMMdd"),
            F.concat(F.lit(" "), day, F.lit(" ")),
            F.lit("2024-02-30"),
        ).alias("d"),
        by_priority(
            F.concat(day, F.lit("T10:30:00")),
            F.concat(day, F.lit(" 10:30:00.250")),
            F.concat(day, F.lit("T10:30:00+02:00")),
            day,
            F.concat(day, F.lit("T25:00:00")),
        ).alias("t"),
        by_priority(price, F.lit("12,5"), F.lit(" 1.25 "), F.lit(""), F.lit("1_000.5")).alias("n"),
        F.col("o_totalprice").alias("x"),
    )


_CASTS = {
    "i": "int",
    "f": "float",
    "b": "bool",
    "d": "date",
    "t": "datetime",
    "n": "decimal",
    "x": "int",
    "absent": "int",
}

_CAST_SQL = """select o_orderkey,
  case o_orderpriority when '1-URGENT' then o_orderkey when '5-LOW' then o_orderkey * 1000 end as i,
  case o_orderpriority when '2-HIGH' then cast(cast(o_totalprice as varchar) || 'e2' as double)
       when '4-NOT SPECIFIED' then o_totalprice when '5-LOW' then -o_totalprice end as f,
  case o_orderpriority when '1-URGENT' then true when '2-HIGH' then true
       when '3-MEDIUM' then false end as b,
  case when o_orderpriority in ('1-URGENT', '3-MEDIUM', '4-NOT SPECIFIED')
       then cast(o_orderdate as date) end as d,
  case o_orderpriority when '1-URGENT' then cast(o_orderdate as date) + interval 630 minute
       when '2-HIGH' then cast(o_orderdate as date) + interval 37800250 millisecond
       when '3-MEDIUM' then cast(o_orderdate as date) + interval 510 minute
       when '4-NOT SPECIFIED' then cast(cast(o_orderdate as date) as timestamp) end as t,
  case o_orderpriority when '1-URGENT' then cast(cast(o_totalprice as varchar) as double)
       when '3-MEDIUM' then 1.25::double when '5-LOW' then 1000.5::double end as n,
  cast(trunc(o_totalprice) as bigint) as x
  from orders"""


@query(_CAST_SQL)
def cast_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    cast = cleaning.cast_types(_cast_input(spark, sf_dir), _CASTS)
    return cast.withColumn("n", F.col("n").cast("double"))


@query(
    """select count(*) filter (where o_orderpriority in ('2-HIGH', '4-NOT SPECIFIED')) as i,
  count(*) filter (where o_orderpriority = '1-URGENT') as f, 0::bigint as b,
  count(*) filter (where o_orderpriority in ('2-HIGH', '5-LOW')) as d,
  count(*) filter (where o_orderpriority = '5-LOW') as t,
  count(*) filter (where o_orderpriority = '2-HIGH') as n, 0::bigint as x from orders"""
)
def cast_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Non-blank values each lenient cast turns into NULL."""
    df = _cast_input(spark, sf_dir)
    return df.agg(*cleaning.cast_failures(df, _CASTS))


# --- nulls, filters, chains --------------------------------------------------------------


@query(
    f"""with {MESSY_SQL} select id,
  case when first_name is null or {strip_sql("first_name")} = '' then 'unknown'
       else first_name end as first_name,
  coalesce(last_name, 'n/a') as last_name, 'web' as channel from messy_customers"""
)
def fill_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.fill_nulls(
        messy_customers(spark, sf_dir),
        {"first_name": "unknown", "last_name": "n/a", "channel": "web"},
    )


@query(
    f"""with {MESSY_SQL} select * from messy_customers where first_name is not null
  and {strip_sql("first_name")} <> '' and last_name is not null"""
)
def drop_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.drop_nulls(messy_customers(spark, sf_dir), ["first_name", "last_name"])


@query("select * from lineitem where l_quantity >= 25 and l_returnflag in ('A', 'R')")
def filter_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.filter_rows(
        read(spark, sf_dir, "lineitem"),
        (F.col("l_quantity") >= 25) & F.col("l_returnflag").isin("A", "R"),
    )


def _chain(spark: SparkSession, sf_dir: str, count_rows: bool) -> cleaning.StepRun:
    return cleaning.run_steps(
        messy_payments(spark, sf_dir),
        [
            cleaning.dedup_step(["id"], ["amount"]),
            cleaning.cast_step({"id": "int", "order_id": "int", "amount": "int"}),
            cleaning.filter_step(F.col("payment_method") != "cash", "no cash"),
            cleaning.drop_step(["amount"]),
            cleaning.fill_step({"currency": "EUR"}),
        ],
        count_rows=count_rows,
    )


_CHAIN_SQL = f"""{MESSY_SQL},
deduplicated as (select * exclude (n) from (select *, row_number() over (partition by id
    order by amount desc nulls last, order_id desc nulls last, payment_method desc nulls last) as n
    from messy_payments) where n = 1),
no_cash as (select * from deduplicated where payment_method <> 'cash'),
filled as (select * from no_cash where regexp_matches(amount, '^-?[0-9]+$'))"""


@query(
    f"""with {_CHAIN_SQL} select cast(id as bigint) as id, cast(order_id as bigint) as order_id,
  payment_method, cast(amount as bigint) as amount, 'EUR' as currency from filled"""
)
def step_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _chain(spark, sf_dir, count_rows=False).frame


@query(
    f"""with {_CHAIN_SQL}, sizes as (
  select (select count(*) from messy_payments) as a, (select count(*) from deduplicated) as b,
         (select count(*) from no_cash) as c, (select count(*) from filled) as d)
select 'deduplicate' as step, a as input_count, b as output_count, b - a as delta from sizes
union all select 'cast_types', b, b, 0 from sizes
union all select 'filter(no cash)', b, c, c - b from sizes
union all select 'drop_nulls', c, d, d - c from sizes
union all select 'fill_nulls', d, d, 0 from sizes"""
)
def step_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows before and after each step, observed while the chain runs once."""
    run = _chain(spark, sf_dir, count_rows=True)
    run.frame.write.format("noop").mode("overwrite").save()
    return spark.createDataFrame(
        run.counts(), "step string, input_count bigint, output_count bigint, delta bigint"
    )


@query(
    f"""with {_CHAIN_SQL}, counted as (
  select count(*) as n, count(*) filter (order_id <> '' and payment_method = 'coupon') as b
  from filled)
select 'completeness' as check_name, b >= 0.95 * n as passed, b::double / n as metric_value,
  0.95::double as threshold,
  'complete in order_id, coupon: ' || b || ' of ' || n || ' (' || printf('%.2f', 100.0 * b / n)
  || '%), limit 95.00%' as message from counted"""
)
def step_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A chain that reports on its result: how many payments are complete coupon payments."""
    coupon = F.when(F.col("payment_method") == "coupon", F.col("payment_method"))
    run = cleaning.run_steps(
        messy_payments(spark, sf_dir),
        [
            cleaning.dedup_step(["id"], ["amount"]),
            cleaning.cast_step({"id": "int", "order_id": "int", "amount": "int"}),
            cleaning.filter_step(F.col("payment_method") != "cash", "no cash"),
            cleaning.drop_step(["amount"]),
        ],
        checks=lambda df: check_completeness(df.withColumn("coupon", coupon), ["order_id", "coupon"]),
    )
    return run.checks


@query(
    """select cast(c_custkey as varchar) as c_custkey, c_name,
  cast(c_nationkey as varchar) as c_nationkey from customer"""
)
def cast_to_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = read(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey")
    return cleaning.cast_types(customer, {"c_custkey": "str", "c_name": "str", "c_nationkey": "str"})


# --- rule validation ---------------------------------------------------------------------

_NOT_INT = "Input should be a valid integer, unable to parse string as an integer"
_STATUSES = "'completed', 'placed', 'return_pending', 'returned', 'shipped'"
_METHODS = "'bank_transfer', 'coupon', 'credit_card', 'gift_card'"


def _quoted(options: str) -> str:
    return options.replace("'", "''")


_ORDER_CHECK_SQL = f"""{MESSY_SQL}, checked as (
  select *, concat_ws('; ',
    case when cast(id as bigint) <= 0 then 'id: Input should be greater than 0' end,
    case when cast(cast(trim(user_id) as double) as bigint) <= 0
         then 'user_id: Input should be greater than 0' end,
    case when contains(order_date, '/')
         then 'order_date: Input should be a valid date or datetime' end,
    case when status = '' then 'status: String should have at least 1 character'
         when {strip_sql("lower(status)")} not in ({_STATUSES})
         then 'status: Value error, Invalid status ''' || status
              || '''. Must be one of: [{_quoted(_STATUSES)}]' end) as _errors
  from messy_orders)"""
_CUSTOMER_CHECK_SQL = f"""{MESSY_SQL}, checked as (
  select *, concat_ws('; ',
    case when cast(id as bigint) <= 0 then 'id: Input should be greater than 0' end,
    case when first_name = '' then 'first_name: String should have at least 1 character' end,
    case when last_name is null then 'last_name: Input should be a valid string' end) as _errors
  from messy_customers)"""
_PAYMENT_CHECK_SQL = f"""{MESSY_SQL}, checked as (
  select *, concat_ws('; ',
    case when cast(id as bigint) <= 0 then 'id: Input should be greater than 0' end,
    case when cast(order_id as bigint) <= 0
         then 'order_id: Input should be greater than 0' end,
    case when lower(payment_method) not in ({_METHODS})
         then 'payment_method: Value error, Invalid payment method ''' || payment_method
              || '''. Must be one of: [{_quoted(_METHODS)}]' end,
    case when contains(amount, '.5') then 'amount: {_NOT_INT}'
         when starts_with(amount, '-')
         then 'amount: Input should be greater than or equal to 0' end) as _errors
  from messy_payments)"""

VALID_ORDERS_SQL = f"""with {_ORDER_CHECK_SQL} select cast(id as bigint) as id,
  cast(cast(trim(user_id) as double) as bigint) as user_id, cast(order_date as date) as order_date,
  {strip_sql("lower(status)")} as status from checked where _errors = ''"""


@query(VALID_ORDERS_SQL)
def validate_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validate(messy_orders(spark, sf_dir), ORDER_RULES).valid


@query(f"with {_ORDER_CHECK_SQL} select * from checked where _errors <> ''")
def invalid_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validate(messy_orders(spark, sf_dir), ORDER_RULES).invalid


@query(
    f"""with {_CUSTOMER_CHECK_SQL} select cast(id as bigint) as id,
  {strip_sql("first_name")} as first_name, {strip_sql("last_name")} as last_name
  from checked where _errors = ''"""
)
def validate_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validate(messy_customers(spark, sf_dir), CUSTOMER_RULES).valid


@query(f"with {_CUSTOMER_CHECK_SQL} select * from checked where _errors <> ''")
def invalid_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validate(messy_customers(spark, sf_dir), CUSTOMER_RULES).invalid


@query(
    f"""with {_PAYMENT_CHECK_SQL} select cast(id as bigint) as id,
  cast(order_id as bigint) as order_id, lower(payment_method) as payment_method,
  cast(amount as bigint) as amount from checked where _errors = ''"""
)
def validate_payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validate(messy_payments(spark, sf_dir), PAYMENT_RULES).valid


@query(f"with {_PAYMENT_CHECK_SQL} select * from checked where _errors <> ''")
def invalid_payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validate(messy_payments(spark, sf_dir), PAYMENT_RULES).invalid


@query(
    f"""with {_PAYMENT_CHECK_SQL} select count(*) as total,
  count(*) filter (where _errors = '') as valid_count,
  count(*) filter (where _errors <> '') as invalid_count,
  cast(count(*) filter (where _errors = '') as double) / count(*) as validation_rate from checked"""
)
def validation_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validate(messy_payments(spark, sf_dir), PAYMENT_RULES).summary()


# --- history -----------------------------------------------------------------------------

_OPENED = datetime(2023, 1, 1)
_AS_OF = datetime(2024, 1, 15, 12)


def _history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers of most nations, those of nation 5 already closed."""
    return (
        read(spark, sf_dir, "customer")
        .filter(F.col("c_nationkey") <= 20)
        .select(
            F.col("c_custkey").alias("customer_id"),
            F.col("c_name").alias("name"),
            F.col("c_mktsegment").alias("tier"),
            utc_literal(_OPENED).alias("_effective_from"),
            F.when(F.col("c_nationkey") == 5, utc_literal(_AS_OF)).alias("_effective_to"),
            (F.col("c_nationkey") != 5).alias("_is_current"),
            F.lit("stored").alias("_row_hash"),
        )
    )


def _batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """New, changed and unchanged customers; household customers come twice."""
    customer = read(spark, sf_dir, "customer").filter(F.col("c_nationkey") >= 3)
    segment = F.col("c_mktsegment")
    first = customer.select(
        F.col("c_custkey").alias("customer_id"),
        F.col("c_name").alias("name"),
        F.when(F.col("c_acctbal") < 0, F.lit("DELINQUENT"))
        .when(segment != "MACHINERY", segment)
        .alias("tier"),
        F.lit(1).alias("seq"),
    )
    again = customer.filter(segment == "HOUSEHOLD").select(
        F.col("c_custkey").alias("customer_id"),
        F.col("c_name").alias("name"),
        F.lit("HOME").alias("tier"),
        F.lit(2).alias("seq"),
    )
    return first.unionByName(again)


_HISTORY_SQL = f"""existing as (
  select c_custkey as customer_id, c_name as name, c_mktsegment as tier,
         timestamp '{_OPENED}' as _effective_from,
         case when c_nationkey = 5 then timestamp '{_AS_OF}' end as _effective_to,
         c_nationkey <> 5 as _is_current, 'stored' as _row_hash
  from customer where c_nationkey <= 20),
batch as (
  select c_custkey as customer_id, c_name as name,
         case when c_mktsegment = 'HOUSEHOLD' then 'HOME'
              when c_acctbal < 0 then 'DELINQUENT'
              when c_mktsegment <> 'MACHINERY' then c_mktsegment end as tier,
         case when c_mktsegment = 'HOUSEHOLD' then 2 else 1 end as seq
  from customer where c_nationkey >= 3),
current_rows as (select * from existing where _is_current),
paired as (
  select b.*, c.customer_id is not null as known,
         b.name is not distinct from c.name and b.tier is not distinct from c.tier as same
  from batch b left join current_rows c on b.customer_id = c.customer_id),
merged as (
  select e.* replace (
           case when p.known and not p.same then timestamp '{_AS_OF}'
                else e._effective_to end as _effective_to,
           e._is_current and (p.customer_id is null or p.same) as _is_current),
         cast(null as integer) as seq
  from existing e left join paired p on e.customer_id = p.customer_id and e._is_current
  union all
  select customer_id, name, tier, timestamp '{_AS_OF}', null, true,
         md5(coalesce(name, 'None') || '|' || coalesce(tier, 'None')), seq
  from paired where not known or not same)"""


@query(f"with {_HISTORY_SQL} select * from merged")
def history_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge_history(
        _history(spark, sf_dir),
        _batch(spark, sf_dir),
        key="customer_id",
        tracked=["tier", "name"],
        as_of=_AS_OF,
        incoming_order=["seq"],
    )


@query(
    f"""with versions as (
  select o_custkey as customer_id, cast(o_orderkey as varchar) as name, o_orderpriority as tier,
         o_orderdate as opened from orders where o_custkey % 3 <> 1),
ranked as (
  select *, row_number() over newest as place, lag(opened) over newest as successor
  from versions
  window newest as (partition by customer_id order by opened desc, name desc)),
batch as (select c_custkey as customer_id, 'batch' as name, c_mktsegment as tier
  from customer where c_custkey % 2 = 0)
select customer_id, name, tier, opened as _effective_from,
       case when place > 1 then successor
            when customer_id in (select customer_id from batch) then timestamp '{_AS_OF}'
       end as _effective_to,
       place = 1 and customer_id not in (select customer_id from batch) as _is_current,
       'stored' as _row_hash
from ranked
union all
select customer_id, name, tier, timestamp '{_AS_OF}', null, true, md5(name || '|' || tier) from batch"""
)
def history_merge_repeated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A history in which customers have many current versions, and a batch."""
    stored = read(spark, sf_dir, "orders").filter("o_custkey % 3 <> 1").select(
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderkey").cast("string").alias("name"),
        F.col("o_orderpriority").alias("tier"),
        F.col("o_orderdate").alias("_effective_from"),
        F.lit(None).cast("timestamp_ntz").alias("_effective_to"),
        F.lit(True).alias("_is_current"),
        F.lit("stored").alias("_row_hash"),
    )
    batch = read(spark, sf_dir, "customer").filter("c_custkey % 2 = 0").select(
        F.col("c_custkey").alias("customer_id"),
        F.lit("batch").alias("name"),
        F.col("c_mktsegment").alias("tier"),
    )
    return merge_history(stored, batch, "customer_id", ["name", "tier"], _AS_OF)


_STORED_AT = [datetime(2024, 3, d) for d in (1, 2, 3)]


@query(
    f"""with batches as (
  select o_custkey as customer_id, o_orderpriority as tier, o_orderkey, step from orders,
    (values (0), (1), (2)) as steps(step) where o_orderkey % 3 = step),
batch as (
  select * exclude (o_orderkey), cast(o_orderkey as bigint) as number from batches
  qualify row_number() over (partition by customer_id, step order by o_orderkey desc) = 1),
changes as (
  select *, lag(tier) over versions as before from batch
  window versions as (partition by customer_id order by step)),
opened as (
  select *, lead(step) over versions as closed from changes where before is distinct from tier
  window versions as (partition by customer_id order by step))
select customer_id, tier, number,
       timestamp '{_STORED_AT[0]}' + to_days(step) as _effective_from,
       timestamp '{_STORED_AT[0]}' + to_days(closed) as _effective_to,
       closed is null as _is_current, md5(tier) as _row_hash
from opened"""
)
def history_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three batches of customers' newest priorities, merged into a stored history."""
    w = Warehouse(spark, f"millrace_{uuid.uuid4().hex[:8]}", workspace(spark, "history"))
    create_schema(w)
    orders = read(spark, sf_dir, "orders")
    for step, at in enumerate(_STORED_AT):
        batch = orders.filter(F.col("o_orderkey") % 3 == step).select(
            F.col("o_custkey").alias("customer_id"),
            F.col("o_orderpriority").alias("tier"),
            F.col("o_orderkey").alias("number"),
        )
        store_history(w, "priorities", batch, "customer_id", ["tier"], at, ["number"], buckets=16)
    return spark.table(w.table("priorities"))


@query(
    """select o_custkey, count(*) as versions from orders where o_orderstatus = 'O'
  group by o_custkey having count(*) > 1"""
)
def repeated_current(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Open orders taken as current versions: customers that have several."""
    versions = read(spark, sf_dir, "orders").select(
        "o_custkey", (F.col("o_orderstatus") == "O").alias("_is_current")
    )
    return repeated(versions, "o_custkey")


@query(
    """select c_custkey, md5('' || '|' || c_custkey || '|' || c_name || '|' || c_nationkey) as h
  from customer"""
)
def row_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """MD5 of columns in name order; ``absent`` is not a column and renders empty."""
    df = read(spark, sf_dir, "customer")
    columns = ["c_nationkey", "c_name", "absent", "c_custkey"]
    return df.select("c_custkey", hash_of(df.schema, columns).alias("h"))
