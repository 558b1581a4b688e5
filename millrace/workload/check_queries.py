"""Record checks, source checks and column tests."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators import column_tests as tests
from millrace.operators import record_checks as records
from millrace.operators.rules import ORDER_STATUSES, PAYMENT_METHODS
from millrace.operators.source_checks import (
    Check,
    check_metrics,
    default_checks,
    failure_samples,
    orphan_keys,
    results_frame,
    run_checks,
    summarize,
)
from millrace.plans.build import build_marts
from millrace.session import workspace
from millrace.workload.mart_queries import FCT_SQL, SPINE_SQL, daily_sql, dim_sql
from millrace.workload.registry import query
from millrace.workload.tables import (
    MESSY_SQL,
    RAW_SQL,
    messy_customers,
    messy_orders,
    messy_payments,
    raw_customers,
    raw_orders,
    raw_payments,
    read,
    strip_sql,
)


def _list(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


# --- record checks -----------------------------------------------------------------------

_RESULT = ("check_name", "passed", "metric_value", "threshold")


@query(
    f"""with {MESSY_SQL}, r as (
  select avg(case when first_name is not null and {strip_sql("first_name")} <> ''
             and last_name is not null then 1.0 else 0.0 end) as rate from messy_customers)
select 'completeness' as check_name, rate >= 0.7 as passed, rate as metric_value,
  0.7::double as threshold from r"""
)
def completeness(spark: SparkSession, sf_dir: str) -> DataFrame:
    result = records.check_completeness(
        messy_customers(spark, sf_dir), ["first_name", "last_name"], 0.7
    )
    return result.select(*_RESULT)


@query(
    """with k as (select count(*) as n, (select count(*) from
    (select distinct l_orderkey, l_linenumber from lineitem)) as u from lineitem)
select 'uniqueness' as check_name, n = u as passed,
  cast(n - u as double) / n as metric_value, 0.0::double as threshold from k"""
)
def uniqueness_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    result = records.check_unique_key(
        read(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"]
    )
    return result.select(*_RESULT)


_REFERENCE_DAY = date(2024, 2, 5)


def _freshness_sql(newest: str, table: str) -> str:
    return f"""select 'freshness' as check_name,
  date_diff('day', max({newest}), date '{_REFERENCE_DAY}') <= 7 as passed,
  cast(date_diff('day', max({newest}), date '{_REFERENCE_DAY}') as double) as metric_value,
  7.0::double as threshold from {table}"""


@query(_freshness_sql("cast(ts as date)", "events"))
def freshness(spark: SparkSession, sf_dir: str) -> DataFrame:
    result = records.check_freshness(read(spark, sf_dir, "events"), "ts", _REFERENCE_DAY)
    return result.select(*_RESULT)


@query(
    f"with {MESSY_SQL} "
    + _freshness_sql(
        "case when not contains(order_date, '/') then cast(order_date as date) end",
        "messy_orders",
    )
)
def freshness_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dates as text, some of them unreadable."""
    result = records.check_freshness(messy_orders(spark, sf_dir), "order_date", _REFERENCE_DAY)
    return result.select(*_RESULT)


# --- source checks -----------------------------------------------------------------------

_METRICS = ("check_name", "source_name", "passed", "severity", "metric_value", "threshold")


def _messy(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {
        "orders": messy_orders(spark, sf_dir),
        "customers": messy_customers(spark, sf_dir),
        "payments": messy_payments(spark, sf_dir),
    }


def _clean(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {
        "orders": raw_orders(spark, sf_dir),
        "customers": raw_customers(spark, sf_dir),
        "payments": raw_payments(spark, sf_dir),
    }


def _metrics(spark: SparkSession, sources: dict[str, DataFrame], checks: list[Check]) -> DataFrame:
    return check_metrics(spark, sources, checks).select(*_METRICS)


def _check_sql(c: Check, prefix: str = "messy_") -> str:
    """One check as SQL over the tables ``<prefix><source>``."""
    table = prefix + c.source_name
    col = f"coalesce(cast({c.column} as varchar), '')"
    limit = "null" if c.threshold is None else c.threshold
    if c.check_type == "null_rate":
        metric = f"avg(case when {strip_sql(col)} = '' then 1.0 else 0.0 end)"
        passed = f"{metric} <= {c.threshold}"
    elif c.check_type == "row_count_min":
        metric, passed = "count(*)", f"count(*) >= {c.threshold}"
    elif c.check_type == "schema_match":
        metric, passed = "1.0", "count(*) >= 0"
    elif c.check_type == "uniqueness":
        metric = f"cast(count(*) - count(distinct {col}) as double) / count(*)"
        passed = f"count(*) = count(distinct {col})"
    elif c.check_type == "accepted_values":
        bad = f"count(*) filter (where {strip_sql(col)} not in ('', {_list(c.params['values'])}))"
        metric, passed = f"cast({bad} as double) / count(*)", f"{bad} = 0"
    else:
        parent = prefix + c.params["reference_source"]
        key = f"cast({c.params['reference_column']} as varchar)"
        orphans = f"""count(distinct {col}) filter (where {col} not in
            (select {key} from {parent} where {key} is not null))"""
        metric = f"cast({orphans} as double) / count(distinct {col})"
        passed = f"{orphans} = 0"
    return f"""select '{c.name}' as check_name, '{c.source_name}' as source_name,
  {passed} as passed, '{c.severity}' as severity, cast({metric} as double) as metric_value,
  cast({limit} as double) as threshold from {table}"""


def _checks_sql(checks: list[Check], tables: str = MESSY_SQL, prefix: str = "messy_") -> str:
    return f"with {tables} " + " union all ".join(_check_sql(c, prefix) for c in checks)


_NULL_RATES = [
    Check("customers", "null_rate", "first_name", 0.1),
    Check("customers", "null_rate", "last_name", 0.5, "warning"),
    Check("orders", "null_rate", "status", 0.1),
]
_ROW_COUNTS = [
    Check("orders", "row_count_min", threshold=10),
    Check("payments", "row_count_min", threshold=100_000_000, severity="warning"),
]
_UNIQUE = [
    Check("orders", "uniqueness", "id"),
    Check("payments", "uniqueness", "id"),
    Check("payments", "uniqueness", "order_id", severity="warning"),
]
_ACCEPTED = [
    Check("orders", "accepted_values", "status", params={"values": list(ORDER_STATUSES)}),
    Check(
        "payments", "accepted_values", "payment_method", params={"values": list(PAYMENT_METHODS)}
    ),
]
_REFERENCES = [
    Check(
        "payments",
        "referential_integrity",
        "order_id",
        params={"reference_source": "orders", "reference_column": "id"},
    ),
    Check(
        "orders",
        "referential_integrity",
        "id",
        params={"reference_source": "payments", "reference_column": "order_id"},
    ),
]


@query(_checks_sql(_NULL_RATES))
def null_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _metrics(spark, _messy(spark, sf_dir), _NULL_RATES)


@query(_checks_sql(_ROW_COUNTS))
def row_count_min(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _metrics(spark, _messy(spark, sf_dir), _ROW_COUNTS)


@query(
    f"""with {MESSY_SQL}
select 'schema_match:customers' as check_name, 'customers' as source_name, false as passed,
  'error' as severity, 0.75::double as metric_value, cast(null as double) as threshold,
  count(*) as checked_rows from messy_customers"""
)
def schema_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One of four expected columns is missing."""
    expected = ["id", "first_name", "last_name", "email"]
    check = Check("customers", "schema_match", params={"expected_columns": expected})
    rows = Check("customers", "row_count_min")
    both = check_metrics(spark, _messy(spark, sf_dir), [check, rows])
    counted = F.max(F.when(F.col("check_type") == "row_count_min", F.col("part")))
    found = F.max(F.when(F.col("check_type") == "schema_match", F.struct(*_METRICS)))
    return both.agg(found.alias("m"), counted.alias("checked_rows")).select("m.*", "checked_rows")


@query(_checks_sql(_UNIQUE))
def uniqueness_col(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _metrics(spark, _messy(spark, sf_dir), _UNIQUE)


_MANY_UNIQUE = [Check("payments", "uniqueness", c) for c in ("id", "order_id", "payment_method", "amount")]


@query(_checks_sql(_MANY_UNIQUE))
def uniqueness_many(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four columns of one source that must be unique."""
    return _metrics(spark, _messy(spark, sf_dir), _MANY_UNIQUE)


_SAMPLED = [
    Check("orders", "accepted_values", "status", params={"values": ["placed"]}),
    Check("orders", "accepted_values", "user_id", params={"values": ["1", "2"]}),
    Check("payments", "accepted_values", "amount", params={"values": []}),
    Check("payments", "accepted_values", "payment_method", params={"values": ["coupon"]}),
    Check(
        "orders",
        "referential_integrity",
        "user_id",
        params={"reference_source": "payments", "reference_column": "order_id"},
    ),
]


def _sample_sql(position: int, c: Check) -> str:
    value = strip_sql(f"coalesce({c.column}, '')")
    if c.check_type == "referential_integrity":
        known = strip_sql(f"coalesce({c.params['reference_column']}, '')")
        refused = f"not in (select {known} from messy_{c.params['reference_source']})"
    else:
        refused = f"not in ({_list(['', *c.params['values']])})"
    return f"""(select {position} as position, value as key from (
  select distinct {value} as value from messy_{c.source_name})
  where value <> '' and value {refused} order by value limit 5)"""


@query(f"with {MESSY_SQL} " + " union all ".join(_sample_sql(i, c) for i, c in enumerate(_SAMPLED)))
def check_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first offending values of five checks, in one frame."""
    return failure_samples(_messy(spark, sf_dir), list(enumerate(_SAMPLED)))


@query(
    """select l_orderkey, l_linenumber, count(*) as n from lineitem
  where l_partkey not in (select p_partkey from part where p_partkey % 100 <> 7) group by all"""
)
def orphan_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of parts that a reduced part table does not have."""
    parts = read(spark, sf_dir, "part").filter("p_partkey % 100 <> 7")
    rows = tests.relationships_failures(read(spark, sf_dir, "lineitem"), "l_partkey", parts, "p_partkey")
    return rows.groupBy("l_orderkey", "l_linenumber").agg(F.count(F.lit(1)).alias("n"))


@query(_checks_sql(_ACCEPTED))
def accepted_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _metrics(spark, _messy(spark, sf_dir), _ACCEPTED)


@query(_checks_sql(_REFERENCES))
def referential_integrity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _metrics(spark, _messy(spark, sf_dir), _REFERENCES)


@query(
    """select cast(o_orderkey as varchar) as key from orders
  where o_orderkey not in (select l_orderkey from lineitem)"""
)
def orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order ids without a payment."""
    sources = _messy(spark, sf_dir)
    return orphan_keys(sources["orders"], "id", sources["payments"], "order_id")


@query(_checks_sql(default_checks()))
def check_suite(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _metrics(spark, _messy(spark, sf_dir), default_checks())


@query(
    _checks_sql(default_checks(), RAW_SQL, "raw_")
)
def check_suite_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The suite on typed sources, in which only the repeated payment ids fail."""
    return _metrics(spark, _clean(spark, sf_dir), default_checks())


@query(
    f"""with {MESSY_SQL}, bad as (
  select 'orders' as source_name, 'accepted_values:orders.status' as check_name,
    (select count(*) from messy_orders) as n, count(*) as b,
    list_sort(list(distinct {strip_sql("status")}))[1:5] as sample
  from messy_orders where {strip_sql("status")} not in ('', {_list(ORDER_STATUSES)})
  union all
  select 'payments', 'accepted_values:payments.payment_method',
    (select count(*) from messy_payments), count(*), list_sort(list(distinct payment_method))[1:5]
  from messy_payments where payment_method not in ({_list(PAYMENT_METHODS)}))
select check_name, source_name, false as passed, 'error' as severity,
  'refused values in ' || split_part(check_name, ':', 2) || ': ' || b || ' of ' || n
  || ' (' || printf('%.2f', 100.0 * b / n) || '%), limit 0.00%, such as '
  || list_aggregate(sample, 'string_agg', ', ') as message,
  cast(b as double) / n as metric_value, cast(null as double) as threshold from bad"""
)
def accepted_values_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Results as the action reports them, with a sample of the refused values."""
    return results_frame(spark, run_checks(spark, _messy(spark, sf_dir), _ACCEPTED))


@query(
    f"""with r as ({_checks_sql(default_checks())})
select count(*) as total, count(*) filter (where passed) as passed,
  count(*) filter (where not passed and severity = 'error') as failed_errors,
  count(*) filter (where not passed and severity = 'warning') as failed_warnings from r"""
)
def check_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summarize(_metrics(spark, _messy(spark, sf_dir), default_checks()))


# --- column tests ------------------------------------------------------------------------


@query(f"with {MESSY_SQL} select * from messy_customers where last_name is null")
def test_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tests.not_null_failures(messy_customers(spark, sf_dir), "last_name")


@query(
    f"""with {RAW_SQL} select id, count(*) as occurrences from raw_payments
  where id is not null group by id having count(*) > 1"""
)
def test_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tests.unique_failures(raw_payments(spark, sf_dir), "id")


@query(f"with {MESSY_SQL} select * from messy_orders where status not in ({_list(ORDER_STATUSES)})")
def test_accepted_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tests.accepted_values_failures(messy_orders(spark, sf_dir), "status", ORDER_STATUSES)


@query(
    f"""with {RAW_SQL} select * from raw_orders where id is not null
  and id not in (select order_id from raw_payments)"""
)
def test_relationships(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tests.relationships_failures(
        raw_orders(spark, sf_dir), "id", raw_payments(spark, sf_dir), "order_id"
    )


@query("select * from orders where not (o_totalprice > 1000 and o_totalprice < 400000)")
def test_accepted_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tests.accepted_range_failures(
        read(spark, sf_dir, "orders"), "o_totalprice", 1000, 400000, inclusive=False
    )


def _column_test_sql(t: tests.ColumnTest) -> str:
    if t.test == "unique":
        failures = f"""(select count(*) from (select {t.column} from {t.model}
          where {t.column} is not null group by {t.column} having count(*) > 1))"""
    else:
        if t.test == "not_null":
            condition = f"{t.column} is null"
        elif t.test == "accepted_values":
            condition = f"{t.column} not in ({_list(t.values)})"
        elif t.test == "relationships":
            condition = f"{t.column} not in (select {t.field} from {t.to})"
        else:
            bounds = [f"{t.column} >= {t.min_value}"]
            if t.max_value is not None:
                bounds.append(f"{t.column} <= {t.max_value}")
            condition = f"not ({' and '.join(bounds)})"
        failures = f"(select count(*) from {t.model} where {condition})"
    return f"""select '{t.model}' as model, '{t.column}' as column_name, '{t.test}' as test,
  {failures} as failures, {failures} = 0 as passed"""


COLUMN_TESTS_SQL = (
    f"with {FCT_SQL}, {dim_sql('stg_orders')}, {daily_sql(SPINE_SQL)} "
    + " union all ".join(_column_test_sql(t) for t in tests.model_tests())
)


@query(COLUMN_TESTS_SQL)
def column_test_suite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All column tests on raw tables, staging views and written marts."""
    raw = _clean(spark, sf_dir)
    models = build_marts(spark, raw, workspace(spark, "marts"))
    models.update({f"raw_{name}": df for name, df in raw.items()})
    return tests.run_column_tests(models)
