"""Column tests on models. Each test yields the failing rows; none means passed."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.joins import join_splittable
from millrace.operators.keyfilter import possible
from millrace.operators.rules import ORDER_STATUSES, PAYMENT_METHODS


def not_null_failures(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNull())


def unique_failures(df: DataFrame, column: str) -> DataFrame:
    """Non-null values that occur more than once, with their count."""
    return (
        df.filter(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("occurrences"))
        .filter(F.col("occurrences") > 1)
    )


def accepted_values_failures(df: DataFrame, column: str, values: Sequence[Any]) -> DataFrame:
    """Rows with a non-null value outside the list."""
    return df.filter(~F.col(column).isin(*values))


def relationships_failures(
    child: DataFrame, column: str, parent: DataFrame, parent_column: str
) -> DataFrame:
    """Child rows whose non-null key has no parent row.

    Child keys are reduced to distinct values before the anti-join, then joined back by
    a join that can split a key shared by a large part of the rows. A bounded filter of the
    orphan keys stands before that join, so that only possible orphans are shuffled.
    """
    keys = child.select(F.col(column)).filter(F.col(column).isNotNull()).distinct()
    known = parent.select(F.col(parent_column).alias(column)).distinct()
    orphans = keys.join(known, column, "left_anti")
    return join_splittable(possible(child, orphans, column), orphans, column, "left_semi")


def accepted_range_failures(
    df: DataFrame,
    column: str,
    min_value: float | None = None,
    max_value: float | None = None,
    inclusive: bool = True,
) -> DataFrame:
    """Rows with a non-null value outside the bounds."""
    return df.filter(~_in_range(column, min_value, max_value, inclusive))


def _in_range(column: str, low: float | None, high: float | None, inclusive: bool) -> Column:
    c = F.col(column)
    ok = F.lit(True)
    if low is not None:
        ok = ok & ((c >= low) if inclusive else (c > low))
    if high is not None:
        ok = ok & ((c <= high) if inclusive else (c < high))
    return ok


@dataclass(frozen=True)
class ColumnTest:
    model: str
    column: str
    test: str
    values: tuple[Any, ...] = ()
    to: str = ""
    field: str = ""
    min_value: float | None = None
    max_value: float | None = None
    inclusive: bool = True


def _not_null(model: str, *columns: str) -> list[ColumnTest]:
    return [ColumnTest(model, c, "not_null") for c in columns]


def model_tests() -> list[ColumnTest]:
    """The column tests of the raw tables, staging views and marts."""
    # Tested columns, accepted values, parents and bounds.
    tiers = ("inactive", "new", "active", "loyal")
    return [
        *_not_null("raw_orders", "id", "user_id", "order_date"),
        *_not_null("raw_customers", "id", "first_name", "last_name"),
        *_not_null("raw_payments", "id", "order_id", "amount"),
        *_not_null("stg_orders", "order_id", "customer_id", "order_status", "ordered_at"),
        *_not_null("stg_customers", "customer_id", "first_name", "last_name"),
        *_not_null("stg_payments", "payment_id", "order_id", "payment_method", "amount_dollars"),
        *_not_null(
            "dim_customers",
            "customer_id",
            "full_name",
            "total_orders",
            "lifetime_spend_dollars",
            "customer_tier",
        ),
        *_not_null(
            "fct_orders",
            "order_id",
            "customer_id",
            "order_total_dollars",
            "ordered_at",
            "order_status",
        ),
        *_not_null(
            "metrics_daily",
            "date_day",
            "total_orders",
            "total_revenue_dollars",
            "return_rate_pct",
        ),
        ColumnTest("raw_orders", "id", "unique"),
        ColumnTest("raw_customers", "id", "unique"),
        ColumnTest("raw_payments", "id", "unique"),
        ColumnTest("stg_orders", "order_id", "unique"),
        ColumnTest("stg_customers", "customer_id", "unique"),
        ColumnTest("stg_payments", "payment_id", "unique"),
        ColumnTest("dim_customers", "customer_id", "unique"),
        ColumnTest("fct_orders", "order_id", "unique"),
        ColumnTest("metrics_daily", "date_day", "unique"),
        ColumnTest("raw_orders", "status", "accepted_values", values=ORDER_STATUSES),
        ColumnTest("raw_payments", "payment_method", "accepted_values", values=PAYMENT_METHODS),
        ColumnTest("dim_customers", "customer_tier", "accepted_values", values=tiers),
        ColumnTest("raw_payments", "order_id", "relationships", to="raw_orders", field="id"),
        ColumnTest(
            "stg_orders", "customer_id", "relationships", to="stg_customers", field="customer_id"
        ),
        ColumnTest("stg_payments", "order_id", "relationships", to="stg_orders", field="order_id"),
        ColumnTest(
            "fct_orders", "customer_id", "relationships", to="dim_customers", field="customer_id"
        ),
        ColumnTest("dim_customers", "total_orders", "accepted_range", min_value=0),
        ColumnTest("dim_customers", "lifetime_spend_dollars", "accepted_range", min_value=0),
        ColumnTest("fct_orders", "order_total_dollars", "accepted_range", min_value=0),
        ColumnTest("metrics_daily", "total_orders", "accepted_range", min_value=0),
        ColumnTest("metrics_daily", "total_revenue_dollars", "accepted_range", min_value=0),
        ColumnTest(
            "metrics_daily", "return_rate_pct", "accepted_range", min_value=0, max_value=100
        ),
    ]


def _labelled(t: ColumnTest, failures: Column) -> list[Column]:
    return [
        F.lit(t.model).alias("model"),
        F.lit(t.column).alias("column_name"),
        F.lit(t.test).alias("test"),
        failures.cast("bigint").alias("failures"),
        (failures == 0).alias("passed"),
    ]


def _row_condition(t: ColumnTest) -> Column:
    if t.test == "not_null":
        return F.col(t.column).isNull()
    if t.test == "accepted_values":
        return ~F.col(t.column).isin(*t.values)
    return ~_in_range(t.column, t.min_value, t.max_value, t.inclusive)


def _orphan_rows(child: DataFrame, parent: DataFrame, t: ColumnTest) -> DataFrame:
    """Number of child rows without a parent, from per-key counts and one anti-join."""
    per_key = (
        child.filter(F.col(t.column).isNotNull())
        .groupBy(F.col(t.column).alias("key"))
        .agg(F.count(F.lit(1)).alias("rows"))
    )
    known = parent.select(F.col(t.field).alias("key")).distinct()
    orphans = per_key.join(known, "key", "left_anti")
    return orphans.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("n")).select(
        *_labelled(t, F.col("n"))
    )


def run_column_tests(
    models: Mapping[str, DataFrame], tests: Sequence[ColumnTest] | None = None
) -> DataFrame:
    """Failure counts of all tests, one row each, for the models given.

    The row-level tests of a model share one aggregation over one scan. ``unique`` and
    ``relationships`` read their key column only. Pass materialised models: the plan
    reads a model once for its row-level tests and once for each key test.
    """
    tests = [t for t in (model_tests() if tests is None else tests) if t.model in models]
    frames: list[DataFrame] = []
    by_model: dict[str, list[ColumnTest]] = {}
    for t in tests:
        if t.test == "unique":
            failures = unique_failures(models[t.model].select(t.column), t.column)
            frames.append(
                failures.agg(F.count(F.lit(1)).alias("n")).select(*_labelled(t, F.col("n")))
            )
        elif t.test == "relationships":
            frames.append(_orphan_rows(models[t.model], models[t.to], t))
        else:
            by_model.setdefault(t.model, []).append(t)
    for model, group in by_model.items():
        counted = models[model].agg(
            *[F.count_if(_row_condition(t)).alias(f"c{i}") for i, t in enumerate(group)]
        )
        entries = [F.struct(*_labelled(t, F.col(f"c{i}"))) for i, t in enumerate(group)]
        frames.append(counted.select(F.inline(F.array(*entries))))
    return reduce(DataFrame.unionByName, frames)
