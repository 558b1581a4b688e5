import random
import statistics
from datetime import date, datetime, timedelta

import pytest

from millrace.operators.quantiles import daily_median
from millrace.plans import build_marts, fct_orders, metrics_daily
from millrace.plans.staging import stg_customers, stg_orders, stg_payments

AT, LATER = datetime(2024, 1, 1), datetime(2024, 1, 2)
D1, D2, D4 = date(2024, 1, 1), date(2024, 1, 2), date(2024, 1, 4)


@pytest.fixture(scope="module")
def raw(spark):
    orders = [
        (1, 1, D1, "placed", AT),
        (1, 1, D1, "completed", LATER),
        (2, 1, D1, "returned", AT),
        (3, 2, D2, "shipped", AT),
        (4, 2, D4, "return_pending", AT),
        (5, 9, None, None, AT),
        (None, 1, D1, "placed", AT),
    ]
    customers = [(1, " Ann ", "Lee", AT), (2, "Bo", None, AT), (3, "Cy", "Dee ", AT)]
    payments = [
        (1, 1, "credit_card", 1000, AT),
        (2, 1, "coupon", 250, AT),
        (2, 1, "coupon", 300, LATER),
        (3, 2, "coupon", 0, AT),
        (4, 3, "gift_card", 333, AT),
        (5, 3, "bank_transfer", 1, AT),
        (6, 3, None, 10, AT),
        (7, 77, "coupon", 5, AT),
    ]
    stamp = "_loaded_at timestamp_ntz"
    return {
        "orders": spark.createDataFrame(
            orders, f"id int, user_id int, order_date date, status string, {stamp}"
        ),
        "customers": spark.createDataFrame(
            customers, f"id int, first_name string, last_name string, {stamp}"
        ),
        "payments": spark.createDataFrame(
            payments, f"id int, order_id int, payment_method string, amount int, {stamp}"
        ),
    }


@pytest.fixture(scope="module")
def marts(spark, raw, tmp_path_factory):
    return build_marts(spark, raw, str(tmp_path_factory.mktemp("marts")))


def test_staging_keeps_the_newest_row(raw):
    orders = {r.order_id: r for r in stg_orders(raw["orders"]).collect()}
    assert sorted(orders) == [1, 2, 3, 4, 5]
    assert orders[1].order_status == "completed"
    names = {r.customer_id: (r.first_name, r.last_name) for r in stg_customers(raw["customers"]).collect()}
    assert names == {1: ("Ann", "Lee"), 2: ("Bo", None), 3: ("Cy", "Dee")}
    paid = {r.payment_id: r.amount_dollars for r in stg_payments(raw["payments"]).collect()}
    assert paid[2] == 3.0


def test_fact_rows(marts):
    facts = {r.order_id: r for r in marts["fct_orders"].collect()}
    one = facts[1]
    assert (one.order_total_dollars, one.payment_count, one.distinct_payment_methods) == (13.0, 2, 2)
    assert (one.credit_card_amount, one.coupon_amount, one.used_coupon) == (10.0, 3.0, True)
    assert (one.customer_first_name, one.is_returned) == ("Ann", False)
    # A coupon of zero does not count as used.
    assert (facts[2].used_coupon, facts[2].is_returned) == (False, True)
    # A payment without a method counts, but not as a method.
    assert (facts[3].payment_count, facts[3].distinct_payment_methods) == (3, 2)
    unpaid = facts[4]
    assert (unpaid.order_total_dollars, unpaid.payment_count) == (0.0, 0)
    assert unpaid.distinct_payment_methods is None
    assert (unpaid.used_coupon, unpaid.is_returned) == (False, True)
    assert (facts[5].customer_first_name, facts[5].is_returned) == (None, False)


def test_customer_rows(marts):
    customers = {r.customer_id: r for r in marts["dim_customers"].collect()}
    ann, bo, cy = customers[1], customers[2], customers[3]
    assert (ann.full_name, bo.full_name, cy.full_name) == ("Ann Lee", None, "Cy Dee")
    assert (ann.total_orders, ann.completed_orders, ann.returned_orders) == (2, 1, 1)
    assert (ann.customer_tier, bo.customer_tier, cy.customer_tier) == ("active", "active", "inactive")
    assert (ann.lifetime_spend_dollars, ann.preferred_payment_method) == (13.0, "coupon")
    # A tie goes to the alphabetically first method.
    assert (bo.preferred_payment_method, bo.distinct_payment_methods) == ("bank_transfer", 2)
    assert (bo.first_order_at, bo.most_recent_order_at) == (D2, D4)
    assert (cy.total_orders, cy.lifetime_spend_dollars) == (0, 0.0)
    assert cy.distinct_payment_methods is None and cy.preferred_payment_method is None


def test_daily_rows(marts):
    days = marts["metrics_daily"].collect()
    assert [r.date_day for r in days] == [D1, D2, D4]
    first = days[0]
    assert (first.total_orders, first.unique_customers, first.total_revenue_dollars) == (2, 1, 13.0)
    assert (first.avg_order_value_dollars, first.median_order_value_dollars) == (6.5, 6.5)
    assert (first.completed_orders, first.returned_orders, first.return_rate_pct) == (1, 1, 50.0)
    assert (first.orders_with_coupon, first.total_coupon_discount_dollars) == (1, 3.0)
    assert [r.cumulative_orders for r in days] == [2, 3, 4]
    assert [r.cumulative_revenue_dollars for r in days] == [13.0, 16.44, 16.44]


def test_calendar_fills_days_without_orders(marts):
    days = metrics_daily(marts["fct_orders"], calendar=True).collect()
    assert [r.date_day for r in days] == [D1, D2, date(2024, 1, 3), D4]
    gap = days[2]
    assert (gap.total_orders, gap.median_order_value_dollars, gap.return_rate_pct) == (0, 0.0, 0.0)
    assert gap.cumulative_orders == 3


def test_marts_of_no_orders(spark, raw):
    none = raw["orders"].limit(0)
    fct = fct_orders(
        stg_orders(none), stg_payments(raw["payments"]), stg_customers(raw["customers"])
    )
    assert metrics_daily(fct).count() == 0
    assert metrics_daily(fct, calendar=True).count() == 0


@pytest.mark.parametrize("bits", [4, 16])
def test_median_against_brute_force(spark, bits):
    rng = random.Random(11)
    # A third of the rows on one day, ties, negative values, odd and even counts.
    data = [(D1, rng.choice([5, 5, 5, rng.randrange(-50, 10**6)])) for _ in range(1000)]
    data += [(D1 + timedelta(days=rng.randrange(1, 40)), rng.randrange(-10**7, 10**9)) for _ in range(2000)]
    data += [(date(2025, 1, 1), 7), (date(2025, 1, 2), 1), (date(2025, 1, 2), 10**12), (None, 3)]
    df = spark.createDataFrame(data, "d date, v bigint").repartition(7)
    expected = {}
    for d, v in data:
        if d is not None:
            expected.setdefault(d, []).append(v)
    got = {r.day: r.median for r in daily_median(df, "d", "v", bits).collect()}
    assert got == {d: float(statistics.median(vs)) for d, vs in expected.items()}
