from datetime import date

from millrace.operators.rules import CUSTOMER_RULES, ORDER_RULES, PAYMENT_RULES, validate


def test_orders_are_split_and_coerced(spark):
    df = spark.createDataFrame(
        [
            ("1", " 7 ", "2024-01-05", " Placed ", "x"),
            ("1.0", "+3", "2024-01-05T00:00:00", "RETURNED", "x"),
            ("0", "2", "2024-01-05", "placed", "x"),
            ("1.5", "2", "2024/01/05", "lost", "x"),
            (None, "2", None, "", "x"),
        ],
        "id string, user_id string, order_date string, status string, extra string",
    )
    result = validate(df, ORDER_RULES)
    assert [tuple(r) for r in result.valid.collect()] == [
        (1, 7, date(2024, 1, 5), "placed"),
        (1, 3, date(2024, 1, 5), "returned"),
    ]
    errors = [r._errors for r in result.invalid.collect()]
    assert errors[0] == "id: Input should be greater than 0"
    assert errors[1] == (
        "id: Input should be a valid integer, unable to parse string as an integer; "
        "order_date: Input should be a valid date or datetime; "
        "status: Value error, Invalid status 'lost'. Must be one of: "
        "['completed', 'placed', 'return_pending', 'returned', 'shipped']"
    )
    assert errors[2] == (
        "id: Input should be a valid integer; order_date: Input should be a valid date; "
        "status: String should have at least 1 character"
    )
    assert result.invalid.columns == [*df.columns, "_errors"]
    summary = result.summary().first()
    assert (summary.total, summary.valid_count, summary.invalid_count) == (5, 2, 3)
    assert summary.validation_rate == 0.4


def test_customer_names_are_measured_before_stripping(spark):
    df = spark.createDataFrame(
        [(1, "   ", " B "), (2, "", "B"), (3, "A", None)],
        "id int, first_name string, last_name string",
    )
    result = validate(df, CUSTOMER_RULES)
    assert [tuple(r) for r in result.valid.collect()] == [(1, "", "B")]
    assert [r._errors for r in result.invalid.collect()] == [
        "first_name: String should have at least 1 character",
        "last_name: Input should be a valid string",
    ]


def test_payments_accept_zero_and_report_missing_columns(spark):
    df = spark.createDataFrame([("1", "1", "Coupon", "0")], "id string, order_id string, "
                               "payment_method string, amount string")
    assert [tuple(r) for r in validate(df, PAYMENT_RULES).valid.collect()] == [(1, 1, "coupon", 0)]
    partial = validate(df.drop("amount"), PAYMENT_RULES)
    assert partial.valid.count() == 0
    assert partial.invalid.first()._errors == "amount: Field required"


def test_empty_input_has_rate_zero(spark):
    df = spark.createDataFrame([], "id string, first_name string, last_name string")
    assert validate(df, CUSTOMER_RULES).summary().first().validation_rate == 0.0
