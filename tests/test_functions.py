import hashlib
from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.casts import lenient_cast, strict_cast
from millrace.functions.hashing import checksum16, row_hash
from millrace.functions.numeric import cents_to_dollars, dollars_to_cents
from millrace.functions.text import blank_to_null, is_blank, strip


def one(spark, value, make, schema="c string"):
    return spark.createDataFrame([(value,)], schema).select(make(F.col("c")).alias("r")).first().r


def texts(spark, values, target):
    rows = spark.createDataFrame(list(enumerate(values)), "i int, c string")
    cast = rows.select("i", lenient_cast(F.col("c"), T.StringType(), target).alias("r"))
    return [r.r for r in cast.orderBy("i").collect()]


def test_strip_removes_what_python_strips(spark):
    for text in (" a ", "\t a \n", " a ", "", "   ", "a b"):
        assert one(spark, text, strip) == text.strip()


def test_blank_rules_differ(spark):
    assert one(spark, " \t", is_blank) is True
    assert one(spark, None, is_blank) is True
    assert one(spark, "x", is_blank) is False
    assert one(spark, "", blank_to_null) is None
    assert one(spark, " ", blank_to_null) == " "


@pytest.mark.parametrize(
    ("target", "values"),
    [
        (
            "int",
            {"42": 42, " +5\t": 5, "-7": -7, "1_000": 1000, "12.5": None, "abc": None, "": None,
             "  ": None, None: None, "1__0": None, "99999999999999999999": None},
        ),
        (
            "float",
            {"3.14": 3.14, "1e3": 1000.0, ".5": 0.5, "5.": 5.0, "1_0.5": 10.5, "1.5f": None,
             "1.5d": None, "inf": float("inf"), "-Infinity": float("-inf"), " ": None},
        ),
        (
            "bool",
            {"TRUE": True, " yes ": True, "t": True, "1": True, "y": True, "no": False,
             "maybe": False, "": None, None: None},
        ),
        (
            "date",
            {"2024-01-05": date(2024, 1, 5), " 2024-01-05 ": date(2024, 1, 5),
             "20240105": date(2024, 1, 5), "2024-W01-5": date(2024, 1, 5),
             "2020W53": date(2020, 12, 28), "2024-W53-1": None, "2024-1-5": None,
             "2024-02-30": None, "2024": None, "2024-01-05T10:00:00": None},
        ),
        (
            "datetime",
            {"2024-01-05": datetime(2024, 1, 5), "2024-01-05T10:30": datetime(2024, 1, 5, 10, 30),
             "2024-01-05 10:30:01.250": datetime(2024, 1, 5, 10, 30, 1, 250000),
             "2024-01-05T10:30:00Z": datetime(2024, 1, 5, 10, 30),
             "2024-01-05T10:30:00+02:00": datetime(2024, 1, 5, 8, 30),
             "2024-01-05T10:30:00-0130": datetime(2024, 1, 5, 12, 0),
             "2024-01-05T25:00:00": None, "20240105": datetime(2024, 1, 5)},
        ),
        ("decimal", {"1.25": Decimal("1.25"), "1_000.5": Decimal("1000.5"), "abc": None, "": None}),
        ("str", {" a ": " a ", "  ": None, None: None}),
        ("unknown", {"x": "x", " ": None}),
    ],
)
def test_lenient_cast_of_text(spark, target, values):
    assert texts(spark, list(values), target) == list(values.values())


def test_lenient_cast_of_typed_values(spark):
    def cast(value, schema, dtype, target):
        return one(spark, value, lambda c: lenient_cast(c, dtype, target), schema)

    assert cast(2.9, "c double", T.DoubleType(), "int") == 2
    assert cast(-2.9, "c double", T.DoubleType(), "int") == -2
    assert cast(True, "c boolean", T.BooleanType(), "int") == 1
    assert cast(True, "c boolean", T.BooleanType(), "str") == "True"
    assert cast(1, "c int", T.IntegerType(), "bool") is True
    assert cast(1.0, "c double", T.DoubleType(), "bool") is False
    assert cast(date(2024, 1, 5), "c date", T.DateType(), "int") is None
    assert cast(date(2024, 1, 5), "c date", T.DateType(), "datetime") == datetime(2024, 1, 5)
    when = datetime(2024, 1, 5, 3)
    assert cast(when, "c timestamp_ntz", T.TimestampNTZType(), "date") == when


def test_strict_cast_raises_on_bad_values(spark):
    assert one(spark, "42", lambda c: strict_cast(c, T.LongType())) == 42
    assert one(spark, "", lambda c: strict_cast(c, T.LongType())) is None
    assert one(spark, None, lambda c: strict_cast(c, T.LongType())) is None
    assert one(spark, "Alice", lambda c: strict_cast(c, T.StringType())) == "Alice"
    assert one(spark, "3.14", lambda c: strict_cast(c, T.DoubleType())) == pytest.approx(3.14)
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        one(spark, "12.5", lambda c: strict_cast(c, T.LongType()))


def test_checksum_is_a_sha256_prefix(spark):
    for text in ("hello", "world"):
        expected = hashlib.sha256(text.encode()).hexdigest()[:16]
        assert one(spark, text, checksum16) == expected


def test_row_hash_renders_null_and_absent_columns(spark):
    df = spark.createDataFrame([(1, None, True)], "b int, a string, t boolean")
    got = df.select(row_hash(df.schema, ["t", "b", "a", "zz"]).alias("h")).first().h
    assert got == hashlib.md5(b"None|1|True|").hexdigest()


def test_cents_survive_the_round_trip(spark):
    cents = [0, 1, 7, 29, 57, 115, 999_999_999_999, -335, 10**15 + 1]
    df = spark.createDataFrame([(c,) for c in cents], "c bigint")
    back = df.select("c", dollars_to_cents(cents_to_dollars(F.col("c"))).alias("r"))
    assert all(r.c == r.r for r in back.collect())
