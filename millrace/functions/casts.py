"""Strict casts (a bad value fails the job) and lenient casts (a bad value is NULL)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.text import WHITESPACE, blank_to_null, python_text, strip

# Target type names of the lenient cast and the Spark type each one yields.
LENIENT_TYPES: dict[str, T.DataType] = {
    "int": T.LongType(),
    "float": T.DoubleType(),
    "str": T.StringType(),
    "bool": T.BooleanType(),
    "date": T.DateType(),
    "datetime": T.TimestampNTZType(),
    "decimal": T.DecimalType(38, 18),
}

# Texts that count as true. Any other non-blank text is false.
TRUE_TEXTS = ("true", "1", "yes", "t", "y")

# Each pattern is used once, to extract the usable text. Text that does not match is NULL
# before the cast: a try_cast that fails raises and catches an exception per row.
_PAD = f"[{WHITESPACE}]*"
_DIGITS = r"[0-9]+(?:_[0-9]+)*"
_INT = rf"^{_PAD}([+-]?{_DIGITS}){_PAD}$"
_INTEGRAL = rf"^{_PAD}([+-]?{_DIGITS})(?:\.0+)?{_PAD}$"
_NUMBER = rf"[+-]?(?:{_DIGITS}\.?(?:{_DIGITS})?|\.{_DIGITS})(?:[eE][+-]?{_DIGITS})?"
_DECIMAL = rf"^{_PAD}({_NUMBER}){_PAD}$"
_FLOAT = rf"^{_PAD}({_NUMBER}|[+-]?(?i:inf|infinity|nan)){_PAD}$"
_NUMBER_PATTERNS = {"int": _INT, "float": _FLOAT, "decimal": _DECIMAL}
_MONTH, _DAY, _CLOCK = "(?:0[1-9]|1[0-2])", "(?:0[1-9]|[12][0-9]|3[01])", "(?:[01][0-9]|2[0-3])"
_ISO_DAY = rf"[0-9]{{4}}-{_MONTH}-{_DAY}"
_DATE = rf"^({_ISO_DAY})$"
_DATE_COMPACT = r"^([0-9]{4})([0-9]{2})([0-9]{2})$"
_WEEK_DATE = r"^([0-9]{4})-?W([0-9]{2})(?:-?([1-7]))?$"
_DATETIME = (
    rf"^({_ISO_DAY}(?:[T ]{_CLOCK}:[0-5][0-9](?::[0-5][0-9](?:[.,][0-9]{{1,6}})?)?)?)"
    r"(Z|[+-][0-9]{2}:?[0-9]{2})?$"
)


def strict_cast(c: Column, target: T.DataType) -> Column:
    """Empty string to NULL, then an ANSI cast: a value that does not fit raises."""
    value = blank_to_null(c)
    return value if isinstance(target, T.StringType) else value.cast(target)


def lenient_cast(c: Column, source: T.DataType, target: str) -> Column:
    """Cast to one of ``LENIENT_TYPES``; blank or unusable values become NULL.

    An unknown target name leaves the column as it is, apart from blanks.
    """
    text_in = isinstance(source, T.StringType)
    text = strip(c if text_in else python_text(c, source))
    value = F.when(text != "", c) if text_in else c
    if target in _NUMBER_PATTERNS:
        spark_name = LENIENT_TYPES[target].simpleString()
        if text_in:
            return number_in(c, _NUMBER_PATTERNS[target], spark_name)
        return _numeric_only(c, source, spark_name)
    if target == "str":
        return value if text_in else python_text(c, source)
    if target == "bool":
        if isinstance(source, T.BooleanType):
            return c
        return F.when(text != "", F.lower(text).isin(*TRUE_TEXTS))
    if target == "date":
        if isinstance(source, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            return c
        return iso_date(text)
    if target == "datetime":
        if isinstance(source, (T.TimestampType, T.TimestampNTZType)):
            return c
        if isinstance(source, T.DateType):
            return c.cast("timestamp_ntz")
        return iso_datetime(text)
    return value


def _matched(text: Column, pattern: str) -> Column:
    return blank_to_null(F.regexp_extract(text, pattern, 1))


def _rarely(text: Column, parse: Callable[[Column], Column]) -> Column:
    """Evaluate ``parse`` through a lambda, which Spark interprets.

    Parsers of rare forms would otherwise swell the generated method of every row
    beyond the size the JVM compiles.
    """
    return F.transform(F.array(text), parse)[0]


def number_in(text: Column, pattern: str, target: str) -> Column:
    """The number in group 1 of the pattern, without digit separators, else NULL."""
    return F.translate(_matched(text, pattern), "_", "").try_cast(target)


def integral(text: Column) -> Column:
    """An integer, also when written with a zero fraction (``7.0``)."""
    return number_in(text, _INTEGRAL, "bigint")


def iso_date(text: Column) -> Column:
    """ISO calendar (``YYYY-MM-DD``, ``YYYYMMDD``) or week date, else NULL."""
    dashed = F.regexp_replace(text, _DATE_COMPACT, "$1-$2-$3")
    return F.coalesce(
        _matched(dashed, _DATE).try_cast("date"),
        F.when(F.contains(text, F.lit("W")), _rarely(text, _week_date)),
    )


def iso_day(text: Column) -> Column:
    """Only ``YYYY-MM-DD``, else NULL."""
    return _matched(text, _DATE).try_cast("date")


def _week_date(text: Column) -> Column:
    year = F.regexp_extract(text, _WEEK_DATE, 1)
    week = F.regexp_extract(text, _WEEK_DATE, 2).try_cast("int")
    day = F.coalesce(F.regexp_extract(text, _WEEK_DATE, 3).try_cast("int"), F.lit(1))
    # 4 January always lies in week 1.
    first = F.concat(year, F.lit("-01-04")).try_cast("date")
    monday = F.date_add(F.date_trunc("week", first).cast("date"), (week - 1) * 7)
    in_year = F.extract(F.lit("YEAROFWEEK"), monday) == year.try_cast("int")
    return F.when((week >= 1) & in_year, F.date_add(monday, day - 1))


def iso_datetime(text: Column) -> Column:
    """ISO date-time as ``timestamp_ntz``; a value with an offset is moved to UTC."""
    dashed = F.regexp_replace(text, _DATE_COMPACT, "$1-$2-$3")
    local = F.translate(_matched(dashed, _DATETIME), ",", ".").try_cast("timestamp_ntz")
    offset = F.regexp_extract(text, _DATETIME, 2)
    return F.when(offset.isin("", "Z"), local).otherwise(local - _rarely(offset, _offset))


def _offset(text: Column) -> Column:
    """``+02:00`` or ``+0200`` as an interval."""
    hours = F.substring(text, 1, 3).try_cast("int")
    minutes = F.concat(F.substring(text, 1, 1), F.right(text, F.lit(2))).try_cast("int")
    return F.make_dt_interval(F.lit(0), hours, minutes)


def _numeric_only(c: Column, source: T.DataType, target: str) -> Column:
    """Numbers and booleans convert (fractions truncate toward zero); dates do not."""
    if isinstance(source, T.BooleanType):
        return c.cast("int").cast(target)
    if isinstance(source, T.NumericType):
        return c.try_cast(target)
    return F.lit(None).cast(target)
