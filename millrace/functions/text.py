"""Whitespace and blank handling.

Four null rules are in use and must not be merged:

* file load: the empty string is NULL, other whitespace is kept (``blank_to_null``)
* cleaning steps: NULL or whitespace-only counts as missing (``is_blank``)
* source checks: the same test, with an absent column counted as missing
* uniqueness: raw values, nothing stripped
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The characters Python's str.strip() removes.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def strip(c: Column) -> Column:
    """Remove all leading and trailing whitespace (``F.trim`` removes spaces only)."""
    return F.btrim(c, F.lit(WHITESPACE))


def is_blank(c: Column, dtype: T.DataType | None = None) -> Column:
    """True for NULL and, on strings, for whitespace-only values. Never NULL."""
    if dtype is not None and not isinstance(dtype, T.StringType):
        return c.isNull()
    return c.isNull() | (strip(c) == "")


def blank_to_null(c: Column) -> Column:
    """The empty string becomes NULL; ``"  "`` is kept."""
    return F.nullif(c, F.lit(""))


def python_text(c: Column, dtype: T.DataType) -> Column:
    """Text of a value as ``str()`` gives it for booleans; NULL stays NULL.

    Doubles keep Spark's rendering, which differs for exponents (``1.0E16``).
    """
    text = c.cast("string")
    return F.initcap(text) if isinstance(dtype, T.BooleanType) else text
