"""Declared schemas of the raw tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import types as T

LOADED_AT = "_loaded_at"

# The raw tables and the declared types of their columns.
RAW_TABLES: dict[str, tuple[tuple[str, str], ...]] = {
    "orders": (
        ("id", "INTEGER"),
        ("user_id", "INTEGER"),
        ("order_date", "DATE"),
        ("status", "VARCHAR"),
    ),
    "customers": (
        ("id", "INTEGER"),
        ("first_name", "VARCHAR"),
        ("last_name", "VARCHAR"),
    ),
    "payments": (
        ("id", "INTEGER"),
        ("order_id", "INTEGER"),
        ("payment_method", "VARCHAR"),
        ("amount", "INTEGER"),
    ),
}

EXPECTED_COLUMNS = {name: [c for c, _ in columns] for name, columns in RAW_TABLES.items()}

# Declared type names. Integers are 64 bits wide so keys do not overflow.
_TYPES: dict[str, T.DataType] = {
    "INTEGER": T.LongType(),
    "VARCHAR": T.StringType(),
    "DATE": T.DateType(),
    "TIMESTAMP": T.TimestampNTZType(),
    "FLOAT": T.DoubleType(),
    "NUMERIC": T.DecimalType(18, 3),
    "BOOLEAN": T.BooleanType(),
}


def spark_type(name: str) -> T.DataType:
    """Spark type of a declared type name in any case; text for unknown names."""
    return _TYPES.get(name.upper(), T.StringType())


def struct_type(columns: Sequence[tuple[str, str]], loaded_at: bool = True) -> T.StructType:
    fields = [T.StructField(c, spark_type(t)) for c, t in columns]
    if loaded_at:
        fields.append(T.StructField(LOADED_AT, T.TimestampNTZType()))
    return T.StructType(fields)
