"""Readers: files, landed API pages, databases; declared schemas; extraction manifest."""

from millrace.sources.files import read_csv, read_json, read_parquet, read_source, require_columns
from millrace.sources.schemas import EXPECTED_COLUMNS, RAW_TABLES, spark_type, struct_type

__all__ = [
    "EXPECTED_COLUMNS",
    "RAW_TABLES",
    "read_csv",
    "read_json",
    "read_parquet",
    "read_source",
    "require_columns",
    "spark_type",
    "struct_type",
]
