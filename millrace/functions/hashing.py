"""Row hashes and content checksums."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.text import python_text


def checksum16(content: Column) -> Column:
    """First 16 hex characters of SHA-256."""
    return F.substring(F.sha2(content, 256), 1, 16)


def row_hash(schema: T.StructType, columns: Sequence[str], prefix: str = "") -> Column:
    """MD5 over the named columns in name order, joined by ``|``.

    NULL renders as ``None`` and a column the schema lacks as the empty string.
    ``prefix`` addresses the columns inside a struct, e.g. ``"cur."``.
    """
    types = {f.name: f.dataType for f in schema.fields}
    parts = [
        F.coalesce(python_text(F.col(f"{prefix}`{name}`"), types[name]), F.lit("None"))
        if name in types
        else F.lit("")
        for name in sorted(columns)
    ]
    return F.md5(F.concat_ws("|", *parts))


def content_hash(df: DataFrame) -> Column:
    """Order-free aggregate hash of a whole frame, for comparing two copies of it.

    ``xxhash64`` passes over NULLs, so each column goes in with a flag that tells them.
    """
    cols = [F.col(f"`{c}`") for c in sorted(df.columns)]
    parts = [part for c in cols for part in (c.isNull(), c)]
    return F.sum(F.xxhash64(*parts).cast("decimal(38,0)"))
