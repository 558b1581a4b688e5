"""What the operators of this package share: shipping code, staged tables, Arrow batches."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Batches = Iterator[pa.RecordBatch]

#: Text handed to one step of a Python worker at a time, in bytes.
STEP_BYTES = 2_000_000


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once per Spark context.

    The archive lies in the driver's own folder; Spark serves it to the executors.
    """
    context = spark.sparkContext
    if getattr(context, "_millrace_shipped", False):
        return
    root = Path(__file__).resolve().parents[1]
    archive = os.path.join(tempfile.mkdtemp(prefix="millrace-code-"), "millrace_code.zip")
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as z:
        for file in sorted(root.rglob("*.py")):
            z.write(file, file.relative_to(root.parent))
    context.addPyFile(archive)
    context._millrace_shipped = True


def map_batches(df: DataFrame, work: Callable[[Batches], Batches], schema: str) -> DataFrame:
    """``mapInArrow`` with this package on the executors."""
    ship(df.sparkSession)
    return df.mapInArrow(work, schema)


def on_group(work: Callable[..., pa.Table], *given) -> Callable[[pa.Table], pa.Table]:
    """``work`` with its first arguments given, with the annotations ``applyInArrow`` needs."""

    def run(rows: pa.Table) -> pa.Table:
        return work(*given, rows)

    return run


def on_keyed_group(work: Callable[..., pa.Table], *given) -> Callable[..., pa.Table]:
    """As ``on_group``, for work that takes the key as well."""

    def run(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        return work(*given, key, rows)

    return run


def staged(df: DataFrame, path: str, **options: str) -> DataFrame:
    """Write ``df`` to shared storage and read it back: later steps start from the files."""
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def utf8(column: str) -> Column:
    """The bytes of a text column; null counts as empty."""
    return F.coalesce(F.col(f"`{column}`").cast("string"), F.lit("")).cast("binary")


def steps(items: list[bytes]) -> Iterator[tuple[int, int]]:
    """Consecutive slices of ``items`` of about ``STEP_BYTES`` each, one item at least."""
    start, held = 0, 0
    for i, item in enumerate(items):
        held += len(item)
        if held >= STEP_BYTES:
            yield start, i + 1
            start, held = i + 1, 0
    if start < len(items):
        yield start, len(items)


def out_batch(schema: pa.Schema, *columns) -> pa.RecordBatch:
    arrays = [
        c if isinstance(c, pa.Array) else pa.array(c, type=f.type)
        for c, f in zip(columns, schema, strict=True)
    ]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)
