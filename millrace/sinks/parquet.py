"""Parquet folders, optionally partitioned."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from millrace.sources.schemas import LOADED_AT

LOADED_DATE = "_loaded_date"


def write_parquet(
    df: DataFrame,
    path: str,
    compression: str = "snappy",
    partition_col: str | None = None,
    keep_if_empty: bool = True,
) -> int:
    """Replace ``path`` by the rows and return their number; no rows writes nothing.

    Finding out that there are no rows runs the plan up to its first row. Pass
    ``keep_if_empty=False`` for a plan with a shuffle: then no rows clear the folder.

    A partition column the frame lacks is ignored. Rows are gathered by partition value
    before the write, which bounds the number of files; adaptive execution splits the
    share of a dominant value over several tasks.
    """
    if keep_if_empty and df.isEmpty():
        return 0
    rows = Observation()
    partitioned = partition_col is not None and partition_col in df.columns
    if partitioned:
        df = df.hint("rebalance", F.col(partition_col))
    writer = (
        df.observe(rows, F.count(F.lit(1)).alias("n"))
        .write.mode("overwrite")
        .option("compression", compression)
    )
    (writer.partitionBy(partition_col) if partitioned else writer).parquet(path)
    return rows.get["n"]


def append_by_load_date(df: DataFrame, path: str) -> None:
    """Append stamped rows to a folder partitioned by the day of ``_loaded_at``.

    One load has one load time, so every task writes into a single day folder.
    """
    df.withColumn(LOADED_DATE, F.col(LOADED_AT).cast("date")).write.mode("append").partitionBy(
        LOADED_DATE
    ).parquet(path)
