"""Named queries against a database, read over JDBC."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

FETCH_SIZE = 10_000


@dataclass(frozen=True)
class Split:
    """Read a query in parallel ranges of a numeric, date or timestamp column."""

    column: str
    lower: str
    upper: str
    partitions: int


def jdbc_options(
    connection: Mapping[str, str],
    query: str,
    fetch_size: int = FETCH_SIZE,
    split: Split | None = None,
) -> dict[str, str]:
    """Reader options. A split query goes in as a derived table, which JDBC requires."""
    options = {**connection, "fetchsize": str(fetch_size)}
    if split is None:
        return {**options, "query": query}
    return {
        **options,
        "dbtable": f"({query}) q",
        "partitionColumn": split.column,
        "lowerBound": split.lower,
        "upperBound": split.upper,
        "numPartitions": str(split.partitions),
    }


def read_query(
    spark: SparkSession,
    connection: Mapping[str, str],
    queries: Mapping[str, str],
    source_name: str,
    fetch_size: int = FETCH_SIZE,
    split: Split | None = None,
    in_one_task: bool = False,
) -> DataFrame:
    """Rows of a named query; filters and columns chosen later are pushed down.

    A read without ``split`` is one task's work and has to be asked for by ``in_one_task``.
    """
    if source_name not in queries:
        raise ValueError(f"No query configured for source: {source_name}")
    if split is None and not in_one_task:
        raise ValueError("give a split, or ask for a read in_one_task")
    options = jdbc_options(connection, queries[source_name], fetch_size, split)
    return spark.read.format("jdbc").options(**options).load()
