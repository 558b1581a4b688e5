"""The registered queries and the SQL each of them is checked against."""

from millrace.workload.registry import REGISTRY, Query
from millrace.workload import (  # noqa: F401  (importing registers the queries)
    check_queries,
    cleaning_queries,
    io_queries,
    mart_queries,
    runlog_queries,
)

__all__ = ["REGISTRY", "Query"]
