"""Name -> query and oracle SQL."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

Run = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    name: str
    run: Run
    oracle: str | None


REGISTRY: dict[str, Query] = {}


def query(oracle: str | None = None, name: str | None = None) -> Callable[[Run], Run]:
    """Register a function under its name, with the SQL that must give the same rows."""

    def register(run: Run) -> Run:
        key = name or run.__name__
        if key in REGISTRY:
            raise ValueError(f"query {key} is registered twice")
        REGISTRY[key] = Query(key, run, oracle)
        return run

    return register
