"""Casting, null handling, filtering, and chaining of steps."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import Column, DataFrame, Observation, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.casts import lenient_cast
from millrace.functions.text import is_blank
from millrace.operators.dedup import deduplicate

Step = Callable[[DataFrame], DataFrame]


def _types(df: DataFrame) -> dict[str, T.DataType]:
    return {f.name: f.dataType for f in df.schema.fields}


def cast_types(df: DataFrame, type_map: Mapping[str, str]) -> DataFrame:
    """Lenient cast of the named columns; columns the frame lacks are skipped."""
    types = _types(df)
    return df.withColumns(
        {c: lenient_cast(F.col(f"`{c}`"), types[c], t) for c, t in type_map.items() if c in types}
    )


def cast_failures(df: DataFrame, type_map: Mapping[str, str]) -> list[Column]:
    """Aggregates counting, per column, the non-blank values the lenient cast loses."""
    types = _types(df)
    return [
        F.count_if(
            ~is_blank(F.col(f"`{c}`"), types[c])
            & lenient_cast(F.col(f"`{c}`"), types[c], t).isNull()
        ).alias(c)
        for c, t in type_map.items()
        if c in types
    ]


def fill_nulls(df: DataFrame, defaults: Mapping[str, Any]) -> DataFrame:
    """Replace NULL and blank values by a default; an absent column is added."""
    types = _types(df)
    return df.withColumns(
        {
            c: F.when(is_blank(F.col(f"`{c}`"), types[c]), F.lit(v)).otherwise(F.col(f"`{c}`"))
            if c in types
            else F.lit(v)
            for c, v in defaults.items()
        }
    )


def drop_nulls(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Drop rows with a NULL or blank in any named column. An absent column drops all."""
    types = _types(df)
    for c in columns:
        df = df.filter(~is_blank(F.col(f"`{c}`"), types[c]) if c in types else F.lit(False))
    return df


def filter_rows(df: DataFrame, predicate: Column) -> DataFrame:
    return df.filter(predicate)


@dataclass(frozen=True)
class NamedStep:
    name: str
    apply: Step


def dedup_step(keys: Sequence[str], order_by: Sequence[str], keep: str = "last") -> NamedStep:
    return NamedStep("deduplicate", lambda df: deduplicate(df, keys, order_by, keep))


def cast_step(type_map: Mapping[str, str]) -> NamedStep:
    return NamedStep("cast_types", lambda df: cast_types(df, type_map))


def fill_step(defaults: Mapping[str, Any]) -> NamedStep:
    return NamedStep("fill_nulls", lambda df: fill_nulls(df, defaults))


def drop_step(columns: Sequence[str]) -> NamedStep:
    return NamedStep("drop_nulls", lambda df: drop_nulls(df, columns))


def filter_step(predicate: Column, description: str = "custom filter") -> NamedStep:
    return NamedStep(f"filter({description})", lambda df: filter_rows(df, predicate))


@dataclass
class StepRun:
    """Result of a step chain. ``counts()`` needs an action on ``frame`` first."""

    frame: DataFrame
    checks: DataFrame | None = None
    _names: list[str] = field(default_factory=list)
    _observed: list[Observation] = field(default_factory=list)

    def counts(self) -> list[Row]:
        """One row per step: ``step, input_count, output_count, delta``."""
        if not self._observed:
            raise ValueError("run_steps(..., count_rows=True) is needed for step counts")
        seen = [o.get["n"] for o in self._observed]
        return [
            Row(step=name, input_count=before, output_count=after, delta=after - before)
            for name, before, after in zip(self._names, seen, seen[1:])
        ]


def run_steps(
    df: DataFrame,
    steps: Sequence[NamedStep],
    checks: Callable[[DataFrame], DataFrame] | None = None,
    count_rows: bool = False,
) -> StepRun:
    """Chain steps lazily.

    Row counts per step come from observed metrics of the one action that runs the
    chain. They stop filters from moving into the scan, so they are off by default.
    """
    observed: list[Observation] = []

    def watch(frame: DataFrame) -> DataFrame:
        if not count_rows:
            return frame
        observed.append(Observation())
        return frame.observe(observed[-1], F.count(F.lit(1)).alias("n"))

    df = watch(df)
    for step in steps:
        df = watch(step.apply(df))
    return StepRun(
        frame=df,
        checks=checks(df) if checks else None,
        _names=[s.name for s in steps],
        _observed=observed,
    )
