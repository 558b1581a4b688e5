"""Raw files to tested marts in one call: load, check, build, test."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame

from millrace.operators.column_tests import run_column_tests
from millrace.operators.source_checks import Check, CheckResult, require_passed, run_checks
from millrace.plans.build import build_marts
from millrace.sinks.loading import LoadResult, load_all
from millrace.sinks.tables import Warehouse


@dataclass(frozen=True)
class FlowResult:
    loads: list[LoadResult]
    checks: list[CheckResult]
    models: dict[str, DataFrame]
    tests: DataFrame


def run_flow(
    w: Warehouse,
    paths: Mapping[str, str],
    marts: str,
    loaded_at: datetime,
    checks: Sequence[Check] | None = None,
    gate: bool = False,
) -> FlowResult:
    """Load the raw tables, check them, build the marts and test all models.

    A failed load raises. Failed checks are reported; with ``gate`` those of severity
    error stop the flow before the marts are built.
    """
    loads = load_all(w, paths, loaded_at)
    failed = [f"{r.source_name}: {r.error}" for r in loads if not r.success]
    if failed:
        raise RuntimeError(f"Load failed for: {'; '.join(failed)}")
    raw = {r.source_name: w.spark.table(w.table(r.source_name)) for r in loads}
    results = run_checks(w.spark, raw, checks)
    if gate:
        require_passed(results)
    models = build_marts(w.spark, raw, marts)
    models.update({f"raw_{name}": df for name, df in raw.items()})
    return FlowResult(loads, results, models, run_column_tests(models))
