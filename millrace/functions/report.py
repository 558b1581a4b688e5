"""The one sentence that checks report: what was checked, a share of rows, a limit, samples."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

NO_ROWS = "nothing to check"


def report(
    what: str,
    part: int | None = None,
    whole: int | None = None,
    limit: str | None = None,
    sample: Sequence[str] = (),
) -> str:
    """For example ``duplicates in id: 2 of 8 (25.00%), limit 0.00%, such as 1, 7``."""
    if whole == 0:
        return f"{what}: {NO_ROWS}"
    text = what
    if whole is not None:
        text += f": {part} of {whole} ({part / whole:.2%})"
    elif part is not None:
        text += f": {part}"
    if limit is not None:
        text += f", limit {limit}"
    return text + (f", such as {', '.join(sample)}" if sample else "")


def report_column(what: str, part: Column, whole: Column, limit: str | None = None) -> Column:
    """The same sentence in a plan."""
    text = F.format_string(
        "%s: %d of %d (%.2f%%)", F.lit(what), part, whole, F.try_divide(100.0 * part, whole)
    )
    if limit is not None:
        text = F.concat(text, F.lit(f", limit {limit}"))
    return F.when(whole == 0, F.lit(f"{what}: {NO_ROWS}")).otherwise(text)
