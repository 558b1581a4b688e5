"""Validate landed files as they arrive and append them."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import UTC, datetime

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from millrace.functions.time import utc_literal
from millrace.operators.rules import Rule, validate
from millrace.sources.schemas import LOADED_AT

BATCH = "_batch_id"


def _now() -> datetime:
    return datetime.now(UTC)


def append_stream(
    stream: DataFrame,
    target: str,
    checkpoint: str,
    rules: Sequence[Rule] | None = None,
    rejected: str | None = None,
    trigger: dict[str, object] | None = None,
) -> StreamingQuery:
    """Append every micro-batch to a Parquet folder, with one load time per batch.

    With ``rules`` only valid rows go to ``target``; ``rejected`` receives the others
    with their errors. A batch writes its own ``_batch_id=`` folder in overwrite mode:
    a batch that runs again after a failure replaces its rows instead of doubling them.
    The default ``trigger`` takes what has landed and stops.
    """

    def write(df: DataFrame, folder: str, batch_id: int, at: datetime) -> None:
        stamped = df.withColumn(LOADED_AT, utc_literal(at))
        stamped.write.mode("overwrite").parquet(f"{folder}/{BATCH}={batch_id}")

    def plain(batch: DataFrame, batch_id: int) -> None:
        write(batch, target, batch_id, _now())

    def split(batch: DataFrame, batch_id: int) -> None:
        # Validation is one narrow pass: a second one costs less than keeping the batch.
        outcome, at = validate(batch, rules), _now()
        write(outcome.valid, target, batch_id, at)
        if rejected is not None:
            write(outcome.invalid, rejected, batch_id, at)

    each: Callable[[DataFrame, int], None] = plain if rules is None else split
    return (
        stream.writeStream.foreachBatch(each)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
