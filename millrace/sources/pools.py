"""Several sources at a time: each one's jobs run in a scheduler pool of its own."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

Item = TypeVar("Item")
Result = TypeVar("Result")
_POOL = "spark.scheduler.pool"


def each_source(
    spark: SparkSession, work: Callable[[Item], Result], items: Iterable[Item], at_once: int
) -> list[Result]:
    """``work`` of every item, ``at_once`` of them at a time; results in the order of items.

    Jobs take over the caller's job group and properties. With ``spark.scheduler.mode=FAIR``
    the pools share the cluster, so that a large source does not hold up the small ones.
    """
    context = spark.sparkContext
    listed = list(items)
    if at_once < 2 or len(listed) < 2:
        return [work(item) for item in listed]

    def run(numbered: tuple[int, Item]) -> Result:
        number, item = numbered
        before = context.getLocalProperty(_POOL)
        context.setLocalProperty(_POOL, f"millrace-{number % at_once}")
        try:
            return work(item)
        finally:
            context.setLocalProperty(_POOL, before)

    def start(numbered: tuple[int, Item]) -> Callable[[], Result]:
        # Properties are taken over here, in the caller's thread.
        return inheritable_thread_target(spark)(lambda: run(numbered))

    with ThreadPoolExecutor(max_workers=at_once) as threads:
        running = [threads.submit(start(numbered)) for numbered in enumerate(listed)]
        return [r.result() for r in running]
