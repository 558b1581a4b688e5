"""Working folders that every executor can reach."""

from __future__ import annotations

import atexit
import uuid
from collections.abc import Iterator
from contextlib import contextmanager, suppress

from pyspark.sql import SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"
WAREHOUSE_DIR = "spark.sql.warehouse.dir"

_made: dict[str, SparkSession] = {}


def workspace(spark: SparkSession, purpose: str) -> str:
    """A new folder path in the cluster's shared storage.

    The base is ``spark.checkpoint.dir`` or, where that is unset, the warehouse; never a
    folder of one machine's own. ``release`` removes the folder; what is left is removed
    when the driver's Python process ends.
    """
    base = spark.conf.get(CHECKPOINT_DIR, None) or spark.conf.get(WAREHOUSE_DIR) + "/_work"
    path = f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex[:12]}"
    _made[path] = spark
    return path


def release(spark: SparkSession, *paths: str) -> None:
    """Remove working folders whose rows nothing reads any more."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    for path in paths:
        folder = jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(conf).delete(folder, True)
        _made.pop(path, None)


@contextmanager
def working_folder(spark: SparkSession, purpose: str) -> Iterator[str]:
    """A working folder that is removed at the end of the block."""
    path = workspace(spark, purpose)
    try:
        yield path
    finally:
        release(spark, path)


@atexit.register
def release_all() -> None:
    """Remove every working folder that is left, of sessions still running."""
    for path, spark in list(_made.items()):
        with suppress(Exception):
            release(spark, path)
