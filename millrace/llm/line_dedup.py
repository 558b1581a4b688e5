"""Line deduplication over levelled sorted runs of line hashes.

A run is a table, bucketed and sorted by line hash, with one row per hash: in how many
documents the line stands and the largest id among them. Documents come in batches:

1. A batch's lines are counted per hash. Hashes which a run already holds as repeated, with
   an id no smaller, are anti-joined away: they could not change any result. Runs are joined
   bucket by bucket, without moving them. What is left becomes a new run of level 0.
2. When a level has ``fanout`` runs, they are merged into one run of the next level.
3. At the end the runs are merged once more: the hashes of at least ``min_docs`` documents.
   Every document but the one with the largest id loses such lines.

A line's key is the line without space and U+0009 to U+000D at both ends, with A-Z lowered.
Keys shorter than ``min_chars`` code points are never dropped. The hash has 128 bits.

Null text counts as one empty line. Rows that repeat an id count as one document, and all of
them keep or lose a line. A null id is smaller than any other. An empty table gives an empty
result. Only the named columns are read.
"""

from __future__ import annotations

import hashlib
import uuid
from functools import partial

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.shared import Batches, map_batches, out_batch, staged, utf8
from millrace.session import release, workspace

MIN_CHARS = 20
MIN_DOCS = 3
BATCHES = 4
FANOUT = 2

_SPACE = b" \t\n\x0b\x0c\r"


class LineRuns:
    """The runs of all levels. ``add`` may be called with batches in any order."""

    def __init__(self, spark: SparkSession, min_docs: int = MIN_DOCS, fanout: int = FANOUT) -> None:
        self.spark, self.min_docs, self.fanout = spark, min_docs, fanout
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[list[tuple[str, str]]] = [[]]

    def add(self, lines: DataFrame) -> None:
        """Add a batch: columns ``id`` and ``hash``, each pair once."""
        own = lines.groupBy("hash").agg(F.count("*").alias("n"), F.max("id").alias("largest"))
        for run in self._tables():
            settled = run.filter(F.col("n") >= self.min_docs).select(
                "hash", F.col("largest").alias("settled")
            )
            known = (own["hash"] == settled["hash"]) & (
                own["largest"].isNull() | (own["largest"] <= settled["settled"])
            )
            own = own.join(settled, known, "left_anti")
        self.levels[0].append(self._write(own))
        level = 0
        while len(self.levels[level]) >= self.fanout:
            runs = self.levels[level]
            merged = self._write(self._merged(runs))
            self.levels[level] = []
            self._drop(runs)
            level += 1
            if level == len(self.levels):
                self.levels.append([])
            self.levels[level].append(merged)

    def repeated(self) -> DataFrame:
        """``hash`` and ``largest`` of the lines that stand in enough documents."""
        every = self._merged([run for runs in self.levels for run in runs])
        return every.filter(F.col("n") >= self.min_docs).select("hash", "largest")

    def close(self) -> None:
        for runs in self.levels:
            self._drop(runs)
        self.levels = [[]]

    def _tables(self) -> list[DataFrame]:
        return [self.spark.table(name) for runs in self.levels for name, _ in runs]

    def _merged(self, runs: list[tuple[str, str]]) -> DataFrame:
        # Read as files: a union of bucketed tables is taken for bucketed, which it is not.
        schema = self.spark.table(runs[0][0]).schema
        every = self.spark.read.schema(schema).parquet(*(folder for _, folder in runs))
        return every.groupBy("hash").agg(F.sum("n").alias("n"), F.max("largest").alias("largest"))

    def _write(self, run: DataFrame) -> tuple[str, str]:
        name, folder = f"millrace_run_{uuid.uuid4().hex[:12]}", workspace(self.spark, "line-run")
        (
            run.repartition(self.buckets, "hash")
            .write.bucketBy(self.buckets, "hash")
            .sortBy("hash")
            .option("path", folder)
            .saveAsTable(name)
        )
        return name, folder

    def _drop(self, runs: list[tuple[str, str]]) -> None:
        for name, folder in runs:
            self.spark.sql(f"drop table if exists {name}")
            release(self.spark, folder)


def drop_repeated_lines(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_chars: int = MIN_CHARS,
    min_docs: int = MIN_DOCS,
    batches: int = BATCHES,
    fanout: int = FANOUT,
) -> DataFrame:
    """Every row's ``id_col``, ``kept_text`` (UTF-8), ``n_lines`` and ``n_dropped``.

    The table is dealt into ``batches`` of about equal size by ranges of a numeric id, the
    largest ids first, so that most repeated lines are settled early; other ids are dealt by
    hash.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), utf8(text_col).alias("text"))
    id_type = rows.schema["id"].dataType.simpleString()
    if id_type in ("tinyint", "smallint", "int", "bigint"):
        # Where the batches are cut changes the work, not the result.
        shares = [k / batches for k in range(1, batches)]
        cuts = rows.agg(F.percentile_approx("id", shares).alias("cuts")).first().cuts if shares else []
        batch = F.lit(0)
        for cut in cuts or []:
            batch = batch + (F.col("id") <= F.lit(cut)).cast("int")
        batch = F.coalesce(batch, F.lit(batches - 1))
    else:
        batch = F.pmod(F.xxhash64("id"), F.lit(batches)).cast("int")
    folder = workspace(spark, "line-hashes")
    # A batch's lines are read again for its run and, at the end, to find what to drop.
    map_batches(
        rows.withColumn("batch", batch),
        partial(_line_hashes, min_chars),
        f"batch int, id {id_type}, hash binary",
    ).write.partitionBy("batch").parquet(folder)
    lines = spark.read.schema(f"id {id_type}, hash binary, batch int").parquet(folder)
    lines = lines.dropDuplicates(["id", "hash"]) if _repeats_ids(rows) else lines
    runs = LineRuns(spark, min_docs, fanout)
    try:
        for k in range(batches):
            runs.add(lines.filter(F.col("batch") == k).select("id", "hash"))
        repeated = staged(runs.repeated(), workspace(spark, "line-repeated"))
    finally:
        runs.close()
    # Both inputs come straight from files: a line of very many documents can be split.
    losing = lines.join(repeated, "hash").filter(~F.col("id").eqNullSafe(F.col("largest")))
    drops = staged(
        losing.groupBy("id").agg(F.collect_list("hash").alias("drops")),
        workspace(spark, "line-drops"),
    )
    release(spark, folder)
    named = drops.withColumnRenamed("id", "of")
    with_drops = rows.join(named, F.col("id").eqNullSafe(F.col("of")), "left").drop("of")
    kept = map_batches(
        with_drops, _rewrite, f"id {id_type}, kept_text binary, n_lines long, n_dropped long"
    )
    return kept.withColumnRenamed("id", id_col)


def _repeats_ids(rows: DataFrame) -> bool:
    return not rows.groupBy("id").count().filter("count > 1").isEmpty()


def line_key(line: bytes) -> bytes:
    return line.strip(_SPACE).lower()


def _hash(key: bytes) -> bytes:
    return hashlib.blake2b(key, digest_size=16).digest()


def _line_hashes(min_chars: int, batches: Batches) -> Batches:
    """Each long enough line of each document once."""
    for batch in batches:
        owners, hashes = [], []
        for i, text in enumerate(batch.column("text").to_pylist()):
            keys = {line_key(line) for line in text.split(b"\n")}
            own = [
                _hash(k)
                for k in keys
                if len(k) >= min_chars and len(k.decode("utf-8", "replace")) >= min_chars
            ]
            owners += [i] * len(own)
            hashes += own
        schema = pa.schema(
            [("batch", pa.int32()), ("id", batch.column("id").type), ("hash", pa.binary())]
        )
        taken = pa.array(owners, pa.int64())
        yield out_batch(
            schema, batch.column("batch").take(taken), batch.column("id").take(taken), hashes
        )


def _rewrite(batches: Batches) -> Batches:
    for batch in batches:
        kept, n_lines, n_dropped = [], [], []
        for text, drops in zip(batch.column("text").to_pylist(), batch.column("drops").to_pylist()):
            lines = text.split(b"\n")
            n_lines.append(len(lines))
            if drops:
                gone = set(drops)
                lines = [line for line in lines if _hash(line_key(line)) not in gone]
            kept.append(b"\n".join(lines))
            n_dropped.append(n_lines[-1] - len(lines))
        schema = pa.schema(
            [
                ("id", batch.column("id").type),
                ("kept_text", pa.binary()),
                ("n_lines", pa.int64()),
                ("n_dropped", pa.int64()),
            ]
        )
        yield out_batch(schema, batch.column("id"), kept, n_lines, n_dropped)
