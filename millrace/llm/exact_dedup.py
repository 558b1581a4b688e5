"""Exact deduplication by Grace hashing.

1. Every scan task folds its own rows with an open-addressing table that compares complete
   texts, so a text leaves a task once, however often it occurs there.
2. The folded rows go to spill files: tables in shared storage, bucketed by a hash of the
   text's digest. A bucket with more bytes than ``bucket_bytes`` is partitioned again, with
   another hash, into the spill files of the next level, until every bucket fits or holds
   one digest only (copies of one text; the table needs that text once).
3. Each bucket is read by one task, without a shuffle, into a table of complete texts.
4. Documents find their group by digest. Should two different texts ever share a digest,
   the documents concerned are compared with the texts themselves.

Texts are equal when identical after lower-casing A-Z. Null counts as empty. Of equal texts
the row with the largest id stays (a null id only among nulls); rows that repeat an id and a
text are all marked alike. An empty table gives an empty result. Only the named columns are
read.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.shared import Batches, map_batches, out_batch, staged, utf8
from millrace.operators.joins import join_splittable
from millrace.session import release, workspace

BUCKET_BYTES = 64 * 2**20
#: Different texts a scan task holds before it hands them on, in bytes.
_FOLD_BYTES = 32 * 2**20
_DEEPEST = 16


class TextTable:
    """Open addressing with linear probing over complete texts; counts and largest ids."""

    def __init__(self) -> None:
        self._slots = np.full(1024, -1, dtype=np.int64)
        self.digests: list[bytes] = []
        self.texts: list[bytes] = []
        self.largest: list = []
        self.counts: list[int] = []
        self.held = 0

    def add(self, digest: bytes, text: bytes, largest, count: int) -> None:
        at = self._find(digest, text)
        entry = int(self._slots[at])
        if entry >= 0:
            self.counts[entry] += count
            if self.largest[entry] is None or (largest is not None and largest > self.largest[entry]):
                self.largest[entry] = largest
            return
        self._slots[at] = len(self.texts)
        self.digests.append(digest)
        self.texts.append(text)
        self.largest.append(largest)
        self.counts.append(count)
        self.held += len(text) + 200
        if 2 * len(self.texts) > len(self._slots):
            self._slots = np.full(2 * len(self._slots), -1, dtype=np.int64)
            for i, (d, t) in enumerate(zip(self.digests, self.texts, strict=True)):
                self._slots[self._find(d, t)] = i

    def _find(self, digest: bytes, text: bytes) -> int:
        """The slot that holds ``text``, or the free one where it belongs."""
        mask = len(self._slots) - 1
        at = int.from_bytes(digest[:8], "little") & mask
        while (entry := int(self._slots[at])) >= 0 and self.texts[entry] != text:
            at = (at + 1) & mask
        return at


def exact_groups(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    bucket_bytes: int = BUCKET_BYTES,
    digest_bytes: int = 32,
) -> DataFrame:
    """Every row's group: ``id_col``, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``.

    ``digest_bytes`` shortens the digest that buckets and joins go by, for tests.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), utf8(text_col).alias("text"))
    id_type = rows.schema["id"].dataType.simpleString()
    groups = staged(
        _resolve(rows, id_type, bucket_bytes, digest_bytes), workspace(spark, "exact-groups")
    )
    alone = groups.filter("not shared")
    named = map_batches(
        rows, partial(_name, digest_bytes), f"id {id_type}, digest binary, sha string"
    )
    result = join_splittable(named, alone.drop("shared", "text"), "digest", "inner")
    shared = groups.filter("shared")
    if not shared.isEmpty():
        full = map_batches(
            rows,
            partial(_name, digest_bytes, with_text=True),
            f"id {id_type}, digest binary, sha string, text binary",
        )
        result = result.unionByName(
            full.join(shared.drop("shared"), ["digest", "text"]).drop("text")
        )
    return result.select(
        F.col("id").alias(id_col),
        "keep_id",
        "group_size",
        F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.col("sha").alias("text_sha256"),
    )


def _name(digest_bytes: int, batches: Batches, with_text: bool = False) -> Batches:
    for batch in batches:
        texts = [t.lower() for t in batch.column("text").to_pylist()]
        digests = [hashlib.sha256(t).digest() for t in texts]
        fields = [("id", batch.column("id").type), ("digest", pa.binary()), ("sha", pa.string())]
        columns = [batch.column("id"), [d[:digest_bytes] for d in digests], [d.hex() for d in digests]]
        if with_text:
            fields.append(("text", pa.binary()))
            columns.append(texts)
        yield out_batch(pa.schema(fields), *columns)


def _fold(digest_bytes: int, batches: Batches) -> Batches:
    table, schema = TextTable(), None
    for batch in batches:
        schema = schema or _folded(batch.column("id").type)
        for name, raw in zip(batch.column("id").to_pylist(), batch.column("text").to_pylist()):
            text = raw.lower()
            table.add(hashlib.sha256(text).digest()[:digest_bytes], text, name, 1)
            if table.held >= _FOLD_BYTES:
                yield from _rows(table, schema)
                table = TextTable()
    if schema:
        yield from _rows(table, schema)


def _folded(id_type: pa.DataType) -> pa.Schema:
    return pa.schema(
        [
            ("digest", pa.binary()),
            ("text", pa.binary()),
            ("largest", id_type),
            ("n", pa.int64()),
            ("bytes", pa.int64()),
        ]
    )


def _rows(table: TextTable, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    for a in range(0, len(table.texts), 2000):
        part = slice(a, a + 2000)
        texts = table.texts[part]
        yield out_batch(
            schema,
            table.digests[part],
            texts,
            table.largest[part],
            table.counts[part],
            [len(t) for t in texts],
        )


def _resolve(rows: DataFrame, id_type: str, bucket_bytes: int, digest_bytes: int) -> DataFrame:
    """One row per different text, from the buckets of all levels."""
    spark = rows.sparkSession
    fanout = int(spark.conf.get("spark.sql.shuffle.partitions"))
    pending = map_batches(
        rows,
        partial(_fold, digest_bytes),
        f"digest binary, text binary, largest {id_type}, n long, bytes long",
    )
    found, done = None, []
    for level in range(_DEEPEST):
        name, folder = f"millrace_spill_{uuid.uuid4().hex[:12]}", workspace(spark, "exact-spill")
        hashed = F.pmod(F.xxhash64("digest", F.lit(level)), F.lit(fanout)).cast("int")
        (
            pending.withColumn("bucket", hashed)
            .repartition(fanout, "bucket")
            .write.bucketBy(fanout, "bucket")
            .option("path", folder)
            .option("compression", "zstd")
            .saveAsTable(name)
        )
        if done:  # the level above is settled now
            _forget(spark, done[-1])
        done.append((name, folder))
        spill = spark.table(name)
        sizes = spill.groupBy("bucket").agg(
            F.sum("bytes").alias("bytes"),
            F.min("digest").alias("low"),
            F.max("digest").alias("high"),
        )
        large = [
            r["bucket"]
            for r in sizes.filter(F.col("bytes") > bucket_bytes).filter("low < high").collect()
        ]  # at most one number per bucket of this level
        if level + 1 == _DEEPEST:
            large = []
        fit = spill.filter(~F.col("bucket").isin(large)) if large else spill
        groups = fit.groupBy("bucket").applyInArrow(
            _bucket_groups,
            f"digest binary, keep_id {id_type}, group_size long, shared boolean, text binary",
        )
        path = workspace(spark, "exact-level")
        part = staged(groups, path)
        found = part if found is None else found.unionByName(part)
        if not large:
            break
        pending = spill.filter(F.col("bucket").isin(large)).drop("bucket")
    _forget(spark, done[-1])
    return found


def _forget(spark, spill: tuple[str, str]) -> None:
    spark.sql(f"drop table if exists {spill[0]}")
    release(spark, spill[1])


def _bucket_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The different texts of one bucket. ``text`` is set where a digest stands for several."""
    table, id_type = TextTable(), None
    for batch in batches:
        id_type = batch.column("largest").type
        for row in zip(*(batch.column(c).to_pylist() for c in ("digest", "text", "largest", "n"))):
            table.add(*row)
    if id_type is None:
        return
    uses: dict[bytes, int] = {}
    for d in table.digests:
        uses[d] = uses.get(d, 0) + 1
    shared = [uses[d] > 1 for d in table.digests]
    schema = pa.schema(
        [
            ("digest", pa.binary()),
            ("keep_id", id_type),
            ("group_size", pa.int64()),
            ("shared", pa.bool_()),
            ("text", pa.binary()),
        ]
    )
    texts = [t if s else None for t, s in zip(table.texts, shared, strict=True)]
    yield out_batch(schema, table.digests, table.largest, table.counts, shared, texts)
