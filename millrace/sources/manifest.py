"""Checksums, change detection and the extraction manifest."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime
from pathlib import PurePosixPath

from pyspark.sql import DataFrame, Observation, Row, SparkSession, Window
from pyspark.sql import functions as F

from millrace.functions.hashing import checksum16
from millrace.sources.pools import each_source
from millrace.sources.files import JsonLayout, read_source, require_columns

MANIFEST_SCHEMA = (
    "source_name string, path string, row_count bigint, byte_count bigint, checksum string, "
    "columns array<string>, success boolean, error string, duration_seconds double, "
    "extracted_at timestamp_ntz, skipped boolean"
)


#: Two primes below 2**31 and the bases whose powers weigh the lines of a file.
_FIELDS = ((2_147_483_647, 16_807), (2_147_483_629, 48_271))
#: Lines before which a task may start counting: ``monotonically_increasing_id`` has 33 bits.
_INDEX_BITS = 33


def _power(index: str, prime: int, base: int) -> str:
    """SQL for ``base ** index mod prime``: one table look-up for every eight bits of index."""
    power = "1L"
    for shift in range(0, _INDEX_BITS, 8):
        table = ",".join(f"{pow(base, b << shift, prime)}L" for b in range(256))
        digit = f"cast(shiftright({index}, {shift}) & 255 as int)"
        power = f"({power} * array({table})[{digit}] % {prime}L)"
    return power


def file_checksums(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """One row per file: ``path, length, checksum``, by one rule for files of every size.

    The bytes between line feeds are the file's lines, in whatever format it is. The checksum
    is the sum of the first 64 bits of the lines' SHA-256, plus two polynomials that see in
    which place each line stands: ``sum(c[i] * (base**i - 1))`` modulo a prime, where c[i] is
    another hash of line i. All of it modulo 2**64, in hexadecimal; for one line that is the
    start of its SHA-256.

    Any number of tasks read a file once, and none holds it. A task weighs its lines by their
    place among the rows of its own partition; powers of the base then move each split to its
    place in the file, for which only one row per split is shuffled. How a file is split does
    not change its checksum. Spark passes over files without content.
    """
    place = F.monotonically_increasing_id().bitwiseAND((1 << _INDEX_BITS) - 1)
    lines = (
        spark.read.option("recursiveFileLookup", "true")
        .option("lineSep", "\n")
        .text(paths)
        .select(
            F.col("_metadata.file_path").alias("path"),
            F.col("_metadata.file_size").alias("length"),
            F.col("_metadata.file_block_start").alias("start"),
            place.alias("place"),
            F.conv(checksum16(F.col("value").cast("binary")), 16, 10)
            .cast("decimal(20,0)")
            .alias("part"),
            F.xxhash64(F.col("value").cast("binary")).alias("other"),
        )
    )
    weighed, plain, moved = [], [], []
    for k, (prime, base) in enumerate(_FIELDS):
        c = f"pmod(other, {prime}L)"
        weighed.append(F.expr(f"sum({c} * {_power('place', prime, base)} % {prime}L)").alias(f"w{k}"))
        plain.append(F.expr(f"sum({c})").alias(f"p{k}"))
        there = _power(f"pmod(before - least, {prime - 1}L)", prime, base)
        moved.append(f"pmod(sum((w{k} % {prime}L) * {there} % {prime}L - p{k} % {prime}L), {prime}L)")
    splits = lines.groupBy("path", "length", "start").agg(
        F.sum("part").alias("total"),
        F.count(F.lit(1)).alias("n"),
        F.min("place").alias("least"),
        *weighed,
        *plain,
    )
    earlier = (
        Window.partitionBy("path").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    )
    placed = splits.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
    order = f"cast({moved[0]} * {2**31}L + {moved[1]} as decimal(38,0))"
    summed = placed.groupBy("path", "length").agg(
        (F.sum("total") + F.expr(order)).alias("total")
    )
    low = (F.col("total") % F.lit(str(2**64)).cast("decimal(38,0)")).cast("string")
    return summed.select(
        "path", "length", F.lower(F.lpad(F.conv(low, 10, 16), 16, "0")).alias("checksum")
    )


def changed_files(current: DataFrame, seen: DataFrame) -> DataFrame:
    """Files that an earlier ``file_checksums`` result does not have with the same content."""
    own = ["path", "length", "checksum"]
    return current.join(seen.select(*own), own, "left_anti")


def source_fingerprint(files: DataFrame) -> DataFrame:
    """One row: ``byte_count, checksum`` of a source made of any number of files.

    A single file keeps its own checksum. Several are combined by an order-free sum,
    which needs no list of them.
    """
    total = F.sum(F.conv(F.col("checksum"), 16, 10).cast("decimal(38,0)"))
    return files.agg(
        F.coalesce(F.sum("length"), F.lit(0)).alias("byte_count"),
        F.when(F.count(F.lit(1)) == 1, F.max("checksum"))
        .otherwise(checksum16(total.cast("string").cast("binary")))
        .alias("checksum"),
    )


def extract_source(
    spark: SparkSession,
    source_name: str,
    path: str | None,
    landing: str,
    extracted_at: datetime,
    previous: Row | None = None,
    multiline: bool = False,
    json_layout: JsonLayout = "document",
) -> Row:
    """Land one source as Parquet and return its manifest row.

    The content is read once for its fingerprint and, if that is new, once more to write and
    count its rows. A failure becomes a manifest row.
    """
    started = datetime.now()
    target = f"{landing.rstrip('/')}/{source_name}"

    def outcome(**values) -> Row:
        row = {
            "source_name": source_name,
            "path": target,
            "row_count": 0,
            "byte_count": 0,
            "checksum": "",
            "columns": [],
            "success": False,
            "error": None,
            "duration_seconds": (datetime.now() - started).total_seconds(),
            "extracted_at": extracted_at,
            "skipped": False,
        }
        return Row(**{**row, **values})

    try:
        if path is None:
            raise ValueError(f"No path configured for source: {source_name}")
        df = require_columns(
            read_source(spark, path, multiline, json_layout), source_name, with_rows=False
        )
        content = source_fingerprint(file_checksums(spark, path)).first()
        found = {
            "byte_count": content.byte_count,
            "checksum": content.checksum,
            "columns": df.columns,
            "success": True,
        }
        same = previous is not None and previous.success
        if same and (previous.byte_count, previous.checksum) == (
            content.byte_count,
            content.checksum,
        ):
            return outcome(**found, row_count=previous.row_count, skipped=True)
        rows = Observation()
        df.observe(rows, F.count(F.lit(1)).alias("n")).write.mode("overwrite").parquet(
            f"{target}/{content.checksum}"
        )
        if rows.get["n"] == 0:
            raise ValueError(f"No data rows found in {source_name}")
        return outcome(**found, row_count=rows.get["n"])
    except Exception as exc:
        return outcome(error=str(exc))


@dataclass(frozen=True)
class Source:
    """Where a source lies and how its files are laid out."""

    path: str | None
    multiline: bool = False
    json_layout: JsonLayout = "document"


def extract_all(
    spark: SparkSession,
    sources: Mapping[str, str | Source],
    landing: str,
    extracted_at: datetime,
    previous: Mapping[str, Row] | None = None,
    at_once: int = 4,
) -> DataFrame:
    """Manifest of all sources, in their order; a failing source does not stop the others.

    ``at_once`` sources are extracted at a time.
    """

    def extract(item: tuple[str, str | Source]) -> Row:
        name, given = item
        source = given if isinstance(given, Source) else Source(given)
        return extract_source(
            spark,
            name,
            source.path,
            landing,
            extracted_at,
            (previous or {}).get(name),
            source.multiline,
            source.json_layout,
        )

    rows = each_source(spark, extract, sources.items(), at_once)
    return spark.createDataFrame(rows, MANIFEST_SCHEMA)


def landed(spark: SparkSession, entry: Row) -> DataFrame:
    """The data a manifest row points to."""
    return spark.read.parquet(str(PurePosixPath(entry.path) / entry.checksum))


def extraction_summary(manifest: DataFrame) -> DataFrame:
    """One row: sources succeeded and failed, rows and seconds in total."""
    return manifest.agg(
        F.count_if("success").alias("succeeded"),
        F.count_if(~F.col("success")).alias("failed"),
        F.coalesce(F.sum("row_count"), F.lit(0)).alias("total_rows"),
        F.coalesce(F.sum("duration_seconds"), F.lit(0.0)).alias("total_seconds"),
    )
