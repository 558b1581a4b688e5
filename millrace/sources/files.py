"""CSV, JSON and Parquet files."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from pathlib import PurePosixPath
from typing import Literal

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.session import workspace
from millrace.sources.records import (
    csv_records,
    first_of_file,
    json_elements,
    leaves_open,
    pieces,
    read_quoted_csv,
)
from millrace.sources.schemas import EXPECTED_COLUMNS


def read_csv(
    spark: SparkSession,
    path: str,
    multiline: bool = False,
    malformed: str | None = None,
    position: str | None = None,
) -> DataFrame:
    """All columns as text, named by each file's own header. An empty field is NULL.

    Files may order their columns differently or lack some; what a file lacks is NULL.
    ``malformed`` names an extra column that holds the raw text of rows with too few or
    too many fields. Quoted fields may hold line breaks: files that have some are put together
    from their lines by many tasks. ``multiline`` hands all files to the reader that takes one
    task per file. ``position`` names an extra column that orders rows as in the input: by
    file, split and row. It does not depend on how many tasks read the files.
    """

    def reader():
        return (
            spark.read.option("header", True)
            .option("encoding", "UTF-8")
            .option("escape", '"')
            .option("multiLine", multiline)
        )

    def load(files: str | list[str]) -> DataFrame:
        df = reader().csv(files)
        if malformed is not None:
            schema = T.StructType([*df.schema.fields, T.StructField(malformed, T.StringType())])
            marked = reader().schema(schema).option("columnNameOfCorruptRecord", malformed)
            df = marked.csv(files)
        if position is None:
            return df
        place = F.struct(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("start"),
            F.monotonically_increasing_id().alias("row"),
        )
        return df.select("*", place.alias(position))

    looked = _csv_files(spark, path)
    kinds = looked.groupBy("header", "broken").agg(F.count(F.lit(1)).alias("n")).collect()
    if len(kinds) < 2 and (multiline or not any(k.broken for k in kinds)):
        return load(path)
    # Files that differ are read in groups, each as a list of its files.
    frames = []
    files = F.sort_array(F.collect_list("path")).alias("files")
    groups = looked.withColumn("open_header", leaves_open(F.col("header")))
    groups = groups.groupBy("header", "open_header", "broken").agg(files)
    for kind in groups.orderBy("header", "broken").collect():
        if multiline or not kind.broken:
            frames.append(load(kind.files))
            continue
        headers = {kind.header: kind.files}
        if kind.open_header:
            first = csv_records(spark, kind.files).filter(first_of_file())
            first = first.groupBy("value").agg(files)
            headers = {r.value: r.files for r in first.orderBy("value").collect()}
        frames += [read_quoted_csv(spark, f, h, malformed, position) for h, f in headers.items()]
    df = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    last = [c for c in (malformed, position) if c is not None]
    return df.select(*[f"`{c}`" for c in df.columns if c not in last], *last)


def _csv_files(spark: SparkSession, path: str) -> DataFrame:
    """``path, header, broken`` of every file: its first line, and whether some line of it
    leaves a quoted field open. One scan; a file is one row from then on."""
    at_start = F.when(F.col("start") == 0, F.col("at"))
    return (
        pieces(spark, path, "\n")
        .groupBy("path")
        .agg(
            F.substring_index(F.min_by("value", at_start), "\r", 1).alias("header"),
            F.max(leaves_open(F.col("value"))).alias("broken"),
        )
    )


JsonLayout = Literal["document", "lines"]


def read_json(
    spark: SparkSession, path: str, lines: bool = False, layout: JsonLayout | None = None
) -> DataFrame:
    """``document``: each file is an array of objects or one object. ``lines``: one per line.

    The columns are the union of all keys. Documents larger than a split are cut at their
    objects by many tasks and read from a working copy. A file of lines is refused as a
    document, since only its first line would be read.
    """
    lines = lines if layout is None else layout == "lines"
    if lines:
        return spark.read.json(path)
    sizes = spark.read.format("binaryFile").load(path).agg(F.max("length").alias("largest"))
    largest = sizes.first().largest or 0
    if largest > _bytes(spark, "spark.sql.files.maxPartitionBytes"):
        return _read_large_documents(spark, path)
    _require_documents(spark, path)
    return spark.read.option("multiLine", True).json(path)


def _bytes(spark: SparkSession, conf: str) -> int:
    return spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(conf))


def _read_large_documents(spark: SparkSession, path: str) -> DataFrame:
    """Objects of documents, from a working copy with one object per line.

    White space outside strings may be any; JSON strings hold no line breaks.
    """
    copy = workspace(spark, "json-objects")
    objects = json_elements(spark, path)
    together = Observation()
    objects.observe(together, F.count_if(~F.col("apart")).alias("n")).select(
        F.regexp_replace("value", r"[\r\n]+", " ")
    ).write.text(copy)
    if together.get["n"] > 0:
        raise ValueError(f"{path} holds one object per line; read it as lines")
    return spark.read.json(copy)


def _require_documents(spark: SparkSession, path: str) -> None:
    text = spark.read.text(path, wholetext=True).select("value", "_metadata.file_path")
    parts = text.select("file_path", F.split(F.trim("value"), r"\s*\n\s*", 2).alias("part"))
    first, rest = F.col("part")[0], F.col("part")[1]
    # A document over several lines has a first line that is no value by itself.
    lined = parts.filter(
        (F.size("part") > 1) & rest.startswith("{") & F.try_parse_json(first).isNotNull()
    ).first()
    if lined is not None:
        raise ValueError(f"{lined.file_path} holds one object per line; read it as lines")


def write_json_lines(df: DataFrame, path: str, compression: str = "none") -> None:
    """One JSON object per row and line; NULL fields are written."""
    df.write.option("ignoreNullFields", False).option("compression", compression).json(path)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_source(
    spark: SparkSession,
    path: str,
    multiline: bool = False,
    json_layout: JsonLayout = "document",
) -> DataFrame:
    """Choose the reader by the lower-cased suffix: .csv, .json, .jsonl, .ndjson, .parquet.

    ``multiline``: as in ``read_csv``. ``json_layout``: how .json is laid out.
    """
    suffix = PurePosixPath(path.rstrip("/")).suffix.lower()
    if suffix == ".csv":
        return read_csv(spark, path, multiline)
    if suffix == ".json":
        return read_json(spark, path, layout=json_layout)
    if suffix in (".jsonl", ".ndjson"):
        return read_json(spark, path, layout="lines")
    if suffix == ".parquet":
        return read_parquet(spark, path)
    raise ValueError(f"Unsupported file format: {suffix}")


def require_columns(
    df: DataFrame,
    source_name: str,
    expected: Sequence[str] | None = None,
    with_rows: bool = True,
) -> DataFrame:
    """Raise when declared columns are missing or there is no row; extra columns pass.

    Without ``with_rows`` the rows are not looked at.
    """
    wanted = EXPECTED_COLUMNS.get(source_name, []) if expected is None else expected
    missing = sorted(set(wanted) - set(df.columns))
    if missing:
        raise ValueError(f"{source_name}: missing columns {missing} among {df.columns}")
    if with_rows and df.isEmpty():
        raise ValueError(f"No data rows found in {source_name}")
    return df
