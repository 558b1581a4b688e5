"""From raw documents to packed training sequences, in five stages.

Each stage takes ``(spark, docs, sf_dir)`` and returns a frame that is written as Parquet and
read again as the next one's ``docs``. All but the last return the columns of ``docs``. Rows
are told apart by id and text, so ids may be null or repeat, and columns of any other name
may be present.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.exact_dedup import exact_groups
from millrace.llm.language_id import identify, primary_subtag, train_text_model
from millrace.llm.mixing import cyclic_weights, mix
from millrace.llm.packing import pack
from millrace.llm.shared import staged, table, utf8
from millrace.llm.simhash import near_duplicates
from millrace.operators.dedup import deduplicate
from millrace.operators.keyfilter import anti_join
from millrace.session import workspace

_ROW = "_millrace_row"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _row(text: Column) -> Column:
    """Id and text digest; inside a struct, null equals null."""
    return F.struct(F.col("doc_id"), F.sha2(F.coalesce(text, F.lit("")), 256).alias("digest"))


def _without(docs: DataFrame, row: Column, dropped: DataFrame, purpose: str) -> DataFrame:
    """``docs`` but for the rows in ``dropped``."""
    known = staged(dropped.distinct(), workspace(docs.sparkSession, purpose)).toDF(_ROW)
    return anti_join(docs.withColumn(_ROW, row), known, _ROW).select(docs.columns)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop texts without letters and those whose evidence speaks against itself.

    What cannot be determined stays: short texts, and all texts where none has a ``lang``.
    """
    unknown = F.lit(None).cast("string")
    rows = docs.select(
        _row(F.col("text")).alias("id"),
        utf8("text").alias("text"),
        primary_subtag(F.col("lang")).alias("declared"),
        unknown.alias("suffix"),
        F.col("source").alias("host"),
        unknown.alias("domain"),
    )
    found = identify(rows, train_text_model(docs))
    return _without(docs, _row(F.col("text")), found.filter("rejected").select("id"), "pipeline-language")


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts (A-Z lowered) the one with the largest id stays, once."""
    row = _row(F.translate("text", _UPPER, _LOWER))
    groups = staged(
        exact_groups(docs).select(F.struct("doc_id", F.col("text_sha256").alias("digest")).alias(_ROW), "kept"),
        workspace(spark, "pipeline-exact"),
    )
    kept = _without(docs, row, groups.filter("not kept").select(_ROW), "pipeline-exact-dropped")
    twice = groups.filter("kept").groupBy(_ROW).count().filter("count > 1").select(_ROW)
    if twice.isEmpty():
        return kept
    marked = kept.withColumn(_ROW, row)
    once = deduplicate(marked.join(twice, _ROW, "left_semi"), [_ROW], [], "first")
    return marked.join(twice, _ROW, "left_anti").unionByName(once).select(docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document with the smallest id stays."""
    row = _row(F.col("text"))
    groups = near_duplicates(docs.select(row.alias(_ROW), "text"), id_col=_ROW)
    dropped = groups.filter(F.col(_ROW) != F.col("component_id")).select(_ROW)
    return _without(docs, row, dropped, "pipeline-near")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeat or leave out documents until every source has its share of words."""
    row = _row(F.col("text"))
    taken = mix(docs.select(row.alias(_ROW), "text", "source"), cyclic_weights(1, 2, 3), id_col=_ROW)
    per_row = staged(
        taken.groupBy(_ROW).agg(F.sum("copies").alias("_millrace_copies"), F.count("*").alias("_millrace_rows")),
        workspace(spark, "pipeline-mix"),
    )
    marked = docs.withColumn(_ROW, row)
    if not per_row.filter("_millrace_rows > 1").isEmpty():
        marked = deduplicate(marked, [_ROW], [], "first")
    chosen = per_row.filter("_millrace_copies > 0").select(_ROW, "_millrace_copies")
    return (
        marked.join(chosen, _ROW)
        .withColumn("_millrace_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_millrace_copies"))))
        .select(docs.columns)
    )


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Tokenize and pack into sequences of 4096 tokens."""
    return pack(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=2)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language_id),
    ("exact_dedup", exact_dedup),
    ("simhash_near_dedup", near_dedup),
    ("mix_sources", mix_sources),
    ("pack", pack_sequences),
]

#: Tokenizing and language models are beyond SQL; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), workspace(spark, f"pipeline-{name}"))
    return STAGES[-1][1](spark, docs, sf_dir)
