"""Records out of landed API pages: one JSON document per row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators.joins import join_splittable
from millrace.session import workspace

# The keys that may hold the records of a page, in order of preference.
ENVELOPE_KEYS = ("data", "results", "items", "records")


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """One row per file: ``page`` (whole text) and ``page_no`` by file name order digits."""
    return spark.read.text(path, wholetext=True).select(
        F.col("value").alias("page"),
        F.regexp_extract(F.col("_metadata.file_name"), r"(\d+)[^\d]*$", 1)
        .try_cast("bigint")
        .alias("page_no"),
    )


def page_records(pages: DataFrame, page: str = "page") -> DataFrame:
    """Add ``_records``: the records of each page as an array of variants.

    A list is its items. An object is the first envelope key that holds a list, else
    the object itself is one record. Anything else, also broken JSON, is NULL.
    """
    doc = F.col("_doc")
    shape = F.schema_of_variant(doc)
    inner = [F.try_variant_get(doc, f"$.{k}", "array<variant>") for k in ENVELOPE_KEYS]
    records = F.when(
        shape.startswith("ARRAY"), F.try_variant_get(doc, "$", "array<variant>")
    ).when(shape.startswith("OBJECT"), F.coalesce(*inner, F.array(doc)))
    parsed = pages.withColumn("_doc", F.try_parse_json(F.col(page)))
    return parsed.withColumn("_records", records).drop("_doc")


def unwrap_pages(
    pages: DataFrame,
    endpoint: str | None = None,
    page_no: str | None = None,
    page: str = "page",
    page_size: int | None = None,
    endpoints: Sequence[str] | None = None,
) -> DataFrame:
    """One row per record, as variant column ``record``. All landed pages count.

    With ``page_size`` the pages of an endpoint end as a client would end them: after the
    first page with fewer records, before the first page without any. The ends are a small
    table, written first: where Spark can send it round by its size, the pages are not
    shuffled. ``endpoints`` keeps the listed ones.
    """
    if (endpoint is None) != (page_no is None):
        raise ValueError("endpoint and page_no go together")
    if page_size is not None and endpoint is None:
        raise ValueError("page_size needs the endpoint and page_no columns")
    keep = [] if endpoint is None else [endpoint, page_no]
    if endpoint is not None and endpoints is not None:
        pages = pages.filter(F.col(endpoint).isin(*endpoints))
    if page_size is not None:
        sizes = page_records(pages, page).select(
            *keep, F.coalesce(F.size("_records"), F.lit(0)).alias("_size")
        )
        path = workspace(pages.sparkSession, "page-ends")
        sizes.groupBy(endpoint).agg(
            F.min(F.when(F.col("_size") < page_size, F.col(page_no))).alias("_last")
        ).write.parquet(path)
        last = pages.sparkSession.read.parquet(path)
        pages = join_splittable(pages, last, endpoint, "inner").filter(
            F.col("_last").isNull() | (F.col(page_no) <= F.col("_last"))
        )
    found = page_records(pages, page)
    # explode would add a filter that parses every page a second time.
    records = found.select(*keep, F.explode_outer("_records").alias("record"))
    return records.filter(F.col("record").isNotNull())
