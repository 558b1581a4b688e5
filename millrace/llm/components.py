"""Connected components of a graph that no machine needs to hold.

Alternating star steps (Kiveris et al., Connected Components in MapReduce and Beyond, 2014):
in a large-star step every node points its larger neighbours at its smallest one, in a
small-star step its smaller neighbours and itself. Both keep components and drive them into
stars around their smallest node. Every round is written to shared storage, so lost executors
repeat one round at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.shared import staged
from millrace.operators.joins import join_splittable
from millrace.session import release, workspace


def connected(links: DataFrame) -> DataFrame:
    """``node``, ``label`` of every node that has a link; the label is the smallest node.

    ``links``: columns ``u`` and ``v`` of type long, each link in either direction. Links of a
    node to itself and repeated links do not matter.
    """
    spark = links.sparkSession
    # From here on each link is (u, v) with u > v.
    down = links.filter("u <> v").select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")
    )
    path = workspace(spark, "components")
    stars = staged(down.distinct(), path)
    mark = _mark(stars)
    while mark[0]:
        both = stars.unionByName(stars.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _towards_least(both).filter("v > u").select(F.col("v").alias("u"), "least")
        large = large.select("u", F.col("least").alias("v")).filter("u <> v").distinct()
        small = _towards_least(large)
        small = small.filter("v <> least").select(F.col("v").alias("u"), F.col("least").alias("v"))
        own = large.groupBy("u").agg(F.min("v").alias("v"))
        after_path = workspace(spark, "components")
        after = staged(small.unionByName(own).distinct(), after_path)
        after_mark = _mark(after)
        release(spark, path)
        stars, path = after, after_path
        if after_mark == mark:
            break
        mark = after_mark
    centres = stars.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct()
    return stars.select(F.col("u").alias("node"), F.col("v").alias("label")).unionByName(centres)


def _towards_least(links: DataFrame) -> DataFrame:
    """Every link (u, v) with the smallest of u and its neighbours."""
    least = links.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("least"))
    return join_splittable(links, least, "u", "inner")


def _mark(links: DataFrame) -> tuple:
    """The same for the same set of links, whatever their order."""
    row = links.agg(
        F.count("*").alias("n"),
        F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("sum"),
        F.bit_xor(F.xxhash64("v", "u")).alias("mix"),
    ).first()
    return row["n"], row["sum"], row["mix"]
