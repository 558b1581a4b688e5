"""Mix sources to target weights by Pareto order sampling; DataFrame operations only.

1. Targets: sources share the total of all sizes by weight. No target may exceed
   ``most_copies`` times its source's size; the excess is shared again by weight. With sources
   ordered by size over weight, the level of this water filling is the largest of the levels
   that follow when the first 0, 1, 2, ... sources are full.
2. A document is expected as often as its wish (``weight_col``) says relative to the others of
   its source, ``most_copies`` times at most, so that the expected sizes add up to the
   source's target: the factor on the wishes is found by filling again, over levels of the
   wish (``_LEVELS`` per octave). The whole part of the expectation is certain. The rest is an
   inclusion probability p: documents are ranked by the odds of a random number over the
   odds of p, and in that order taken once more until the source's target is reached to the
   nearest document.
3. The rank is never sorted as a whole: sizes are summed per source and slice of the rank,
   the slice in which a source's target falls is found, and only that slice is ordered. There
   are so many slices that one has about ``EDGE_ROWS`` documents of the largest source.
4. Places and running sums over all sources come from ranges of sources: sums within each
   range, and one row per range to add up.

The random number is a hash of seed and id, so reruns agree. Null text or id are allowed; a
null source is a source of its own, behind all others. Rows that repeat share their random
number; ties are ordered by id and size. A source without words has target 0. An empty table
gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.shared import staged
from millrace.session import workspace

MOST_COPIES = 3
SLICES, EDGE_ROWS = 4096, 100_000
SEED = 7
_LEVELS = 16
_WORDS = r"[^\x20\x09-\x0D]+"


def cyclic_weights(*weights: int) -> Column:
    """Weights that repeat over the sources in the order of their code points, null last."""
    return F.element_at(
        F.array(*map(F.lit, weights)), (F.pmod(F.col("place") - 1, F.lit(len(weights))) + 1).cast("int")
    )


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text.cast("string"), F.lit(_WORDS)), F.lit(0)).cast("long")


def mix(
    docs: DataFrame,
    weight: Column,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    most_copies: int = MOST_COPIES,
    seed: int = SEED,
    weight_col: str | None = None,
    slices: int = SLICES,
) -> DataFrame:
    """Every row's ``id_col``, ``size``, ``source_size``, ``target``, ``taken`` and ``copies``.

    ``weight``: a column of the source's weight, from ``source`` and ``place`` (its place in
    the order of sources, from 1). ``weight_col``: how often a document is wanted relative
    to the others of its source (more than 0; null counts as 1).
    """
    spark = docs.sparkSession
    likes = F.lit(1.0) if weight_col is None else F.coalesce(F.col(f"`{weight_col}`").cast("double"), F.lit(1.0))
    digits = F.substring(F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(f"`{id_col}`").cast("string"))), 1, 13)
    sized = staged(
        docs.select(
            F.col(f"`{id_col}`").alias("id"),
            F.col(f"`{source_col}`").cast("string").alias("source"),
            word_count(F.col(f"`{text_col}`")).alias("size"),
            likes.alias("likes"),
            ((F.conv(digits, 16, 10).cast("double") + 0.5) / F.lit(float(16**13))).alias("random"),
        ),
        workspace(spark, "mixing-sizes"),
    )
    per_source = staged(
        sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("rows")),
        workspace(spark, "mixing-totals"),
    )
    largest = per_source.agg(F.max("rows")).first()[0] or 0
    slices = max(slices, -(-largest // EDGE_ROWS))
    targets = staged(_targets(per_source.drop("rows"), weight, most_copies), workspace(spark, "mixing-targets"))
    sources = staged(_factors(sized, targets, most_copies), workspace(spark, "mixing-sources"))
    joined = sized.withColumnRenamed("source", "own").join(
        sources, F.col("own").eqNullSafe(F.col("source"))
    ).drop("own")
    # Expected copies, certain copies, and the odds of one copy more.
    wanted = F.least(F.col("factor") * F.col("likes"), F.lit(float(most_copies)))
    expected = joined.withColumn("wanted", wanted)
    certain = F.floor("wanted")
    p = F.col("wanted") - F.col("certain")
    ratio = (F.col("random") / (1 - F.col("random"))) / (p / (1 - p))
    # ratio / (1 + ratio) keeps the order and lies between 0 and 1.
    ranked = expected.withColumn("certain", certain).withColumn(
        "rank", F.when(p > 0, ratio / (1 + ratio)).otherwise(1.0)
    ).withColumn("open", (F.col("certain") < most_copies) & (F.col("size") > 0)).withColumn(
        "slice", F.when(F.col("open"), F.least(F.floor(F.col("rank") * slices), F.lit(slices - 1)))
    )
    per_slice = ranked.groupBy("source", "slice").agg(
        F.sum("size").alias("slice_size"),
        F.sum(F.col("size") * F.col("certain")).alias("certain_size"),
        F.first("target").alias("target"),
    )
    whole_source = Window.partitionBy("source")
    in_order = whole_source.orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    slices_left = (
        per_slice.withColumn("left", F.col("target") - F.sum("certain_size").over(whole_source))
        .filter("slice is not null")
        .withColumn("ahead", F.coalesce(F.sum("slice_size").over(in_order), F.lit(0)))
    )
    # The slice in which the rest of the target falls; earlier ones are taken whole.
    edges = slices_left.filter("left > ahead").groupBy("source").agg(
        F.max(F.struct("slice", "ahead", "left")).alias("edge")
    )
    edges = edges.select(F.col("source").alias("edge_source"), "edge.*")
    edges = staged(edges.withColumnRenamed("slice", "edge_slice"), workspace(spark, "mixing-edges"))
    placed = ranked.join(edges, F.col("source").eqNullSafe(F.col("edge_source")), "left")
    at_edge = F.col("slice") == F.col("edge_slice")
    ordered = Window.partitionBy("source").orderBy("rank", "id", "size")
    edge_rows = placed.filter(at_edge).withColumn(
        "half_way",
        F.col("ahead")
        + F.sum("size").over(ordered.rowsBetween(Window.unboundedPreceding, 0))
        - F.col("size") / 2,
    )
    edge_rows = edge_rows.withColumn("more", (F.col("half_way") <= F.col("left")).cast("long")).drop("half_way")
    rest = placed.filter(~F.coalesce(at_edge, F.lit(False))).withColumn(
        "more", F.coalesce(F.col("slice") < F.col("edge_slice"), F.lit(False)).cast("long")
    )
    copies = F.col("certain") + F.col("more")
    return rest.unionByName(edge_rows).select(
        F.col("id").alias(id_col),
        "size",
        "source_size",
        "target",
        (F.col("size") * copies).alias("taken"),
        copies.alias("copies"),
    )


def _factors(sized: DataFrame, targets: DataFrame, most_copies: int) -> DataFrame:
    """``targets`` with ``factor``: documents are expected ``factor`` times their wish.

    With the highest levels of the wish full, the rest shares what is left; the factor is the
    largest of those that follow when none, one, two, ... levels are full.
    """
    level = F.floor(F.log2("likes") * _LEVELS)
    per_level = sized.groupBy("source", level.alias("level")).agg(
        F.sum("size").alias("level_size"), F.sum(F.col("size") * F.col("likes")).alias("liked")
    )
    higher = Window.partitionBy("source").orderBy(F.col("level").desc()).rowsBetween(Window.unboundedPreceding, -1)
    left = Window.partitionBy("source").orderBy("level").rowsBetween(Window.unboundedPreceding, 0)
    shared = (
        per_level.withColumn("full", F.coalesce(F.sum("level_size").over(higher), F.lit(0)) * float(most_copies))
        .withColumn("open", F.sum("liked").over(left))
        .withColumnRenamed("source", "own")
        .join(targets, F.col("own").eqNullSafe(F.col("source")))
    )
    factor = F.when(F.col("open") > 0, (F.col("target") - F.col("full")) / F.col("open"))
    return shared.groupBy("source", "source_size", "target").agg(
        F.greatest(F.coalesce(F.max(factor), F.lit(0.0)), F.lit(0.0)).alias("factor")
    )


def _running(rows: DataFrame, order: list[Column], names: list[str]) -> DataFrame:
    """``rows`` with the sums of the named columns over all rows before, as ``<name>_before``.

    Rows are dealt into ranges of the order. Running sums are taken within each range; of the
    ranges there is one row each, and only these are added up in one task.
    """
    spark = rows.sparkSession
    ranged = staged(
        rows.repartitionByRange(*order).withColumn("range", F.spark_partition_id()),
        workspace(spark, "mixing-ranges"),
    )
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    sums = ranged.groupBy("range").agg(*[F.sum(n).alias(n) for n in names])
    offsets = sums.select(
        "range", *[F.coalesce(F.sum(n).over(before), F.lit(0)).alias(f"{n}_offset") for n in names]
    )
    within = Window.partitionBy("range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    summed = ranged.join(offsets, "range")
    for n in names:
        own = F.coalesce(F.sum(n).over(within), F.lit(0)) + F.col(f"{n}_offset")
        summed = summed.withColumn(f"{n}_before", own)
    return summed.drop("range", *[f"{n}_offset" for n in names])


def _targets(sources: DataFrame, weight: Column, most_copies: int) -> DataFrame:
    """``target`` of every source."""
    by_name = [F.col("source").asc_nulls_last()]
    placed = _running(sources.withColumn("one", F.lit(1)), by_name, ["one"])
    weighed = placed.withColumn("place", F.col("one_before") + 1).withColumn("weight", weight.cast("double"))
    weighed = weighed.withColumn("full", (F.col("source_size") * most_copies).cast("double"))
    filled = staged(
        _running(weighed, [F.col("full") / F.col("weight"), F.col("place")], ["full", "weight"]),
        workspace(sources.sparkSession, "mixing-levels"),
    )
    whole = filled.agg(F.sum("source_size").alias("size"), F.sum("weight").alias("weight")).first()
    if whole["size"] is None:
        return filled.select("source", "source_size", F.lit(0.0).alias("target"))
    level = (F.lit(whole["size"]) - F.col("full_before")) / (F.lit(whole["weight"]) - F.col("weight_before"))
    highest = filled.agg(F.max(level)).first()[0]
    return filled.select(
        "source", "source_size", F.least(F.col("full"), F.lit(highest) * F.col("weight")).alias("target")
    )
