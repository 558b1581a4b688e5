"""Records that cross line or split boundaries, put together by any number of tasks.

Spark cuts a file into splits and a split into pieces at a separator. Whether a piece begins
inside a quoted field or string is only known from all the pieces before it. But what a piece
does to that state is a function of two values, functions are composed in any grouping, and so
the state before every piece comes from a scan within each split and one over the splits, of
which there is one row each. No task needs a whole file.
"""

from __future__ import annotations

import csv
import io
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, WindowSpec
from pyspark.sql import functions as F

_SPLIT = ("path", "start")
#: A quoted CSV field and what a line that starts within one has of it.
_FIELD = r'(^|,)"(?:[^"]++|"")*+"'
_REST_OF_FIELD = r'^(?:[^"]++|"")*+"[^,]*+'


def _in_split() -> WindowSpec:
    return Window.partitionBy(*_SPLIT).orderBy("at")


def _in_file() -> WindowSpec:
    return Window.partitionBy("path").orderBy("start")


def pieces(spark: SparkSession, path: str | Sequence[str], separator: str) -> DataFrame:
    """``path, start, at, value``: the pieces of every file; ``at`` orders those of a split."""
    return (
        spark.read.option("lineSep", separator)
        .text(path)
        .select(
            F.col("_metadata.file_path").alias("path"),
            F.col("_metadata.file_block_start").alias("start"),
            F.monotonically_increasing_id().alias("at"),
            "value",
        )
    )


def _before(df: DataFrame, window: WindowSpec, first: int, name: str) -> DataFrame:
    """Add the state before each row if it is ``first`` before the window's first row.

    ``from0`` and ``from1`` are the states after the row for either state before it. After a row
    with the same outcome for both, earlier rows do not matter; the others keep or swap.
    """
    swap = ((F.col("from0") == 1) & (F.col("from1") == 0)).cast("int")
    settles = F.col("from0") == F.col("from1")
    earlier = window.rowsBetween(Window.unboundedPreceding, -1)
    swapped = df.withColumn("_swaps", F.sum(swap).over(window))
    last = F.last(F.when(settles, F.struct("from0", "_swaps")), ignorenulls=True).over(earlier)
    known = swapped.withColumn("_last", last).withColumn("_passed", F.col("_swaps") - swap)
    state = F.coalesce(F.col("_last.from0"), F.lit(first)) + F.col("_passed")
    state = state - F.coalesce(F.col("_last._swaps"), F.lit(0))
    return known.withColumn(name, F.pmod(state, F.lit(2))).drop("_swaps", "_last", "_passed")


def _after(before: str) -> Column:
    return F.when(F.col(before) == 0, F.col("from0")).otherwise(F.col("from1"))


def _with_state(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Pieces with ``if0`` and ``if1``, the state before them for either state before their
    split, and the splits with ``state``, the state before the split."""
    both = _before(_before(rows, _in_split(), 0, "if0"), _in_split(), 1, "if1")
    splits = both.groupBy(*_SPLIT).agg(
        F.max_by(_after("if0"), "at").alias("from0"), F.max_by(_after("if1"), "at").alias("from1")
    )
    return both, _before(splits, _in_file(), 0, "state").select(*_SPLIT, "state")


def _assemble(rows: DataFrame, joint: str) -> DataFrame:
    """``path, start, no, value``: records from pieces with flags ``opens`` and ``closes``.

    A piece that both opens and closes a record is one. Only the pieces of other records are
    shuffled again, to be joined where the record opened. ``start`` and ``no`` are the split
    in which a record opens and its number there, from 1: the order of a file's records.
    """
    whole = F.col("opens") & F.col("closes")
    counted = rows.withColumn("_no", F.sum(F.col("opens").cast("int")).over(_in_split()))
    # Pieces before the first opening of a split go with the last opening before the split.
    openings = counted.groupBy(*_SPLIT).agg(F.max("_no").alias("_n"))
    earlier = _in_file().rowsBetween(Window.unboundedPreceding, -1)
    held = F.when(F.col("_n") > 0, F.struct(F.col("start").alias("_start"), F.col("_n").alias("_no")))
    carried = openings.withColumn("_carried", F.last(held, ignorenulls=True).over(earlier))
    own = F.struct(F.col("start").alias("_start"), F.col("_no"))
    open_ = counted.filter(~whole).join(carried.drop("_n"), list(_SPLIT))
    joined = (
        open_.withColumn("_key", F.when(F.col("_no") > 0, own).otherwise(F.col("_carried")))
        .groupBy("path", "_key")
        .agg(F.sort_array(F.collect_list(F.struct("start", "at", "value"))).alias("_parts"))
        .select(
            "path",
            F.col("_key._start").alias("start"),
            F.col("_key._no").alias("no"),
            F.array_join(F.transform("_parts", lambda p: p["value"]), joint).alias("value"),
        )
    )
    alone = counted.filter(whole).select("path", "start", F.col("_no").alias("no"), "value")
    return alone.unionByName(joined)


def first_of_file() -> Column:
    return (F.col("start") == 0) & (F.col("no") == 1)


# --- CSV ---------------------------------------------------------------------------------


def leaves_open(value: Column) -> Column:
    """Whether a line that starts a record ends inside a quoted field.

    A quotation mark counts where a field begins, and within a quoted field.
    """
    closed = F.regexp_replace(value, _FIELD, "$1")
    return F.when(value.contains('"'), closed.rlike('(^|,)"')).otherwise(F.lit(False))


def csv_records(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """``path, first, value``: the records of CSV files, line breaks in quotes included.

    ``first`` marks the headers. ``\\r\\n`` counts as ``\\n``. A quotation mark that is never
    closed makes the rest of its file one record.
    """
    value = F.col("value")
    closes = value.contains('"') & value.rlike(_REST_OF_FIELD)
    rest = F.regexp_replace(value, _REST_OF_FIELD, "")
    lines = pieces(spark, path, "\n").withColumns(
        {
            "from0": leaves_open(value).cast("int"),
            "from1": F.when(closes, leaves_open(rest).cast("int")).otherwise(F.lit(1)),
        }
    )
    both, splits = _with_state(lines)
    known = both.join(splits, list(_SPLIT)).withColumn(
        "before", F.when(F.col("state") == 0, F.col("if0")).otherwise(F.col("if1"))
    )
    flagged = known.select(
        *_SPLIT,
        "at",
        "value",
        (F.col("before") == 0).alias("opens"),
        (_after("before") == 0).alias("closes"),
    )
    return _assemble(flagged, "\n").withColumn(
        "value", F.regexp_replace(F.regexp_replace("value", "\r\n", "\n"), "\r$", "")
    )


def read_quoted_csv(
    spark: SparkSession,
    path: str | Sequence[str],
    header: str,
    malformed: str | None = None,
    position: str | None = None,
) -> DataFrame:
    """Files with one header whose quoted fields hold line breaks, all columns as text."""
    names = _column_names(header)
    columns = [f"`{n.replace('`', '``')}` string" for n in [*names, *([malformed] if malformed else [])]]
    options = {"escape": '"', "multiLine": "true"}
    if malformed:
        options["columnNameOfCorruptRecord"] = malformed
    rows = (
        csv_records(spark, path)
        .filter(~first_of_file() & (F.trim("value") != ""))
        .select(
            F.from_csv("value", ", ".join(columns), options).alias("row"),
            F.struct(F.col("path").alias("file"), "start", F.col("no").alias("row")).alias("place"),
        )
    )
    place = [F.col("place").alias(position)] if position else []
    return rows.select("row.*", *place)


def _column_names(header: str) -> list[str]:
    """Names as Spark's reader makes them: none gives the position, repeated ones are numbered."""
    names = next(csv.reader(io.StringIO(header.removesuffix("\r"), newline="")), [])
    folded = [n.lower() for n in names]
    return [
        f"_c{i}" if n == "" else f"{n}{i}" if folded.count(n.lower()) > 1 else n
        for i, n in enumerate(names)
    ]


# --- JSON --------------------------------------------------------------------------------


def json_elements(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """``path, value, apart``: the objects of files that are one array of objects or one object.

    Pieces end at closing braces. Strings are told from the rest by the parity of quotation
    marks that are not escaped, and objects within objects by counting braces outside strings.
    ``apart`` is false for an object that follows another one without a comma.
    """
    real = F.regexp_replace("value", r"(?s)\\.", "")
    quotes = F.length(real) - F.length(F.replace(real, F.lit('"')))
    cut = pieces(spark, path, "}").withColumns(
        {
            "_real": real,
            "from0": (quotes % 2).cast("int"),
            "from1": (1 - quotes % 2).cast("int"),
        }
    )
    both, splits = _with_state(cut)

    def braces(before: str) -> Column:
        """Opened minus closed by the piece and the brace that ends it."""
        outside = F.when(F.col(before) == 0, F.col("_real")).otherwise(
            F.regexp_replace("_real", '^[^"]*+("|$)', "")
        )
        outside = F.regexp_replace(outside, '"[^"]*+("|$)', "")
        opened = F.length(outside) - F.length(F.replace(outside, F.lit("{")))
        return opened - (_after(before) == 0).cast("int")

    deep = both.withColumns({"_d0": braces("if0"), "_d1": braces("if1")}).withColumns(
        {"_d0": F.sum("_d0").over(_in_split()), "_own0": F.col("_d0"), "_d1": F.sum("_d1").over(_in_split()), "_own1": F.col("_d1")}
    )
    totals = deep.groupBy(*_SPLIT).agg(
        F.max_by("_d0", "at").alias("_t0"), F.max_by("_d1", "at").alias("_t1")
    )
    earlier = _in_file().rowsBetween(Window.unboundedPreceding, -1)
    own = F.when(F.col("state") == 0, F.col("_t0")).otherwise(F.col("_t1"))
    bases = totals.join(splits, list(_SPLIT)).withColumn("_own", own)
    bases = bases.withColumn("_base", F.coalesce(F.sum("_own").over(earlier), F.lit(0)))
    known = deep.join(bases.select(*_SPLIT, "state", "_base"), list(_SPLIT))

    def of_state(name: str) -> Column:
        return F.when(F.col("state") == 0, F.col(f"{name}0")).otherwise(F.col(f"{name}1"))

    depth = F.col("_base") + of_state("_d")
    flagged = known.withColumns({"before": of_state("if"), "_depth": depth, "_piece": of_state("_own")}).select(
        *_SPLIT,
        "at",
        "value",
        ((F.col("before") == 0) & (F.col("_depth") == F.col("_piece"))).alias("opens"),
        ((_after("before") == 0) & (F.col("_depth") == 0)).alias("closes"),
    )
    # What follows the last object opens a record as well, and holds no brace.
    found = _assemble(flagged, "}").filter(F.col("value").contains("{"))
    return found.select(
        "path",
        F.concat(F.regexp_replace("value", r"^[\s,\[]++", ""), F.lit("}")).alias("value"),
        (first_of_file() | F.col("value").rlike(r"^\s*+,")).alias("apart"),
    )
