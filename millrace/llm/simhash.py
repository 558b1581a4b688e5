"""SimHash near-duplicates by tiled exact comparison.

1. Fingerprints: of every four-word shingle, repeats included, the XXH64; a bit is set if
   more than half of the hashes have it.
2. Different fingerprints are few against documents (copies share theirs). They are blocked
   by population count, 65 values, and within one count by hash into blocks of at most about
   ``block_rows``. Two fingerprints within the radius differ by at most the radius in their
   counts, so only blocks of such counts meet; every pair of them meets in one task.
3. A task compares its two blocks tile by tile: exclusive-or and bit counts over numpy
   arrays. Tiles are sorted by the population counts of their four 16-bit quarters; a tile
   pair is skipped when the ranges of these counts are further apart than the radius.
4. A task joins what it links into trees and returns one link per fingerprint to the root
   of its tree, never all pairs. Spark joins the trees into components.

The comparison is exact: no link is missed. Its work grows with the square of the number of
different fingerprints, divided by what the counts exclude.

Words are runs of characters other than space and U+0009 to U+000D, A-Z lowered. A text of
fewer than four words has one shingle; one without words has fingerprint zero, linked like
any other. Null counts as empty. Rows that repeat give repeated result rows; a null id never
names a component unless all its documents have none. Only the named columns are read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.components import connected
from millrace.llm.shared import Batches, map_batches, on_keyed_group, out_batch, ship, staged, utf8
from millrace.operators.joins import join_splittable
from millrace.session import workspace

RADIUS = 4
SHINGLE = 4
SEED = 42
BLOCK_ROWS = 131_072
_TILE = 512
#: Hashes turned into bits at a time.
_HASHES = 65_536


def fingerprint(text: bytes, width: int = SHINGLE, seed: int = SEED) -> int:
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    if len(words) > width:
        starts, ends = starts[: 1 - width], ends[width - 1 :]
    else:
        starts, ends = starts[:1], ends[-1:]
    ones, hash_of = np.zeros(64, dtype=np.int64), xxhash.xxh64_intdigest
    for at in range(0, len(starts), _HASHES):
        spans = zip(starts[at : at + _HASHES].tolist(), ends[at : at + _HASHES].tolist())
        hashes = np.array([hash_of(joined[a:b], seed) for a, b in spans], dtype="<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(starts), bitorder="little").view("<u8")[0])


def _fingerprints(batches: Batches) -> Batches:
    for batch in batches:
        prints = [fingerprint(t) for t in batch.column("text").to_pylist()]
        signed = np.array(prints, dtype=np.uint64).view(np.int64)
        schema = pa.schema([("id", batch.column("id").type), ("print", pa.int64())])
        yield out_batch(schema, batch.column("id"), pa.array(signed))


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    radius: int = RADIUS,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Every row's ``id_col``, ``fingerprint`` (16 hex digits) and ``component_id``."""
    spark = docs.sparkSession
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), utf8(text_col).alias("text"))
    id_type = rows.schema["id"].dataType.simpleString()
    printed = staged(
        map_batches(rows, _fingerprints, f"id {id_type}, print long"),
        workspace(spark, "simhash-prints"),
    )
    different = staged(
        printed.groupBy("print").agg(F.min("id").alias("least")),
        workspace(spark, "simhash-different"),
    )
    links = staged(_links(different, radius, block_rows), workspace(spark, "simhash-links"))
    labels = connected(links)
    labelled = different.join(labels.withColumnRenamed("node", "print"), "print", "left").select(
        "print", F.coalesce("label", "print").alias("label"), "least"
    )
    named = labelled.groupBy("label").agg(F.min("least").alias("component_id"))
    of_print = labelled.drop("least").join(named, "label").drop("label")
    return join_splittable(printed, of_print, "print", "inner").select(
        F.col("id").alias(id_col),
        F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"),
        "component_id",
    )


def _links(different: DataFrame, radius: int, block_rows: int) -> DataFrame:
    """``u``, ``v``: each linked fingerprint with the root of its tree, per pair of blocks."""
    ship(different.sparkSession)
    counted = different.select("print", F.bit_count("print").cast("int").alias("ones"))
    sizes = {r["ones"]: r["n"] for r in counted.groupBy("ones").agg(F.count("*").alias("n")).collect()}
    blocks = [max(1, -(-sizes.get(k, 0) // block_rows)) for k in range(65)]
    n_blocks = F.array(*map(F.lit, blocks))
    blocked = (
        counted.withColumn("of_ones", F.element_at(n_blocks, F.col("ones") + 1))
        .withColumn("block", F.expr("cast(pmod(xxhash64(print), of_ones) as int)"))
        .groupBy("ones", "block")
        .applyInArrow(_pack, "ones int, block int, prints binary")
    )
    # A block meets itself, and every later block up to ``radius`` counts ahead.
    ahead = F.flatten(
        F.transform(
            F.sequence("ones", F.least(F.col("ones") + radius, F.lit(64))),
            lambda k: F.transform(
                F.sequence(F.lit(0), F.element_at(n_blocks, k + 1) - 1),
                lambda b: F.struct(
                    F.col("ones").alias("a"), F.col("block").alias("b"), k.alias("c"), b.alias("d")
                ),
            ),
        )
    )
    behind = F.flatten(
        F.transform(
            F.sequence(F.greatest(F.col("ones") - radius, F.lit(0)), "ones"),
            lambda k: F.transform(
                F.sequence(F.lit(0), F.element_at(n_blocks, k + 1) - 1),
                lambda b: F.struct(
                    k.alias("a"), b.alias("b"), F.col("ones").alias("c"), F.col("block").alias("d")
                ),
            ),
        )
    )
    left = blocked.select("prints", F.explode(ahead).alias("cell"), F.lit(0).alias("side")).filter(
        "cell.a < cell.c or cell.b <= cell.d"
    )
    right = blocked.select("prints", F.explode(behind).alias("cell"), F.lit(1).alias("side")).filter(
        "cell.a < cell.c or cell.b < cell.d"
    )
    return (
        left.unionByName(right)
        .select("cell.*", "side", "prints")
        .groupBy("a", "b", "c", "d")
        .applyInArrow(on_keyed_group(_compare, radius), "u long, v long")
    )


def _pack(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
    prints = np.sort(rows.column("print").to_numpy().view(np.uint64)).tobytes()
    schema = pa.schema([("ones", pa.int32()), ("block", pa.int32()), ("prints", pa.binary())])
    return pa.Table.from_batches(
        [out_batch(schema, [key[0].as_py()], [key[1].as_py()], [prints])]
    )


def _quarters(prints: np.ndarray) -> np.ndarray:
    """Population counts of the four 16-bit quarters."""
    return np.bitwise_count(prints.view(np.uint16).reshape(-1, 4)).astype(np.int16)


def _tiles(prints: np.ndarray):
    """Prints sorted by the counts of their quarters, with each tile's least and largest."""
    quarters = _quarters(prints)
    order = np.lexsort(quarters.T[::-1])
    prints, quarters = prints[order], quarters[order]
    starts = np.arange(0, len(prints), _TILE)
    return prints, starts, np.minimum.reduceat(quarters, starts), np.maximum.reduceat(quarters, starts)


def _root(parent: np.ndarray, at: np.ndarray) -> np.ndarray:
    while True:
        up = parent[at]
        if (up == at).all():
            return at
        parent[at] = parent[up]
        at = parent[at]


def _compare(radius: int, key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
    sides = {r["side"]: np.frombuffer(r["prints"], dtype=np.uint64) for r in rows.to_pylist()}
    itself = 1 not in sides and key[0].as_py() == key[2].as_py() and key[1].as_py() == key[3].as_py()
    empty = np.zeros(0, dtype=np.uint64)
    a = sides.get(0, empty)
    b = a if itself else sides.get(1, empty)
    schema = pa.schema([("u", pa.int64()), ("v", pa.int64())])
    if not len(a) or not len(b):
        return schema.empty_table()
    a, starts_a, low_a, high_a = _tiles(a)
    b, starts_b, low_b, high_b = (a, starts_a, low_a, high_a) if itself else _tiles(b)
    prints = a if itself else np.concatenate([a, b])
    shift = 0 if itself else len(a)
    parent = np.arange(len(prints))
    for i, start in enumerate(starts_a):
        gap = np.maximum(0, np.maximum(low_a[i] - high_b, low_b - high_a[i])).sum(axis=1)
        near = np.flatnonzero(gap <= radius)
        part = a[start : start + _TILE, None]
        for j in near[near >= i] if itself else near:
            other = starts_b[j]
            close = np.bitwise_count(part ^ b[None, other : other + _TILE]) <= radius
            if not close.any():
                continue
            x, y = np.nonzero(close)
            x, y = x + start, y + other + shift
            while len(x):
                x, y = _root(parent, x), _root(parent, y)
                apart = x != y
                x, y = x[apart], y[apart]
                # Of the links to one root the smallest wins; the others come round again.
                np.minimum.at(parent, np.maximum(x, y), np.minimum(x, y))
    roots = _root(parent, np.arange(len(prints)))
    linked = np.flatnonzero(roots != np.arange(len(prints)))
    return pa.Table.from_arrays(
        [pa.array(prints[linked].view(np.int64)), pa.array(prints[roots[linked]].view(np.int64))],
        schema=schema,
    )
