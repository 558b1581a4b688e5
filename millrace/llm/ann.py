"""Nearest neighbours by inner product, over randomly rotated one-bit codes.

After RaBitQ (Gao and Long, 2024). Every vector is taken relative to the nearest of a few
centres, rotated by a fixed random rotation and reduced to the signs of its components:
``dim`` bits and two numbers, the length of the rest and how well the signs match it. From
these a query estimates every inner product, with a bound on the error. Vectors whose upper
bound reaches the ``k``-th largest lower bound are compared exactly.

Centres are fitted on a bounded sample: the ``SAMPLE_FLOATS / dim`` vectors (``SAMPLE_ROWS``
at most) with the smallest hash of their id. Every vector is coded. Queries and vectors are
dealt into blocks, each pair of blocks is one task's work, and Spark merges the blocks'
results. The work is that of comparing all queries with all vectors, as the query set is a
share of the table.

Vectors that are null, zero, or hold a null or a component that is not finite take no part,
nor do those with a null id. Vectors are compared with those of the same number of components;
each such number is a search of its own. Rows that repeat an id are candidates and queries of
their own; a row is never its own candidate. Components keep their type, float or double, and
scores are sums of products in double precision. Ties go to the smaller id. Fewer than ``k``
candidates are all returned. An empty table gives an empty result. Only the named columns are
read.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.shared import Batches, map_batches, on_group, out_batch, ship, staged
from millrace.session import workspace

K = 20
CENTRES = 32
SAMPLE_ROWS, SAMPLE_FLOATS = 20_000, 4_000_000
#: Width of the error bound in standard deviations of the estimate.
CONFIDENCE = 2.5
DATA_ROWS, QUERY_ROWS = 16_384, 8_192
_QUERIES_AT_ONCE = 128
def usable(column: str) -> Column:
    return F.expr(
        f"""`{column}` is not null
            and forall(`{column}`, x -> x is not null and not isnan(x)
                                        and abs(x) < double('infinity'))
            and exists(`{column}`, x -> x <> 0)"""
    )


def nearest(
    vectors: DataFrame,
    is_query: Column,
    k: int = K,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    confidence: float = CONFIDENCE,
    data_rows: int = DATA_ROWS,
    query_rows: int = QUERY_ROWS,
) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id``, ``score``. ``is_query``: a condition on ``vec_id``."""
    spark = vectors.sparkSession
    element = vectors.schema[vector_col].dataType.elementType.simpleString()
    element = element if element == "float" else "double"
    kept = staged(
        vectors.filter(F.col(f"`{id_col}`").isNotNull())
        .select(
            F.col(f"`{id_col}`").cast("long").alias("vec_id"),
            F.col(f"`{vector_col}`").cast(f"array<{element}>").alias("vector"),
        )
        .filter(usable("vector"))
        .withColumn("row", F.monotonically_increasing_id()),
        workspace(spark, "ann-vectors"),
    )
    found = None
    for r in kept.groupBy(F.size("vector").alias("dim")).count().orderBy("dim").collect():
        of_dim = kept.filter(F.size("vector") == r["dim"])
        met = _met(of_dim, r["dim"], r["count"], element, is_query, k, confidence, data_rows, query_rows)
        found = met if found is None else found.unionByName(met)
    if found is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    best = Window.partitionBy("query_row").orderBy(F.col("score").desc(), "vec_id", "row")
    return (
        found.withColumn("rank", F.row_number().over(best))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def _met(
    kept: DataFrame,
    dim: int,
    count: int,
    element: str,
    is_query: Column,
    k: int,
    confidence: float,
    data_rows: int,
    query_rows: int,
) -> DataFrame:
    """The best vectors of one width for each query, per pair of blocks."""
    spark = kept.sparkSession
    centres = _fit_centres(kept, dim)
    schema = f"""row long, vec_id long, code binary, centre int, rest double, match double,
                 vector array<{element}>"""
    coded = staged(
        map_batches(kept, partial(_encode, centres), schema), workspace(spark, "ann-codes")
    )
    data_blocks = -(-count // data_rows)
    queries = coded.filter(is_query).select("row", "vec_id", "vector")
    query_blocks = max(1, -(-queries.count() // query_rows))
    # Every query block meets every data block, in a task of its own.
    data_side = coded.select(
        F.pmod(F.xxhash64("row"), F.lit(data_blocks)).alias("d"),
        F.explode(_numbers(query_blocks)).alias("q"),
        F.lit(False).alias("asks"),
        *coded.columns,
    )
    query_side = queries.select(
        F.explode(_numbers(data_blocks)).alias("d"),
        F.pmod(F.xxhash64("row"), F.lit(query_blocks)).alias("q"),
        F.lit(True).alias("asks"),
        "row",
        "vec_id",
        "vector",
    )
    ship(spark)
    return (
        data_side.unionByName(query_side, allowMissingColumns=True)
        .groupBy("d", "q")
        .applyInArrow(
            on_group(_search, centres, k, confidence),
            "query_row long, query_id long, row long, vec_id long, score double",
        )
    )


def _numbers(n: int) -> Column:
    return F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long"))


def _fit_centres(vectors: DataFrame, dim: int) -> np.ndarray:
    """A few rounds of Lloyd's algorithm over the sample."""
    rows = max(CENTRES, min(SAMPLE_ROWS, SAMPLE_FLOATS // dim))
    order = (F.xxhash64("vec_id"), "vec_id", "vector")
    sample = vectors.orderBy(*order).limit(rows).select("vector").toArrow()
    points = _matrix(sample.column("vector").combine_chunks(), dim).astype(np.float64)
    centres = points[:CENTRES].copy()
    for _ in range(8):
        own = _closest(points, centres)
        for c in range(len(centres)):
            if (own == c).any():
                centres[c] = points[own == c].mean(axis=0)
    return centres


def _closest(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return ((centres**2).sum(axis=1) - 2 * points @ centres.T).argmin(axis=1)


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def rotation(dim: int, seed: int = 5) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng(seed).normal(size=(dim, dim)))
    return q * np.sign(np.diag(r))


def _encode(centres: np.ndarray, batches: Batches) -> Batches:
    dim = centres.shape[1]
    turn = rotation(dim)
    for batch in batches:
        schema = pa.schema(
            [
                ("row", pa.int64()),
                ("vec_id", pa.int64()),
                ("code", pa.binary()),
                ("centre", pa.int32()),
                ("rest", pa.float64()),
                ("match", pa.float64()),
                ("vector", batch.column("vector").type),
            ]
        )
        points = _matrix(batch.column("vector"), dim).astype(np.float64)
        centre = _closest(points, centres)
        rest = points - centres[centre]
        length = np.linalg.norm(rest, axis=1)
        turned = rest @ turn.T
        # The cosine between the vector and its signs.
        match = np.abs(turned).sum(axis=1) / np.sqrt(dim) / np.where(length > 0, length, 1)
        codes = [row.tobytes() for row in np.packbits(turned > 0, axis=1)]
        yield out_batch(
            schema,
            batch.column("row"),
            batch.column("vec_id"),
            codes,
            pa.array(centre.astype(np.int32)),
            pa.array(length),
            pa.array(np.where(length > 0, match, 1.0)),
            batch.column("vector"),
        )


def _search(centres: np.ndarray, k: int, confidence: float, rows: pa.Table) -> pa.Table:
    """The ``k`` best vectors of a data block for each query of a query block."""
    dim = centres.shape[1]
    asks = rows.column("asks").to_numpy()
    asking, data = rows.filter(pa.array(asks)), rows.filter(pa.array(~asks))
    names = ("query_row", "query_id", "row", "vec_id")
    schema = pa.schema([*((n, pa.int64()) for n in names), ("score", pa.float64())])
    if not len(asking) or not len(data):
        return schema.empty_table()
    turn = rotation(dim)
    rows_, ids = data.column("row").to_numpy(), data.column("vec_id").to_numpy()
    points = _matrix(data.column("vector").combine_chunks(), dim).astype(np.float64)
    bits = np.frombuffer(b"".join(data.column("code").to_pylist()), dtype=np.uint8)
    signs = np.unpackbits(bits.reshape(len(ids), -1), axis=1, count=dim).astype(np.float32) * 2 - 1
    rest, match = data.column("rest").to_numpy(), data.column("match").to_numpy()
    centre = data.column("centre").to_numpy()
    scale = (rest / match / np.sqrt(dim)).astype(np.float32)
    spread = rest * np.sqrt(np.maximum(0, 1 - match**2)) / match * confidence / np.sqrt(max(1, dim - 1))
    # Rounding of the estimate itself.
    spread = spread + 1e-5 * (rest / match + np.linalg.norm(centres, axis=1)[centre])
    query_rows, query_ids = asking.column("row").to_numpy(), asking.column("vec_id").to_numpy()
    queries = _matrix(asking.column("vector").combine_chunks(), dim).astype(np.float64)
    out = []
    for at in range(0, len(query_ids), _QUERIES_AT_ONCE):
        some = queries[at : at + _QUERIES_AT_ONCE]
        guess = (some @ turn.T).astype(np.float32) @ signs.T * scale
        guess = guess + (some @ centres.T)[:, centre]
        margin = np.linalg.norm(some, axis=1)[:, None] * spread
        for i, own in enumerate(query_rows[at : at + _QUERIES_AT_ONCE]):
            other = np.flatnonzero(rows_ != own)
            low = (guess[i] - margin[i])[other]
            high = (guess[i] + margin[i])[other]
            if len(other) > k:
                # Estimates that overflow exclude nothing.
                other = other[~(high < np.partition(low, len(low) - k)[len(low) - k])]
            best, score = _exact_best(some[i], rows_[other], ids[other], points[other], k)
            asked = np.full(len(best), query_ids[at + i])
            out.append((np.full(len(best), own), asked, rows_[other][best], ids[other][best], score))
    return pa.Table.from_arrays(
        [pa.array(np.concatenate(c)) for c in zip(*out, strict=True)], schema=schema
    )


def _exact_best(query: np.ndarray, rows: np.ndarray, ids: np.ndarray, points: np.ndarray, k: int):
    """Places and scores of the ``k`` best."""
    near = np.arange(len(ids))
    if len(ids) > k:
        quick = points @ query
        floor = np.partition(quick, len(quick) - k)[len(quick) - k]
        near = np.flatnonzero(quick >= floor - 1e-9 * (1 + abs(floor)))
    # Component by component, so that equal vectors have equal scores wherever they lie.
    score = np.zeros(len(near))
    for d in range(points.shape[1]):
        score += points[near, d] * query[d]
    best = np.lexsort((rows[near], ids[near], -score))[:k]
    return near[best], score[best]
