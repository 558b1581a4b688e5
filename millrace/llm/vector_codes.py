"""Compressed vector codes: product quantisation with integers, entries found by GNATs.

A component x becomes the integer floor(256 * x). Vectors are cut into ``PARTS`` equal
consecutive parts; each part position has a codebook of at most ``ENTRIES`` entries, at first
that part of the vectors with the smallest ids. A round assigns every part to the nearest
entry and moves each entry to the floored mean of its parts; entries without parts stay.

The nearest entry is found in a geometric near-neighbour access tree (Brin, 1995) over the
entries. An inner node has split points and, for every split point and child, the least and
the largest distance between the point and the child's entries. A query measures its distance
to the split points; a child is left out with its whole subtree if some split point proves all
of it strictly further away than the best entry so far. Distances are square roots and may be
off in their last bits, so the proof must hold by more than that; entries that are left are
compared by their squared distances, which are integers, ties to the lower index.

Spark deals out the vectors; a task returns integer sums and counts per entry, so that what
meets is as large as the codebooks however many vectors there are. The driver and the tasks
hold the codebooks of one width, or of several widths together below ``BOOK_BYTES``.

Vectors that are null or hold a null or a component that is not finite take no part. Zero
vectors do. Each width (number of components) has codebooks of its own; a width that is no
multiple of ``PARTS`` counts as filled up with zeros. Of fewer vectors than entries each gives
one. Null ids come last, rows that repeat an id are ordered by their vectors. Components of any
finite size are exact; errors beyond the range of long are given as its largest value. An
empty table gives an empty result. Only the named columns are read.
"""

from __future__ import annotations

import hashlib
import math
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.shared import Batches, map_batches, out_batch, staged
from millrace.operators.joins import join_splittable
from millrace.session import workspace

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
BOOK_BYTES = 64 * 2**20
#: Split points of a node of the tree.
DEGREE = 8
_LARGEST = 2**63 - 1
_LIMB = 32
#: Vectors worked on at a time, in components.
_STEP = 2**20


def integers(values: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """floor(scale * x): 64-bit where squares of differences fit, else Python integers."""
    if not values.size or np.abs(values).max() * scale < 2.0**31 / (2 * math.sqrt(values.shape[-1])):
        return np.floor(values * scale).astype(np.int64)
    # A double of at least 2**52 is an integer; below, the product is exact for a power of two.
    exact = [
        int(v) * scale if abs(v) >= 2.0**52 else math.floor(v * scale)
        for v in values.ravel().tolist()
    ]
    return np.array(exact, dtype=object).reshape(values.shape)


def _squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances of every row of ``a`` to every row of ``b``."""
    apart = a[:, None, :] - b[None, :, :]
    if a.shape[1] == 0:
        return np.zeros(apart.shape[:2], dtype=np.int64)
    return (apart * apart).sum(axis=2)


def _roots(squares: np.ndarray) -> np.ndarray:
    if squares.dtype == object:
        flat = [math.isqrt(s) for s in squares.ravel()]
        return np.array(flat + [None], dtype=object)[:-1].reshape(squares.shape)
    return np.sqrt(squares.astype(np.float64))


def _further(far: np.ndarray, near: np.ndarray) -> np.ndarray:
    """Where ``far`` is larger than ``near`` by more than roots can be wrong."""
    if far.dtype == object or near.dtype == object:
        return (far - near > 4).astype(bool)
    return far - near > 1e-12 * (far + near)


class Gnat:
    """A tree over the rows ``members`` of ``entries``."""

    def __init__(self, entries: np.ndarray, members: np.ndarray, degree: int = DEGREE) -> None:
        self.entries, self.children = entries, []
        if len(members) <= degree:
            self.splits = members
            return
        chosen = [0]
        nearest = _squares(entries[members], entries[members[:1]])[:, 0]
        while len(chosen) < degree:
            chosen.append(int(nearest.argmax()))
            gap = _squares(entries[members], entries[members[chosen[-1:]]])[:, 0]
            nearest = np.minimum(nearest, gap)
        # Entries that coincide give the same place twice.
        chosen = sorted(set(chosen))
        self.splits = members[chosen]
        rest = np.delete(members, chosen)
        apart = _squares(entries[rest], entries[self.splits])
        owner, distance = apart.argmin(axis=1), _roots(apart)
        for j in range(len(chosen)):
            own = owner == j
            if own.any():
                low, high = distance[own].min(axis=0), distance[own].max(axis=0)
                if own.all() and len(chosen) == 1:  # all coincide: no split tells them apart
                    self.splits, self.children = members, []
                    return
                self.children.append((low, high, Gnat(entries, rest[own], degree)))

    def search(self, points: np.ndarray, rows: np.ndarray, best: np.ndarray, index: np.ndarray) -> int:
        """Improve ``best`` and ``index`` of the points ``rows``; the number of distances taken."""
        squares = _squares(points[rows], self.entries[self.splits])
        for j, entry in enumerate(self.splits):
            new = squares[:, j]
            held, held_index = best[rows], index[rows]
            better = ((new < held) | ((new == held) & (entry < held_index))).astype(bool)
            best[rows[better]], index[rows[better]] = new[better], entry
        taken = squares.size
        distance = _roots(squares) if self.children else None
        for low, high, child in self.children:
            reach = _roots(best[rows])[:, None]
            gone = _further(distance, reach + high[None, :]) | _further(
                np.broadcast_to(low[None, :], distance.shape), distance + reach
            )
            left = rows[~gone.any(axis=1)]
            if len(left):
                taken += child.search(points, left, best, index)
        return taken


def nearest_entries(tree: Gnat, points: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Squared distance and index of the nearest entry, ties to the lower index."""
    wide = points.dtype == object or tree.entries.dtype == object
    best = np.full(len(points), math.inf if wide else _LARGEST, dtype=object if wide else np.int64)
    if wide:  # larger than any squared distance met
        best[:] = 1 << 8192
    index = np.full(len(points), len(tree.entries), dtype=np.int64)
    taken = tree.search(points, np.arange(len(points)), best, index)
    return best, index, taken


def compress(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
    book_bytes: int = BOOK_BYTES,
) -> DataFrame:
    """``id_col``, ``label_col``, ``code``, ``error``, ``label_error``, ``codebooks_sha256``."""
    spark = vectors.sparkSession
    kept = (
        vectors.select(
            F.col(f"`{id_col}`").alias("id"),
            F.col(f"`{label_col}`").alias("label"),
            F.col(f"`{vector_col}`").cast("array<double>").alias("vector"),
        )
        .filter("vector is not null")
        .filter("forall(vector, x -> x is not null and not isnan(x) and abs(x) < double('infinity'))")
        .withColumn("width", F.size("vector"))
    )
    types = {f.name: f.dataType.simpleString() for f in kept.schema.fields}
    schema = f"id {types['id']}, label {types['label']}, code string, error long, sha string"
    widths = sorted(r["width"] for r in kept.select("width").distinct().collect())
    coded = []
    for some in _together(widths, entries, book_bytes):
        of_widths = kept.filter(F.col("width").isin(some))
        books = first_entries(of_widths, parts, entries)
        for _ in range(rounds):
            books = _moved(books, of_widths, parts)
        path = workspace(spark, "vector-codes")
        work = partial(_encode, {w: trees(b) for w, b in books.items()}, parts, _shas(books))
        coded.append(staged(map_batches(of_widths.select("id", "label", "vector"), work, schema), path))
    if not coded:
        coded.append(spark.createDataFrame([], schema))
    every = coded[0]
    for more in coded[1:]:
        every = every.unionByName(more)
    every = every.withColumn("same", F.struct("label"))
    whole = F.sum(F.col("error").cast("decimal(38,0)"))
    by_label = every.groupBy("same").agg(
        F.least(whole, F.lit(_LARGEST).cast("decimal(38,0)")).cast("long").alias("label_error")
    )
    return join_splittable(every, by_label, "same", "inner").select(
        F.col("id").alias(id_col),
        F.col("label").alias(label_col),
        "code",
        "error",
        "label_error",
        F.col("sha").alias("codebooks_sha256"),
    )


def _together(widths: list[int], entries: int, book_bytes: int) -> list[list[int]]:
    groups, held = [], 0
    for w in widths:
        size = 8 * entries * max(w, 1)
        if not groups or held + size > book_bytes:
            groups.append([])
            held = 0
        groups[-1].append(w)
        held += size
    return groups


def _cut(rows: np.ndarray, parts: int) -> np.ndarray:
    """(rows, width) -> (rows, parts, part width), filled up with zeros."""
    each = -(-rows.shape[1] // parts)
    if each * parts != rows.shape[1]:
        rows = np.hstack([rows, np.zeros((len(rows), each * parts - rows.shape[1]))])
    return rows.reshape(len(rows), parts, each)


def first_entries(kept: DataFrame, parts: int, entries: int) -> dict[int, np.ndarray]:
    """Per width the codebooks (parts, entries, part width) that the smallest ids give."""
    order = Window.partitionBy("width").orderBy(F.col("id").asc_nulls_last(), "vector")
    first = (
        kept.select("width", "id", "vector", F.row_number().over(order).alias("place"))
        .filter(F.col("place") <= entries)
        .select("width", "place", "vector")
        .collect()
    )  # at most ``entries`` rows of each width
    by_width: dict[int, list] = {}
    for row in sorted(first, key=lambda r: (r["width"], r["place"])):
        by_width.setdefault(row["width"], []).append(row["vector"])
    return {
        w: integers(_cut(np.array(rows, dtype=np.float64).reshape(len(rows), w), parts)).swapaxes(0, 1)
        for w, rows in by_width.items()
    }


def trees(book: np.ndarray) -> list[Gnat]:
    """One tree per part position."""
    return [Gnat(entries, np.arange(len(entries))) for entries in book]


def _points(vectors: pa.Array, parts: int):
    """Steps of rows of one width: ``width``, row numbers, integers (rows, parts, part width)."""
    widths = np.diff(vectors.offsets.to_numpy())
    for width in np.unique(widths):
        rows = np.flatnonzero(widths == width)
        step = max(1, _STEP // max(1, int(width)))
        for at in range(0, len(rows), step):
            some = rows[at : at + step]
            flat = vectors.take(pa.array(some)).flatten().to_numpy(zero_copy_only=False)
            yield int(width), some, integers(_cut(flat.reshape(len(some), width), parts))


def _column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(name).cast(pa.list_(pa.float64()))


_SUMS = pa.schema(
    [("width", pa.int32()), ("slot", pa.int32()), ("at", pa.int32()), ("limb", pa.int32()), ("value", pa.int64())]
)


def _sum_parts(books: dict[int, list[Gnat]], parts: int, batches: Batches) -> Batches:
    """Counts (``at`` -1) and sums per entry, each sum in limbs of 32 bits."""
    counts = {w: np.zeros((parts, len(t[0].entries)), dtype=np.int64) for w, t in books.items()}
    # Steps are summed in 64 bits where they are small, and together as Python integers.
    sums = {w: np.zeros((parts, *t[0].entries.shape), dtype=object) for w, t in books.items()}
    for batch in batches:
        for width, _, points in _points(_column(batch, "vector"), parts):
            for p, tree in enumerate(books[width]):
                _, index, _ = nearest_entries(tree, points[:, p])
                counts[width][p] += np.bincount(index, minlength=len(tree.entries))
                step = np.zeros(tree.entries.shape, dtype=points.dtype)
                np.add.at(step, index, points[:, p])
                sums[width][p] += step
    out = []
    for width, count in counts.items():
        size = count.shape[1]
        for p, e in zip(*np.nonzero(count)):
            slot = int(p) * size + int(e)
            out.append((width, slot, -1, 0, int(count[p, e])))
            for at, total in enumerate(sums[width][p, e].tolist()):
                limb, total = 0, int(total)
                while abs(total) >> _LIMB:
                    out.append((width, slot, at, limb, total & (2**_LIMB - 1)))
                    total >>= _LIMB
                    limb += 1
                out.append((width, slot, at, limb, total))
    if out:
        yield out_batch(_SUMS, *map(list, zip(*out)))


def _moved(books: dict[int, np.ndarray], kept: DataFrame, parts: int) -> dict[int, np.ndarray]:
    """The codebooks after one round."""
    work = partial(_sum_parts, {w: trees(b) for w, b in books.items()}, parts)
    summed = (
        map_batches(kept.select("vector"), work, "width int, slot int, at int, limb int, value long")
        .groupBy("width", "slot", "at", "limb")
        .agg(F.sum("value").alias("value"))
        .collect()
    )  # as large as the codebooks
    counts: dict[tuple[int, int], int] = {}
    sums: dict[tuple[int, int, int], int] = {}
    for r in summed:
        if r["at"] < 0:
            counts[r["width"], r["slot"]] = r["value"]
        else:
            key = (r["width"], r["slot"], r["at"])
            sums[key] = sums.get(key, 0) + (r["value"] << (_LIMB * r["limb"]))
    after = {w: b.astype(object) for w, b in books.items()}
    for (width, slot, at), total in sums.items():
        p, e = divmod(slot, books[width].shape[1])
        after[width][p, e, at] = total // counts[width, slot]
    return {w: _small(b) for w, b in after.items()}


def _small(book: np.ndarray) -> np.ndarray:
    largest = max((abs(int(v)) for v in book.ravel()), default=0)
    return book.astype(np.int64) if largest < 2**31 / (2 * math.sqrt(max(1, book.shape[-1]))) else book


def _shas(books: dict[int, np.ndarray]) -> dict[int, str]:
    return {
        w: hashlib.sha256(",".join(str(int(v)) for v in b.ravel()).encode()).hexdigest()
        for w, b in books.items()
    }


def _encode(books: dict[int, list[Gnat]], parts: int, shas: dict[int, str], batches: Batches) -> Batches:
    for batch in batches:
        n = len(batch)
        codes, errors, of_book = [""] * n, [0] * n, [""] * n
        for width, rows, points in _points(_column(batch, "vector"), parts):
            found = [nearest_entries(tree, points[:, p])[:2] for p, tree in enumerate(books[width])]
            index = np.stack([i for _, i in found], axis=1).astype(np.uint8)
            total = sum(best.astype(object) for best, _ in found)
            for row, code, error in zip(rows.tolist(), index, total):
                codes[row], errors[row] = code.tobytes().hex(), min(int(error), _LARGEST)
                of_book[row] = shas[width]
        names = ("id", "label")
        schema = pa.schema(
            [
                *((c, batch.column(c).type) for c in names),
                ("code", pa.string()),
                ("error", pa.int64()),
                ("sha", pa.string()),
            ]
        )
        yield out_batch(schema, *(batch.column(c) for c in names), codes, errors, of_book)
