"""Pack tokenized documents into fixed-length sequences by cutting-stock column generation.

1. Every document is tokenized once. Full sequences are cut off its front; what is left has
   a length class (its length in 256ths of the sequence, rounded up).
   Pieces are written to shared storage with a rank per class and task.
2. The histogram of classes, at most 256 numbers whatever the input, goes to the driver. A
   linear program over patterns (which classes fill a sequence) is solved by column
   generation: a knapsack dynamic program prices new patterns. Patterns that leave almost
   no room are rounded to whole numbers and used. What they do not cover is laid end to
   end and cut where a sequence is full, so that only the very last sequence stays open.
3. The plan is a table of rank ranges whose size depends on the number of classes only.
   Documents find their places in it by class and rank; Spark does that as a join.

Null text counts as empty. Every row counts, also one that repeats. An empty table gives an
empty result. Only the two named columns are read.
"""

from __future__ import annotations

import zlib
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.shared import Batches, map_batches, out_batch, staged, steps, utf8
from millrace.llm.wordcache import PieceIds, shared_pieces
from millrace.session import workspace

#: Length classes. A piece of class c fits into c / CLASSES of a sequence.
CLASSES = 256
#: Patterns that leave more classes empty than this are not used.
_MOST_WASTE = 1
_STEPS = 1_500


def pack(
    docs: DataFrame,
    tokenizer: str,
    end_id: int,
    capacity: int = 4096,
    id_col: str = "doc_id",
    text_col: str = "text",
    keep_ids: bool = False,
) -> DataFrame:
    """One row per piece: document, place in the document, place in a sequence, checksum.

    Columns: ``id_col``, ``start``, ``length``, ``ids_crc32``, ``doc_tokens``,
    ``sequence_id``, ``offset``; with ``keep_ids`` also ``ids``, the token ids as
    little-endian unsigned 32-bit numbers. ``capacity`` is a multiple of 256.
    """
    if capacity % CLASSES:
        raise ValueError(f"capacity must be a multiple of {CLASSES}")
    unit = capacity // CLASSES
    spark = docs.sparkSession
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), utf8(text_col).alias("text"))
    id_type = rows.schema["id"].dataType.simpleString()
    pieces = staged(
        map_batches(
            rows,
            partial(_tokenize, tokenizer, end_id, capacity),
            f"""id {id_type}, part int, class int, local long, start long, length long,
                crc long, doc_tokens long, ids binary""",
        ),
        workspace(spark, "packing-pieces"),
        compression="zstd",
    )
    # How many pieces of a class earlier tasks have: one row per task and class.
    earlier = Window.partitionBy("class").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    shares = staged(
        pieces.groupBy("class", "part").agg(F.count("*").alias("n")),
        workspace(spark, "packing-shares"),
    )
    before = shares.select(
        "class", "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before")
    )
    histogram = shares.groupBy("class").agg(F.sum("n").alias("n")).collect()
    plan = spark.createDataFrame(
        plan_packing({r["class"]: r["n"] for r in histogram}),
        "class int, lo long, hi long, base long, per int, slot int",
    )
    laid = F.expr("per = 0")
    at = F.expr("base + (rank - lo) * class")
    placed = (
        pieces.drop("ids")
        .join(before, ["class", "part"])
        .withColumn("rank", F.col("before") + F.col("local"))
        .join(F.broadcast(plan), "class")
        .filter("rank >= lo and rank < hi")
        .withColumn("item", F.expr("rank - lo"))
        .withColumn("at", at)
        .withColumn(
            "sequence_id",
            F.explode(
                F.when(laid, F.expr(f"sequence(at div {CLASSES}, (at + class - 1) div {CLASSES})"))
                .otherwise(F.expr("array(base + item div per)"))
            ),
        )
        .withColumn("opens", F.expr(f"sequence_id * {CLASSES} - at"))
        .withColumn("cut_from", F.when(laid, F.greatest(F.lit(0), "opens")).otherwise(0) * unit)
        .withColumn(
            "cut_to",
            F.when(laid, F.least(F.col("length"), (F.col("opens") + CLASSES) * unit))
            .otherwise(F.col("length")),
        )
        .select(
            "id", "part", "class", "local", "doc_tokens", "length", "crc", "cut_from", "cut_to",
            (F.col("start") + F.col("cut_from")).alias("start"),
            "sequence_id",
            F.when(laid, F.greatest(F.lit(0), -F.col("opens")))
            .otherwise(F.expr("slot + item % per")).alias("slot"),
        )
    )
    whole = F.expr("cut_from = 0 and cut_to = length")
    own = ["part", "class", "local"]
    cut_ids = F.expr("substring(ids, 4 * cut_from + 1, 4 * (cut_to - cut_from))")
    # Cut pieces are few. Written first, their size is known and Spark can send them round
    # instead of shuffling all token ids.
    to_cut = staged(placed.filter(~whole), workspace(spark, "packing-cut"))
    with_ids = (placed if keep_ids else to_cut).join(pieces.select(*own, "ids"), own)
    cut = with_ids.withColumn("ids", cut_ids).withColumn(
        "crc", F.when(whole, F.col("crc")).otherwise(F.crc32("ids"))
    )
    if keep_ids:
        result = cut
    else:
        result = placed.filter(whole).unionByName(cut.drop("ids"))
    in_sequence = Window.partitionBy("sequence_id").orderBy("slot")
    length = F.col("cut_to") - F.col("cut_from")
    return result.select(
        F.col("id").alias(id_col),
        "start",
        length.alias("length"),
        F.col("crc").alias("ids_crc32"),
        "doc_tokens",
        "sequence_id",
        (F.sum(length).over(in_sequence) - length).alias("offset"),
        *(["ids"] if keep_ids else []),
    )


def _tokenize(path: str, end_id: int, capacity: int, batches: Batches) -> Batches:
    tokens = shared_pieces(PieceIds, path)
    end = np.array([end_id], dtype="<u4").tobytes()
    part, unit = TaskContext.get().partitionId(), capacity // CLASSES
    seen = [0] * (CLASSES + 1)
    for batch in batches:
        texts, names = batch.column("text").to_pylist(), batch.column("id")
        schema = pa.schema(
            [
                ("id", names.type),
                ("part", pa.int32()),
                ("class", pa.int32()),
                ("local", pa.int64()),
                ("start", pa.int64()),
                ("length", pa.int64()),
                ("crc", pa.int64()),
                ("doc_tokens", pa.int64()),
                ("ids", pa.binary()),
            ]
        )
        for a, b in steps(texts):
            owners, rows = [], []
            for i, ids in enumerate(tokens.ids(texts[a:b]), a):
                ids += end
                total = len(ids) // 4
                for start in range(0, total, capacity):
                    piece = ids[4 * start : 4 * (start + capacity)]
                    length = len(piece) // 4
                    kind = -(-length // unit)
                    owners.append(i)
                    rows.append(
                        (part, kind, seen[kind], start, length, zlib.crc32(piece), total, piece)
                    )
                    seen[kind] += 1
            if rows:
                yield out_batch(schema, names.take(pa.array(owners)), *map(list, zip(*rows)))


def solve_patterns(demand: dict[int, int], classes: int = CLASSES) -> list[tuple[dict, float]]:
    """Patterns and how often to use each, near the least number of sequences.

    The linear program: cover ``demand[c]`` pieces of every class c with patterns whose
    classes add up to ``classes`` at most. Column generation with a revised simplex method,
    one row per class present. Stops when the bound is within 0.05 %.
    """
    kinds = np.array(sorted(c for c, n in demand.items() if n), dtype=np.int64)
    if not len(kinds):
        return []
    need = np.array([demand[c] for c in kinds], dtype=float)
    need += 1e-7 * np.arange(1, len(kinds) + 1)  # breaks ties between pivots
    columns = np.diag((classes // kinds).astype(float))
    cost = np.ones(len(kinds))
    inverse = np.diag(1 / columns.diagonal())
    for step in range(_STEPS):
        if step % 100 == 99:
            inverse = _inverse(columns)
        price = (cost[:, None] * inverse).sum(axis=0)
        low = int(price.argmin())
        if price[low] < -1e-9:  # more of this class than needed would not hurt
            column, column_cost = -np.eye(len(kinds))[low], 0.0
        else:
            worth, column = _best_pattern(kinds, price, classes)
            if worth <= 1.0005:
                break
            column_cost = 1.0
        level, slope = (inverse * need).sum(axis=1), (inverse * column).sum(axis=1)
        rising = np.flatnonzero(slope > 1e-9)
        if not len(rising):
            break
        leaves = rising[(level[rising] / slope[rising]).argmin()]
        columns[:, leaves], cost[leaves] = column, column_cost
        pivot = inverse[leaves] / slope[leaves]
        inverse -= np.outer(slope, pivot)
        inverse[leaves] = pivot
    level = (_inverse(columns) * need).sum(axis=1)
    return [
        ({int(kinds[i]): int(n) for i, n in enumerate(columns[:, j]) if n}, float(level[j]))
        for j in np.argsort(-level)
        if cost[j] and level[j] > 0
    ]


def _inverse(matrix: np.ndarray) -> np.ndarray:
    """Gauss-Jordan elimination by rows.

    Products here are sums over elements: the threads of BLAS stall in a driver that has started
    a Java gateway, which a few hundred rows do not need.
    """
    n = len(matrix)
    both = np.hstack([matrix, np.eye(n)])
    for k in range(n):
        pivot = k + int(np.abs(both[k:, k]).argmax())
        both[[k, pivot]] = both[[pivot, k]]
        both[k] /= both[k, k]
        factors = both[:, k].copy()
        factors[k] = 0.0
        both -= factors[:, None] * both[k]
    return both[:, n:]


def _best_pattern(kinds: np.ndarray, price: np.ndarray, classes: int) -> tuple[float, np.ndarray]:
    """Knapsack by dynamic programming: the pattern whose pieces are worth most."""
    best, choice = np.zeros(classes + 1), np.full(classes + 1, -1)
    for room in range(1, classes + 1):
        fits = int(np.searchsorted(kinds, room, side="right"))
        best[room] = best[room - 1]
        if fits:
            worth = best[room - kinds[:fits]] + price[:fits]
            top = int(worth.argmax())
            if worth[top] > best[room] + 1e-12:
                best[room], choice[room] = worth[top], top
    column, room = np.zeros(len(kinds)), classes
    while room > 0:
        if choice[room] < 0:
            room -= 1
        else:
            column[choice[room]] += 1
            room -= kinds[choice[room]]
    return float(best[classes]), column


def plan_packing(demand: dict[int, int], classes: int = CLASSES) -> list[tuple]:
    """Rows (class, lo, hi, base, per, first, slot) for documents of a class by their rank.

    With ``per``, documents ``lo`` to ``hi`` go whole into the sequences from ``base`` on, ``per``
    into each. With ``per`` 0 they are laid end to end from position ``base``, in classes.
    At most two rows per class and pattern.
    """
    taken = dict.fromkeys(demand, 0)
    rows, sequences = [], 0
    for pattern, level in solve_patterns(demand, classes):
        if classes - sum(c * n for c, n in pattern.items()) > _MOST_WASTE:
            continue
        times = min(round(level), *((demand[c] - taken[c]) // n for c, n in pattern.items()))
        slot = 0
        for c, n in pattern.items() if times else ():
            rows.append((c, taken[c], taken[c] + n * times, sequences, n, slot))
            taken[c] += n * times
            slot += n
        sequences += times
    position = sequences * classes
    for c in sorted(demand, reverse=True):
        if taken[c] < demand[c]:
            rows.append((c, taken[c], demand[c], position, 0, 0))
            position += c * (demand[c] - taken[c])
    return rows
