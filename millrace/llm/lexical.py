"""Ranked lexical search as blocked dense matrix products.

An item's score for a document is the sum, over the item's terms with repeats, of a weight of
the term times the term's impact in the document, all integers. That is a product of a matrix
of items by terms and one of terms by documents:

1. Items are dealt into blocks of about ``BLOCK_ENTRIES`` different terms (``BLOCK_ITEMS`` items
   at most, in the mean). The terms of a block are numbered; its vocabulary is what is sent to
   the tasks. Each block is one pass over the documents, and there is one block unless the
   items together are large.
2. A pass reduces every document to the numbers and counts of those of its terms that the block
   has, and counts documents per term.
3. A task multiplies tiles: all items of the block by ``TILE_TERMS`` terms, times these terms by
   ``TILE_DOCS`` documents, in float64 with BLAS. Impacts are below 10**6; a tile of item weights
   whose rows sum to too much is split into layers, so that no sum within a product can reach
   2**53 and every product is exact in whatever order BLAS adds. Tiles are added as 64-bit integers.
4. Each task keeps the ``k`` best documents per item, ties by id; Spark merges those of the tasks.

Terms are runs of ASCII letters and digits and of characters beyond U+007F, A-Z lowered. Null
texts have none. Rows that repeat an item are answered each by itself, rows that repeat a document
stand each by themselves. Ids of documents are cast to long, null ids come last among ties.
Documents that score 0 are not returned, so an item without known terms has no rows; without
documents there are none at all. An item's score must fit 64 bits, which takes more than
300 million terms in one item to exceed. Only the named columns are read.
"""

from __future__ import annotations

import math
from collections import Counter
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.shared import Batches, map_batches, out_batch, staged, utf8
from millrace.session import workspace

K = 10
BLOCK_ENTRIES, BLOCK_ITEMS = 2**20, 1024
TILE_TERMS, TILE_DOCS = 1024, 512
#: Fixed values of the measure.
IMPACT, SCALE, LENGTH, SHARE = 1_000_000_000, 1000, 75, 8
#: The largest sum of weights whose product with impacts stays below 2**53.
_MOST = (2**53 - 1) // (IMPACT // SCALE)
_SALTS = 64
_NULL_ID = 2**63 - 1

_KEPT = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256)
)


def terms(text: bytes) -> list[bytes]:
    """Runs of letters, digits and characters beyond ASCII; A-Z lowered."""
    return text.translate(_KEPT).split()


def _item_terms(batches: Batches) -> Batches:
    schema = pa.schema([("item", pa.int64()), ("term", pa.binary()), ("n", pa.int64())])
    for batch in batches:
        items, found, counts = [], [], []
        for item, text in zip(batch.column("item").to_pylist(), batch.column("text").to_pylist()):
            for term, n in Counter(terms(text)).items():
                items.append(item)
                found.append(term)
                counts.append(n)
        yield out_batch(schema, items, found, counts)


def _reduce(vocabulary: dict[bytes, int], batches: Batches) -> Batches:
    """Per document its length in terms, and numbers and counts of the vocabulary's terms."""
    schema = pa.schema(
        [
            ("id", pa.int64()),
            ("length", pa.int64()),
            ("terms", pa.list_(pa.int32())),
            ("counts", pa.list_(pa.int32())),
        ]
    )
    number = vocabulary.get
    for batch in batches:
        lengths, found, counts = [], [], []
        for text in batch.column("text").to_pylist():
            every = terms(text)
            tally = Counter(filter(None, map(number, every)))
            lengths.append(len(every))
            found.append(list(tally.keys()))
            counts.append(list(tally.values()))
        yield out_batch(schema, batch.column("id"), lengths, found, counts)


def _documents_per_term(n_terms: int, batches: Batches) -> Batches:
    seen = np.zeros(n_terms + 1, dtype=np.int64)
    for batch in batches:
        seen += np.bincount(batch.column("terms").flatten().to_numpy(), minlength=n_terms + 1)
    number = np.flatnonzero(seen)
    schema = pa.schema([("term", pa.int32()), ("n", pa.int64())])
    yield out_batch(schema, pa.array(number.astype(np.int32)), pa.array(seen[number]))


class ItemBlock:
    """Weights of a block's items by term, in coordinates; dense one tile of terms at a time."""

    def __init__(self, items: np.ndarray, rows: np.ndarray, columns: np.ndarray, weights: np.ndarray):
        order = np.argsort(columns, kind="stable")
        self.items = items
        self.rows, self.columns, self.weights = rows[order], columns[order], weights[order]

    def layers(self, low: int, high: int) -> list[np.ndarray]:
        """Dense matrices (items, high - low) that add up to the weights of these terms."""
        a, b = np.searchsorted(self.columns, [low, high])
        dense = np.zeros((len(self.items), high - low), dtype=np.int64)
        np.add.at(dense, (self.rows[a:b], self.columns[a:b] - low), self.weights[a:b])
        n = max(1, -(-int(dense.sum(axis=1).max(initial=0)) // (_MOST - (high - low))))
        return [(dense // n + (dense % n > i)).astype(np.float64) for i in range(n)]


def _search(
    block: ItemBlock, n_terms: int, n_docs: int, n_words: int, k: int, batches: Batches
) -> Batches:
    tiles = []
    for low in range(0, n_terms + 1, TILE_TERMS):
        high = min(low + TILE_TERMS, n_terms + 1)
        tiles.append((low, high, block.layers(low, high)))
    n_items = len(block.items)
    kept_scores = np.zeros((n_items, 0), dtype=np.int64)
    kept_ids = np.zeros((n_items, 0), dtype=np.int64)
    for batch in batches:
        every_id = batch.column("id").fill_null(_NULL_ID).to_numpy()
        lengths = batch.column("length").to_pylist()
        # In Python integers: the product may need more than 64 bits.
        norms = np.array([SHARE * (100 - LENGTH + LENGTH * n * n_docs // n_words) for n in lengths], dtype=np.int64)
        numbers, counts = (batch.column(c) for c in ("terms", "counts"))
        ends = numbers.offsets.to_numpy()
        for at in range(0, len(batch), TILE_DOCS):
            upto = min(at + TILE_DOCS, len(batch))
            of_doc = np.repeat(np.arange(upto - at), np.diff(ends[at : upto + 1]))
            term = numbers.values.to_numpy()[ends[at] : ends[upto]]
            tf = counts.values.to_numpy()[ends[at] : ends[upto]].astype(np.int64)
            impact = IMPACT * tf // (SCALE * tf + norms[at:upto][of_doc])
            order = np.argsort(term, kind="stable")
            term, of_doc, impact = term[order], of_doc[order], impact[order]
            scores = np.zeros((n_items, upto - at), dtype=np.int64)
            for low, high, layers in tiles:
                a, b = np.searchsorted(term, [low, high])
                if a == b:
                    continue
                dense = np.zeros((high - low, upto - at))
                dense[term[a:b] - low, of_doc[a:b]] = impact[a:b]
                for layer in layers:
                    scores += (layer @ dense).astype(np.int64)
            ids = np.broadcast_to(every_id[at:upto], scores.shape)
            kept_scores, kept_ids = best(
                np.hstack([kept_scores, scores]), np.hstack([kept_ids, ids]), k
            )
    item, place = np.nonzero(kept_scores > 0)
    schema = pa.schema([("item", pa.int64()), ("doc_id", pa.int64()), ("score", pa.int64())])
    found = kept_ids[item, place]
    yield out_batch(
        schema,
        pa.array(block.items[item]),
        pa.array(found, mask=found == _NULL_ID),
        pa.array(kept_scores[item, place]),
    )


def best(scores: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` highest scores of each row, equal scores by id."""
    if scores.shape[1] <= k:
        return scores, ids
    least = np.partition(scores, scores.shape[1] - k, axis=1)[:, -k]
    out_scores, out_ids = np.zeros((len(scores), k), np.int64), np.zeros((len(scores), k), np.int64)
    for i, floor in enumerate(least):
        near = np.flatnonzero(scores[i] >= floor)  # all that tie with the last one are among them
        near = near[np.lexsort((ids[i, near], -scores[i, near]))[:k]]
        out_scores[i], out_ids[i] = scores[i, near], ids[i, near]
    return out_scores, out_ids


def search(
    docs: DataFrame,
    items: DataFrame,
    k: int = K,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    block_entries: int = BLOCK_ENTRIES,
    block_items: int = BLOCK_ITEMS,
) -> DataFrame:
    """``item_col``, ``rank``, ``doc_id``, ``score`` of the ``k`` best documents per row of ``items``."""
    spark = docs.sparkSession
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), utf8(text_col).alias("text"))
    numbered = staged(
        items.select(
            F.col(f"`{item_col}`").alias("name"),
            utf8(item_text_col).alias("text"),
        ).withColumn("item", F.monotonically_increasing_id()),
        workspace(spark, "lexical-items"),
    )
    entries = staged(
        map_batches(numbered.select("item", "text"), _item_terms, "item long, term binary, n long"),
        workspace(spark, "lexical-terms"),
    )
    size = entries.agg(F.count("*").alias("n"), F.count_distinct("item").alias("items")).first()
    blocks = max(1, -(-size["n"] // block_entries), -(-size["items"] // block_items))
    entries = entries.withColumn("block", F.pmod(F.xxhash64("item"), F.lit(blocks)))
    found, total = None, None
    for b in range(blocks):
        block = entries.filter(F.col("block") == b).drop("block").toArrow()  # bounded, see above
        words = sorted(set(block.column("term").to_pylist()))
        vocabulary = {word: i for i, word in enumerate(words, start=1)}
        path = workspace(spark, "lexical-documents")
        reduced = staged(
            map_batches(
                rows,
                partial(_reduce, vocabulary),
                "id long, length long, terms array<int>, counts array<int>",
            ),
            path,
        )
        if total is None:
            total = reduced.agg(
                F.count_if(F.col("length") > 0).alias("docs"), F.sum("length").alias("words")
            ).first()
        if not total["words"] or not words:
            continue
        holders = dict.fromkeys(range(1, len(words) + 1), 0)
        per_term = map_batches(
            reduced.select("terms"), partial(_documents_per_term, len(words)), "term int, n long"
        )
        holders |= {r["term"]: r["n"] for r in per_term.groupBy("term").agg(F.sum("n").alias("n")).collect()}
        weighed = _weigh(block, vocabulary, holders, total["docs"])
        best_of_tasks = map_batches(
            reduced,
            partial(_search, weighed, len(words), total["docs"], total["words"], k),
            "item long, doc_id long, score long",
        )
        part = staged(best_of_tasks, workspace(spark, "lexical-best"))
        found = part if found is None else found.unionByName(part)
    if found is None:
        found = spark.createDataFrame([], "item long, doc_id long, score long")
    # Every task has at most k rows an item; they meet in two steps.
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    salted = found.withColumn("salt", F.spark_partition_id() % _SALTS)
    some = Window.partitionBy("item", "salt").orderBy(*order)
    all_of_item = Window.partitionBy("item").orderBy(*order)
    ranked = (
        salted.withColumn("place", F.row_number().over(some))
        .filter(F.col("place") <= k)
        .withColumn("rank", F.row_number().over(all_of_item))
        .filter(F.col("rank") <= k)
    )
    return ranked.join(numbered.select("item", "name"), "item").select(
        F.col("name").alias(item_col), "rank", "doc_id", "score"
    )


def _weigh(block: pa.Table, vocabulary: dict[bytes, int], holders: dict[int, int], n_docs: int) -> ItemBlock:
    items, rows = np.unique(block.column("item").to_numpy(), return_inverse=True)
    columns = np.array([vocabulary[t] for t in block.column("term").to_pylist()], dtype=np.int64)
    weight = {
        c: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * holders[c] + 1)))
        for c in vocabulary.values()
    }
    weights = np.array([weight[c] for c in columns.tolist()], dtype=np.int64)
    return ItemBlock(items, rows, columns, weights * block.column("n").to_numpy())
