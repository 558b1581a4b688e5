"""Toxicity scores by logistic regression, trained with FTRL-proximal.

Features: hashed single words and word beginnings (``STEM`` characters), pairs of neighbouring
words and pairs with one word between, each counted once per text. Learning: the features of
a bounded sample of labelled rows are found in parallel and written to shared storage; in each
epoch one task reads all of them there and runs FTRL-proximal (McMahan et al., Ad Click
Prediction, 2013) over them, one after the other, with a learning rate per coordinate and an
L1 penalty that keeps most weights at zero. Features of fewer than ``MIN_TEXTS`` texts of the sample are left out. Rows
pass through that task, so its memory does not depend on the texts, and the state between
epochs is two numbers per coordinate. What is left is a sparse table of at most ``2 ** BITS``
weights, whatever the input, which goes to every task.

A text's score depends on its text only. Null counts as empty and gets the score of the
intercept. Labels other than 0 and 1, null among them, are not learned from; without labels
of both kinds every score is the share of positive labels (0 without labels). Rows that
repeat give repeated result rows. An empty table gives an empty result.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.shared import Batches, map_batches, out_batch, staged, steps, utf8
from millrace.session import release, workspace

BITS = 18
#: Labelled rows learned from: those with the smallest hash of their id.
TRAIN_ROWS = 24_000
EPOCHS = 4
ALPHA, BETA, L1, L2 = 1.0, 1.0, 5.0, 1.0
MIN_TEXTS = 4
STEM = 5

_BIAS = 0
_EDGE = b".,;:!?\"'()[]{}|#$%&*@"
_NEXT, _SKIP = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


class Features:
    """Feature numbers of texts; remembers the hashes of words."""

    def __init__(self, remembered: int = 500_000) -> None:
        self.words: dict[bytes, int] = {}
        self.stems: dict[bytes, int] = {}
        self.remembered = remembered

    def of(self, text: bytes) -> np.ndarray:
        """Sorted different feature numbers, the intercept's first."""
        words = text.lower().split()
        if len(self.words) > self.remembered:
            self.words.clear()
            self.stems.clear()
        known, stems = self.words, self.stems
        different = set(words)
        for w in different:
            if w in known:
                continue
            bare = w.strip(_EDGE)
            known[w] = xxhash.xxh64_intdigest(bare)
            stems[w] = xxhash.xxh64_intdigest(bare.decode("utf-8", "replace")[:STEM], 1)
        one = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
        stem = np.fromiter(map(stems.__getitem__, different), np.uint64, len(different))
        with np.errstate(over="ignore"):
            parts = [one, stem, one[:-1] * _NEXT + one[1:], one[:-2] * _SKIP + one[2:]]
        mixed = np.concatenate(parts)
        mixed ^= mixed >> np.uint64(29)
        with np.errstate(over="ignore"):
            mixed *= np.uint64(0xBF58476D1CE4E5B9)
        numbers = (mixed >> np.uint64(64 - BITS)).astype(np.int64)
        numbers[numbers == _BIAS] = 1
        return np.concatenate(([_BIAS], np.unique(numbers)))


class Ftrl:
    """FTRL-proximal with a learning rate per coordinate."""

    def __init__(self) -> None:
        self.z, self.n = np.zeros(1 << BITS), np.zeros(1 << BITS)

    def weights(self, at) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        active = np.abs(z) > L1
        return np.where(active, (np.sign(z) * L1 - z) / ((BETA + np.sqrt(n)) / ALPHA + L2), 0.0)

    def learn(self, at: np.ndarray, label: int) -> None:
        w = self.weights(at)
        slope = _sigmoid(w.sum()) - label
        n = self.n[at]
        step = (np.sqrt(n + slope * slope) - np.sqrt(n)) / ALPHA
        self.z[at] += slope - step * w
        self.n[at] = n + slope * slope


def _sigmoid(x: float) -> float:
    return float(1 / (1 + np.exp(-np.clip(x, -35, 35))))


def train(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    rows: int = TRAIN_ROWS,
) -> tuple[np.ndarray, float]:
    """Weights of all coordinates, and the share of positive labels."""
    chosen = (
        labels.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{label_col}`").alias("label"))
        .filter("label in (0, 1) and id is not null")
        .groupBy("id")
        .agg(F.max("label").cast("int").alias("label"))
        .withColumn("turn", F.xxhash64("id"))
        .orderBy("turn", "id")
        .limit(rows)
    )
    # Written, it has ``rows`` short rows at most: it is sent to the texts, which stay in place.
    chosen = staged(chosen, workspace(docs.sparkSession, "toxicity-sample"))
    share = chosen.agg(F.avg("label")).first()[0] or 0.0
    texts = docs.select(F.col(f"`{id_col}`").alias("id"), utf8(text_col).alias("text"))
    path = workspace(docs.sparkSession, "toxicity-features")
    examples = staged(
        map_batches(
            texts.join(F.broadcast(chosen), "id").select("turn", "label", "text"),
            _features,
            "turn long, label int, features binary",
        ),
        path,
        compression="zstd",
    )
    counted = map_batches(examples.select("features"), _count, "at int, n long")
    frequent = np.zeros(1 << BITS, dtype=bool)
    for row in counted.groupBy("at").agg(F.sum("n").alias("n")).filter(F.col("n") >= MIN_TEXTS).collect():
        frequent[row["at"]] = True  # at most 2 ** BITS
    model = Ftrl()
    in_turn = _in_turn(examples)
    for _ in range(EPOCHS if 0 < share < 1 else 0):
        sent = docs.sparkSession.sparkContext.broadcast((model.z, model.n, frequent))
        learned = map_batches(in_turn, partial(_learn, sent), "at int, z double, n double").toArrow()
        at = learned.column("at").to_numpy()
        model.z[at], model.n[at] = learned.column("z").to_numpy(), learned.column("n").to_numpy()
        sent.destroy()
    release(docs.sparkSession, path)
    return model.weights(slice(None)).astype(np.float32), float(share)


def _in_turn(examples: DataFrame) -> DataFrame:
    """All examples in one task, in an order that does not depend on how the rows lie.

    The task reads the files itself. A shuffle would store the examples again in every epoch,
    and its files stay until the driver happens to collect its garbage.
    """
    return examples.coalesce(1).sortWithinPartitions("turn", "features")


def _count(batches: Batches) -> Batches:
    texts = np.zeros(1 << BITS, dtype=np.int64)
    for batch in batches:
        for row in batch.column("features").to_pylist():
            texts[np.frombuffer(row, "<i4")] += 1
    at = np.flatnonzero(texts)
    schema = pa.schema([("at", pa.int32()), ("n", pa.int64())])
    yield out_batch(schema, pa.array(at.astype(np.int32)), pa.array(texts[at]))


def _features(batches: Batches) -> Batches:
    features = Features()
    schema = pa.schema([("turn", pa.int64()), ("label", pa.int32()), ("features", pa.binary())])
    for batch in batches:
        texts = batch.column("text").to_pylist()
        for a, b in steps(texts):
            found = [features.of(text).astype("<i4").tobytes() for text in texts[a:b]]
            yield out_batch(
                schema, batch.column("turn")[a:b], batch.column("label")[a:b], pa.array(found, pa.binary())
            )


def _learn(sent, batches: Batches) -> Batches:
    """One epoch: the state of all coordinates that the rows or the given state touch."""
    model = Ftrl()
    z, n, frequent = sent.value
    model.z[:], model.n[:] = z, n
    for batch in batches:
        for row, label in zip(batch.column("features").to_pylist(), batch.column("label").to_pylist()):
            at = np.frombuffer(row, "<i4")
            model.learn(at[frequent[at]], label)
    at = np.flatnonzero(model.n)
    schema = pa.schema([("at", pa.int32()), ("z", pa.float64()), ("n", pa.float64())])
    yield out_batch(schema, pa.array(at.astype(np.int32)), pa.array(model.z[at]), pa.array(model.n[at]))


def score(
    docs: DataFrame,
    model: tuple[np.ndarray, float],
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``id_col`` and ``score`` of every row."""
    weights, share = model
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), utf8(text_col).alias("text"))
    at = np.flatnonzero(weights)
    sent = docs.sparkSession.sparkContext.broadcast((at.astype(np.int32), weights[at], share))
    id_type = rows.schema["id"].dataType.simpleString()
    scored = map_batches(rows, partial(_score, sent), f"id {id_type}, score double")
    return scored.withColumnRenamed("id", id_col)


def _score(sent, batches: Batches) -> Batches:
    at, values, share = sent.value
    weights = np.zeros(1 << BITS)
    weights[at] = values
    features = Features()
    for batch in batches:
        texts, scores = batch.column("text").to_pylist(), []
        for a, b in steps(texts):
            for text in texts[a:b]:
                total = weights[features.of(text)].sum()
                scores.append(_sigmoid(total) if len(at) else share)
        schema = pa.schema([("id", batch.column("id").type), ("score", pa.float64())])
        yield out_batch(schema, batch.column("id"), scores)
