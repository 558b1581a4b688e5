"""Vector codes, the n-gram join and lexical search against brute force."""

import random
from collections import Counter

import brute
import numpy as np
import pytest
from samples import ROWS, WORDS

from millrace.llm import lexical, ngram_join
from millrace.llm.lexical import ItemBlock, best, search
from millrace.llm.ngram_join import ngram_components
from millrace.llm.vector_codes import Gnat, compress, nearest_entries

VECTORS = "vec_id long, embedding array<double>, label int, code string, error string"


def _pairs(rows):
    return [(r[0], r[1]) for r in rows]


@pytest.mark.parametrize("dtype", [np.int64, object])
@pytest.mark.parametrize("width", [1, 2, 4])
def test_tree_finds_the_nearest_entry_and_the_lower_index(dtype, width):
    draw = np.random.default_rng(width)
    entries = draw.integers(-20, 20, size=(64, width))
    entries[40:44] = entries[3]
    points = np.vstack([draw.integers(-25, 25, size=(500, width)), entries])
    apart = ((points[:, None] - entries[None]) ** 2).sum(axis=2)
    tree = Gnat(entries.astype(dtype), np.arange(64))
    distance, index, taken = nearest_entries(tree, points.astype(dtype))
    assert index.tolist() == apart.argmin(axis=1).tolist()
    assert distance.tolist() == apart.min(axis=1).tolist()
    assert taken < apart.size  # whole subtrees are left out


def test_tree_of_equal_entries():
    tree = Gnat(np.ones((64, 3), dtype=np.int64), np.arange(64))
    assert nearest_entries(tree, np.zeros((2, 3), dtype=np.int64))[1].tolist() == [0, 0]


def _coded(frame):
    return {
        r["vec_id"]: (r["code"], r["error"], r["label_error"], r["codebooks_sha256"])
        for r in compress(frame).collect()
    }


@pytest.mark.parametrize(("width", "scale"), [(32, 1.0), (20, 1.0), (16, 1e30), (1, 3e5)])
def test_codes_against_brute_force(spark, width, scale):
    draw = random.Random(width)
    rows = [(i, [draw.gauss(0, scale) for _ in range(width)], i % 3 or None) for i in range(150)]
    frame = spark.createDataFrame([(*r, "x", "y") for r in rows], VECTORS).repartition(5)
    want, sha = brute.parted([(i, v) for i, v, _ in rows])
    largest = 2**63 - 1
    by_label = Counter()
    for (_, _, label), (_, error) in zip(rows, want):
        by_label[label] += min(error, largest)
    assert _coded(frame) == {
        i: (code, min(error, largest), min(by_label[label], largest), sha)
        for (i, _, label), (code, error) in zip(rows, want)
    }


def test_codes_of_odd_rows(spark):
    inf, nan = float("inf"), float("nan")
    two = [([float(i), -float(i)]) for i in range(3)]
    rows = [
        (1, two[0], 1), (2, two[1], None), (3, two[2], 1), (3, two[2], 1), (None, [9.0, 9.0], None),
        (4, None, 1), (5, [1.0, None], 1), (6, [inf, 1.0], 1), (7, [nan, 1.0], 1),
        (8, [5.0] * 16, 2), (9, [], 2),
    ]
    frame = spark.createDataFrame([(*r, "x", "y") for r in rows], VECTORS)
    got = Counter(
        (r["vec_id"], r["code"], r["error"], r["label_error"]) for r in compress(frame).collect()
    )
    ones = "{0:02x}{0:02x}" + "00" * 14
    assert got == Counter(
        {
            (1, ones.format(0), 0, 0): 1,
            (2, ones.format(1), 0, 0): 1,
            (3, ones.format(2), 0, 0): 2,
            (None, ones.format(4), 0, 0): 1,
            (8, "00" * 16, 0, 0): 1,
            (9, "00" * 16, 0, 0): 1,
        }
    )
    # Widths handled one after the other give the same.
    assert sorted(compress(frame).collect(), key=str) == sorted(compress(frame, book_bytes=1).collect(), key=str)
    assert compress(frame.limit(0)).collect() == []


def test_ngram_join_of_odd_rows(tricky, nothing):
    got = Counter(map(tuple, ngram_components(tricky).collect()))
    assert got == brute.jaccard(_pairs(ROWS))
    assert ngram_components(nothing).collect() == []


def _copies(seed: int):
    """Groups of near copies of several sizes, many at the edge of the threshold."""
    draw = random.Random(seed)
    rows = []
    for g in range(12):
        base = [draw.choice(WORDS) + str(draw.randrange(40)) for _ in range(draw.randrange(2, 120))]
        for _ in range(draw.choice([1, 2, 40])):
            own = list(base)
            for _ in range(draw.randrange(4)):
                own[draw.randrange(len(own))] = f"new{draw.randrange(10**6)}"
            if draw.random() < 0.3:
                own += [f"tail{draw.randrange(30)}"] * draw.randrange(6)
            rows.append((len(rows), draw.choice([" ", "\n", "\t "]).join(own)))
        rows.append((len(rows), " ".join(base).upper()))
    return rows


@pytest.mark.parametrize("frequent", [2**18, 0])
def test_ngram_join_against_brute_force(spark, monkeypatch, frequent):
    monkeypatch.setattr(ngram_join, "FREQUENT", frequent)  # the order of shingles changes nothing
    rows = _copies(5)
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    got = Counter(map(tuple, ngram_components(frame).collect()))
    assert got == brute.jaccard(rows)
    assert len({c for _, _, c in got}) < len(rows) - 50


def test_a_chain_of_links_is_one_component(spark):
    words = [f"w{i}" for i in range(60)]
    rows = [(i, " ".join(words[i:] + [f"v{k}" for k in range(i)])) for i in range(20)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = Counter(map(tuple, ngram_components(frame).collect()))
    assert got == brute.jaccard(rows)
    assert {c for _, _, c in got} == {0}


def test_search_of_odd_rows(tricky, nothing, spark):
    items = [(1, "alpha BETA beta"), (1, "alpha BETA beta"), (2, None), (3, ""), (None, "élan vital 世界"),
             (4, "this line stands"), (5, "unknownword"), (6, "!!!")]
    frame = spark.createDataFrame([(*i, "x", "y") for i in items], "item_id long, text string, item string, score string")
    got = Counter(map(tuple, search(tricky, frame).collect()))
    assert got == brute.lexical(_pairs(ROWS), items)
    assert search(nothing, frame).collect() == []
    assert search(tricky, frame.limit(0)).collect() == []


def test_search_in_several_blocks_and_tiles(spark, monkeypatch):
    monkeypatch.setattr(lexical, "TILE_TERMS", 3)
    monkeypatch.setattr(lexical, "TILE_DOCS", 4)
    draw = random.Random(3)
    text = lambda n: " ".join(draw.choice(WORDS) for _ in range(n))
    docs = [(i, text(draw.randrange(0, 12))) for i in range(200)]
    items = [(i, text(5)) for i in range(9)]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(6)
    asked = spark.createDataFrame(items, "item_id long, text string")
    got = Counter(map(tuple, search(frame, asked, block_entries=10).collect()))
    assert got == brute.lexical(docs, items)


def test_layers_bound_every_sum_and_add_up():
    most = lexical._MOST
    weights = np.array([most * 3 + 7, 5, most, most - 1])
    block = ItemBlock(np.array([7, 8]), np.array([0, 0, 1, 1]), np.array([0, 1, 1, 2]), weights)
    layers = block.layers(0, 3)
    assert all(layer.sum(axis=1).max() <= most for layer in layers)
    whole = sum(layer.astype(np.int64) for layer in layers)
    assert whole.tolist() == [[most * 3 + 7, 5, 0], [0, most, most - 1]]


def test_best_keeps_the_smaller_ids_among_ties():
    scores, ids = best(np.array([[5, 7, 5, 5, 0]]), np.array([[9, 8, 3, 4, 1]]), 3)
    assert scores.tolist() == [[7, 5, 5]] and ids.tolist() == [[8, 3, 4]]
