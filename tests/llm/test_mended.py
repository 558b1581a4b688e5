"""Language evidence and toxicity against formulas in plain Python; hostile ids, pages and lengths."""

import random
import time
from collections import Counter

import brute
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from samples import WORDS

from millrace.llm import language_id as li
from millrace.llm import toxicity as tox
from millrace.llm.ann import nearest
from millrace.llm.line_dedup import drop_repeated_lines
from millrace.llm.packing import pack

IDS = public_tokenizers.path("word_bpe_49k.json")
LINE = "a line of more than twenty characters"


def test_lines_of_ids_at_both_ends_of_the_range(spark):
    ids = [-(2**63), -(2**63) + 1, -5, 0, 7, 2**63 - 2, 2**63 - 1, None]
    rows = [(i, f"{LINE}\nown line number {k} of this text") for k, i in enumerate(ids)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = drop_repeated_lines(docs).collect()
    got = Counter((r["doc_id"], r["n_lines"], r["n_dropped"], brute.sha(bytes(r["kept_text"]).decode())) for r in kept)
    assert got == brute.lines(rows)
    same = spark.createDataFrame([(5, LINE)] * 4, "doc_id long, text string")
    assert {r["n_dropped"] for r in drop_repeated_lines(same).collect()} == {0}


@pytest.mark.parametrize("part", [b"<nav>", b"<script>x", b"<!--", b"<", b"<html ", b"<html lang", b"</nav><style>", b" lang=", b"<head><!--"])
def test_pages_of_open_tags_take_linear_time(part):
    page = part * (1_000_000 // len(part))
    start = time.perf_counter()
    li.visible_text(page)
    li.declared_language(page)
    assert time.perf_counter() - start < 1


def test_visible_text_and_declared_language():
    assert li.visible_text(b"a<nav>b</nav>c<b>d</b>").split() == [b"a", b"c", b"d"]
    assert li.visible_text(b"a<nav>b<script>c</nav>d</script>e").split() == [b"a", b"d", b"e"]
    assert li.visible_text(b"<!-- x -->a <!-- open <nav>b</NAV >c").split() == [b"a", b"<!--", b"open", b"c"]
    assert li.visible_text(b"1 < 2 and 3 > 2 <") == b"1   2 <"
    assert li.declared_language(b"<HTML class=x lang='DE-at'>") == "de"
    assert li.declared_language(b"<html><html lang=fr>") == "fr"
    assert li.declared_language(b"<html><body lang=fr>") is None


def test_fusion_against_the_formula(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    model = li.train_text_model(docs)
    languages, log_p = model
    draw = random.Random(2)
    texts = [r["text"] or "" for r in docs.limit(60).collect()] + ["", "123", "one", "zwei drei"]
    facts = [
        (draw.choice(languages + [None, "xx"]), draw.choice(["de", "fr", None]), f"h{draw.randrange(9)}" if k % 5 else None,
         draw.choice(["d1", "d2", None])) for k in range(len(texts))
    ]
    rows = spark.createDataFrame(
        [(i, t.encode(), *f) for i, (t, f) in enumerate(zip(texts, facts))],
        "id long, text binary, declared string, suffix string, host string, domain string",
    )
    got = {r["id"]: r for r in li.identify(rows, model).collect()}
    numbers = [li.trigrams(t.encode()).tolist() if any(c.isalpha() for c in t) else None for t in texts]
    want = brute.fused(numbers, facts, log_p.tolist(), li.TEMPER, li.MOST_TRIGRAMS, li.STRENGTH)
    for i, (best, confidence) in enumerate(want):
        assert got[i]["confidence"] == pytest.approx(confidence, rel=1e-6)
        assert got[i]["language"] == languages[best]
        assert got[i]["accepted"] == (numbers[i] is not None and confidence >= li.MIN_CONFIDENCE)
        assert not (got[i]["accepted"] and got[i]["rejected"])
        assert got[i]["rejected"] or numbers[i] is not None


def test_rejected_where_the_evidence_speaks_against_itself(spark):
    alphabet = {"aa": "abc ", "bb": "xyz "}
    draw = random.Random(1)

    def text(lang, n):
        return "".join(draw.choice(alphabet[lang]) for _ in range(n))

    docs = spark.createDataFrame([(text(k, 2000), k) for k in alphabet for _ in range(20)], "text string, lang string")
    model = li.train_text_model(docs)
    rows = [(i, text("aa", 400), "aa", "h1") for i in range(40)] + [(50, text("bb", 60), "aa", "h1"), (51, "a", None, None)]
    frame = spark.createDataFrame(
        [(i, t.encode(), d, None, h, None) for i, t, d, h in rows],
        "id long, text binary, declared string, suffix string, host string, domain string",
    )
    found = {r["id"]: r for r in li.identify(frame, model, min_confidence=1.1).collect()}
    assert found[0]["rejected"] and not found[51]["rejected"] and not found[51]["accepted"]


def test_ftrl_against_plain_python(spark):
    draw = random.Random(4)
    bad = ["idiot", "stupid", "hate"]
    rows, labels = [], []
    for i in range(160):
        toxic = draw.random() < 0.4
        words = [draw.choice(WORDS) for _ in range(draw.randrange(1, 25))] + ([draw.choice(bad)] if toxic else [])
        draw.shuffle(words)
        rows.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    marks = spark.createDataFrame(labels, "doc_id long, toxic int")
    weights, share = tox.train(docs, marks)
    turns = {r["doc_id"]: r["t"] for r in docs.select("doc_id", F.xxhash64("doc_id").alias("t")).collect()}
    features = tox.Features()
    order = sorted(range(160), key=lambda i: turns[i])
    learned = brute.ftrl(
        [(features.of(rows[i][1].encode()).tolist(), labels[i][1]) for i in order],
        tox.EPOCHS, tox.ALPHA, tox.BETA, tox.L1, tox.L2, tox.MIN_TEXTS,
    )
    assert set(np.flatnonzero(weights).tolist()) == set(learned) and len(learned) > 3
    assert all(weights[f] == pytest.approx(w, rel=1e-5) for f, w in learned.items())
    got = {r["doc_id"]: r["score"] for r in tox.score(docs, (weights, share)).collect()}
    for i, text in rows:
        total = sum(learned.get(f, 0.0) for f in features.of(text.encode()).tolist())
        assert got[i] == pytest.approx(1 / (1 + np.exp(-total)), rel=1e-4)


def test_examples_are_not_shuffled_in_every_epoch(spark, tmp_path):
    draw = random.Random(9)
    rows = [(draw.randrange(-50, 50), i % 2, bytes([draw.randrange(256)])) for i in range(200)]
    frame = spark.createDataFrame(rows, "turn long, label int, features binary").repartition(6)
    frame.write.parquet(str(tmp_path / "examples"))
    in_turn = tox._in_turn(spark.read.parquet(str(tmp_path / "examples")))
    assert "Exchange" not in in_turn._jdf.queryExecution().executedPlan().toString()
    assert in_turn.rdd.getNumPartitions() == 1
    got = [(r["turn"], bytes(r["features"])) for r in in_turn.collect()]
    assert got == sorted((turn, features) for turn, _, features in rows)


@pytest.mark.parametrize(("words", "n"), [(600, 60), (300, 200)])
def test_little_padding(spark, words, n):
    rows = [(i, " ".join(["word"] * words)) for i in range(n)]
    got = pack(spark.createDataFrame(rows, "doc_id long, text string").repartition(6), IDS, 2).collect()
    total = sum(r["length"] for r in got)
    assert total == n * (words + 1)
    assert len({r["sequence_id"] for r in got}) <= 1.03 * total / 4096 + 1
    by_sequence = {}
    for r in got:
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for pieces in by_sequence.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 4096


def test_nearest_of_two_widths_repeated_ids_and_doubles(spark):
    draw = np.random.default_rng(6)
    rows = [(int(i % 150), (draw.normal(size=16 if i % 3 else 40) + 1e-9 * i).tolist()) for i in range(400)]
    rows += [(200 + i, [1e18 * (i + 1), -1e18]) for i in range(30)] + [(1000, [3.0]), (1020, [1.0, None])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("row", F.lit("x"))
    got = Counter(map(tuple, nearest(frame, F.col("vec_id") % 20 == 0, data_rows=60).collect()))
    total = found = 0
    want = Counter()
    for q, (name, vector) in enumerate(rows):
        if name % 20 or None in vector:
            continue
        scored = []
        for c, (other, v) in enumerate(rows):
            if c != q and len(v) == len(vector) and None not in v:
                score = 0.0
                for x, y in zip(v, vector):
                    score += x * y
                scored.append((-score, other))
        best = sorted(scored)[:20]
        want.update((name, k, other, -score) for k, (score, other) in enumerate(best, start=1))
        total += len(best)
    assert sum(got.values()) == total
    found = sum(((Counter((a, c, d) for a, _, c, d in got.elements())) & Counter((a, c, d) for a, _, c, d in want.elements())).values())
    assert found / total >= 0.9
    assert max(k for _, k, *_ in got) == 20
