"""Mixing, language, neighbours, WARC and toxicity."""

import base64
from collections import Counter, defaultdict
import hashlib

import brute
import numpy as np
from samples import ROWS
from pyspark.sql import functions as F

import corpus_pipeline
from millrace.llm import warc
from millrace.llm.ann import nearest
from millrace.llm.language_id import identify, page_evidence, train_text_model
from millrace.llm.mixing import cyclic_weights, mix
from millrace.llm.toxicity import score, train


def test_mix(spark, tricky):
    more = [(400 + i, "w " * (1 + i % 9), "en", "abcd"[i % 3 if i % 7 else 3]) for i in range(600)]
    docs = tricky.select("doc_id", "text", "lang", "source").unionByName(
        spark.createDataFrame(more, "doc_id long, text string, lang string, source string")
    )
    for slices in (4096, 3):
        got = mix(docs, cyclic_weights(1, 2, 3), slices=slices).collect()
        assert len(got) == len(ROWS) + len(more)
        sizes, taken, target = defaultdict(int), defaultdict(int), {}
        source_of = defaultdict(set)
        for name, text, _, source in ROWS + more:
            sizes[source] += len(brute.words(text))
            source_of[name].add(source)
        for r in got:
            assert r["taken"] == r["copies"] * r["size"] and 0 <= r["copies"] <= 3
        names = sorted((s for s in sizes if s is not None)) + [None]
        weight = {s: float(1 + i % 3) for i, s in enumerate(names)}
        left, open_, want = float(sum(sizes.values())), set(names), {}
        while open_:
            level = left / sum(weight[s] for s in open_)
            full = {s for s in open_ if level * weight[s] > 3 * sizes[s]}
            for s in full or open_:
                want[s] = 3.0 * sizes[s] if full else level * weight[s]
            left -= sum(want[s] for s in full)
            open_ = open_ - full if full else set()
        for r in got:
            if len(source_of[r["doc_id"]]) == 1:
                s = next(iter(source_of[r["doc_id"]]))
                assert abs(r["target"] - want[s]) < 1e-6 * (1 + want[s]) and r["source_size"] == sizes[s]
                taken[s] += r["taken"]
        largest = {s: max(len(brute.words(t)) for _, t, _, q in ROWS + more if q == s) for s in names}
        for s in names:
            if s is not None and s != "a":  # an id without value stands in two sources
                assert abs(taken[s] - want[s]) <= largest[s]
        again = mix(docs, cyclic_weights(1, 2, 3), slices=slices).collect()
        assert Counter(map(tuple, again)) == Counter(map(tuple, got))


def test_mix_prefers_wanted_documents(spark):
    rows = [(i, "word " * 10, "s" if i < 400 else "t", 4.0 if i % 2 else 1.0) for i in range(800)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, wish double")
    got = mix(docs, F.when(F.col("source") == "s", 0.5).otherwise(1.5), weight_col="wish").collect()
    by_wish = Counter()
    for r in got:
        if r["doc_id"] < 400:
            by_wish[r["doc_id"] % 2] += r["taken"]
    assert abs(sum(by_wish.values()) - 2000) <= 10 and by_wish[1] > 2.5 * by_wish[0]


EN = "the people of the town said that they would come with the others and this was good"
DE = "die leute aus der stadt sagten dass sie mit den anderen kommen und das war gut nicht"


def test_language(spark, tricky, nothing):
    train_rows = [(f"{EN} number {i}", "en") for i in range(30)] + [(f"{DE} nummer {i}", "de") for i in range(30)]
    model = train_text_model(spark.createDataFrame(train_rows, "text string, lang string"))
    assert model[0] == ["de", "en"]
    page = '<!doctype html><html lang="{}"><body><script>var the = 1</script><p>{}</p></body></html>'
    pages = [(i, f"http://a.example.com/{i}", page.format("en", EN)) for i in range(20)]
    pages += [(100 + i, f"http://b.example.de/{i}", page.format("de-DE", DE)) for i in range(20)]
    pages += [
        (200, "http://b.example.de/x", "<p>ok</p>"),  # host and suffix decide
        (201, "http://a.example.com/x", "<p>ok</p>"),
        (202, None, None),
        (203, "http://b.example.de/y", "<p>123 !!!</p>"),
        (203, "http://b.example.de/y", "<p>123 !!!</p>"),
        (None, "nonsense", f"<p>{DE}</p>"),
    ]
    frame = spark.createDataFrame(pages, "page_id long, url string, html string").withColumn("id", F.lit(1))
    got = identify(page_evidence(frame, "page_id", "url", "html"), model).collect()
    assert len(got) == len(pages)
    by_id = {r["id"]: r for r in got}
    assert all(by_id[i]["language"] == "en" and by_id[i]["accepted"] for i in range(20))
    assert all(by_id[100 + i]["language"] == "de" and by_id[100 + i]["accepted"] for i in range(20))
    assert by_id[200]["language"] == "de" and by_id[201]["language"] == "en"
    assert not by_id[202]["accepted"] and not by_id[203]["accepted"]
    assert by_id[None]["language"] == "de"
    empty = identify(page_evidence(frame.limit(0), "page_id", "url", "html"), model)
    assert empty.count() == 0
    untrained = identify(page_evidence(frame, "page_id", "url", "html"), train_text_model(nothing))
    assert untrained.filter("accepted").count() == 0 and untrained.count() == len(pages)


def test_every_language_is_modelled(spark):
    r = np.random.default_rng(5)
    words = {f"l{i:02}": ["".join(r.choice(list("abcdefghijklmnop"), 6)) for _ in range(8)] for i in range(90)}
    rows = [
        (i * 100 + k, " ".join(r.permutation(known)), [name, f"{name.upper()}-US", f" {name}_gb "][k % 3])
        for i, (name, known) in enumerate(words.items())
        for k in range(3 if i < 45 else 2)
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("source", F.lit("a"))
    model = train_text_model(docs)
    assert model[0] == sorted(words)
    nothing = F.lit(None).cast("string")
    facts = {c: nothing for c in ("declared", "suffix", "host", "domain")}
    unlabelled = docs.select(F.col("doc_id").alias("id"), F.col("text").cast("binary")).withColumns(facts)
    got = identify(unlabelled, model).collect()
    assert len(got) == len(rows)
    assert all(x["accepted"] and x["language"] == f"l{x['id'] // 100:02}" for x in got)
    assert corpus_pipeline.language_id(spark, docs, "").count() == len(rows)


def test_nearest(spark):
    rng = np.random.default_rng(3)
    vectors = rng.normal(size=(900, 24)).astype(np.float32)
    vectors[100:400] = vectors[100]  # a hot vector
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)]
    bad = [(1000, None), (1020, [0.0] * 24), (1040, [float("nan")] * 24), (1060, [float("inf")] + [1.0] * 23)]
    bad += [(1080, [None] + [1.0] * 23), (1100, [1.0, 2.0]), (None, [1.0] * 24)]
    frame = spark.createDataFrame(rows + bad, "vec_id long, embedding array<float>").withColumn("score", F.lit(0))
    for sizes in ({}, {"data_rows": 200, "query_rows": 10}):
        got = defaultdict(list)
        for r in nearest(frame, F.col("vec_id") % 20 == 0, **sizes).orderBy("query_id", "rank").collect():
            got[r["query_id"]].append((r["vec_id"], r["score"]))
            assert r["rank"] == len(got[r["query_id"]])
        wide = vectors.astype(np.float64)
        found = total = 0
        assert sorted(got) == list(range(0, 900, 20))
        for q, answer in got.items():
            exact = np.zeros(900)
            for d in range(24):
                exact += wide[:, d] * wide[q, d]
            order = [i for i in np.lexsort((np.arange(900), -exact)) if i != q][:20]
            assert all(s == exact[v] for v, s in answer)
            found += len(set(order) & {v for v, _ in answer})
            total += 20
        assert found / total >= 0.9
    few = nearest(frame.filter("vec_id < 5"), F.col("vec_id") % 20 == 0)
    assert few.count() == 4 and nearest(frame.limit(0), F.col("vec_id") % 20 == 0).count() == 0


HTML = [
    (1, "http://a/1", "same"),
    (2, "http://a/2", "same"),
    (3, "http://a/3", "ünïcode\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\n\r\n"),
    (4, None, None),
    (5, "http://a/5", ""),
    (6, "http://a/6\r\nX-Header: no", "long " * 50_000),
    (None, "http://a/7", "no id"),
    (2, "http://a/2", "same"),
]


def test_archives_round_trip(spark):
    pages = spark.createDataFrame(HTML, "page_id long, url string, html string").withColumn("id", F.lit(1))
    got = Counter(map(tuple, warc.archived_pages(pages).collect()))
    groups = defaultdict(list)
    for name, _, html in HTML:
        groups[html or ""].append(name)
    want = Counter()
    for name, _, html in HTML:
        raw = (html or "").encode()
        last = max((n for n in groups[html or ""] if n is not None), default=None)
        digest = base64.b32encode(hashlib.sha1(raw).digest()).decode()
        kind = "response" if name == last else "revisit"
        want[name, len(raw), digest, kind, None if name == last else last] += 1
    assert got == want
    assert warc.archived_pages(pages.limit(0)).count() == 0


def test_small_payloads_are_never_revisits(spark):
    pages = spark.createDataFrame([(1, "u", "ab"), (2, "u", "ab")], "page_id long, url string, html string")
    got = {r["page_id"]: r["record_type"] for r in warc.archived_pages(pages, min_bytes=3).collect()}
    assert got == {1: "response", 2: "response"}


def test_payloads_and_transactions(spark, tmp_path):
    pages = spark.createDataFrame(HTML, "page_id long, url string, html string")
    folder = str(tmp_path / "warc")
    warc.write_archives(pages, folder)
    rows = warc.assemble(warc.read_archives(spark, folder)).collect()
    texts = Counter(bytes(r["capture"]["payload"]).decode() for r in rows if r["capture"]["type"] == "response")
    assert texts == Counter(["same", "same", *(h or "" for i, _, h in HTML if i in (3, 5, 6, None))])
    ok = [r for r in rows if r["capture"]["target_uri"] == "http://a/3"]
    assert len(ok) == 1 and len(ok[0]["requests"]) == len(ok[0]["metadata"]) == 1
    assert ok[0]["metadata"][0]["fields"]["page-id"] == ["3"]


def test_links_in_either_direction_and_over_one_record(spark):
    fields = "type string, record_id string, concurrent_to array<string>, payload binary"
    records = [
        ("response", "r1", ["q1"], b"x"),
        ("request", "q1", [], None),
        ("metadata", "m1", ["q1"], None),
        ("revisit", "r2", [], None),
        ("request", "q2", ["r2"], None),
        ("metadata", "m2", ["q2"], None),
        ("metadata", "lost", ["nowhere"], None),
        ("conversion", "c1", ["r1"], None),
        ("resource", "s1", ["r1"], None),
    ]
    rows = warc.assemble(spark.createDataFrame(records, fields)).collect()
    got = {
        r["capture_id"]: ([x["record_id"] for x in r["requests"]], [x["record_id"] for x in r["metadata"]])
        for r in rows
    }
    assert got == {"r1": (["q1"], ["m1"]), "r2": (["q2"], ["m2"])}
    others = {r["capture_id"]: sorted(x["record_id"] for x in r["others"]) for r in rows}
    assert others == {"r1": ["c1", "s1"], "r2": []}


def test_fields_keep_all_their_values():
    block = b"outlink: a\r\noutlink: b\r\nhop : x:y\r\n\r\n"
    row = warc._row({"warc-type": ["metadata"], "content-type": ["application/warc-fields"]}, block, True)
    assert ("outlink", ["a", "b"]) in row[7] and ("hop", ["x:y"]) in row[7]


def test_toxicity(spark, tricky, nothing):
    r = np.random.default_rng(1)
    plain = [f"w{i}" for i in range(80)]
    rows, labels = [], []
    for i in range(1200):
        words = list(r.choice(plain, size=40))
        toxic = i % 6 == 0
        if toxic:
            words[int(r.integers(40))] = ["Idiot!", "scum", "trash,"][i % 3]
        rows.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    told = spark.createDataFrame(labels + [(5000, None), (None, 1)], "doc_id long, toxic int")
    model = train(docs, told.filter("doc_id is null or doc_id % 5 <> 0"))
    assert 0 < np.count_nonzero(model[0]) < 200
    got = {x["doc_id"]: x["score"] for x in score(docs, model).collect()}
    held = [(got[i], i % 6 == 0) for i in range(0, 1200, 5)]
    assert np.mean([(s >= 0.5) == t for s, t in held]) > 0.97
    others = score(tricky, model).collect()
    assert len(others) == len(ROWS) and all(0 <= x["score"] <= 1 for x in others)
    one_kind = score(docs, train(docs, told.filter("toxic = 0")))
    assert one_kind.agg(F.max("score")).first()[0] == 0
    assert score(nothing, train(nothing, told.limit(0))).count() == 0


def test_toxicity_learns_rare_words_from_many_rows(spark):
    word = "element_at(array('idle', 'mild', 'calm', 'warm', 'cool', 'slow', 'fast'), cast(pmod(hash(id, {}), 7) + 1 as int))"
    plain = ", ".join(word.format(k) for k in range(6))
    foul = "case when id % 3000 = 7 then 'rarefoul' when id % 20 = 0 then 'scum' else 'fine' end"
    rows = spark.range(24_000).selectExpr(
        "id as doc_id", f"concat_ws(' ', {plain}, {foul}) as text", "int(id % 3000 = 7 or id % 20 = 0) as toxic"
    )
    model = train(rows, rows)
    unseen = spark.createDataFrame(
        [(1, "calm rarefoul warm"), (2, "calm scum warm"), (3, "calm fine warm")], "doc_id long, text string"
    )
    got = {x["doc_id"]: x["score"] for x in score(unseen, model).collect()}
    assert got[1] >= 0.5 and got[2] >= 0.5 and got[3] < 0.1
    # How the rows lie does not matter.
    again = train(rows.repartition(7, "text"), rows)
    assert np.array_equal(model[0], again[0])
