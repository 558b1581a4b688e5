"""Line and exact deduplication, SimHash, token counts and packing against brute force."""

from collections import Counter, defaultdict
import random
import zlib

import brute
import numpy as np
import public_tokenizers
import pytest
from samples import ROWS

from millrace.llm import token_counts as tc
from millrace.llm.components import connected
from millrace.llm.exact_dedup import exact_groups
from millrace.llm.line_dedup import drop_repeated_lines
from millrace.llm.packing import pack, plan_packing, solve_patterns
from millrace.llm.simhash import near_duplicates
from millrace.llm.wordcache import PieceCounts, PieceIds, open_tokenizer

PAIRS = [(r[0], r[1]) for r in ROWS]
COUNTS = public_tokenizers.path("byte_bpe_50k.json")
IDS = public_tokenizers.path("word_bpe_49k.json")
PARTS = [
    "a", "The", " ", "  ", "\n", "\n\n", ".", ",", "!", "'s", "'", "<|endoftext|>", "é", "é",
    "12", "\x1c", "　", "ß", "世界", "\r\n", "\t", " word", "idiot", "'ll", "<|EndOfText|>",
]


def random_texts(n, longest, seed=3):
    r = random.Random(seed)
    return ["".join(r.choice(PARTS) for _ in range(r.randint(0, longest))) for _ in range(n)]


def test_lines(tricky):
    kept = drop_repeated_lines(tricky).collect()
    got = Counter((r["doc_id"], r["n_lines"], r["n_dropped"], brute.sha(bytes(r["kept_text"]).decode())) for r in kept)
    assert got == brute.lines(PAIRS)


def test_lines_in_many_batches(spark):
    r = random.Random(1)
    pool = [f"line number {i} of the pool of lines" for i in range(30)]
    rows = [(i, "\n".join(r.choice(pool) for _ in range(r.randint(0, 6)))) for i in range(120)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = drop_repeated_lines(docs, batches=7, fanout=2).collect()
    got = Counter((x["doc_id"], x["n_lines"], x["n_dropped"], brute.sha(bytes(x["kept_text"]).decode())) for x in kept)
    assert got == brute.lines(rows)


@pytest.mark.parametrize("digest_bytes, bucket_bytes", [(32, 2**26), (32, 300), (1, 300)])
def test_exact(spark, tricky, digest_bytes, bucket_bytes):
    """Also with buckets that must be split, and with digests that collide."""
    docs = tricky.select("doc_id", "text")
    extra = [(100 + i % 40, f"text {i % 60}") for i in range(150)]
    docs = docs.unionByName(spark.createDataFrame(extra, docs.schema))
    got = exact_groups(docs, digest_bytes=digest_bytes, bucket_bytes=bucket_bytes)
    assert Counter(map(tuple, got.collect())) == brute.exact(PAIRS + extra)


def test_near(spark, tricky):
    r = random.Random(5)
    base = [[f"w{r.randint(0, 400)}" for _ in range(150)] for _ in range(6)]
    more = []
    for i in range(60):
        w = list(r.choice(base))
        for _ in range(r.randint(0, 4)):
            w[r.randrange(len(w))] = f"v{r.randint(0, 999)}"
        more.append((200 + i, " ".join(w)))
    docs = tricky.select("doc_id", "text").unionByName(
        spark.createDataFrame(more, "doc_id long, text string")
    )
    rows = PAIRS + more
    prints = [brute.fingerprint(t) for _, t in rows]
    labels = brute.components(prints, [n for n, _ in rows])
    want = Counter((n, f"{p:016x}", c) for (n, _), p, c in zip(rows, prints, labels))
    for block_rows in (131_072, 5):
        assert Counter(map(tuple, near_duplicates(docs, block_rows=block_rows).collect())) == want


def test_components(spark):
    r = random.Random(2)
    chain = [(i, i + 1) for i in range(0, 60)]
    links = chain + [(100, 163), (163, 120), (7, 7)] + [(r.randint(200, 260), r.randint(200, 260)) for _ in range(50)]
    got = {x["node"]: x["label"] for x in connected(spark.createDataFrame(links, "u long, v long")).collect()}
    parent = {n: n for link in links for n in link}

    def root(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in links:
        parent[max(root(a), root(b))] = min(root(a), root(b))
    linked = {n for a, b in links if a != b for n in (a, b)}
    assert got == {n: root(n) for n in linked}


def test_word_caches_agree_with_the_library():
    texts = random_texts(3000, 30) + ["", " ", "a ", " a", "A.", "H̱"]
    raw = [t.encode() for t in texts]
    counts, ids = open_tokenizer(COUNTS), open_tokenizer(IDS)
    assert PieceCounts(counts).count(raw) == [len(counts.encode(t, add_special_tokens=False).ids) for t in texts]
    want = [np.array(ids.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
    assert PieceIds(ids).ids(raw) == want


def test_marks_at_the_end_of_words(monkeypatch):
    """Words apart from marks behind them give the library's ids, and are not learned once per mark."""
    r = random.Random(8)
    marks = [".", ",", "***", "$$$", "?!", "'", "'.", "|>", "<|", "<|endoftext|>", ")", "_", "×", "’", "…", "\u0301."]
    words = ["plain", "Où", "élan", "naïveté", "été", "É", "x1", "4.5", "don't", "l'", "世界", "e\u0301", "", "<|endoftext|>", "<|a"]
    texts = [" ".join(r.choice(words) + r.choice(marks) * r.randint(0, 2) for _ in range(12)) for _ in range(2000)]
    library = open_tokenizer(IDS)
    want = [np.array(library.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
    assert PieceIds(library).ids([t.encode() for t in texts]) == want
    # Each text alone: nothing is known from before.
    assert [PieceIds(library).ids([t.encode()])[0] for t in texts[:20]] == want[:20]
    pieces, alone = PieceIds(library), []
    encoded = pieces._encoded
    monkeypatch.setattr(pieces, "_encoded", lambda some: alone.extend(some) or encoded(some))
    pieces.ids([" ".join(f"{a}{b}{m}" for a in "abcdef" for b in ("u", "é") for m in ("***", "&&&", ".", "?!")).encode()])
    assert sorted(alone) == [b"&&&", b"***", b".", b"?!"]


def test_token_counts(spark, tricky):
    library = open_tokenizer(COUNTS)
    more = [(300 + i, t) for i, t in enumerate(random_texts(60, 300, seed=9))] + [(299, "y" * 3000)]
    docs = tricky.select("doc_id", "text").unionByName(spark.createDataFrame(more, "doc_id long, text string"))
    got = tc.token_counts(docs, COUNTS, chunk_chars=150, overlap=64).collect()
    want = Counter(
        (n, len((t or "").encode()), len(library.encode(t or "", add_special_tokens=False).ids))
        for n, t in PAIRS + more
    )
    assert Counter(map(tuple, got)) == want


def test_splices_are_proven():
    """Words in front of a settled start are those of the whole text."""
    library = open_tokenizer(COUNTS)
    for text in random_texts(300, 120, seed=4):
        whole = dict(tc.word_starts(library, text))
        for cut in (50, 90, 140):
            for at, before in tc._settled(tc.word_starts(library, text[:cut]), cut):
                assert cut >= len(text) or whole.get(at) == before


def check_packing(rows, got, capacity):
    library = open_tokenizer(IDS)
    want = Counter()
    for name, text in rows:
        ids = np.array(library.encode(text or "", add_special_tokens=False).ids + [2], "<u4")
        want[name, len(ids)] += 1
    by_sequence, by_doc = defaultdict(list), defaultdict(int)
    for r in got:
        by_sequence[r["sequence_id"]].append((r["offset"], r["length"]))
        by_doc[r["doc_id"], r["doc_tokens"]] += r["length"]
        assert zlib.crc32(bytes(r["ids"])) == r["ids_crc32"] and len(r["ids"]) == 4 * r["length"]
    assert by_doc == {k: n * k[1] for k, n in want.items()}
    for pieces in by_sequence.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at and length > 0
            at += length
        assert at <= capacity
    return by_sequence


def test_packing(tricky):
    got = pack(tricky, IDS, 2, capacity=256, keep_ids=True).collect()
    sequences = check_packing(PAIRS, got, 256)
    total = sum(length for pieces in sequences.values() for _, length in pieces)
    assert len(sequences) <= total // 256 + 2
    library = open_tokenizer(IDS)
    unique = {name: text for name, text in PAIRS if [n for n, _ in PAIRS].count(name) == 1}
    for name, text in unique.items():
        own = sorted((r for r in got if r["doc_id"] == name), key=lambda r: r["start"])
        ids = b"".join(bytes(r["ids"]) for r in own)
        assert ids == np.array(library.encode(text or "", add_special_tokens=False).ids + [2], "<u4").tobytes()
        assert [r["start"] for r in own] == list(np.cumsum([0] + [r["length"] for r in own[:-1]]))


def test_patterns():
    demand = {100: 50, 156: 50, 128: 11, 30: 90}
    used = Counter()
    for pattern, times in solve_patterns(demand):
        assert sum(c * n for c, n in pattern.items()) <= 256
        for c, n in pattern.items():
            used[c] += n * times
    assert all(used[c] >= n - 1e-4 for c, n in demand.items())
    assert sum(t for _, t in solve_patterns(demand)) < 50 + 5.5 + 90 / 8 + 0.1
    for kind, n in demand.items():
        ranges = sorted((lo, hi) for c, lo, hi, *_ in plan_packing(demand) if c == kind)
        assert ranges[0][0] == 0 and ranges[-1][1] == n
        assert all(a[1] == b[0] for a, b in zip(ranges, ranges[1:]))
    assert plan_packing({}) == [] and len(plan_packing({132: 10**9})) == 1


def test_empty_tables(nothing):
    assert drop_repeated_lines(nothing).count() == 0
    assert exact_groups(nothing).count() == 0
    assert near_duplicates(nothing).count() == 0
    assert tc.token_counts(nothing, COUNTS).count() == 0
    assert pack(nothing, IDS, 2).count() == 0
