"""The operators over again, small and slow, in plain Python."""

from __future__ import annotations

import hashlib
from collections import Counter, defaultdict

import xxhash

SPACE = " \t\n\x0b\x0c\r"


def lower(text: str | None) -> str:
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def lines(rows):
    """(id, text) -> counted (id, n_lines, n_dropped, sha of what is kept)."""
    holders = defaultdict(set)
    for name, text in rows:
        for line in (text or "").split("\n"):
            holders[lower(line.strip(SPACE))].add(name)
    order = lambda x: (x is not None, x)
    out = Counter()
    for name, text in rows:
        every, kept = (text or "").split("\n"), []
        for line in every:
            key = lower(line.strip(SPACE))
            gone = len(key) >= 20 and len(holders[key]) >= 3 and max(holders[key], key=order) != name
            if not gone:
                kept.append(line)
        out[name, len(every), len(every) - len(kept), sha("\n".join(kept))] += 1
    return out


def exact(rows):
    groups = defaultdict(list)
    for name, text in rows:
        groups[lower(text)].append(name)
    out = Counter()
    for name, text in rows:
        same = groups[lower(text)]
        keep = max((x for x in same if x is not None), default=None)
        out[name, keep, len(same), name == keep, sha(lower(text))] += 1
    return out


def words(text: str | None) -> list[str]:
    for c in SPACE:
        text = (text or "").replace(c, " ")
    return [w for w in text.split(" ") if w]


def fingerprint(text: str | None) -> int:
    w = words(lower(text))
    if not w:
        return 0
    shingles = [" ".join(w[i : i + 4]) for i in range(max(1, len(w) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(prints: list[int], names: list, radius: int = 4) -> list:
    """The smallest name reachable from each entry."""
    label = list(range(len(prints)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i, a in enumerate(prints):
        for j in range(i):
            if (a ^ prints[j]).bit_count() <= radius:
                label[max(root(i), root(j))] = min(root(i), root(j))
    least = {}
    for i, name in enumerate(names):
        if name is not None:
            r = root(i)
            least[r] = min(least.get(r, name), name)
    return [least.get(root(i)) for i in range(len(prints))]


def shingle_set(text: str | None, width: int = 4) -> frozenset:
    w = words(lower(text))
    return frozenset(" ".join(w[i : i + width]) for i in range(max(1, len(w) - width + 1))) if w else frozenset()


def jaccard(rows, percent: int = 85):
    """(id, text) -> counted (id, set size, smallest id reachable)."""
    sets = [shingle_set(t) for _, t in rows]
    label = list(range(len(rows)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if a and 100 * len(a & sets[j]) >= percent * len(a | sets[j]):
                x, y = root(i), root(j)
                label[max(x, y)] = min(x, y)
    least = {}
    for i, (name, _) in enumerate(rows):
        if name is not None:
            least[root(i)] = min(least.get(root(i), name), name)
    return Counter((name, len(sets[i]), least.get(root(i))) for i, (name, _) in enumerate(rows))


def parted(vectors, parts=16, entries=64, rounds=2):
    """(id, vector) rows of one width, by id -> codes, errors and the final codebooks."""
    import math
    from fractions import Fraction

    width = len(vectors[0][1])
    each = -(-width // parts)
    whole = [[math.floor(Fraction(x) * 256) for x in v] + [0] * (each * parts - width) for _, v in vectors]
    cut = [[tuple(v[p * each : (p + 1) * each]) for p in range(parts)] for v in whole]
    books = [[v[p] for v in cut[:entries]] for p in range(parts)]

    def assign():
        out = []
        for v in cut:
            out.append(
                [
                    min((sum((a - b) ** 2 for a, b in zip(v[p], e)), i) for i, e in enumerate(books[p]))
                    for p in range(parts)
                ]
            )
        return out

    for _ in range(rounds):
        own = assign()
        for p in range(parts):
            for i in range(len(books[p])):
                of_entry = [cut[r][p] for r, a in enumerate(own) if a[p][1] == i]
                if of_entry:
                    books[p][i] = tuple(sum(c) // len(of_entry) for c in zip(*of_entry))
    last = assign()
    text = ",".join(str(c) for book in books for e in book for c in e)
    return [("".join(f"{i:02x}" for _, i in a), sum(d for d, _ in a)) for a in last], sha(text)


def lexical(docs, items, k=10):
    """Counted (item, rank, id, score)."""
    import math
    import re

    def found(text):
        return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lower(text))

    of_docs = [(name, Counter(found(text))) for name, text in docs]
    n_docs = sum(1 for _, t in of_docs if t)
    n_words = sum(sum(t.values()) for _, t in of_docs)
    holders = Counter(term for _, t in of_docs for term in t)
    out = Counter()
    for item, text in items:
        scored = []
        for name, t in of_docs:
            if not t:
                continue
            m = 25 + 75 * sum(t.values()) * n_docs // n_words
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * holders[w] + 1)))
                * (10**9 * t[w] // (1000 * t[w] + 8 * m))
                for w in found(text)
                if w in t
            )
            if score > 0:
                scored.append((-score, name is None, name or 0, name))
        for rank, (score, _, _, name) in enumerate(sorted(scored)[:k], start=1):
            out[item, rank, name, -score] += 1
    return out


def fused(texts, facts, log_p, temper, most, strength):
    """(language number, confidence) per row, or None without letters.

    ``texts``: trigram numbers of each row, None without letters. ``facts``: per row declared,
    suffix, host and domain. ``log_p``: per language the log-probability of each number.
    """
    import math

    n = len(log_p)
    evidence = []
    for numbers in texts:
        if numbers is None:
            evidence.append([0.0] * n)
            continue
        own = [sum(float(p[k]) for k in numbers) for p in log_p]
        own = [v * temper * min(len(numbers), most) / max(1, len(numbers)) for v in own]
        evidence.append([v - max(own) for v in own])
    votes = [None if t is None else e.index(max(e)) for t, e in zip(texts, evidence)]
    total = sum(v is not None for v in votes)
    of_language = [votes.count(k) for k in range(n)]

    def others(row, key):
        """Votes per language of the other rows that share the row's fact, and their number."""
        counts = [0] * n
        if facts[row][key] is not None:
            for i, v in enumerate(votes):
                if i != row and v is not None and facts[i][key] == facts[row][key]:
                    counts[v] += 1
        return counts, sum(counts)

    out = []
    for row in range(len(texts)):
        share = [(c + 1) / (total + n) for c in of_language]
        counts, m = others(row, 3)
        domain = [(c + strength * s) / (m + strength) for c, s in zip(counts, share)]
        counts, m = others(row, 2)
        score = [
            e + math.log((c + strength * d) / (m + strength))
            for e, c, d in zip(evidence[row], counts, domain)
        ]
        for key in (0, 1):
            if facts[row][key] is None:
                continue
            counts, m = others(row, key)
            spread = max(m, 1) / max(1, total)
            score = [
                s + math.log((c + strength * spread) / (all_ + strength))
                for s, c, all_ in zip(score, counts, of_language)
            ]
        best = score.index(max(score))
        out.append((best, 1 / sum(math.exp(s - score[best]) for s in score)))
    return out


def ftrl(rows, epochs, alpha, beta, l1, l2, least):
    """Weights by feature of (features, label) rows learned one after the other."""
    import math
    from collections import defaultdict as table

    holders = Counter(f for features, _ in rows for f in features)
    z, n = table(float), table(float)

    def weight(f):
        if abs(z[f]) <= l1:
            return 0.0
        return (math.copysign(l1, z[f]) - z[f]) / ((beta + math.sqrt(n[f])) / alpha + l2)

    for _ in range(epochs):
        for features, label in rows:
            own = [f for f in features if holders[f] >= least]
            w = {f: weight(f) for f in own}
            total = max(-35.0, min(35.0, sum(w.values())))
            slope = 1 / (1 + math.exp(-total)) - label
            for f in own:
                step = (math.sqrt(n[f] + slope * slope) - math.sqrt(n[f])) / alpha
                z[f] += slope - step * w[f]
                n[f] += slope * slope
    return {f: w for f in z if (w := weight(f))}
