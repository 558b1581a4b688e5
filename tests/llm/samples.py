"""Rows with everything that operators must stand."""

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron".split()

LINE = "this line stands in many documents"
BASE = " ".join(WORDS * 12)

#: doc_id, text, lang, source: nulls, empty texts, ties, repeated rows and ids.
ROWS = [
    (1, BASE, "en", "a"),
    (2, BASE.upper(), "en", "a"),
    (3, BASE + " end", "en", None),
    (4, None, None, "b"),
    (5, "", "en", "b"),
    (6, f"{LINE}\nown line of document number six\n  {LINE.upper()}  ", "en", "b"),
    (7, f"{LINE}\nshort\nshort", "de", "c"),
    (8, f"x\n{LINE}", "de", "c"),
    (8, f"x\n{LINE}", "de", "c"),
    (9, "!!! 123 ???", "fr", "c"),
    (9, "another text under the same id", "fr", "c"),
    (None, "a text without an id", "en", "a"),
    (None, None, None, None),
    (10, "word " * 9000, "en", "a"),
    (11, "x" * 9000, "en", "d"),
    (12, "élan vital, naïve façade — 世界 <|endoftext|> it's fine\t ok\r\n", "fr", "d"),
    (13, "one", "en", "a"),
]
#: Columns that operators use inside, to be ignored.
CLASHING = (
    "id size source_size target taken copies part class local start length rank lo hi print "
    "label least node hash batch largest n kept key digest sha bucket bytes shared score shard at"
).split()
