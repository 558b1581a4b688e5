"""Token counts of whole texts; huge texts are encoded in overlapping chunks.

A text longer than ``chunk_chars`` is cut into chunks that reach ``overlap`` characters into
the next one. Every chunk is encoded by itself, with offsets, anywhere in the cluster. Two
neighbours are spliced at a place in their overlap where both start a word. The tokenizer
finds words from left to right and its pattern looks at nothing to the left of where it
stands, so from a common start on the right chunk's words are those of the whole text. The
left chunk's words are right up to its last few: what the cut end could change is kept out
of the overlap (see ``_settled``). Where neighbours share no start, the text is encoded
again with overlaps eight times as wide, until a chunk covers it.

Null counts as an empty text (0 tokens). Rows that repeat give repeated result rows. An
empty table gives an empty result. Only the two named columns are read.
"""

from __future__ import annotations

import hashlib
from functools import partial

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.shared import Batches, map_batches, out_batch, staged, steps, utf8
from millrace.llm.wordcache import PieceCounts, open_tokenizer, shared_pieces
from millrace.operators.joins import join_splittable
from millrace.session import release, workspace

CHUNK_CHARS = 65_536
OVERLAP = 1_024

#: Longer than any special token's text and than what the word pattern looks ahead.
_MARGIN = 32

_PLACES = "array<struct<at: long, before: long>>"
_CHUNKS = "digest binary, chunk int, chunks int, start long, stop long, text string"
_ENCODED = f"""digest binary, chunk int, chunks int, start long, next_start long, tokens long,
               first {_PLACES}, last {_PLACES}"""


def token_counts(
    docs: DataFrame,
    tokenizer: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    chunk_chars: int = CHUNK_CHARS,
    overlap: int = OVERLAP,
) -> DataFrame:
    """``id_col``, ``n_bytes`` and ``n_tokens`` of every row. ``tokenizer``: path of its file."""
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), utf8(text_col).alias("text"))
    long_row = F.char_length(F.col("text").cast("string")) > chunk_chars
    id_type = rows.schema["id"].dataType.simpleString()
    short = map_batches(
        rows.filter(~long_row),
        partial(_count_short, tokenizer),
        f"id {id_type}, n_bytes long, n_tokens long",
    )
    huge = map_batches(
        rows.filter(long_row), _digests, f"id {id_type}, n_bytes long, digest binary"
    )
    counted = _count_huge(rows.filter(long_row), tokenizer, chunk_chars, overlap)
    if counted is not None:
        short = short.unionByName(join_splittable(huge, counted, "digest").drop("digest"))
    return short.select(F.col("id").alias(id_col), "n_bytes", "n_tokens")


def _count_short(tokenizer: str, batches: Batches) -> Batches:
    schema = None
    pieces = shared_pieces(PieceCounts, tokenizer)
    for batch in batches:
        texts = batch.column("text").to_pylist()
        counts: list[int] = []
        for a, b in steps(texts):
            counts += pieces.count(texts[a:b])
        schema = schema or pa.schema(
            [("id", batch.column("id").type), ("n_bytes", pa.int64()), ("n_tokens", pa.int64())]
        )
        yield out_batch(schema, batch.column("id"), [len(t) for t in texts], counts)


def _digests(batches: Batches) -> Batches:
    for batch in batches:
        texts = batch.column("text").to_pylist()
        schema = pa.schema(
            [("id", batch.column("id").type), ("n_bytes", pa.int64()), ("digest", pa.binary())]
        )
        digests = [hashlib.sha256(t).digest() for t in texts]
        yield out_batch(schema, batch.column("id"), [len(t) for t in texts], digests)


def _count_huge(
    rows: DataFrame, tokenizer: str, chunk_chars: int, overlap: int
) -> DataFrame | None:
    """``digest`` and ``n_tokens`` of each different long text; None if there is none."""
    spark = rows.sparkSession
    done, failed, used = [], None, []
    while True:
        chunks = map_batches(rows, partial(_cut, chunk_chars, overlap), _CHUNKS)
        if failed is not None:
            chunks = chunks.join(failed, "digest", "left_semi")
        # One copy of each text is enough. The shuffle also deals out the chunks of one text.
        encoded = map_batches(
            chunks.dropDuplicates(["digest", "chunk"]),
            partial(_encode, tokenizer, overlap),
            _ENCODED,
        )
        spliced = encoded.groupBy("digest").applyInArrow(_splice, "digest binary, n_tokens long")
        used.append(workspace(spark, "token-counts"))
        found = staged(spliced, used[-1])
        done.append(found.filter("n_tokens is not null"))
        failed = found.filter("n_tokens is null").select("digest")
        if failed.isEmpty():
            break
        overlap *= 8
    if all(d.isEmpty() for d in done):
        release(spark, *used)
        return None
    result = done[0]
    for d in done[1:]:
        result = result.unionByName(d)
    return result


def _cut(chunk_chars: int, overlap: int, batches: Batches) -> Batches:
    schema = pa.schema(
        [
            ("digest", pa.binary()),
            ("chunk", pa.int32()),
            ("chunks", pa.int32()),
            ("start", pa.int64()),
            ("stop", pa.int64()),
            ("text", pa.string()),
        ]
    )
    for batch in batches:
        for raw in batch.column("text").to_pylist():
            digest, text = hashlib.sha256(raw).digest(), raw.decode("utf-8", "replace")
            starts = list(range(0, max(1, len(text) - overlap), chunk_chars))
            for k, start in enumerate(starts):
                last = k + 1 == len(starts)
                stop = len(text) if last else min(len(text), start + chunk_chars + overlap)
                yield out_batch(
                    schema, [digest], [k], [len(starts)], [start], [stop], [text[start:stop]]
                )


def word_starts(tokenizer, text: str) -> list[tuple[int, int]]:
    """Where each word of ``text`` starts and how many tokens stand before it; the end too."""
    encoding = tokenizer.encode(text, add_special_tokens=False)
    found, before = [], None
    for i, (span, word) in enumerate(zip(encoding.offsets, encoding.word_ids, strict=True)):
        if word is None or word != before:
            found.append((span[0], i))
        before = word
    found.append((len(text), len(encoding.ids)))
    return found


def _settled(starts: list[tuple[int, int]], length: int) -> list[tuple[int, int]]:
    """Word starts that a longer text would have as well.

    A cut end can change the word it stands in and, through what the pattern looks ahead
    or a special token cut in two, the word that reaches into the last ``_MARGIN``
    characters; that word could also have begun with the end of the word before it.
    """
    inside = [k for k, (at, _) in enumerate(starts) if at <= length - _MARGIN]
    return starts[: max(0, len(inside) - 2)]


def _encode(tokenizer: str, overlap: int, batches: Batches) -> Batches:
    opened = open_tokenizer(tokenizer)
    place = pa.list_(pa.struct([("at", pa.int64()), ("before", pa.int64())]))
    schema = pa.schema(
        [
            ("digest", pa.binary()),
            ("chunk", pa.int32()),
            ("chunks", pa.int32()),
            ("start", pa.int64()),
            ("next_start", pa.int64()),
            ("tokens", pa.int64()),
            ("first", place),
            ("last", place),
        ]
    )
    for batch in batches:
        for row in batch.to_pylist():
            starts = word_starts(opened, row["text"])
            base, ends = row["start"], row["chunk"] + 1 == row["chunks"]
            next_start = row["stop"] if ends else row["stop"] - overlap
            settled = [] if ends else _settled(starts, len(row["text"]))

            def places(some, base=base):
                return [{"at": base + at, "before": before} for at, before in some]

            yield out_batch(
                schema,
                [row["digest"]],
                [row["chunk"]],
                [row["chunks"]],
                [base],
                [next_start],
                [starts[-1][1]],
                [places((a, n) for a, n in starts if row["chunk"] and a <= overlap)],
                [places((a, n) for a, n in settled if base + a >= next_start)],
            )


def _splice(key: tuple[pa.Scalar, ...], chunks: pa.Table) -> pa.Table:
    """Tokens of one text from its chunks; null where two neighbours share no word start."""
    rows = sorted(chunks.to_pylist(), key=lambda r: r["chunk"])
    total, since, at_least = 0, 0, 0
    for left, right in zip(rows, rows[1:]):
        ahead = {p["at"]: p["before"] for p in right["first"]}
        common = [p for p in left["last"] if p["at"] in ahead and p["at"] >= at_least]
        if not common:
            total = None
            break
        at_least = common[0]["at"]
        total += common[0]["before"] - since
        since = ahead[at_least]
    if total is not None:
        total += rows[-1]["tokens"] - since
    schema = pa.schema([("digest", pa.binary()), ("n_tokens", pa.int64())])
    return pa.Table.from_batches([out_batch(schema, [key[0].as_py()], [total])])
