"""Language identification by Bayesian fusion of evidence.

For every row and language the logarithms of these add up:

* the likelihood of the text: hashed byte trigrams, counted per language over all training
  rows. Trigrams overlap and repeat, so the likelihood counts as ``TEMPER`` per trigram, and
  as that of ``MOST_TRIGRAMS`` trigrams at most;
* the likelihood of the declared language and of the address suffix, given the language;
* the prior of the host, smoothed towards that of its parent domain, which is smoothed
  towards that of all rows.

The last two come from grouped aggregations over the languages that the texts alone point
to, smoothed by ``STRENGTH`` pseudo-rows; a row's own vote is taken out before its host and
domain speak to it. A row is accepted if the text has letters and the posterior of the best
language is at least ``min_confidence``. It is rejected without letters, or if the text alone
has a language with a posterior of ``SURE`` but the evidence together stays below
``min_confidence``, so that it speaks against itself. Rows that are neither are undetermined:
short texts, or any texts where no row has a declared language to learn from.

Every language that a training row names is modelled, by its primary subtag: ``en-us`` and
``en_GB`` are ``en``. The text model has ``2 ** BITS`` numbers (64 KB) per language and goes to
every task; work and the evidence kept per row grow with the number of languages, votes per
host, domain and so on with the languages that occur there.

Null or missing evidence says nothing. Empty text is not accepted. Rows that repeat are voters
and results of their own. Without a training row nothing is accepted. An empty table gives an
empty result. Only the named columns are read.
"""

from __future__ import annotations

import re
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.shared import Batches, map_batches, on_group, out_batch, staged, utf8
from millrace.session import workspace

BITS = 14
#: Languages that a counting task holds at a time, and numbers handled in one step.
HELD = 64
STEP_NUMBERS = 1_000_000
TEMPER = 0.15
MOST_TRIGRAMS = 400
STRENGTH = 20.0
MIN_CONFIDENCE = 0.5
SURE = 0.99

_HASH = np.uint32(2654435761)
_LETTER = re.compile(r"[^\W\d_]")


def trigrams(text: bytes) -> np.ndarray:
    """Hashed byte trigrams of the text between two spaces, A-Z lowered."""
    codes = np.frombuffer(b" " + b" ".join(text.lower().split()) + b" ", dtype=np.uint8)
    codes = codes.astype(np.uint32)
    packed = (codes[:-2] << 16) | (codes[1:-1] << 8) | codes[2:]
    return (packed * _HASH) >> np.uint32(32 - BITS)


def primary_subtag(lang: Column) -> Column:
    """``pt-BR`` and ``pt_pt`` are ``pt``; null without a name. ``x-...`` and ``i-...`` stay whole."""
    name = F.lower(F.trim(lang.cast("string")))
    found = F.regexp_extract(name, "^([^-_]{2,})[-_]", 1)
    return F.when(found != "", found).when(name != "", name)


def train_text_model(
    docs: DataFrame, text_col: str = "text", lang_col: str = "lang"
) -> tuple[list[str], np.ndarray]:
    """Language names and the log-probability of every trigram number in each."""
    rows = docs.select(
        primary_subtag(F.col(f"`{lang_col}`")).alias("lang"), utf8(text_col).alias("text")
    ).filter("lang is not null")
    learned = (
        map_batches(rows, _count_trigrams, "lang string, at int, n long")
        .groupBy("lang", "at")
        .agg(F.sum("n").alias("n"))
        .groupBy("lang")
        .applyInArrow(on_group(_log_probabilities), "lang string, log_p binary")
        .toArrow()
    )  # one row per language
    found = dict(zip(learned.column("lang").to_pylist(), learned.column("log_p").to_pylist()))
    languages = sorted(found)
    log_p = np.zeros((len(languages), 1 << BITS), dtype=np.float32)
    for i, name in enumerate(languages):
        log_p[i] = np.frombuffer(found.pop(name), dtype="<f4")
    return languages, log_p


def _count_trigrams(batches: Batches) -> Batches:
    schema = pa.schema([("lang", pa.string()), ("at", pa.int32()), ("n", pa.int64())])
    counts: dict[str, np.ndarray] = {}

    def counted() -> Batches:
        for name, n in counts.items():
            at = np.flatnonzero(n)
            if not len(at):  # a language without any trigram is one as well
                at = np.zeros(1, dtype=np.int64)
            yield out_batch(schema, [name] * len(at), pa.array(at.astype(np.int32)), pa.array(n[at]))
        counts.clear()

    for batch in batches:
        for name, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
            if name not in counts:
                if len(counts) >= HELD:
                    yield from counted()
                counts[name] = np.zeros(1 << BITS, dtype=np.int64)
            counts[name] += np.bincount(trigrams(text), minlength=1 << BITS)
    yield from counted()


def _log_probabilities(rows: pa.Table) -> pa.Table:
    smooth = np.full(1 << BITS, 0.5)
    smooth[rows.column("at").to_numpy()] += rows.column("n").to_numpy()
    log_p = np.log(smooth / smooth.sum()).astype("<f4")
    schema = pa.schema([("lang", pa.string()), ("log_p", pa.binary())])
    return pa.table([[rows.column("lang")[0].as_py()], [log_p.tobytes()]], schema=schema)


def identify(
    rows: DataFrame,
    model: tuple[list[str], np.ndarray],
    min_confidence: float = MIN_CONFIDENCE,
) -> DataFrame:
    """``id``, ``language``, ``confidence``, ``text_language``, ``accepted``, ``rejected`` of every row.

    ``rows``: ``id`` of any type, ``text`` (UTF-8 bytes), ``declared``, ``suffix``, ``host``
    and ``domain`` (strings; null where unknown).
    """
    spark = rows.sparkSession
    languages, log_p = model
    sent = spark.sparkContext.broadcast((len(languages), np.ascontiguousarray(log_p.T)))
    id_type = rows.schema["id"].dataType.simpleString()
    facts = "declared string, suffix string, host string, domain string"
    voted = staged(
        map_batches(
            rows.select("id", "declared", "suffix", "host", "domain", "text"),
            partial(_text_evidence, sent),
            f"id {id_type}, {facts}, evidence array<double>, vote int, letters boolean",
        ),
        workspace(spark, "language-votes"),
    )
    if not languages:
        unknown = F.lit(None).cast("string")
        return voted.select(
            "id",
            unknown.alias("language"),
            F.lit(0.0).alias("confidence"),
            unknown.alias("text_language"),
            F.lit(False).alias("accepted"),
            (~F.col("letters")).alias("rejected"),
        )
    known = voted.filter("vote is not null")
    overall = {r["vote"]: r["n"] for r in known.groupBy("vote").agg(F.count("*").alias("n")).collect()}
    of_language = np.array([float(overall.get(i, 0)) for i in range(len(languages))])
    result = voted
    for key in ("declared", "suffix", "host", "domain"):
        result = _with_counts(result, known, key)
    fused = spark.sparkContext.broadcast((languages, of_language))
    return map_batches(
        result,
        partial(_fuse, fused, min_confidence),
        f"""id {id_type}, language string, confidence double, text_language string,
            accepted boolean, rejected boolean""",
    )


def _with_counts(rows: DataFrame, known: DataFrame, key: str) -> DataFrame:
    """Each row with the votes of all rows that share its ``key``, for the languages that have any."""
    table = staged(
        known.filter(F.col(key).isNotNull())
        .groupBy(key, "vote")
        .agg(F.count("*").cast("double").alias("n"))
        .groupBy(key)
        .agg(
            F.collect_list(F.struct("vote", "n")).alias("votes"),
            F.sum("n").alias(f"{key}_total"),
        )
        .select(
            key,
            F.col("votes.vote").alias(f"{key}_votes"),
            F.col("votes.n").alias(f"{key}_counts"),
            f"{key}_total",
        ),
        workspace(rows.sparkSession, f"language-{key}"),
    )
    # Both sides come straight from files or shuffles of their own: hot keys can be split.
    return rows.join(table, key, "left")


def _fuse(sent, min_confidence: float, batches: Batches) -> Batches:
    languages, of_language = sent.value
    n, total = len(languages), of_language.sum()
    shares = (of_language + 1.0) / (total + n)
    step = max(1, STEP_NUMBERS // n)
    for whole in batches:
        for start in range(0, whole.num_rows, step):
            batch = whole.slice(start, step)
            rows = np.arange(batch.num_rows)
            votes = batch.column("vote").to_pylist()
            voters = np.array([i for i, v in enumerate(votes) if v is not None], dtype=np.int64)
            own = np.zeros((len(rows), 1))
            own[voters] = 1.0

            def of_others(key: str) -> tuple[np.ndarray, np.ndarray]:
                """Votes of the other rows with the same key: per language, and all."""
                counts = np.zeros((len(rows), n))
                named, found = batch.column(f"{key}_votes"), batch.column(f"{key}_counts")
                sizes = pc.fill_null(pc.list_value_length(named), 0).to_numpy(zero_copy_only=False)
                counts[np.repeat(rows, sizes), named.flatten().to_numpy()] = found.flatten().to_numpy()
                counts[voters, [votes[i] for i in voters]] -= 1.0
                all_votes = pc.fill_null(batch.column(f"{key}_total"), 0.0).to_numpy(zero_copy_only=False)
                return np.maximum(counts, 0.0), np.maximum(all_votes[:, None] - own, 0.0)

            scores = batch.column("evidence").flatten().to_numpy().reshape(len(rows), n).copy()
            # The best language of the text alone has evidence zero.
            sure = 1 / np.exp(scores).sum(axis=1) >= SURE
            counts, others = of_others("domain")
            domain = (counts + STRENGTH * shares) / (others + STRENGTH)
            counts, others = of_others("host")
            scores += np.log((counts + STRENGTH * domain) / (others + STRENGTH))
            for key in ("declared", "suffix"):
                # P(key | language), smoothed towards P(key).
                counts, others = of_others(key)
                spread = np.maximum(others, 1.0) / max(1.0, total)
                likelihood = (counts + STRENGTH * spread) / (of_language + STRENGTH)
                told = batch.column(key).is_valid().to_numpy(zero_copy_only=False)
                scores += np.where(told[:, None], np.log(likelihood), 0.0)
            best = scores.argmax(axis=1)
            confidence = 1 / np.exp(scores - scores[rows, best][:, None]).sum(axis=1)
            letters = batch.column("letters").to_numpy(zero_copy_only=False)
            schema = pa.schema(
                [
                    ("id", batch.column("id").type),
                    ("language", pa.string()),
                    ("confidence", pa.float64()),
                    ("text_language", pa.string()),
                    ("accepted", pa.bool_()),
                    ("rejected", pa.bool_()),
                ]
            )
            yield out_batch(
                schema,
                batch.column("id"),
                [languages[i] for i in best],
                pa.array(confidence),
                [None if v is None else languages[v] for v in votes],
                pa.array(letters & (confidence >= min_confidence)),
                pa.array(~letters | (sure & (confidence < min_confidence))),
            )


def _text_evidence(sent, batches: Batches) -> Batches:
    n, by_trigram = sent.value
    step = max(1, STEP_NUMBERS // max(1, n))
    facts = ("declared", "suffix", "host", "domain")
    for whole in batches:
        schema = pa.schema(
            [
                ("id", whole.column("id").type),
                *((c, pa.string()) for c in facts),
                ("evidence", pa.list_(pa.float64())),
                ("vote", pa.int32()),
                ("letters", pa.bool_()),
            ]
        )
        for start in range(0, whole.num_rows, step):
            batch = whole.slice(start, step)
            evidence = np.zeros((batch.num_rows, n))
            votes, letters = [], []
            for i, text in enumerate(batch.column("text").to_pylist()):
                has_letters = bool(_LETTER.search(text.decode("utf-8", "replace")))
                letters.append(has_letters)
                if not has_letters or not n:
                    votes.append(None)
                    continue
                numbers = trigrams(text)
                own = evidence[i]
                for k in range(0, len(numbers), step):
                    own += by_trigram[numbers[k : k + step]].sum(axis=0, dtype=np.float64)
                own *= TEMPER * min(len(numbers), MOST_TRIGRAMS) / max(1, len(numbers))
                own -= own.max()
                votes.append(int(own.argmax()))
            ends = pa.array(np.arange(batch.num_rows + 1, dtype=np.int32) * n, pa.int32())
            lists = pa.ListArray.from_arrays(ends, pa.array(evidence.ravel()))
            passed = (batch.column(c).cast(pa.string()) for c in facts)
            yield out_batch(schema, batch.column("id"), *passed, lists, votes, letters)


_LANG = re.compile(rb"\slang\s*=\s*[\"']?([A-Za-z]{2,3})", re.I)
_HTML = re.compile(rb"<html", re.I)
_HIDES = re.compile(rb"<(?:(script|style|head|nav)\b|!--)", re.I)
_SHOWS = {
    None: re.compile(rb"-->"),
    **{k: re.compile(rb"</" + k + rb"\s*>", re.I) for k in (b"script", b"style", b"head", b"nav")},
}
_TAG = re.compile(rb"<[^>]*>")


def declared_language(html: bytes) -> str | None:
    """The language that an ``html`` tag names, in one pass."""
    at = 0
    while found := _HTML.search(html, at):
        at = html.find(b">", found.end())
        at = len(html) if at < 0 else at
        if lang := _LANG.search(html, found.end(), at):
            return lang[1].decode().lower()
    return None


def visible_text(html: bytes) -> bytes:
    """The page without tags, comments and the content of tags that show no text of it.

    One pass: an opening without its closing hides nothing, and of each kind the rest of the
    page is searched in vain once at most.
    """
    parts, at, look, never_shown = [], 0, 0, set()
    while found := _HIDES.search(html, look):
        kind = found[1].lower() if found[1] else None
        look = found.end()
        if kind in never_shown:
            continue
        end = _SHOWS[kind].search(html, look)
        if end is None:
            never_shown.add(kind)
            continue
        parts.append(html[at : found.start()])
        at = look = end.end()
    shown = b" ".join([*parts, html[at:]])
    last = shown.rfind(b">") + 1  # behind it no tag is complete
    return _TAG.sub(b" ", shown[:last]) + shown[last:]


def page_evidence(pages: DataFrame, id_col: str, url_col: str, html_col: str) -> DataFrame:
    """Rows for ``identify`` from web pages: visible text, declared language, address parts."""
    host = F.lower(F.regexp_extract(F.col(f"`{url_col}`").cast("string"), r"^[A-Za-z][\w+.-]*://([^/:?#]+)", 1))
    rows = pages.select(
        F.col(f"`{id_col}`").alias("id"),
        F.when(host != "", host).alias("host"),
        utf8(html_col).alias("html"),
    )
    id_type = rows.schema["id"].dataType.simpleString()
    read = map_batches(rows, _visible, f"id {id_type}, host string, declared string, text binary")
    labels = F.split("host", r"\.")
    return read.select(
        "id",
        "text",
        "declared",
        "host",
        F.when(F.size(labels) > 1, F.element_at(labels, -1)).alias("suffix"),
        F.when(
            F.size(labels) > 1, F.array_join(F.slice(labels, -2, 2), ".")
        ).alias("domain"),
    )


def _visible(batches: Batches) -> Batches:
    for batch in batches:
        declared, texts = [], []
        for html in batch.column("html").to_pylist():
            declared.append(declared_language(html))
            texts.append(visible_text(html))
        schema = pa.schema(
            [
                ("id", batch.column("id").type),
                ("host", pa.string()),
                ("declared", pa.string()),
                ("text", pa.binary()),
            ]
        )
        yield out_batch(schema, batch.column("id"), batch.column("host").cast(pa.string()), declared, texts)
