"""Tokenize texts piece by piece, remembering the pieces.

Both tokenizers used here cut a text into words before they merge bytes, and neither cut
can reach across the boundaries chosen below, so the tokens of a text are the tokens of
its pieces in order. Pieces repeat, so most are looked up. Whatever does not satisfy the
stated conditions is given to the library whole.
"""

from __future__ import annotations

import os
import re
import string
from collections.abc import Iterable
from itertools import chain, filterfalse, pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Pieces remembered per worker; twice as many at most are held. Ids take more room than counts.
REMEMBERED, REMEMBERED_IDS = 500_000, 200_000

#: One of these behind a letter and before white space or the end is a word of its own.
_STOP = re.compile(rb"(?<=[A-Za-z])[.,!?](?=[ \n]|\Z)")
#: Added to a count to mark a piece that touches white space.
_UNCLEAN = 1 << 40
#: Longer pieces are not remembered from one step to the next.
_LONG = 256


def open_tokenizer(path: str):
    """A fast tokenizer from its file, on one thread: the task has one core."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


class _Memory(dict):
    """A dictionary of bounded size: what was not asked for lately is forgotten."""

    def __init__(self) -> None:
        super().__init__()
        self.before: dict = {}

    def missing(self, keys: set) -> list:
        """Make room, bring known ``keys`` to the front, and return the others."""
        if len(self) > REMEMBERED:
            self.before = {k: v for k, v in self.items() if len(k) <= _LONG}
            self.clear()
        new = []
        for k in keys:
            if k in self:
                continue
            if k in self.before:
                self[k] = self.before[k]
            else:
                new.append(k)
        return new

    def forget_long(self, keys: list) -> None:
        for k in keys:
            if len(k) > _LONG:
                self.pop(k, None)


class PieceCounts:
    """Token counts of a byte-level BPE whose words take one space in front.

    A text is cut in front of every space that stands between two characters other than
    white space. No word of the tokenizer's pattern crosses such a place, and none looks
    further ahead than the character behind it. Stops (see ``_STOP``) are counted apart.
    """

    def __init__(self, tokenizer) -> None:
        self.tokenizer, self.pieces, self.words = tokenizer, _Memory(), _Memory()
        self.single_stops = all(len(tokenizer.encode(x).ids) == 1 for x in ".,!?")
        self.opens = _marked(tokenizer, lambda token: token.startswith("Ġ"))

    def count(self, texts: list[bytes]) -> list[int]:
        """Tokens of each text (UTF-8)."""
        if self.single_stops:
            bare, totals = map(list, zip(*[_STOP.subn(b"", t) for t in texts], strict=True))
        else:
            bare, totals = texts, [0] * len(texts)
        cut = [t.split(b" ") for t in bare]
        new = self._learn(set().union(*cut))
        look = self.pieces.__getitem__
        exact = []
        for i, pieces in enumerate(cut):
            total = sum(map(look, pieces[1:]))
            if total + look(pieces[0]) >= _UNCLEAN:
                exact.append(_merged(pieces))
            else:
                exact.append([_text(pieces[0])])
                totals[i] += total
        self.pieces.forget_long(new)
        counts = iter(self._counts([w for words in exact for w in words]))
        return [total + sum(next(counts) for _ in e) for total, e in zip(totals, exact, strict=True)]

    def _learn(self, pieces: set[bytes]) -> list[bytes]:
        """Counts of new pieces, each with a space in front."""
        lines: dict[bytes, list[str]] = {}
        plain = []
        new = self.pieces.missing(pieces)
        for piece in new:
            if piece.isalpha():
                plain.append(piece)
                continue
            text = _text(piece)
            if not text or text[0].isspace() or text[-1].isspace():
                self.pieces[piece] = _UNCLEAN
                continue
            parts = text.split("\n")
            if all(x and not x[0].isspace() and not x[-1].isspace() for x in parts):
                lines[piece] = [" \n"[k > 0] + x for k, x in enumerate(parts)]
            else:
                lines[piece] = [" " + text]
        for start in range(0, len(plain), 8192):
            some = plain[start : start + 8192]
            ids = _joined_ids(self.tokenizer, b" " + b" ".join(some))
            first = np.append(np.flatnonzero(self.opens[ids]), len(ids))
            self.pieces.update(zip(some, np.diff(first).tolist(), strict=True))
        counts = iter(self._counts([w for words in lines.values() for w in words]))
        for piece, words in lines.items():
            self.pieces[piece] = sum(next(counts) for _ in words)
        return new

    def _counts(self, words: list[str]) -> list[int]:
        known = self.words
        new = known.missing(set(words))
        for start in range(0, len(new), 8192):
            some = new[start : start + 8192]
            found = self.tokenizer.encode_batch_fast(some, add_special_tokens=False)
            known.update(zip(some, map(len, found), strict=True))
        counts = [known[w] for w in words]
        known.forget_long(new)
        return counts


def _marked(tokenizer, marks) -> np.ndarray:
    """By token id, whether its text has the mark."""
    flags = np.zeros(max(tokenizer.get_vocab().values()) + 1, dtype=bool)
    flags[[i for token, i in tokenizer.get_vocab().items() if marks(token)]] = True
    return flags


def _joined_ids(tokenizer, text: bytes) -> np.ndarray:
    found = tokenizer.encode_batch_fast([text.decode("ascii")], add_special_tokens=False)
    return np.array(found[0].ids, dtype="<u4")


def _text(piece: bytes) -> str:
    return piece.decode("utf-8", "replace")


def _merged(pieces: list[bytes]) -> list[str]:
    """Pieces joined until no cut touches white space."""
    out = [_text(pieces[0])]
    for piece in map(_text, pieces[1:]):
        if piece and not piece[0].isspace() and out[-1] and not out[-1][-1].isspace():
            out.append(" " + piece)
        else:
            out[-1] += " " + piece
    return out


#: Words that the steps before the model only lower: a-z and the letters of U+00C0 to U+00FF.
_PLAIN = re.compile(rb"(?:[a-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])+")
_ACCENTED = re.compile(rb"\xc3[\x80-\x96\x98-\xb6\xb8-\xbf]")
_MARKS = string.punctuation.encode()
#: Words joined for one call of the tokenizer, whose result then stays in the processor's cache.
_JOINED = 512


class PieceIds:
    """Token ids of a lower-casing BPE that drops white space, as little-endian 32-bit numbers.

    A text is cut at ASCII white space. ASCII letters are lowered beforehand, as the tokenizer
    would do, unless the text holds what that could change: marks that combine with letters,
    or the text of a special token. ASCII marks at the end of a piece, behind an ASCII letter or
    digit or a letter of U+00C0 to U+00FF, are a word of their own, so the piece has the ids of
    the rest and those of the marks.
    """

    def __init__(self, tokenizer) -> None:
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        self.tokenizer = tokenizer
        self.pieces: dict[bytes, bytes] = {}
        self.before: dict[bytes, bytes] = {}
        self.letters = Tokenizer.from_str(tokenizer.to_str())
        self.letters.normalizer = normalizers.Sequence([])
        self.letters.pre_tokenizer = pre_tokenizers.Sequence(
            [
                pre_tokenizers.WhitespaceSplit(),
                pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False),
            ]
        )
        self.closes = _marked(tokenizer, lambda token: token.endswith("</w>"))

    def ids(self, texts: list[bytes]) -> list[bytes]:
        """The ids of each text (UTF-8), without special tokens added."""
        lowered = [
            t if b"<|" in t or b"\xcc" in t or b"\xcd" in t else t.lower() for t in texts
        ]
        # Arrow cuts the texts and numbers the different pieces: each is looked up once a step.
        cut = pc.ascii_split_whitespace(pa.array(lowered, pa.binary()).view(pa.string()))
        numbered = cut.flatten().dictionary_encode()
        pieces = numbered.dictionary.view(pa.binary()).to_numpy(zero_copy_only=False).tolist()
        new = self._learn(pieces)
        look = list(map(self.pieces.__getitem__, pieces)).__getitem__
        numbers, ends = numbered.indices.to_numpy(), cut.offsets.to_pylist()
        ids = [b"".join(map(look, numbers[a:b].tolist())) for a, b in pairwise(ends)]
        for k in new:
            if len(k) > _LONG:
                del self.pieces[k]
        return ids

    def _learn(self, pieces: list[bytes]) -> set[bytes]:
        """Ids of the pieces that are not known; what was not asked for lately is forgotten."""
        if len(self.pieces) > REMEMBERED_IDS:
            self.before, self.pieces = self.pieces, {}
        new = self._unknown(pieces)
        ended = {}
        for p in filterfalse(bytes.isalpha, new):
            bare = p.rstrip(_MARKS)
            if len(bare) < len(p) and (bare[-1:].isalnum() or _ACCENTED.fullmatch(bare[-2:])):
                if b"<|" not in p:
                    ended[p] = bare
        new.difference_update(ended)
        new |= self._unknown(chain(ended.values(), [p[len(bare) :] for p, bare in ended.items()]))
        plain, others = [], []
        for p in new:
            (plain if p.isalpha() or _PLAIN.fullmatch(p) else others).append(p)
        for start in range(0, len(plain), _JOINED):
            some = plain[start : start + _JOINED]
            text = b" ".join(some).decode("utf-8").lower()
            found = self.letters.encode_batch_fast([text], add_special_tokens=False)
            ids = np.array(found[0].ids, dtype="<u4")
            ends = (4 * np.flatnonzero(self.closes[ids]) + 4).tolist()
            flat = ids.tobytes()
            known = zip(some, [0, *ends[:-1]], ends, strict=True)
            self.pieces.update((p, flat[a:b]) for p, a, b in known)
        for start in range(0, len(others), 8192):
            some = others[start : start + 8192]
            self.pieces.update(zip(some, self._encoded(some), strict=True))
        ids = self.pieces
        for p, bare in ended.items():
            ids[p] = ids[bare] + ids[p[len(bare) :]]
        return new.union(ended)

    def _unknown(self, pieces: Iterable[bytes]) -> set[bytes]:
        """Pieces that are not known; those known before are known again."""
        new = set(filterfalse(self.pieces.__contains__, pieces))
        again = list(filter(self.before.__contains__, new))
        self.pieces.update(zip(again, map(self.before.__getitem__, again)))
        new.difference_update(again)
        return new

    def _encoded(self, pieces: list[bytes]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast([_text(p) for p in pieces], add_special_tokens=False)
        return [np.array(e.ids, dtype="<u4").tobytes() for e in found]


_open: dict[tuple[type, str], object] = {}


def shared_pieces(kind: type, path: str):
    """The one instance of ``kind`` for a tokenizer file in this Python worker."""
    if (kind, path) not in _open:
        _open[kind, path] = kind(open_tokenizer(path))
    return _open[kind, path]
