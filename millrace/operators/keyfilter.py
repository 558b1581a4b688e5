"""A bounded filter that keeps most rows of a large table out of a join's shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Words of 64 bits in the largest filter: 16 MB of them.
MOST_WORDS = 2**20
_WORD, _BIT, _BITS = "_millrace_word", "_millrace_bit", "_millrace_bits"


def _hashed(df: DataFrame, key: str, words: int) -> DataFrame:
    place = F.pmod(F.xxhash64(F.col(f"`{key}`")), F.lit(64 * words))
    return df.withColumn(_WORD, F.shiftright(place, 6)).withColumn(
        _BIT, (place % 64).cast("int")
    )


def words_for(n_keys: int) -> int:
    """Words of a filter for so many keys: 32 bits a key, within the bound."""
    words = 256
    while words < MOST_WORDS and words * 64 < 32 * n_keys:
        words *= 2
    return words


def _bits(keys: DataFrame, key: str, words: int) -> DataFrame:
    return (
        _hashed(keys.select(f"`{key}`").filter(F.col(f"`{key}`").isNotNull()), key, words)
        .groupBy(_WORD)
        .agg(F.bit_or(F.expr(f"shiftleft(1L, {_BIT})")).alias(_BITS))
    )


def possible(
    df: DataFrame, keys: DataFrame, key: str, words: int = MOST_WORDS
) -> DataFrame:
    """Rows of ``df`` whose ``key`` may be among ``keys``; surely every row whose key is.

    A bit of a table of ``words`` 64-bit words is set for the hash of each key (a Bloom filter
    with one hash function). Only words with a bit set are rows of that table, so it is never
    larger than the keys nor than ``MOST_WORDS`` words, and is broadcast; rows whose bit is not
    set are dropped without a shuffle. With many more keys than bits the filter lets
    everything pass, so what follows must still be an exact join.
    """
    probed = _hashed(df, key, words).join(F.broadcast(_bits(keys, key, words)), _WORD)
    return probed.filter(F.expr(f"shiftright({_BITS}, {_BIT}) & 1L = 1L")).drop(_WORD, _BIT, _BITS)


def anti_join(
    df: DataFrame, keys: DataFrame, key: str, words: int = MOST_WORDS
) -> DataFrame:
    """Rows of ``df`` whose ``key`` is not among ``keys``; a NULL key is among none.

    Rows that the filter of ``possible`` clears are passed on where they lie; only the others
    are shuffled, for an exact merge join. ``df`` is read once for each of the two. What is
    dropped may grow with ``df``, so the plan is the same at every size.
    """
    probed = _hashed(df, key, words).join(F.broadcast(_bits(keys, key, words)), _WORD, "left")
    marked = F.coalesce(F.expr(f"shiftright({_BITS}, {_BIT}) & 1L = 1L"), F.lit(False))
    own = (_WORD, _BIT, _BITS)
    rest = probed.filter(marked).drop(*own).join(keys.select(f"`{key}`").hint("merge"), key, "left_anti")
    return probed.filter(~marked).drop(*own).unionByName(rest)
