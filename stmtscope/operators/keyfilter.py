"""Membership filters of key columns, as small tables that merge and join.

A filter is a blocked Bloom filter: a key owns a few bits of one 64-bit word, so a filter is a
table of (word, bits), filters of one size merge by OR, and a look-up is one join on the word.  A key
that is in never misses; one that is not passes with a probability of about 1 % at
``BITS_PER_KEY``, so what passes is looked up exactly.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS_PER_KEY = 16
PROBES = 4
SALT = 0x5EED
# 2^20 words, 16 MB as rows: the size up to which a filter is broadcast, whatever the number of keys.
MAX_BROADCAST_LOG_WORDS = 20
_WORD, _MASK = "_filter_word", "_filter_mask"


def log_words_for(n_keys: int) -> int:
    """Binary logarithm of the number of words of a filter of ``n_keys`` keys."""
    return max(1, math.ceil(math.log2(max(1, n_keys) * BITS_PER_KEY / 64)))


def word_of(key: Sequence[str], log_words: int | Column) -> Column:
    """Number of the word that holds the key: the upper bits of its hash, so that a word of a
    filter is two words of the next larger one."""
    shift = F.lit(64) - log_words
    return F.call_function("shiftrightunsigned", F.xxhash64(*key), shift.cast("int"))


def mask_of(key: Sequence[str]) -> Column:
    """The key's bits."""
    chosen = F.xxhash64(*key, F.lit(SALT))
    mask = None
    for i in range(PROBES):
        place = F.call_function("shiftrightunsigned", chosen, F.lit(6 * i)).bitwiseAND(F.lit(63)).cast("int")
        bit = F.call_function("shiftleft", F.lit(1).cast("long"), place)
        mask = bit if mask is None else mask.bitwiseOR(bit)
    return mask


def key_filter(df: DataFrame, key: Sequence[str], log_words: int) -> DataFrame:
    """(word, bits) of all keys; most of the work is done before the shuffle."""
    marked = df.select(word_of(key, log_words).alias("word"), mask_of(key).alias("mask"))
    return marked.groupBy("word").agg(F.bit_or("mask").alias("bits"))


def counted_filter(df: DataFrame, key: Sequence[str], log_words: int) -> DataFrame:
    """(word, bits, most) of all keys, where ``most`` is how often a word's most frequent key occurs.
    One shuffle, of the keys alone, serves the filter and the search for repeated keys: equal keys
    have one word, so both groupings find their rows in place."""
    word = word_of(key, log_words)
    dealt = df.select(*key).repartition(word).select(*key, word.alias("word"))
    counted = dealt.groupBy("word", *key).agg(F.count("*").alias("n"))
    return counted.groupBy("word").agg(F.bit_or(mask_of(key)).alias("bits"), F.max("n").alias("most"))


def might_be_in(df: DataFrame, key: Sequence[str], words: DataFrame, log_words: int) -> DataFrame:
    """Rows whose key the filter may hold.  A broadcast of ``words`` keeps ``df`` in place."""
    holds = (F.col(_WORD) == F.col("word")) & (F.col("bits").bitwiseAND(F.col(_MASK)) == F.col(_MASK))
    marked = df.withColumns({_WORD: word_of(key, log_words), _MASK: mask_of(key)})
    return marked.join(words, holds, "left_semi").drop(_WORD, _MASK)


def found_in_filters(df: DataFrame, key: Sequence[str], filters: DataFrame, sizes: Sequence[int]) -> DataFrame:
    """(key, ``of``) for every filter ``of`` that may hold the key.

    ``filters`` has (of, log_words, word, bits) of any number of filters; ``sizes`` are their
    distinct ``log_words``, at most 62, and a key is looked up once per size.
    """
    # The word comes first: rows are sorted by it, and the size of a filter tells few of them apart.
    # Of the keys only what they are made from is shuffled; words and bits are computed where they meet.
    if len(sizes) == 1:
        marked, same = df.select(*key), word_of(key, sizes[0]) == F.col("word")
    else:
        marked = df.select(*key, F.explode(F.array(*[F.lit(s) for s in sizes])).alias("_size"))
        same = (word_of(key, F.col("_size")) == F.col("word")) & (F.col("_size") == F.col("log_words"))
    holds = F.col("bits").bitwiseAND(mask_of(key)) == mask_of(key)
    return marked.join(filters, same & holds).select(*key, "of")
