"""Tests of many incoming keys against big stores, with a filter of the keys in front of the shuffle.

Small sets of keys are broadcast by Spark anyway. Beyond that a join would shuffle the whole store, although few of
its rows match. Here the keys set bits in a table of 64-bit words of bounded size, a blocked Bloom filter; the
store meets it in a broadcast join, and what passes is joined exactly. The filter loses no match, and a larger set
of keys only lets more rows through to the exact join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom.operators.ordinals import first_per_key
from feedloom.operators.tables import KEY
from feedloom.session import materialise

#: The most words of a filter: 2 ** 20, which is 8 MB, and some 30 MB as the broadcast hash table.
MOST_WORDS = 20
#: Keys per word that a filter is sized for; with four bits each about one row in a hundred passes by chance.
KEYS_PER_WORD = 4


def _place(key: Column, words: int) -> Column:
    return F.shiftrightunsigned(F.xxhash64(key), 64 - words) if words else F.lit(0).cast("long")


def _bits(key: Column) -> Column:
    """Four bits of a word, from a hash of their own."""
    other = F.xxhash64(key, F.lit("bits"))
    one = F.lit(1).cast("long")
    bits = None
    for step in range(4):
        bit = F.call_function("shiftleft", one, F.shiftrightunsigned(other, 6 * step).bitwiseAND(F.lit(63)).cast("int"))
        bits = bit if bits is None else bits.bitwiseOR(bit)
    return bits


def key_filter(keys: DataFrame, key: str = KEY, most_words: int = MOST_WORDS) -> tuple[DataFrame, int]:
    """``(place, word)`` rows of a filter of the keys, and the binary logarithm of its number of words."""
    wanted = keys.select(key).filter(F.col(key).isNotNull())
    n = wanted.count()
    words = min(most_words, max(0, (n // KEYS_PER_WORD).bit_length()))
    filled = wanted.groupBy(_place(F.col(key), words).alias("_place")).agg(F.bit_or(_bits(F.col(key))).alias("_word"))
    return materialise(filled, "key-filter"), words


def possible(store: DataFrame, found: tuple[DataFrame, int], key: str = KEY) -> DataFrame:
    """The rows of the store whose key may be among those of the filter: all that are, and a few others.

    The broadcast side has at most ``2 ** MOST_WORDS`` rows of two integers.
    """
    words, size = found
    met = store.withColumn("_place", _place(F.col(key), size)).join(F.broadcast(words), "_place")
    bits = _bits(F.col(key))
    return met.filter(F.col("_word").bitwiseAND(bits) == bits).select(*store.columns)


def rows_of(store: DataFrame, keys: DataFrame, key: str = KEY) -> DataFrame:
    """The rows of the store with one of the keys, as ``tables.rows_of``."""
    return possible(store, key_filter(keys, key), key).join(keys.select(key), key, "left_semi").select(*store.columns)


def existing_keys(keys: DataFrame, tables: Sequence[DataFrame], key: str = KEY) -> DataFrame:
    """The distinct given keys that any of the tables holds, as ``tables.existing_keys``; one filter serves all."""
    found = key_filter(keys, key)
    held = None
    for table in tables:
        part = possible(table.select(key), found, key)
        held = part if held is None else held.unionByName(part)
    return held.distinct().join(keys.select(key), key, "left_semi")


def new_rows(rows: DataFrame, stored: DataFrame, order: str, key: str = KEY) -> DataFrame:
    """The first row of each key that is not stored yet, as ``tables.new_rows``."""
    held = possible(stored.select(key), key_filter(rows, key), key)
    return first_per_key(rows.join(held, key, "left_anti").select(*rows.columns), key, order)


def closed_keys(stored: DataFrame, current: DataFrame, key: str = KEY) -> DataFrame:
    """Stored active keys the feed no longer has, as ``tables.closed_keys``.

    Here the feed is filtered by the stored keys, where the feed is the larger side.
    """
    active = stored.filter((F.col("status") == "ACTIVE") & F.col(key).isNotNull()).select(key).distinct()
    active = materialise(active, "active")
    return active.join(possible(current.select(key), key_filter(active, key), key), key, "left_anti")
