"""Bloom filters as small tables of 64-bit words, made and tested with DataFrame functions.

A hash picks one word and two of its bits, so a filter is a table (word, bits)
and testing it is one broadcast join. The number of words is bounded by
`max_words`, which bounds what is broadcast at 16 bytes a word whatever the
input size. A fuller filter passes more rows to the exact step behind it and
never loses one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# 2^20 words are 16 MB as rows. At two bits a hash they stay selective up to
# about 30 million hashes for filters of repeated hashes.
MAX_WORDS = 1 << 20

# Bits of filter per hash, below the bound.
BITS_PER_HASH = 8


def words_for(n_hashes: int, max_words: int = MAX_WORDS) -> int:
    """A power of two of words for so many hashes."""
    wanted = n_hashes * BITS_PER_HASH // 64
    return min(1 << wanted.bit_length(), max_words)


def _word(hash_: Column, n_words: int) -> Column:
    return hash_.bitwiseAND(F.lit(n_words - 1))


def _bits(hash_: Column) -> list[Column]:
    """Two bit numbers from the top of the hash, apart from what picks the word."""
    return [F.shiftrightunsigned(hash_, at).bitwiseAND(F.lit(63)).cast("int") for at in (58, 52)]


def build(hashes: DataFrame, n_words: int, at_least: int = 1) -> DataFrame:
    """(word, bits) from one column of hashes: the bits that at least so many rows have set.

    With `at_least=2` this is the second filter of a two-pass scheme: a hash that
    occurs twice has set both its bits twice, so it is always found again, and a
    hash that occurs once is found only if others have set both its bits.
    """
    hash_ = F.col(hashes.columns[0])
    bits = F.explode(F.array_distinct(F.array(*_bits(hash_))))
    hits = hashes.select(_word(hash_, n_words).alias("word"), bits.alias("bit"))
    if at_least > 1:
        counted = hits.groupBy("word", "bit").agg(F.count(F.lit(1)).alias("n"))
        hits = counted.filter(F.col("n") >= at_least)
    return hits.groupBy("word").agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("bits"))


def tested(df: DataFrame, hash_: Column, words: DataFrame, n_words: int, name: str) -> DataFrame:
    """`df` with a boolean column `name`, false only where the hash is not in the filter.

    The join is a broadcast of at most `n_words` rows; no row of `df` moves.
    A null hash tests false.
    """
    word, bits = f"{name}_word", f"{name}_bits"
    small = words.select(F.col("word").alias(word), F.col("bits").alias(bits))
    joined = df.join(F.broadcast(small), _word(hash_, n_words) == F.col(word), "left")
    both = [F.getbit(F.col(bits), bit) == 1 for bit in _bits(hash_)]
    return joined.withColumn(name, F.coalesce(both[0] & both[1], F.lit(False))).drop(word, bits)


def split(df: DataFrame, keys: DataFrame, key: str, max_words: int = MAX_WORDS) -> tuple[DataFrame, DataFrame]:
    """`df` in two parts: rows whose `key` is in no row of `keys`, and all others.

    `keys` is a stored table with one column; it is read twice. The second part
    holds every row whose key is in `keys`, and a few more.
    """
    n_words = words_for(keys.count(), max_words)
    hashed = keys.select(F.xxhash64(keys.columns[0]))
    name = unused(df, "maybe")
    marked = tested(df, F.xxhash64(key), build(hashed, n_words), n_words, name)
    return marked.filter(~F.col(name)).drop(name), marked.filter(name).drop(name)


def without(df: DataFrame, keys: DataFrame, key: str, max_words: int = MAX_WORDS) -> DataFrame:
    """Rows of `df` whose `key` is not in the stored table `keys`.

    Rows that the filter clears stay where they are; only the others are joined.
    """
    clear, maybe = split(df, keys, key, max_words)
    return clear.unionByName(maybe.join(_as(keys, key), key, "left_anti").select(*df.columns))


def within(df: DataFrame, keys: DataFrame, key: str, max_words: int = MAX_WORDS) -> DataFrame:
    """Rows of `df` whose `key` is in the stored table `keys`; only rows that pass its filter are joined."""
    _, maybe = split(df, keys, key, max_words)
    return maybe.join(_as(keys, key), key, "left_semi").select(*df.columns)


def _as(keys: DataFrame, name: str) -> DataFrame:
    return keys.select(F.col(keys.columns[0]).alias(name))


def unused(df: DataFrame, name: str) -> str:
    """A column name that `df` does not have."""
    taken = {c.lower() for c in df.columns}
    while any(c.startswith(name) for c in taken):
        name = f"_{name}"
    return name
