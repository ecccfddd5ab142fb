"""Word, prefix and line statistics. Input lines are (line) with any columns that name a line."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import tokenize, vocab, word_prefix


def words(lines: DataFrame, line: str = "line", *carry: str) -> DataFrame:
    """One row per token occurrence, with the `carry` columns."""
    return lines.select(*carry, F.explode(tokenize(line)).alias("word"))


def line_total(lines: DataFrame) -> DataFrame:
    """Number of lines, blank ones included."""
    return lines.agg(F.count(F.lit(1)).alias("n_lines"))


def word_count(lines: DataFrame, line: str = "line") -> DataFrame:
    """(word, n). Partial counts leave each task, so a frequent word costs one row per task."""
    return words(lines, line).groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def prefix_count(lines: DataFrame, k: int = 2, line: str = "line") -> DataFrame:
    """(prefix, n) over tokens of at least k characters."""
    prefixes = words(lines, line).select(word_prefix("word", k).alias("prefix"))
    return (
        prefixes.filter(F.col("prefix").isNotNull())
        .groupBy("prefix")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def top_prefixes(lines: DataFrame, n: int, k: int = 2, line: str = "line") -> DataFrame:
    """The n most frequent prefixes, ties by prefix."""
    return prefix_count(lines, k, line).orderBy(F.desc("n"), "prefix").limit(n)


def vocab_words(lines: DataFrame, line: str = "line", keys: Sequence[str] = ("docno",)) -> DataFrame:
    """(keys, word), each word once per line."""
    return lines.select(*keys, F.explode(vocab(line)).alias("word"))


def line_df(lines: DataFrame, line: str = "line") -> DataFrame:
    """(word, df): in how many lines the word occurs."""
    return vocab_words(lines, line, ()).groupBy("word").agg(F.count(F.lit(1)).alias("df"))
