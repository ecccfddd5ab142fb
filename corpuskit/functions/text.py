"""Text expressions. All of them run inside Spark's generated code."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The whitespace that separates tokens, and the score above which
# a document is spam.
WHITESPACE = " \t\n\r\f"
SPAM_THRESHOLD = 0

# A token runs from its first letter to its last; what stands between is kept.
# Every character is looked at a bounded number of times, so a very long text
# or a very long run without letters stays linear.
_TOKEN = f"[a-z](?:[^{WHITESPACE}]*[a-z])?"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def tokenize(text: Column | str) -> Column:
    """Lower-cased tokens of a text, in order, stripped of non-letters at both ends.

    Splitting on whitespace, stripping each piece and dropping empty ones comes
    to the same as taking, within every piece, the span from the first letter
    to the last, which one pattern finds in one pass.
    """
    return F.regexp_extract_all(F.lower(_col(text)), F.lit(_TOKEN), F.lit(0))


def vocab(text: Column | str) -> Column:
    """Distinct tokens of a line, all of them, in order of first appearance."""
    return F.array_distinct(tokenize(text))


def word_prefix(word: Column | str, k: int = 2) -> Column:
    """First k characters of a word; NULL for a shorter word."""
    word = _col(word)
    return F.when(F.length(word) >= k, F.substring(word, 1, k))


def adjacent_pairs(tokens: Column | str) -> Column:
    """array<struct<w1, w2>> of neighbouring tokens; empty below two tokens."""
    tokens = _col(tokens)
    n = F.size(tokens)
    zipped = F.arrays_zip(
        F.slice(tokens, F.lit(1), F.greatest(n - 1, F.lit(0))).alias("w1"),
        F.slice(tokens, F.lit(2), F.greatest(n - 1, F.lit(0))).alias("w2"),
    )
    return zipped.cast("array<struct<w1:string,w2:string>>")


def snippet(line: Column | str, width: int = 80) -> Column:
    """The line, cut to `width` characters plus '...' when it is longer."""
    line = _col(line)
    cut = F.concat(F.substring(line, 1, width), F.lit("..."))
    return F.when(F.length(line) > width, cut).otherwise(line)


def sigmoid(x: Column | str) -> Column:
    """1 / (1 + exp(-x))."""
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-_col(x)))


def classified(score: Column | str) -> Column:
    """'spam' above zero, else 'ham'; zero is ham."""
    return F.when(_col(score) > SPAM_THRESHOLD, F.lit("spam")).otherwise(F.lit("ham"))
