"""Column expressions: no shuffle, no Python worker."""

from .dates import after, before, date_matches, month_of
from .measures import charge, discounted, extended, money, rate
from .text import (
    adjacent_pairs,
    classified,
    sigmoid,
    snippet,
    tokenize,
    vocab,
    word_prefix,
)

__all__ = [
    "adjacent_pairs",
    "after",
    "before",
    "charge",
    "classified",
    "date_matches",
    "discounted",
    "extended",
    "money",
    "month_of",
    "rate",
    "sigmoid",
    "snippet",
    "tokenize",
    "vocab",
    "word_prefix",
]
