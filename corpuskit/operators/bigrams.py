"""Adjacent word pairs inside a line and their relative frequencies."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import adjacent_pairs, tokenize
from ..sources.state import cut
from .cooccurrence import STRIPE_PARTS, stripe_part
from .skew import with_key_totals


def bigram_counts(lines: DataFrame, line: str = "line") -> DataFrame:
    """(w1, w2, n) for words that follow each other in a line."""
    pairs = lines.select(tokenize(line).alias("t")).select(
        F.explode(adjacent_pairs("t")).alias("p")
    )
    # never NULL; said once, so that all readers of the counts share one shuffle
    pairs = pairs.select("p.w1", "p.w2").filter(F.col("w1").isNotNull())
    return pairs.groupBy("w1", "w2").agg(F.count(F.lit(1)).alias("n"))


def bigram_relfreq(lines: DataFrame, marginals: bool = True, line: str = "line") -> DataFrame:
    """(w1, w2, value): share of w2 among the words right after w1.

    With `marginals`, rows (w1, '*', n) hold how often w1 is a left word. A word
    cannot be '*', since words begin with a letter.
    """
    counts = bigram_counts(lines, line)
    with_total = with_key_totals(counts, ["w1"], ["w2"], {"_left": F.sum("n")})
    relative = with_total.select("w1", "w2", (F.col("n") / F.col("_left")).alias("value"))
    if not marginals:
        return relative
    left = counts.groupBy("w1").agg(F.sum("n").cast("double").alias("value"))
    return left.select("w1", F.lit("*").alias("w2"), "value").unionByName(relative)


def bigram_stripes(lines: DataFrame, line: str = "line", parts: int = STRIPE_PARTS) -> DataFrame:
    """(w1, part, stripe) with the relative frequencies of w1's followers.

    Counts go to their stripes first, and how often w1 is a left word is added up
    from the stripes, at most `parts` rows for a word, so pairs move once.
    """
    counts = bigram_counts(lines, line).withColumn("part", stripe_part("w2", parts))
    entries = F.sort_array(F.collect_list(F.struct("w2", "n")))
    counted = cut(counts.groupBy("w1", "part").agg(F.sum("n").alias("_n"), entries.alias("_entries")), "stripes")
    totals = counted.groupBy("w1").agg(F.sum("_n").alias("_left"))
    shares = F.transform("_entries", lambda e: F.struct(e["w2"].alias("w2"), (e["n"] / F.col("_left")).alias("value")))
    return counted.join(totals, "w1").select("w1", "part", F.map_from_entries(shares).alias("stripe"))
