"""Ranking quality of scores: 1-ROCA%, 100 * (1 - area under the ROC curve)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.state import cut
from .classifier import SPAM
from .skew import default_pieces


def one_minus_roca(
    scores: DataFrame, by: Sequence[str] = (), population: DataFrame | None = None
) -> DataFrame:
    """(by..., n_spam, n_ham, one_minus_roca); ties between spam and ham count half.

    The area is the share of (spam, ham) pairs that the spam wins. With
    `population` (doc_id, label), its documents without a score in a group of
    `by` have score 0 there. Equal scores become one row. Score ranges from
    quantiles of each group, as many as the shuffle has partitions, split the
    sort over tasks: pairs inside a range are counted there, pairs across ranges
    from the range totals. Any split gives the exact result; quantiles only
    balance the work.
    """
    by = list(by)
    spam = (F.col("label") == SPAM).cast("bigint")
    totals = [F.sum(spam).alias("_p"), F.sum(1 - spam).alias("_n")]
    levels = scores.groupBy(*by, "score").agg(*totals)
    if population is not None:
        all_p, all_n = (population.agg(t).scalar() for t in totals)
        seen = levels.groupBy(*by).agg(F.sum("_p").alias("_p"), F.sum("_n").alias("_n"))
        rest = seen.select(*by, F.lit(0.0).alias("score"), (all_p - F.col("_p")).alias("_p"), (all_n - F.col("_n")).alias("_n"))
        levels = levels.unionByName(rest).groupBy(*by, "score").agg(F.sum("_p").alias("_p"), F.sum("_n").alias("_n"))
    levels = cut(levels, "levels")
    buckets = default_pieces(scores)
    marks = [i / buckets for i in range(1, buckets)] or [0.5]
    splits = cut(levels.groupBy(*by).agg(F.percentile_approx("score", marks).alias("_splits")), "splits")
    at = levels.join(splits, by) if by else levels.withColumn("_splits", splits.scalar())
    bucketed = at.withColumn(
        "_bucket", F.size(F.filter("_splits", lambda s: s < F.col("score")))
    ).drop("_splits")
    inside = (
        Window.partitionBy(*by, "_bucket")
        .orderBy("score")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    lower = F.coalesce(F.sum("_n").over(inside), F.lit(0))
    won = bucketed.withColumn("_won", F.col("_p") * (lower + F.col("_n") / 2))
    totals = won.groupBy(*by, "_bucket").agg(
        F.sum("_won").alias("_won"), F.sum("_p").alias("_p"), F.sum("_n").alias("_n")
    )
    earlier = (
        Window.partitionBy(*by).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    )
    below = F.coalesce(F.sum("_n").over(earlier), F.lit(0))
    pairs = totals.withColumn("_won", F.col("_won") + F.col("_p") * below)
    area = F.sum("_won") / (F.sum("_p") * F.sum("_n"))
    return pairs.groupBy(*by).agg(
        F.sum("_p").alias("n_spam"),
        F.sum("_n").alias("n_ham"),
        (100 * (1 - area)).alias("one_minus_roca"),
    )


def mean_over_runs(quality: DataFrame) -> DataFrame:
    """One row: n_runs and the mean, lowest and highest 1-ROCA% of several runs."""
    return quality.agg(
        F.count(F.lit(1)).alias("n_runs"),
        F.avg("one_minus_roca").alias("mean"),
        F.min("one_minus_roca").alias("lowest"),
        F.max("one_minus_roca").alias("highest"),
    )
