"""Quality classifier: a sparse ensemble of conjunctive rules over text statistics."""

from __future__ import annotations

import math
import re
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.tables import load
from ..sources.state import cut

# Trees and their depth give at most 2 * (2^DEPTH - 1) * TREES rules.
TREES = 24
DEPTH = 3
LASSO = 2e-4
SEED = 7


def _whole(text: str) -> Column:
    return F.coalesce(F.col(text), F.lit(""))


def _words(whole: Column) -> Column:
    return F.split(whole, r"[\x20\x09-\x0D]+", -1)


def statistics(whole: Column, words: Column) -> dict[str, Column]:
    """Name and value of each statistic of a text, not null, and its words.

    `variety` is the logarithm of the number of distinct words over that of all
    words, which falls little with length where words aren't repeated at will.
    """
    n_words = F.size(words)  # one empty word at least
    n_chars = F.greatest(F.length(whole), F.lit(1))
    count = lambda pattern: F.regexp_count(whole, F.lit(pattern))
    return {
        "log_words": F.log2(n_words.cast("double")),
        "word_length": F.length(whole) / n_words,
        "variety": F.log2(F.size(F.array_distinct(words)) + 1.0) / F.log2(n_words + 1.0),
        "upper": count(r"\p{Lu}") / n_chars,
        "symbols": count(r"[#$%&*@^~=<>{}\[\]\\_+/]") / n_words,
        "bars": count(r"\|") / n_words,
        "marks": count("[!?]") / n_words,
        "stops": count("[.,;:]") / n_words,
        "digits": count("[0-9]") / n_chars,
        "lines": count("\n") / n_words,
    }


STATISTICS = (
    "log_words",
    "word_length",
    "variety",
    "upper",
    "symbols",
    "bars",
    "marks",
    "stops",
    "digits",
    "lines",
)


@dataclass(frozen=True)
class Condition:
    """A statistic at most, or above, a bound."""

    statistic: str
    above: bool
    bound: float

    def column(self, value_of: Callable[[str], Column] = F.col) -> Column:
        value = value_of(self.statistic)
        return value > self.bound if self.above else value <= self.bound


@dataclass(frozen=True)
class Model:
    """A logistic sum of the weights of the rules that hold; a rule holds if all its conditions do."""

    base: float
    rules: tuple[tuple[float, tuple[Condition, ...]], ...]

    def score(self, value_of: Callable[[str], Column] = F.col) -> Column:
        """The probability of label 1, as an expression over the statistics' columns."""
        total = F.lit(self.base)
        for weight, rule in self.rules:
            total = total + F.when(reduce(and_, [c.column(value_of) for c in rule]), weight).otherwise(0.0)
        return 1 / (1 + F.exp(-total))


def _paths(tree: str, names: Sequence[str]) -> Iterator[tuple[Condition, ...]]:
    """The conditions on the way to every node below the root, from a tree's description."""
    way: list[Condition] = []
    for line in tree.splitlines():
        found = re.match(r"( *)(?:If|Else) \(feature (\d+) (<=|>) (\S+)\)", line)
        if found:
            # the description indents by one blank per level, the root's tests by two
            del way[len(found[1]) - 2 :]
            way.append(Condition(names[int(found[2])], found[3] == ">", float(found[4])))
            yield tuple(way)


def _short(rule: tuple[Condition, ...]) -> tuple[Condition, ...]:
    """The same rule with one condition per statistic and side."""
    tight: dict[tuple[str, bool], Condition] = {}
    for c in rule:
        had = tight.get((c.statistic, c.above))
        if had is None or (c.bound > had.bound) == c.above:
            tight[c.statistic, c.above] = c
    return tuple(sorted(tight.values(), key=lambda c: (c.statistic, c.above)))


def fit(
    labelled: DataFrame, trees: int = TREES, depth: int = DEPTH, lasso: float = LASSO, seed: int = SEED
) -> Model:
    """Learn from a stored table of statistics and `label`, 0 or 1; all its rows count.

    Paths of the trees of a small random forest become rules; a logistic model
    with an absolute penalty gives them weights, most of them zero. Both are
    fitted by Spark over all executors. With one kind of label, or none, every
    score is that label's share, or one half.
    """
    n, positive = labelled.agg(F.count(F.lit(1)), F.coalesce(F.sum("label"), F.lit(0))).first()
    if positive in (0, n):
        share = (positive + 0.5) / (n + 1)
        return Model(math.log(share / (1 - share)), ())
    rows = labelled.withColumn("label", F.col("label").cast("double"))
    names = list(STATISTICS)
    vectors = VectorAssembler(inputCols=names, outputCol="features").transform(rows)
    forest = RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=seed, maxBins=64).fit(vectors)
    paths = (p for tree in forest.trees for p in _paths(tree.toDebugString, names))
    rules = sorted({_short(p) for p in paths}, key=str)
    if not rules:
        share = positive / n
        return Model(math.log(share / (1 - share)), ())
    held = [reduce(and_, [c.column() for c in r]).cast("double").alias(f"r{i}") for i, r in enumerate(rules)]
    named = [f"r{i}" for i in range(len(rules))]
    table = VectorAssembler(inputCols=named, outputCol="rules").transform(rows.select("label", *held))
    lasso_fit = LogisticRegression(
        featuresCol="rules", elasticNetParam=1.0, regParam=lasso, standardization=False, maxIter=60
    ).fit(table.select("label", "rules"))
    weights = lasso_fit.coefficients.toArray().tolist()
    return Model(lasso_fit.intercept, tuple((w, r) for w, r in zip(weights, rules, strict=True) if w))


def held_out(key: str) -> Column:
    """Whether a row's label is never learned from: crc32 of the key as text has remainder 1 by 3."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % 3 == 1


def described(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, the statistics) of every row."""
    whole = _whole(text)
    return df.select(key, *[c.alias(name) for name, c in statistics(whole, _words(whole)).items()])


def learned(stats: DataFrame, labels: DataFrame, key: str = "doc_id", label: str = "quality") -> Model:
    """A model from the labels of rows that are not held out; null labels and keys are left out."""
    known = labels.select(F.col(key), F.col(label).cast("int").alias("label")).filter("label IS NOT NULL")
    joined = stats.filter(~held_out(key)).join(known, key).select("label", *STATISTICS)
    return fit(cut(joined, "labelled"))


def classify(
    df: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality"
) -> DataFrame:
    """(key, held_out, score, predicted) of every row of `df`, by a model from `labels` (key, label).

    The statistics of all texts are stored once, some 90 bytes each, and serve
    both to learn and to score. The score depends on the text alone. Null and
    empty texts get a score like others, rows may repeat, labels of keys that
    `df` doesn't have are not used, other columns play no part.
    """
    stats = cut(described(df, key, text), "statistics")
    score = learned(stats, labels, key, label).score()
    return stats.select(
        key, held_out(key).alias("held_out"), score.alias("score"), (score >= 0.5).cast("int").alias("predicted")
    )


def keep_good(
    df: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality"
) -> DataFrame:
    """The rows of `df`, with all their columns, that the model doesn't reject; no row is shuffled."""
    stats = cut(described(df, key, text), "statistics")
    model = learned(stats, labels, key, label)
    # a filter repeats its columns' expressions wherever rules use them; as arguments
    # of lambda functions the words and the statistics are made once per row
    words = F.array(F.struct(_whole(text).alias("text"), _words(_whole(text)).alias("words")))
    made = F.transform(
        words, lambda w: F.struct(*[c.alias(name) for name, c in statistics(w["text"], w["words"]).items()])
    )
    return df.filter(F.exists(made, lambda s: model.score(s.getField) >= 0.5))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's quality score, and whether its label was held out."""
    return classify(load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels"))


QUERIES = {"op2_quality_rules": op2_quality_rules}
ORACLES: dict[str, str] = {}
