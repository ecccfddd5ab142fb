"""Spam classifier on the labelled documents; one model per language."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import operators as op
from ..sources import cut
from ..sources.state import passing
from .tables import SQL_INSTANCES, labelled

SEEDS = list(range(10))
BATCHES = 2
PLACES = 9

# Scores are sums of many weights, so their last places depend on the order.
SCORE_PLACES = 6


def _rounded(df, column):
    places = PLACES if column == "weight" else SCORE_PLACES
    return df.withColumn(column, F.round(column, places))


def _stored(spark, sf):
    """The instances with counted features as a stored table, which training and scoring read several times."""
    return cut(op.with_counts(labelled(spark, sf)), "instances")


def _models(instances, rounds=2):
    """(model, feature, weight), a model per language."""
    by_language = instances.withColumnRenamed("lang", "model")
    return op.train_gradient(by_language, rounds, by=["model"])


def _scored(spark, sf):
    """Instances, models and exact scores."""
    instances = _stored(spark, sf)
    models = cut(_models(instances), "model")
    return instances, models, op.score(instances, models)


def _scores(spark, sf):
    return _rounded(_scored(spark, sf)[2], "score")


def _instances(spark, sf):
    rows = labelled(spark, sf).select("doc_id", "lang", "label", F.explode("features").alias("feature"))
    return rows.groupBy("doc_id", "lang", "label", "feature").agg(F.count(F.lit(1)).alias("n"))


def _one_round(spark, sf):
    return _rounded(_models(labelled(spark, sf), 1), "weight")


def _two_rounds(spark, sf):
    return _rounded(_models(_stored(spark, sf)), "weight")


def _union(spark, sf):
    """One model on the union of two training sets, English and all other languages."""
    instances = _stored(spark, sf)
    english = F.coalesce(F.col("lang") == "en", F.lit(False))
    sets = [instances.filter(english), instances.filter(~english)]
    return _rounded(op.train_gradient(op.union_sets(*sets), 2), "weight")


def _ensemble(method):
    def query(spark, sf):
        instances, models, scores = _scored(spark, sf)
        scores = scores if method == "average" else _rounded(scores, "score")
        return _rounded(op.ensemble(scores, method, instances, models), "score")

    return query


def _quality(spark, sf):
    instances, _, scores = _scored(spark, sf)
    return _rounded(op.one_minus_roca(_rounded(scores, "score"), ["model"], instances), "one_minus_roca")


def _ensemble_quality(spark, sf):
    return _rounded(op.one_minus_roca(_ensemble("average")(spark, sf)), "one_minus_roca")


def _batches(spark, sf):
    return _rounded(op.train_batches(_stored(spark, sf), BATCHES, SEEDS[:2]), "weight")


def _shuffled_quality(spark, sf):
    """1-ROCA% over ten shuffled orders, all trained in the same jobs, one model per order."""
    with passing(spark, keep=("blocks",)):
        instances = op.in_blocks(_stored(spark, sf))
    with passing(spark, keep=("models",)):
        models = cut(op.train_batches(instances, BATCHES, SEEDS), "models")
    scores = _rounded(op.score(instances, models), "score")
    quality = op.mean_over_runs(op.one_minus_roca(scores, ["model"], instances))
    for column in ("mean", "lowest", "highest"):
        quality = _rounded(quality, column)
    return quality


QUERIES = {
    "instances": _instances,
    "train_gradient": _one_round,
    "train_gradient_2_rounds": _two_rounds,
    "train_union": _union,
    "train_batches": _batches,
    "score": lambda spark, sf: _scores(spark, sf),
    "classify": lambda spark, sf: op.classify(_scores(spark, sf)),
    "ensemble_average": _ensemble("average"),
    "ensemble_vote": _ensemble("vote"),
    "one_minus_roca": _quality,
    "ensemble_quality": _ensemble_quality,
    "shuffled_quality": _shuffled_quality,
}

_DELTA = "CAST(0.002 AS DOUBLE)"


def _two_round_sql(name: str, key: str) -> str:
    """Weights after two rounds for each value of `key` (a column or a constant)."""
    return f"""{name}_1 AS (
  SELECT {key} AS model, feature,
         sum((CASE WHEN label = 'spam' THEN 0.5::DOUBLE ELSE -0.5::DOUBLE END) * n) * {_DELTA} AS weight
  FROM counted GROUP BY ALL),
{name}_e AS (
  SELECT i.doc_id, any_value({key}) AS model,
         any_value(CASE WHEN label = 'spam' THEN 1::DOUBLE ELSE 0::DOUBLE END)
           - 1 / (1 + exp(-coalesce(sum(n * weight), 0))) AS err
  FROM counted i JOIN {name}_1 w ON w.model = {key} AND w.feature = i.feature GROUP BY i.doc_id),
{name}_2 AS (
  SELECT model, feature, sum(weight) AS weight FROM (
    SELECT model, feature, weight FROM {name}_1
    UNION ALL
    SELECT model, feature, err * n * {_DELTA} FROM counted JOIN {name}_e USING (doc_id))
  GROUP BY model, feature)"""


def _batch_sql(seeds: list[int]) -> str:
    """Weights of each seed after its two batches, as b_2."""
    batch = f"CAST('0x' || substring(md5(doc_id || ':' || seed), 1, 7) AS BIGINT) % {BATCHES}"
    return f"""dealt AS (
  SELECT seed AS model, doc_id, label, feature, n, {batch} AS batch
  FROM counted CROSS JOIN (SELECT unnest({seeds}) AS seed)),
b_1 AS (
  SELECT model, feature,
         sum((CASE WHEN label = 'spam' THEN 0.5::DOUBLE ELSE -0.5::DOUBLE END) * n) * {_DELTA} AS weight
  FROM dealt WHERE batch = 0 GROUP BY ALL),
b_e AS (
  SELECT d.model, d.doc_id,
         any_value(CASE WHEN label = 'spam' THEN 1::DOUBLE ELSE 0::DOUBLE END)
           - 1 / (1 + exp(-coalesce(sum(n * weight), 0))) AS err
  FROM dealt d LEFT JOIN b_1 ON b_1.model = d.model AND b_1.feature = d.feature
  WHERE batch = 1 GROUP BY d.model, d.doc_id),
b_2 AS (
  SELECT model, feature, sum(weight) AS weight FROM (
    SELECT model, feature, weight FROM b_1
    UNION ALL
    SELECT model, feature, err * n * {_DELTA} FROM dealt JOIN b_e USING (model, doc_id))
  GROUP BY model, feature)"""


_SCORES = f"""{SQL_INSTANCES},
{_two_round_sql('w', 'lang')},
names AS (SELECT DISTINCT model FROM w_2),
exact AS (
  SELECT doc_id, label, model, sum(n * weight) AS score FROM counted JOIN w_2 USING (feature)
  GROUP BY doc_id, label, model),
scores AS (SELECT doc_id, label, model, round(score, {SCORE_PLACES}) AS score FROM exact),
full_scores AS (
  SELECT i.doc_id, i.label, names.model, coalesce(s.score, 0) AS score, coalesce(e.score, 0) AS exact
  FROM instances i CROSS JOIN names
  LEFT JOIN scores s ON s.doc_id = i.doc_id AND s.model = names.model
  LEFT JOIN exact e ON e.doc_id = i.doc_id AND e.model = names.model)"""

_AVERAGE = f"""{_SCORES},
joint AS (SELECT doc_id, label, round(avg(exact), {SCORE_PLACES}) AS score FROM full_scores GROUP BY doc_id, label)"""


def _roca_sql(source: str, key: str, out: str) -> str:
    """Every spam score against every ham score."""
    return f"""SELECT {out}count(DISTINCT s.doc_id) AS n_spam, count(DISTINCT h.doc_id) AS n_ham,
  round(100 * (1 - avg(CASE WHEN s.score > h.score THEN 1.0 WHEN s.score = h.score THEN 0.5
    ELSE 0.0 END)), {SCORE_PLACES}) AS one_minus_roca
FROM {source} s JOIN {source} h ON {key} WHERE s.label = 'spam' AND h.label = 'ham' GROUP BY ALL"""


_PREDICTION = "CASE WHEN score > 0 THEN 'spam' ELSE 'ham' END AS prediction"

ORACLES = {
    "instances": f"WITH {SQL_INSTANCES} SELECT doc_id, lang, label, feature, n FROM counted",
    "train_gradient": f"""WITH {SQL_INSTANCES}, {_two_round_sql('w', 'lang')}
SELECT model, feature, round(weight, {PLACES}) AS weight FROM w_1""",
    "train_gradient_2_rounds": f"""WITH {SQL_INSTANCES}, {_two_round_sql('w', 'lang')}
SELECT model, feature, round(weight, {PLACES}) AS weight FROM w_2""",
    "train_union": f"""WITH {SQL_INSTANCES}, {_two_round_sql('w', "'all'")}
SELECT feature, round(weight, {PLACES}) AS weight FROM w_2""",
    "score": f"WITH {_SCORES} SELECT doc_id, label, model, score FROM scores",
    "classify": f"WITH {_SCORES} SELECT doc_id, label, model, score, {_PREDICTION} FROM scores",
    "ensemble_average": f"WITH {_AVERAGE} SELECT doc_id, label, score, {_PREDICTION} FROM joint",
    "ensemble_vote": f"""WITH {_SCORES},
joint AS (
  SELECT doc_id, label, CAST(sum(CASE WHEN score > 0 THEN 1 ELSE -1 END) AS DOUBLE) AS score
  FROM full_scores GROUP BY doc_id, label)
SELECT doc_id, label, score, {_PREDICTION} FROM joint""",
    "one_minus_roca": f"WITH {_SCORES} {_roca_sql('full_scores', 's.model = h.model', 's.model, ')}",
    "ensemble_quality": f"WITH {_AVERAGE} {_roca_sql('joint', 'true', '')}",
    "train_batches": f"""WITH {SQL_INSTANCES}, {_batch_sql(SEEDS[:2])}
SELECT model, feature, round(weight, {PLACES}) AS weight FROM b_2""",
    "shuffled_quality": f"""WITH {SQL_INSTANCES}, {_batch_sql(SEEDS)},
exact AS (
  SELECT doc_id, model, sum(n * weight) AS score FROM counted JOIN b_2 USING (feature) GROUP BY doc_id, model),
full_scores AS (
  SELECT i.doc_id, i.label, s.model, round(coalesce(e.score, 0), {SCORE_PLACES}) AS score
  FROM instances i CROSS JOIN (SELECT unnest({SEEDS}) AS model) s
  LEFT JOIN exact e ON e.doc_id = i.doc_id AND e.model = s.model),
runs AS ({_roca_sql('full_scores', 's.model = h.model', 's.model, ').replace(f', {SCORE_PLACES})', ', 30)')})
SELECT count(*) AS n_runs, round(avg(one_minus_roca), {SCORE_PLACES}) AS mean,
  round(min(one_minus_roca), {SCORE_PLACES}) AS lowest, round(max(one_minus_roca), {SCORE_PLACES}) AS highest FROM runs""",
}
