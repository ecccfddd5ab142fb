"""Linear spam classifier over instances (doc_id, label, features).

Features are ints or strings; an occurrence counts each time. Instances that are
read more than once can be stored with `counts` in place of features, see
`with_counts`. Models are rows (model, feature, weight), so one table can hold
any number of them.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import classified, sigmoid
from ..sources.state import bucket_keys, bucketed, cut, fresh_path, joined_as_dealt, tasks_for

# Learning rate, positive label, ensemble methods.
DELTA = 0.002
SPAM = "spam"
METHODS = ("average", "vote")


def _is_spam() -> Column:
    return F.when(F.col("label") == SPAM, F.lit(1)).otherwise(F.lit(0))


def union_sets(*training: DataFrame) -> DataFrame:
    """Several training sets as one."""
    whole = training[0]
    for more in training[1:]:
        whole = whole.unionByName(more)
    return whole


def _counts(features: str | Column = "features") -> Column:
    """The different features of an array and how often each is in it, as an array of (feature, n)."""

    def once(value: Column, use) -> Column:
        """What `use` makes of a value that is worked out once, not for each element that refers to it."""
        return F.get(F.transform(F.array(value), use), F.lit(0))

    def begins(s: Column) -> Column:
        another = lambda i: (i == F.size(s)) | (i == 0) | ~F.get(s, i).eqNullSafe(F.get(s, i - 1))
        return F.filter(F.sequence(F.lit(0), F.size(s)), another)

    def runs(s: Column, at: Column) -> Column:
        # from each place where another feature begins to the next; the last place is the end
        return F.zip_with(
            F.slice(at, F.lit(1), F.size(at) - 1),
            F.slice(at, F.lit(2), F.size(at) - 1),
            lambda i, j: F.named_struct(F.lit("feature"), F.get(s, i), F.lit("n"), (j - i).cast("bigint")),
        )

    return once(F.sort_array(features), lambda s: once(begins(s), lambda at: runs(s, at)))


def with_counts(instances: DataFrame) -> DataFrame:
    """Instances with `counts`, an array of (feature, n), in place of `features`, those without features too.

    Counted in the row: a document that comes in several rows has as many
    counts, which its sums add up like one.
    """
    if "counts" in instances.columns:
        return instances
    counts = F.when(F.size("features") > 0, _counts())
    return instances.withColumn("counts", counts).drop("features")


def in_blocks(instances: DataFrame) -> DataFrame:
    """Instances with `counts` and `block`, a stored table in buckets by it; all rows of a document are in one block.

    There are as many blocks as bound the counts in one. A block asks for the
    weights of its features once, however many of its documents have them, so
    that weights go to the documents and no occurrence is shuffled.
    """
    if "block" in instances.columns:
        return instances
    spark = instances.sparkSession
    rows = instances if "counts" in instances.columns else cut(with_counts(instances), "instances")
    n = rows.filter(F.size("counts") > 0).agg(F.sum(F.size("counts"))).first()[0] or 0
    least = min(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    blocks = tasks_for(spark, n, least)
    number = F.pmod(F.xxhash64("doc_id"), F.lit(blocks)).cast("int")
    block = F.get(F.array(*map(F.lit, bucket_keys(spark, blocks))), number)
    named = rows.withColumn("block", block.alias("block", metadata={"blocks": blocks}))
    return bucketed(named, "blocks", ["block"], blocks, ordered=False)


def _blocks(rows: DataFrame) -> int:
    """How many blocks rows of `in_blocks` are in."""
    return rows.schema["block"].metadata["blocks"]


def _sent_to_blocks(rows: DataFrame, weights: DataFrame) -> DataFrame:
    """(block, the weights' columns): the weights of the features in each block of the rows, dealt out like these."""
    asked = _each_count(rows, "block").select("block", "feature").distinct()
    return asked.join(weights, "feature").repartition(_blocks(rows), "block")


def _learned_from(instances: DataFrame) -> DataFrame:
    """The instances that have features, with `counts`."""
    column = "counts" if "counts" in instances.columns else "features"
    return with_counts(instances.filter(F.size(column) > 0))


def _each_count(rows: DataFrame, *keys: str | Column) -> DataFrame:
    """(keys, feature, n): how often each row with `counts` has each of its features."""
    each = rows.select("*", F.explode("counts").alias("_c"))
    return each.select(*keys, "_c.feature", "_c.n")


def train_gradient(
    instances: DataFrame, rounds: int, delta: float = DELTA, by: Sequence[str] = ()
) -> DataFrame:
    """(by..., feature, weight) after `rounds` of w += delta * sum((y - p) * x).

    All instances of one value of `by` train one model together. The counts of
    their features are stored once, unless they come with `counts`; every round is
    joins and sums over all of them.
    """
    if rounds < 1:
        raise ValueError("rounds must be at least 1")
    by, weights = list(by), None
    rows = _learned_from(instances)
    rows = rows.select(*by, "doc_id", _is_spam().cast("double").alias("y"), "counts")
    if rounds > 1 and "counts" not in instances.columns:
        rows = cut(rows, "occurrences")
    for i in range(rounds):
        weights = _round(rows, weights, delta, by)
        if i < rounds - 1:
            weights = cut(weights, "weights")
    return weights


def _round(rows: DataFrame, weights: DataFrame | None, delta: float, by: Sequence[str]) -> DataFrame:
    """The weights (by..., feature, weight) after a step on all rows (by..., doc_id, y, counts).

    Occurrences meet their weights and are added up by document as they are met;
    what goes back to the documents is a sum each. So occurrences are shuffled
    once, by feature, and the documents as they are stored; an error is spread
    over the features of a document where its row is.
    """
    keys = [*by, "feature"]
    if weights is None:  # every probability is one half
        scored = rows.withColumn("_e", F.col("y") - 0.5)
    else:
        names = [*by, "doc_id"]
        known = _each_count(rows, *names).join(weights, keys)
        totals = known.groupBy(*names).agg(F.sum(F.col("n") * F.col("weight")).alias("_total"))
        totals = totals.toDF(*(f"_{c}" for c in names), "_total")
        same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in names]
        total = F.coalesce("_total", F.lit(0.0))
        scored = rows.join(totals, reduce(and_, same), "left").withColumn("_e", F.col("y") - sigmoid(total))
    step = _each_count(scored, *by, "_e").select(*keys, (F.col("_e") * F.col("n") * delta).alias("weight"))
    if weights is not None:
        step = weights.unionByName(step)
    return step.groupBy(*keys).agg(F.sum("weight").alias("weight"))


def batch_of(key: str | Column, seed: Column, batches: int) -> Column:
    """The batch of a document in the order of a seed: 7 hex digits of the MD5 of key:seed, modulo the batches."""
    key = F.col(key) if isinstance(key, str) else key
    digest = F.md5(F.concat_ws(":", key.cast("string"), seed.cast("string")))
    return F.conv(F.substring(digest, 1, 7), 16, 10).cast("bigint") % batches


def deal(instances: DataFrame, batches: int, seeds: Sequence[int], whole: bool = False) -> DataFrame:
    """(model, doc_id, y, feature, n, batch): how often a document has a feature, for each seed, stored by batch.

    The batch of a document in each seed's order and the occurrences of its
    features are worked out once; a batch is a folder, which is all that a step
    on it reads. A folder has a row per document, with its counts and the models
    that it trains there; they become rows when it is read, or with `whole` stay
    as they are: (doc_id, y, counts, models, batch, block), in the blocks of the
    instances. Documents without features have nothing to learn from.
    """
    spark = instances.sparkSession
    seeds = [int(s) for s in seeds]
    dealt = F.array(*(batch_of("doc_id", F.lit(s), batches).cast("int") for s in seeds))
    rows = in_blocks(instances) if whole else instances
    block = ["block"] if whole else []
    rows = _learned_from(rows)
    rows = rows.select("doc_id", _is_spam().cast("double").alias("y"), dealt.alias("_dealt"), "counts", *block)
    # a document goes once to each batch that it has for any seed
    named = F.arrays_zip(F.array(*map(F.lit, seeds)).alias("model"), F.col("_dealt").alias("batch"))
    rows = rows.select("doc_id", "y", "counts", named.alias("_named"), F.explode(F.array_distinct("_dealt")).alias("batch"), *block)
    of_batch = F.filter("_named", lambda s: s["batch"] == F.col("batch"))
    models = F.transform(of_batch, lambda s: s["model"]).alias("models")
    rows = rows.select("doc_id", "y", "counts", models, "batch", *block)
    if whole:
        return bucketed(rows, "batches", block, _blocks(rows), folders=["batch"], ordered=False)
    path = fresh_path(spark, "batches")
    rows.write.partitionBy("batch").parquet(path)
    stored = spark.read.schema(rows.schema).parquet(path)
    each = stored.select("doc_id", "y", "models", "batch", F.explode("counts").alias("_c"))
    return each.select(F.explode("models").alias("model"), "doc_id", "y", "_c.feature", "_c.n", "batch")


def batch_step(
    rows: DataFrame, weights: DataFrame | None, delta: float = DELTA, by: Sequence[str] = ("model",), seeds: Sequence[int] | None = None
) -> DataFrame:
    """The weights (by..., feature, weight) after a step on rows (by..., doc_id, y, feature, n), which are read once.

    Features meet their weights, a document's parts are added up beside its rows,
    and its error goes back to its features. The weights, a stored table, are
    read twice; against it AQE can split the occurrences of a feature that most
    documents have. With `seeds`, rows are whole (see `deal`) and the weights, a
    stored table, have a row per feature and a column for each seed, null where
    it has not met the feature.
    """
    if seeds is not None:
        return _block_step(rows, weights, delta, seeds)
    keys = [*by, "feature"]
    if weights is None:  # every probability is one half
        scored = rows.withColumn("_e", F.col("y") - 0.5)
    else:
        part = F.col("n") * F.coalesce(F.col("weight"), F.lit(0.0))
        parts = rows.join(weights, keys, "left").withColumn("_part", part)
        total = F.sum("_part").over(Window.partitionBy(*by, "doc_id"))
        scored = parts.withColumn("_e", F.col("y") - sigmoid(total))
    step = scored.select(*keys, (F.col("_e") * F.col("n") * delta).alias("weight"))
    if weights is not None:
        step = weights.unionByName(step)
    return step.groupBy(*keys).agg(F.sum("weight").alias("weight"))


def _of_model(i: int) -> str:
    return f"_w{i}"


def _block_step(rows: DataFrame, weights: DataFrame | None, delta: float, seeds: Sequence[int]) -> DataFrame:
    """`batch_step` on whole rows, for all seeds at once.

    Each block gets the weights of its features, its documents' sums are made
    there and go no further, and errors are added up by feature in the block
    before they are shuffled.
    """
    names = [_of_model(i) for i in range(len(seeds))]

    def times(seed: int) -> Column:
        return F.size(F.filter("models", lambda m: m == seed))

    errors = [(times(s), F.lit(0.5)) for s in seeds]
    scored = rows
    if weights is not None:
        each = _each_count(rows, "block", "doc_id").join(_sent_to_blocks(rows, weights), ["block", "feature"])
        sums = each.groupBy("block", "doc_id").agg(*(F.sum(F.col("n") * F.col(c)).alias(c) for c in names))
        sums = sums.withColumnsRenamed({"block": "_block", "doc_id": "_doc_id"})
        same = (F.col("block") == F.col("_block")) & F.col("doc_id").eqNullSafe(F.col("_doc_id"))
        scored = rows.join(sums, same, "left")
        errors = [(times(s), sigmoid(times(s) * F.coalesce(c, F.lit(0.0)))) for s, c in zip(seeds, names, strict=True)]
    step = [F.when(t > 0, t * (F.col("y") - p) * delta).alias(c) for (t, p), c in zip(errors, names, strict=True)]
    scored = scored.select("counts", *step)
    step = _each_count(scored, *names).select("feature", *((F.col("n") * F.col(c)).alias(c) for c in names))
    if weights is not None:
        step = weights.unionByName(step)
    with joined_as_dealt(rows.sparkSession):
        return cut(step.groupBy("feature").agg(*(F.sum(c).alias(c) for c in names)), "weights")


def train_batches(
    instances: DataFrame, batches: int, seeds: Sequence[int] = (0,), delta: float = DELTA
) -> DataFrame:
    """(model, feature, weight): one pass in `batches` steps, in the shuffled order of each seed.

    A seed deals the documents to batches, which train one after another, each
    with all its documents at once: a step of a batch is joins and sums like a
    round of `train_gradient`. The number of batches says how often weights are
    updated on the way through the data; neither it nor the model depends on the
    size of the data or the cluster. All seeds, which name the models, train in
    the same jobs. Instances are dealt to folders first (`deal`), so each row is
    read in the step of its batch only, and lie in blocks there (`in_blocks`).
    """
    if batches < 1:
        raise ValueError("batches must be at least 1")
    rows = deal(instances, batches, seeds, whole=True)
    models, weights = list(dict.fromkeys(int(s) for s in seeds)), None
    for i in range(batches):
        weights = batch_step(rows.filter(F.col("batch") == i), weights, delta, seeds=models)
    each = [F.struct(F.lit(s).alias("model"), F.col(_of_model(i)).alias("weight")) for i, s in enumerate(models)]
    one = weights.select("feature", F.explode(F.array(*each)).alias("_m"))
    return one.select("_m.model", "feature", "_m.weight").filter(F.col("weight").isNotNull())


def _matched(
    instances: DataFrame,
    weights: DataFrame,
    carry: Sequence[str],
    keys: Sequence[str] = ("feature",),
) -> DataFrame:
    """A row for each row of instances, known feature and model, with its part of the score."""
    counted = _each_count(_learned_from(instances), *carry)
    part = (F.col("n") * F.col("weight")).alias("_part")
    model = [] if "model" in carry or "model" not in weights.columns else ["model"]
    return counted.join(weights, list(keys)).select(*carry, *model, part)


def score(instances: DataFrame, model: DataFrame) -> DataFrame:
    """(doc_id, label, model, score) for every document and model that knows one of its features.

    A pair that is not there has score 0, and `ensemble` and `one_minus_roca`
    count it so; documents times models rows are never made. Occurrences are
    counted in the row first, without a shuffle. The model joins as it is: broadcast if Spark
    finds it small, else shuffled, where AQE splits a hot feature as long as the
    model is a stored table. Instances of `in_blocks` stay where they are: the
    models' weights go to the blocks, and the scores are a stored table.
    """
    if "block" in instances.columns:
        return _scored_in_blocks(instances, model)
    known = _matched(instances, model, ["doc_id", "label"])
    return known.groupBy("doc_id", "label", "model").agg(F.sum("_part").alias("score"))


def _scored_in_blocks(instances: DataFrame, model: DataFrame) -> DataFrame:
    """`score` of instances in blocks; a feature's weights for all models go to a block together."""
    rows = instances.filter(F.size("counts") > 0)
    weighed = model.groupBy("feature").agg(F.collect_list(F.struct("model", "weight")).alias("_m"))
    weighed = weighed.select("feature", F.col("_m.model").alias("_models"), F.col("_m.weight").alias("_weights"))
    each = _each_count(rows, "block", "doc_id", "label").join(_sent_to_blocks(rows, weighed), ["block", "feature"])
    of_models = F.explode(F.arrays_zip(F.col("_models").alias("model"), F.col("_weights").alias("weight"))).alias("_m")
    parts = each.select("block", "doc_id", "label", "n", of_models)
    scores = parts.groupBy("block", "doc_id", "label", F.col("_m.model").alias("model")).agg(
        F.sum(F.col("n") * F.col("_m.weight")).alias("score")
    )
    with joined_as_dealt(instances.sparkSession):
        return cut(scores.drop("block"), "scores")


def classify(scores: DataFrame) -> DataFrame:
    """Scores with the prediction: spam above 0, else ham."""
    return scores.withColumn("prediction", classified("score"))


def ensemble(scores: DataFrame, method: str, instances: DataFrame, model: DataFrame) -> DataFrame:
    """(doc_id, label, score, prediction) over all models, for every instance.

    average: mean score. vote: +1 for every model above 0, -1 for every other.
    Models without a score for a document count as 0.
    """
    if method not in METHODS:
        raise ValueError(f"method must be one of {METHODS}, not {method!r}")
    n = model.agg(F.count_distinct("model").cast("double")).scalar()
    part = F.sum("score") if method == "average" else F.sum((F.col("score") > 0).cast("double"))
    parts = scores.groupBy("doc_id").agg(part.alias("_part"))
    joined = instances.select("doc_id", "label").join(parts, "doc_id", "left")
    total = F.coalesce("_part", F.lit(0.0))
    joint = total / n if method == "average" else 2 * total - n
    return classify(joined.select("doc_id", "label", joint.alias("score")))
