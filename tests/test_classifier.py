import hashlib
import math
import re

import pytest
from models import roca
from plans import plan_lines
from pyspark.sql import functions as F

from corpuskit import operators as op
from corpuskit.operators import classifier
from corpuskit.sources import cut

SMALL = [("d1", "spam", [1, 2, 2]), ("d2", "ham", [2, 3]), ("d3", "spam", [3])]
SCHEMA = "doc_id string, label string, features array<int>"


@pytest.fixture
def small(spark):
    return spark.createDataFrame(SMALL, SCHEMA)


def many():
    rows = []
    for i in range(300):
        label = "spam" if i % 3 == 0 else "ham"
        # feature 0 is in every document
        features = [0] + [(i * k + k) % 23 for k in range(1, 1 + i % 9)] + [30 + (label == "spam")]
        rows.append((f"d{i:04d}", label, features))
    return rows


def weights(model):
    return {r.feature: r.weight for r in model.collect()}


def batch(doc_id, seed, batches):
    return int(hashlib.md5(f"{doc_id}:{seed}".encode()).hexdigest()[:7], 16) % batches


@pytest.mark.parametrize("batches", [1, 2, 5])
def test_batches_train_one_after_another(spark, batches):
    rows = many() + [("empty", "ham", [])]
    instances = spark.createDataFrame(rows, SCHEMA)
    got = {}
    for r in op.train_batches(instances.repartition(7), batches, [3, 8]).collect():
        got.setdefault(r.model, {})[r.feature] = r.weight
    for seed in (3, 8):
        w = {}
        for i in range(batches):
            w = gradient([r for r in rows if batch(r[0], seed, batches) == i], 1, w=w)
        assert got[seed] == pytest.approx(w)
    assert batches == 1 or got[3][0] != got[8][0]


def test_a_step_reads_its_own_batch_once(spark):
    instances = spark.createDataFrame(many(), SCHEMA)
    rows = op.deal(instances, 3, [3, 8])
    assert rows.filter("batch = 1").agg(F.sum("n")).first()[0] == sum(
        len(fs) for d, _, fs in many() for seed in (3, 8) if batch(d, seed, 3) == 1
    )
    weights = op.batch_step(rows.filter("batch = 0"), None)
    step = op.batch_step(rows.filter("batch = 1"), weights)
    scans = [x for _, x in plan_lines(step) if "FileScan" in x]
    assert sorted(re.search(r"PartitionFilters: \[(.*?)\]", x).group(1).split(" = ")[1][:1] for x in scans if "doc_id" in x) == ["1"]
    assert all("PartitionFilters: [isnotnull(batch" in x for x in scans)


def test_repeated_documents_and_odd_instances(spark):
    rows = [("a", "spam", [1, 1, 2]), ("a", "spam", [2]), ("a", "ham", [3]), ("b", "ham", None), ("c", None, [1]), ("d", "ham", [])]
    instances = spark.createDataFrame(rows, SCHEMA)
    for seeds in ([1], [1, 2]):
        got = op.train_batches(instances, 1, seeds).collect()
        assert {(r.model, r.feature) for r in got} == {(s, f) for s in seeds for f in (1, 2, 3)}
    assert op.train_batches(instances.limit(0), 2).count() == 0


def test_training_needs_no_python_on_executors(small):
    plan = op.train_batches(small, 3)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def gradient(rows, rounds, delta=0.002, w=None):
    w = w or {}
    for _ in range(rounds):
        step = {}
        for _, label, fs in rows:
            p = 1 / (1 + math.exp(-sum(w.get(f, 0.0) for f in fs)))
            for f in fs:
                step[f] = step.get(f, 0.0) + delta * ((label == "spam") - p)
        w = w | {f: w.get(f, 0.0) + s for f, s in step.items()}
    return w


@pytest.mark.parametrize("rounds", [1, 2, 4])
def test_gradient(spark, rounds):
    rows = many() + [("empty", "ham", [])]
    instances = spark.createDataFrame(rows, SCHEMA)
    assert weights(op.train_gradient(instances, rounds)) == pytest.approx(gradient(rows, rounds))


def test_gradient_by_group_and_union(spark):
    rows = many()
    sets = [spark.createDataFrame(rows[i::2], SCHEMA) for i in (0, 1)]
    both = op.union_sets(*sets)
    assert weights(op.train_gradient(both, 2)) == pytest.approx(gradient(rows, 2))
    named = op.union_sets(*[s.withColumn("model", F.lit(str(i))) for i, s in enumerate(sets)])
    got = op.train_gradient(named, 2, by=["model"]).collect()
    for i in (0, 1):
        mine = {r.feature: r.weight for r in got if r.model == str(i)}
        assert mine == pytest.approx(gradient(rows[i::2], 2))


def test_score_counts_occurrences_and_unknown_features(spark):
    instances = spark.createDataFrame(
        [("a", "spam", [1, 1, 7]), ("b", "ham", [9]), ("c", "ham", [])], SCHEMA
    )
    model = spark.createDataFrame(
        [("x", 1, 0.5), ("y", 1, -1.0), ("y", 7, 3.0)], "model string, feature int, weight double"
    )
    got = {(r.doc_id, r.model): r.score for r in op.score(instances, model).collect()}
    assert got == {("a", "x"): 1.0, ("a", "y"): 1.0}
    average = op.ensemble(op.score(instances, model), "average", instances, model).collect()
    assert {r.doc_id: (r.score, r.prediction) for r in average} == {
        "a": (1.0, "spam"), "b": (0.0, "ham"), "c": (0.0, "ham")
    }


def test_ensembles(spark):
    scores = spark.createDataFrame(
        [("d", "spam", "x", 1.0), ("d", "spam", "y", -0.5)],
        "doc_id string, label string, model string, score double",
    )
    instances = spark.createDataFrame([("d", "spam", [1])], SCHEMA)
    model = spark.createDataFrame([(m, 1, 0.0) for m in "xyz"], "model string, feature int, weight double")
    average = op.ensemble(scores, "average", instances, model).first()
    assert average.score == pytest.approx(1 / 6) and average.prediction == "spam"
    vote = op.ensemble(scores, "vote", instances, model).first()
    assert vote.score == -1.0 and vote.prediction == "ham"
    with pytest.raises(ValueError):
        op.ensemble(scores, "median", instances, model)


def test_documents_without_a_score_count_as_zero(spark):
    population = [(i, "spam" if i % 3 == 0 else "ham") for i in range(60)]
    scored = [(i, label, m, float((i * 7) % 11 - 5)) for i, label in population for m in ("x", "y") if (i + (m == "y")) % 4]
    scores = spark.createDataFrame(scored, "doc_id int, label string, model string, score double")
    everyone = spark.createDataFrame(population, "doc_id int, label string")
    got = {r.model: (r.n_spam, r.n_ham, r.one_minus_roca) for r in op.one_minus_roca(scores, ["model"], everyone).collect()}
    for m in ("x", "y"):
        own = {i: s for i, _, model, s in scored if model == m}
        expected = roca([(label, own.get(i, 0.0)) for i, label in population])
        assert got[m] == (20, 40, pytest.approx(expected))


def test_roca(spark):
    schema = "run int, label string, score double"
    rows = [(1, "spam", 3.0), (1, "spam", 1.0), (1, "ham", 2.0), (1, "ham", 1.0)]
    scores = spark.createDataFrame(rows, schema)
    assert op.one_minus_roca(scores).first().one_minus_roca == pytest.approx(37.5)
    more = rows + [
        (2, "spam" if i % 5 == 0 else "ham", float((i * 37) % 11 + (i % 5 == 0))) for i in range(500)
    ]
    # one score holds a third of all rows
    more += [(2, "spam" if i % 2 else "ham", 4.0) for i in range(250)]
    got = op.one_minus_roca(spark.createDataFrame(more, schema), ["run"])
    for r in got.collect():
        expected = roca([(label, s) for run, label, s in more if run == r.run])
        assert r.one_minus_roca == pytest.approx(expected)
    mean = op.mean_over_runs(got).first()
    assert mean.n_runs == 2 and mean.lowest <= mean["mean"] <= mean.highest


def test_a_document_is_stored_once_for_each_of_its_batches(spark):
    instances = spark.createDataFrame([*many(), ("twice", "spam", [4, None, 4, 2]), ("none", "ham", None)], SCHEMA)
    seeds = list(range(12))
    rows = op.deal(instances, 2, seeds)
    stored = spark.read.parquet(*{f.rsplit("/batch=", 1)[0] for f in rows.inputFiles()})
    assert stored.groupBy("doc_id", "batch").count().filter("count > 1").isEmpty()
    got = {(r.feature, r.n) for r in rows.filter("doc_id = 'twice' AND model = 3").collect()}
    assert got == {(4, 2), (None, 1), (2, 1)}
    # counted in the row: nothing is shuffled before the step
    assert not any("Exchange" in x for _, x in plan_lines(rows))


def odd(spark):
    """Documents that come twice or have no name, no features or a feature that is null."""
    rows = [*many()[:60], ("d0001", "spam", [3, 3]), (None, "ham", [2, 30]), (None, "spam", [31]), ("n", "ham", [None, 5]), ("e", "ham", []), ("z", "ham", None)]
    return spark.createDataFrame(rows, SCHEMA)


def test_a_round_shuffles_occurrences_once_and_not_by_document(spark):
    stored = cut(op.with_counts(odd(spark)), "instances")
    weights = cut(op.train_gradient(stored, 1), "weights")
    plan = [x for _, x in plan_lines(classifier._round(classifier._learned_from(stored).withColumn("y", F.lit(1.0)), weights, 0.1, []))]
    assert not any("Window" in x for x in plan)
    assert sum("Exchange hashpartitioning(feature" in x and "ENSURE" in x for x in plan) <= 3
    scored = [x for _, x in plan_lines(op.score(stored, weights.withColumn("model", F.lit("m"))))]
    by_document = [x for x in scored if "Exchange hashpartitioning(doc_id" in x]
    assert by_document and not any("feature" in x for x in by_document)


def test_counted_instances_train_and_score_alike(spark):
    instances = odd(spark)
    counted = op.with_counts(instances)
    assert counted.columns == ["doc_id", "label", "counts"] and counted.count() == instances.count()
    assert op.with_counts(counted) is counted
    # a document's rows are one sum, also without a name; a null feature never meets its weight
    first = weights(op.train_gradient(instances, 1))
    sums, expected = {}, dict(first)
    rows = instances.collect()
    for d, _, fs in rows:
        sums[d] = sums.get(d, 0.0) + sum(first[f] for f in fs or [] if f is not None)
    for d, label, fs in rows:
        for f in fs or []:
            expected[f] += 0.002 * ((label == "spam") - 1 / (1 + math.exp(-sums[d])))
    for some in (instances, counted):
        assert weights(op.train_gradient(some, 2)) == pytest.approx(expected)
        model = op.train_gradient(some, 2).withColumn("model", F.lit("m"))
        got = {(r.doc_id, r.label): r.score for r in op.score(some, model).collect()}
        want = {}
        for d, label, fs in rows:
            for f in fs or []:
                if f is not None:
                    want[d, label] = want.get((d, label), 0.0) + expected[f]
        assert got == pytest.approx(want)
        batches = {(r.model, r.feature): r.weight for r in op.train_batches(some, 2, [1, 2]).collect()}
        assert {f for _, f in batches} == set(expected)


@pytest.fixture
def blocks(spark, monkeypatch):
    """Instances with odd rows in five blocks."""
    monkeypatch.setattr(classifier, "tasks_for", lambda spark, n, least: 5)
    return op.in_blocks(op.with_counts(odd(spark)))


def test_a_block_has_all_rows_of_its_documents(spark, blocks):
    assert op.in_blocks(blocks) is blocks and len(blocks.inputFiles()) == 5
    assert blocks.groupBy("doc_id").agg(F.count_distinct("block").alias("n")).filter("n > 1").isEmpty()
    assert blocks.drop("block").exceptAll(op.with_counts(odd(spark))).isEmpty() and blocks.count() == odd(spark).count()


def test_documents_in_blocks_train_and_score_alike(spark, blocks):
    rows = op.deal(odd(spark), 2, [1, 2, 2])
    expected = op.batch_step(rows.filter("batch = 1"), cut(op.batch_step(rows.filter("batch = 0"), None), "weights"))
    got = op.train_batches(blocks, 2, [1, 2, 2])
    both = [{(r.model, r.feature): r.weight for r in x.collect()} for x in (got, expected)]
    assert both[0] == pytest.approx(both[1]) and len(both[0]) > 20
    model = cut(got, "model")
    scores = [{(r.doc_id, r.label, r.model): r.score for r in op.score(x, model).collect()} for x in (blocks, odd(spark))]
    assert scores[0] == pytest.approx(scores[1]) and (None, "ham", 2) in scores[0]


def test_weights_go_to_the_blocks_and_no_occurrence_is_shuffled(spark, blocks, monkeypatch):
    model = cut(op.train_batches(blocks, 1, [1, 2]), "model")
    written = []
    monkeypatch.setattr(classifier, "cut", lambda df, name: written.append((name, plan_lines(df))) or cut(df, name))
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        op.train_batches(blocks, 2, [1, 2])
        op.score(blocks, model)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert [name for name, _ in written] == ["weights", "weights", "scores"]
    for _, lines in written[1:]:
        dealt = [x.partition("hashpartitioning(")[2] for _, x in lines if "Exchange hashpartitioning(" in x]
        # once to the blocks, the weights; else by feature, and what is asked for has a row per block and feature
        assert sum(x.startswith("block") for x in dealt) == 1 and all(x.startswith(("block", "feature")) for x in dealt)
        assert any("HashAggregate(keys=[block" in x and "feature" in x for _, x in lines)
