"""Decisions that go to rows at their places, and plans that exchange no texts."""

import re

import pytest
from pyspark.sql import functions as F

from corpuskit.llm import exact_dedup, places, secret_scan


@pytest.fixture
def many(spark, tmp_path):
    """1,000 rows in several files, with columns of names used inside."""
    path = str(tmp_path / "many")
    rows = spark.range(0, 1000, 1, 5).select(
        F.col("id").alias("doc_id"), F.concat(F.lit("text "), F.col("id") % 300).alias("text"), F.lit(1).alias("at")
    )
    rows.withColumns({"file": F.lit(2), "_word": F.lit(3)}).write.parquet(path)
    return spark.read.parquet(path)


@pytest.mark.parametrize("bound", [1, 3, 7, 1 << 20])
def test_rows_are_dropped_at_their_places(many, bound):
    assert places.stored(many) is many
    gone = many.filter("doc_id % 3 = 0").select(places.place(many).alias("p")).select("p.*")
    left = places.without(many, gone, bound)
    assert left.columns == many.columns
    assert sorted(r.doc_id for r in left.collect()) == [i for i in range(1000) if i % 3]


def test_flags_are_told_apart(many):
    flagged = many.select(places.place(many).alias("p"), (F.col("doc_id") % 2 == 0).alias("a"), (F.col("doc_id") % 5 == 0).alias("b"))
    for bound in (2, 1 << 20):
        got = places.with_flags(
            many, flagged.filter("a OR b").select("p.*", "a", "b"), ["a", "b"], lambda d, f: d.select("doc_id", f[0].alias("a"), f[1].alias("b")), bound
        )
        assert sorted(map(tuple, got.collect())) == [(i, i % 2 == 0, i % 5 == 0) for i in range(1000)]


def test_other_tables_are_stored_first(many, no_documents, spark):
    for df in (many.filter("doc_id < 10"), many.join(many.select("doc_id"), "doc_id"), many.union(many), no_documents):
        table = places.stored(df)
        assert table is not df
        assert table.count() == df.count() == table.select(places.place(table)).distinct().count()
    assert places.without(places.stored(no_documents), spark.createDataFrame([], "file bigint, at bigint")).count() == 0


def test_a_column_may_be_named_as_the_hidden_one(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([(1, "a", "x"), (2, "a", "y")], "doc_id bigint, text string, _metadata string").write.parquet(path)
    got = exact_dedup.dedup(spark.read.parquet(path)).collect()
    assert [(r.doc_id, r["_metadata"]) for r in got] == [(1, "x")]


def exchanged(df):
    """The shuffles in the plan before any run, and the plan."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [line for line in plan.splitlines() if re.search(r"\bExchange\b", line)], plan


@pytest.mark.parametrize("max_words", [1, 1 << 20])
def test_no_text_is_exchanged(many, max_words, tmp_path, monkeypatch):
    out = exact_dedup.dedup(many, max_words=max_words)
    assert not exchanged(out)[0] and "SortMergeJoin" not in exchanged(out)[1]
    assert sorted(r.doc_id for r in out.collect()) == list(range(300))

    plans, real = [], places.with_flags
    monkeypatch.setattr(secret_scan.places, "with_flags", lambda *a, **k: plans.append(real(*a, **k)) or plans[-1])
    ledger = str(tmp_path / "ledger")
    for _ in range(2):
        secret_scan.update_ledger(many, "text", ledger, max_words=max_words)
        assert secret_scan.read_ledger(many.sparkSession, ledger).count() == 900
    assert len(plans) == 2 and not any(exchanged(p)[0] for p in plans)


def test_rules_that_are_left_go_to_one_row_of_each_text(many, tmp_path):
    ledger = str(tmp_path / "ledger")
    secret_scan.update_ledger(many.filter("doc_id < 100"), "text", ledger, secret_scan.RULES[:1])
    secret_scan.update_ledger(many, "text", ledger)
    kinds = secret_scan.read_ledger(many.sparkSession, ledger).groupBy("blob", "kind").count()
    assert kinds.count() == 900 and kinds.filter("count > 1").count() == 0
