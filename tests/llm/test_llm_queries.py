"""The registered queries on the smallest tables, and the pipeline."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

import corpus_pipeline  # noqa: E402
from check import bag  # noqa: E402
from corpuskit import llm  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for f in os.listdir(SF):
        con.execute(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM '{SF}/{f}'")
    return con


@pytest.mark.parametrize("name", sorted(llm.ORACLES))
def test_query_equals_sql(spark, con, name):
    df = llm.QUERIES[name](spark, SF)
    got = con.execute(llm.ORACLES[name])
    columns = [d[0] for d in got.description]
    assert sorted(columns) == sorted(df.columns)
    assert bag(df.columns, df.collect()) == bag(columns, got.fetchall())


@pytest.mark.parametrize("name", sorted(set(llm.QUERIES) - set(llm.ORACLES)))
def test_other_queries_cover_all_rows(spark, name):
    df = llm.QUERIES[name](spark, SF)
    key = "conv_id" if "conv_id" in df.columns else "doc_id"
    table = spark.read.parquet(f"{SF}/{'conversations' if key == 'conv_id' else 'documents'}.parquet")
    assert df.select(key).distinct().count() == table.select(key).distinct().count()


def test_every_number_has_a_query():
    assert {int(n[2:].split("_")[0]) for n in llm.QUERIES} == set(range(1, 14))


def test_pipeline(spark):
    rows = corpus_pipeline.run(spark, SF).collect()
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert 0 < len({r.doc_id for r in rows}) < docs.count()


def test_stages_on_odd_and_empty_tables(spark, odd_documents, no_documents, clashing):
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, no_documents, SF).count() == 0
        got = stage(spark, odd_documents, SF)
        assert got.columns == odd_documents.columns and got.count() > 0
        assert stage(spark, clashing, SF).columns == clashing.columns


def test_packing_of_odd_and_empty_tables(spark, odd_documents, no_documents, clashing):
    assert corpus_pipeline.packed(spark, no_documents, SF).count() == 0
    rows = corpus_pipeline.packed(spark, odd_documents, SF).collect()
    ids = [r.doc_id for r in odd_documents.collect()]
    assert {r.doc_id for r in rows} == set(ids)
    assert sum(r.start == 0 for r in rows) == len(ids)
    assert corpus_pipeline.packed(spark, clashing, SF).columns == rows[0].__fields__


def test_different_texts_under_one_id_stay(spark, documents):
    words = [f"w{i}" for i in range(100)]
    text, near, other = " ".join(words), " ".join([*words, "x"]), " ".join(reversed(words))
    rows = [(1, text), (2, near), (2, other), (3, "something else"), (None, near + " y"), (None, other[:200]), (2, None)]
    got = corpus_pipeline.near_copies(spark, documents(rows), SF).collect()
    kept = sorted(((r.doc_id, r.text) for r in got), key=repr)
    assert kept == sorted([(1, text), (2, other), (3, "something else"), (None, other[:200]), (2, None)], key=repr)
    only = corpus_pipeline.near_copies(spark, documents([(9, near), (None, text), (5, text + " z")]), SF).collect()
    assert [(r.doc_id, r.text) for r in only] == [(5, text + " z")]


def test_decisions_take_effect(spark, documents):
    near = [f"w{i}" for i in range(100)]
    docs = documents(
        [(1, "a b c"), (2, "a  b c"), (3, " ".join(near)), (4, " ".join([*near, "x"])), (5, "token=abcdef here"), (6, None)]
    )
    rows = {r.doc_id: r for r in corpus_pipeline.near_copies(spark, corpus_pipeline.exact_copies(spark, docs, SF), SF).collect()}
    assert sorted(rows) == [1, 3, 5, 6]
    clean = {r.doc_id: (r.text, r.n_chars) for r in corpus_pipeline.secrets(spark, docs, SF).collect()}
    assert clean[5] == ("[SECRET] here", 13) and clean[1] == ("a b c", 5) and clean[6] == (None, None)
