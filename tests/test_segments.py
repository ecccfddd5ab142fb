"""Segments that can be skipped, and cells that are added to a stored table."""

import random
import re

import pytest
from plans import above, plan_lines
from pyspark.sql import functions as F

from corpuskit import operators as op
from corpuskit import sources as src
from corpuskit.sources.cells import _summed
from corpuskit.sources.state import tasks_for

POSTINGS = "term string, docno bigint, tf int"


def written(spark, path, lists, parts=3, rows=10):
    """An index of {term: docnos}."""
    all_rows = [(t, d, 1 + d % 3) for t, docs in lists.items() for d in docs]
    src.write_segments(spark.createDataFrame(all_rows, POSTINGS), path, parts, rows)
    return path


def test_segments_cover_all_postings(spark, tmp_path):
    lists = {"a": range(95), "b": range(1000, 1007), "c": [5]}
    path = written(spark, f"{tmp_path}/i", lists)
    skips = src.read_skips(spark, path).collect()
    assert {t: sum(r.n for r in skips if r.term == t) for t in lists} == {"a": 95, "b": 7, "c": 1}
    assert all(r.n <= 10 and r.lowest <= r.highest for r in skips)
    for t in lists:  # segments of a term lie one after another
        spans = sorted((r.lowest, r.highest) for r in skips if r.term == t)
        assert all(x[1] < y[0] for x, y in zip(spans, spans[1:], strict=False))
    stored = spark.read.parquet(f"{path}/postings")
    inside = stored.join(src.read_skips(spark, path), ["term", "part", "segment"])
    assert inside.filter(F.col("docno").between(F.col("lowest"), F.col("highest"))).count() == 103
    got = src.read_segments(spark, path).collect()
    assert sorted((r.term, r.docno) for r in got) == sorted((t, d) for t, docs in lists.items() for d in docs)


def test_disjoint_segments_are_not_read(spark, tmp_path):
    lists = {"a": [*range(1000), *range(9000, 9020)], "b": [*range(5000, 6000), *range(9010, 9030)], "z": range(10_000)}
    path = written(spark, f"{tmp_path}/i", lists, parts=6, rows=50)
    alive = op.alive_segments(src.read_skips(spark, path), "a b AND").collect()
    assert 2 <= len(alive) <= 4 and all(r.highest >= 9000 for r in alive)
    table = spark.createDataFrame(alive)
    read = src.read_segments(spark, path, table)
    # only the folders of these segments, and in them only files and row groups with these terms and documents
    scan = next(x for _, x in plan_lines(read) if "FileScan" in x and "tf" in x)
    assert "PartitionFilters" in scan and "GreaterThanOrEqual(docno" in scan and "In(term" in scan
    folders = re.search(r"PartitionFilters: \[[^\]]*part#\d+ IN \(([\d,]+)\)", scan).group(1)
    assert set(map(int, folders.split(","))) == {r.part for r in alive} != set(range(6))
    assert read.count() <= 200
    assert [r.docno for r in op.skipping_query(spark, path, "a b AND").orderBy("docno").collect()] == list(range(9010, 9020))


@pytest.mark.parametrize("rpn", ["a b AND", "a b OR", "a b AND c OR", "a b OR c AND d AND", "a b AND c AND d AND", "a", "a none AND", "none"])
def test_any_query_is_as_without_skipping(spark, tmp_path, rpn):
    rnd = random.Random(len(rpn))
    starts = {"a": 0, "b": 300, "c": 100, "d": 350}
    lists = {t: sorted(rnd.sample(range(s, s + 400), 150)) + [10_000 + s] for t, s in starts.items()}
    path = written(spark, f"{tmp_path}/i", lists, rows=7)
    whole = op.boolean_query(src.read_segments(spark, path), rpn)
    found = op.skipping_query(spark, path, rpn)
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, whole.collect()))


def test_odd_indexes(spark, tmp_path):
    path = f"{tmp_path}/empty"
    src.write_segments(spark.createDataFrame([], POSTINGS), path, 2)
    with pytest.raises(ValueError):
        op.skipping_query(spark, path, "AND")
    path = f"{tmp_path}/odd"
    rows = [(None, 1, 1), ("a", -5, 1), ("a", 2**60, 1), ("b", -5, 2)]
    src.write_segments(spark.createDataFrame(rows, POSTINGS).withColumn("part", F.lit("x")), path, 2)
    assert src.read_segments(spark, path).count() == 3
    assert [r.docno for r in op.skipping_query(spark, path, "a b AND").collect()] == [-5]


def cells(df):
    return {(r.term, r.docno): r.tf for r in df.collect()}


def test_two_loads(spark):
    first = spark.createDataFrame([("a", 1, 2), ("a", 1, 3), ("b", 2, 1), (None, 3, 1), ("c", None, 1)], POSTINGS)
    table = src.create_cells(first, "cells", 4)
    assert cells(table) == {("a", 1): 5, ("b", 2): 1}
    more = spark.createDataFrame([("a", 1, 10), ("a", 2, 1), ("a", 2, 1), ("d", 9, 4)], POSTINGS)
    after = src.upsert_cells(table, more, "cells", 4)
    assert cells(after) == {("a", 1): 15, ("a", 2): 2, ("b", 2): 1, ("d", 9): 4}
    assert cells(table) == {("a", 1): 5, ("b", 2): 1}  # the version before
    assert cells(src.upsert_cells(after, more.limit(0), "cells", 4)) == cells(after)
    assert cells(src.upsert_cells(src.create_cells(first.limit(0), "cells", 4), more, "cells", 4)) == {
        ("a", 1): 10, ("a", 2): 2, ("d", 9): 4
    }


def test_the_table_is_merged_where_it_lies(spark):
    hot = spark.createDataFrame([("hot", i, 1) for i in range(3000)], POSTINGS)
    table = src.create_cells(hot, "hot", 4)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        paths = above(src.merged_cells(table, hot), "hot_")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert len(paths) == 1 and "Join" in paths[0][-1] and not any("Exchange" in x for x in paths[0])
    # one term, but even buckets
    sizes = [r["count"] for r in table.groupBy(F.input_file_name()).count().collect()]
    assert len(sizes) == 4 and max(sizes) < 2 * min(sizes)


def test_parts_of_an_index_are_bounded(spark, tmp_path):
    rows = spark.createDataFrame([(f"t{i % 7}", i, 1) for i in range(2000)], POSTINGS)
    path = f"{tmp_path}/i"
    src.write_segments(rows, path, 1, 10, part_rows=100)
    sizes = [r.n for r in src.read_skips(spark, path).groupBy("part").agg(F.sum("n").alias("n")).collect()]
    assert sum(sizes) == 2000 and len(sizes) > 15 and max(sizes) <= 200
    found = op.skipping_query(spark, path, "t3").collect()
    assert sorted(r.docno for r in found) == list(range(3, 2000, 7))


def test_tasks_grow_with_the_rows():
    assert [tasks_for(None, rows, 3, 4) for rows in (0, 12, 13, 400)] == [3, 3, 4, 100]


def test_cells_are_summed_in_their_buckets(spark):
    rows = spark.createDataFrame([("a", i % 50, 1) for i in range(500)], POSTINGS)
    lines = [x for _, x in plan_lines(_summed(rows, 6))]
    exchanges = [x for x in lines if "Exchange" in x]
    assert len(exchanges) == 1 and re.search(r"hashpartitioning\(term#\d+, docno#\d+L, 6\)", exchanges[0])
    table = src.create_cells(rows, "cells", 6)
    assert cells(table) == {("a", i): 10 for i in range(50)}
    assert cells(src.upsert_cells(table, rows, "cells", 6)) == {("a", i): 20 for i in range(50)}


def test_postings_are_not_counted_where_they_are_read(spark):
    docs = spark.createDataFrame([(1, "a b a"), (1, "a"), (None, "b"), (None, "b")], "docno bigint, line string")
    found = op.postings(docs)
    lines = [x for _, x in plan_lines(found)]
    last = max(i for i, x in enumerate(lines) if "Exchange" in x)
    assert not any("Aggregate" in x for x in lines[last:])
    rows = {(r.term, r.docno): r.tf for r in found.collect()}
    assert rows == {("a", 1): 3, ("b", 1): 1, ("b", None): 2}
