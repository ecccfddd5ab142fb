import pytest
from plans import plan_lines
from pyspark.sql import functions as F

from corpuskit import operators as op
from corpuskit.operators import index

DOCS = [(0, "a b a"), (6, "b c"), (10, "a b d")]


@pytest.fixture
def postings(spark):
    return op.postings(spark.createDataFrame(DOCS, "docno bigint, line string"))


def docnos(df):
    return sorted(r.docno for r in df.collect())


@pytest.mark.parametrize("size", [1 << 16, 2, 1])
def test_index_and_gaps(postings, size):
    lists = {}
    for r in op.inverted_index(postings, size).orderBy("term", "segment").collect():
        df, found = lists.setdefault(r.term, (r.df, []))
        assert df == r.df and len(r.postings) <= size
        found.extend((p.docno, p.tf) for p in r.postings)
    assert lists == {
        "a": (2, [(0, 2), (10, 1)]),
        "b": (3, [(0, 1), (6, 1), (10, 1)]),
        "c": (1, [(6, 1)]),
        "d": (1, [(10, 1)]),
    }
    gaps = op.encode_gaps(postings, size).orderBy("term", "segment", "pos").collect()
    assert [r.gap for r in gaps if r.term == "b"] == [0, 6, 4]
    assert [r.gap for r in gaps if r.term == "a"] == [0, 10]
    decoded = op.decode_gaps(op.encode_gaps(postings, size))
    assert sorted(map(tuple, decoded.collect())) == sorted(map(tuple, postings.collect()))


@pytest.mark.parametrize("step", [1, 3, 100_003])
def test_hot_term_spans_segments(spark, step):
    """Segments have so many postings, however far apart the documents' numbers are."""
    docs = spark.range(1000).selectExpr(f"id * {step} AS docno", "concat('hot w', id % 7, 'x') AS line")
    found = op.postings(docs)
    rows = op.inverted_index(found, 256).filter("term = 'hot'").orderBy("segment").collect()
    assert [len(r.postings) for r in rows] == [256, 256, 256, 232] and {r.df for r in rows} == {1000}
    decoded = op.decode_gaps(op.encode_gaps(found, 64), group=2)
    assert decoded.exceptAll(found).count() == 0 and decoded.count() == found.count()


def test_no_task_has_all_postings_of_a_term(spark):
    """Only lists of a bounded length are put together by term; the others' postings leave before that, and go by range."""
    docs = spark.createDataFrame([*DOCS, *((i, "a") for i in range(20, 40))], "docno bigint, line string")
    plan = op.encode_gaps(op.postings(docs), longest=5)
    text = plan._jdf.queryExecution().executedPlan().toString()
    by_term = text[: text.index("hashpartitioning(_range")]
    assert "LeftAnti" in by_term and by_term.count("hashpartitioning(term") == 1
    lists, rest = index._lists(op.postings(docs), ("docno",), 5)
    assert {r.term for r in lists.collect()} == {"b", "c", "d"}
    assert [r.term for r in rest.select("term").distinct().collect()] == ["a"]


def test_postings_table_sums_repeated_cells(spark):
    rows = spark.createDataFrame(
        [("a", 1, 2), ("a", 1, 3), ("a", 9, 1)], "term string, docno bigint, tf int"
    )
    assert op.postings_table(rows).first().cells == {1: 5, 9: 1}


def test_terms_and_sets(postings):
    assert docnos(op.term_docs(postings, "a")) == [0, 10]
    assert docnos(op.term_docs(postings, "A")) == []
    a, c = op.term_docs(postings, "a"), op.term_docs(postings, "c")
    assert docnos(op.docs_or(a, c)) == [0, 6, 10]
    assert docnos(op.docs_and(a, c)) == []


QUERIES = {
    "a b AND": [0, 10],
    "c d OR": [6, 10],
    "a c AND d OR": [10],
    "zzz": [],
    "a c": [6],
    "A": [],
    "  b ": [0, 6, 10],
    "a b c OR AND": [0, 10],
    "d zzz AND": [],
}


def test_boolean_queries(postings):
    for rpn, expected in QUERIES.items():
        assert docnos(op.boolean_query(postings, rpn)) == expected, rpn


@pytest.mark.parametrize("rpn", ["AND", "a OR", "", "a b AND OR"])
def test_malformed_query(spark, postings, rpn):
    with pytest.raises(ValueError):
        op.boolean_query(postings, rpn)
    batch = spark.createDataFrame([(1, rpn), (2, "a")], "query_id int, rpn string")
    assert [tuple(r) for r in op.malformed(batch).collect()] == [(1, rpn)]
    got = op.boolean_query_batch(postings, batch).collect()
    assert sorted(map(tuple, got)) == [(2, 0), (2, 10)]


def batch_result(spark, postings, queries):
    table = spark.createDataFrame(list(queries.items()), "query_id string, rpn string")
    out = {q: [] for q in queries}
    for r in op.boolean_query_batch(postings, table).collect():
        out[r.query_id].append(r.docno)
    return {q: sorted(d) for q, d in out.items()}


def test_batch_equals_single(spark, postings):
    assert batch_result(spark, postings, {q: q for q in QUERIES}) == QUERIES


def test_batch_with_long_and_deep_queries(spark):
    words = ["w" + chr(97 + i // 26) + chr(97 + i % 26) for i in range(150)]
    docs = spark.createDataFrame(
        [(1, " ".join(words)), (2, " ".join(words[:-1])), (3, words[149]), (4, words[0])],
        "docno bigint, line string",
    )
    found = op.postings(docs)
    every = words[0] + " " + " ".join(f"{w} AND" for w in words[1:])
    last = " ".join(words) + " AND" * 148 + " OR"
    queries = {"all": every, "deep": last, "mixed": f"{every} {words[0]} OR"}
    expected = {q: docnos(op.boolean_query(found, q)) for q in queries.values()}
    assert batch_result(spark, found, {q: q for q in queries.values()}) == expected
    assert expected[every] == [1] and expected[queries["deep"]] == [1, 2, 4]


def test_fetch(spark, postings):
    docs = spark.createDataFrame(DOCS, "docno bigint, line string")
    rows = op.fetch(op.boolean_query(postings, "a b AND"), docs).collect()
    assert [tuple(r) for r in rows] == [(0, "a b a", "a b a"), (10, "a b d", "a b d")]


def test_a_frequent_term_only_narrows_down(spark):
    """Only documents with the rare term are asked for the frequent one."""
    docs = spark.range(500).selectExpr("id AS docno", "concat('hot ', if(id % 100 = 0, 'rare', 'x')) AS line")
    queries = {"hot rare AND": "hot rare AND", "rare hot AND": "rare hot AND", "rare zzz OR hot AND": "rare zzz OR hot AND"}
    found = op.postings(docs)
    assert set(map(tuple, batch_result(spark, found, queries).values())) == {(0, 100, 200, 300, 400)}


@pytest.mark.parametrize("block", [1, 3, 1 << 16])
def test_seeds_in_pieces_of_any_size(spark, block):
    docs = spark.createDataFrame([(i, "hot " + ("rare " if i % 9 == 0 else "") + f"w{'abc'[i % 3]}") for i in range(60)], "docno bigint, line string")
    found = op.postings(docs)
    rpns = ["hot", "hot rare AND", "hot wa AND wb OR", "rare wa AND", "wa wb AND", "none hot OR", "none hot AND"]
    queries = spark.createDataFrame(list(enumerate(rpns)), "query_id int, rpn string")
    got = {}
    for r in op.boolean_query_batch(found, queries, block=block).collect():
        got.setdefault(r.query_id, []).append(r.docno)
    for i, rpn in enumerate(rpns):
        assert sorted(got.get(i, [])) == docnos(op.boolean_query(found, rpn)), rpn


@pytest.mark.parametrize("longest", [0, 20, 1 << 16])
def test_lists_are_the_same_in_one_row_and_in_ranges(spark, longest):
    docs = [(i * 3 - 20, " ".join(["hot"] * (1 + i % 2) + [f"w{'abcde'[i % 5]}"])) for i in range(90)]
    found = op.postings(spark.createDataFrame(docs, "docno bigint, line string"))
    found = found.union(spark.createDataFrame([(None, 1, 1)], "term string, docno bigint, tf int"))
    expected = {}
    for docno, line in docs:
        for w in dict.fromkeys(line.split()):
            expected.setdefault(w, []).append((docno, line.split().count(w)))
    got, df = {}, {}
    for r in op.inverted_index(found, 7, longest=longest).orderBy("term", "segment").collect():
        assert len(got.setdefault(r.term, [])) == 7 * r.segment
        got[r.term] += [tuple(p) for p in r.postings]
        df[r.term] = r.df
    assert got == expected and df == {t: len(x) for t, x in expected.items()}
    gaps = op.encode_gaps(found, 7, longest=longest).orderBy("term", "segment", "pos").collect()
    for t, entries in expected.items():
        at = [0] + [d for d, _ in entries]
        own = [(r.segment * 7 + r.pos, r.gap, r.tf) for r in gaps if r.term == t]
        assert own == [(i, d - at[i], tf) for i, (d, tf) in enumerate(entries)]
    cells = {}
    for r in op.postings_table(found.union(found), 7, longest=longest).filter("term IS NOT NULL").collect():
        cells.setdefault(r.term, {}).update(r.cells)
    assert cells == {t: {d: 2 * tf for d, tf in x} for t, x in expected.items()}


def test_short_lists_need_one_shuffle_of_the_postings(spark):
    docs = spark.createDataFrame([(i, "a b c") for i in range(50)], "docno bigint, line string")
    index = op.inverted_index(op.postings(docs), 10)
    assert sum("Exchange" in line for _, line in plan_lines(index)) == 1


@pytest.mark.parametrize("buckets", [1, 4, 1 << 16])
def test_long_lists_are_found_by_way_of_buckets(spark, buckets):
    sizes = {"a": 9, "b": 10, "c": 11, "d": 40, "e": 1}
    rows = [(t, p, i, 1) for t, n in sizes.items() for p in (1, None) for i in range(n)]
    stored = spark.createDataFrame(rows, "term string, path bigint, docno bigint, tf int")
    found = index._long_lists(stored, ["term", "path"], 10, buckets)
    assert {(r.term, r.path) for r in found.collect()} == {(t, p) for t in "cd" for p in (1, None)}
    assert index._long_lists(stored, ["term", "path"], 40, buckets).isEmpty()


def test_tasks_that_count_occurrences_grow_in_number_with_the_texts(spark):
    docs = spark.range(8).select(F.col("id").alias("docno"), F.repeat(F.lit("ab "), 700_000).alias("line"))
    plan = op.postings(docs)._jdf.queryExecution().executedPlan().toString()
    assert "docno#" in plan and ", 5), REPARTITION_BY_NUM" in plan
    assert op.postings(docs.limit(0)).count() == 0


def test_lists_are_dealt_out_before_they_are_collected(lines):
    plan = op.encode_gaps(op.postings(lines(["a b", "b c"])))._jdf.queryExecution().executedPlan().toString()
    assert plan.index("partial_collect_list") < plan.index("REPARTITION_BY_NUM")
