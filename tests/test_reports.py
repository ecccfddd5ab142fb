import io
from contextlib import redirect_stdout

import pytest
from plans import above

from corpuskit import operators as op
from corpuskit.functions import date_matches
from corpuskit.plans import QUERIES
from corpuskit.sources import write_index

SF = "/root/testdata/sf0.001"


def plan(df):
    out = io.StringIO()
    with redirect_stdout(out):
        df.explain()
    return out.getvalue()


def executed(df):
    """The final plan after AQE, once the query has run."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def table(spark, name):
    return spark.read.parquet(f"{SF}/{name}.parquet")


def test_whole_dates_are_pushed_to_the_scan(spark):
    items = table(spark, "lineitem")
    for pattern in ("1996-03-15", "1996-03", "1996"):
        text = plan(op.ship_count(items, pattern))
        assert "GreaterThanOrEqual(l_shipdate" in text and "LessThan(l_shipdate" in text
        assert "ReadSchema: struct<l_shipdate" in text


@pytest.mark.parametrize("pattern", ["1996-03-15", "1996-12", "1996", "-03-1", "96-", "1996-13", "9999"])
def test_date_pattern_is_a_substring_test(spark, pattern):
    items = table(spark, "lineitem")
    plain = items.filter(items.l_shipdate.cast("date").cast("string").contains(pattern)).count()
    assert items.filter(date_matches("l_shipdate", pattern)).count() == plain


def test_report_plans(spark):
    q2 = plan(QUERIES["q2_clerks"](spark, SF))
    assert "LeftSemi" in q2 and "TakeOrderedAndProject" in q2
    assert "BroadcastHashJoin" in plan(QUERIES["q3_parts"](spark, SF))
    q7 = plan(QUERIES["q7_unshipped"](spark, SF))
    assert "TakeOrderedAndProject" in q7 and "partial_sum" in q7


def test_large_sides_are_not_broadcast(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1")
    try:
        for name in ("q3_parts", "q4_nation", "q5_monthly", "q7_unshipped"):
            assert "BroadcastHashJoin" not in plan(QUERIES[name](spark, SF)), name
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_no_cross_joins_and_no_python(spark):
    for name, query in QUERIES.items():
        if name in ("train_sharded", "shuffled_quality"):
            continue
        text = plan(query(spark, SF))
        for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "MapInPandas"):
            assert bad not in text, (name, bad)


def test_strict_lookup(spark):
    items = table(spark, "lineitem")
    part, supplier = table(spark, "part"), table(spark, "supplier")
    some = part.filter("p_partkey > 10")
    kept = op.parts_suppliers(items, some, supplier, "1996", n=None).count()
    assert kept < op.parts_suppliers(items, part, supplier, "1996", n=None, strict=True).count()
    with pytest.raises(Exception, match="l_partkey is not in p_partkey"):
        op.parts_suppliers(items, some, supplier, "1996", strict=True).collect()
    with pytest.raises(Exception, match="is not in"):  # whatever is read of the rows
        op.parts_suppliers(items, some, supplier, "1996", n=None, strict=True).count()
    with pytest.raises(Exception, match="l_suppkey is not in s_suppkey"):
        op.parts_suppliers(items, part, supplier.limit(0), "1996", strict=True).collect()


def test_strict_lookup_needs_no_job_of_its_own(spark):
    items, part, supplier = (table(spark, t) for t in ("lineitem", "part", "supplier"))
    context = spark.sparkContext
    jobs = {}
    for strict in (False, True):
        context.setJobGroup(f"strict {strict}", "")
        op.parts_suppliers(items, part, supplier, "1996", n=None, strict=strict).collect()
        jobs[strict] = len(context.statusTracker().getJobIdsForGroup(f"strict {strict}"))
    context.setLocalProperty("spark.jobGroup.id", None)
    assert jobs[True] == jobs[False]


def test_one_order_with_most_line_items(spark):
    orders = spark.createDataFrame([(1, 5), (2, 5)], "o_orderkey bigint, o_custkey bigint")
    items = spark.range(3000).selectExpr(
        "IF(id % 3 = 0, 2, 1) AS l_orderkey", "date'1996-03-15' AS l_shipdate"
    )
    assert op.shipped_orders(orders, items, "1996-03-15").count() == 2
    customer = spark.createDataFrame([(5, 3)], "c_custkey bigint, c_nationkey int")
    rows = op.monthly_items(orders, items, customer).collect()
    assert [tuple(r) for r in rows] == [(3, "1996-03", 3000)]


def test_term_filter_reaches_the_index_files(spark, tmp_path):
    docs = table(spark, "documents").selectExpr("doc_id AS docno", "text AS line")
    path = str(tmp_path / "index")
    write_index(op.postings(docs), path, 4)
    text = plan(op.boolean_query(spark.read.parquet(path), "the and AND"))
    assert "In(term, [and,the])" in text
    assert text.count("Exchange") == 1


def test_shuffles_are_shared(spark):
    """Pairs get their names from one shuffle of the words, iterations need none of the links."""
    pmi = executed(QUERIES["pmi_pairs"](spark, SF))
    assert pmi.count("RoundRobin") == 0 and "ReusedExchange" in pmi
    assert "ReusedExchange" in executed(QUERIES["bigram_relfreq"](spark, SF))
    links = above(QUERIES["ppr_3_iterations"](spark, SF), "links_")
    assert len(links) == 3 and not any("Exchange hashpartitioning" in x for path in links for x in path)
