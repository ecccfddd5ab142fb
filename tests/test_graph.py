import pytest
from models import pagerank
from plans import above, plan_lines
from pyspark.sql import functions as F

from corpuskit import operators as op
from corpuskit import sources as src

NODES = [1, 2, 3, 4]
EDGES = [(1, 2), (1, 3), (2, 1), (4, 9), (4, 1), (4, 1)]


@pytest.fixture
def tables(spark):
    def make(nodes=NODES, edges=EDGES):
        return (
            spark.createDataFrame([(n,) for n in nodes], "node bigint"),
            spark.createDataFrame(edges, "src bigint, dst bigint"),
        )

    return make


def table(df, sources):
    return df.sparkSession.createDataFrame([(s,) for s in sources], "source bigint")


def as_dict(ranks):
    return {(r.source, r.node): r.mass for r in ranks.collect()}


def model(nodes, edges, sources, iterations):
    out = {}
    for s in sources:
        ranked = pagerank(nodes, edges, s, iterations).items()
        out.update({(s, n): m for n, m in ranked if m > 0})
    return out


def test_stats(tables):
    nodes, edges = tables()
    assert tuple(op.graph_stats(nodes, edges).first()) == (4, 6, 3)
    assert [r.node for r in op.missing_targets(nodes, edges).collect()] == [9]
    assert tuple(op.message_counts(nodes, edges).first()) == (6, 1)


def test_repeated_nodes_are_reported_and_count_once(tables):
    assert op.repeated_nodes(tables()[0]).count() == 0
    nodes, edges = tables([1, 2, 2, 3, 4])
    assert [tuple(r) for r in op.repeated_nodes(nodes).collect()] == [(2, 2)]
    ranks = op.personalized_pagerank(op.prepare(nodes, edges), table(nodes, [1, 4]), 2)
    assert as_dict(ranks) == pytest.approx(model(NODES, EDGES, [1, 4], 2))


def test_sources(tables):
    nodes, _ = tables()
    got = op.ppr_init(nodes, table(nodes, [4, 1, 4, 77])).collect()
    assert sorted(map(tuple, got)) == [(1, 1, 1.0), (4, 4, 1.0)]
    assert [r.source for r in op.unknown_sources(nodes, table(nodes, [1, 77])).collect()] == [77]
    assert op.ppr_init(nodes, table(nodes, [])).count() == 0


@pytest.mark.parametrize("iterations", [1, 2, 3])
def test_pagerank_golden(tables, iterations):
    graph = op.prepare(*tables())
    ranks = op.personalized_pagerank(graph, table(graph.nodes, [1, 4]), iterations)
    assert as_dict(ranks) == pytest.approx(model(NODES, EDGES, [1, 4], iterations))


def test_golden_numbers(tables):
    graph = op.prepare(*tables())
    got = as_dict(op.personalized_pagerank(graph, table(graph.nodes, [1, 4]), 3))
    assert got[1, 1] == pytest.approx(0.258375) and got[1, 2] == pytest.approx(0.3708125)
    assert got[4, 4] == pytest.approx(0.43199537) and got[4, 1] == pytest.approx(0.35928241)
    ranks = op.personalized_pagerank(graph, table(graph.nodes, [1]), 3)
    top = op.top_k(ranks, 2, graph.nodes).orderBy("rank").collect()
    assert [r.node for r in top] == [2, 3] and top[0].shown == "0.37081 2"


def test_step_and_missing(tables):
    nodes, edges = tables()
    graph = op.prepare(nodes, edges)
    stepped = op.ppr_step(op.ppr_init(nodes, table(nodes, [1, 3, 4])), graph)
    assert as_dict(stepped) == pytest.approx({(1, 2): 0.5, (1, 3): 0.5, (4, 1): 2 / 3})
    missing = {r.source: r.missing for r in op.missing_mass(stepped, table(nodes, [1, 3, 4])).collect()}
    assert missing == pytest.approx({1: 0.0, 3: 1.0, 4: 1 / 3})


def hub_graph():
    nodes = list(range(60))
    edges = [(0, i) for i in range(1, 60)] + [(i, 0) for i in range(1, 50)]
    edges += [(i, (i * 7) % 70) for i in range(1, 50)] + [(5, 6), (5, 6)]
    return nodes, edges


def test_hubs_equal_model(tables):
    nodes, edges = hub_graph()
    graph = op.prepare(*tables(nodes, edges))
    got = as_dict(op.personalized_pagerank(graph, table(graph.nodes, [0, 7, 59]), 9, cut_every=3))
    assert got == pytest.approx(model(nodes, edges, [0, 7, 59], 9))
    for s in (0, 7, 59):
        assert sum(m for (source, _), m in got.items() if source == s) == pytest.approx(1.0)


def test_saved_states_and_resume(tables, spark, tmp_path):
    graph = op.prepare(*tables())
    path = str(tmp_path / "states")
    op.personalized_pagerank(graph, table(graph.nodes, [1, 4]), 2, save_to=path)
    saved = spark.read.parquet(f"{path}/iter0001")
    assert as_dict(saved) == pytest.approx(model(NODES, EDGES, [1, 4], 1))
    resumed = op.personalized_pagerank(graph, table(graph.nodes, [1, 4]), 3, start=2, save_to=path)
    assert as_dict(resumed) == pytest.approx(model(NODES, EDGES, [1, 4], 3))
    with pytest.raises(ValueError):
        op.personalized_pagerank(graph, table(graph.nodes, [1]), 3, start=1)


def test_top_k_is_cut_before_the_shuffle(tables):
    graph = op.prepare(*tables())
    ranks = op.personalized_pagerank(graph, table(graph.nodes, [1, 4]), 1)
    plan = op.top_k(ranks, 3, graph.nodes)._jdf.queryExecution().explainString(
        ranks.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple")
    )
    assert "WindowGroupLimit" in plan


def test_top_k_goes_on_with_the_lowest_nodes_without_mass(tables):
    nodes, _ = tables([5, 1, 9, 7, 3, 2, 8])
    rows = op.top_k(op.ppr_init(nodes, table(nodes, [3, 9])), 4, nodes).collect()
    got = {}
    for r in sorted(rows, key=lambda r: (r.source, r["rank"])):
        got.setdefault(r.source, []).append((r.node, r.mass))
    assert got == {3: [(3, 1.0), (1, 0.0), (2, 0.0), (5, 0.0)], 9: [(9, 1.0), (1, 0.0), (2, 0.0), (3, 0.0)]}


@pytest.mark.parametrize("per_slot", [1, 7, 1000])
def test_links_stay_in_their_buckets(tables, per_slot):
    nodes, edges = hub_graph()
    graph = op.prepare(*tables(nodes, edges), per_slot=per_slot)
    ranks = op.personalized_pagerank(graph, table(graph.nodes, [0, 7, 59]), 3)
    assert as_dict(ranks) == pytest.approx(model(nodes, edges, [0, 7, 59], 3))
    spark = graph.nodes.sparkSession
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        paths = above(op.personalized_pagerank(graph, table(graph.nodes, [0]), 3), "links_")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert len(paths) == 3
    for path in paths:
        assert "SortMergeJoin" in path[-1] and not any("Exchange" in x for x in path)
    hubs = {r.node for r in graph.hubs.collect()}
    assert hubs == {n for n in nodes if len({b for a, b in edges if a == n}) > per_slot}
    if per_slot == 7:  # the hub's 59 links lie in several slots
        assert graph.links.filter("src = 0").select("slot").distinct().count() > 4


def test_a_hub_as_source_and_lost_mass(tables):
    nodes, edges = list(range(40)), [(0, i) for i in range(1, 60)] + [(1, 0)]
    graph = op.prepare(*tables(nodes, edges), per_slot=5)
    ranks = op.personalized_pagerank(graph, table(graph.nodes, [0, 1]), 4)
    assert as_dict(ranks) == pytest.approx(model(nodes, edges, [0, 1], 4))


def test_repeated_nodes_raise_in_the_job_that_reads_them(tables):
    with pytest.raises(Exception, match="node is listed more than once: 2"):
        op.prepare(*tables([1, 2, 2, 3]), strict=True)
    assert op.prepare(*tables(), strict=True).nodes.count() == 4


PAGES = [
    ("http://a.org/x/one?ref=1", '<a href="/x/two">2</a> <A class=c HREF=\'three#top\'>3</A> <a href="#in">i</a>'),
    ("http://a.org/x/two", '<a href="http://b.org/">b</a><a href="//b.org/?p=1">b</a><a href="mailto:x@y.z">m</a>'),
    ("https://b.org", '<a href="four">4</a> <link href="/style.css"> <a href="/x/two&amp;k">k</a><a name="n">n</a>'),
    ("http://a.org/x/three", None),
    (None, '<a href="/nowhere">n</a>'),
]


def test_page_links(spark):
    pages = spark.createDataFrame(PAGES, "url string, html string")
    edges = src.page_edges(pages)
    assert sorted(map(tuple, edges.collect())) == [
        ("http://a.org/x/one", "http://a.org/x/three"),
        ("http://a.org/x/one", "http://a.org/x/two"),
        ("http://a.org/x/two", "http://b.org/"),
        ("http://a.org/x/two", "http://b.org/"),
        ("https://b.org", "https://b.org/four"),
        ("https://b.org", "https://b.org/x/two&k"),
    ]
    own = {"http://a.org/x/one", "http://a.org/x/two", "https://b.org", "http://a.org/x/three"}
    assert {r.node for r in src.page_nodes(pages, edges).collect()} == own
    assert {r.node for r in src.page_nodes(pages, edges, seen_from=1).collect()} > own
    more = pages.union(spark.createDataFrame([("http://c.org/", '<a href="http://b.org/">b</a>')], pages.schema))
    nodes = src.page_nodes(more, src.page_edges(more), seen_from=2)
    assert {r.node for r in nodes.collect()} == own | {"http://c.org/", "http://b.org/"}
    empty = pages.limit(0)
    assert src.page_edges(empty).count() == src.page_nodes(empty, src.page_edges(empty), 2).count() == 0


def test_links_lie_in_as_many_buckets_as_bound_them(spark, monkeypatch):
    from corpuskit.operators import graph as module

    nodes = spark.range(40).select(F.col("id").alias("node"))
    edges = spark.range(900).select((F.col("id") % 37).alias("src"), (F.col("id") * F.col("id") % 43).alias("dst"))
    edges = edges.union(spark.createDataFrame([(1, None), (None, 2), (5, 6), (5, 6)], "src bigint, dst bigint"))
    columns = ["src", "slot", "dst", F.round("w", 12), "slots"]
    expected = sorted(map(str, op.prepare(nodes, edges).links.select(*columns).collect()))
    asked = []
    monkeypatch.setattr(module, "tasks_for", lambda spark, n: asked.append(n) or 9)
    monkeypatch.setattr(module, "TASK_ROWS", 1)
    links = op.prepare(nodes, edges).links
    assert asked == [904]
    # more files than shuffle partitions: one per bucket
    assert len(links.inputFiles()) > 4
    assert sorted(map(str, links.select(*columns).collect())) == expected


def test_line_items_meet_orders_in_as_many_tasks_as_bound_them(spark, tmp_path, monkeypatch):
    from corpuskit.plans.tables import purchases
    from corpuskit.sources import state

    tables = {
        "customer": ([(i,) for i in range(5)], "c_custkey bigint"),
        "part": ([(i,) for i in range(9)], "p_partkey bigint"),
        "orders": ([*((i, i % 5) for i in range(20)), (3, 4), (None, 1), (7, None)], "o_orderkey bigint, o_custkey bigint"),
        "lineitem": ([*((i % 25, i % 9) for i in range(90)), (None, 2), (4, None)], "l_orderkey bigint, l_partkey bigint"),
    }
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    exchanges = lambda edges: [x for _, x in plan_lines(edges) if "hashpartitioning(l_orderkey" in x and "REPARTITION" in x]
    _, edges = purchases(spark, str(tmp_path))
    expected = sorted(map(str, edges.collect()))
    assert not exchanges(edges) and len(expected) == 2 * (75 + 4 + 4 + 1)
    monkeypatch.setattr(state, "TASK_ROWS", 10)
    _, edges = purchases(spark, str(tmp_path))
    assert len(exchanges(edges)) == 2 and all(", 10), REPARTITION" in x for x in exchanges(edges))
    assert sorted(map(str, edges.collect())) == expected


def test_only_a_large_node_is_in_pieces(spark, monkeypatch):
    from corpuskit.operators import graph as module

    edges = spark.range(600).select(F.when(F.col("id") < 400, 1).otherwise(F.col("id") % 9).alias("src"), (F.col("id") % 70).alias("dst"))
    counts = {(r.src, r.dst): r.n for r in edges.groupBy("src", "dst").agg(F.count("*").alias("n")).collect()}
    monkeypatch.setattr(module, "TASK_ROWS", 4 * 100)
    pairs = module._pairs(edges.union(spark.createDataFrame([(None, 3)], edges.schema)), 5)
    assert {(r.src, r.dst): r._m for r in pairs.collect()} == counts
    pieces = {r.src: r.n for r in pairs.groupBy("src").agg(F.count_distinct("_piece").alias("n")).collect()}
    assert pieces.pop(1) == 4 and set(pieces.values()) == {1}


def test_the_parts_of_a_prepared_graph_are_all_that_stays(tables, spark):
    from corpuskit.sources import state

    begun = len(state._written.get(spark.sparkContext.applicationId, []))
    graph = op.prepare(*tables(), per_slot=2)
    stays = state._written[spark.sparkContext.applicationId][begun:]
    assert sorted(path.rsplit("/", 1)[-1].rsplit("-", 1)[0] for path, _ in stays) == ["hubs", "links", "nodes"]
    assert graph.links.count() and graph.hubs.count() == 0


def test_an_earlier_run_leaves_its_states_only(spark):
    from corpuskit.plans import QUERIES
    from corpuskit.sources import state

    begun = len(state._written.get(spark.sparkContext.applicationId, []))
    ranks = QUERIES["ppr_resumed"](spark, "/root/testdata/sf0.001")
    left = [path.rsplit("/", 1)[-1].rsplit("-", 1)[0] for path, _ in state._written[spark.sparkContext.applicationId][begun:]]
    assert sorted(left) == ["home", "hubs", "links", "nodes"] and ranks.count()
