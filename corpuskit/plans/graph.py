"""Graph statistics and personalized PageRank on the graph of purchases."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import operators as op
from .tables import SQL_GRAPH, SQL_PAGES, graph_sources, load, page_graph, page_sources, purchases

ITERATIONS = 3


def single(ranks, column="mass"):
    """Mass in single precision, so that the order of additions does not show.

    Decimal places would not do: 0.85 shared out by halves often ends in a 5.
    """
    return ranks.withColumn(column, F.col(column).cast("float").cast("double"))


def _sql_single(column: str) -> str:
    return f"CAST(CAST({column} AS FLOAT) AS DOUBLE)"


def ranks_after(spark, sf, iterations=ITERATIONS, **more):
    graph = op.prepare(*purchases(spark, sf))
    return op.personalized_pagerank(graph, graph_sources(spark, sf), iterations, **more)


def _stepped(spark, sf):
    """The mass step taken once from the state after one iteration."""
    graph = op.prepare(*purchases(spark, sf))
    return op.ppr_step(op.personalized_pagerank(graph, graph_sources(spark, sf), 1), graph)


def _missing(spark, sf):
    missing = op.missing_mass(_stepped(spark, sf), graph_sources(spark, sf))
    return missing.withColumn("missing", F.round("missing", 9))


def _top(spark, sf):
    nodes, _ = purchases(spark, sf)
    return op.top_k(single(ranks_after(spark, sf)), 10, nodes).select("source", "rank", "node", "mass")


def _top_of_start(spark, sf):
    """The best three after no iteration: the source, and the lowest nodes without mass."""
    nodes, _ = purchases(spark, sf)
    start = op.ppr_init(nodes, graph_sources(spark, sf))
    return op.top_k(start, 3, nodes).select("source", "rank", "node", "mass")


def _unknown(spark, sf):
    """Sources and their successors that are no nodes."""
    nodes, _ = purchases(spark, sf)
    customers = nodes.filter("node % 2 = 0")
    wanted = graph_sources(spark, sf).select(F.explode(F.array("source", F.col("source") + 1)).alias("source"))
    return op.unknown_sources(customers, wanted)


def _repeated(spark, sf):
    """Customers listed once for each of their orders."""
    listed = load(spark, sf, "orders").select((F.col("o_custkey") * 2).alias("node"))
    return op.repeated_nodes(listed)


def _page_ranks(spark, sf, iterations=ITERATIONS):
    graph = op.prepare(*page_graph(spark, sf))
    return op.personalized_pagerank(graph, page_sources(spark, sf), iterations)


def _page_missing(spark, sf):
    """What the pages' mass loses in a step from the state after one iteration."""
    graph = op.prepare(*page_graph(spark, sf))
    sources = page_sources(spark, sf)
    stepped = op.ppr_step(op.personalized_pagerank(graph, sources, 1), graph)
    return op.missing_mass(stepped, sources).withColumn("missing", F.round("missing", 9))


def _page_top(spark, sf):
    nodes, _ = page_graph(spark, sf)
    top = op.top_k(single(_page_ranks(spark, sf)), 5, nodes)
    return top.select("source", "rank", "node", "mass", "shown")


QUERIES = {
    "page_edges": lambda spark, sf: page_graph(spark, sf)[1].groupBy("src", "dst").agg(F.count("*").alias("n")),
    "page_graph_stats": lambda spark, sf: op.graph_stats(*page_graph(spark, sf)),
    "page_missing_targets": lambda spark, sf: op.missing_targets(*page_graph(spark, sf)),
    "page_message_counts": lambda spark, sf: op.message_counts(*page_graph(spark, sf)),
    "page_ppr": lambda spark, sf: single(_page_ranks(spark, sf)),
    "page_ppr_missing": _page_missing,
    "page_ppr_top_k": _page_top,
    "graph_stats": lambda spark, sf: op.graph_stats(*purchases(spark, sf)),
    "missing_targets": lambda spark, sf: op.missing_targets(*purchases(spark, sf)),
    "message_counts": lambda spark, sf: op.message_counts(*purchases(spark, sf)),
    "repeated_nodes": _repeated,
    "unknown_sources": _unknown,
    "ppr_init": lambda spark, sf: op.ppr_init(purchases(spark, sf)[0], graph_sources(spark, sf)),
    "ppr_step": lambda spark, sf: single(_stepped(spark, sf)),
    "ppr_missing": _missing,
    "ppr_3_iterations": lambda spark, sf: single(ranks_after(spark, sf)),
    "ppr_top_k": _top,
    "ppr_top_k_start": _top_of_start,
}


def sql_ranks(iterations: int, graph: str = SQL_GRAPH) -> str:
    """All iterations, written out one after the other."""
    parts = [
        graph,
        "deg AS (SELECT src, CAST(count(*) AS DOUBLE) AS d FROM edges GROUP BY src)",
        "r0 AS (SELECT source AS node, source, CAST(1 AS DOUBLE) AS mass FROM sources)",
    ]
    for i in range(1, iterations + 1):
        parts.append(f"{_sql_step(f'm{i}', f'r{i - 1}')}")
        parts.append(f"{_sql_missing(f'x{i}', f'm{i}')}")
        parts.append(f"""r{i} AS (
  SELECT node, source, sum(part) AS mass FROM (
    SELECT node, source, CAST(0.85 AS DOUBLE) * mass AS part FROM m{i}
    UNION ALL
    SELECT source, source, CAST(0.15 AS DOUBLE) + CAST(0.85 AS DOUBLE) * missing FROM x{i})
  GROUP BY node, source)""")
    return ",\n".join(parts)


def _sql_step(name: str, ranks: str) -> str:
    return f"""{name} AS (
  SELECT e.dst AS node, r.source, sum(r.mass / deg.d) AS mass
  FROM {ranks} r JOIN edges e ON e.src = r.node JOIN deg ON deg.src = e.src
  WHERE e.dst IN (SELECT node FROM nodes) GROUP BY e.dst, r.source)"""


def _sql_missing(name: str, stepped: str) -> str:
    return f"""{name} AS (
  SELECT s.source, greatest(CAST(0 AS DOUBLE), 1 - coalesce(sum(m.mass), 0)) AS missing
  FROM sources s LEFT JOIN {stepped} m ON m.source = s.source GROUP BY s.source)"""


_STEP = f"{sql_ranks(1)},\n{_sql_step('stepped', 'r1')}"
_RANKS = f"""WITH {sql_ranks(ITERATIONS)},
ranks AS (SELECT node, source, {_sql_single('mass')} AS mass FROM r{ITERATIONS})"""


def _sql_top(ranks: str, k: int) -> str:
    """Every node for every source."""
    return f"""every AS (
  SELECT s.source, n.node, coalesce(r.mass, 0) AS mass
  FROM sources s CROSS JOIN nodes n LEFT JOIN {ranks} r ON r.source = s.source AND r.node = n.node)
SELECT source, rank, node, mass FROM (
  SELECT source, node, mass,
         CAST(row_number() OVER (PARTITION BY source ORDER BY mass DESC, node) AS INTEGER) AS rank
  FROM every) WHERE rank <= {k}"""


def _sql_stats(graph: str) -> str:
    return f"""WITH {graph}
SELECT (SELECT count(*) FROM nodes) AS n_nodes, (SELECT count(*) FROM edges) AS n_edges,
  (SELECT count(DISTINCT src) FROM edges) AS n_active"""


def _sql_targets(graph: str) -> str:
    return f"""WITH {graph}
SELECT DISTINCT dst AS node FROM edges WHERE dst NOT IN (SELECT node FROM nodes)"""


def _sql_messages(graph: str) -> str:
    return f"""WITH {graph}
SELECT count(*) AS mass_messages,
  count(DISTINCT dst) FILTER (dst NOT IN (SELECT node FROM nodes)) AS missing_structure FROM edges"""


_PAGE_STEP = f"{sql_ranks(1, SQL_PAGES)},\n{_sql_step('stepped', 'r1')}"
_PAGE_RANKS = f"""WITH {sql_ranks(ITERATIONS, SQL_PAGES)},
ranks AS (SELECT node, source, {_sql_single('mass')} AS mass FROM r{ITERATIONS} WHERE mass > 0)"""
_SHOWN = "printf('%.5f', mass) || ' ' || node"

ORACLES = {
    "page_edges": f"WITH {SQL_PAGES} SELECT src, dst, count(*) AS n FROM edges GROUP BY src, dst",
    "page_graph_stats": _sql_stats(SQL_PAGES),
    "page_missing_targets": _sql_targets(SQL_PAGES),
    "page_message_counts": _sql_messages(SQL_PAGES),
    "page_ppr": f"{_PAGE_RANKS} SELECT node, source, mass FROM ranks",
    "page_ppr_missing": f"""WITH {_PAGE_STEP},
{_sql_missing('missed', 'stepped')}
SELECT source, round(missing, 9) AS missing FROM missed""",
    "page_ppr_top_k": f"""{_PAGE_RANKS},
{_sql_top('ranks', 5).replace('SELECT source, rank, node, mass FROM', f'SELECT source, rank, node, mass, {_SHOWN} AS shown FROM')}""",
    "graph_stats": _sql_stats(SQL_GRAPH),
    "missing_targets": _sql_targets(SQL_GRAPH),
    "message_counts": _sql_messages(SQL_GRAPH),
    "ppr_init": f"""WITH {SQL_GRAPH}
SELECT source AS node, source, CAST(1 AS DOUBLE) AS mass FROM sources""",
    "ppr_step": f"WITH {_STEP} SELECT node, source, {_sql_single('mass')} AS mass FROM stepped",
    "ppr_missing": f"""WITH {_STEP},
{_sql_missing('missed', 'stepped')}
SELECT source, round(missing, 9) AS missing FROM missed""",
    "ppr_3_iterations": f"{_RANKS} SELECT node, source, mass FROM ranks",
    "ppr_top_k": f"{_RANKS},\n{_sql_top('ranks', 10)}",
    "ppr_top_k_start": f"""WITH {SQL_GRAPH},
ranks AS (SELECT source AS node, source, CAST(1 AS DOUBLE) AS mass FROM sources),
{_sql_top('ranks', 3)}""",
    "repeated_nodes": "SELECT 2 * o_custkey AS node, count(*) AS n FROM orders GROUP BY o_custkey HAVING count(*) > 1",
    "unknown_sources": f"WITH {SQL_GRAPH} SELECT source + 1 AS source FROM sources",
}
