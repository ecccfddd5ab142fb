"""Personalized PageRank from many sources at once.

Ranks are sparse rows (node, source, mass): pairs without mass are not stored.
Mass is a plain double, so a zero needs no special value. Sources are a table
(source), of any size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.state import cut
from .graph import Graph

# Fixed value: chance to jump back to the source.
ALPHA = 0.15


def unknown_sources(nodes: DataFrame, sources: DataFrame) -> DataFrame:
    """(source): the sources that are no nodes; they have no ranks."""
    known = nodes.select(F.col("node").alias("source"))
    return sources.select("source").distinct().join(known, "source", "left_anti")


def ppr_init(nodes: DataFrame, sources: DataFrame) -> DataFrame:
    """(node, source, mass): all mass of a source on the source itself, repeated sources once."""
    known = nodes.select(F.col("node").alias("source"))
    found = sources.select("source").distinct().join(known, "source", "left_semi")
    return found.select(F.col("source").alias("node"), "source", F.lit(1.0).alias("mass"))


def _with_slots(ranks: DataFrame, graph: Graph) -> DataFrame:
    """(node, source, mass, slots): in how many slots the links of the node are."""
    joined = ranks.select("node", "source", "mass").join(graph.hubs, "node", "left")
    return joined.select("node", "source", "mass", F.coalesce("slots", F.lit(1)).alias("slots"))


def _sent(ranks: DataFrame, graph: Graph) -> DataFrame:
    """(dst, source, m, slots): mass along every link; dst is NULL for lost mass.

    The links stay in their buckets; a hub's mass goes to each of its slots.
    """
    slot = F.explode(F.sequence(F.lit(0), F.col("slots") - 1)).alias("slot")
    leaving = ranks.select(F.col("node").alias("src"), "source", "mass", slot)
    met = leaving.join(graph.links, ["src", "slot"])
    return met.select("dst", "source", (F.col("mass") * F.col("w")).alias("m"), "slots")


def ppr_step(ranks: DataFrame, graph: Graph) -> DataFrame:
    """(node, source, mass) after mass/outdegree went along every out-edge, before any jump."""
    arrived = _sent(_with_slots(ranks, graph), graph).filter(F.col("dst").isNotNull())
    return arrived.groupBy(F.col("dst").alias("node"), "source").agg(F.sum("m").alias("mass"))


def missing_mass(stepped: DataFrame, sources: DataFrame) -> DataFrame:
    """(source, missing): 1 - the mass still there after a step, never below 0."""
    every = sources.select("source").distinct().withColumn("mass", F.lit(0.0))
    present = stepped.select("source", "mass").unionByName(every)
    return present.groupBy("source").agg(
        F.greatest(F.lit(0.0), F.lit(1.0) - F.sum("mass")).alias("missing")
    )


def _iterate(ranks: DataFrame, home: DataFrame, graph: Graph, alpha: float) -> DataFrame:
    """One full iteration: a join with the links and one aggregation, from and to (node, source, mass, slots).

    Lost mass belongs to the source, so a link without target sends to the
    source and no separate pass over the total is needed. `home` adds the jump
    and the source's number of slots; other nodes' came with the links to them.
    """
    sent = _sent(ranks, graph).select(
        F.coalesce("dst", "source").alias("node"), "source", "m", "slots", F.lit(0).alias("jump")
    )
    jumps = home.select("node", "source", F.lit(0.0).alias("m"), "slots", F.lit(1).alias("jump"))
    mass = (1.0 - alpha) * F.sum("m") + alpha * F.max("jump")
    return (
        sent.unionByName(jumps)
        .groupBy("node", "source")
        .agg(mass.alias("mass"), F.max("slots").alias("slots"))
        .filter(F.col("mass") > 0)
    )


def personalized_pagerank(
    graph: Graph,
    sources: DataFrame,
    iterations: int,
    alpha: float = ALPHA,
    start: int = 0,
    save_to: str | None = None,
    cut_every: int = 4,
) -> DataFrame:
    """(node, source, mass) after iterations start .. iterations-1.

    With `save_to`, every state goes to <save_to>/iterNNNN (iter0000 the initial
    one) and a later call with `start` goes on from such a state. Otherwise the
    ranks are written to the session's shared folder every `cut_every`
    iterations. Sources that are no nodes have no ranks, see `unknown_sources`.
    """
    spark = graph.nodes.sparkSession

    def path(i: int) -> str:
        return f"{save_to}/iter{i:04d}"

    if iterations < start:
        raise ValueError("iterations must not be below start")
    if start and not save_to:
        raise ValueError("start needs save_to, where the earlier states are")
    home = cut(_with_slots(ppr_init(graph.nodes, sources), graph), "home")
    if start:
        ranks = _with_slots(spark.read.parquet(path(start)), graph)
    else:
        ranks = cut(home, "ranks", path(0)) if save_to else home
    for i in range(start + 1, iterations + 1):
        ranks = _iterate(ranks, home, graph, alpha)
        if save_to:
            ranks = cut(ranks, "ranks", path(i))
        elif (i - start) % cut_every == 0 and i < iterations:
            ranks = cut(ranks, "ranks")
    return ranks.select("node", "source", "mass")


def top_k(ranks: DataFrame, k: int, nodes: DataFrame) -> DataFrame:
    """(source, rank, node, mass, shown): the k highest masses per source, ties by node.

    Each task keeps k rows per source before the shuffle, so a source with mass
    on every node does not bring them all together. A source with mass on fewer
    than k nodes goes on with the lowest other nodes: of the 2k lowest ones, it
    has mass on less than k.
    """
    lowest = nodes.select("node").distinct().orderBy("node").limit(2 * k)
    lowest = lowest.agg(F.array_sort(F.collect_list("node"))).scalar()
    short = ranks.groupBy("source").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") < k)
    empty = short.select("source", F.explode(lowest).alias("node"))
    empty = empty.join(ranks, ["source", "node"], "left_anti").withColumn("mass", F.lit(0.0))
    best_first = Window.partitionBy("source").orderBy(F.desc("mass"), "node")
    every = ranks.select("source", "node", "mass").unionByName(empty.select("source", "node", "mass"))
    ranked = every.withColumn("rank", F.row_number().over(best_first)).filter(F.col("rank") <= k)
    shown = F.format_string("%.5f %s", F.col("mass"), F.col("node").cast("string"))
    return ranked.select("source", "rank", "node", "mass", shown.alias("shown"))
