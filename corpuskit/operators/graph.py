"""Directed graphs as nodes(node) and edges(src, dst), parallel edges allowed."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.state import TASK_ROWS, bucketed, cut, cut_counted, passing, tasks_for
from .skew import PIECE, default_pieces, piece_of


def graph_stats(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """One row: n_nodes, n_edges (with multiplicity), n_active (nodes with an out-edge)."""
    n_edges = edges.agg(F.count(F.lit(1))).scalar()
    n_active = edges.select("src").distinct().agg(F.count(F.lit(1))).scalar()
    return nodes.agg(F.count(F.lit(1)).alias("n_nodes")).select(
        "n_nodes", n_edges.alias("n_edges"), n_active.alias("n_active")
    )


def repeated_nodes(nodes: DataFrame) -> DataFrame:
    """(node, n): nodes that are listed more than once; a sound graph has none."""
    return nodes.groupBy("node").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def missing_targets(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(node): distinct edge targets that are no node."""
    targets = edges.select(F.col("dst").alias("node")).distinct()
    return targets.join(nodes, "node", "left_anti")


def message_counts(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """One row per step: mass_messages (one per edge) and missing_structure (unknown targets)."""
    unknown = missing_targets(nodes, edges).agg(F.count(F.lit(1))).scalar()
    return edges.agg(F.count(F.lit(1)).alias("mass_messages")).select(
        "mass_messages", unknown.alias("missing_structure")
    )


# Links of one node in a slot; a node with more has several.
PER_SLOT = 1 << 16

# Cells of nodes that edges are counted in first.
CELLS = 1 << 16


@dataclass(frozen=True)
class Graph:
    """A graph ready for mass propagation.

    nodes(node): each node once. links(src, slot, dst, w, slots): w is the share
    of src's mass that goes to dst, parallel edges added up; a row without dst is
    the share that gets lost, all of it for a node without out-edges. The links
    of a hub lie in several slots; `slots` says how many dst itself has, and
    hubs(node, slots) lists the nodes with more than one.
    """

    nodes: DataFrame
    links: DataFrame
    hubs: DataFrame


def prepare(nodes: DataFrame, edges: DataFrame, strict: bool = False, per_slot: int = PER_SLOT) -> Graph:
    """Collapse parallel edges, weigh them and see which targets are nodes.

    Links are written to the session's shared folder in buckets by (src, slot),
    so iterations join them as they lie and only ranks and arrivals move; slots
    of about `per_slot` links keep a hub from filling one bucket. There are as
    many buckets as bound the links in one. An edge is shuffled three times, by
    source, target and slot, each time from a table to the next, and only the
    last table stays. `repeated_nodes`
    lists nodes that come more than once; they count once, or with `strict` raise
    an error in the job that reads them.
    """
    spark = nodes.sparkSession
    if strict:
        counted = nodes.groupBy("node").agg(F.count(F.lit(1)).alias("n"))
        message = F.concat(F.lit("node is listed more than once: "), F.col("node").cast("string"))
        once = counted.select(F.when(F.col("n") > 1, F.raise_error(message)).otherwise(F.col("node")).alias("node"))
        once = once.select(F.col("node").cast(nodes.schema["node"].dataType).alias("node"))
    else:
        once = nodes.select("node").distinct()
    with passing(spark, keep=("nodes", "hubs", "links")):
        nodes, n_nodes = cut_counted(once, "nodes")
        with passing(spark, keep=("nodes", "hubs", "met", "active")):
            with passing(spark, keep=("nodes", "pairs")):
                # stored first, so that a task counts a bounded number of them, where their source is added up too
                stored, n = cut_counted(edges.select("src", "dst"), "edges")
                buckets = tasks_for(spark, n)
                pairs = _pairs(stored, buckets)
            met, active, hubs = _met(pairs, nodes, buckets, per_slot, apart=n_nodes > TASK_ROWS)
        links = bucketed(_links(met, active, nodes, hubs), "links", ["src", "slot"], buckets)
    return Graph(nodes, links, hubs)


def _pairs(edges: DataFrame, buckets: int) -> DataFrame:
    """(src, piece, dst, _m), a stored table in buckets by (src, piece): how often each edge is there.

    Only nodes that might fill a task are in pieces, any others would have a
    part in nearly as many as they have links. Such nodes are looked for in the
    cells that have many edges.
    """
    known = edges.filter(F.col("src").isNotNull())
    most, cell = TASK_ROWS // 4, F.xxhash64("src").bitwiseAND(F.lit(CELLS - 1)).alias("_cell")
    cells = cut(known.groupBy(cell).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > most).select("_cell"), "cells")
    large = known.select("src", cell).join(cells, "_cell", "left_semi").groupBy("src").agg(F.count(F.lit(1)).alias("_n"))
    large = cut(large.filter(F.col("_n") > most).select("src", F.lit(True).alias("_large")), "large")
    piece = F.when(F.col("_large"), piece_of(["dst"], default_pieces(edges))).otherwise(F.lit(0)).cast("int")
    spread = ["src", PIECE]
    dealt = known.join(large, "src", "left").select("src", piece.alias(PIECE), "dst").repartition(buckets, *spread)
    return bucketed(dealt.groupBy(*spread, "dst").agg(F.count(F.lit(1)).alias("_m")), "pairs", spread, buckets)


def _met(pairs: DataFrame, nodes: DataFrame, buckets: int, per_slot: int, apart: bool) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(src, dst, w, slot), a stored table with dst and slot 0 where the target is no node; (src) with edges; (node, slots) of hubs."""
    spread = ["src", PIECE]
    parts = pairs.groupBy(*spread).agg(F.sum("_m").alias("_deg"), F.count(F.lit(1)).alias("_n")).repartition(buckets, "src")
    of_source = Window.partitionBy("src")
    totals = cut(parts.select(*spread, *(F.sum(c).over(of_source).alias(c) for c in ("_deg", "_n"))), "totals")
    own_slots = F.ceil(F.col("_n") / per_slot).cast("int")
    hubs = totals.filter(own_slots > 1).select(F.col("src").alias("node"), own_slots.alias("slots")).distinct()
    hubs, active = cut(hubs, "hubs"), cut(totals.select("src").distinct(), "active")
    slot = F.pmod(F.xxhash64("dst"), own_slots).cast("int").alias("slot")
    weighed = pairs.join(totals, spread).select("src", "dst", (F.col("_m") / F.col("_deg")).alias("w"), slot)
    # too many nodes to be broadcast: the links meet them in tasks that are bounded too
    weighed = weighed.repartition(buckets, "dst") if apart else weighed
    there = nodes.select(F.col("node").alias("dst"), F.lit(True).alias("_there"))
    found = weighed.join(there, "dst", "left").select(
        "src", F.when(F.col("_there"), F.col("dst")).alias("dst"), "w", F.when(F.col("_there"), F.col("slot")).otherwise(F.lit(0)).alias("slot")
    )
    return cut(found, "met"), active, hubs


def _links(met: DataFrame, active: DataFrame, nodes: DataFrame, hubs: DataFrame) -> DataFrame:
    """(src, slot, dst, w, slots), see `Graph`."""
    known = met.filter(F.col("dst").isNotNull()).join(hubs.withColumnRenamed("node", "dst"), "dst", "left")
    known = known.select("src", "slot", "dst", "w", F.coalesce("slots", F.lit(1)).alias("slots"))
    nowhere = [F.lit(0).alias("slot"), F.lit(None).cast(met.schema["dst"].dataType).alias("dst")]
    no_slots = F.lit(None).cast("int").alias("slots")
    lost = met.filter(F.col("dst").isNull()).groupBy("src").agg(F.sum("w").alias("w")).select("src", *nowhere, "w", no_slots)
    dangling = nodes.withColumnRenamed("node", "src").join(active, "src", "left_anti")
    dangling = dangling.select("src", *nowhere, F.lit(1.0).alias("w"), no_slots)
    return known.unionByName(lost).unionByName(dangling)
