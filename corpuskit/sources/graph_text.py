"""Adjacency text: ``node target target ...`` per line."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_adjacency(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """nodes(node) and edges(src, dst). A line with one id is a node without out-edges."""
    ids = F.split(F.regexp_replace("value", r"^\s+|\s+$", ""), r"\s+")
    rows = (
        spark.read.text(path)
        .filter(F.col("value").rlike(r"\S"))
        .select(F.transform(ids, lambda s: s.cast("bigint")).alias("ids"))
    )
    nodes = rows.select(F.col("ids")[0].alias("node"))
    targets = F.slice("ids", F.lit(2), F.size("ids"))
    edges = rows.select(F.col("ids")[0].alias("src"), F.explode(targets).alias("dst"))
    return nodes, edges
