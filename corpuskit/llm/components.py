"""Connected components of a stored table of links, in logarithmically many rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.state import cut


def _stars(edges: DataFrame) -> DataFrame:
    """One round over (u, v), u > v: larger neighbours, then smaller ones, move to the smallest."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    larger = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
    least = larger.groupBy("u").agg(F.min("v").alias("m"))
    moved = larger.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.withColumnRenamed("m", "v")).distinct()


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): for every node of a link, the smallest node that it reaches.

    Each round is written to the shared folder and compared with the one before
    by its number of links and a sum over them; no link or node comes to the
    driver.
    """
    links = links.filter(F.col(a) != F.col(b))
    edges = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct()
    before = None
    while True:
        edges = cut(edges, "links")
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
        edges = _stars(edges)
    own = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(own)
