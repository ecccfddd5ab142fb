"""Boolean queries that read only the segments of an index that can have matches."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.segments import read_segments, read_skips
from ..sources.state import cut
from .retrieval import boolean_query, needed_terms, query_condition


def alive_segments(skips: DataFrame, rpn: str) -> DataFrame:
    """(term, part, segment, lowest, highest, n): the segments whose span meets what the query needs there.

    The documents' numbers are cut into equal cells, about as many as the query's
    terms have segments. As the segments of a term lie one after another, they
    fall into few more cells than there are segments and cells together. A cell
    is alive if the query holds for the terms that have a segment in it, and a
    segment if one of its cells is. Only spans are looked at, no postings.
    """
    tree, terms = needed_terms(rpn)
    own = cut(skips.filter(F.col("term").isin(terms)), "spans")
    facts = own.agg(
        F.count(F.lit(1)).alias("n"), F.min("lowest").alias("lowest"), F.max("highest").alias("highest")
    ).first()
    if not facts["n"]:
        return own
    first, width = facts["lowest"], max(1, -(-(facts["highest"] - facts["lowest"] + 1) // facts["n"]))
    cell = lambda c: F.floor((F.col(c) - first) / width)
    spread = own.select("*", F.explode(F.sequence(cell("lowest"), cell("highest"))).alias("cell"))
    flags = {t: f"_has{i}" for i, t in enumerate(terms)}
    # what of the cell each term's segments span; where all that is needed never overlaps, nothing can match
    start, stop = F.col("cell") * width + first, (F.col("cell") + 1) * width + first - 1
    clipped = spread.select(
        "*", F.greatest("lowest", start).alias("_from"), F.least("highest", stop).alias("_to")
    )
    present = [F.max(F.col("term") == t).alias(flag) for t, flag in flags.items()]
    cells = clipped.groupBy("cell").agg(*present).filter(query_condition(tree, flags)).select("cell")
    if isinstance(tree, tuple) and _only_ands(tree):
        hull = clipped.groupBy("cell", "term").agg(F.min("_from").alias("_from"), F.max("_to").alias("_to"))
        shared = hull.groupBy("cell").agg(F.max("_from").alias("_from"), F.min("_to").alias("_to"))
        cells = cells.join(shared.filter("_from <= _to"), "cell")
        met = clipped.join(cells.withColumnsRenamed({"_from": "_a", "_to": "_b"}), "cell")
        met = met.filter((F.col("_from") <= F.col("_b")) & (F.col("_to") >= F.col("_a")))
    else:
        met = clipped.join(cells, "cell", "left_semi")
    return met.select(*own.columns).distinct()


def _only_ands(tree) -> bool:
    return isinstance(tree, str) or (tree[0] == "AND" and all(map(_only_ands, tree[1:])))


def skipping_query(spark: SparkSession, path: str, rpn: str) -> DataFrame:
    """(docno) matching a postfix query on an index written by `write_segments`.

    The same as `boolean_query`, but only segments that can have a match are read.
    """
    alive = cut(alive_segments(read_skips(spark, path), rpn), "alive")
    return boolean_query(read_segments(spark, path, alive), rpn)
