"""A keyed table that takes later cells: a bucketed table per version, merged without moving what is stored."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .state import bucketed

KEY = ("term", "docno")


def _summed(cells: DataFrame, buckets: int | None = None) -> DataFrame:
    """One row per cell, summed in their buckets if their number is given; cells without term or docno are left out."""
    known = cells.filter("term IS NOT NULL AND docno IS NOT NULL")
    if buckets:
        known = known.repartition(buckets, *KEY)
    return known.groupBy(*KEY).agg(F.sum("tf").cast("int").alias("tf"))


def create_cells(cells: DataFrame, name: str, buckets: int | None = None) -> DataFrame:
    """A table (term, docno, tf) in buckets by (term, docno), each sorted by it; repeated cells are summed.

    Buckets by the whole key are even, however many cells a term has, and the
    statistics of sorted files find a term's cells in each. A task sums and sorts
    a bucket, so `tasks_for` the cells is a good number of them.
    """
    return bucketed(_summed(cells, buckets), name, KEY, buckets)


def merged_cells(table: DataFrame, more: DataFrame) -> DataFrame:
    """All cells of the table with `more` added: new ones beside, values of known ones summed.

    The table's buckets are read as they lie; only `more` is shuffled.
    """
    delta = _summed(more).withColumnRenamed("tf", "_more")
    both = table.join(delta, list(KEY), "full_outer")
    total = F.coalesce("tf", F.lit(0)) + F.coalesce("_more", F.lit(0))
    return both.select(*KEY, total.cast("int").alias("tf"))


def upsert_cells(table: DataFrame, more: DataFrame, name: str, buckets: int | None = None) -> DataFrame:
    """The next version of the table, with `more` added, as a table of its own.

    `buckets` is the table's number of buckets, as given to `create_cells`. The
    version before stays as it is, so whoever reads it is not disturbed and a run
    that is interrupted leaves it whole; drop it when nobody needs it.
    """
    return bucketed(merged_cells(table, more), name, KEY, buckets)
