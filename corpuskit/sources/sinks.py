"""Writers. All of them replace what is at the target."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_text(
    df: DataFrame,
    path: str,
    n: int | None = None,
    keys: Sequence[str] | None = None,
    sep: str = "\t",
) -> None:
    """One line per row, columns joined by `sep`.

    `n` asks for that many output files, rows placed by `keys` (all columns by
    default); without it the plan's own partitioning is written.
    """
    if n is not None:
        df = df.repartition(n, *(keys or df.columns))
    fields = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in df.columns]
    df.select(F.concat_ws(sep, *fields).alias("value")).write.mode("overwrite").text(path)


def write_index(postings: DataFrame, path: str, n: int) -> None:
    """Postings as n Parquet files in (term, docno) order.

    Ranges over both columns keep a term's postings next to each other, and a
    term too frequent for one file continues in the next. The files' min/max
    statistics let a term filter skip the other files.
    """
    (
        postings.select("term", "docno", "tf")
        .repartitionByRange(n, "term", "docno")
        .sortWithinPartitions("term", "docno")
        .write.mode("overwrite")
        .parquet(path)
    )


def write_keyed_table(table: DataFrame, path: str, key: str = "term") -> None:
    """A keyed table, dropped and created again, its rows in key order in each file."""
    table.sortWithinPartitions(key).write.mode("overwrite").parquet(path)
