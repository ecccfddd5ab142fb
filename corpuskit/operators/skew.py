"""Per-key totals that stay balanced when one key holds much of the data.

A key is cut into pieces by a hash of other columns of the row. Totals are taken
per piece and then over the pieces of a key, of which there are never more than
`pieces`, and are joined back on (key, piece). No task sees all rows of a key,
nothing is broadcast by force and no row is dropped.

Plain joins need none of this where both sides are shuffled for the join: there
AQE splits a skewed partition by itself. It cannot where a side is the result of
an aggregation on the same key, which is the case these totals are for.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PIECE = "_piece"


def default_pieces(df: DataFrame) -> int:
    """Power of two at or above the shuffle parallelism, so a hot key fills the cluster."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return 1 << max(n - 1, 1).bit_length()


def piece_of(columns: Sequence[str | Column], pieces: int) -> Column:
    """Piece number of a row, 0 .. pieces-1; `pieces` is a power of two."""
    return F.xxhash64(*columns).bitwiseAND(F.lit(pieces - 1))


def with_key_totals(
    df: DataFrame,
    keys: Sequence[str],
    spread_by: Sequence[str],
    totals: dict[str, Column],
    having: Column | None = None,
    pieces: int | None = None,
) -> DataFrame:
    """Attach to each row sums over all rows of its key.

    `totals` maps an output column to an aggregate that can be summed over parts
    (a count or a sum). `having` filters on the totals, which drops the rows of
    the other keys. Totals are partly added up before their shuffle; the rows
    themselves move only if the totals are too many to broadcast.
    """
    keys = list(keys)
    n = pieces or default_pieces(df)
    cut = df.withColumn(PIECE, piece_of(spread_by, n))
    parts = cut.groupBy(*keys, PIECE).agg(*[agg.alias(c) for c, agg in totals.items()])
    over_key = Window.partitionBy(*keys)
    whole = parts.select(
        *keys, PIECE, *[F.sum(c).over(over_key).alias(c) for c in totals]
    )
    if having is not None:
        whole = whole.filter(having)
    return cut.join(whole, [*keys, PIECE]).drop(PIECE)
