"""Rows of a stored table known by their places, so that decisions go to the rows and not rows to the decisions.

A row's place is its file and its number there. What is decided about rows from
their keys or digests comes back as a table of 64 rows to a word, and each task
looks its own rows up while it reads them: no column of the table is ever
exchanged. At most `bound` words are broadcast at once. Where there are more,
the table is gone through in slices, each of which reads only its own files, so
what is broadcast doesn't grow with the table and the answer stays exact.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.state import cut, fresh_path
from .bloom import unused

# Words broadcast at once: some 32 MB as rows, for up to 67 million rows of the table.
WORDS = 1 << 20


def stored(df: DataFrame, name: str = "rows") -> DataFrame:
    """`df` itself if it is a Parquet table just as read, else a stored copy of it."""
    plan = df._jdf.queryExecution().analyzed().getClass().getSimpleName()
    if plan == "LogicalRelation":
        try:
            df.select(df.metadataColumn("_metadata")["row_index"])
            return df
        except AnalysisException:  # another format
            pass
    return cut(df, name)


def place(df: DataFrame) -> Column:
    """(file, at) of each row of a stored table; files are taken as equal if the 64-bit hashes of their paths are."""
    own = df.metadataColumn("_metadata")
    return F.struct(F.xxhash64(own["file_path"]).alias("file"), own["row_index"].alias("at"))


def _words(flagged: DataFrame, flags: Sequence[str]) -> DataFrame:
    bit = F.expr("shiftleft(1L, CAST(at & 63 AS INT))")
    each = [F.bit_or(F.when(F.col(f), bit).otherwise(F.lit(0).cast("bigint"))).alias(f) for f in flags]
    return flagged.groupBy("file", F.shiftrightunsigned("at", 6).alias("word")).agg(*each)


def _slicing(words: DataFrame, bound: int) -> tuple[int, Callable[[Column, Column], Column]]:
    """How many slices, and a row's slice by its file and word: whole files, or parts of them if one has too many words."""
    number = words.count()
    if number <= bound:
        return 1, lambda file, word: F.lit(0)
    chunk = max(1, bound // 4)
    largest = words.groupBy("file").count().agg(F.max("count")).first()[0]
    whole = largest <= max(1, bound // 2)
    key = (lambda file, word: file) if whole else (lambda file, word: F.xxhash64(file, F.floor(word / chunk)))
    slices = 2
    while True:
        slice_of = lambda file, word, n=slices: F.pmod(key(file, word), F.lit(n)).cast("int")
        sizes = words.groupBy(slice_of(F.col("file"), F.col("word")).alias("s")).count()
        if sizes.agg(F.max("count")).first()[0] <= bound:
            return slices, slice_of
        slices *= 2


def with_flags(
    df: DataFrame,
    flagged: DataFrame,
    flags: Sequence[str],
    then: Callable[[DataFrame, list[Column]], DataFrame],
    bound: int = WORDS,
) -> DataFrame:
    """`then(rows, flags)` of the stored table `df`, each flag true for the rows that `flagged` says.

    `flagged` is (file, at, *flags) with boolean flags; rows that are not there
    have none. `then` works on each row by itself: with several slices it is
    called for each, one after another, and the results are stored together.
    """
    words = cut(_words(flagged, flags), "places")
    slices, slice_of = _slicing(words, bound)
    file, at, word = (unused(df, f"_{name}") for name in ("file", "at", "word"))
    names = [unused(df, f"_flag{i}") for i in range(len(flags))]
    own = place(df)
    number = F.shiftrightunsigned(own["at"], 6)

    def part(s: int) -> DataFrame:
        rows, some = df, words
        if slices > 1:
            rows = df.filter(slice_of(own["file"], number) == s)
            some = words.filter(slice_of(F.col("file"), F.col("word")) == s)
        rows = rows.select(*df.columns, own["file"].alias(file), own["at"].alias(at))
        small = some.select(
            F.col("file").alias(f"{file}_"), F.col("word").alias(word), *[F.col(f).alias(n) for f, n in zip(flags, names, strict=True)]
        )
        meet = (F.col(file) == F.col(f"{file}_")) & (F.shiftrightunsigned(at, 6) == F.col(word))
        bit = F.col(at).bitwiseAND(F.lit(63)).cast("int")
        set_ = [F.coalesce(F.getbit(F.col(n), bit) == 1, F.lit(False)) for n in names]
        return then(rows.join(F.broadcast(small), meet, "left"), set_)

    if slices == 1:
        return part(0)
    path = fresh_path(df.sparkSession, "by-place")
    for s in range(slices):
        part(s).write.mode("append").parquet(path)
    return df.sparkSession.read.schema(part(0).schema).parquet(path)


def without(df: DataFrame, gone: DataFrame, bound: int = WORDS) -> DataFrame:
    """Rows of the stored table `df` whose place is not in `gone`, a table (file, at)."""
    flagged = gone.select("file", "at", F.lit(True).alias("gone"))
    return with_flags(df, flagged, ["gone"], lambda rows, flags: rows.filter(~flags[0]).select(*df.columns), bound)
