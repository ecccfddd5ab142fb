"""Exact dedup by two Bloom passes: only rows whose hash may be repeated are shuffled."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.skew import default_pieces, piece_of
from ..plans.tables import load
from ..sources.state import cut
from . import bloom, places


def normalised(text: str | Column) -> Column:
    """Text with each run of ASCII white space replaced by one space; null is empty."""
    text = F.col(text) if isinstance(text, str) else text
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")


def digest(text: str | Column) -> Column:
    """SHA-256 of the normalised text in UTF-8, as 32 bytes; equal digests are taken as equal texts."""
    return F.unhex(F.sha2(normalised(text).cast("binary"), 256))


def _hash(sha: str | Column) -> Column:
    return F.xxhash64(sha)


def mark(df: DataFrame, key: str = "doc_id", text: str = "text", max_words: int = bloom.MAX_WORDS) -> DataFrame:
    """(key, keep_id, group_size, kept, sha): one row per row of `df`, saying which row of its copies stays.

    Of rows with equal normalised text the one with the smallest key stays, nulls
    last; of rows that share key and text, one. The first pass stores (key,
    digest) and builds the filter of repeated hashes; the second sends rows that
    the filter clears straight to the result and shuffles the others, 60 bytes
    each. Their totals are taken per (digest, piece) before they meet, so a
    digest that holds a third of all rows is spread over `default_pieces` tasks.
    Empty input gives no rows; null text counts as empty; other columns of `df`
    play no part.
    """
    rows = cut(
        df.select(F.col(key).alias("key"), digest(text).alias("sha"), F.monotonically_increasing_id().alias("row")),
        "digests",
    )
    single, copies = _ranked(rows, max_words, default_pieces(df))
    return single.unionByName(copies).drop("row").withColumnRenamed("key", key)


def _ranked(rows: DataFrame, max_words: int, pieces: int) -> tuple[DataFrame, DataFrame]:
    """`rows` (key, sha, row) as (key, keep_id, group_size, kept, sha, row), in two parts.

    The first part holds those that the filter clears, which move nowhere, the
    second all others.
    """
    n_words = bloom.words_for(rows.count(), max_words)
    repeated = bloom.build(rows.select(_hash("sha")), n_words, at_least=2)
    tested = bloom.tested(rows, _hash("sha"), repeated, n_words, "maybe")
    single = tested.filter(~F.col("maybe")).select(
        "key", F.col("key").alias("keep_id"), F.lit(1).cast("bigint").alias("group_size"), F.lit(True).alias("kept"), "sha", "row"
    )

    rank = F.struct(F.col("key").isNull().alias("last"), "key", "row")
    maybe = tested.filter("maybe").withColumn("piece", piece_of(["row"], pieces))
    parts = maybe.groupBy("sha", "piece").agg(F.min(rank).alias("best"), F.count(F.lit(1)).alias("n"))
    of_text = Window.partitionBy("sha")
    whole = parts.select(
        "sha", "piece", F.min("best").over(of_text).alias("best"), F.sum("n").over(of_text).alias("group_size")
    )
    copies = maybe.join(whole, ["sha", "piece"]).select(
        "key", F.col("best.key").alias("keep_id"), "group_size", (F.col("row") == F.col("best.row")).alias("kept"), "sha", "row"
    )
    return single, copies


def dedup(df: DataFrame, key: str = "doc_id", text: str = "text", max_words: int = bloom.MAX_WORDS) -> DataFrame:
    """The rows of `df` that stay, with all their columns.

    Digests are stored with the places of their rows, and `mark`'s decisions go
    back to these places: neither texts nor other columns are exchanged, however
    full the filter is. Which row stays is as in `mark`; of rows that share key
    and text, the first by place. A `df` that is not a Parquet table as read is
    stored first.
    """
    table = places.stored(df)
    rows = cut(
        table.select(F.col(key).alias("key"), digest(text).alias("sha"), places.place(table).alias("row")), "digests"
    )
    _, copies = _ranked(rows, max_words, default_pieces(df))
    return places.without(table, copies.filter(~F.col("kept")).select("row.*"))


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the copy that stays, the size of its group and the digest of its text."""
    marked = mark(load(spark, sf_dir, "documents"))
    return marked.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("sha")).alias("text_sha256"))


QUERIES = {"op1_exact_dedup": op1_exact_dedup}

ORACLES = {
    "op1_exact_dedup": r"""
WITH t AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
  FROM documents)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = min(doc_id) OVER w AS kept, text_sha256
FROM t WINDOW w AS (PARTITION BY text_sha256)"""
}
