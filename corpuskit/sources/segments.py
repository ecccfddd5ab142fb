"""An index in files that can be skipped: postings in segments, and a table of what each segment spans."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .state import TASK_ROWS, cut_counted, tasks_for

# Postings in a segment.
SEGMENT_ROWS = 1 << 16


def write_segments(
    postings: DataFrame, path: str, parts: int, segment_rows: int = SEGMENT_ROWS, part_rows: int = TASK_ROWS
) -> None:
    """Postings (term, docno, tf) under <path>/postings/part=N and what they span under <path>/skips.

    Parts are ranges of (term, docno), so a term that is too frequent for one
    goes on in the next. There are `parts` of them, or more where one would have
    more than about `part_rows` rows, which a task sorts. Within a part, in that order, every `segment_rows` rows
    begin a new segment, and so does every term. `skips` has a row (term, part,
    segment, lowest, highest, n) for each. Replaces what is at `path`. Null terms
    are left out; an empty table gives empty files.
    """
    spark = postings.sparkSession
    # stored first: the ranges come from a sample, for which the postings would be made twice
    rows, n = cut_counted(postings.select("term", "docno", "tf").filter("term IS NOT NULL"), "postings")
    parts = tasks_for(spark, n, parts, part_rows)
    ranged = rows.repartitionByRange(parts, "term", "docno").sortWithinPartitions("term", "docno")
    # the id counts the rows of a partition, in their order, in its lower 33 bits
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    numbered = ranged.select("*", F.floor(place / segment_rows).cast("int").alias("segment"), F.spark_partition_id().alias("part"))
    schema = numbered.schema
    # the writer wants rows by part; said with the whole order, it keeps it
    numbered = numbered.sortWithinPartitions("part", "term", "docno")
    numbered.write.mode("overwrite").partitionBy("part").parquet(f"{path}/postings")
    stored = spark.read.schema(schema).parquet(f"{path}/postings")
    spans = stored.groupBy("term", "part", "segment").agg(
        F.min("docno").alias("lowest"), F.max("docno").alias("highest"), F.count(F.lit(1)).alias("n")
    )
    spans.repartitionByRange(parts, "term").sortWithinPartitions("term", "lowest").write.mode("overwrite").parquet(
        f"{path}/skips"
    )


def read_skips(spark: SparkSession, path: str) -> DataFrame:
    """(term, part, segment, lowest, highest, n): one row per segment of an index."""
    return spark.read.parquet(f"{path}/skips")


def read_segments(spark: SparkSession, path: str, segments: DataFrame | None = None) -> DataFrame:
    """(term, docno, tf) of an index, or only of the segments (term, part, segment) of a table.

    The parts and terms that occur in the table, at most as many as the index has
    parts and a query has terms, and the documents they span become filters on
    folders and files; rows of other segments in the same files go by a join.
    """
    stored = spark.read.parquet(f"{path}/postings").withColumn("part", F.col("part").cast("int"))
    if segments is None:
        return stored.select("term", "docno", "tf")
    spans = segments.agg(
        F.collect_set("part").alias("parts"),
        F.collect_set("term").alias("terms"),
        F.min("lowest").alias("lowest"),
        F.max("highest").alias("highest"),
    ).first()
    wanted = stored.filter(F.col("part").isin(spans["parts"]) & F.col("term").isin(spans["terms"]))
    if spans["parts"]:
        wanted = wanted.filter(F.col("docno").between(spans["lowest"], spans["highest"]))
    return wanted.join(segments.select("term", "part", "segment"), ["term", "part", "segment"], "left_semi").select(
        "term", "docno", "tf"
    )
