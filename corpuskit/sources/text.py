"""Line sources."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .state import cut


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """(line), in as many partitions as the reader makes."""
    return spark.read.text(path).withColumnRenamed("value", "line")


def _offsets():
    """For mapInArrow: (path, _block, _above, value), the bytes of the split's lines above each one.

    A function inside a function travels to the executors by value.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, above = None, 0
        for batch in batches:
            # rows come in file order; a task can have several splits, one after another
            ends = pc.run_end_encode(pc.binary_join_element_wise(batch["path"], batch["_block"].cast(pa.string()), "\n"))
            first = 0
            for last, name in zip(ends.run_ends.to_pylist(), ends.values.to_pylist(), strict=True):
                part = batch.slice(first, last - first)
                if name != split:
                    split, above = name, 0
                upto = pc.cumulative_sum(pc.add(pc.binary_length(part["value"]).cast(pa.int64()), 1))
                start = pa.concat_arrays([pa.array([0], pa.int64()), upto.slice(0, len(upto) - 1)])
                columns = [part["path"], part["_block"], pc.add(start, above), part["value"]]
                yield pa.RecordBatch.from_arrays(columns, ["path", "_block", "_above", "value"])
                above += upto[-1].as_py()
                first = last

    return run


def read_lines_with_offset(spark: SparkSession, path: str) -> DataFrame:
    """(path, docno, line) with docno the byte offset of the line in its file.

    The key of a line is (path, docno); offsets of different files meet. Lines
    end at \\n, \\r or \\r\\n. Every file split adds up the bytes of its own
    lines in the order in which it reads them, without a shuffle of the text; the
    splits before it in the file, a few numbers, give its start. A file of any
    size is thus read in parallel, and offsets are 64-bit.
    """
    raw = spark.read.option("lineSep", "\n").text(path)
    rows = raw.select(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("_block"),
        "value",
    )
    blocks = rows.groupBy("path", "_block").agg(F.sum(F.octet_length("value") + 1).alias("_sum"))
    earlier = Window.partitionBy("path").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_start")
    starts = cut(blocks.select("path", "_block", start), "starts")
    schema = "path string, _block bigint, _above bigint, value string"
    at = rows.mapInArrow(_offsets(), schema).join(starts, ["path", "_block"]).select(
        "path", (F.col("_start") + F.col("_above")).alias("_at"), F.split("value", "\r").alias("_pieces")
    )
    # "abc\r" is a line with \r\n at its end, not a line and an empty one
    n = F.size("_pieces")
    ended = (n > 1) & (F.element_at("_pieces", -1) == "")
    kept = F.when(ended, F.slice("_pieces", F.lit(1), n - 1)).otherwise(F.col("_pieces"))
    each = at.select("path", "_at", "_pieces", F.posexplode(kept).alias("_i", "line"))
    before = F.octet_length(F.array_join(F.slice("_pieces", F.lit(1), F.col("_i")), "\r"))
    inside = F.when(F.col("_i") > 0, before + 1).otherwise(0)
    return each.select("path", (F.col("_at") + inside).alias("docno"), "line")
