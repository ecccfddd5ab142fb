"""Where a job keeps intermediate tables, so that a lost executor costs no recomputation."""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

_SETTING = "spark.checkpoint.dir"

# Rows that a task sorts or groups at most, where their number is known; small ones, such as postings.
TASK_ROWS = 1 << 20


def state_dir(spark: SparkSession) -> str:
    """The shared folder the session names in spark.checkpoint.dir.

    Where that is unset, a folder in the session's warehouse, which all
    executors share too. Nothing depends on the kind of master.
    """
    shared = spark.conf.get(_SETTING, None) or spark.sparkContext.getCheckpointDir()
    if shared:
        return shared.rstrip("/")
    return spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_state"


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that no other run uses."""
    return f"{state_dir(spark)}/{name}-{uuid.uuid4().hex}"


# What each application has written here: paths, and names of tables.
_written: dict[str, list[tuple[str, str | None]]] = {}


def _note(spark: SparkSession, path: str, table: str | None = None) -> None:
    _written.setdefault(spark.sparkContext.applicationId, []).append((path, table))


def _remove(spark: SparkSession, written: list[tuple[str, str | None]]) -> None:
    configuration = spark.sparkContext._jsc.hadoopConfiguration()
    for path, table in written:
        if table:
            spark.sql(f"DROP TABLE IF EXISTS {table}")
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(configuration).delete(place, True)


def release(spark: SparkSession) -> int:
    """Remove the intermediate tables that this application has written, once its results are; how many.

    Results that are still to be computed from them fail afterwards. Tables that
    were given a path of their own are left.
    """
    written = _written.pop(spark.sparkContext.applicationId, [])
    _remove(spark, written)
    return len(written)


@contextmanager
def passing(spark: SparkSession, keep: Sequence[str] = ()) -> Iterator[None]:
    """At its end, remove the intermediate tables that were written within, but those of the names in `keep`.

    What goes on from within may read only the tables that are kept.
    """
    begun = len(_written.setdefault(spark.sparkContext.applicationId, []))
    yield
    written = _written[spark.sparkContext.applicationId]
    gone = [x for x in written[begun:] if x[0].rsplit("/", 1)[-1].rsplit("-", 1)[0] not in keep]
    written[begun:] = [x for x in written[begun:] if x not in gone]
    _remove(spark, gone)


@contextmanager
def _with_setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def _shuffles_removed(spark: SparkSession):
    """What is written within has its shuffles removed when it is written, not when the driver happens to collect its garbage."""
    return _with_setting(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")


def joined_as_dealt(spark: SparkSession):
    """Tables that are dealt out alike by some of the columns that they are joined on, and are written within, stay where they are."""
    return _with_setting(spark, "spark.sql.requireAllClusterKeysForCoPartition", "false")


def cut(df: DataFrame, name: str, path: str | None = None, row_group: int | None = None, codec: str | None = None) -> DataFrame:
    """Write `df` as Parquet in the shared folder and go on from the written table.

    Row groups of `row_group` bytes let many tasks read what few have written.
    `codec` is another compression than the session's.
    """
    spark = df.sparkSession
    if path is None:
        path = fresh_path(spark, name)
        _note(spark, path)
    options = {"parquet.block.size": str(row_group)} if row_group else {}
    options |= {"compression": codec} if codec else {}
    with _shuffles_removed(spark):
        df.write.mode("overwrite").options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def cut_counted(df: DataFrame, name: str) -> tuple[DataFrame, int]:
    """`cut`, and how many rows were written, counted while they were."""
    counter = Observation()
    stored = cut(df.observe(counter, F.count(F.lit(1)).alias("n")), name)
    return stored, counter.get["n"]


def tasks_for(spark: SparkSession, rows: int, least: int | None = None, each: int | None = None) -> int:
    """Over how many tasks so many rows are spread: at most `each`, by default TASK_ROWS, a task, and `least` or as the shuffle has at least.

    A number that is given to `repartition` stays, while AQE puts partitions
    together by their compressed size, which says little of what a task then holds.
    """
    least = least or int(spark.conf.get("spark.sql.shuffle.partitions"))
    return max(least, -(-rows // (each or TASK_ROWS)))


def bucket_keys(spark: SparkSession, buckets: int) -> list[int]:
    """An integer for each bucket that is put there; others may meet in one and leave another empty."""
    some = spark.range(40 * buckets).select(F.col("id").cast("int").alias("key"))
    found = some.groupBy(F.pmod(F.hash("key"), F.lit(buckets)).alias("bucket")).agg(F.min("key").alias("key"))
    keys = {r.bucket: r.key for r in found.collect()}
    return [keys[i] for i in range(buckets)]


def bucketed(
    df: DataFrame, name: str, columns: Sequence[str], buckets: int | None = None, folders: Sequence[str] = (), ordered: bool = True
) -> DataFrame:
    """Write `df` in the shared folder as a table in buckets by `columns`, sorted by them unless not `ordered`, one file per bucket.

    A join or an aggregation on exactly these columns reads the buckets as they
    are, without an exchange. By default there are as many as shuffle partitions.
    `folders` names columns of which each value has a folder of its own.
    """
    spark = df.sparkSession
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = fresh_path(spark, name)
    table = f"{name}_{uuid.uuid4().hex}"
    writer = df.repartition(n, *columns).write.format("parquet").bucketBy(n, *columns)
    writer = writer.sortBy(*columns) if ordered else writer
    writer = writer.partitionBy(*folders) if folders else writer
    _note(spark, path, table)
    with _shuffles_removed(spark):
        writer.option("path", path).saveAsTable(table)
    return spark.table(table)
