"""What the operators need to run Python on executors."""

from __future__ import annotations

import ctypes
import io
import os
import zipfile
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..sources.state import fresh_path

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the executors this package, once per application: a file in the shared folder that Spark hands out."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w") as z:
        for folder, _, names in os.walk(package):
            for name in sorted(names):
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    z.write(path, os.path.relpath(path, os.path.dirname(package)))
    context = spark.sparkContext
    path = spark._jvm.org.apache.hadoop.fs.Path(fresh_path(spark, "package"), "corpuskit_shipped.zip")
    store = path.getFileSystem(context._jsc.hadoopConfiguration())
    out = store.create(path)
    out.write(packed.getvalue())
    out.close()
    context.addPyFile(store.makeQualified(path).toString())
    _shipped.add(app)


def give_back() -> None:
    """Return to the system what Arrow's pool and malloc hold but nothing uses."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc's; others have none
    if trim:
        trim(0)


def map_arrow(
    df: DataFrame, run: Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: T.StructType
) -> DataFrame:
    """`df.mapInArrow`, with this package on the executors' path.

    A worker gives back what a task has left free: Spark keeps it for a minute,
    and a step that has no Python runs beside it.
    """
    ship(df.sparkSession)

    def returned(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            give_back()

    return df.mapInArrow(returned, schema)
