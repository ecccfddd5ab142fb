"""Classifier input ``docid label f1 f2 ...`` and models."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def instances_from_text(lines: DataFrame, line: str = "line") -> DataFrame:
    """(doc_id, label, features array<int>) from blank-separated lines."""
    fields = F.split(F.rtrim(line), " ")
    parsed = lines.select(fields.alias("f"))
    features = F.transform(F.slice("f", F.lit(3), F.size("f")), lambda s: s.cast("int"))
    return parsed.select(
        F.col("f")[0].alias("doc_id"), F.col("f")[1].alias("label"), features.alias("features")
    )


def read_instances(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Training or test instances; a folder or several paths are read as one set."""
    return instances_from_text(spark.read.text(path), "value")


def _weights(spark: SparkSession, path: str | list[str]) -> DataFrame:
    pair = r"^\(([^,]+),([^)]+)\)$"
    return spark.read.text(path).select(
        F.col("_metadata.file_name").alias("file"),
        F.col("_metadata.file_path").alias("path"),
        F.regexp_extract("value", pair, 1).cast("int").alias("feature"),
        F.regexp_extract("value", pair, 2).cast("double").alias("weight"),
    )


def read_model(spark: SparkSession, path: str | list[str], name: str = "model") -> DataFrame:
    """(model, feature, weight) from ``(feature,weight)`` lines, all files one model."""
    return _weights(spark, path).select(F.lit(name).alias("model"), "feature", "weight")


def read_models(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(model, feature, weight) with one model per file or folder of files, named after it.

    A folder named model=NAME, as `write_model` makes them, gives NAME to all its files.
    """
    weights = _weights(spark, path)
    folder = F.regexp_extract("path", "/model=([^/]+)/", 1)
    # the name is escaped in the folder's name, and this again in the path
    plain = lambda c: F.url_decode(F.replace(c, F.lit("+"), F.lit("%2B")))
    name = F.when(folder != "", plain(plain(folder))).otherwise(F.col("file"))
    return weights.select(name.alias("model"), "feature", "weight")


def write_model(model: DataFrame, path: str, one_folder_per: str | None = None) -> None:
    """``(feature,weight)`` lines, replacing what is at `path`; a folder for each value of a column if asked.

    A folder has one file, or several where its model is large: Spark splits
    what one task would have to write by the session's advisory partition size.
    """
    pair = F.concat(
        F.lit("("), F.col("feature").cast("string"), F.lit(","), F.col("weight").cast("string"),
        F.lit(")"),
    ).alias("value")
    if one_folder_per is None:
        model.select(pair).write.mode("overwrite").text(path)
        return
    named = model.select(F.col(one_folder_per).alias("model"), pair).hint("rebalance", F.col("model"))
    named.write.mode("overwrite").partitionBy("model").text(path)
