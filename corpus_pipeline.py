"""A training-data pipeline: quality, exact and near copies, secrets, packing.

Each stage takes (spark, docs, sf_dir) and works on all rows that the stage
before it has kept, written as Parquet and read again. All stages but the last
return the columns of `documents`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuskit.llm import bloom, exact_dedup, jaccard_join, packing, places, quality_rules, secret_scan
from corpuskit.plans.tables import load
from corpuskit.sources.state import cut


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rule ensemble doesn't reject.

    Null and empty texts are scored like any other, by their statistics. Repeated
    rows share their score and stay or go together. Further columns, of whatever
    name, pass through; an empty table stays empty.
    """
    return quality_rules.keep_good(docs, load(spark, sf_dir, "labels"))


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group with the same normalised text, the one of the smallest id.

    Null text is as empty text, null ids come last, of repeated rows one stays.
    Further columns, of whatever name, pass through; an empty table stays empty.
    """
    return exact_dedup.dedup(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, of the smallest id, of each class linked by a similarity of 0.8 of 5-word shingles.

    Where rows share an id or have none, all are told apart by a number of their
    own: different texts under one id stay unless they are near copies of another row. Null ids
    come last; of rows with the same id in a class the first stored stays. Texts
    without words, null ones too, are in no class and stay. Further columns, of
    whatever name, pass through; an empty table stays empty.
    """
    shared = docs.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1 OR doc_id IS NULL")
    if shared.isEmpty():  # ids are numbers of rows already
        classes = cut(jaccard_join.classes(docs, words=5, num=80, den=100), "classes")
        table = places.stored(docs, "documents")
        rows = table.select("doc_id", places.place(table).alias("row"))
        gone = rows.join(classes.filter("doc_id <> component_id").select("doc_id"), "doc_id", "left_semi")
        return places.without(table, gone.select("row.*"))
    row = bloom.unused(docs, "row")
    numbered = cut(docs.withColumn(row, F.monotonically_increasing_id()), "numbered")
    members = cut(jaccard_join.classes(numbered, row, words=5, num=80, den=100).toDF("member", "class"), "classes")
    ids = bloom.within(numbered.select(F.col(row).alias("member"), "doc_id"), members.select("member"), "member")
    known = cut(members.join(ids, "member"), "members")
    first = known.groupBy("class").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "member"))["member"].alias("first"))
    others = cut(known.join(first, "class").filter("member <> first").select("member"), "others")
    return bloom.without(numbered, others, row).select(*docs.columns)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with a mark in place of each secret and n_chars as the text then has.

    Null texts stay null, with n_chars null. Repeated rows all stay. Further
    columns, of whatever name, pass through; an empty table stays empty.
    """
    return secret_scan.redact(docs, "text").withColumn("n_chars", F.length("text").cast("bigint"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' tokens in full sequences, one row per piece.

    Null and empty texts are an end token. Repeated rows are packed each; null
    ids stay null. Further columns play no part; an empty table has no pieces.
    """
    return packing.pack(docs)


STAGES = [
    ("quality classifier", quality),
    ("exact dedup", exact_copies),
    ("n-gram Jaccard join", near_copies),
    ("secret scans", secrets),
    ("packing", packed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`."""
    docs = load(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), name.replace(" ", "-").lower())
    return STAGES[-1][1](spark, docs, sf_dir)


# A learned classifier and a tokenizer cannot be written in SQL.
ORACLE_SQL = None
