"""Sources and sinks: the given tables written out, read back and queried."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import operators as op
from ..functions import tokenize
from ..sources import (
    read_adjacency,
    read_instances,
    read_lines,
    read_lines_with_offset,
    read_model,
    read_models,
    read_tbl,
    write_index,
    write_keyed_table,
    write_model,
    write_text,
)
from ..sources.state import fresh_path, passing
from ..sources.tables import TBL_SCHEMAS
from . import graph, index, reports, text
from .tables import (
    SQL_GRAPH,
    SQL_INSTANCES,
    SQL_LINES,
    document_lines,
    labelled,
    load,
    purchases,
    whole_documents,
)


def _parallelism(spark) -> int:
    return spark.sparkContext.defaultParallelism


# Documents' numbers in one file of text.
FILE_RANGE = 4096


def _offsets(spark, sf):
    """The documents of each source as text files, one for each range of numbers, read with the offset of every line.

    Files have a line with the document's number before its text, so that lines
    can be told apart; (file, docno) is the key of a line. Documents without
    source are a source of their own, and those without text have an empty line.
    """
    path = fresh_path(spark, "lines")
    docs = load(spark, sf, "documents")
    number = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    rows = docs.select(
        F.coalesce("source", F.lit("none")).alias("source"),
        F.coalesce(F.floor(F.col("doc_id") / FILE_RANGE), F.lit(-1)).alias("range"),
        F.concat(F.lit("#"), number, F.lit("\n"), F.coalesce("text", F.lit(""))).alias("value"),
        "doc_id",
    )
    files = rows.repartition("source", "range").sortWithinPartitions("source", "range", "doc_id")
    files.select("source", "range", "value").write.partitionBy("source", "range").text(path)
    read = read_lines_with_offset(spark, path)
    source, number = (F.regexp_extract("path", f"{c}=([^/]+)/", 1) for c in ("source", "range"))
    return read.select(source.alias("source"), number.cast("bigint").alias("range"), "docno", "line")


def _text_sink(spark, sf):
    path = fresh_path(spark, "counts")
    write_text(op.word_count(document_lines(spark, sf)), path, _parallelism(spark), ["word"])
    fields = F.split("line", "\t")
    return read_lines(spark, path).select(
        fields[0].alias("word"), fields[1].cast("bigint").alias("n")
    )


def _as_tbl(spark, sf, *tables):
    """Given tables as pipe-delimited files with all their columns, read back."""
    directory = fresh_path(spark, "tbl")
    for table in tables:
        rows = load(spark, sf, table)
        fields = []
        for column in TBL_SCHEMAS[table].split(", "):
            name, kind = column.split()
            value = F.col(name).cast(kind).cast("string") if name in rows.columns else F.lit("")
            fields.append(F.coalesce(value, F.lit("")))
        row = F.concat(F.concat_ws("|", *fields), F.lit("|"))
        rows.select(row.alias("value")).write.text(f"{directory}/{table}.tbl")
    return [read_tbl(spark, directory, table) for table in tables]


def _tbl(spark, sf):
    return op.pricing_summary(*_as_tbl(spark, sf, "lineitem"), reports.MONTH)


def _tbl_orders_per_nation(spark, sf):
    tables = _as_tbl(spark, sf, "orders", "lineitem", "customer", "nation")
    return op.orders_per_nation(*tables, reports.MONTH)


def _tbl_parts(spark, sf):
    return op.parts_suppliers(*_as_tbl(spark, sf, "lineitem", "part", "supplier"), reports.DAY)


def _tbl_unshipped(spark, sf):
    tables = _as_tbl(spark, sf, "customer", "orders", "lineitem")
    return op.unshipped_value(*tables, reports.DAY, carry="o_orderpriority")


def _replaced(spark, sf):
    """Word counts written over prefix counts: only the later result is there."""
    path = fresh_path(spark, "replaced")
    lines = document_lines(spark, sf)
    write_text(op.prefix_count(lines), path, 2)
    write_text(op.word_count(lines), path, 3, ["word"])
    fields = F.split("line", "\t")
    return read_lines(spark, path).select(fields[0].alias("word"), fields[1].cast("bigint").alias("n"))


def _adjacency(spark, sf):
    """The graph of purchases as adjacency text, a line per node, read back."""
    path = fresh_path(spark, "adjacency")
    nodes, edges = purchases(spark, sf)
    listed = edges.groupBy(F.col("src").alias("node")).agg(F.collect_list("dst").alias("to"))
    lines = nodes.join(listed, "node", "left").select(
        F.concat_ws(" ", F.col("node").cast("string"), F.transform("to", lambda x: x.cast("string"))).alias("value")
    )
    lines.write.text(path)
    return read_adjacency(spark, path)


def _adjacency_edges(spark, sf):
    _, edges = _adjacency(spark, sf)
    return edges.groupBy("src", "dst").agg(F.count(F.lit(1)).alias("n"))


def _index_files(spark, sf):
    path = fresh_path(spark, "index")
    write_index(op.postings(whole_documents(spark, sf)), path, _parallelism(spark))
    return op.boolean_query(spark.read.parquet(path), index.RPN)


def _keyed_table(spark, sf):
    path = fresh_path(spark, "table")
    table = op.postings_table(op.postings(whole_documents(spark, sf)), index.SEGMENT)
    write_keyed_table(table, path)
    return spark.read.parquet(path).select("term", F.explode("cells").alias("docno", "tf"))


def _resumed_ranks(spark, sf):
    """Two iterations saved, and the third one from the saved state."""
    path = fresh_path(spark, "states")
    with passing(spark):  # the states are all that the later run has of the earlier
        graph.ranks_after(spark, sf, 2, save_to=path)
    return graph.single(graph.ranks_after(spark, sf, 3, start=2, save_to=path))


def _length_instances(spark, sf):
    """Labelled documents with the lengths of their tokens as features, by way of a text file."""
    path = fresh_path(spark, "instances")
    docs = load(spark, sf, "documents").select("doc_id", "text")
    rows = docs.join(load(spark, sf, "labels"), "doc_id").select(
        F.col("doc_id").cast("string").alias("doc_id"),
        F.when(F.col("toxic") == 1, F.lit("spam")).otherwise(F.lit("ham")).alias("label"),
        F.array_join(F.transform(tokenize("text"), lambda w: F.length(w).cast("string")), " "),
    )
    write_text(rows, path, sep=" ")
    return read_instances(spark, path)


def _instances_text(spark, sf):
    rows = _length_instances(spark, sf).select("doc_id", "label", F.explode("features").alias("feature"))
    return rows.groupBy("doc_id", "label", "feature").agg(F.count(F.lit(1)).alias("n"))


def _model_text(spark, sf):
    path = fresh_path(spark, "model")
    write_model(op.train_gradient(_length_instances(spark, sf), 1), path)
    return read_model(spark, path, "lengths").withColumn("weight", F.round("weight", 9))


def _models_text(spark, sf):
    """A model per language, each written to a folder of its own and named after it."""
    path = fresh_path(spark, "models")
    by_language = labelled(spark, sf).withColumnRenamed("lang", "model")
    lengths = F.transform("features", lambda w: F.length(w))
    models = op.train_gradient(by_language.withColumn("features", lengths), 1, by=["model"])
    write_model(models, path, one_folder_per="model")
    return read_models(spark, path).withColumn("weight", F.round("weight", 9))


QUERIES = {
    "lines_with_offset": _offsets,
    "text_sink": _text_sink,
    "text_replaced": _replaced,
    "tbl_pricing": _tbl,
    "tbl_orders_per_nation": _tbl_orders_per_nation,
    "tbl_parts": _tbl_parts,
    "tbl_unshipped": _tbl_unshipped,
    "adjacency_stats": lambda spark, sf: op.graph_stats(*_adjacency(spark, sf)),
    "adjacency_edges": _adjacency_edges,
    "index_files": _index_files,
    "keyed_table": _keyed_table,
    "ppr_resumed": _resumed_ranks,
    "instances_text": _instances_text,
    "model_text": _model_text,
    "models_text": _models_text,
}

_LENGTHS = f"""{SQL_INSTANCES},
lengths AS (
  SELECT CAST(doc_id AS VARCHAR) AS doc_id, label, CAST(length(feature) AS INTEGER) AS feature,
         CAST(sum(n) AS BIGINT) AS n
  FROM counted GROUP BY ALL)"""

ORACLES = {
    "lines_with_offset": f"""WITH {SQL_LINES},
each AS (
  SELECT source, doc_id, -1 AS line_no, '#' || coalesce(CAST(doc_id AS VARCHAR), '') AS line FROM documents
  UNION ALL SELECT source, doc_id, line_no, line FROM lines JOIN documents USING (doc_id)
  UNION ALL SELECT source, doc_id, 0, '' FROM documents WHERE text IS NULL),
ranged AS (
  SELECT coalesce(source, 'none') AS source, coalesce(doc_id // {FILE_RANGE}, -1) AS range, doc_id, line_no, line
  FROM each),
placed AS (
  SELECT source, range, line, coalesce(sum(strlen(line) + 1) OVER (
    PARTITION BY source, range ORDER BY doc_id, line_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS docno
  FROM ranged)
SELECT source, CAST(range AS BIGINT) AS range, CAST(docno AS BIGINT) AS docno, line FROM placed""",
    "text_sink": text.ORACLES["word_count"],
    "text_replaced": text.ORACLES["word_count"],
    "tbl_pricing": reports.ORACLES["q6_pricing"],
    "tbl_orders_per_nation": reports.ORACLES["q4_nation"],
    "tbl_parts": reports.ORACLES["q3_parts"],
    "tbl_unshipped": reports.ORACLES["q7_unshipped"],
    "adjacency_stats": graph.ORACLES["graph_stats"],
    "adjacency_edges": f"WITH {SQL_GRAPH} SELECT src, dst, count(*) AS n FROM edges GROUP BY ALL",
    "index_files": index.ORACLES["bool_query"],
    "keyed_table": index.ORACLES["postings_table"],
    "ppr_resumed": graph.ORACLES["ppr_3_iterations"],
    "instances_text": f"WITH {_LENGTHS} SELECT doc_id, label, feature, n FROM lengths",
    "model_text": f"""WITH {_LENGTHS}
SELECT 'lengths' AS model, feature,
  round(sum((CASE WHEN label = 'spam' THEN 0.5::DOUBLE ELSE -0.5::DOUBLE END) * n)
    * CAST(0.002 AS DOUBLE), 9) AS weight
FROM lengths GROUP BY feature""",
    "models_text": f"""WITH {SQL_INSTANCES}
SELECT lang AS model, CAST(length(feature) AS INTEGER) AS feature,
  round(sum((CASE WHEN label = 'spam' THEN 0.5::DOUBLE ELSE -0.5::DOUBLE END) * n)
    * CAST(0.002 AS DOUBLE), 9) AS weight
FROM counted GROUP BY ALL""",
}
