"""Inverted index and boolean retrieval over whole documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import operators as op
from ..functions import tokenize
from ..sources import create_cells, cut, read_skips, upsert_cells, write_segments
from ..sources.state import cut_counted, fresh_path, tasks_for
from .tables import LINE, SQL_POSTINGS, SQL_TOKENS, _token_list, document_lines, load, sql_benchmark_terms, whole_documents

# Postings per index segment; even the smaller tables have lists of more than one.
SEGMENT = 128

RPN = "the and AND ciudad mente OR OR de AND"


def _postings(spark, sf):
    return op.postings(whole_documents(spark, sf))


def _index(spark, sf):
    """The lists themselves, an entry per row."""
    lists = op.inverted_index(_postings(spark, sf), SEGMENT)
    each = lists.select("term", "segment", "df", F.posexplode("postings").alias("pos", "p"))
    return each.select("term", "segment", "df", "pos", "p.docno", "p.tf")


def _line_gaps(spark, sf):
    """Gaps between the lines of each document that have a term: lists within documents."""
    postings = op.postings(document_lines(spark, sf), keys=LINE)
    return op.encode_gaps(postings, 4, keys=LINE)


def _benchmark_queries(spark, sf):
    """Two postfix queries per benchmark item: all of its tokens, and either of its
    first two together with either of the last two and the one in the middle."""
    tokens = load(spark, sf, "benchmark").select("item_id", F.array_distinct(tokenize("text")).alias("t"))
    t, n = F.col("t"), F.size("t")
    each = F.transform(F.slice(t, F.lit(2), n), lambda w: F.concat(w, F.lit(" AND")))
    every = F.concat_ws(" ", t[0], F.array_join(each, " "))
    middle = F.get(t, F.floor(n / 2).cast("int"))
    some = F.concat_ws(
        " ", t[0], F.get(t, F.least(n - 1, F.lit(1))), F.lit("OR"), F.get(t, F.greatest(n - 2, F.lit(0))),
        F.get(t, n - 1), F.lit("OR AND"), middle, F.lit("AND"),
    )
    kinds = F.create_map(F.lit("all"), every, F.lit("some"), some)
    rows = tokens.filter(n > 0).select("item_id", F.explode(kinds).alias("kind", "rpn"))
    return rows.select(F.concat_ws("-", "item_id", "kind").alias("query_id"), F.trim("rpn").alias("rpn"))


def _batch(spark, sf):
    return op.boolean_query_batch(_postings(spark, sf), _benchmark_queries(spark, sf))


def _term(word):
    return lambda spark, sf: op.term_docs(_postings(spark, sf), word)


def _sets(combine):
    def query(spark, sf):
        found = _postings(spark, sf)
        return combine(op.term_docs(found, "the"), op.term_docs(found, "and"))

    return query


def _snippets(spark, sf):
    docs = whole_documents(spark, sf)
    return op.fetch(op.boolean_query(op.postings(docs), "the and AND"), docs)


def _table_cells(spark, sf):
    table = op.postings_table(_postings(spark, sf), SEGMENT)
    return table.select("term", F.explode("cells").alias("docno", "tf"))


def _segmented(spark, sf):
    """The index in segments of SEGMENT postings; its folder."""
    path = fresh_path(spark, "segments")
    write_segments(_postings(spark, sf), path, spark.sparkContext.defaultParallelism, SEGMENT)
    return path


def _skip(rpn):
    return lambda spark, sf: op.skipping_query(spark, _segmented(spark, sf), rpn)


def _skips(spark, sf):
    """What the segments of every term span together."""
    whole = read_skips(spark, _segmented(spark, sf)).groupBy("term")
    return whole.agg(F.sum("n").alias("df"), F.min("lowest").alias("lowest"), F.max("highest").alias("highest"))


def _benchmark_postings(spark, sf):
    items = load(spark, sf, "benchmark").select(F.col("item_id").alias("docno"), F.col("text").alias("line"))
    return op.postings(items)


def _cells_upserted(spark, sf):
    """Cells of the documents, and then those of the benchmark items with the same numbers."""
    postings, n = cut_counted(_postings(spark, sf), "postings")
    buckets = tasks_for(spark, n)
    table = create_cells(postings, "cells", buckets)
    return upsert_cells(table, _benchmark_postings(spark, sf), "cells", buckets)


QUERIES = {
    "index_skips": _skips,
    "bool_skip_and": _skip("the and AND"),
    "bool_skip_query": _skip(RPN),
    "cells_upserted": _cells_upserted,
    "postings": _postings,
    "inverted_index": _index,
    "line_gaps": _line_gaps,
    "posting_gaps": lambda spark, sf: op.encode_gaps(_postings(spark, sf), SEGMENT),
    "posting_decode": lambda spark, sf: op.decode_gaps(
        cut(op.encode_gaps(_postings(spark, sf), SEGMENT), "gaps")
    ),
    "term_docs": _term("the"),
    "bool_and": _sets(op.docs_and),
    "bool_or": _sets(op.docs_or),
    "bool_query": lambda spark, sf: op.boolean_query(_postings(spark, sf), RPN),
    "bool_query_batch": _batch,
    "bool_snippets": _snippets,
    "postings_table": _table_cells,
}


def _docs(term: str) -> str:
    return f"SELECT docno FROM postings WHERE term = '{term}'"


ORACLES = {
    "index_skips": f"""WITH {SQL_POSTINGS}
SELECT term, count(*) AS df, min(docno) AS lowest, max(docno) AS highest FROM postings GROUP BY term""",
    "bool_skip_and": f"WITH {SQL_POSTINGS} {_docs('the')} INTERSECT {_docs('and')}",
    "bool_skip_query": f"""WITH {SQL_POSTINGS}
(({_docs('the')} INTERSECT {_docs('and')}) UNION ({_docs('ciudad')} UNION {_docs('mente')}))
INTERSECT {_docs('de')}""",
    "cells_upserted": f"""WITH {SQL_POSTINGS},
items AS (
  SELECT docno, unnest(ws) AS term
  FROM (SELECT item_id AS docno, {_token_list('text')} AS ws FROM benchmark)),
cells AS (
  SELECT term, docno, tf FROM postings
  UNION ALL SELECT term, docno, count(*) AS tf FROM items GROUP BY term, docno)
SELECT term, docno, CAST(sum(tf) AS INTEGER) AS tf FROM cells GROUP BY term, docno""",
    "postings": f"WITH {SQL_POSTINGS} SELECT term, docno, tf FROM postings",
    "inverted_index": f"""WITH {SQL_POSTINGS},
placed AS (
  SELECT term, docno, tf, count(*) OVER (PARTITION BY term) AS df,
         row_number() OVER (PARTITION BY term ORDER BY docno) - 1 AS place
  FROM postings)
SELECT term, place // {SEGMENT} AS segment, df, CAST(place % {SEGMENT} AS INTEGER) AS pos, docno, tf FROM placed""",
    "posting_gaps": f"""WITH {SQL_POSTINGS},
placed AS (
  SELECT term, tf, docno - lag(docno, 1, 0) OVER w AS gap, row_number() OVER w - 1 AS place
  FROM postings WINDOW w AS (PARTITION BY term ORDER BY docno))
SELECT term, place // {SEGMENT} AS segment, CAST(place % {SEGMENT} AS INTEGER) AS pos, gap, tf FROM placed""",
    "line_gaps": f"""WITH {SQL_TOKENS},
postings AS (
  SELECT word AS term, doc_id, line_no, CAST(count(*) AS INTEGER) AS tf FROM tokens GROUP BY ALL),
placed AS (
  SELECT term, doc_id, tf, line_no - lag(line_no, 1, 0) OVER w AS gap, row_number() OVER w - 1 AS place
  FROM postings WINDOW w AS (PARTITION BY term, doc_id ORDER BY line_no))
SELECT term, doc_id, place // 4 AS segment, CAST(place % 4 AS INTEGER) AS pos, gap, tf FROM placed""",
    "posting_decode": f"WITH {SQL_POSTINGS} SELECT term, docno, tf FROM postings",
    "term_docs": f"WITH {SQL_POSTINGS} {_docs('the')} ORDER BY docno",
    "bool_and": f"WITH {SQL_POSTINGS} {_docs('the')} INTERSECT {_docs('and')}",
    "bool_or": f"WITH {SQL_POSTINGS} {_docs('the')} UNION {_docs('and')}",
    "bool_query": f"""WITH {SQL_POSTINGS}
(({_docs('the')} INTERSECT {_docs('and')}) UNION ({_docs('ciudad')} UNION {_docs('mente')}))
INTERSECT {_docs('de')}""",
    "bool_query_batch": f"""WITH {SQL_POSTINGS},
listed AS ({sql_benchmark_terms()}),
wanted AS (
  SELECT item_id, t, len(t) AS n_terms, unnest(t) AS term FROM listed WHERE len(t) > 0),
hits AS (
  SELECT item_id, docno, any_value(t) AS t, any_value(n_terms) AS n_terms, list(term) AS has
  FROM wanted JOIN postings USING (term) GROUP BY item_id, docno)
SELECT item_id || '-all' AS query_id, docno FROM hits WHERE len(has) = n_terms
UNION ALL
SELECT item_id || '-some' AS query_id, docno FROM hits
WHERE (list_contains(has, t[1]) OR list_contains(has, t[least(n_terms, 2)]))
  AND (list_contains(has, t[greatest(n_terms - 1, 1)]) OR list_contains(has, t[n_terms]))
  AND list_contains(has, t[n_terms // 2 + 1])""",
    "bool_snippets": f"""WITH {SQL_POSTINGS}
SELECT doc_id AS docno,
  CASE WHEN length(text) > 80 THEN substring(text, 1, 80) || '...' ELSE text END AS snippet, text AS line
FROM documents WHERE doc_id IN ({_docs('the')} INTERSECT {_docs('and')}) ORDER BY docno""",
    "postings_table": f"WITH {SQL_POSTINGS} SELECT term, docno, tf FROM postings",
}
