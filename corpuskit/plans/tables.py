"""The given tables as lines, documents, graph and instances, in Spark and in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import tokenize
from ..sources.page_links import address, page_edges, page_nodes
from ..sources.state import tasks_for

# A line of a document is named by both columns, however long documents are.
LINE = ("doc_id", "line_no")


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def document_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, line_no, line), every line of every document."""
    docs = load(spark, sf_dir, "documents")
    return docs.select("doc_id", F.posexplode(F.split("text", "\n")).alias("line_no", "line"))


def whole_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(docno, line) with a whole document as one line."""
    docs = load(spark, sf_dir, "documents")
    return docs.select(F.col("doc_id").alias("docno"), F.col("text").alias("line"))


def purchases(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """nodes(node), edges(src, dst): all customers and parts, and a link each way for every line item.

    Customers have even numbers and parts odd ones. Customers without orders and
    parts that nobody bought have no out-edges. Where there are more line items
    than the shuffle's partitions should sort, they meet their orders in more tasks.
    """
    customers = load(spark, sf_dir, "customer").select((F.col("c_custkey") * 2).alias("node"))
    parts = load(spark, sf_dir, "part").select((F.col("p_partkey") * 2 + 1).alias("node"))
    orders = load(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"), (F.col("o_custkey") * 2).alias("customer")
    )
    items = load(spark, sf_dir, "lineitem").select("l_orderkey", (F.col("l_partkey") * 2 + 1).alias("part"))
    tasks = tasks_for(spark, items.count(), least=1)
    if tasks > int(spark.conf.get("spark.sql.shuffle.partitions")):
        items, orders = (df.repartition(tasks, "l_orderkey") for df in (items, orders))
    bought = items.join(orders, "l_orderkey")
    ways = F.explode(
        F.array(
            F.struct(F.col("customer").alias("src"), F.col("part").alias("dst")),
            F.struct(F.col("part").alias("src"), F.col("customer").alias("dst")),
        )
    )
    return customers.union(parts), bought.select(ways.alias("e")).select("e.*")


def graph_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(source): the first customer of each nation."""
    customers = load(spark, sf_dir, "customer").groupBy("c_nationkey")
    return customers.agg((F.min("c_custkey") * 2).alias("source")).select("source")


def page_graph(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """nodes(node), edges(src, dst): the links of all pages between addresses.

    Nodes are the pages and the targets that at least two pages link to, which
    have no links of their own. Other targets are unknown.
    """
    pages = load(spark, sf_dir, "pages")
    edges = page_edges(pages)
    return page_nodes(pages, edges, seen_from=2), edges


def page_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(source): the first page of each site."""
    pages = load(spark, sf_dir, "pages").select(address("url").alias("node"))
    site = F.regexp_extract("node", "^[a-z]+://[^/]*", 0)
    return pages.groupBy(site).agg(F.min("node").alias("source")).select("source")


def labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, lang, label, features): toxic documents are spam, all tokens are features."""
    docs = load(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    labels = load(spark, sf_dir, "labels").select("doc_id", "toxic")
    label = F.when(F.col("toxic") == 1, F.lit("spam")).otherwise(F.lit("ham")).alias("label")
    return docs.join(labels, "doc_id").select("doc_id", "lang", label, tokenize("text").alias("features"))


# The same in SQL, as named parts of a WITH clause. Tokens are made the long
# way here: split at whitespace, strip each piece, drop empty ones.

_PIECES = r"regexp_split_to_array({0}, '[ \t\n\r\f]+')"
# Fixed value: what is cut off at both ends of a token.
_CLEAN = "regexp_replace(lower({0}), '^[^a-z]+|[^a-z]+$', '', 'g')"


def _token_list(column: str) -> str:
    cleaned = f"list_transform({_PIECES.format(column)}, lambda x: {_CLEAN.format('x')})"
    return f"list_filter({cleaned}, lambda x: x <> '')"


SQL_LINES = """lines AS (
  SELECT doc_id, CAST(generate_subscripts(parts, 1) - 1 AS INTEGER) AS line_no, unnest(parts) AS line
  FROM (SELECT doc_id, string_split(text, chr(10)) AS parts FROM documents))"""

SQL_TOKENS = f"""{SQL_LINES},
tokens AS (
  SELECT doc_id, line_no, generate_subscripts(ws, 1) AS i, unnest(ws) AS word
  FROM (SELECT doc_id, line_no, {_token_list('line')} AS ws FROM lines))"""

SQL_VOCAB = f"""{SQL_TOKENS},
vocab AS (SELECT DISTINCT doc_id, line_no, word FROM tokens)"""

SQL_DOC_TOKENS = f"""doc_tokens AS (
  SELECT docno, unnest(ws) AS term
  FROM (SELECT doc_id AS docno, {_token_list('text')} AS ws FROM documents))"""

SQL_POSTINGS = f"""{SQL_DOC_TOKENS},
postings AS (SELECT term, docno, CAST(count(*) AS INTEGER) AS tf FROM doc_tokens GROUP BY term, docno)"""

SQL_GRAPH = """nodes AS (
  SELECT 2 * c_custkey AS node FROM customer UNION ALL SELECT 2 * p_partkey + 1 FROM part),
bought AS (
  SELECT 2 * o_custkey AS customer, 2 * l_partkey + 1 AS part FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
edges AS (SELECT customer AS src, part AS dst FROM bought UNION ALL SELECT part, customer FROM bought),
sources AS (SELECT 2 * min(c_custkey) AS source FROM customer GROUP BY c_nationkey)"""

SQL_PAGES = """hrefs AS (
  SELECT regexp_replace(url, '[?#].*$', '') AS src,
         unnest(regexp_extract_all(html, '(?i)<a\\s[^>]*?href\\s*=\\s*["'']([^"''>]*)["'']', 1)) AS href
  FROM pages),
edges AS (
  SELECT src, regexp_replace(CASE
    WHEN href ILIKE 'http://%' OR href ILIKE 'https://%' THEN href
    WHEN href LIKE '//%' THEN regexp_extract(src, '^[a-zA-Z]+:') || href
    WHEN href LIKE '/%' THEN regexp_extract(src, '^[a-zA-Z]+://[^/]*') || href
    ELSE regexp_replace(src, '[^/]*$', '') || href END, '[?#].*$', '') AS dst
  FROM hrefs WHERE src IS NOT NULL AND href <> '' AND NOT href LIKE '#%' AND NOT href LIKE '?%'),
own AS (SELECT DISTINCT regexp_replace(url, '[?#].*$', '') AS node FROM pages),
nodes AS (
  SELECT node FROM own
  UNION SELECT dst FROM (SELECT DISTINCT src, dst FROM edges) GROUP BY dst HAVING count(*) >= 2),
sources AS (SELECT min(node) AS source FROM own GROUP BY regexp_extract(node, '^[a-z]+://[^/]*'))"""

SQL_INSTANCES = f"""instances AS (
  SELECT doc_id, lang, CASE WHEN toxic = 1 THEN 'spam' ELSE 'ham' END AS label,
         {_token_list('text')} AS features
  FROM documents JOIN labels USING (doc_id)),
counted AS (
  SELECT doc_id, lang, label, feature, count(*) AS n
  FROM (SELECT doc_id, lang, label, unnest(features) AS feature FROM instances)
  GROUP BY doc_id, lang, label, feature)"""


def sql_benchmark_terms() -> str:
    """(item_id, t): the distinct tokens of each item in order of first appearance."""
    return f"""SELECT item_id, list(term ORDER BY i) AS t FROM (
    SELECT item_id, term, min(i) AS i FROM (
      SELECT item_id, unnest(ws) AS term, generate_subscripts(ws, 1) AS i
      FROM (SELECT item_id, {_token_list('text')} AS ws FROM benchmark))
    GROUP BY item_id, term)
  GROUP BY item_id"""
