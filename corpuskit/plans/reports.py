"""Shipping reports. The given orders have no clerk and no ship priority; the order
priority stands in for both."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import operators as op
from ..functions import date_matches
from .tables import load

DAY = "1996-03-15"
MONTH = "1996-03"

_ON_DAY = "CAST(l_shipdate AS DATE) = DATE '1996-03-15'"
_IN_MONTH = "strftime(l_shipdate, '%Y-%m') = '1996-03'"


def _tables(spark, sf, *names):
    return [load(spark, sf, name) for name in names]


def _semi_join(spark, sf):
    orders, items = _tables(spark, sf, "orders", "lineitem")
    keys = orders.select("o_orderkey", "o_custkey")
    return op.shipped_orders(keys, items, MONTH)


QUERIES = {
    "ship_on_count": lambda spark, sf: op.ship_count(load(spark, sf, "lineitem"), DAY),
    "ship_month_count": lambda spark, sf: op.ship_count(load(spark, sf, "lineitem"), MONTH),
    "ship_substring_count": lambda spark, sf: op.ship_count(load(spark, sf, "lineitem"), "-03-1"),
    "semi_join_orders": _semi_join,
    "broadcast_part_supplier": lambda spark, sf: op.parts_suppliers(
        *_tables(spark, sf, "lineitem", "part", "supplier"), MONTH, n=None
    ),
    "q1_ship_count": lambda spark, sf: op.ship_count(load(spark, sf, "lineitem"), "1996"),
    "q2_clerks": lambda spark, sf: op.clerks(
        *_tables(spark, sf, "orders", "lineitem"), DAY, carry="o_orderpriority"
    ),
    "q3_parts": lambda spark, sf: op.parts_suppliers(
        *_tables(spark, sf, "lineitem", "part", "supplier"), DAY
    ),
    "q4_nation": lambda spark, sf: op.orders_per_nation(
        *_tables(spark, sf, "orders", "lineitem", "customer", "nation"), MONTH
    ),
    "q5_monthly": lambda spark, sf: op.monthly_items(
        *_tables(spark, sf, "orders", "lineitem", "customer")
    ),
    "q6_pricing": lambda spark, sf: op.pricing_summary(load(spark, sf, "lineitem"), MONTH),
    "q6_pricing_year": lambda spark, sf: op.pricing_summary(load(spark, sf, "lineitem"), "1996"),
    "q7_unshipped": lambda spark, sf: op.unshipped_value(
        *_tables(spark, sf, "customer", "orders", "lineitem"), DAY, carry="o_orderpriority"
    ),
    "date_filters": lambda spark, sf: load(spark, sf, "lineitem")
    .groupBy(
        date_matches("l_shipdate", DAY).alias("on_day"),
        date_matches("l_shipdate", MONTH).alias("in_month"),
        date_matches("l_shipdate", "1996").alias("in_year"),
        date_matches("l_shipdate", "6-0").alias("has_part"),
    )
    .agg(F.count(F.lit(1)).alias("n")),
}


_NET = "CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(4,2)))"


def _pricing(where: str) -> str:
    return f"""SELECT l_returnflag, l_linestatus,
  CAST(round(sum(CAST(l_quantity AS DECIMAL(12,2))), 2) AS DOUBLE) AS sum_qty,
  CAST(round(sum(CAST(l_extendedprice AS DECIMAL(12,2))), 2) AS DOUBLE) AS sum_base_price,
  CAST(round(sum({_NET}), 2) AS DOUBLE) AS sum_disc_price,
  CAST(round(sum({_NET} * (1 + CAST(l_tax AS DECIMAL(4,2)))), 2) AS DOUBLE) AS sum_charge,
  round(CAST(sum(CAST(l_quantity AS DECIMAL(12,2))) AS DOUBLE) / count(*), 2) AS avg_qty,
  round(CAST(sum(CAST(l_extendedprice AS DECIMAL(12,2))) AS DOUBLE) / count(*), 2) AS avg_price,
  round(CAST(sum(CAST(l_discount AS DECIMAL(4,2))) AS DOUBLE) / count(*), 2) AS avg_disc,
  count(*) AS n_items
FROM lineitem WHERE {where} GROUP BY l_returnflag, l_linestatus"""


ORACLES = {
    "ship_on_count": f"SELECT count(*) AS n_items FROM lineitem WHERE {_ON_DAY}",
    "ship_month_count": f"SELECT count(*) AS n_items FROM lineitem WHERE {_IN_MONTH}",
    "ship_substring_count": """SELECT count(*) AS n_items FROM lineitem
WHERE contains(CAST(CAST(l_shipdate AS DATE) AS VARCHAR), '-03-1')""",
    "semi_join_orders": f"""SELECT o_orderkey, o_custkey FROM orders
WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE {_IN_MONTH})""",
    "broadcast_part_supplier": f"""SELECT l_orderkey, p_name, s_name
FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey
WHERE {_IN_MONTH}""",
    "q1_ship_count": "SELECT count(*) AS n_items FROM lineitem WHERE year(l_shipdate) = 1996",
    "q2_clerks": f"""SELECT o_orderpriority, o_orderkey FROM orders
WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE {_ON_DAY})
ORDER BY o_orderkey, o_orderpriority LIMIT 20""",
    "q3_parts": f"""SELECT l_orderkey, p_name, s_name
FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey
WHERE {_ON_DAY} ORDER BY l_orderkey, p_name, s_name LIMIT 20""",
    "q4_nation": f"""SELECT n_nationkey, n_name, count(*) AS n_orders
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE {_IN_MONTH})
GROUP BY n_nationkey, n_name ORDER BY n_nationkey""",
    "q5_monthly": """SELECT c_nationkey AS nationkey, strftime(l_shipdate, '%Y-%m') AS month,
  count(*) AS n_items
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
WHERE c_nationkey IN (3, 24) GROUP BY ALL""",
    "q6_pricing": _pricing(_IN_MONTH),
    "q6_pricing_year": _pricing("year(l_shipdate) = 1996"),
    "q7_unshipped": f"""SELECT c_name, o_orderkey, CAST(round(revenue, 2) AS DOUBLE) AS revenue,
  CAST(o_orderdate AS DATE) AS o_orderdate, o_orderpriority
FROM (SELECT l_orderkey, sum({_NET}) AS revenue FROM lineitem
      WHERE CAST(l_shipdate AS DATE) > DATE '1996-03-15' GROUP BY l_orderkey)
JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
WHERE CAST(o_orderdate AS DATE) < DATE '1996-03-15'
ORDER BY revenue DESC, o_orderkey LIMIT 10""",
    "date_filters": f"""SELECT {_ON_DAY} AS on_day, {_IN_MONTH} AS in_month,
  year(l_shipdate) = 1996 AS in_year,
  contains(CAST(CAST(l_shipdate AS DATE) AS VARCHAR), '6-0') AS has_part, count(*) AS n
FROM lineitem GROUP BY ALL""",
}
