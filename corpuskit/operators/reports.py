"""Order and shipping reports over star-schema tables.

Dimension joins carry no broadcast hint: Spark broadcasts a side it measures to
be under spark.sql.autoBroadcastJoinThreshold and shuffles otherwise, where AQE
splits skewed partitions. Fact sides are reduced to one row per key before they
meet, so a key with very many line items is added up inside each task first.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import (
    after,
    before,
    charge,
    date_matches,
    discounted,
    extended,
    money,
    month_of,
    rate,
)


def _count():
    return F.count(F.lit(1))


def unmatched(rows: DataFrame, dimension: DataFrame, key: str, dimension_key: str) -> int:
    """How many distinct keys of `rows` the dimension does not have."""
    keys = rows.select(F.col(key).alias(dimension_key)).distinct()
    return keys.join(dimension, dimension_key, "left_anti").count()


def _dimension(
    rows: DataFrame, dimension: DataFrame, key: str, dimension_key: str, strict: bool
) -> DataFrame:
    """Inner join on the key; with `strict`, an unknown key raises instead of dropping out.

    The check is part of the join: the row itself raises in the job that reads
    it, and no other job looks at the keys. Who reads none of the columns, as a
    bare count of the rows does, is told nothing.
    """
    if not strict:
        return rows.join(dimension, rows[key] == dimension[dimension_key])
    known = dimension.withColumn("_known", F.lit(True))
    joined = rows.join(known, rows[key] == known[dimension_key], "left")
    message = F.concat(F.lit(f"{key} is not in {dimension_key}: "), F.coalesce(F.col(key).cast("string"), F.lit("NULL")))
    # every column comes out of the check, so none can be read without it
    checked = [
        F.when(F.col("_known").isNull(), F.raise_error(message).cast(f.dataType)).otherwise(F.col(f.name)).alias(f.name)
        for f in joined.schema.fields
        if f.name != "_known"
    ]
    return joined.select(*checked)


def ship_count(lineitem: DataFrame, date: str) -> DataFrame:
    """One row n_items: line items shipped on the date (or month, year, date part)."""
    return lineitem.filter(date_matches("l_shipdate", date)).agg(_count().alias("n_items"))


def shipped_orders(orders: DataFrame, lineitem: DataFrame, date: str) -> DataFrame:
    """Orders with at least one line item shipped on the date, one row per order."""
    keys = (
        lineitem.filter(date_matches("l_shipdate", date))
        .select(F.col("l_orderkey").alias("o_orderkey"))
        .distinct()
    )
    return orders.join(keys, "o_orderkey", "left_semi")


def clerks(
    orders: DataFrame, lineitem: DataFrame, date: str, carry: str = "o_clerk", n: int = 20
) -> DataFrame:
    """(carry, o_orderkey): first n orders by key with a line item shipped on the date."""
    shipped = shipped_orders(orders.select("o_orderkey", carry), lineitem, date)
    return shipped.select(carry, "o_orderkey").orderBy("o_orderkey", carry).limit(n)


def parts_suppliers(
    lineitem: DataFrame,
    part: DataFrame,
    supplier: DataFrame,
    date: str,
    n: int | None = 20,
    strict: bool = False,
) -> DataFrame:
    """(l_orderkey, p_name, s_name): first n line items by order shipped on the date.

    n=None gives all of them, unordered.
    """
    items = lineitem.filter(date_matches("l_shipdate", date)).select(
        "l_orderkey", "l_partkey", "l_suppkey"
    )
    named = _dimension(
        items, part.select("p_partkey", "p_name"), "l_partkey", "p_partkey", strict
    )
    named = _dimension(
        named, supplier.select("s_suppkey", "s_name"), "l_suppkey", "s_suppkey", strict
    ).select("l_orderkey", "p_name", "s_name")
    if n is None:
        return named
    return named.orderBy("l_orderkey", "p_name", "s_name").limit(n)


def orders_per_nation(
    orders: DataFrame,
    lineitem: DataFrame,
    customer: DataFrame,
    nation: DataFrame,
    date: str,
    strict: bool = False,
) -> DataFrame:
    """(n_nationkey, n_name, n_orders) of orders shipped on the date, by nation key."""
    shipped = shipped_orders(orders.select("o_orderkey", "o_custkey"), lineitem, date)
    per_customer = shipped.groupBy("o_custkey").agg(_count().alias("_n"))
    homes = customer.select("c_custkey", "c_nationkey")
    per_key = (
        _dimension(per_customer, homes, "o_custkey", "c_custkey", strict)
        .groupBy("c_nationkey")
        .agg(F.sum("_n").alias("n_orders"))
    )
    names = nation.select("n_nationkey", "n_name")
    return (
        _dimension(per_key, names, "c_nationkey", "n_nationkey", strict)
        .select("n_nationkey", "n_name", "n_orders")
        .orderBy("n_nationkey")
    )


def monthly_items(
    orders: DataFrame,
    lineitem: DataFrame,
    customer: DataFrame,
    nations: Sequence[int] = (3, 24),
) -> DataFrame:
    """(nationkey, month, n_items) of line items by ship month for customers of the nations.

    Both joins shuffle plain scans, whose hot keys AQE splits; line items are
    counted after the join, in each task, as (nation, month) has few groups.
    """
    homes = customer.filter(F.col("c_nationkey").isin(list(nations))).select(
        F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("nationkey")
    )
    theirs = orders.select("o_orderkey", "o_custkey").join(homes, "o_custkey")
    items = lineitem.select(
        F.col("l_orderkey").alias("o_orderkey"), month_of("l_shipdate").alias("month")
    )
    return (
        items.join(theirs.select("o_orderkey", "nationkey"), "o_orderkey")
        .groupBy("nationkey", "month")
        .agg(_count().alias("n_items"))
    )


def pricing_summary(lineitem: DataFrame, date: str) -> DataFrame:
    """Sums, averages and count per return flag and line status of items shipped on the date."""
    items = lineitem.filter(date_matches("l_shipdate", date)).select(
        "l_returnflag",
        "l_linestatus",
        money("l_quantity").alias("_qty"),
        money("l_extendedprice").alias("_price"),
        rate("l_discount").alias("_disc"),
        discounted("l_extendedprice", "l_discount").alias("_net"),
        charge("l_extendedprice", "l_discount", "l_tax").alias("_charge"),
    )
    sums = items.groupBy("l_returnflag", "l_linestatus").agg(
        *[F.sum(c).alias(c) for c in ("_qty", "_price", "_disc", "_net", "_charge")],
        _count().alias("n_items"),
    )

    def mean(c: str):
        return F.round(F.col(c).cast("double") / F.col("n_items"), 2)

    return sums.select(
        "l_returnflag",
        "l_linestatus",
        extended("_qty").alias("sum_qty"),
        extended("_price").alias("sum_base_price"),
        extended("_net").alias("sum_disc_price"),
        extended("_charge").alias("sum_charge"),
        mean("_qty").alias("avg_qty"),
        mean("_price").alias("avg_price"),
        mean("_disc").alias("avg_disc"),
        "n_items",
    )


def unshipped_value(
    customer: DataFrame,
    orders: DataFrame,
    lineitem: DataFrame,
    date: str,
    carry: str = "o_shippriority",
    n: int = 10,
    strict: bool = False,
) -> DataFrame:
    """(c_name, o_orderkey, revenue, o_orderdate, carry): n largest open orders.

    Orders from before the date, their line items shipped after it; revenue
    descending, then order key. Rounding comes after the choice.
    """
    per_order = (
        lineitem.filter(after("l_shipdate", date))
        .groupBy(F.col("l_orderkey").alias("o_orderkey"))
        .agg(F.sum(discounted("l_extendedprice", "l_discount")).alias("_revenue"))
    )
    open_orders = orders.filter(before("o_orderdate", date)).select(
        "o_orderkey", "o_custkey", "o_orderdate", carry
    )
    valued = open_orders.join(per_order, "o_orderkey")
    names = customer.select("c_custkey", "c_name")
    best = (
        _dimension(valued, names, "o_custkey", "c_custkey", strict)
        .orderBy(F.desc("_revenue"), "o_orderkey")
        .limit(n)
    )
    return best.select(
        "c_name",
        "o_orderkey",
        extended("_revenue").alias("revenue"),
        F.col("o_orderdate").cast("date").alias("o_orderdate"),
        carry,
    )
