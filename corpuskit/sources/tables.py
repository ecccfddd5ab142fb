"""Pipe-delimited star-schema tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Column order of the .tbl files.
TBL_SCHEMAS = {
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
        "l_quantity decimal(12,2), l_extendedprice decimal(12,2), l_discount decimal(12,2), "
        "l_tax decimal(12,2), l_returnflag string, l_linestatus string, l_shipdate date, "
        "l_commitdate date, l_receiptdate date, l_shipinstruct string, l_shipmode string, "
        "l_comment string"
    ),
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, "
        "o_totalprice decimal(12,2), o_orderdate date, o_orderpriority string, "
        "o_clerk string, o_shippriority string, o_comment string"
    ),
    "customer": (
        "c_custkey bigint, c_name string, c_address string, c_nationkey int, c_phone string, "
        "c_acctbal decimal(12,2), c_mktsegment string, c_comment string"
    ),
    "part": (
        "p_partkey bigint, p_name string, p_mfgr string, p_brand string, p_type string, "
        "p_size int, p_container string, p_retailprice decimal(12,2), p_comment string"
    ),
    "supplier": (
        "s_suppkey bigint, s_name string, s_address string, s_nationkey int, s_phone string, "
        "s_acctbal decimal(12,2), s_comment string"
    ),
    "nation": "n_nationkey int, n_name string, n_regionkey int, n_comment string",
}


def read_tbl(spark: SparkSession, directory: str, table: str) -> DataFrame:
    """Typed table from <directory>/<table>.tbl.

    Fields have no quoting, and one more delimiter after the last is ignored. A
    field that is used and does not parse is an error; unused ones are not parsed.
    """
    fields = F.split("value", r"\|")
    columns = [c.rsplit(" ", 1) for c in TBL_SCHEMAS[table].split(", ")]
    return spark.read.text(f"{directory}/{table}.tbl").select(
        *[fields[i].cast(kind).alias(name) for i, (name, kind) in enumerate(columns)]
    )
