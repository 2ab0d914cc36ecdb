"""Inputs the registered queries share, with the SQL of the same."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from chunkspark.operators.partition import PartitionSpec
from chunkspark.plans.sql_text import key_text, packed, partition_number, placed
from chunkspark.session import read_table, shared_dir

ORDERS_SPEC = PartitionSpec(8, ("o_custkey",), ("o_custkey", "o_orderkey"), "o_orderkey")
ORDERS_CHUNK = 4096
ORDERS_COLUMNS = "o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority"
ORDERS_NUMBER = partition_number([key_text("o_custkey")], 8)
ORDERS_BYTES = "64 + strlen(o_orderstatus) + strlen(o_orderpriority)"
ORDERS_PLACED = placed("orders", ORDERS_COLUMNS, ORDERS_NUMBER, "o_custkey, o_orderkey", ORDERS_BYTES)
ORDERS_PACKED = packed(ORDERS_PLACED, ORDERS_CHUNK)

LINEITEM_COLUMNS = (
    "l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax, "
    "l_returnflag, l_linestatus, l_shipdate"
)
LINEITEM_BYTES = "104 + strlen(l_returnflag) + strlen(l_linestatus)"


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "orders")


def lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "lineitem")


def new_name(stem: str) -> str:
    return f"{stem}_{uuid.uuid4().hex[:12]}"


def scratch(spark: SparkSession, name: str) -> str:
    """Folder for a table a query writes, in the shared folder."""
    return f"{shared_dir(spark)}/tables/{name}"
