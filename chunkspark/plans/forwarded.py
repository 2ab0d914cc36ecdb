"""SQL texts handed over as they are, and the listing of what they can reach."""

from __future__ import annotations

from pyspark.sql import functions as F

from chunkspark.plans.registry import query
from chunkspark.session import TABLES, read_table, register_views
from chunkspark.sources.results import run_query
from chunkspark.sources.schema import column_sizes, describe_schema as describe_schema_of, table_row_counts


def _forward(name: str, spark_sql: str, oracle: str | None = None, views: str = "") -> None:
    needed = [t for t in TABLES if t in views.split()]

    @query(name, oracle or spark_sql)
    def run(spark, sf_dir):
        register_views(spark, sf_dir, needed)
        return run_query(spark, spark_sql)


_forward(
    "run_query",
    "SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderstatus <> 'F'",
    views="orders",
)
_forward(
    "filter_and_order",
    "SELECT c_custkey, c_name, c_acctbal FROM customer WHERE c_custkey > 0 ORDER BY c_custkey",
    views="customer",
)
_forward(
    "aggregate",
    """SELECT p_brand, p_size, CAST(count(*) AS BIGINT) AS parts,
              CAST(sum(CAST(p_retailprice AS DECIMAL(18,2))) AS DOUBLE) AS retail
       FROM part GROUP BY p_brand, p_size""",
    views="part",
)
_forward(
    "odd_column_names",
    "SELECT o_totalprice AS `c$`, o_orderkey AS `a?`, o_custkey AS `b.` FROM orders",
    'SELECT o_totalprice AS "c$", o_orderkey AS "a?", o_custkey AS "b." FROM orders',
    views="orders",
)
_forward(
    "always_true",
    "SELECT c_custkey, c_mktsegment FROM customer WHERE c_name = 'i' OR true",
    views="customer",
)
_forward(
    "cast_to_text",
    "SELECT CAST(n_nationkey AS STRING) AS nation, n_name, CAST(c_custkey AS STRING) AS customer "
    "FROM nation JOIN customer ON n_nationkey = c_nationkey",
    "SELECT CAST(n_nationkey AS VARCHAR) AS nation, n_name, CAST(c_custkey AS VARCHAR) AS customer "
    "FROM nation JOIN customer ON n_nationkey = c_nationkey",
    views="nation customer",
)
_forward(
    "in_list_over_subquery",
    """SELECT * FROM (SELECT l_orderkey, l_linenumber, l_shipdate, l_returnflag FROM lineitem) q
       WHERE l_linenumber IN (1, 3, 5)""",
    views="lineitem",
)
_forward(
    "empty_result",
    "SELECT * FROM orders WHERE 1 = 0",
    views="orders",
)


@query(
    "join_behind_view",
    "SELECT o_orderkey, o_custkey, c_name, c_mktsegment, o_totalprice FROM orders JOIN customer ON o_custkey = c_custkey",
)
def join_behind_view(spark, sf_dir):
    register_views(spark, sf_dir, ["orders", "customer"])
    spark.sql(
        """CREATE OR REPLACE TEMP VIEW customer_orders AS
           SELECT o_orderkey, o_custkey, c_name, c_mktsegment, o_totalprice
           FROM orders JOIN customer ON o_custkey = c_custkey"""
    )
    return run_query(spark, "SELECT * FROM customer_orders")


@query(
    "list_tables",
    " UNION ALL ".join(f"SELECT '{t}' AS table_name, CAST(count(*) AS BIGINT) AS row_count FROM {t}" for t in TABLES),
)
def list_tables(spark, sf_dir):
    register_views(spark, sf_dir)
    return table_row_counts(spark, TABLES)


def _column(position: int, name: str, kind: str, width: int, size: str) -> str:
    return (
        f"SELECT CAST({position} AS INTEGER) AS position, '{name}' AS name, '{kind}' AS type_class, "
        f"CAST({width} AS INTEGER) AS width, CAST({size} AS BIGINT) AS stored_bytes FROM customer"
    )


@query(
    "describe_schema",
    " UNION ALL ".join([
        _column(0, "c_custkey", "Int64", 8, "8 * count(*)"),
        _column(1, "c_name", "Variable", 0, "sum(16 + strlen(c_name))"),
        _column(2, "c_nationkey", "Int32", 4, "8 * count(*)"),
        _column(3, "c_acctbal", "Double", 8, "8 * count(*)"),
        _column(4, "c_mktsegment", "Variable", 0, "sum(16 + strlen(c_mktsegment))"),
    ]),
)
def describe_schema(spark, sf_dir):
    return column_sizes(read_table(spark, sf_dir, "customer"))


_SQL_COLUMNS = [
    _column(0, "c_name", "Variable", 0, "sum(16 + strlen(c_name))"),
    _column(1, "twice", "Double", 8, "8 * count(*)"),
    _column(2, "c_mktsegment", "Variable", 0, "sum(16 + strlen(c_mktsegment))"),
]


@query(
    "describe_table_and_query",
    "SELECT 'query' AS source, * FROM (" + " UNION ALL ".join(_SQL_COLUMNS) + ") UNION ALL SELECT 'table', * FROM (" + " UNION ALL ".join([
        _column(0, "c_custkey", "Int64", 8, "8 * count(*)"),
        _column(1, "c_name", "Variable", 0, "sum(16 + strlen(c_name))"),
        _column(2, "c_nationkey", "Int32", 4, "8 * count(*)"),
        _column(3, "c_acctbal", "Double", 8, "8 * count(*)"),
        _column(4, "c_mktsegment", "Variable", 0, "sum(16 + strlen(c_mktsegment))"),
    ]) + ")",
)
def describe_both(spark, sf_dir):
    """By table name and by the text of a query that has not run; beside it the bytes that each column takes."""
    register_views(spark, sf_dir, ["customer"])
    text = "SELECT c_name, c_acctbal * 2 AS twice, c_mktsegment FROM customer WHERE c_custkey >= 0"
    told = []
    for label, source in (("table", "customer"), ("query", text)):
        sizes = column_sizes(spark.table(source) if label == "table" else spark.sql(source)).select("position", "stored_bytes")
        told.append(describe_schema_of(spark, source).join(sizes, "position").select(
            F.lit(label).alias("source"), "position", "name", "type_class", "width", "stored_bytes"))
    return told[0].unionByName(told[1])
