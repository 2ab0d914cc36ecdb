"""Loads, changes and table creation."""

from __future__ import annotations

from pyspark.sql import functions as F

from chunkspark.functions.types import binary_field, char_field, time_field, with_fields
from chunkspark.plans.inputs import lineitem, new_name, scratch
from chunkspark.plans.registry import query
from chunkspark.session import read_table, register_views
from chunkspark.sources.positional import export_positional, import_positional
from chunkspark.sources.tables import (
    create_table, create_table_as, delete_where, drop_table, insert_rows, load_mapped, load_table,
    update_where, with_row_key,
)


def _copy(spark, sf_dir, source):
    """A new table with the rows of a given one."""
    register_views(spark, sf_dir, [source])
    name = new_name(source)
    create_table_as(spark, name, f"SELECT * FROM {source}", scratch(spark, name))
    return name


def _with_count(spark, table, count):
    return spark.table(table).withColumn("affected", F.lit(count).cast("long"))


@query(
    "load_table",
    """SELECT s_suppkey, s_name, s_nationkey, s_acctbal, 'loaded' AS note FROM supplier
       UNION ALL SELECT s_suppkey + 1000000000, s_name, NULL, s_acctbal * 2, 'loaded' FROM supplier""",
)
def load(spark, sf_dir):
    """Loads naming different columns in different orders; the rest get defaults."""
    name = new_name("supplier_loaded")
    create_table(
        spark, name,
        "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE, note STRING DEFAULT 'loaded'",
        scratch(spark, name),
    )
    supplier = read_table(spark, sf_dir, "supplier")
    load_table(supplier, name, ["s_acctbal", "s_name", "s_suppkey", "s_nationkey"])
    again = supplier.select(
        (F.col("s_suppkey") + 1_000_000_000).alias("s_suppkey"), (F.col("s_acctbal") * 2).alias("s_acctbal"), "s_name"
    )
    load_table(again, name)
    return spark.table(name)


def _mapped(spark, sf_dir, zero_is_null):
    rows = read_table(spark, sf_dir, "part").withColumns({
        "p_size": F.expr("nullif(p_size, 1)"),
        "p_brand": F.expr("if(p_size = 2, '', p_brand)"),
    })
    path = scratch(spark, new_name("part_records"))
    export_positional(rows, path)
    name = new_name("part_mapped")
    create_table(
        spark, name, "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, p_retailprice DOUBLE",
        scratch(spark, name),
    )
    loaded = load_mapped(import_positional(spark, path, rows.schema), name, rows.schema, zero_is_null)
    return _with_count(spark, name, loaded)


_MAPPED = """SELECT p_partkey, p_name, {brand} AS p_brand, p_type, nullif(p_size, 1) AS p_size, p_retailprice,
    (SELECT CAST(count(*) AS BIGINT) FROM part) AS affected FROM part"""


@query("load_mapped", _MAPPED.format(brand="CASE WHEN p_size = 2 THEN NULL ELSE p_brand END"))
def mapped(spark, sf_dir):
    return _mapped(spark, sf_dir, True)


@query("load_mapped_keep_empty", _MAPPED.format(brand="CASE WHEN p_size = 2 THEN '' ELSE p_brand END"))
def mapped_keep_empty(spark, sf_dir):
    return _mapped(spark, sf_dir, False)


_ALL_TYPES = """SELECT event_id, nullif(user_id, 3) AS user_id, ts - INTERVAL 60 YEAR AS ts,
    CASE WHEN event_id % 5 = 0 THEN NULL ELSE CAST(ts - INTERVAL 60 YEAR AS DATE) END AS day,
    CASE WHEN event_id % 7 = 0 THEN NULL ELSE (event_id % 200001 - 100000) * 1234567 END AS took,
    CASE WHEN event_id % 4 = 0 THEN {blank} ELSE event_type END AS kind,
    hex(CASE WHEN event_id % 6 = 0 THEN {zeros} ELSE {key} END) AS token, value, CASE WHEN event_id % 3 = 0 THEN {empty} ELSE props END AS props,
    (SELECT count(*) FROM events) AS affected FROM events"""


def _all_types(spark, sf_dir, zero_is_null):
    """Records of every type: dates and times before 1960, signed times, blank slots, empty text."""
    rows = read_table(spark, sf_dir, "events").selectExpr(
        "event_id", "nullif(user_id, 3) AS user_id", "ts - INTERVAL '60' YEAR AS ts",
        "if(event_id % 5 = 0, null, CAST(ts - INTERVAL '60' YEAR AS DATE)) AS day",
        "if(event_id % 7 = 0, null, CAST((event_id % 200001 - 100000) * 1234567 AS BIGINT)) AS took",
        "if(event_id % 4 = 0, '', event_type) AS kind",
        "if(event_id % 6 = 0, X'', CAST(lpad(CAST(event_id AS STRING), 12, '0') AS BINARY)) AS token", "value", "if(event_id % 3 = 0, '', props) AS props")
    rows = with_fields(rows, time_field("took"), char_field("kind", 12), binary_field("token", 12))
    path, name = scratch(spark, new_name("event_records")), new_name("events_mapped")
    export_positional(rows, path)
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema)
    create_table(spark, name, columns, scratch(spark, name))
    loaded = load_mapped(import_positional(spark, path, rows.schema), name, rows.schema, zero_is_null)
    return _with_count(spark, name, loaded).withColumn("token", F.hex("token"))


_KEY = "encode(lpad(CAST(event_id AS VARCHAR), 12, '0'))"


@query("load_mapped_all_types", _ALL_TYPES.format(blank="NULL", zeros="NULL", empty="NULL", key=_KEY))
def mapped_all_types(spark, sf_dir):
    return _all_types(spark, sf_dir, True)


@query("load_mapped_all_types_keep_empty", _ALL_TYPES.format(blank="''", zeros="'\\x00\\x00\\x00\\x00\\x00\\x00\\x00\\x00\\x00\\x00\\x00\\x00'::BLOB", empty="''", key=_KEY))
def mapped_all_types_keep_empty(spark, sf_dir):
    return _all_types(spark, sf_dir, False)


@query(
    "insert_rows",
    """SELECT *, (SELECT CAST(count(*) AS BIGINT) FROM supplier WHERE s_acctbal > 0) AS affected
       FROM (SELECT * FROM supplier UNION ALL
             SELECT s_suppkey + 1000000000, s_name, s_nationkey, s_acctbal FROM supplier WHERE s_acctbal > 0)""",
)
def insert(spark, sf_dir):
    name = _copy(spark, sf_dir, "supplier")
    count = insert_rows(
        spark, name,
        "SELECT s_suppkey + 1000000000 AS s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier WHERE s_acctbal > 0",
    )
    return _with_count(spark, name, count)


@query(
    "insert_select_doubling",
    """SELECT *, (SELECT CAST(count(*) AS BIGINT) FROM customer) AS affected
       FROM (SELECT * FROM customer UNION ALL SELECT * FROM customer)""",
)
def double(spark, sf_dir):
    """A table inserted into itself."""
    name = _copy(spark, sf_dir, "customer")
    return _with_count(spark, name, insert_rows(spark, name, f"SELECT * FROM {name}"))


@query(
    "delete_where",
    """SELECT *, (SELECT CAST(count(*) AS BIGINT) FROM customer WHERE nullif(c_nationkey, 3) < 10) AS affected
       FROM customer WHERE NOT coalesce(nullif(c_nationkey, 3) < 10, false)""",
)
def delete(spark, sf_dir):
    """Rows for which the condition is unknown stay."""
    name = _copy(spark, sf_dir, "customer")
    return _with_count(spark, name, delete_where(spark, name, "nullif(c_nationkey, 3) < 10"))


@query(
    "update_where",
    """SELECT c_custkey, c_name, CASE WHEN c_acctbal < 0 THEN c_nationkey * 2 ELSE c_nationkey END AS c_nationkey,
        CASE WHEN c_acctbal < 0 THEN c_acctbal * 2 ELSE c_acctbal END AS c_acctbal, c_mktsegment,
        (SELECT CAST(count(*) AS BIGINT) FROM customer WHERE c_acctbal < 0) AS affected FROM customer""",
)
def update(spark, sf_dir):
    name = _copy(spark, sf_dir, "customer")
    count = update_where(spark, name, {"c_nationkey": "c_nationkey * 2", "c_acctbal": "c_acctbal * 2"}, "c_acctbal < 0")
    return _with_count(spark, name, count)


@query(
    "delete_where_partitioned",
    """SELECT *, (SELECT CAST(count(*) AS BIGINT) FROM orders WHERE o_orderstatus <> 'O' AND (o_custkey % 5 = 0 OR o_orderstatus = 'P')) AS affected,
        'o_orderstatus' AS partitioned_by
       FROM orders WHERE o_orderstatus = 'O' OR NOT (o_custkey % 5 = 0 OR o_orderstatus = 'P')""",
)
def delete_partitioned(spark, sf_dir):
    """One partition loses some rows, one all, one none; the table stays partitioned."""
    name = new_name("orders_partitioned")
    rows = read_table(spark, sf_dir, "orders")
    rows.write.partitionBy("o_orderstatus").option("path", scratch(spark, name)).saveAsTable(name)
    count = delete_where(spark, name, "o_orderstatus <> 'O' AND (o_custkey % 5 = 0 OR o_orderstatus = 'P')")
    by = ",".join(c.name for c in spark.catalog.listColumns(name) if c.isPartition)
    return _with_count(spark, name, count).withColumn("partitioned_by", F.lit(by))


@query(
    "update_where_bucketed",
    """SELECT o_orderkey, o_custkey, o_orderstatus, CASE WHEN o_orderstatus = 'F' THEN o_totalprice * 2 ELSE o_totalprice END AS o_totalprice,
        o_orderdate, o_orderpriority, (SELECT CAST(count(*) AS BIGINT) FROM orders WHERE o_orderstatus = 'F') AS affected, 'o_custkey' AS bucketed_by
       FROM orders""",
)
def update_bucketed(spark, sf_dir):
    name = new_name("orders_bucketed")
    rows = read_table(spark, sf_dir, "orders")
    rows.write.bucketBy(8, "o_custkey").sortBy("o_orderkey").option("path", scratch(spark, name)).saveAsTable(name)
    count = update_where(spark, name, {"o_totalprice": "o_totalprice * 2"}, "o_orderstatus = 'F'")
    by = ",".join(c.name for c in spark.catalog.listColumns(name) if c.isBucket)
    return _with_count(spark, name, count).withColumn("bucketed_by", F.lit(by))


@query(
    "update_where_moves_partitions",
    """SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate, o_orderpriority, CASE WHEN o_custkey % 3 = 0 THEN 'F' WHEN o_orderstatus = 'P' THEN 'F' ELSE o_orderstatus END AS o_orderstatus,
        (SELECT count(*) FROM orders WHERE o_custkey % 3 = 0 OR o_orderstatus = 'P') AS affected FROM orders""",
)
def update_moves(spark, sf_dir):
    """Rows go from one partition to another, and one partition loses all, in a session that overwrites partitions one by one."""
    name, setting = new_name("orders_moving"), "spark.sql.sources.partitionOverwriteMode"
    read_table(spark, sf_dir, "orders").write.partitionBy("o_orderstatus").option("path", scratch(spark, name)).saveAsTable(name)
    before = spark.conf.get(setting)
    spark.conf.set(setting, "dynamic")
    try:
        count = update_where(spark, name, {"o_orderstatus": "'F'"}, "o_custkey % 3 = 0 OR o_orderstatus = 'P'")
    finally:
        spark.conf.set(setting, before)
    return _with_count(spark, name, count)


@query("create_table_as", "SELECT n_name, r_name, n_nationkey FROM nation JOIN region ON n_regionkey = r_regionkey")
def ctas(spark, sf_dir):
    """Created, dropped and created again from a query over two tables."""
    register_views(spark, sf_dir, ["nation", "region"])
    name = new_name("nation_region")
    sql = "SELECT n_name, r_name, n_nationkey FROM nation JOIN region ON n_regionkey = r_regionkey"
    create_table_as(spark, name, sql, scratch(spark, name))
    drop_table(spark, name)
    create_table_as(spark, name, sql, scratch(spark, name + "_again"))
    return spark.table(name)


_ROWS = "l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_t" \
    "ax, l_returnflag, l_linestatus, l_shipdate"


@query("with_row_key", f"SELECT *, CAST(row_number() OVER (ORDER BY {_ROWS}) AS BIGINT) AS row_key FROM lineitem")
def row_key(spark, sf_dir):
    return with_row_key(lineitem(spark, sf_dir), _ROWS.split(", "))
