"""Partition, position, store and report."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from chunkspark.functions.types import row_bytes
from chunkspark.operators.checks import affinity_violations
from chunkspark.operators.chunks import pack_chunks
from chunkspark.operators.partition import PartitionSpec, add_partition_id, largest_partition, partition_result, union_of
from chunkspark.operators.positions import with_row_pos
from chunkspark.operators.reports import node_report, partition_report, route_report
from chunkspark.plans.inputs import (
    LINEITEM_BYTES, LINEITEM_COLUMNS, ORDERS_COLUMNS, ORDERS_NUMBER, ORDERS_PLACED, ORDERS_SPEC,
    lineitem, new_name, orders, scratch,
)
from chunkspark.plans.registry import query
from chunkspark.plans.sql_text import key_text, partition_number, placed
from chunkspark.session import read_table
from chunkspark.sources.results import (
    IN_PLACE, SNAPSHOT, choose_mode, drop_result, materialize_result, read_auto, read_in_place, read_owned, read_partitions,
    snapshot_result,
)

LINEITEM_SPEC = PartitionSpec(64, ("l_orderkey",), ("l_orderkey", "l_linenumber"))
LINEITEM_NUMBER = partition_number([key_text("l_orderkey")], 64)
NULLABLE = PartitionSpec(16, ("status", "o_totalprice", "o_orderdate"), (), "o_orderkey")
NULLABLE_NUMBER = partition_number(
    [key_text("status", "text"), key_text("o_totalprice", "double"), key_text("o_orderdate", "datetime")], 16
)


@query("partition_result", f"SELECT {LINEITEM_COLUMNS}, {LINEITEM_NUMBER} AS partition_id FROM lineitem")
def by_order(spark, sf_dir):
    return partition_result(lineitem(spark, sf_dir), LINEITEM_SPEC)


@query(
    "partition_by_key",
    f"SELECT *, {partition_number([key_text('c_custkey')], 8)} AS partition_id FROM customer",
)
def by_key(spark, sf_dir):
    return partition_result(read_table(spark, sf_dir, "customer"), PartitionSpec(8, key="c_custkey"))


REGION_SPEC = PartitionSpec(3)
REGION_NUMBER = partition_number([key_text(c, k) for c, k in (("n_nationkey", "other"), ("n_name", "text"), ("n_regionkey", "other"))], 3)


@query("partition_without_columns", f"SELECT n_nationkey, n_name, n_regionkey, {REGION_NUMBER} AS partition_id, true AS packed_alike FROM nation")
def without_columns(spark, sf_dir):
    """Numbered by the whole row, and alike when the rows are packed."""
    nation = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    packed = pack_chunks(nation, REGION_SPEC, 4096).select("n_nationkey", F.col("partition_id").alias("p"))
    rows = partition_result(nation, REGION_SPEC).join(packed, "n_nationkey")
    return rows.select(*nation.columns, "partition_id", (F.col("p") == F.col("partition_id")).alias("packed_alike"))


def _small_tasks(rows, spec):
    """The spec with tasks that hold a quarter of the largest partition, so that partitions are split at any scale."""
    return replace(spec, task_bytes=max(1, largest_partition(add_partition_id(rows, spec)) // 4))


@query("snapshot_split", f"SELECT {ORDERS_COLUMNS}, partition_id, row_pos FROM ({ORDERS_PLACED})")
def snapshot_split(spark, sf_dir):
    name, rows = new_name("orders_split"), orders(spark, sf_dir)
    return snapshot_result(spark, name, rows, _small_tasks(rows, ORDERS_SPEC))


@query(
    "positions_split_without_key",
    f"SELECT {LINEITEM_COLUMNS}, partition_id, row_pos FROM ("
    + placed(
        "lineitem", LINEITEM_COLUMNS, LINEITEM_NUMBER,
        "l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, "
        "l_returnflag, l_linestatus, l_shipdate",
    ) + ")",
)
def positions_split_without_key(spark, sf_dir):
    rows = lineitem(spark, sf_dir)
    return with_row_pos(rows, _small_tasks(rows, LINEITEM_SPEC))


@query(
    "read_owned",
    f"SELECT {ORDERS_COLUMNS}, partition_id, row_pos, partition_id % 3 AS worker_id, (partition_id // 3) % 2 AS consumer_id FROM ({ORDERS_PLACED})",
)
def owned(spark, sf_dir):
    """The shares of all consumers together."""
    name = new_name("orders_owned")
    stored = materialize_result(spark, name, orders(spark, sf_dir), ORDERS_SPEC, path=scratch(spark, name))
    shares = [
        read_owned(stored, 3, w, 2, c).withColumns({"worker_id": F.lit(w).cast("long"), "consumer_id": F.lit(c).cast("long")})
        for w in range(3) for c in range(2)
    ]
    return union_of(shares)


@query("read_auto", f"""SELECT o_orderkey, 'snapshot' AS mode, partition_id FROM ({ORDERS_PLACED})
    UNION ALL SELECT o_orderkey, 'stored', partition_id FROM ({ORDERS_PLACED})
    UNION ALL SELECT o_orderkey, 'in_place', NULL FROM orders""")
def auto(spark, sf_dir):
    """Each mode, chosen by the layout of the table and the number of passes."""
    spark.conf.set("spark.sql.sources.bucketing.autoBucketedScan.enabled", "false")
    plain, bucketed, kept = new_name("orders_plain"), new_name("orders_buckets"), new_name("orders_kept")
    orders(spark, sf_dir).write.option("path", scratch(spark, plain)).saveAsTable(plain)
    materialize_result(spark, bucketed, orders(spark, sf_dir), ORDERS_SPEC, path=scratch(spark, bucketed), layout="bucketed")
    parts = []
    for table, many in ((plain, False), (plain, True), (bucketed, False)):
        mode = choose_mode(spark, table, ORDERS_SPEC, many)
        rows = read_auto(spark, f"{kept}_{mode}", table, ORDERS_SPEC, many, scratch(spark, f"{kept}_{mode}"))
        # Buckets are numbered by the engine's own hash.
        number = F.lit(None).cast("long") if mode == IN_PLACE else F.col("partition_id")
        parts.append(rows.select("o_orderkey", F.lit(mode).alias("mode"), number.alias("partition_id")))
    return union_of(parts)


@query(
    "partition_null_keys",
    f"""SELECT o_orderkey, o_custkey, status, o_totalprice, o_orderdate, o_orderpriority, {NULLABLE_NUMBER} AS partition_id
        FROM (SELECT *, nullif(o_orderstatus, 'P') AS status FROM orders)""",
)
def null_keys(spark, sf_dir):
    rows = orders(spark, sf_dir).selectExpr(
        "o_orderkey", "o_custkey", "nullif(o_orderstatus, 'P') AS status", "o_totalprice", "o_orderdate", "o_orderpriority"
    )
    return partition_result(rows, NULLABLE)


@query(
    "partition_few_values",
    f"SELECT {ORDERS_COLUMNS}, partition_id, row_pos FROM ("
    + placed("orders", ORDERS_COLUMNS, partition_number([key_text("o_orderstatus", "text")], 8),
             "o_orderstatus, o_orderkey") + ")",
)
def few_values(spark, sf_dir):
    """Three values only: a partition holds half of the table."""
    spec = PartitionSpec(8, ("o_orderstatus",), ("o_orderstatus",), "o_orderkey")
    return with_row_pos(orders(spark, sf_dir), spec)


@query(
    "row_positions",
    f"SELECT {LINEITEM_COLUMNS}, partition_id, row_pos FROM ("
    + placed(
        "lineitem", LINEITEM_COLUMNS, LINEITEM_NUMBER,
        "l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, "
        "l_returnflag, l_linestatus, l_shipdate",
    ) + ")",
)
def row_positions(spark, sf_dir):
    return with_row_pos(lineitem(spark, sf_dir), LINEITEM_SPEC)


@query("snapshot_result", f"SELECT {ORDERS_COLUMNS}, partition_id, row_pos FROM ({ORDERS_PLACED})")
def snapshot(spark, sf_dir):
    name = new_name("orders_snapshot")
    snapshot_result(spark, name, orders(spark, sf_dir), ORDERS_SPEC)
    return spark.table(name)


@query(
    "drop_result",
    """SELECT o_orderstatus, CAST(count(*) AS BIGINT) AS row_count, false AS listed
       FROM orders GROUP BY o_orderstatus""",
)
def dropped(spark, sf_dir):
    """Rows read through a snapshot stay whole; its name is gone after the drop."""
    name = new_name("orders_dropped")
    snapshot = snapshot_result(spark, name, orders(spark, sf_dir), ORDERS_SPEC)
    drop_result(spark, name, SNAPSHOT)
    listed = spark.catalog.tableExists(name)
    counts = snapshot.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("row_count"))
    return counts.withColumn("listed", F.lit(listed))


@query("materialize_result", f"SELECT {ORDERS_COLUMNS}, partition_id, row_pos FROM ({ORDERS_PLACED})")
def materialize(spark, sf_dir):
    name = new_name("orders_stored")
    return materialize_result(spark, name, orders(spark, sf_dir), ORDERS_SPEC, path=scratch(spark, name))


@query("materialize_bucketed", f"SELECT {LINEITEM_COLUMNS} FROM lineitem")
def materialize_bucketed(spark, sf_dir):
    name = new_name("lineitem_bucketed")
    spec = PartitionSpec(8, ("l_orderkey",), ("l_orderkey", "l_linenumber"))
    return materialize_result(spark, name, lineitem(spark, sf_dir), spec, path=scratch(spark, name), layout="bucketed")


@query("read_partitions", f"SELECT {ORDERS_COLUMNS}, partition_id, row_pos FROM ({ORDERS_PLACED})")
def stored_partitions(spark, sf_dir):
    """Every partition of a stored result, in stored order."""
    name = new_name("orders_read")
    stored = materialize_result(spark, name, orders(spark, sf_dir), ORDERS_SPEC, path=scratch(spark, name))
    return read_partitions(stored, range(ORDERS_SPEC.partitions))


@query("read_in_place", f"SELECT {ORDERS_COLUMNS}, {ORDERS_NUMBER} AS partition_id FROM orders")
def in_place(spark, sf_dir):
    return read_in_place(spark, orders(spark, sf_dir), PartitionSpec(8, ("o_custkey",), (), "o_orderkey"))


@query(
    "partition_arrays",
    f"""SELECT vec_id, label, array_to_string([CAST(floor(CAST(x AS DOUBLE) * 1000000) AS BIGINT) for x in embedding], ',') AS embedding,
        {partition_number([key_text('label')], 8)} AS partition_id FROM embeddings""",
)
def arrays(spark, sf_dir):
    """Columns without an exchange form are carried along; vectors are shown in millionths, alike in every engine."""
    rows = partition_result(read_table(spark, sf_dir, "embeddings"), PartitionSpec(8, ("label",), ("label",), "vec_id"))
    shown = F.expr("array_join(transform(embedding, x -> cast(floor(cast(x AS double) * 1000000) AS string)), ',')")
    return rows.select("vec_id", "label", shown.alias("embedding"), "partition_id")


@query("read_in_place_buckets", f"SELECT {LINEITEM_COLUMNS} FROM lineitem")
def in_place_buckets(spark, sf_dir):
    """Buckets of the source serve as partitions. Their numbers come from the
    engine's own hash, so only the rows are shown."""
    spark.conf.set("spark.sql.sources.bucketing.autoBucketedScan.enabled", "false")
    name = new_name("lineitem_in_place")
    spec = PartitionSpec(8, ("l_orderkey",), ("l_orderkey", "l_linenumber"))
    materialize_result(spark, name, lineitem(spark, sf_dir), spec, path=scratch(spark, name), layout="bucketed")
    rows = read_in_place(spark, f"SELECT * FROM {name}", spec, bucketed_by=["l_orderkey"])
    return rows.drop("partition_id")


@query(
    "partition_report",
    f"""SELECT partition_id, CAST(count(*) AS BIGINT) AS row_count, CAST(sum(bytes) AS BIGINT) AS bytes
        FROM (SELECT {LINEITEM_NUMBER} AS partition_id, {LINEITEM_BYTES} AS bytes FROM lineitem) GROUP BY partition_id""",
)
def loads(spark, sf_dir):
    return partition_report(add_partition_id(lineitem(spark, sf_dir), LINEITEM_SPEC))


_LOADS = f"SELECT {LINEITEM_NUMBER} AS p, {LINEITEM_BYTES} AS bytes FROM lineitem"


@query(
    "route_report",
    f"""SELECT p % 5 AS worker_id, (p // 5) % 3 AS consumer_id, CAST(count(DISTINCT p) AS BIGINT) AS partitions,
               CAST(count(*) AS BIGINT) AS row_count, CAST(sum(bytes) AS BIGINT) AS bytes
        FROM ({_LOADS}) GROUP BY 1, 2""",
)
def routes(spark, sf_dir):
    return route_report(add_partition_id(lineitem(spark, sf_dir), LINEITEM_SPEC), 5, 3)


@query(
    "node_report",
    f"""SELECT p % 7 AS node_id, CAST(count(DISTINCT p) AS BIGINT) AS partitions,
               CAST(count(*) AS BIGINT) AS row_count, CAST(sum(bytes) AS BIGINT) AS bytes
        FROM ({_LOADS}) GROUP BY 1""",
)
def nodes(spark, sf_dir):
    return node_report(add_partition_id(lineitem(spark, sf_dir), LINEITEM_SPEC), 7)


@query(
    "row_bytes",
    """SELECT doc_id, CAST(64 + strlen(text) + strlen(lang)
                           + strlen(coalesce(nullif(source, 'src0'), '')) AS BIGINT) AS row_bytes FROM documents""",
)
def sizes(spark, sf_dir):
    documents = read_table(spark, sf_dir, "documents").withColumn("source", F.expr("nullif(source, 'src0')"))
    return documents.select("doc_id", row_bytes(documents.schema).alias("row_bytes"))


@query(
    "affinity_check",
    f"""SELECT o_custkey, min(partition_id) AS lowest_partition, max(partition_id) AS highest_partition
        FROM (SELECT o_custkey, {ORDERS_NUMBER} AS partition_id FROM orders)
        GROUP BY o_custkey HAVING count(DISTINCT partition_id) > 1""",
)
def affinity(spark, sf_dir):
    return affinity_violations(partition_result(orders(spark, sf_dir), ORDERS_SPEC), ["o_custkey"])


@query(
    "affinity_check_other_key",
    f"""SELECT o_custkey, min(partition_id) AS lowest_partition, max(partition_id) AS highest_partition
        FROM (SELECT o_custkey, {partition_number([key_text('o_orderkey')], 8)} AS partition_id FROM orders)
        GROUP BY o_custkey HAVING count(DISTINCT partition_id) > 1""",
)
def affinity_other_key(spark, sf_dir):
    """Split by another column, most customers are found in several partitions."""
    rows = add_partition_id(orders(spark, sf_dir), PartitionSpec(8, ("o_orderkey",)))
    return affinity_violations(rows, ["o_custkey"])


@query(
    "read_in_place_one",
    "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority, CAST(1 AS BIGINT) AS buckets, true AS asked_for FROM orders",
)
def in_place_one(spark, sf_dir):
    """Every partition of a bucketed table read on its own, from the files of its bucket."""
    spark.conf.set("spark.sql.sources.bucketing.autoBucketedScan.enabled", "false")
    name = new_name("orders_one")
    source = materialize_result(spark, name, orders(spark, sf_dir), ORDERS_SPEC, path=scratch(spark, name), layout="bucketed")
    shares = [
        read_in_place(spark, spark.table(name), ORDERS_SPEC, part, bucketed_by=["o_custkey"]).withColumn("asked_for", F.col("partition_id") == part)
        for part in range(ORDERS_SPEC.partitions)
    ]
    rows = union_of(shares)
    spread = rows.groupBy("o_custkey").agg(F.countDistinct("partition_id").alias("buckets"))
    return rows.join(spread, "o_custkey").select(*source.columns, "buckets", "asked_for")
