"""Chunks: packing, index, passes, lookups."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from chunkspark.operators.checks import compare_passes, order_violations
from chunkspark.operators.chunks import chunk_index, pack_chunks
from chunkspark.operators.lookup import get_chunks, get_chunks_by_keys, get_rows_by_keys, get_rows_by_position, rows_by_key
from chunkspark.operators.partition import PartitionSpec, add_partition_id, largest_partition
from chunkspark.plans.inputs import (
    LINEITEM_BYTES, ORDERS_BYTES, ORDERS_CHUNK, ORDERS_COLUMNS, ORDERS_NUMBER, ORDERS_PACKED, ORDERS_PLACED,
    ORDERS_SPEC, lineitem, new_name, orders, scratch,
)
from chunkspark.plans.registry import query
from chunkspark.plans.sql_text import INDEX, key_text, packed, partition_number, placed
from chunkspark.session import read_table
from chunkspark.sources.results import materialize_result

LINEITEM_SPEC = PartitionSpec(64, ("l_suppkey",), ("l_shipdate", "l_orderkey", "l_linenumber"))
LINEITEM_CHUNK = 8192
LARGE_CHUNK = 1 << 17
_LINEITEM_KEYS = "l_shipdate, l_orderkey, l_linenumber"
_LINEITEM_REST = (
    "l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus"
)


def _orders_chunks(spark, sf_dir, keep=None):
    return pack_chunks(orders(spark, sf_dir), ORDERS_SPEC, ORDERS_CHUNK, keep)


@query("pack_chunks", ORDERS_PACKED + f"SELECT {ORDERS_COLUMNS}, partition_id, row_pos, chunk_id, row_bytes FROM packed")
def pack(spark, sf_dir):
    return _orders_chunks(spark, sf_dir)


@query("chunk_index", ORDERS_PACKED + INDEX)
def index(spark, sf_dir):
    return chunk_index(_orders_chunks(spark, sf_dir, keep=[]))


@query(
    "pack_chunks_without_key",
    packed(
        placed("lineitem", f"{_LINEITEM_KEYS}, {_LINEITEM_REST}", partition_number([key_text("l_suppkey")], 64),
               f"{_LINEITEM_KEYS}, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, "
               "l_returnflag, l_linestatus", LINEITEM_BYTES),
        LINEITEM_CHUNK,
    ) + INDEX,
)
def pack_without_key(spark, sf_dir):
    return chunk_index(pack_chunks(lineitem(spark, sf_dir), LINEITEM_SPEC, LINEITEM_CHUNK, keep=[]))


@query(
    "pack_chunks_fixed_width",
    "SELECT *, row_pos // (4096 // 40) AS chunk_id FROM ("
    + placed("orders", "o_orderkey, o_custkey, o_totalprice, o_orderdate, CAST(o_orderdate AS DATE) AS o_day",
             ORDERS_NUMBER, "o_custkey, o_orderkey", "40") + ")",
)
def pack_fixed_width(spark, sf_dir):
    rows = orders(spark, sf_dir).selectExpr(
        "o_orderkey", "o_custkey", "o_totalprice", "o_orderdate", "CAST(o_orderdate AS DATE) AS o_day"
    )
    return pack_chunks(rows, ORDERS_SPEC, ORDERS_CHUNK)


@query(
    "pack_chunks_long_text",
    packed(
        placed("documents", "doc_id, lang, source", partition_number([key_text("lang", "text")], 4),
               "source, doc_id", "64 + strlen(text) + strlen(lang) + strlen(source)"),
        1 << 18,
    ) + "SELECT doc_id, lang, partition_id, row_pos, chunk_id, row_bytes FROM packed",
)
def pack_long_text(spark, sf_dir):
    spec = PartitionSpec(4, ("lang",), ("source", "doc_id"), "doc_id")
    return pack_chunks(read_table(spark, sf_dir, "documents"), spec, 1 << 18, keep=["doc_id", "lang"])


@query(
    "pack_chunks_conversations",
    packed(
        placed("conversations", "conv_id, turn, role", partition_number([key_text("conv_id")], 16), "conv_id, turn",
               "48 + strlen(role) + strlen(text)"),
        1 << 16,
    ) + "SELECT conv_id, turn, role, partition_id, row_pos, chunk_id, row_bytes FROM packed",
)
def pack_conversations(spark, sf_dir):
    spec = PartitionSpec(16, ("conv_id",), ("conv_id",), "turn")
    return pack_chunks(read_table(spark, sf_dir, "conversations"), spec, 1 << 16, keep=["conv_id", "turn", "role"])


@query(
    "pack_chunks_split_partition",
    packed(
        placed("orders", "o_orderkey, o_orderstatus, o_orderdate",
               partition_number([key_text("o_orderstatus", "text")], 8), "o_orderdate, o_orderkey", ORDERS_BYTES),
        ORDERS_CHUNK,
    ) + "SELECT o_orderkey, partition_id, row_pos, chunk_id, row_bytes FROM packed",
)
def pack_split_partition(spark, sf_dir):
    """Half of the rows share a key. Also on small tables the largest partition is
    spread over several tasks."""
    rows = orders(spark, sf_dir)
    spec = PartitionSpec(8, ("o_orderstatus",), ("o_orderdate",), "o_orderkey")
    largest = largest_partition(add_partition_id(rows, spec))
    spec = replace(spec, task_bytes=min(spec.task_bytes, largest // 4))
    return pack_chunks(rows, spec, ORDERS_CHUNK, keep=["o_orderkey"])


@query(
    "pack_chunks_large_chunk",
    packed(
        placed("orders", ORDERS_COLUMNS, partition_number([key_text("o_orderstatus", "text")], 8),
               "o_orderdate, o_orderkey", ORDERS_BYTES),
        LARGE_CHUNK,
    ) + f"SELECT {ORDERS_COLUMNS}, partition_id, row_pos, chunk_id, row_bytes FROM packed",
)
def pack_large_chunk(spark, sf_dir):
    """Chunks that span about four blocks each, whatever the size of the table."""
    spec = PartitionSpec(8, ("o_orderstatus",), ("o_orderdate",), "o_orderkey", LARGE_CHUNK // 2)
    return pack_chunks(orders(spark, sf_dir), spec, LARGE_CHUNK)


def _stored_chunks(spark, sf_dir):
    name = new_name("orders_chunks")
    return materialize_result(
        spark, name, orders(spark, sf_dir), ORDERS_SPEC, ORDERS_CHUNK, path=scratch(spark, name)
    )


@query(
    "get_chunks",
    ORDERS_PACKED + """, wanted AS (SELECT partition_id, max(chunk_id) AS chunk_id FROM packed GROUP BY partition_id)
SELECT o_orderkey, o_custkey, partition_id, chunk_id, row_pos
FROM packed JOIN wanted USING (partition_id, chunk_id)""",
)
def chunks_again(spark, sf_dir):
    """Last chunk of every partition, from the stored chunks."""
    chunks = _stored_chunks(spark, sf_dir)
    wanted = chunks.groupBy("partition_id").agg(F.max("chunk_id").alias("chunk_id"))
    return get_chunks(chunks, wanted).select("o_orderkey", "o_custkey", "partition_id", "chunk_id", "row_pos")


@query(
    "get_rows_by_position",
    ORDERS_PACKED + """, wanted AS (SELECT partition_id, min(row_pos) AS row_pos FROM packed GROUP BY partition_id, chunk_id)
SELECT o_orderkey, o_custkey, o_totalprice, partition_id, chunk_id, row_pos
FROM packed JOIN wanted USING (partition_id, row_pos)""",
)
def rows_at_positions(spark, sf_dir):
    """First row of every chunk."""
    chunks = _stored_chunks(spark, sf_dir)
    wanted = chunk_index(chunks).select("partition_id", F.col("first_row_pos").alias("row_pos"))
    found = get_rows_by_position(chunks, wanted)
    return found.select("o_orderkey", "o_custkey", "o_totalprice", "partition_id", "chunk_id", "row_pos")


@query(
    "get_row_by_key",
    f"""WITH placed AS ({ORDERS_PLACED}), wanted AS (SELECT o_custkey, max(o_orderkey) AS o_orderkey FROM orders GROUP BY o_custkey)
SELECT p.o_orderkey, p.o_custkey, p.o_totalprice, p.partition_id
FROM placed p JOIN wanted w ON w.o_orderkey = p.o_orderkey""",
)
def rows_at_keys(spark, sf_dir):
    """Latest order of every customer, asked for by partition and key."""
    rows = add_partition_id(orders(spark, sf_dir), ORDERS_SPEC)
    wanted = rows.groupBy("partition_id", "o_custkey").agg(F.max("o_orderkey").alias("o_orderkey"))
    found = rows_by_key(rows, wanted.drop("o_custkey"), "o_orderkey")
    return found.select("o_orderkey", "o_custkey", "o_totalprice", "partition_id")


@query(
    "get_rows_by_keys",
    f"""WITH placed AS ({ORDERS_PLACED}), wanted AS (SELECT max(o_orderkey) AS o_orderkey FROM orders GROUP BY o_custkey),
summed AS (SELECT p.*, sum(p.row_bytes) OVER (PARTITION BY p.partition_id ORDER BY p.o_orderkey) AS upto,
                  sum(p.row_bytes) OVER (PARTITION BY p.partition_id) AS asked
           FROM placed p JOIN wanted w ON w.o_orderkey = p.o_orderkey)
SELECT o_orderkey, o_custkey, partition_id, asked > {ORDERS_CHUNK} AS truncated FROM summed WHERE upto <= {ORDERS_CHUNK}""",
)
def rows_fitting_a_chunk(spark, sf_dir):
    rows = add_partition_id(orders(spark, sf_dir), ORDERS_SPEC)
    wanted = rows.groupBy("partition_id", "o_custkey").agg(F.max("o_orderkey").alias("o_orderkey"))
    found = get_rows_by_keys(rows, wanted.drop("o_custkey"), "o_orderkey", ORDERS_CHUNK)
    return found.select("o_orderkey", "o_custkey", "partition_id", "truncated")


_ANSWER = packed(
    f"""SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority, partition_id, row_bytes,
    row_number() OVER (PARTITION BY partition_id ORDER BY o_orderkey) - 1 AS row_pos FROM ({ORDERS_PLACED}) p
    JOIN (SELECT max(o_orderkey) AS o_orderkey FROM orders GROUP BY o_custkey) w USING (o_orderkey)""", ORDERS_CHUNK)


@query(
    "get_rows_by_keys_all",
    _ANSWER + "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority, partition_id, row_bytes, "
    "CAST(row_pos AS BIGINT) AS row_pos, chunk_id FROM packed",
)
def all_rows_at_keys(spark, sf_dir):
    """The whole answer, chunk by chunk."""
    rows = add_partition_id(orders(spark, sf_dir), ORDERS_SPEC)
    wanted = rows.groupBy("partition_id", "o_custkey").agg(F.max("o_orderkey").alias("o_orderkey"))
    return get_chunks_by_keys(rows, wanted.drop("o_custkey"), "o_orderkey", ORDERS_CHUNK, partitions=ORDERS_SPEC.partitions)


@query(
    "second_pass_check",
    ORDERS_PACKED + f""", idx AS ({INDEX})
SELECT (SELECT CAST(count(*) AS BIGINT) FROM (FROM idx EXCEPT ALL FROM idx)) AS only_in_first,
       (SELECT CAST(count(*) AS BIGINT) FROM (FROM idx EXCEPT ALL FROM idx)) AS only_in_second""",
)
def second_pass(spark, sf_dir):
    """Chunks of a stored result against chunks packed again from the source."""
    stored = chunk_index(_stored_chunks(spark, sf_dir))
    return compare_passes(stored, chunk_index(_orders_chunks(spark, sf_dir, keep=[])))


@query(
    "second_pass_difference",
    ORDERS_PACKED + f""", idx AS ({INDEX}), other AS (
  SELECT * FROM idx WHERE chunk_id % 3 <> 0 UNION ALL SELECT * FROM idx WHERE chunk_id % 2 = 0)
SELECT (SELECT CAST(count(*) AS BIGINT) FROM (FROM idx EXCEPT ALL FROM other)) AS only_in_first,
       (SELECT CAST(count(*) AS BIGINT) FROM (FROM other EXCEPT ALL FROM idx)) AS only_in_second""",
)
def second_pass_changed(spark, sf_dir):
    """A second pass that lost some chunks and got some twice."""
    first = chunk_index(_stored_chunks(spark, sf_dir))
    second = chunk_index(_orders_chunks(spark, sf_dir, keep=[]))
    return compare_passes(first, second.filter("chunk_id % 3 <> 0").unionByName(second.filter("chunk_id % 2 = 0")))


_PREVIOUS = "lag({c}) OVER (PARTITION BY partition_id, chunk_id ORDER BY row_pos)"


@query(
    "order_check",
    ORDERS_PACKED + f""", ahead AS (
  SELECT partition_id, chunk_id, row_pos, o_custkey, o_orderkey,
         {_PREVIOUS.format(c='o_custkey')} AS c, {_PREVIOUS.format(c='o_orderkey')} AS o FROM packed)
SELECT partition_id, chunk_id, row_pos FROM ahead WHERE c > o_custkey OR (c = o_custkey AND o > o_orderkey)""",
)
def ordered(spark, sf_dir):
    return order_violations(_orders_chunks(spark, sf_dir, keep=["o_custkey", "o_orderkey"]), ["o_custkey", "o_orderkey"])


@query(
    "order_check_other_order",
    ORDERS_PACKED + f""", ahead AS (
  SELECT partition_id, chunk_id, row_pos, o_orderdate, {_PREVIOUS.format(c='o_orderdate')} AS d FROM packed)
SELECT partition_id, chunk_id, row_pos FROM ahead WHERE d > o_orderdate""",
)
def ordered_otherwise(spark, sf_dir):
    """Chunks sorted by customer are not sorted by date."""
    return order_violations(_orders_chunks(spark, sf_dir, keep=["o_orderdate"]), ["o_orderdate"])
