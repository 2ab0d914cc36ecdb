"""Exchange values and files."""

from __future__ import annotations

from pyspark.sql import functions as F, types as T

from chunkspark.functions.codec import decode_table, encode_table, micros_to_time_text, time_text_to_micros
from chunkspark.functions.types import binary_field, char_field, time_field, with_fields
from chunkspark.plans.inputs import LINEITEM_COLUMNS, lineitem, new_name, orders, scratch
from chunkspark.plans.registry import query
from chunkspark.plans.sql_text import days, micros
from chunkspark.session import read_table
from chunkspark.sources.positional import export_positional, import_positional, map_positional
from chunkspark.sources.tsv import export_tsv, import_tsv

INT64_MIN = "CAST(-9223372036854775808 AS BIGINT)"
INT32_MIN = "CAST(-2147483648 AS INTEGER)"

ORDERS_WITH_NULLS = """o_orderkey, nullif(o_custkey, 7) AS o_custkey, nullif(o_orderstatus, 'P') AS o_orderstatus,
    CASE WHEN o_orderstatus = 'O' THEN NULL ELSE o_totalprice END AS o_totalprice,
    CASE WHEN o_orderpriority LIKE '1%' THEN NULL ELSE o_orderdate END AS o_orderdate,
    CASE WHEN o_orderpriority LIKE '2%' THEN NULL ELSE CAST(o_orderdate AS DATE) END AS o_day, o_orderpriority"""


def _orders_with_nulls(spark, sf_dir):
    spark_sql = ORDERS_WITH_NULLS.replace("\n", " ")
    orders(spark, sf_dir).createOrReplaceTempView("orders")
    return spark.sql(f"SELECT {spark_sql} FROM orders")


@query(
    "encode_table",
    f"""SELECT o_orderkey, coalesce(o_custkey, {INT64_MIN}) AS o_custkey,
        coalesce(hex(o_orderstatus), '') AS o_orderstatus, o_totalprice IS NULL AS price_is_null,
        coalesce(o_totalprice, -1.0) AS o_totalprice, coalesce({micros('o_orderdate')}, {INT64_MIN}) AS o_orderdate,
        coalesce({days('o_day')}, {INT32_MIN}) AS o_day, hex(o_orderpriority) AS o_orderpriority FROM (SELECT {ORDERS_WITH_NULLS} FROM orders)""",
)
def encode(spark, sf_dir):
    """NaN and bytes are shown in a form every engine prints alike."""
    encoded = encode_table(_orders_with_nulls(spark, sf_dir))
    return encoded.select(
        "o_orderkey", "o_custkey", F.hex("o_orderstatus").alias("o_orderstatus"),
        F.isnan("o_totalprice").alias("price_is_null"), F.nanvl("o_totalprice", F.lit(-1.0)).alias("o_totalprice"),
        "o_orderdate", "o_day", F.hex("o_orderpriority").alias("o_orderpriority"),
    )


@query("decode_table", f"SELECT {ORDERS_WITH_NULLS} FROM orders")
def decode(spark, sf_dir):
    """Encoded and decoded again."""
    rows = _orders_with_nulls(spark, sf_dir)
    return decode_table(encode_table(rows), rows.schema)


FIXED_FIELDS = (char_field("segment", 10), char_field("latin", 11, "latin1"), binary_field("name", 20))


def _customer_fixed(spark, sf_dir):
    rows = read_table(spark, sf_dir, "customer").select(
        "c_custkey", "c_nationkey", "c_acctbal",
        F.expr("nullif(c_mktsegment, 'MACHINERY')").alias("segment"),
        F.col("c_mktsegment").alias("latin"),
        F.col("c_name").cast("binary").alias("name"),
    )
    return with_fields(rows, *FIXED_FIELDS)


@query(
    "encode_fixed_width",
    """SELECT c_custkey, c_nationkey, c_acctbal,
        CASE WHEN c_mktsegment = 'MACHINERY' THEN repeat('00', 40)
             ELSE hex(c_mktsegment) || repeat('20', CAST(40 - strlen(c_mktsegment) AS BIGINT)) END AS segment,
        hex(c_mktsegment) || repeat('20', CAST(40 - strlen(c_mktsegment) AS BIGINT)) AS latin,
        hex(c_name) || repeat('00', CAST(24 - strlen(c_name) AS BIGINT)) AS name FROM customer""",
)
def encode_fixed(spark, sf_dir):
    encoded = encode_table(_customer_fixed(spark, sf_dir))
    return encoded.select("c_custkey", "c_nationkey", "c_acctbal", *[F.hex(c).alias(c) for c in ("segment", "latin", "name")])


@query(
    "decode_fixed_width",
    """SELECT c_custkey, c_nationkey, c_acctbal, nullif(c_mktsegment, 'MACHINERY') AS segment, c_mktsegment AS latin,
        hex(c_name) || repeat('00', CAST(20 - strlen(c_name) AS BIGINT)) AS name FROM customer""",
)
def decode_fixed(spark, sf_dir):
    """Text loses its padding, binary keeps its declared width."""
    rows = _customer_fixed(spark, sf_dir)
    return decode_table(encode_table(rows), rows.schema).withColumn("name", F.hex("name"))


_SIGNED = "(CASE WHEN user_id % 2 = 0 THEN 1 ELSE -1 END) * ((epoch_us(ts) + 315619200000000) % 200000000000)"


def _event_times(spark, sf_dir):
    """Signed times up to 55 hours."""
    encoded = encode_table(read_table(spark, sf_dir, "events").select("event_id", "user_id", "ts"))
    sign = F.when(F.col("user_id") % 2 == 0, F.lit(1)).otherwise(F.lit(-1))
    return encoded.select("event_id", (sign * F.pmod("ts", F.lit(200_000_000_000).cast("long"))).alias("micros"))


@query(
    "time_text",
    f"""SELECT event_id, micros, micros AS parsed,
        printf('%s%d:%d:%d.%06d', CASE WHEN micros < 0 THEN '-' ELSE '' END, abs(micros) // 3600000000,
               (abs(micros) // 60000000) % 60, (abs(micros) // 1000000) % 60, abs(micros) % 1000000) AS shown
        FROM (SELECT event_id, {_SIGNED} AS micros FROM events)""",
)
def time_text(spark, sf_dir):
    shown = _event_times(spark, sf_dir).withColumn("shown", micros_to_time_text(F.col("micros")))
    return shown.withColumn("parsed", time_text_to_micros(F.col("shown")))


def _through_tsv(spark, rows, stem):
    path = scratch(spark, new_name(stem))
    export_tsv(rows, path)
    return import_tsv(spark, path, rows.schema)


@query(
    "tsv_round_trip_text",
    "SELECT doc_id, nullif(text, '') AS text, nullif(lang, 'de') AS lang, source, n_chars FROM documents",
)
def tsv_text(spark, sf_dir):
    rows = read_table(spark, sf_dir, "documents").withColumn("lang", F.expr("nullif(lang, 'de')"))
    return _through_tsv(spark, rows, "documents_tsv")


_MARKS = """CASE {key} % 6 WHEN 0 THEN {n} WHEN 1 THEN {b} || {n} WHEN 2 THEN {q} || {n} || {t} WHEN 3 THEN NULL
    WHEN 4 THEN text || {l} || {n} || {b} ELSE text || {l} || {q} || {t} || text END"""


@query(
    "tsv_round_trip_null_mark",
    "SELECT doc_id, nullif(" + _MARKS.format(key="doc_id", n="'\\N'", b="'\\'", q="'\"'", t="chr(9)", l="chr(10)")
    + ", '') AS text, lang, source, n_chars FROM documents",
)
def tsv_null_mark(spark, sf_dir):
    """Texts that read like NULL, and texts with escapes, quotes, tabs and newlines. Every task writes its own file, and many tasks read one."""
    marks = _MARKS.format(key="doc_id", n=r"'\\N'", b=r"'\\'", q="'\"'", t="chr(9)", l="chr(10)").replace("\n", " ")
    rows = read_table(spark, sf_dir, "documents").withColumn("text", F.expr(marks))
    return _through_tsv(spark, rows, "marked_tsv")


@query("tsv_round_trip_pages", "SELECT page_id, url, nullif(html, '') AS html FROM pages")
def tsv_pages(spark, sf_dir):
    return _through_tsv(spark, read_table(spark, sf_dir, "pages"), "pages_tsv")


@query("tsv_round_trip_values", f"SELECT {LINEITEM_COLUMNS} FROM lineitem")
def tsv_values(spark, sf_dir):
    return _through_tsv(spark, lineitem(spark, sf_dir), "lineitem_tsv")


@query(
    "tsv_round_trip_times",
    f"""SELECT event_id, {_SIGNED} AS micros, ts, CAST(ts AS DATE) AS day, user_id, event_type, value,
        nullif(props, '') AS props FROM events""",
)
def tsv_times(spark, sf_dir):
    rows = read_table(spark, sf_dir, "events").selectExpr(
        "event_id", "ts", "CAST(ts AS DATE) AS day", "user_id", "event_type", "value", "props"
    )
    rows = rows.join(_event_times(spark, sf_dir), "event_id")
    return _through_tsv(spark, with_fields(rows, time_field("micros")), "events_tsv")


@query("positional_round_trip", f"SELECT {ORDERS_WITH_NULLS} FROM orders")
def positional(spark, sf_dir):
    rows = _orders_with_nulls(spark, sf_dir)
    path = scratch(spark, new_name("orders_positional"))
    export_positional(rows, path)
    return map_positional(import_positional(spark, path, rows.schema), rows.schema)


@query(
    "positional_records",
    f"""SELECT p_partkey AS col_0, hex(p_name) AS col_1, hex(p_brand) AS col_2, coalesce(hex(p_type), '') AS col_3,
        coalesce(nullif(p_size, 1), {INT32_MIN}) AS col_4, p_retailprice AS col_5 FROM part""",
)
def positional_records(spark, sf_dir):
    rows = read_table(spark, sf_dir, "part").withColumn("p_size", F.expr("nullif(p_size, 1)"))
    path = scratch(spark, new_name("part_positional"))
    export_positional(rows, path)
    records = import_positional(spark, path, rows.schema)
    hexed = [F.hex(f.name).alias(f.name) if isinstance(f.dataType, T.BinaryType) else F.col(f.name) for f in records.schema]
    return records.select(*hexed)
