"""Streams delivered as chunks or loaded."""

from __future__ import annotations

from pyspark.sql import functions as F

from chunkspark.functions.codec import encode_table
from chunkspark.operators.partition import PartitionSpec
from chunkspark.plans.inputs import new_name, scratch
from chunkspark.plans.registry import query
from chunkspark.plans.sql_text import key_text, micros, packed, partition_number, placed
from chunkspark.session import read_table
from chunkspark.sources.positional import export_positional
from chunkspark.streaming.streams import (
    create_stream_table, read_delivered, read_ledger, read_stream, stream_chunks, stream_load, stream_load_table,
)

EVENTS_SPEC = PartitionSpec(16, ("user_id",), ("ts",), "event_id")
EVENTS_CHUNK = 4096


def _events(spark, sf_dir):
    schema = read_table(spark, sf_dir, "events").schema
    return read_stream(spark, sf_dir, schema, "events.parquet")


def _places(spark, stem):
    name = new_name(stem)
    return scratch(spark, name), scratch(spark, name + "_progress")


@query(
    "stream_chunks",
    packed(
        placed("events", "event_id, user_id, ts", partition_number([key_text("user_id")], 16), "ts, event_id",
               "64 + strlen(event_type) + strlen(props)"),
        EVENTS_CHUNK,
    ) + "SELECT event_id, user_id, ts, partition_id, row_pos, chunk_id, CAST(0 AS BIGINT) AS batch_id FROM packed",
)
def chunks(spark, sf_dir):
    """The table arrives as one file, hence as one batch."""
    sink, progress = _places(spark, "events_chunks")
    stream_chunks(_events(spark, sf_dir), EVENTS_SPEC, EVENTS_CHUNK, sink, progress).awaitTermination()
    delivered = read_delivered(spark, sink)
    return delivered.select(
        "event_id", "user_id", "ts", "partition_id", "row_pos", "chunk_id", delivered.batch_id.cast("long").alias("batch_id")
    )


@query(
    "stream_load",
    f"""SELECT event_id, {micros('ts')} AS ts, user_id, encode(event_type) AS event_type, value, encode(props) AS props FROM events""",
)
def load(spark, sf_dir):
    """Loaded in exchange form by the mapping of each batch."""
    sink, progress = _places(spark, "events_loaded")
    stream_load(_events(spark, sf_dir), sink, progress, encode_table).awaitTermination()
    return read_delivered(spark, sink).drop("batch_id")


@query(
    "stream_load_table",
    """SELECT event_id, ts, user_id, event_type, value, CASE WHEN user_id % 3 = 0 THEN NULL ELSE props END AS props,
        'streamed' AS note, CAST(event_id % 4 AS BIGINT) AS batch_id, (SELECT count(*) FROM events) AS loaded FROM events""",
)
def load_table(spark, sf_dir):
    """Positional records, one file a batch, mapped into a table that has one column more."""
    events = read_table(spark, sf_dir, "events").withColumn("props", F.expr("if(user_id % 3 = 0, '', props)"))
    records, progress = _places(spark, "event_records")
    for part in range(4):
        export_positional(events.filter(F.col("event_id") % 4 == part).coalesce(1), records, fmt="parquet", mode="append")
    name = new_name("events_streamed")
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in events.schema)
    create_stream_table(spark, name, f"{columns}, note STRING DEFAULT 'streamed'", scratch(spark, name))
    arriving = read_stream(spark, records, spark.read.parquet(records).schema, "*.parquet", files_per_batch=1)
    stream_load_table(arriving, name, progress, schema=events.schema).awaitTermination()
    return spark.table(name).withColumn("loaded", F.lit(read_ledger(spark, name).rows).cast("long"))
