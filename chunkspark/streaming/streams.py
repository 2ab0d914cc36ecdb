"""Single-pass delivery: each micro-batch is split and packed on its own.

Every batch replaces its own ``batch_id=`` folder, so a batch that is run again
after a failure leaves the same rows, not twice as many. A sink belongs to the query,
that is to the checkpoint, that first delivered to it; another is refused.

The source is read once per batch: a batch to be packed is written aside as it comes, counted while it is written, and packed
from there. The copy goes when the batch is delivered; a batch that is run again replaces what a lost session left of it.

A sink is a folder, or a table of the catalog. A table keeps a ledger in its properties: the query that loads it, the
last batch that is in it whole, and the rows loaded so far. A batch is written to its own partition, then entered; one that is run again
is passed over when it is entered, and replaces its partition when it is not.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass, replace

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from chunkspark.functions.types import check_supported, quoted, row_bytes
from chunkspark.operators.chunks import pack_chunks
from chunkspark.operators.partition import PartitionSpec
from chunkspark.session import shared_dir
from chunkspark.sources.positional import map_positional
from chunkspark.sources.results import quote_name

BATCH_ID = "batch_id"
# Files in a sink with the id of the query that delivers to it, and with the schema of what it delivers; readers pass
# over names that begin so.
OWNER, SCHEMA = "_owner", "_schema"
# Table property: query, last batch entered and rows loaded.
LEDGER = "chunkspark.stream"


def read_stream(
    spark: SparkSession, path: str, schema, pattern: str | None = None, files_per_batch: int = 1_000,
) -> DataFrame:
    """Unbounded Parquet input with a bounded intake per batch."""
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.parquet(path)


def _deliver(
    stream: DataFrame, sink: str, checkpoint: str, work: Callable[[DataFrame, str | None], DataFrame], available_now: bool,
) -> StreamingQuery:
    if not stream.isStreaming:
        raise ValueError("stream_chunks and stream_load take a streaming DataFrame")

    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        _claim(spark, sink)
        aside = f"{shared_dir(spark)}/stream/{_query_id(spark)}-{batch_id}"
        try:
            work(batch, aside).write.mode("overwrite").parquet(f"{sink}/{BATCH_ID}={batch_id}")
        finally:
            files, place = _file(spark, aside)
            files.delete(place, True)

    # What an empty input makes tells the schema before there is a batch.
    shape = work(stream.sparkSession.createDataFrame([], stream.schema), None).schema
    _write_text(stream.sparkSession, f"{sink}/{SCHEMA}", shape.json())
    return _started(stream, run, checkpoint, available_now)


def _started(stream: DataFrame, run, checkpoint: str, available_now: bool) -> StreamingQuery:
    writer = stream.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def _claim(spark: SparkSession, sink: str) -> None:
    """Mark the sink as this query's, by its checkpoint's id. Another query numbers other rows with the same
    batches (its progress may have been lost, or its intake changed), so it may not write here."""
    mine = _query_id(spark)
    owner = _read_text(spark, f"{sink}/{OWNER}")
    if owner is None:
        _write_text(spark, f"{sink}/{OWNER}", mine)
    elif owner != mine:
        raise ValueError(f"{sink} holds the batches of query {owner}; give query {mine} a sink of its own")


def _query_id(spark: SparkSession) -> str:
    return spark.sparkContext.getLocalProperty("sql.streaming.queryId")


def _file(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def _read_text(spark: SparkSession, path: str) -> str | None:
    files, place = _file(spark, path)
    if not files.exists(place):
        return None
    source = files.open(place)
    try:
        return bytes(source.readAllBytes()).decode()
    finally:
        source.close()


def _write_text(spark: SparkSession, path: str, text: str) -> None:
    files, place = _file(spark, path)
    target = files.create(place, True)
    target.write(bytearray(text.encode()))
    target.close()


def _set_aside(batch: DataFrame, path: str) -> tuple[DataFrame, int]:
    """A batch written to ``path`` in one pass, and the bytes of its rows, told by that pass."""
    spark, seen = batch.sparkSession, Observation()
    batch.observe(seen, F.sum(row_bytes(batch.schema)).alias("bytes")).write.mode("overwrite").parquet(path)
    rows = spark.read.schema(batch.schema).parquet(path)
    try:
        return rows, seen.get["bytes"] or 0
    except Py4JJavaError:
        # An input the optimizer finds empty takes the observation away with it.
        return rows, rows.agg(F.sum(row_bytes(rows.schema))).first()[0] or 0


def stream_chunks(
    stream: DataFrame, spec: PartitionSpec, chunk_bytes: int, sink: str, checkpoint: str, available_now: bool = True,
) -> StreamingQuery:
    """Deliver a stream as chunks, numbered by (batch, partition, chunk)."""
    check_supported(stream.schema)

    def work(batch: DataFrame, aside: str | None) -> DataFrame:
        rows, size = (batch, 0) if aside is None else _set_aside(batch, aside)
        return pack_chunks(rows, replace(spec, input_bytes=size), chunk_bytes)

    return _deliver(stream, sink, checkpoint, work, available_now)


def stream_load(
    stream: DataFrame, sink: str, checkpoint: str, mapping: Callable[[DataFrame], DataFrame] | None = None,
    available_now: bool = True,
) -> StreamingQuery:
    """Load a stream; ``mapping`` computes the target columns (see map_positional)."""
    return _deliver(stream, sink, checkpoint, lambda batch, aside: mapping(batch) if mapping else batch, available_now)


def read_delivered(spark: SparkSession, sink: str) -> DataFrame:
    """Everything delivered so far, with its ``batch_id``; no rows of the same columns before the first batch."""
    files, place = _file(spark, f"{sink}/{BATCH_ID}=*")
    shape = _read_text(spark, f"{sink}/{SCHEMA}")
    if shape is None or files.globStatus(place):
        return spark.read.parquet(sink)
    return spark.createDataFrame([], T.StructType.fromJson(json.loads(shape)).add(BATCH_ID, T.IntegerType()))


# ---- tables ------------------------------------------------------------------

@dataclass(frozen=True)
class Ledger:
    """What a table has of a stream: the query, the last batch that is in it whole, and all rows loaded."""

    query: str
    batch: int
    rows: int


def read_ledger(spark: SparkSession, table: str) -> Ledger | None:
    told = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {quote_name(table)}").collect()}
    if LEDGER not in told:
        return None
    query, batch, rows = told[LEDGER].split()
    return Ledger(query, int(batch), int(rows))


def _enter(spark: SparkSession, table: str, ledger: Ledger) -> None:
    text = f"{ledger.query} {ledger.batch} {ledger.rows}"
    spark.sql(f"ALTER TABLE {quote_name(table)} SET TBLPROPERTIES ('{LEDGER}' = '{text}')")


def create_stream_table(spark: SparkSession, name: str, columns: str, path: str | None = None) -> None:
    """An empty table to load a stream into: a DDL column list, defaults included, and ``batch_id`` as partition."""
    place = f"LOCATION '{path}'" if path else ""
    spark.sql(f"CREATE TABLE {quote_name(name)} ({columns}, {BATCH_ID} BIGINT) USING parquet PARTITIONED BY ({BATCH_ID}) {place}")


def stream_load_table(
    stream: DataFrame, table: str, checkpoint: str, columns=None, schema: T.StructType | None = None,
    treat_zero_len_as_null: bool = True, available_now: bool = True,
) -> StreamingQuery:
    """Load a stream into a table of ``create_stream_table`` by named columns; columns not named get the table's default.

    With ``schema`` the stream holds positional records, and the columns of ``schema`` are computed from them as by
    ``load_mapped``. ``read_ledger`` tells the rows loaded.
    """
    if not stream.isStreaming:
        raise ValueError("stream_load_table takes a streaming DataFrame")
    if [c.name for c in stream.sparkSession.catalog.listColumns(quote_name(table)) if c.isPartition] != [BATCH_ID]:
        raise ValueError(f"{table} is not partitioned by {BATCH_ID}; see create_stream_table")

    def run(batch: DataFrame, batch_id: int) -> None:
        rows = batch if schema is None else map_positional(batch, schema, treat_zero_len_as_null)
        try:
            _load_batch(rows, table, batch_id, list(columns or rows.columns))
        finally:
            # Batches run in a session of their own; the one that started the stream has files listed.
            stream.sparkSession.catalog.refreshTable(quote_name(table))

    return _started(stream, run, checkpoint, available_now)


def _load_batch(rows: DataFrame, table: str, batch_id: int, names: list[str]) -> None:
    """One batch into its partition, entered when it is whole there."""
    spark = rows.sparkSession
    mine, ledger = _query_id(spark), read_ledger(spark, table)
    if ledger is None:
        ledger = Ledger(mine, -1, 0)
        _enter(spark, table, ledger)
    if ledger.query != mine:
        raise ValueError(f"{table} is loaded by query {ledger.query}; give query {mine} a table of its own")
    if batch_id <= ledger.batch:
        return
    seen = Observation()
    counted = rows.select(*[quoted(n) for n in names]).observe(seen, F.count(F.lit(1)).alias("n"))
    listed = ", ".join(quote_name(n) for n in names)
    spark.sql(
        f"INSERT OVERWRITE {quote_name(table)} PARTITION ({BATCH_ID} = {int(batch_id)}) ({listed}) SELECT * FROM {{rows}}", rows=counted)
    try:
        loaded = seen.get["n"]
    except Py4JJavaError:
        # An input the optimizer finds empty takes the observation away with it.
        loaded = rows.count()
    _enter(spark, table, Ledger(mine, batch_id, ledger.rows + loaded))
