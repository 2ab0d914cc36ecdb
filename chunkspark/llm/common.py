"""Helpers the corpus operators share: narrow inputs, shared tables, bounded slices."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chunkspark.session import read_table, shared_dir

#: Bytes of text that one round of array work holds.
SLICE_BYTES = 1 << 18


#: Bytes that one Arrow batch between Spark and Python holds, about; long texts make batches of few rows.
BATCH_BYTES = 4 << 20


def bounded_batches(spark: SparkSession) -> None:
    """Bound the session's Arrow batches by bytes, so that a task's memory does not depend on text lengths."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    bounded_batches(spark)
    return read_table(spark, sf_dir, "documents")


def stored(df: DataFrame, stem: str) -> DataFrame:
    """Write to the folder all executors share and read back: short lineage, safe from lost executors."""
    path = f"{shared_dir(df.sparkSession)}/llm/{stem}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def narrowed(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Two columns, ``doc_id`` long and ``text`` bytes (null: empty), whatever else the input has."""
    bounded_batches(docs.sparkSession)
    return docs.select(
        F.col(f"`{doc_id}`").cast("long").alias("doc_id"),
        F.coalesce(F.col(f"`{text}`").cast("binary"), F.lit(b"")).alias("text"),
    )


def slices(batch: pa.RecordBatch, column: str = "text", limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of a batch that hold about ``limit`` bytes each, one row at least."""
    array = batch.column(column)
    if not len(array):
        return
    sizes = np.diff(offsets(array))
    start, held = 0, 0
    for row, size in enumerate(sizes):
        if held and held + size > limit:
            yield start, row
            start, held = row, 0
        held += int(size)
    yield start, len(sizes)


def offsets(array: pa.Array) -> np.ndarray:
    kind = np.int64 if pa.types.is_large_binary(array.type) or pa.types.is_large_string(array.type) else np.int32
    return np.frombuffer(array.buffers()[1], dtype=kind)[array.offset: array.offset + len(array) + 1].astype(np.int64)


def flat_bytes(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a binary array without nulls, and where each value starts and ends in them."""
    bounds = offsets(array)
    data = array.buffers()[2]
    if data is None or not len(array):
        return np.zeros(0, dtype=np.uint8), bounds - (bounds[0] if len(bounds) else 0)
    return np.frombuffer(data, dtype=np.uint8)[bounds[0]: bounds[-1]], bounds - bounds[0]


def table(schema: pa.Schema, *columns) -> pa.RecordBatch:
    return pa.record_batch([pa.array(c, type=f.type) if not isinstance(c, pa.Array) else c for c, f in zip(columns, schema)], schema=schema)
