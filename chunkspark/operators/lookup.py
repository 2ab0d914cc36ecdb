"""Read chunks and rows of a stored result again, by number, position or key.

Requests come as a list of pairs, pushed to the scan as a predicate, or as a
DataFrame of any size, joined. The join is left to the optimizer: it broadcasts
requests it measures as small and shuffles otherwise.
"""

from __future__ import annotations

import math
from collections import defaultdict
from functools import reduce

from pyspark.sql import DataFrame, Row, Window, functions as F

from chunkspark.functions.types import quoted
from chunkspark.operators.chunks import pack_sized
from chunkspark.operators.partition import CHUNK_ID, PARTITION_ID, ROW_BYTES, ROW_POS, PartitionSpec, accounted_bytes

# Pairs that may stand in a predicate; more become a table.
PREDICATE_PAIRS = 1_000
# Splits whose rests one task may gather.
MANY_SPLITS = 128


def _requested(df: DataFrame, requests, column: str) -> DataFrame:
    """Rows whose (partition, column) is requested."""
    if df.isStreaming:
        raise ValueError("a stream is delivered once; store it to look rows up")
    if isinstance(requests, DataFrame):
        return df.join(requests.select(PARTITION_ID, quoted(column)), [PARTITION_ID, column], "left_semi")
    pairs = list(requests)
    if len(pairs) > PREDICATE_PAIRS:
        kinds = f"{PARTITION_ID} long, `{column}` {df.schema[column].dataType.simpleString()}"
        return _requested(df, df.sparkSession.createDataFrame(pairs, kinds), column)
    values = defaultdict(list)
    for partition, value in pairs:
        values[partition].append(value)
    wanted = [(quoted(PARTITION_ID) == p) & quoted(column).isin(v) for p, v in values.items()]
    return df.filter(reduce(lambda a, b: a | b, wanted, F.lit(False)))


def get_chunks(chunks: DataFrame, requests) -> DataFrame:
    """Rows of the requested (partition_id, chunk_id)."""
    return _requested(chunks, requests, CHUNK_ID)


def get_rows_by_position(df: DataFrame, requests) -> DataFrame:
    """Rows at the requested (partition_id, row_pos), counted from zero."""
    return _requested(df, requests, ROW_POS)


def rows_by_key(df: DataFrame, requests, key: str) -> DataFrame:
    """Rows of the requested (partition_id, key)."""
    return _requested(df, requests, key)


def get_row_by_position(df: DataFrame, partition: int, position: int) -> Row:
    return _single(get_rows_by_position(df, [(partition, position)]), partition, position)


def get_row_by_key(df: DataFrame, partition: int, key: str, value) -> Row:
    return _single(rows_by_key(df, [(partition, value)], key), partition, value)


def _single(found: DataFrame, partition: int, value) -> Row:
    row = found.first()
    if row is None:
        raise LookupError(f"no row {value} in partition {partition}")
    return row


def _sized(found: DataFrame) -> DataFrame:
    if ROW_BYTES in found.columns:
        return found
    extra = [c for c in (PARTITION_ID, ROW_POS, CHUNK_ID) if c in found.columns]
    return found.withColumn(ROW_BYTES, accounted_bytes(found.drop(*extra)))


def get_chunks_by_keys(
    df: DataFrame, requests, key: str, chunk_bytes: int, task_bytes: int = PartitionSpec.task_bytes, partitions: int | None = None,
) -> DataFrame:
    """Per partition, all requested rows in key order, packed into chunks as ``pack_chunks`` packs a result: with
    ``chunk_id`` and ``row_pos`` counted in the answer. The first chunk is what ``get_rows_by_keys`` gives; a hot
    partition is packed over many tasks. ``partitions`` is their number in the result; not given, it is taken from
    the rows asked for."""
    found = _sized(_requested(df, requests, key))
    kept = [c for c in found.columns if c not in (ROW_POS, CHUNK_ID)]
    count = partitions or (found.agg(F.max(PARTITION_ID)).first()[0] or 0) + 1
    return pack_sized(found.select(*[quoted(c) for c in kept]), PartitionSpec(count, (), (key,), key, task_bytes), chunk_bytes)


def next_keys(answer: DataFrame, key: str) -> DataFrame:
    """Per chunk of an answer, the last key in it: what ``get_rows_by_keys`` takes as ``after`` to go on."""
    return answer.groupBy(PARTITION_ID, CHUNK_ID).agg(F.max(quoted(key)).alias("after"))


def get_rows_by_keys(df: DataFrame, requests, key: str, chunk_bytes: int, after=None) -> DataFrame:
    """Per partition, the requested rows in key order as far as they fit one chunk.
    ``truncated`` tells that some did not. ``after`` goes on behind a key: one value for all partitions, or a
    DataFrame (partition_id, after) with the last key had of each; partitions it does not name are not gone on with.

    The rows of a partition are first spread over many splits. Within a split only
    rows up to the first that overflows by itself can belong to the answer or end
    it. The rest goes, what is left is gathered in fewer splits, and at last per
    partition, so that no task sees more than a share of what is asked for.
    """
    found = _sized(_requested(df, requests, key))
    if isinstance(after, DataFrame):
        found = found.join(after.select(PARTITION_ID, F.col("after").alias("_after")), PARTITION_ID).filter(quoted(key) > F.col("_after")).drop("_after")
    elif after is not None:
        found = found.filter(quoted(key) > F.lit(after))
    near = found
    for splits in _narrowing(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))):
        split = F.pmod(F.xxhash64(quoted(key)), F.lit(splits))
        so_far = F.sum(ROW_BYTES).over(_upto_here(Window.partitionBy(PARTITION_ID, split).orderBy(quoted(key))))
        near = near.withColumn("_sum", so_far).filter(F.col("_sum") - F.col(ROW_BYTES) <= chunk_bytes).drop("_sum")
    in_order = Window.partitionBy(PARTITION_ID).orderBy(quoted(key))
    first_too_big = (F.row_number().over(in_order) == 1) & (F.col(ROW_BYTES) > chunk_bytes)
    error = F.raise_error(F.format_string(f"a row of %d bytes is larger than a chunk of {chunk_bytes}", F.col(ROW_BYTES)))
    total = F.when(first_too_big, error.cast("long")).otherwise(F.sum(ROW_BYTES).over(_upto_here(in_order)))
    return (
        near.withColumn("_sum", total)
        .withColumn("truncated", F.max("_sum").over(Window.partitionBy(PARTITION_ID)) > chunk_bytes)
        .filter(F.col("_sum") <= chunk_bytes)
        .drop("_sum")
    )


def _narrowing(splits: int) -> list[int]:
    """Numbers of splits, each about the root of the one before."""
    steps = [max(splits, 2)]
    while steps[-1] > MANY_SPLITS:
        steps.append(math.isqrt(steps[-1]))
    return steps


def _upto_here(window):
    return window.rowsBetween(Window.unboundedPreceding, Window.currentRow)
