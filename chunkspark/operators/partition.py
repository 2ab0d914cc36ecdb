"""Split a result into partitions: number them, place them, order them.

A partition is a number carried by the rows: rows with equal partition columns
have equal numbers. Which task works on a row is a separate question. A partition
that fits ``task_bytes`` is held by one task. The rows of larger ones, which hot
keys make, are range-placed by (partition, sort key), so that a large partition
runs over as many tasks as it needs, each with one contiguous stretch of its order.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, functions as F, types as T

from chunkspark.functions.hashing import partition_number
from chunkspark.functions.types import held_bytes, quoted, row_bytes
from chunkspark.session import checkpointed, shared_dir

PARTITION_ID = "partition_id"
ROW_POS = "row_pos"
CHUNK_ID = "chunk_id"
ROW_BYTES = "row_bytes"
ROW_NO = "_row_no"

# Columns the operators of this package add to a result; an input may not bring its own.
RESERVED = (PARTITION_ID, ROW_POS, CHUNK_ID, ROW_BYTES, "_at", "_block", "_row_no", "_span", "_chunk", "_used", "_pos")
# Large partitions that may be told from the others by a list.
LISTED_PARTITIONS = 1_000
# Chunk bytes below which starting a task costs more than its rows; where blocks may be grouped, smaller ones share a task.
GROUPED_BYTES = 64 << 20


@dataclass(frozen=True)
class PartitionSpec:
    """How to split a result.

    partitions   number of partitions
    by           columns whose equal values stay in one partition; empty = any split
    order        order of the rows inside a partition
    key          column that makes the order total; without one all columns do
    task_bytes   chunk bytes of rows one task may take; packing lets a task take several such shares, one after the
                 other, where they are small (GROUPED_BYTES)
    input_bytes  chunk bytes of all rows where they are known, so that the input need not be read for them
    """

    partitions: int
    by: tuple[str, ...] = ()
    order: tuple[str, ...] = ()
    key: str | None = None
    task_bytes: int = 512 << 20
    input_bytes: int | None = None

    def __post_init__(self):
        if self.partitions <= 0:
            raise ValueError("partitions must be positive")
        if self.task_bytes <= 0:
            raise ValueError("task_bytes must be positive")


@dataclass(frozen=True)
class Placed:
    """Rows of some partitions, placed and sorted; ``split`` when a partition may
    span tasks. A task holds one block, or several of ``block_rows`` rows each;
    ``blocks`` is the most there are."""

    df: DataFrame
    tasks: int
    split: bool
    blocks: int
    block_rows: int | None = None


def sort_key(order, key: str | None = None, columns=()) -> list[str]:
    """Order columns, then the key unless it is among them. Without a key every
    remaining column breaks ties, so the order is total up to equal rows."""
    rest = [key] if key is not None else list(columns)
    return list(dict.fromkeys([*order, *rest]))


def spec_sort_key(df: DataFrame, spec: PartitionSpec) -> list[str]:
    return sort_key(spec.order, spec.key, [c for c in df.columns if c not in (PARTITION_ID, ROW_BYTES)])


def _has_map(kind: T.DataType) -> bool:
    if isinstance(kind, T.StructType):
        return any(_has_map(f.dataType) for f in kind)
    return isinstance(kind, T.MapType) or isinstance(kind, T.ArrayType) and _has_map(kind.elementType)


def sort_columns(df: DataFrame, names) -> list:
    """Columns to sort by; maps have no order of their own, so they go by their text."""
    return [F.to_json(F.struct(quoted(n))) if _has_map(df.schema[n].dataType) else quoted(n) for n in names]


def add_partition_id(df: DataFrame, spec: PartitionSpec) -> DataFrame:
    """Number rows by the hash of ``by``, else of the key, else of the whole row."""
    names = spec.by or ((spec.key,) if spec.key else tuple(df.columns))
    fields = [df.schema[name] for name in names]
    return df.withColumn(PARTITION_ID, partition_number(fields, spec.partitions))


def accounted_bytes(df: DataFrame):
    """Row bytes; columns that have no exchange form count by what they hold."""
    if ROW_BYTES in df.columns:
        return quoted(ROW_BYTES)
    nested = [f for f in df.schema if isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType))]
    flat = T.StructType([f for f in df.schema if f not in nested])
    return reduce(lambda a, b: a + b, [held_bytes(quoted(f.name), f.dataType) for f in nested], row_bytes(flat))


def _estimated_bytes(df: DataFrame) -> int:
    """The optimizer's guess, good enough to choose how to measure."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def _fits(df: DataFrame, limit: int) -> bool:
    """Whether all rows together stay within ``limit``. Only an input estimated to do
    so is summed, which is cheaper than totals per partition: nothing is hashed."""
    return _estimated_bytes(df) <= limit and total_bytes(df) <= limit


def total_bytes(df: DataFrame) -> int:
    return df.agg(F.sum(accounted_bytes(df))).first()[0] or 0


def largest_partition(df: DataFrame) -> int:
    """Bytes of the largest partition, from per-partition totals."""
    totals = df.groupBy(PARTITION_ID).agg(F.sum(accounted_bytes(df)).alias("bytes"))
    return totals.agg(F.max("bytes")).first()[0] or 0


def partitions_fit(df: DataFrame, limit: int) -> bool:
    """Whether no partition is larger than ``limit``."""
    return _fits(df, limit) or largest_partition(df) <= limit


def _sizes(df: DataFrame, spec: PartitionSpec) -> tuple[list[int] | None, int, int]:
    """Partitions larger than a task, their bytes and their rows; None when that is all
    of them or more than a filter should list."""
    large = F.col("bytes") > spec.task_bytes
    totals = df.groupBy(PARTITION_ID).agg(F.sum(accounted_bytes(df)).alias("bytes"), F.count(F.lit(1)).alias("rows"))
    row = totals.agg(
        F.count(F.lit(1)).alias("used"),
        F.count_if(large).alias("large"),
        F.sum("bytes").alias("bytes"),
        F.sum("rows").alias("rows"),
        F.sum(F.when(large, F.col("bytes"))).alias("large_bytes"),
        F.sum(F.when(large, F.col("rows"))).alias("large_rows"),
        F.slice(F.sort_array(F.collect_list(F.when(large, F.col(PARTITION_ID)))), 1, LISTED_PARTITIONS).alias("ids"),
    ).first()
    if row.large == 0:
        return [], 0, 0
    if row.large == row.used or row.large > LISTED_PARTITIONS:
        return None, row.bytes, row.rows
    return row.ids, row.large_bytes, row.large_rows


def check_names(df: DataFrame) -> DataFrame:
    """Refuse an input with a column named like one that is to be added."""
    taken = [c for c in df.columns if c.lower() in RESERVED]
    if taken:
        raise ValueError(f"rename input columns {taken}: these names are added to results")
    return df


def frozen_rows(df: DataFrame) -> DataFrame:
    """``df`` evaluated once, with a number of its own for every row.

    Written as Parquet in the shared folder, so later passes read just the columns they need; types that
    Parquet cannot hold are checkpointed instead.
    """
    numbered = df.withColumn(ROW_NO, F.monotonically_increasing_id())
    if not _parquet_holds(df.schema):
        return checkpointed(numbered)
    path = f"{shared_dir(df.sparkSession)}/frozen/{uuid.uuid4().hex}"
    numbered.write.parquet(path)
    return df.sparkSession.read.schema(numbered.schema).parquet(path)


def _parquet_holds(kind: T.DataType) -> bool:
    if isinstance(kind, T.StructType):
        return bool(kind.fields) and all(_parquet_holds(f.dataType) for f in kind)
    if isinstance(kind, T.ArrayType):
        return _parquet_holds(kind.elementType)
    if isinstance(kind, T.MapType):
        return _parquet_holds(kind.keyType) and _parquet_holds(kind.valueType)
    return not isinstance(kind, (T.NullType, T.CalendarIntervalType))


def place(df: DataFrame, spec: PartitionSpec, grouped: bool = False) -> list[Placed]:
    """Send rows that carry a partition number to tasks and sort them there:
    partitions that fit a task, and apart from them those that do not. ``grouped``
    lets small blocks of the latter share a task.

    Only an input that fits one task as a whole is moved as it is. Any other is frozen first, for its
    totals, its ranges and its rows are separate reads, and a query need not repeat itself.
    """
    known = spec.input_bytes
    if _fits(df, spec.task_bytes) if known is None else known <= spec.task_bytes:
        return [_place_whole(df, spec)]
    columns = [quoted(c) for c in df.columns]
    rows = frozen_rows(df)
    large, large_bytes, large_rows = _sizes(rows, spec)
    if large is None:
        return [_place_split(rows, spec, large_bytes, large_rows, grouped)]
    if not large:
        return [_place_whole(rows.select(*columns), spec)]
    is_large = quoted(PARTITION_ID).isin(large)
    return [
        _place_whole(rows.filter(~is_large).select(*columns), spec),
        _place_split(rows.filter(is_large), spec, large_bytes, large_rows, grouped),
    ]


def _place_whole(df: DataFrame, spec: PartitionSpec) -> Placed:
    # Task n holds partition n and nothing else, so the number is no sort column.
    moved = df.repartitionById(spec.partitions, quoted(PARTITION_ID).cast("int"))
    order = sort_columns(df, spec_sort_key(df, spec))
    return Placed(moved.sortWithinPartitions(*order), spec.partitions, False, spec.partitions)


def _place_split(rows: DataFrame, spec: PartitionSpec, size: int, count: int, grouped: bool) -> Placed:
    """Ranges over frozen rows. Their numbers order equal rows, so a range may end among these.

    Two blocks are made of every ``task_bytes``. Grouped, a task takes several of them where it would hold little
    otherwise, as long as there are as many tasks as a shuffle has.
    """
    columns = [c for c in rows.columns if c != ROW_NO]
    blocks = tasks = -(-2 * size // spec.task_bytes)
    if grouped:
        least = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        tasks = min(blocks, max(least, -(-2 * size // GROUPED_BYTES)))
    order = spec_sort_key(rows.select(*[quoted(c) for c in columns]), spec)
    keys = [quoted(PARTITION_ID), *sort_columns(rows, order), quoted(ROW_NO)]
    moved = rows.repartitionByRange(tasks, *keys).sortWithinPartitions(*keys)
    placed = moved.select(*[quoted(c) for c in columns])
    if tasks == blocks:
        return Placed(placed, tasks, True, blocks)
    # The last block of a task may be a short one.
    return Placed(placed, tasks, True, blocks + tasks, -(-count // blocks))


def union_of(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def partition_result(df: DataFrame, spec: PartitionSpec) -> DataFrame:
    """Rows with ``partition_id``, co-located by it and sorted inside each partition."""
    return union_of([part.df for part in place(add_partition_id(check_names(df), spec), spec)])
