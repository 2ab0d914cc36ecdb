"""Zero-based position of every row inside its partition."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from chunkspark.operators.partition import (
    PARTITION_ID, ROW_POS, PartitionSpec, Placed, add_partition_id, check_names, place, union_of,
)
from chunkspark.functions.types import quoted
from chunkspark.session import checkpointed

BLOCK = "_block"
AT = "_at"
# monotonically_increasing_id keeps the task in the bits above these.
ROW_BITS = 33
# Rows of a per-block table that may be sent to every executor (about 50 bytes each).
BROADCAST_ROWS = 1_000_000


def freeze_blocks(placed: Placed) -> DataFrame:
    """Placed rows frozen with their place and their block, which is named by the place
    of its first row. Frozen, because ranges drawn a second time could differ."""
    at = placed.df.withColumn(AT, F.monotonically_increasing_id())
    in_block = F.col(AT).bitwiseAND(F.lit((1 << ROW_BITS) - 1))
    if placed.block_rows is not None:
        in_block = in_block % F.lit(placed.block_rows).cast("long")
    return checkpointed(at.withColumn(BLOCK, F.col(AT) - in_block))


def join_blocks(rows: DataFrame, blocks: DataFrame, placed: Placed, partitions: int) -> DataFrame:
    """Attach one row per (partition, block) to the frozen rows, keeping their order.

    A block holds a contiguous stretch of partitions, so there are at most
    ``blocks + partitions`` pairs; only within BROADCAST_ROWS are they broadcast.
    """
    on = [PARTITION_ID, BLOCK]
    if placed.blocks + partitions <= BROADCAST_ROWS:
        return rows.join(F.broadcast(blocks), on)
    return rows.join(blocks, on).repartition(placed.tasks, BLOCK).sortWithinPartitions(AT)


def with_row_pos(df: DataFrame, spec: PartitionSpec) -> DataFrame:
    """Rows with ``partition_id`` and ``row_pos``, counted in the order of the spec."""
    return located(add_partition_id(check_names(df), spec), spec)


def located(numbered: DataFrame, spec: PartitionSpec) -> DataFrame:
    """Rows that carry a partition number, with ``row_pos``."""
    return union_of([_with_positions(part, spec) for part in place(numbered, spec)])


def _with_positions(placed: Placed, spec: PartitionSpec) -> DataFrame:
    if not placed.split:
        # A task holds one whole partition, so a row's place in the task is its position.
        in_task = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << ROW_BITS) - 1))
        return placed.df.withColumn(ROW_POS, in_task)
    rows = freeze_blocks(placed)
    blocks = rows.groupBy(PARTITION_ID, BLOCK).agg(F.count(F.lit(1)).alias("_rows"), F.min(AT).alias("_first"))
    before = Window.partitionBy(PARTITION_ID).orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumn("_before", F.coalesce(F.sum("_rows").over(before), F.lit(0))).drop("_rows")
    joined = join_blocks(rows, blocks, placed, spec.partitions)
    pos = F.col("_before") + F.col(AT) - F.col("_first")
    return joined.select(*[quoted(c) for c in placed.df.columns], pos.alias(ROW_POS))
