"""Checks on a partitioned or chunked result: affinity, order, repeatability."""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window, functions as F, types as T

from chunkspark.functions.types import quoted
from chunkspark.operators.partition import CHUNK_ID, PARTITION_ID, ROW_POS

# Send the functions below with the tasks, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def affinity_violations(df: DataFrame, by) -> DataFrame:
    """Partition keys found in more than one partition. Two extremes decide it, so
    a hot key is reduced before the shuffle."""
    found = df.groupBy(*[quoted(c) for c in by]).agg(
        F.min(PARTITION_ID).alias("lowest_partition"),
        F.max(PARTITION_ID).alias("highest_partition"),
    )
    return found.filter("lowest_partition <> highest_partition")


# Types whose order Arrow tells as Spark does.
_COMPARED = (T.LongType, T.IntegerType, T.ShortType, T.ByteType, T.DoubleType, T.FloatType, T.StringType, T.BinaryType, T.BooleanType, T.DateType,
             T.TimestampType, T.TimestampNTZType, T.DecimalType)


def order_violations(chunks: DataFrame, order) -> DataFrame:
    """Rows that sort before the row ahead of them in their chunk. NULLs are equal
    to each other and come first, NaN comes last.

    Rows that follow each other in a task, as packed rows do, are compared there. What a task hands on is
    the first and the last row of each stretch of a chunk; only these meet in a shuffle. Rows in any
    other placement make short stretches, so the result is the same and costs what a full sort does.
    """
    names = list(order)
    kinds = [chunks.schema[c].dataType for c in names]
    columns = F.struct(*[quoted(c) for c in names])
    if not all(isinstance(k, _COMPARED) for k in kinds):
        ahead = F.lag(columns).over(Window.partitionBy(PARTITION_ID, CHUNK_ID).orderBy(ROW_POS))
        compared = chunks.select(PARTITION_ID, CHUNK_ID, ROW_POS, columns.alias("_now"), ahead.alias("_ahead"))
        return compared.filter("_ahead > _now").select(PARTITION_ID, CHUNK_ID, ROW_POS)
    held = T.StructType([T.StructField(f"k{i}", k) for i, k in enumerate(kinds)])
    out = T.StructType([*[T.StructField(c, T.LongType()) for c in (PARTITION_ID, CHUNK_ID, ROW_POS)],
                        T.StructField("_first", held), T.StructField("_last", held)])
    narrow = chunks.select(*[quoted(c).cast("long") for c in (PARTITION_ID, CHUNK_ID, ROW_POS)],
                           *[quoted(c).alias(f"k{i}") for i, c in enumerate(names)])
    told = narrow.mapInArrow(_stretches(len(names)), out)
    # Rows found inside a task have no first row of a stretch; they pass.
    edges = Window.partitionBy(PARTITION_ID, CHUNK_ID, F.col("_first").isNull()).orderBy(ROW_POS)
    met = told.withColumn("_ahead", F.lag("_last").over(edges))
    return met.filter("_first IS NULL OR _ahead > _first").select(PARTITION_ID, CHUNK_ID, ROW_POS)


def _before(now: pa.Array, ahead: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Per pair: whether ``now`` sorts before ``ahead``, and whether they are equal."""
    def flags(array):
        return array.to_numpy(zero_copy_only=False).astype(bool)

    none_now, none_ahead = flags(now.is_null()), flags(ahead.is_null())
    less, same = flags(pc.fill_null(pc.less(now, ahead), False)), flags(pc.fill_null(pc.equal(now, ahead), False))
    if pa.types.is_floating(now.type):
        nan_now, nan_ahead = (flags(pc.fill_null(pc.is_nan(a), False)) for a in (now, ahead))
        less, same = less | (~nan_now & nan_ahead & ~none_now), same | (nan_now & nan_ahead)
    return less | (none_now & ~none_ahead), same | (none_now & none_ahead)


def _stretches(width: int):
    """Violations inside stretches of rows that follow each other, and the ends of each stretch."""
    def run(batches):
        last: pa.Table | None = None
        opened: dict | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            rows = (table if last is None else pa.concat_tables([last, table])).combine_chunks()
            ids, chunk, pos = (rows.column(i).to_numpy() for i in range(3))
            follows = (np.diff(ids) == 0) & (np.diff(chunk) == 0) & (np.diff(pos) == 1)
            keys = [rows.column(3 + i).combine_chunks() for i in range(width)]
            worse, equal = np.zeros(len(follows), bool), np.ones(len(follows), bool)
            for key in keys:
                less, same = _before(key.slice(1), key.slice(0, rows.num_rows - 1))
                worse, equal = worse | (equal & less), equal & same
            new = last is None
            bad = np.flatnonzero(worse & follows) + 1
            # Stretches of these rows; the first goes on from the batch before when a row of it was carried over.
            starts = np.concatenate(([0], np.flatnonzero(~follows) + 1))
            ends = np.append(starts[1:], rows.num_rows) - 1
            if new:
                opened = _row(rows, 0)
            firsts = [opened, *[_row(rows, int(s)) for s in starts[1:]]]
            done = [(f, _row(rows, int(e))) for f, e in zip(firsts[:-1], ends[:-1])]
            opened = firsts[-1]
            yield _told(rows.take(pa.array(bad)), done, rows)
            last = rows.slice(rows.num_rows - 1)
        if last is not None:
            yield _told(last.slice(1), [(opened, last)], last)

    def _row(rows, at):
        return rows.slice(at, 1)

    def _told(bad, done, rows):
        kind = pa.struct([pa.field(f"k{i}", rows.schema.field(3 + i).type) for i in range(width)])

        def struct(table):
            return pa.StructArray.from_arrays([table.column(3 + i).combine_chunks() for i in range(width)], fields=list(kind))

        none = pa.nulls(bad.num_rows, kind)
        if done:
            first, end = (pa.concat_tables(t).combine_chunks() for t in zip(*done))
            ids = [pa.concat_arrays([bad.column(i).combine_chunks(), first.column(i).combine_chunks()]) for i in range(3)]
            pair = [pa.concat_arrays([none, struct(t)]) for t in (first, end)]
        else:
            ids, pair = [bad.column(i).combine_chunks() for i in range(3)], [none, none]
        return pa.RecordBatch.from_arrays([*ids, *pair], names=[PARTITION_ID, CHUNK_ID, ROW_POS, "_first", "_last"])

    return run


def compare_passes(first: DataFrame, second: DataFrame) -> DataFrame:
    """Counts of chunk index rows found in one pass only; both zero when passes agree."""
    columns = first.columns
    both = first.withColumn("_side", F.lit(1)).unionByName(second.withColumn("_side", F.lit(-1)))
    # How much more often a row is in the first pass than in the second; one aggregate reads each pass once.
    more = both.groupBy(*[quoted(c) for c in columns]).agg(F.sum("_side").alias("_more"))
    return more.agg(
        F.coalesce(F.sum(F.greatest("_more", F.lit(0))), F.lit(0)).cast("long").alias("only_in_first"),
        F.coalesce(F.sum(F.greatest(-F.col("_more"), F.lit(0))), F.lit(0)).cast("long").alias("only_in_second"),
    )
