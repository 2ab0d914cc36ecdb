"""Pairs inside buckets, in blocks of bounded size, and the groups that links form."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chunkspark.llm.common import stored

#: Pairs that are looked at in one round of array work.
PAIRS = 1 << 17
LINKS = pa.schema([("vertex", pa.int64()), ("links", pa.int64()), ("root", pa.int64())])
LINKS_DDL = "vertex long, links long, root long"


def blocked(rows: DataFrame, bucket: str, vertex: str, cap: int) -> DataFrame:
    """Rows sorted by (bucket, _a, _b), each such group whole in one task and of about ``2 * cap`` rows at most.

    A bucket of more than ``cap`` rows is dealt into parts by a hash of the vertex, and every two
    parts meet in a group of their own, so no task holds a bucket, however large. ``_own`` is a row's part.
    """
    sizes = rows.groupBy(bucket).agg(F.count(F.lit(1)).alias("_size")).filter("_size > 1")
    parts = F.ceil(F.col("_size") / cap).cast("int")
    own = F.pmod(F.xxhash64(F.lit(77), vertex), F.col("_parts")).cast("int")
    other = F.explode(F.when(F.col("_parts") == 1, F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), F.col("_parts") - 1)))
    met = rows.join(sizes, bucket).withColumn("_parts", parts).withColumn("_own", own).withColumn("_other", other)
    placed = met.withColumn("_a", F.least("_own", "_other")).withColumn("_b", F.greatest("_own", "_other"))
    return placed.drop("_size", "_parts", "_other").repartition(bucket, "_a", "_b").sortWithinPartitions(bucket, "_a", "_b", vertex)


def whole_groups(batches: Iterator[pa.RecordBatch], keys: tuple[str, ...]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Sorted rows as tables of whole groups, with the first row of each group and the end."""
    held: pa.Table | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        table = table if held is None else pa.concat_tables([held, table])
        starts = _starts(table, keys)
        if len(starts) == 1:
            held = table
            continue
        yield table.slice(0, int(starts[-1])).combine_chunks(), starts
        held = table.slice(int(starts[-1]))
    if held is not None:
        yield held.combine_chunks(), np.append(_starts(held, keys), held.num_rows)


def _starts(table: pa.Table, keys: tuple[str, ...]) -> np.ndarray:
    opens = np.zeros(table.num_rows, dtype=bool)
    opens[0] = True
    for key in keys:
        values = table.column(key).to_numpy()
        opens[1:] |= values[1:] != values[:-1]
    return np.flatnonzero(opens)


def pairs(starts: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs of rows in one group, some at a time; ``starts`` ends with the number of rows."""
    ends = np.repeat(starts[1:], np.diff(starts))
    left = np.arange(len(ends))
    later = ends - 1 - left
    total = np.concatenate(([0], np.cumsum(later)))
    at = 0
    while at < total[-1]:
        stop = min(at + PAIRS, int(total[-1]))
        first, last = np.searchsorted(total, [at, stop], side="right") - 1
        last = min(last, len(left) - 1)
        rows = np.arange(first, last + 1)
        count = np.minimum(total[rows + 1], stop) - np.maximum(total[rows], at)
        i = np.repeat(rows, count)
        j = np.arange(at, stop) - total[i] + i + 1
        yield i, j
        at = stop


def meets_first(keys: np.ndarray, here: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Whether the group's bucket is the smallest that both rows are in.

    ``keys`` has each row's buckets in ascending order, filled up with the largest number; ``here`` is
    the bucket of the row's group. Each pair is so judged in one of the buckets it shares.
    """
    out = np.zeros(len(i), dtype=bool)
    step = max(1, (1 << 21) // max(1, keys.shape[1] ** 2))
    for at in range(0, len(i), step):
        a, b = keys[i[at: at + step]], keys[j[at: at + step]]
        never = np.iinfo(np.int64).max
        same = (a[:, :, None] == b[:, None, :]).any(axis=2)
        out[at: at + step] = np.where(same, a, never).min(axis=1) == here[i[at: at + step]]
    return out


def first_pairs(starts: np.ndarray, keys: np.ndarray, here: np.ndarray, many: int = 48) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of rows in one group that meet there first; large groups by one product of their shared buckets."""
    sizes = np.diff(starts)
    large = np.flatnonzero(sizes > many)
    edges = np.concatenate(([-1], large, [len(sizes)]))
    for before, after in zip(edges[:-1], edges[1:]):
        if after - before > 1:
            some = starts[before + 1: after + 1]
            for i, j in pairs(some - some[0]):
                i, j = i + some[0], j + some[0]
                kept = meets_first(keys, here, i, j)
                yield i[kept], j[kept]
        if after < len(sizes):
            a, b = int(starts[after]), int(starts[after + 1])
            row, col = np.nonzero(keys[a:b] < here[a])
            _, name, count = np.unique(keys[a:b][row, col], return_inverse=True, return_counts=True)
            shared = count[name] > 1
            name = np.unique(name[shared], return_inverse=True)[1]
            held = np.zeros((b - a, int(name.max(initial=-1)) + 1), dtype=np.float32)
            held[row[shared], name] = 1
            met = held @ held.T > 0
            for i, j in pairs(np.array([0, b - a])):
                kept = ~met[i, j]
                yield i[kept] + a, j[kept] + a


def key_table(lists: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """List column of ascending longs as a table, short lists filled up with the largest number."""
    lists = lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists
    sizes = np.asarray(lists.value_lengths()).astype(np.int64)
    out = np.full((len(sizes), int(sizes.max(initial=1))), np.iinfo(np.int64).max, dtype=np.int64)
    out[np.arange(out.shape[1])[None, :] < sizes[:, None]] = np.asarray(lists.flatten())
    return out


def linked(i: np.ndarray, j: np.ndarray, vertex: np.ndarray, weight: np.ndarray) -> pa.RecordBatch:
    """Per vertex: the summed weight of its partners, and the smallest vertex it is joined to here."""
    names, at = np.unique(np.concatenate([vertex[i], vertex[j]]), return_inverse=True)
    a, b = at[: len(i)], at[len(i):]
    links = np.zeros(len(names), dtype=np.int64)
    np.add.at(links, a, weight[j])
    np.add.at(links, b, weight[i])
    root = np.arange(len(names))
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, root[a], low)
        np.minimum.at(new, root[b], low)
        new = new[new]
        if (new == root).all():
            break
        root = new
    return pa.record_batch([pa.array(names), pa.array(links), pa.array(names[root])], schema=LINKS)


def components(edges: DataFrame) -> DataFrame:
    """Smallest vertex (``component``) that each vertex of ``edges`` (vertex, root) is joined to, itself excluded.

    Large-star and small-star steps in turn: every vertex links its neighbours to the smallest of them,
    which keeps the number of edges and halves distances; each round is written to the shared folder.
    """
    def tidy(pairs_):
        return pairs_.filter("u > v").distinct()

    now = stored(tidy(edges.select(F.greatest("vertex", "root").alias("u"), F.least("vertex", "root").alias("v"))), "edges")
    told = None
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = tidy(both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")))
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = tidy(large.join(least, "u").filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                     .unionByName(least.select("u", F.col("m").alias("v"))))
        now = stored(small, "edges")
        seen = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if seen == told:
            return now.select(F.col("u").alias("vertex"), F.col("v").alias("component"))
        told = seen
