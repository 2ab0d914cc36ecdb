"""Pack the ordered rows of each partition into chunks of a bounded size.

Packing is greedy: a row opens a new chunk when it does not fit in what is left of
the open one. Equal rows make that a division. Otherwise sizes are walked in
order. A partition that spans several blocks is still packed exactly, without
walking it in one task: each block first states, for every amount of room it could
be entered with, what it leaves behind; those short statements are chained per
partition; then all blocks are packed at once from their known entries. Where chunks
are large, statements stay short because only some rows can open one: every chunk
is full but for less than the widest row, so the n-th opens in a narrow window of bytes.
"""

from __future__ import annotations

import math
import sys
from dataclasses import replace

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window, functions as F, types as T

from chunkspark.functions.types import check_supported, fixed_row_bytes, quoted, row_bytes
from chunkspark.operators.partition import (
    CHUNK_ID, PARTITION_ID, ROW_BYTES, ROW_POS, PartitionSpec, Placed, add_partition_id, check_names, place,
    spec_sort_key, union_of,
)
from chunkspark.operators.positions import AT, BLOCK, ROW_BITS, freeze_blocks, join_blocks, located
from chunkspark.session import checkpointed

ENTRY = ("_chunk", "_used", "_pos")

# Send the functions below with the tasks, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


class ChunkTooSmallError(ValueError):
    """A row that does not fit even in an empty chunk."""


def _too_small(limit: int, size: int) -> str:
    return f"a row of {size} bytes is larger than a chunk of {limit}"


def pack_chunks(df: DataFrame, spec: PartitionSpec, chunk_bytes: int, keep=None) -> DataFrame:
    """Rows with ``partition_id``, ``row_pos``, ``chunk_id`` and ``row_bytes``.

    ``keep`` names the columns to carry along (default all). Sizes always count the
    whole row, so a chunk index needs no column but the partition and sort columns.
    """
    check_supported(df.schema)
    constant = fixed_row_bytes(df.schema)
    columns = df.columns if keep is None else list(keep)
    # Numbered before anything is added or left out, so that a row's partition is what it is without packing.
    sized = add_partition_id(check_names(df), spec).withColumn(ROW_BYTES, row_bytes(df.schema))
    if keep is not None:
        needed = dict.fromkeys([*keep, *spec.by, *spec_sort_key(df, spec)])
        sized = sized.select(*[quoted(c) for c in needed], PARTITION_ID, ROW_BYTES)
    if constant is not None:
        if constant > chunk_bytes:
            raise ChunkTooSmallError(_too_small(chunk_bytes, constant))
        packed = located(sized, spec).withColumn(
            CHUNK_ID, F.call_function("div", F.col(ROW_POS), F.lit(chunk_bytes // constant).cast("long"))
        )
    else:
        packed = _pack_varying(sized, spec, chunk_bytes, columns)
    extra = [c for c in (PARTITION_ID, ROW_POS, CHUNK_ID, ROW_BYTES) if c not in columns]
    return packed.select(*[quoted(c) for c in [*columns, *extra]])


def pack_sized(rows: DataFrame, spec: PartitionSpec, chunk_bytes: int) -> DataFrame:
    """Rows that bring ``partition_id`` and ``row_bytes``, packed in the order of the spec."""
    return _pack_varying(rows, spec, chunk_bytes, rows.columns)


def chunk_index(chunks: DataFrame) -> DataFrame:
    """One row per chunk: rows, bytes, and the position of its first row."""
    return chunks.groupBy(PARTITION_ID, CHUNK_ID).agg(
        F.count(F.lit(1)).alias("row_count"),
        F.sum(ROW_BYTES).alias("used_bytes"),
        F.min(ROW_POS).alias("first_row_pos"),
    )


def _pack_varying(sized: DataFrame, spec: PartitionSpec, limit: int, columns: list[str]) -> DataFrame:
    # Sorted rows need their sort columns no more.
    carried = [quoted(c) for c in dict.fromkeys([*columns, PARTITION_ID, ROW_BYTES])]
    parts = place(sized, spec, grouped=True)
    return union_of([_pack_placed(replace(p, df=p.df.select(*carried)), spec, limit) for p in parts])


def _pack_placed(placed: Placed, spec: PartitionSpec, limit: int) -> DataFrame:
    if not placed.split:
        return _pack_in_order(placed.df, limit)
    rows = freeze_blocks(placed)
    # Placing makes two blocks of every ``task_bytes``.
    windowed = limit > spec.task_bytes // 2 // STATED_SHARE
    entries = _block_entries(_with_starts(rows, placed, spec.partitions) if windowed else rows, limit, placed)
    joined = join_blocks(rows, entries, placed, spec.partitions)
    return _pack_in_order(joined.drop(AT), limit)


# ---- the walk ----------------------------------------------------------------

def _walk(sizes: np.ndarray, used: int, limit: int) -> tuple[list[int], int]:
    """Rows that open a chunk when the open one holds ``used`` bytes, and the bytes
    in the chunk open at the end."""
    ends = np.concatenate(([0], np.cumsum(sizes)))
    at = int(np.searchsorted(ends, limit - used, side="right")) - 1
    follow = _next_starts(ends, limit).tolist()
    count, starts = len(sizes), []
    while at < count:
        starts.append(at)
        at = follow[at]
    left = used + int(ends[-1]) if not starts else int(ends[-1] - ends[starts[-1]])
    return starts, left


def _next_starts(ends: np.ndarray, limit: int) -> np.ndarray:
    """For a chunk opened at each row, the first row that no longer fits in it."""
    follow = np.searchsorted(ends, ends[:-1] + limit, side="right") - 1
    stuck = np.flatnonzero(follow == np.arange(len(follow)))
    if stuck.size:
        size = int(ends[stuck[0] + 1] - ends[stuck[0]])
        raise ChunkTooSmallError(_too_small(limit, size))
    return follow


def _runs(*ids: np.ndarray) -> list[tuple[int, int]]:
    """Stretches in which no value of ``ids`` changes."""
    changed = np.logical_or.reduce([np.diff(values) != 0 for values in ids])
    edges = (np.flatnonzero(changed) + 1).tolist()
    return list(zip([0, *edges], [*edges, len(ids[0])]))


def _ints(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return batch.column(name).to_numpy(zero_copy_only=False)


def _pack_in_order(df: DataFrame, limit: int) -> DataFrame:
    """Number positions and chunks of rows that arrive in order. Entry columns, if
    there are any, give the state a stretch starts with."""
    resumed = ENTRY[0] in df.columns
    kept = [f for f in df.schema if f.name not in (*ENTRY, BLOCK)]
    names = [f.name for f in kept] + [ROW_POS, CHUNK_ID]
    out = T.StructType(kept + [T.StructField(ROW_POS, T.LongType()), T.StructField(CHUNK_ID, T.LongType())])

    def pack(batches):
        current, chunk, used, pos = None, -1, limit, 0
        for batch in batches:
            if batch.num_rows == 0:
                continue
            ids, sizes = _ints(batch, PARTITION_ID), _ints(batch, ROW_BYTES)
            blocks = _ints(batch, BLOCK) if resumed else ids
            chunks = np.empty(len(ids), np.int64)
            places = np.empty(len(ids), np.int64)
            for start, stop in _runs(ids, blocks):
                if (ids[start], blocks[start]) != current:
                    current, chunk, used, pos = (ids[start], blocks[start]), -1, limit, 0
                    if resumed:
                        chunk, used, pos = (int(batch.column(c)[start].as_py()) for c in ENTRY)
                opened, used = _walk(sizes[start:stop], used, limit)
                steps = np.arange(stop - start)
                chunks[start:stop] = chunk + np.searchsorted(opened, steps, side="right")
                places[start:stop] = pos + steps
                chunk, pos = chunk + len(opened), pos + stop - start
            columns = [batch.column(f.name) for f in kept]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(places), pa.array(chunks)], names=names)

    return df.mapInArrow(pack, out)


# ---- partitions over several blocks ------------------------------------------

SPAN = "_span"
# Blocks whose statements one task may chain for a partition.
CHAINED_BLOCKS = 2_000
# Chunks above this share of a block are worth a pass over block sums for shorter statements.
STATED_SHARE = 64
# Bytes of the partition before a block, and its widest row up to the block's end.
START, WIDEST = "_start", "_widest"

_STATED = "rows long, bytes long, before array<long>, opened array<long>, left array<long>"
_ENTERED = ", ".join(f"{c} long" for c in ENTRY)


def _with_starts(rows: DataFrame, placed: Placed, partitions: int) -> DataFrame:
    """Frozen rows with what their block begins with; one row per block is summed and joined back."""
    totals = rows.groupBy(PARTITION_ID, BLOCK).agg(F.sum(ROW_BYTES).alias("_bytes"), F.max(ROW_BYTES).alias(WIDEST))
    through = Window.partitionBy(PARTITION_ID).orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    starts = totals.select(
        PARTITION_ID, BLOCK,
        (F.sum("_bytes").over(through) - F.col("_bytes")).alias(START), F.max(WIDEST).over(through).alias(WIDEST),
    )
    return join_blocks(rows.select(PARTITION_ID, BLOCK, ROW_BYTES, AT), starts, placed, partitions)


def _block_entries(rows: DataFrame, limit: int, placed: Placed) -> DataFrame:
    """State in which packing enters every (partition, block).

    Statements of one partition are chained in the order of its blocks. With many
    blocks that is done in spans of whole tasks: each span is joined to one statement,
    those are chained, and then every span is chained inside from its own entry.
    """
    windowed = START in rows.columns
    columns = [PARTITION_ID, BLOCK, ROW_BYTES, *([START, WIDEST] if windowed else [])]
    stated = rows.select(*columns).mapInArrow(
        _summarise(limit, windowed), f"{PARTITION_ID} long, {BLOCK} long, {_STATED}"
    )
    if placed.blocks <= CHAINED_BLOCKS:
        return _chained(stated, [PARTITION_ID], BLOCK, limit)
    length = max(1, math.isqrt(placed.blocks) * placed.tasks // placed.blocks)
    task = F.shiftright(F.col(BLOCK), ROW_BITS)
    # Frozen, since it is read twice: the rows are not walked again.
    stated = checkpointed(stated.withColumn(SPAN, F.call_function("div", task, F.lit(length).cast("long"))))
    spans = _ordered(stated, [PARTITION_ID, SPAN], BLOCK).mapInArrow(
        _join_spans(limit), f"{PARTITION_ID} long, {SPAN} long, {_STATED}"
    )
    entered = stated.join(_chained(spans, [PARTITION_ID], SPAN, limit), [PARTITION_ID, SPAN])
    return _chained(entered, [PARTITION_ID, SPAN], BLOCK, limit).drop(SPAN)


def _ordered(df: DataFrame, group: list[str], step: str) -> DataFrame:
    """Groups whole in one task, each in the order of ``step``.

    Placed by a hash of the columns, not by the columns: behind a join on these the plan would go without the second
    shuffle, and adaptive execution may then read that of the join map by map, which tears groups apart.
    """
    return df.repartition(F.xxhash64(*group)).sortWithinPartitions(*group, step)


def _chained(stated: DataFrame, group: list[str], step: str, limit: int) -> DataFrame:
    """Entry of every step of every group. Entry columns, if there are any, give the
    state a group starts with."""
    schema = ", ".join(f"{c} long" for c in (*group, step))
    resumed = ENTRY[0] in stated.columns
    return _ordered(stated, group, step).mapInArrow(_chain(limit, group, step, resumed), f"{schema}, {_ENTERED}")


# A statement about a stretch of rows: its rows and bytes, and for each row that may
# open its first new chunk the bytes before that row, the chunks opened from there
# on, and the bytes left in the last one. Those rows lie within the first chunk's
# bytes, and neighbours with one outcome are stated once. Rows known to open no chunk
# may be left out, for no entry that occurs leads to them; the first is always stated,
# so that every entry finds a row.
_LISTS = ("before", "opened", "left")


def _openers(before: np.ndarray, widest: int, limit: int) -> np.ndarray:
    """Which rows can open a chunk, by the bytes of their partition before them.

    A chunk is closed by a row that does not fit, so each holds more than ``limit - widest`` bytes: chunk n
    opens between ``n * (limit - widest + 1)`` and ``n * limit``. The widest row is that of the rows so far.
    """
    chunk = -(-before // limit)
    return chunk * (limit - widest + 1) <= before


def _statement(sizes: np.ndarray, limit: int, openers: np.ndarray | None = None) -> dict:
    ends = np.concatenate(([0], np.cumsum(sizes)))
    follow = _next_starts(ends, limit)
    count = len(sizes)
    first = np.arange(min(int(follow[0]) + 1, count))
    if openers is not None:
        first = first[openers[first] | (first == 0)]
    # Row each distinct walk stands on, and the walk each first row takes. Walks
    # that meet go on as one.
    at, member = first, np.arange(len(first))
    opened = np.ones(len(first), np.int64)
    going = follow[at] < count
    while going.any():
        opened += going[member]
        at, joined = np.unique(np.where(going, follow[at], at), return_inverse=True)
        member = joined[member]
        going = follow[at] < count
    return _stated(count, int(ends[-1]), ends[first], opened, ends[-1] - ends[at[member]])


def _stated(rows: int, size: int, before: np.ndarray, opened: np.ndarray, left: np.ndarray) -> dict:
    new = np.concatenate(([True], (np.diff(opened) != 0) | (np.diff(left) != 0)))
    return {"rows": rows, "bytes": size, "before": before[new], "opened": opened[new], "left": left[new]}


def _pass(statement: dict, used, limit: int):
    """Chunks a stretch opens and bytes it leaves when entered with ``used`` bytes."""
    through = used + statement["bytes"]
    way = np.searchsorted(statement["before"], limit - used, side="right") - 1
    opened = np.where(through <= limit, 0, statement["opened"][way])
    return opened, np.where(through <= limit, through, statement["left"][way])


def _after(first: dict, second: dict, limit: int) -> dict:
    """Statement of two stretches in a row."""
    more, left = _pass(second, first["left"], limit)
    # Rows of the second stretch that can open a chunk after the whole first one.
    reached = int(np.searchsorted(second["before"], limit - first["bytes"], side="right"))
    return _stated(
        first["rows"] + second["rows"],
        first["bytes"] + second["bytes"],
        np.concatenate((first["before"], second["before"][:reached] + first["bytes"])),
        np.concatenate((first["opened"] + more, second["opened"][:reached])),
        np.concatenate((left, second["left"][:reached])),
    )


def _statements(batch: pa.RecordBatch):
    rows, sizes = _ints(batch, "rows"), _ints(batch, "bytes")
    lists = [batch.column(name) for name in _LISTS]
    for i in range(batch.num_rows):
        values = {name: column[i].values.to_numpy() for name, column in zip(_LISTS, lists)}
        yield {"rows": int(rows[i]), "bytes": int(sizes[i]), **values}


def _folded(statements, names: list[str], limit: int):
    """One statement for each run of equal keys, from (key, statement) pairs."""
    held_key, held = None, None

    def row():
        columns = [pa.array([v], pa.int64()) for v in (*held_key, held["rows"], held["bytes"])]
        columns += [pa.array([held[name]], pa.list_(pa.int64())) for name in _LISTS]
        return pa.RecordBatch.from_arrays(columns, names=[*names, "rows", "bytes", *_LISTS])

    for key, statement in statements:
        if key == held_key:
            held = _after(held, statement, limit)
            continue
        if held_key is not None:
            yield row()
        held_key, held = key, statement
    if held_key is not None:
        yield row()


def _summarise(limit: int, windowed: bool):
    """Statements of blocks, batch by batch."""
    def stated(batches):
        current, before = None, 0
        for batch in batches:
            if batch.num_rows == 0:
                continue
            ids, blocks, sizes = (_ints(batch, c) for c in (PARTITION_ID, BLOCK, ROW_BYTES))
            for start, stop in _runs(ids, blocks):
                key, openers = (int(ids[start]), int(blocks[start])), None
                if windowed:
                    if key != current:
                        current, before = key, batch.column(START)[start].as_py()
                    ends = before + np.cumsum(sizes[start:stop])
                    openers = _openers(ends - sizes[start:stop], batch.column(WIDEST)[start].as_py(), limit)
                    before = int(ends[-1])
                yield key, _statement(sizes[start:stop], limit, openers)

    return lambda batches: _folded(stated(batches), [PARTITION_ID, BLOCK], limit)


def _join_spans(limit: int):
    """Statements of spans from those of their blocks in order."""
    def stated(batches):
        for batch in batches:
            keys = zip(_ints(batch, PARTITION_ID).tolist(), _ints(batch, SPAN).tolist())
            yield from zip(keys, _statements(batch))

    return lambda batches: _folded(stated(batches), [PARTITION_ID, SPAN], limit)


def _chain(limit: int, group: list[str], step: str, resumed: bool):
    """Entries of the steps of a group in order."""
    names = [*group, step, *ENTRY]

    def run(batches):
        current, chunk, used, pos = None, -1, limit, 0
        for batch in batches:
            columns = {c: _ints(batch, c).tolist() for c in (names if resumed else [*group, step])}
            entries = {c: [] for c in ENTRY}
            for i, statement in enumerate(_statements(batch)):
                key = [columns[c][i] for c in group]
                if key != current:
                    current, (chunk, used, pos) = key, [columns[c][i] for c in ENTRY] if resumed else (-1, limit, 0)
                for name, value in zip(ENTRY, (chunk, used, pos)):
                    entries[name].append(value)
                opened, left = _pass(statement, used, limit)
                chunk, used, pos = chunk + int(opened), int(left), pos + statement["rows"]
            columns.update(entries)
            yield pa.RecordBatch.from_arrays([pa.array(columns[c], pa.int64()) for c in names], names=names)

    return run
