"""Counts per cell over a whole table, merged from one sketch per task, as a bit map of the shared cells.

Keys fall into cells by hash. Each task counts the cells of its own rows, saturated at
two, and sends them slice by slice; the slices are summed where they belong. What
comes back is one bit per cell, set where two keys or more fell. Its size is ``2**bits / 8``
bytes per row of cells whatever the input is (32 MB for 28 bits), so it may be collected and
broadcast. A key that occurs twice is always found; one that occurs once is
found too when all its cells are shared, so the filter overestimates and loses none.
With more keys than cells it lets all pass: slower, never wrong.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame

from chunkspark.llm.runs import mixed

SLICE_BITS = 20
#: Keys a task holds before it sends its counts.
HELD = 1_000_000
SCHEMA = pa.schema([("slice", pa.int32()), ("once", pa.binary()), ("more", pa.binary())])
SEEDS = (np.uint64(0xA0761D6478BD642F), np.uint64(0xE7037ED1A0B428DB))


def cells(keys: np.ndarray, bits: int, row: int) -> np.ndarray:
    return (mixed(keys ^ SEEDS[row]) >> np.uint64(64 - bits)).astype(np.int64)


def _sent(keys: np.ndarray, bits: int, rows: int, times: int) -> Iterator[pa.RecordBatch]:
    low = (1 << SLICE_BITS) - 1
    for row in range(rows):
        cell, count = np.unique(cells(keys, bits, row), return_counts=True)
        more = count * times > 1
        part = cell >> SLICE_BITS
        names, first = np.unique(part, return_index=True)
        ends = np.append(first[1:], len(cell))
        out: list[list] = [[], [], []]
        for name, a, b in zip(names.tolist(), first.tolist(), ends.tolist()):
            here, shared = (cell[a:b] & low).astype("<u4"), more[a:b]
            out[0].append((row << (bits - SLICE_BITS)) + name)
            out[1].append(_packed(here[~shared]))
            out[2].append(_packed(here[shared]))
        yield pa.record_batch([pa.array(c, type=f.type) for c, f in zip(out, SCHEMA)], schema=SCHEMA)


def _packed(cell: np.ndarray) -> bytes:
    """Sorted cells as their gaps, in two bytes each where they fit."""
    gaps = np.diff(cell, prepend=np.uint32(0))
    return b"\0" + gaps.astype("<u2").tobytes() if not len(gaps) or gaps.max() < 1 << 16 else b"\1" + gaps.astype("<u4").tobytes()


def _unpacked(data: bytes) -> np.ndarray:
    return np.cumsum(np.frombuffer(data, dtype="<u4" if data[:1] == b"\1" else "<u2", offset=1), dtype=np.int64)


def _merged(batches):
    held: dict[int, np.ndarray] = {}
    for batch in batches:
        for name, once, more in zip(*[batch.column(i).to_pylist() for i in range(3)]):
            counts = held.setdefault(name, np.zeros(1 << SLICE_BITS, dtype=np.uint8))
            at = _unpacked(once)
            counts[at] = np.minimum(counts[at] + 1, 2)
            counts[_unpacked(more)] = 2
    for name, counts in held.items():
        if (counts > 1).any():
            yield pa.record_batch({"slice": pa.array([name], pa.int32()), "bits": pa.array([np.packbits(counts > 1).tobytes()], pa.binary())})


class Shared:
    """Which keys may occur more than once; ``bits`` is the broadcast map."""

    def __init__(self, bits_map: Broadcast, bits: int, rows: int):
        self.map, self.bits, self.rows = bits_map, bits, rows

    def test(self, keys: np.ndarray) -> np.ndarray:
        found = np.ones(len(keys), dtype=bool)
        for row in range(self.rows):
            cell = cells(keys, self.bits, row)
            found &= (self.map.value[row, cell >> 3] >> (7 - (cell & 7)).astype(np.uint8)) & 1 == 1
        return found


def shared_keys(df: DataFrame, keys_of: Callable[[pa.RecordBatch], Iterator[np.ndarray]], bits: int, rows: int = 1, times: int = 1) -> Shared:
    """Filter of the keys that ``keys_of`` draws from the batches of ``df``; each counts ``times`` times."""
    def run(batches):
        held, size = [], 0
        for batch in batches:
            for keys in keys_of(batch):
                held.append(keys)
                size += len(keys)
                if size > HELD:
                    yield from _sent(np.concatenate(held), bits, rows, times)
                    held, size = [], 0
        if size:
            yield from _sent(np.concatenate(held), bits, rows, times)

    slices = rows << (bits - SLICE_BITS)
    sketches = df.mapInArrow(run, "slice int, once binary, more binary")
    # As many tasks as slices at most, so that a task sums a few megabytes of cells.
    tasks = min(slices, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    merged = sketches.repartition(tasks, "slice").mapInArrow(_merged, "slice int, bits binary")
    whole = np.zeros((rows, 1 << (bits - 3)), dtype=np.uint8)
    per_row, width = slices // rows, 1 << (SLICE_BITS - 3)
    # One job; what it brings is as large as the map at most.
    for row in merged.collect():
        at = row["slice"] % per_row * width
        whole[row["slice"] // per_row, at: at + width] = np.frombuffer(row["bits"], dtype=np.uint8)
    return Shared(df.sparkSession.sparkContext.broadcast(whole), bits, rows)
