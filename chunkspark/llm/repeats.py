"""Windows that also start earlier, removed: what the two substring operators share.

All windows stand in a few anchored runs (``runs.py``). The passes over the documents:

1. ``prefilter`` tells which anchors may occur more than once; all other runs hold
   unique windows only and take no further part.
2. Runs with equal tokens form a class; the class is owned by its smallest document.
   Everywhere else all windows of the run also start earlier.
3. Within its owner's run, a window starts earlier only if another class with the same
   anchor holds it. For anchors with several classes the owners' windows themselves
   are grouped by their fingerprints, and each window gets its smallest document.
4. Documents receive what they own, work out their runs again, and drop what is covered
   by windows that they don't own.

Classes and windows are keyed by 128-bit fingerprints and aggregated before they are
shuffled, so a passage in a third of all rows is one row per task. No pairs are made.
Texts are shuffled once, to meet what their documents own.

Rows with equal doc_id never take tokens from one another; rows with a null doc_id
neither take nor give. Empty and null texts have no windows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chunkspark.llm.common import flat_bytes, narrowed, slices, stored
from chunkspark.llm.count_filter import Shared, shared_keys
from chunkspark.llm.runs import Fingerprints, Runs, find_runs

#: Cells of the maps of anchors with several classes, and of documents that hold such runs.
SPLIT_BITS, DOC_BITS = 26, 24
#: Rows of output a task gathers before it hands them on.
ROWS = 1 << 16


class Words(dict):
    """Random 64-bit value pairs of words, by hash; emptied when it grows."""

    def __missing__(self, word):
        if len(self) > 400_000:
            self.clear()
        self[word] = value = xxhash.xxh3_128_digest(word)
        return value


@dataclass(frozen=True)
class Unit:
    """What a window is made of: ``length`` bytes or words, anchored at ``group`` of them."""

    words: bool
    length: int
    group: int
    #: Whether an earlier start in the same document counts as well.
    within: bool


@dataclass
class Slice:
    """Tokens of some documents of a batch, with their runs."""

    rows: range
    bounds: np.ndarray
    one: Fingerprints
    two: Callable[[], Fingerprints]
    runs: Runs
    tokens: list | np.ndarray


BYTE_VALUES = np.random.default_rng(20).integers(0, 1 << 63, size=(2, 256), dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def read_slices(batch: pa.RecordBatch, unit: Unit) -> Iterator[Slice]:
    known = Words()
    for start, stop in slices(batch):
        column = batch.column("text").slice(start, stop - start)
        if unit.words:
            texts = [t.split() for t in column.to_pylist()]
            bounds = np.concatenate(([0], np.cumsum([len(t) for t in texts]))).astype(np.int64)
            values = np.frombuffer(b"".join([known[w] for t in texts for w in t]), dtype="<u8").reshape(-1, 2)
            first, second, tokens = np.ascontiguousarray(values[:, 0]), values[:, 1], texts
        else:
            tokens, bounds = flat_bytes(column)
            first, second = BYTE_VALUES[0][tokens], None
        one = Fingerprints(first, 0)

        def two(second=second, tokens=tokens):
            return Fingerprints(np.ascontiguousarray(second) if second is not None else BYTE_VALUES[1][tokens], 1)

        yield Slice(range(start, stop), bounds, one, two, find_runs(one, bounds, unit.length, unit.group), tokens)


def anchor_filter(docs: DataFrame, unit: Unit, bits: int, rows: int) -> Shared:
    """Filter of the anchors that may stand in more than one place."""
    def keys(batch):
        for part in read_slices(batch, unit):
            yield part.runs.anchor

    return shared_keys(docs, keys, bits, rows)


def _signed(values: np.ndarray) -> pa.Array:
    return pa.array(values.view(np.int64))


def _batches(parts: Iterator[tuple[np.ndarray, ...]], names: list[str]) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for part in parts:
        held.append(part)
        size += len(part[0])
        if size > ROWS:
            yield pa.record_batch([_signed(np.concatenate(c)) for c in zip(*held)], names=names)
            held, size = [], 0
    if size:
        yield pa.record_batch([_signed(np.concatenate(c)) for c in zip(*held)], names=names)


def _with_id(batch: pa.RecordBatch) -> pa.RecordBatch:
    return batch.filter(batch.column("doc_id").is_valid())


def run_classes(docs: DataFrame, unit: Unit, shared: Shared) -> DataFrame:
    """Classes of equal runs: h1, h2, anchor and the smallest document (``doc``)."""
    def found(batches):
        for batch in batches:
            batch = _with_id(batch)
            ids = np.asarray(batch.column("doc_id"), dtype=np.int64)
            for part in read_slices(batch, unit):
                runs = part.runs
                kept = np.flatnonzero(shared.test(runs.anchor))
                start, stop = runs.first[kept], runs.first[kept] + runs.windows[kept] + unit.length - 1
                yield part.one.of(start, stop), part.two().of(start, stop), runs.anchor[kept], ids[part.rows.start + runs.doc[kept]]

    names = ["h1", "h2", "anchor", "doc"]
    rows = docs.mapInArrow(lambda batches: _batches(found(batches), names), "h1 long, h2 long, anchor long, doc long")
    return rows.groupBy("h1", "h2").agg(F.min("anchor").alias("anchor"), F.min("doc").alias("doc"))


def _longs(data: bytes | None) -> np.ndarray:
    return np.frombuffer(data or b"", dtype=np.uint64)


def own_windows(docs: DataFrame, unit: Unit, classes: DataFrame) -> tuple[DataFrame, Shared]:
    """Fingerprints (``doc``, ``w``) of the windows whose smallest document is ``doc``, for runs whose
    anchor has several classes, and the filter of these anchors."""
    several = classes.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("anchor")
    several = stored(several, "anchors")

    def anchors(batch):
        yield np.asarray(batch.column(0), dtype=np.int64).view(np.uint64)

    split = shared_keys(several, anchors, SPLIT_BITS, times=2)

    # The filter itself decides here and in the last pass, so both mean the same runs.
    def divided(batches):
        for batch in batches:
            yield batch.filter(pa.array(split.test(next(anchors(batch.select(["anchor"]))))))

    # Lists of a document are as long as its text at most.
    chosen = classes.mapInArrow(divided, classes.schema)
    owned = stored(chosen.groupBy("doc").agg(F.collect_list("h1").alias("h1")), "owners")
    holders = shared_keys(owned.select("doc"), anchors, DOC_BITS, times=2)

    def of_holders(batches):
        for batch in batches:
            batch = _with_id(batch)
            yield batch.filter(pa.array(holders.test(np.asarray(batch.column("doc_id"), dtype=np.int64).view(np.uint64))))

    def windows(batches):
        for batch in batches:
            ids = np.asarray(batch.column("doc_id"), dtype=np.int64)
            lists = batch.column("h1")
            values, ends = np.asarray(lists.flatten(), dtype=np.int64).view(np.uint64), np.diff(np.asarray(lists.offsets))
            values, row = values, np.repeat(np.arange(len(ids)), ends)
            for part in read_slices(batch, unit):
                runs, at = part.runs, part.rows.start
                here = (row >= at) & (row < part.rows.stop)
                mine = _member(runs.doc, part.one.of(runs.first, runs.first + runs.windows + unit.length - 1), row[here] - at, values[here])
                start, doc = _starts(runs, np.flatnonzero(mine & split.test(runs.anchor)))
                w1, w2 = part.one.of(start, start + unit.length), part.two().of(start, start + unit.length)
                _, first = np.unique(np.stack([doc.astype(np.uint64), w1]), axis=1, return_index=True)
                yield w1[first], w2[first], ids[at + doc[first]]

    texts = docs.mapInArrow(of_holders, docs.schema).join(owned.withColumnRenamed("doc", "doc_id"), "doc_id")
    names = ["w1", "w2", "doc"]
    rows = texts.select("doc_id", "text", "h1").mapInArrow(lambda b: _batches(windows(b), names), "w1 long, w2 long, doc long")
    return rows.groupBy("w1", "w2").agg(F.min("doc").alias("doc")).select("doc", F.col("w1").alias("w")), split


def _starts(runs: Runs, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Window starts of the chosen runs, and their documents."""
    sizes = runs.windows[chosen]
    ends = np.cumsum(sizes)
    start = np.repeat(runs.first[chosen] - ends + sizes, sizes) + np.arange(int(ends[-1]) if len(ends) else 0)
    return start, np.repeat(runs.doc[chosen], sizes)


def _member(doc: np.ndarray, key: np.ndarray, own_doc: np.ndarray, own_key: np.ndarray) -> np.ndarray:
    """Whether (doc, key) is among (own_doc, own_key)."""
    if not len(own_key) or not len(key):
        return np.zeros(len(key), dtype=bool)
    pairs = np.stack([np.concatenate([own_doc, doc]).astype(np.uint64), np.concatenate([own_key, key])])
    order = np.lexsort((pairs[0], pairs[1]))
    pairs = pairs[:, order]
    changed = np.append(True, (pairs[:, 1:] != pairs[:, :-1]).any(axis=0))
    group = np.cumsum(changed) - 1
    held = np.zeros(group[-1] + 1, dtype=bool)
    held[group[order < len(own_key)]] = True
    out = np.zeros(len(order), dtype=bool)
    out[order] = held[group]
    return out[len(own_key):]


def _first_in_doc(doc: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Whether an entry is the first of its document with its key; entries are in order of place."""
    order = np.lexsort((np.arange(len(key)), key, doc))
    out = np.zeros(len(key), dtype=bool)
    if len(key):
        d, k = doc[order], key[order]
        out[order] = np.append(True, (d[1:] != d[:-1]) | (k[1:] != k[:-1]))
    return out


def covered(part: Slice, unit: Unit, shared: Shared, split: Shared, valid: np.ndarray, own_runs, own_windows_) -> np.ndarray:
    """Which tokens of a slice are covered by windows that also start earlier."""
    runs = part.runs
    marks = np.zeros(int(part.bounds[-1]) + 1, dtype=np.int64)
    maybe = np.flatnonzero(valid[runs.doc] & shared.test(runs.anchor)) if len(runs) else np.zeros(0, dtype=np.int64)
    if len(maybe):
        sub = Runs(runs.doc[maybe], runs.first[maybe], runs.windows[maybe], runs.anchor[maybe])
        print_ = part.one.of(sub.first, sub.first + sub.windows + unit.length - 1)
        mine = _member(sub.doc, print_, *own_runs)
        if unit.within:
            mine &= _first_in_doc(sub.doc, print_)
        whole = np.flatnonzero(~mine)
        np.add.at(marks, sub.first[whole], 1)
        np.add.at(marks, sub.first[whole] + sub.windows[whole] + unit.length - 1, -1)
        start, doc = _starts(sub, np.flatnonzero(mine & split.test(sub.anchor)))
        if len(start):
            w = part.one.of(start, start + unit.length)
            free = _member(doc, w, *own_windows_)
            if unit.within:
                free &= _first_in_doc(doc, w)
            np.add.at(marks, start[~free], 1)
            np.add.at(marks, start[~free] + unit.length, -1)
    return np.cumsum(marks[:-1]) > 0


def finished(docs: DataFrame, unit: Unit, shared: Shared, split: Shared, owned: DataFrame, made_schema: pa.Schema, ddl,
             judge: Callable[[Slice, np.ndarray, int], tuple], extra: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, the ``extra`` columns, and what ``judge`` makes of each document's removed tokens."""
    def lists(batch, name):
        column = batch.column(name)
        sizes = np.diff(np.asarray(column.offsets)) if len(column) else np.zeros(0, dtype=np.int64)
        sizes = np.where(np.asarray(column.is_valid()), sizes, 0) if len(column) else sizes
        return np.repeat(np.arange(len(column)), sizes), np.asarray(column.flatten(), dtype=np.int64).view(np.uint64)

    def run(batches):
        for batch in batches:
            valid = np.asarray(batch.column("doc_id").is_valid())
            kept = {"r": lists(batch, "own_runs"), "w": lists(batch, "own_windows")}
            rows = []
            for part in read_slices(batch, unit):
                at, stop = part.rows.start, part.rows.stop
                near = {k: ((row[(a := slice(*np.searchsorted(row, [at, stop])))] - at), key[a]) for k, (row, key) in kept.items()}
                gone = covered(part, unit, shared, split, valid[at:stop], near["r"], near["w"])
                for row in range(len(part.rows)):
                    rows.append(judge(part, gone, row))
            if rows:
                made = [pa.array(c, type=f.type) for c, f in zip(zip(*rows), made_schema)]
                yield pa.record_batch([batch.column("doc_id"), *[batch.column(c) for c in extra], *made], names=["doc_id", *extra, *made_schema.names])

    mixed_in = docs.join(owned.withColumnRenamed("doc", "doc_id"), "doc_id", "left")
    empty = F.array().cast("array<bigint>")
    return mixed_in.select("doc_id", *extra, "text", F.coalesce("own_runs", empty).alias("own_runs"),
                           F.coalesce("own_windows", empty).alias("own_windows")).mapInArrow(run, ddl)


def removal(docs: DataFrame, unit: Unit, shared: Shared, made_schema: pa.Schema, ddl, judge, extra: tuple[str, ...] = ()) -> DataFrame:
    """All passes after the prefilter; ``docs`` has doc_id, text (bytes) and the ``extra`` columns."""
    two = docs.select("doc_id", "text")
    classes = stored(run_classes(two, unit, shared), "runs")
    windows, split = own_windows(two, unit, classes)
    lists = (
        classes.select("doc", F.col("h1").alias("r"), F.lit(None).cast("long").alias("w"))
        .unionByName(windows.select("doc", F.lit(None).cast("long").alias("r"), "w"))
        .groupBy("doc").agg(F.collect_list("r").alias("own_runs"), F.collect_list("w").alias("own_windows"))
    )
    return finished(docs, unit, shared, split, lists, made_schema, ddl, judge, extra)


def kept_bytes(part: Slice, gone: np.ndarray, row: int) -> bytes:
    a, b = int(part.bounds[row]), int(part.bounds[row + 1])
    if isinstance(part.tokens, list):
        return b" ".join([w for w, g in zip(part.tokens[row], gone[a:b].tolist()) if not g])
    return part.tokens[a:b][~gone[a:b]].tobytes()


def sha256(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


__all__ = ["Unit", "anchor_filter", "removal", "kept_bytes", "sha256", "narrowed"]
