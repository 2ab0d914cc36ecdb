"""Removal of repeated byte strings by a depth-limited radix sort of suffixes.

Tokens are the bytes of a text; matches never cross documents. A byte goes when a string of ``LENGTH``
bytes that covers it also starts earlier (a smaller doc_id, or the same document
before); strings are judged on the input. A string is a suffix read through ``LENGTH`` bytes:

1. Each suffix stands under its anchor, a ``GROUP``-byte group in those bytes, in one of ``2**BITS`` cells. A map of
   the cells over all tasks shows anchors seen once only; their suffixes are unique and need no order.
2. Neighbouring suffixes under one anchor make a run. Equal runs are folded to the one that starts first, told by 128-bit
   fingerprints, before anything is shuffled; all suffixes of the others start earlier as well.
3. Where an anchor has several different runs, these are sent, as bytes, to where their anchor belongs. There their suffixes are
   ordered by most-significant-digit passes: eight bytes a pass, groups of one leave after each, up to ``LENGTH`` bytes. The groups that
   are left are exactly the repeated strings, compared byte for byte; all but the first member of each also start earlier.
4. Documents receive which runs are theirs and which stretches of suffixes are not, and drop what these cover.

A run of n suffixes is sent as n + ``LENGTH`` - 1 bytes, so a suffix costs a few bytes, not a string of its own. A task orders ``SORTED``
bytes of runs at a time. Anchors with more than that are not one task's: their suffixes are dealt by all their bytes and grouped, in one
pass of full depth that is aggregated before the shuffle.

Null and empty texts have nothing to remove, nor have texts shorter than a string. Long texts are scanned in pieces of ``PIECE`` bytes.
Rows with a null doc_id stay whole. Rows repeated with the same doc_id are not earlier than each other, though each may be than
itself. Other columns come through ``deduplicated`` unchanged, whatever their names. Empty tables give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from chunkspark.llm.common import documents, flat_bytes, narrowed, slices, stored
from chunkspark.llm.count_filter import Shared, shared_keys
from chunkspark.llm.pairing import whole_groups
from chunkspark.llm.repeats import BYTE_VALUES, DOC_BITS, SPLIT_BITS, _batches, _first_in_doc, _member, _with_id, sha256
from chunkspark.llm.runs import Fingerprints, find_runs
from chunkspark.plans.registry import query

LENGTH, GROUP = 100, 64
BITS = 28
#: Bytes of a digit, and of a text that is scanned at once.
DIGIT, PIECE = 8, 1 << 20
#: Bytes of runs that a task orders at once, about.
SORTED = 8 << 20


@dataclass(frozen=True)
class Depth:
    """Suffixes are read through ``length`` bytes and anchored at ``group`` of them."""

    length: int = LENGTH
    group: int = GROUP


# ---- runs of suffixes --------------------------------------------------------

@dataclass
class Found:
    """Runs of the rows ``start:stop`` of a batch, by row and place in its text."""

    start: int
    stop: int
    row: np.ndarray
    first: np.ndarray
    windows: np.ndarray
    anchor: np.ndarray
    one: np.ndarray
    two: np.ndarray


def _piece(data: np.ndarray, bounds: np.ndarray, depth: Depth, row: int, base: int) -> tuple[np.ndarray, ...]:
    one = Fingerprints(BYTE_VALUES[0][data], 0)
    runs = find_runs(one, bounds, depth.length, depth.group)
    stop = runs.first + runs.windows + depth.length - 1
    two = Fingerprints(BYTE_VALUES[1][data], 1)
    return runs.doc + row, runs.first - bounds[runs.doc] + base, runs.windows, runs.anchor, one.of(runs.first, stop), two.of(runs.first, stop)


def found_runs(batch: pa.RecordBatch, depth: Depth) -> Iterator[Found]:
    for start, stop in slices(batch):
        data, bounds = flat_bytes(batch.column("text").slice(start, stop - start))
        if bounds[-1] <= PIECE:
            yield Found(start, stop, *_piece(data, bounds, depth, start, 0))
            continue
        # Pieces overlap, so each suffix is in one of them through its depth. A run that a piece cuts is two runs of one anchor.
        told = []
        for row, (a, b) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist()), start):
            for at in range(a, max(a + 1, b - depth.length + 1), PIECE):
                part = data[at: min(b, at + PIECE + depth.length - 1)]
                told.append(_piece(part, np.array([0, len(part)], dtype=np.int64), depth, row, at - a))
        yield Found(start, stop, *[np.concatenate(c) for c in zip(*told)])


def anchors_shared(docs: DataFrame, depth: Depth) -> Shared:
    """Map of the anchors that may stand in more than one place."""
    def keys(batch):
        for found in found_runs(batch, depth):
            yield found.anchor

    return shared_keys(docs, keys, BITS, 1)


def run_classes(docs: DataFrame, depth: Depth, shared: Shared) -> DataFrame:
    """Classes of equal runs: h1, h2, anchor and the smallest document (``doc``)."""
    def told(batches):
        for batch in map(_with_id, batches):
            ids = np.asarray(batch.column("doc_id"), dtype=np.int64)
            for found in found_runs(batch, depth):
                kept = np.flatnonzero(shared.test(found.anchor))
                yield found.one[kept], found.two[kept], found.anchor[kept], ids[found.row[kept]]

    names = ["h1", "h2", "anchor", "doc"]
    rows = docs.mapInArrow(lambda batches: _batches(told(batches), names), "h1 long, h2 long, anchor long, doc long")
    return rows.groupBy("h1", "h2").agg(F.min("anchor").alias("anchor"), F.min("doc").alias("doc"))


# ---- order under an anchor ---------------------------------------------------

#: ``tag`` is a hash of the text: it parts rows of one doc_id, whose places are their own.
RUNS = pa.schema([("anchor", pa.int64()), ("doc", pa.int64()), ("tag", pa.int64()), ("first", pa.int64()), ("run", pa.binary())])
LOST = pa.schema([("doc", pa.int64()), ("tag", pa.int64()), ("first", pa.int64()), ("windows", pa.int64())])
LOST_DDL = "doc long, tag long, first long, windows long"


def contested(docs: DataFrame, depth: Depth, classes: DataFrame) -> DataFrame:
    """Bytes of the runs whose anchor has several classes, one row per class, from its smallest document."""
    several = stored(classes.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("anchor"), "anchors")

    def longs(batch):
        yield np.asarray(batch.column(0), dtype=np.int64).view(np.uint64)

    # A run that the map lets through beside these is alone under its anchor: ordered with nothing, it stays its document's.
    split = shared_keys(several, longs, SPLIT_BITS, times=2)

    def divided(batches):
        for batch in batches:
            yield batch.filter(pa.array(split.test(next(longs(batch.select(["anchor"]))))))

    # Lists of a document are as long as its text at most.
    owned = stored(classes.mapInArrow(divided, classes.schema).groupBy("doc").agg(F.collect_list("h1").alias("h1")), "owners")
    holders = shared_keys(owned.select("doc"), longs, DOC_BITS, times=2)

    def of_holders(batches):
        for batch in map(_with_id, batches):
            yield batch.filter(pa.array(holders.test(np.asarray(batch.column("doc_id"), dtype=np.int64).view(np.uint64))))

    def sent(batches):
        for batch in batches:
            ids, tags = (np.asarray(batch.column(c), dtype=np.int64) for c in ("doc_id", "tag"))
            own_row, own = listed(batch, "h1")
            for found in found_runs(batch, depth):
                here = (own_row >= found.start) & (own_row < found.stop)
                mine = _member(found.row, found.one, own_row[here], own[here]) & _first_in_doc(found.row, found.one)
                for some in np.array_split(kept := np.flatnonzero(mine & split.test(found.anchor)), 1 + len(kept) // 4096):
                    texts, runs = {}, []
                    for row, a, n in zip(found.row[some].tolist(), found.first[some].tolist(), found.windows[some].tolist()):
                        text = texts[row] if row in texts else texts.setdefault(row, batch.column("text")[row].as_py())
                        runs.append(text[a: a + n + depth.length - 1])
                    yield pa.record_batch([pa.array(found.anchor[some].view(np.int64)), pa.array(ids[found.row[some]]),
                                           pa.array(tags[found.row[some]]), pa.array(found.first[some]), pa.array(runs, pa.binary())], schema=RUNS)

    texts = docs.mapInArrow(of_holders, docs.schema).join(owned.withColumnRenamed("doc", "doc_id"), "doc_id")
    return texts.select("doc_id", "text", "h1", F.xxhash64("text").alias("tag")).mapInArrow(
        sent, "anchor long, doc long, tag long, first long, run binary")


def ordered(data: np.ndarray, at: np.ndarray, group: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes at ``at`` that some other one of their group equals through ``length`` bytes, and their groups then.
    One stable sort by (group, digit) a pass; suffixes alone in their group leave."""
    data = np.concatenate([data, np.zeros(DIGIT, dtype=np.uint8)])
    wide = np.lib.stride_tricks.sliding_window_view(data, DIGIT)
    for deep in range(0, length, DIGIT):
        if not len(at):
            break
        digit = np.ascontiguousarray(wide[at + deep]).view(">u8").ravel().astype(np.uint64)
        digit >>= np.uint64(8 * max(0, DIGIT - (length - deep)))
        order = np.lexsort((digit, group))
        digit, was = digit[order], group[order]
        opens = np.append(True, (digit[1:] != digit[:-1]) | (was[1:] != was[:-1]))
        now = np.cumsum(opens) - 1
        several = np.bincount(now)[now] > 1
        at, group = at[order][several], now[several]
    return at, group


def _lost(runs: pa.Table, length: int) -> pa.RecordBatch | None:
    """Stretches of suffixes of these runs (all there are under their anchors) that an earlier one equals."""
    column = runs.column("run").combine_chunks()
    data, bounds = flat_bytes(column if isinstance(column, pa.Array) else pa.concat_arrays(column.chunks))
    doc, tag, first = (runs.column(c).to_numpy() for c in ("doc", "tag", "first"))
    windows = np.diff(bounds) - length + 1
    ends = np.cumsum(windows)
    owner = np.repeat(np.arange(len(windows)), windows)
    at = np.arange(int(ends[-1])) - np.repeat(ends - windows, windows) + bounds[:-1][owner]
    anchor = runs.column("anchor").to_numpy()
    rank = np.append(0, np.cumsum(anchor[1:] != anchor[:-1]))
    found, group = ordered(data, at, rank[owner], length)
    if not len(found):
        return None
    run = np.searchsorted(bounds, found, side="right") - 1
    place = first[run] + found - bounds[run]
    order = np.lexsort((place, tag[run], doc[run], group))
    run, place, group = run[order], place[order], group[order]
    # Lost to a smaller document, or to an earlier place of the same text; rows given twice have each place twice.
    opens = np.append(True, group[1:] != group[:-1])
    smallest = doc[run[opens]][np.cumsum(opens) - 1]
    same = np.append(False, (group[1:] == group[:-1]) & (doc[run[1:]] == doc[run[:-1]]) & (tag[run[1:]] == tag[run[:-1]]))
    head = np.maximum.accumulate(np.where(same, 0, np.arange(len(run))))
    later = (doc[run] > smallest) | (place > place[head])
    run, place = run[later], place[later]
    if not len(run):
        return None
    # Neighbours make one stretch.
    order = np.lexsort((place, run))
    run, place = run[order], place[order]
    opens = np.flatnonzero(np.append(True, (run[1:] != run[:-1]) | (place[1:] != place[:-1] + 1)))
    sizes = np.diff(np.append(opens, len(run)))
    return pa.record_batch([pa.array(doc[run[opens]]), pa.array(tag[run[opens]]), pa.array(place[opens]), pa.array(sizes)], schema=LOST)


def _radix(length: int):
    def run(batches):
        held: list[pa.Table] = []
        size = 0
        for group, _ in whole_groups(batches, ("anchor",)):
            held.append(group)
            size += group.nbytes
            if size > SORTED:
                yield from filter(None, [_lost(pa.concat_tables(held), length)])
                held, size = [], 0
        if held:
            yield from filter(None, [_lost(pa.concat_tables(held), length)])

    return run


def _suffixes(length: int):
    schema = pa.schema([("suffix", pa.binary()), ("doc", pa.int64()), ("tag", pa.int64()), ("first", pa.int64())])

    def run(batches):
        for batch in batches:
            for doc, tag, first, data in zip(*[batch.column(c).to_pylist() for c in ("doc", "tag", "first", "run")]):
                count = len(data) - length + 1
                yield pa.record_batch([pa.array([data[i: i + length] for i in range(count)], pa.binary()),
                                       pa.array(np.full(count, doc)), pa.array(np.full(count, tag)),
                                       pa.array(first + np.arange(count))], schema=schema)

    return run


def lost_stretches(runs: DataFrame, depth: Depth) -> DataFrame:
    """doc, first and windows of stretches of suffixes that also start earlier, among contested runs."""
    runs = stored(runs, "contested")
    large = runs.groupBy("anchor").agg(F.sum(F.octet_length("run")).alias("n")).filter(F.col("n") > SORTED).select("anchor")
    large = stored(large, "large-anchors")
    # By a hash, since a shuffle by the columns of the join below would be left out of the plan, and that of the join may be read in parts.
    placed = runs.join(large, "anchor", "left_anti").repartition(F.xxhash64("anchor")).sortWithinPartitions("anchor")
    lost = placed.mapInArrow(_radix(depth.length), LOST_DDL)
    spread = runs.join(large, "anchor", "left_semi").select("doc", "tag", "first", "run").mapInArrow(
        _suffixes(depth.length), "suffix binary, doc long, tag long, first long")
    texts = spread.groupBy("suffix", "doc", "tag").agg(F.min("first").alias("_first"))
    least = texts.groupBy("suffix").agg(F.min("doc").alias("_doc"))
    met = spread.join(texts, ["suffix", "doc", "tag"]).join(least, "suffix")
    beaten = met.filter("doc > _doc OR first > _first").select("doc", "tag", "first").distinct()
    return lost.unionByName(beaten.withColumn("windows", F.lit(1).cast("long")))


# ---- what is left of the documents -------------------------------------------

def listed(batch: pa.RecordBatch, name: str, kind=np.uint64) -> tuple[np.ndarray, np.ndarray]:
    """Values of a list column, with their rows."""
    column = batch.column(name)
    sizes = np.asarray(column.value_lengths().fill_null(0)).astype(np.int64)
    return np.repeat(np.arange(len(column)), sizes), np.asarray(column.flatten(), dtype=np.int64).view(kind)


def removed(docs: DataFrame, depth: Depth, made_schema: pa.Schema, ddl, judge, extra: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, the ``extra`` columns, and what ``judge`` makes of each text (bytes) and of which of its bytes go."""
    two = docs.select("doc_id", "text")
    shared = anchors_shared(two, depth)
    classes = stored(run_classes(two, depth, shared), "runs")
    lost = lost_stretches(contested(two, depth, classes), depth)
    no = F.lit(None).cast("long")
    stretch = F.when(F.col("first").isNotNull(), F.struct("tag", "first", "windows"))
    told = (
        classes.select("doc", F.col("h1").alias("own"), *[no.alias(c) for c in ("tag", "first", "windows")])
        .unionByName(lost.select("doc", no.alias("own"), "tag", "first", "windows"))
        .groupBy("doc").agg(F.collect_list("own").alias("own"), F.collect_list(stretch).alias("lost"))
        .select(F.col("doc").alias("doc_id"), "own", *[F.col(f"lost.{c}").alias(f"_{c}") for c in ("tag", "first", "windows")])
    )

    def run(batches):
        for batch in batches:
            valid = np.asarray(batch.column("doc_id").is_valid())
            own_row, own = listed(batch, "own")
            lost_row, tag = listed(batch, "_tag", np.int64)
            first, windows = (listed(batch, c, np.int64)[1] for c in ("_first", "_windows"))
            its = tag == np.asarray(batch.column("_text"), dtype=np.int64)[lost_row]
            lost_row, first, windows = lost_row[its], first[its], windows[its]
            rows = []
            for found in found_runs(batch, depth):
                maybe = valid[found.row] & shared.test(found.anchor)
                row, one, place, count = found.row[maybe], found.one[maybe], found.first[maybe], found.windows[maybe]
                here = (own_row >= found.start) & (own_row < found.stop)
                mine = _member(row, one, own_row[here], own[here]) & _first_in_doc(row, one)
                gone = (lost_row >= found.start) & (lost_row < found.stop)
                at = [np.concatenate(c) for c in ((row[~mine], lost_row[gone]), (place[~mine], first[gone]), (count[~mine], windows[gone]))]
                order = np.argsort(at[0], kind="stable")
                at = [c[order] for c in at]
                edges = np.searchsorted(at[0], np.arange(found.start, found.stop + 1))
                for r in range(found.start, found.stop):
                    text = batch.column("text")[r].as_py()
                    some = slice(int(edges[r - found.start]), int(edges[r - found.start + 1]))
                    marks = np.zeros(len(text) + 1, dtype=np.int32)
                    np.add.at(marks, at[1][some], 1)
                    np.add.at(marks, at[1][some] + at[2][some] + depth.length - 1, -1)
                    rows.append(judge(text, np.cumsum(marks[:-1]) > 0))
            if rows:
                made = [pa.array(c, type=f.type) for c, f in zip(zip(*rows), made_schema)]
                yield pa.record_batch([batch.column("doc_id"), *[batch.column(c) for c in extra], *made], names=["doc_id", *extra, *made_schema.names])

    met = docs.join(told, "doc_id", "left").select("doc_id", *extra, "text", F.xxhash64("text").alias("_text"), "own", "_tag", "_first", "_windows")
    return met.mapInArrow(run, ddl)


def kept(text: bytes, gone: np.ndarray) -> bytes:
    return np.frombuffer(text, dtype=np.uint8)[~gone].tobytes() if gone.any() else text


SCHEMA = pa.schema([("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept", pa.binary())])


def suffix_dedup(docs: DataFrame, length: int = LENGTH, group: int = GROUP, doc_id: str = "doc_id", text: str = "text",
                 digest: bool = False) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and the kept bytes (their SHA-256 with ``digest``)."""
    def judge(raw, gone):
        spans = int(np.count_nonzero(gone[1:] & ~gone[:-1])) + int(len(gone) > 0 and gone[0])
        left = kept(raw, gone)
        return len(raw), int(gone.sum()), spans, sha256(left).encode() if digest else left

    return removed(narrowed(docs, doc_id, text), Depth(length, min(group, length)), SCHEMA,
                   "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary", judge)


def deduplicated(docs: DataFrame, length: int = LENGTH, group: int = GROUP, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with what is left of their texts as text; bytes of a cut character become U+FFFD; null stays null."""
    named = docs.toDF(*[f"_c{i}" for i in range(len(docs.columns))])
    at = {name: f"_c{i}" for i, name in enumerate(docs.columns)}
    others = [at[c] for c in docs.columns if c not in (doc_id, text)]
    packed_in = named.select(
        F.col(at[doc_id]).cast("long").alias("doc_id"), F.coalesce(F.col(at[text]).cast("binary"), F.lit(b"")).alias("text"),
        F.col(at[text]).isNull().alias("_null"), F.struct(*others).alias("_rest") if others else F.lit(None).cast("struct<a:int>").alias("_rest"))

    def judge(raw, gone):
        return (kept(raw, gone).decode("utf-8", "replace"),)

    fields = StructType([StructField(f.name, f.dataType) for f in packed_in.schema if f.name != "text"]).add("_kept", StringType())
    made = removed(packed_in, Depth(length, min(group, length)), pa.schema([("_kept", pa.string())]), fields, judge, ("_null", "_rest"))
    back = {doc_id: F.col("doc_id").cast(docs.schema[doc_id].dataType), text: F.when(~F.col("_null"), F.col("_kept"))}
    return made.select(*[back.get(c, F.col(f"_rest.{at[c]}")).alias(c) for c in docs.columns])


@query("op5_suffix_array_dedup")
def op5_suffix_array_dedup(spark, sf_dir):
    found = suffix_dedup(documents(spark, sf_dir), digest=True)
    return found.selectExpr("doc_id", "n_bytes", "n_removed", "n_spans", "cast(kept AS string) AS kept_sha256")
