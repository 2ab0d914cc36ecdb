"""Records of tab-separated files, read by many tasks also where quoted values hold newlines.

Files are read by lines, in blocks as the scan splits them. A line may begin a record, or go on inside a quoted value, or
after an escaped newline of a plain one, and only what comes before it tells. So a block is read twice:

1. Every block states, for each of the three ways it may begin, how it ends, which lines at its head belong to a record
   begun before, and which at its tail to one that goes on after. That is a few rows a block, stored.
2. The outcomes are chained along each file, which tells how each block really begins. Now every task cuts the records that lie in its
   blocks, and the heads and tails between them are joined in the order of their blocks.

An input that the scan does not split needs only the second reading. A record is cut into fields here, not by a CSV reader, so it is
known whether a value was quoted: ``\\N`` is NULL, ``"\\\\N"`` is text. Long stretches of simple lines, whole records without escapes,
are told and cut by column; only what lies between them is walked line by line.
"""

from __future__ import annotations

import re
import sys
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from chunkspark.session import shared_dir

# Fixed values of the file format.
TAB, NULL_MARK = b"\t", b"\\N"

#: How a line may begin.
START, QUOTED, PLAIN = range(3)
#: What makes a line of each kind read like one that begins a record.
_OPENING = {START: b"", QUOTED: b'"', PLAIN: b"x"}

_QUOTED = rb'"([^"\\]*(?:\\.[^"\\]*)*)"([^\t]*)'
_PLAIN = rb'((?:[^"\t\\]|\\.)[^\t\\]*(?:\\.[^\t\\]*)*|)'
_FIELD = rb'(?:"[^"\\]*(?:\\.[^"\\]*)*"[^\t]*|(?:[^"\t\\]|\\.)[^\t\\]*(?:\\.[^\t\\]*)*|)'
_RECORD = re.compile(rb"%s(?:\t%s)*" % (_FIELD, _FIELD), re.DOTALL)
_TOKEN = re.compile(rb"(?:\A|\t)(?:%s|%s)" % (_QUOTED, _PLAIN), re.DOTALL)
_ESCAPED = re.compile(rb'\\([\\"\t\n])')

#: Blocks that do not begin a record and may be sent to every executor, 17 bytes each.
BROADCAST_ROWS = 1_000_000
#: Records and bytes of a batch that is handed on.
ROWS, BYTES = 4096, 4 << 20
#: Simple lines in a row that are worth being cut by column.
STRETCH = 64

# Send the functions below with the tasks, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


class MalformedRecordError(ValueError):
    """A record that does not have the fields of the schema."""


def after(state: int, line: bytes) -> int:
    """How the next line begins when this one begins as ``state``."""
    if b'"' not in line:
        if state == QUOTED:
            return QUOTED
        # Without quotes all that goes on is an escaped newline.
        return PLAIN if (len(line) - len(line.rstrip(b"\\"))) % 2 else START
    whole = _OPENING[state] + line
    if _RECORD.fullmatch(whole):
        return START
    rest = whole[_RECORD.match(whole).end():].removeprefix(TAB)
    return QUOTED if rest.startswith(b'"') else PLAIN


def fields(record: bytes) -> list[bytes | None]:
    """Values of a whole record; unquoted ``\\N`` is None."""
    out = []
    for value in record.split(TAB):
        if value[:1] == b'"':
            if len(value) < 2 or value[-1:] != b'"' or value.count(b'"') != 2 or b"\\" in value:
                return _tokens(record)
            out.append(value[1:-1])
        elif value == NULL_MARK:
            out.append(None)
        elif b"\\" in value:
            return _tokens(record)
        else:
            out.append(value)
    return out


def _tokens(record: bytes) -> list[bytes | None]:
    """The same where values hold tabs, quotes or escapes."""
    out = []
    for quoted, more, plain in (m.groups() for m in _TOKEN.finditer(record)):
        if more:
            raise MalformedRecordError(f"text after the end of a quoted value: {more[:40]!r}")
        out.append(_plain(quoted) if quoted is not None else None if plain == NULL_MARK else _plain(plain))
    return out


def _plain(value: bytes) -> bytes:
    return _ESCAPED.sub(rb"\1", value) if b"\\" in value else value


def _places(data: np.ndarray, character: bytes) -> np.ndarray:
    return np.flatnonzero(data == ord(character))


def simple(lines: pa.Array) -> np.ndarray:
    """Which lines are whole records if they begin one, for sure: their backslashes stand in values that are the NULL mark,
    their quotes at both ends of values and nowhere else."""
    kind = np.int64 if pa.types.is_large_binary(lines.type) else np.int32
    bounds = np.frombuffer(lines.buffers()[1], kind)[lines.offset: lines.offset + len(lines) + 1].astype(np.int64)
    first, ok = bounds[0], np.ones(len(lines), bool)
    if first == bounds[-1]:
        return ok
    # A tab stands before each line, so that every value has one on either side.
    body = np.frombuffer(lines.buffers()[2], np.uint8)[first: bounds[-1]]
    begins = bounds - first
    data = np.insert(body, begins, ord(TAB))
    begins = begins + np.arange(len(begins))
    tabs = _places(data, TAB)

    def line_of(places):
        return np.searchsorted(begins, places, side="right") - 1

    marks = _places(data, b"\\")
    if marks.size:
        # The byte after a backslash is there: a tab ends the last line.
        alone = (data[marks - 1] == ord(TAB)) & (data[marks + 1] == ord("N"))
        alone[alone] = data[marks[alone] + 2] == ord(TAB)
        ok[line_of(marks[~alone])] = False
    quotes = _places(data, b'"')
    if quotes.size:
        line = line_of(quotes)
        count = np.bincount(line, minlength=len(ok))
        ok &= count % 2 == 0
        nth = np.arange(len(quotes)) - (np.cumsum(count) - count)[line]
        opening = nth % 2 == 0
        fits = np.where(opening, data[quotes - 1] == ord(TAB), data[quotes + 1] == ord(TAB))
        ok[line[~fits]] = False
        # Both quotes of a value have as many tabs before them.
        before = np.searchsorted(tabs, quotes)
        closing = np.flatnonzero(~opening)
        torn = closing[before[closing] != before[closing - 1]]
        ok[line[torn]] = False
    return ok


def _stretches(lines: pa.Array) -> Iterator[tuple[pa.Array, bool]]:
    """Lines in order: stretches of at least STRETCH simple ones, and what lies between them."""
    if len(lines) < STRETCH:
        yield lines, False
        return
    edges = np.concatenate(([-1], np.flatnonzero(~simple(lines)), [len(lines)]))
    done = 0
    for at in np.flatnonzero(np.diff(edges) > STRETCH):
        a, b = int(edges[at]) + 1, int(edges[at + 1])
        if done < a:
            yield lines.slice(done, a - done), False
        yield lines.slice(a, b - a), True
        done = b
    if done < len(lines):
        yield lines.slice(done), False


def _columns(lines: pa.Array, width: int) -> pa.RecordBatch:
    """Values of simple lines."""
    counts = pc.count_substring(lines, TAB)
    if pc.any(pc.not_equal(counts, width - 1)).as_py():
        record = lines[pc.index(pc.not_equal(counts, width - 1), True).as_py()].as_py()
        raise MalformedRecordError(f"{record.count(TAB) + 1} values for {width} columns: {record[:40]!r}")
    values, out = pc.split_pattern(lines, TAB).flatten(), []
    for i in range(width):
        column = values.take(pa.array(np.arange(i, len(values), width)))
        is_quoted = pc.starts_with(column, '"')
        if pc.any(is_quoted).as_py():
            column = pc.if_else(is_quoted, pc.binary_slice(column, 1, -1), column)
            is_null = pc.and_not(pc.equal(column, NULL_MARK), is_quoted)
        else:
            is_null = pc.equal(column, NULL_MARK)
        out.append(pc.if_else(is_null, pa.scalar(None, pa.binary()), column) if pc.any(is_null).as_py() else column)
    return pa.record_batch(out, names=[f"c{i}" for i in range(width)])


def _by_block(batches) -> Iterator[tuple[tuple, pa.RecordBatch]]:
    """Rows of one (file, start) each, in order."""
    for batch in batches:
        if batch.num_rows:
            file, start = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            edges = np.flatnonzero((np.diff(file) != 0) | (np.diff(start) != 0)) + 1
            for a, b in zip([0, *edges.tolist()], [*edges.tolist(), batch.num_rows]):
                yield (int(file[a]), int(start[a])), batch.slice(a, b - a)


# ---- first reading -----------------------------------------------------------

class _Way:
    """A block under the assumption that it begins as ``entry``."""

    def __init__(self, entry: int):
        self.state, self.entry = entry, entry
        self.in_head, self.head, self.tail = entry != START, [], []

    def take(self, line: bytes, state: int) -> None:
        if self.in_head:
            self.head.append(line)
            self.in_head = state != START
        elif state == START:
            self.tail = []
        else:
            self.tail.append(line)
        self.state = state


OUTCOMES = "file long, start long, entry int, exit int, head binary, tail binary"


def _outcomes(batches):
    at, ways = None, []

    def told():
        rows = [(*at, w.entry, w.state, b"\n".join(w.head) if w.head else None, b"\n".join(w.tail) if w.tail else None) for w in ways]
        kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary())
        names = [part.split()[0] for part in OUTCOMES.split(", ")]
        return pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

    for block, rows_ in _by_block(batches):
        if block != at:
            if at is not None:
                yield told()
            at, ways = block, [_Way(entry) for entry in (START, QUOTED, PLAIN)]
        for lines, plain in _stretches(rows_.column(2)):
            for line in lines if plain else lines.to_pylist():
                if plain:
                    if all(way.state == START and not way.in_head for way in ways):
                        # Whole records for every way: none is left open.
                        for way in ways:
                            way.tail = []
                        break
                    line = line.as_py()
                known = {}
                for way in ways:
                    if way.state not in known:
                        known[way.state] = after(way.state, line)
                    way.take(line, known[way.state])
    if at is not None:
        yield told()


def _chained(batches):
    """How each block of a file begins; rows come by file, start and entry."""
    file, state = None, START
    for batch in batches:
        found = []
        for at, start, entry, end in zip(*[batch.column(i).to_pylist() for i in range(4)]):
            if at != file:
                file, state, placed = at, START, None
            if start != placed:
                # The three outcomes of a block stand together; the first one opens it.
                placed, begins = start, state
            if entry == begins:
                found.append((at, start, entry))
                state = end
        if found:
            yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*found), (pa.int64(), pa.int64(), pa.int32()))],
                                  names=["file", "start", "entry"])


# ---- second reading ----------------------------------------------------------

def _cut(width: int, ends: bool = False):
    """Values of the records that lie whole in a block. ``ends`` says that every record does."""
    def run(batches):
        def records():
            at, state, skipping, held = None, START, False, []
            for block, rows in _by_block(batches):
                if block != at:
                    unfinished(held)
                    at, state, held = block, rows.column(2)[0].as_py(), []
                    skipping = state != START
                for lines, plain in _stretches(rows.column(3)):
                    for i, line in enumerate(lines if plain else lines.to_pylist()):
                        if plain:
                            if state == START:
                                yield lines.slice(i)
                                break
                            line = line.as_py()
                        state = after(state, line)
                        if skipping:
                            skipping = state != START
                        elif held or state != START:
                            held.append(line)
                            if state == START:
                                yield b"\n".join(held)
                                held = []
                        else:
                            yield line
            unfinished(held)

        def unfinished(held):
            if ends and held:
                raise MalformedRecordError(f"a quoted value without an end: {held[0][:40]!r}")

        return _values(records(), width)

    return run


def _joined(width: int):
    """Values of records put together from their parts."""
    def run(batches):
        def records():
            for batch in batches:
                for record in batch.column(0).to_pylist():
                    if not _RECORD.fullmatch(record):
                        raise MalformedRecordError(f"a quoted value without an end: {record[:40]!r}")
                    yield record

        return _values(records(), width)

    return run


def _values(records: Iterator[bytes | pa.Array], width: int) -> Iterator[pa.RecordBatch]:
    """Values of records, or of stretches of simple lines."""
    names, held, size = [f"c{i}" for i in range(width)], [], 0
    for record in records:
        if isinstance(record, pa.Array):
            if held:
                yield pa.record_batch([pa.array(c, pa.binary()) for c in zip(*held)], names=names)
                held, size = [], 0
            yield _columns(record, width)
            continue
        row = fields(record)
        if len(row) != width:
            raise MalformedRecordError(f"{len(row)} values for {width} columns: {record[:40]!r}")
        held.append(row)
        size += len(record)
        if len(held) == ROWS or size > BYTES:
            yield pa.record_batch([pa.array(c, pa.binary()) for c in zip(*held)], names=names)
            held, size = [], 0
    if held:
        yield pa.record_batch([pa.array(c, pa.binary()) for c in zip(*held)], names=names)


def read_values(spark: SparkSession, path: str, width: int, multi_line: bool = True) -> DataFrame:
    """Binary columns ``c0`` to ``c<width - 1>`` of the records of TSV files, NULL where a value is the NULL mark.
    ``multi_line=False`` says that no value holds a newline, so blocks need not be read for how they begin."""
    kinds = ", ".join(f"c{i} binary" for i in range(width))
    lines = spark.read.option("lineSep", "\n").text(path).select(
        F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"),
        F.col("value").cast("binary").alias("line"))
    if not multi_line or lines.rdd.getNumPartitions() <= 1:
        return lines.select("file", "start", F.lit(START).alias("entry"), "line").mapInArrow(_cut(width, True), kinds)
    outcomes = _stored(lines.mapInArrow(_outcomes, OUTCOMES))
    order = ["file", "start", "entry"]
    begins = _stored(outcomes.select(*order, "exit").repartition("file").sortWithinPartitions(*order).mapInArrow(
        _chained, "file long, start long, entry int"))
    whole = _entered(lines, begins.filter(f"entry <> {START}"))
    parts = _parts(outcomes.join(begins, order, "left_semi"))
    return whole.mapInArrow(_cut(width), kinds).unionByName(parts.mapInArrow(_joined(width), kinds))


def _stored(df: DataFrame) -> DataFrame:
    path = f"{shared_dir(df.sparkSession)}/tsv/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _entered(lines: DataFrame, begins: DataFrame) -> DataFrame:
    """Lines with how their block begins, in order. Only blocks that begin inside a record are listed."""
    entry = F.coalesce("entry", F.lit(START)).alias("entry")
    if begins.count() <= BROADCAST_ROWS:
        return lines.join(F.broadcast(begins), ["file", "start"], "left").select("file", "start", entry, "line")
    placed = lines.withColumn("_line", F.monotonically_increasing_id())
    # By a hash, since a shuffle by the columns of the join below would be left out of the plan, and that of the join may be read in parts.
    joined = placed.join(begins, ["file", "start"], "left").repartition(F.xxhash64("file", "start")).sortWithinPartitions("file", "start", "_line")
    return joined.select("file", "start", entry, "line")


def _parts(blocks: DataFrame) -> DataFrame:
    """Records that lie in several blocks: a tail and the heads of the blocks after it, up to the next tail."""
    pieces = blocks.select("file", "start", F.posexplode(F.array("head", "tail")).alias("kind", "text")).filter("text IS NOT NULL")
    upto = Window.partitionBy("file").orderBy("start", "kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    told = pieces.withColumn("record", F.sum("kind").over(upto)).groupBy("file", "record").agg(
        F.array_sort(F.collect_list(F.struct("start", "kind", F.col("text").cast("string").alias("text")))).alias("pieces"))
    return told.select(F.array_join("pieces.text", "\n").cast("binary").alias("record"))
