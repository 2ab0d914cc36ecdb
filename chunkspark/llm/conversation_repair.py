"""Conversations with damaged structure, repaired by the cheapest edits.

The messages of a conversation, in the order of turn (nulls first; then role, text and place among equals), are walked once by the
survivor-coalescence Viterbi of ``survivors.py``. A message's first fault counts: blank (nothing but ASCII white space), duplicate
(role and text seen earlier in the conversation), truncated (does not end in ``.``, ``!`` or ``?``). Edits: keep (K), rerole to
user or assistant (R), delete (D, needed for blank and duplicate messages), insert an empty message (I).

Messages are shuffled once, by conversation; duplicates are told by a window on the same distribution, then rows are sorted by
turn and streamed through the walk, which holds the edits in dispute and their messages. A task hands on edits as they become final,
so a conversation of any length passes through bounded memory but for what is in dispute: with roles that leave two readings equally good all
along (say only ``system`` messages), that is the conversation. One conversation is one task's, since each edit hangs on those before.

Null roles and texts are one space, so a null text is blank. Rows of a null conversation form one. Repeated rows are duplicates. Empty
tables give no rows. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chunkspark.llm.common import bounded_batches
from chunkspark.llm.survivors import Costs, Repair, Row
from chunkspark.plans.registry import query
from chunkspark.session import read_table

# ASCII white space, and what a message ends with.
WHITE = " \t\n\x0b\x0c\r"
ENDS = ".!?"
#: Rows that one batch of edits holds.
ROWS = 4096
LEGAL = ("su", "ua", "au")


def damaged(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, dropped: rows as the query damages them. A dropped row stays, so that its conversation does."""
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.lit(":"), F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"), (F.crc32(key) % 20).alias("_fate"))
    fate = F.col("_fate")
    text = F.when(fate == 1, F.lit("")).when(fate == 2, F.translate("text", ENDS, "")).otherwise(F.col("text"))
    copies = F.explode(F.when(fate == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return rows.select(
        "conv_id", "turn", F.when(fate == 4, F.lit("user")).otherwise(F.col("role")).alias("role"), text.alias("text"),
        (fate == 0).alias("dropped"), copies.alias("_copy")).drop("_copy")


def in_order(messages: DataFrame) -> DataFrame:
    """Messages with their first fault (blank, duplicate, truncated or null), each conversation in order in one task."""
    bounded_batches(messages.sparkSession)
    last = F.right(F.rtrim(F.col("text"), F.lit(WHITE)), F.lit(1))
    again = F.row_number().over(Window.partitionBy("conv_id", "dropped", "role", "text").orderBy("turn")) > 1
    fault = (F.when(F.trim(F.col("text"), F.lit(WHITE)) == "", F.lit("blank")).when(F.col("_again"), F.lit("duplicate"))
             .when(~F.contains(F.lit(ENDS), last), F.lit("truncated")))
    placed = messages.repartition("conv_id").withColumn("_again", again)
    # Of equal rows of one turn, the one that counts as the first comes first.
    return placed.withColumn("fault", fault).sortWithinPartitions(
        F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), "role", "text", "_again",
    ).select("conv_id", "turn", "role", "text", "dropped", "fault")


class Walk:
    """One conversation: its counts, and its edits as they become final."""

    def __init__(self, costs: Costs):
        self.repair = Repair(costs)
        self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.first = self.last = None
        self.turns, self.ahead = 0, None

    def push(self, turn: int | None, role: str, text: str, fault: str | None) -> Iterator:
        if turn is not None and turn != self.last:
            self.first, self.last, self.turns = turn if self.first is None else self.first, turn, self.turns + 1
        self.blank += fault == "blank"
        self.duplicate += fault == "duplicate"
        self.truncated += fault == "truncated"
        if self.ahead is not None:
            self.illegal += self.ahead + role[:1] not in LEGAL
        self.ahead = role[:1]
        return self.repair.push(Row(role, text, fault in ("blank", "duplicate"), fault == "truncated"))

    @property
    def gaps(self) -> int:
        return 0 if self.first is None else self.last - self.first + 1 - self.turns


def _walked(batches: Iterator[pa.RecordBatch], costs: Costs) -> Iterator[tuple]:
    """(conv_id, walk, edit) per final edit, and (conv_id, walk, None) at the end of each conversation."""
    at, walk = None, None
    for batch in batches:
        for conv, turn, role, text, dropped, fault in zip(*[batch.column(i).to_pylist() for i in range(6)]):
            if walk is None or conv != at:
                if walk is not None:
                    yield from _ended(at, walk)
                at, walk = conv, Walk(costs)
            if not dropped:
                for edit in walk.push(turn, role, text, fault):
                    yield at, walk, edit
    if walk is not None:
        yield from _ended(at, walk)


def _ended(conv, walk: Walk) -> Iterator[tuple]:
    for edit in walk.repair.finish():
        yield conv, walk, edit
    yield conv, walk, None


def _edits(costs: Costs):
    names = ["conv_id", "place", "edit", "role", "text"]

    def run(batches):
        held, place, current = [], 0, None
        for conv, walk, edit in _walked(batches, costs):
            if edit is None:
                continue
            place, current = (place + 1, current) if walk is current else (0, walk)
            letter, role, row = edit
            held.append((conv, place, letter, row.role if letter == "D" else role, "" if row is None else row.text))
            if len(held) == ROWS:
                yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*held), KINDS)], names=names)
                held = []
        if held:
            yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*held), KINDS)], names=names)

    return run


KINDS = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string()]


def edits(messages: DataFrame, costs: Costs = Costs()) -> DataFrame:
    """All edits in order: conv_id, place, edit, role (as repaired; of a deleted message as it was) and text."""
    ready = messages if "dropped" in messages.columns else messages.withColumn("dropped", F.lit(False))
    return in_order(_filled(ready)).mapInArrow(_edits(costs), "conv_id long, place long, edit string, role string, text string")


def repaired(messages: DataFrame, costs: Costs = Costs()) -> DataFrame:
    """Repaired conversations: conv_id, turn (from 0), role, text."""
    kept = edits(messages, costs).filter("edit <> 'D'")
    order = Window.partitionBy("conv_id").orderBy("place")
    return kept.select("conv_id", (F.row_number().over(order) - 1).cast("long").alias("turn"), "role", "text")


def _filled(messages: DataFrame) -> DataFrame:
    return messages.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit(" ")).alias("role"),
        F.coalesce("text", F.lit(" ")).alias("text"), "dropped")


SUMMARY = pa.schema([("conv_id", pa.int64()), *[(c, pa.int64()) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
                     ("audit", pa.string()), ("repaired_sha256", pa.string())])


def _summaries(costs: Costs):
    def run(batches):
        rows, audit, digest, empty = [], [], hashlib.sha256(), True
        for conv, walk, edit in _walked(batches, costs):
            if edit is not None:
                letter, role, row = edit
                audit.append(letter)
                if letter != "D":
                    digest.update(f"{'' if empty else chr(10)}{role}:{'' if row is None else row.text}".encode())
                    empty = False
                continue
            rows.append((conv, walk.gaps, walk.blank, walk.duplicate, walk.truncated, walk.illegal, walk.repair.cost,
                         "".join(audit), digest.hexdigest()))
            audit, digest, empty = [], hashlib.sha256(), True
            if len(rows) == ROWS:
                yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*rows), SUMMARY)], schema=SUMMARY)
                rows = []
        if rows:
            yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*rows), SUMMARY)], schema=SUMMARY)

    return run


def summaries(messages: DataFrame, costs: Costs = Costs()) -> DataFrame:
    """One row per conversation: its faults, and the cost, the letters and the digest of its repair."""
    ready = messages if "dropped" in messages.columns else messages.withColumn("dropped", F.lit(False))
    return in_order(_filled(ready)).mapInArrow(_summaries(costs), (
        "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"))


@query("op12_conversation_repair", """
WITH RECURSIVE keyed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    list_transform(string_split(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), ''),
      lambda c: CAST(unicode(c) AS BIGINT)) AS codes FROM conversations),
fated AS (
  SELECT *, xor(list_reduce(list_prepend(4294967295, codes), lambda c, x: list_reduce(
    list_prepend(xor(c, x), [CAST(0 AS BIGINT) FOR z IN range(8)]), lambda v, z: xor(v >> 1, 3988292384 * (v & 1)))), 4294967295) % 20 AS fate
  FROM keyed),
hurt AS (
  SELECT conv_id, turn, CASE WHEN fate = 4 THEN 'user' ELSE role END AS role,
    CASE fate WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(CASE WHEN fate = 3 THEN [0, 1] ELSE [0] END) AS copy FROM fated WHERE fate <> 0),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i,
    row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS seen,
    regexp_extract_all(text, '[^\x20\x09-\x0D]') AS shown FROM hurt),
faults AS (
  SELECT conv_id, turn, role, text, i, left(role, 1) AS ini, lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS ahead,
    CASE WHEN len(shown) = 0 THEN 'blank' WHEN seen > 1 THEN 'duplicate' WHEN shown[-1] NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault
  FROM placed),
counted AS (
  SELECT conv_id, CASE WHEN count(turn) = 0 THEN 0 ELSE max(turn) - min(turn) + 1 - count(DISTINCT turn) END AS gaps,
    count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
    count(*) FILTER (ahead || ini NOT IN ('su', 'ua', 'au')) AS illegal, max(i) AS n FROM faults GROUP BY conv_id),
inserted(st, mid, c, a, o) AS (VALUES ('e', 'e', 0, '', []), ('s', 's', 0, '', []), ('u', 'u', 0, '', []), ('d', 'd', 0, '', []),
  ('e', 'u', 5, 'I', ['user:']), ('s', 'u', 5, 'I', ['user:']), ('d', 'u', 5, 'I', ['user:']), ('u', 'd', 5, 'I', ['assistant:']),
  ('e', 'd', 10, 'II', ['user:', 'assistant:']), ('s', 'd', 10, 'II', ['user:', 'assistant:'])),
taken(st, ini, nxt) AS (VALUES ('e', 's', 's'), ('e', 'u', 'u'), ('s', 'u', 'u'), ('u', 'a', 'd'), ('d', 'u', 'u')),
walk AS (
  SELECT conv_id, CAST(0 AS BIGINT) AS i, 'e' AS st, 0 AS cost, '' AS audit, CAST([] AS VARCHAR[]) AS shown FROM counted
  UNION ALL
  SELECT conv_id, i, st, cost, audit, shown FROM (
    SELECT *, row_number() OVER (PARTITION BY conv_id, st ORDER BY cost, audit) AS best FROM (
      SELECT w.conv_id, f.i, unnest([
          struct_pack(st := s.mid, cost := w.cost + s.c + 2, audit := w.audit || s.a || 'D', shown := w.shown || s.o),
          CASE WHEN f.fault NOT IN ('blank', 'duplicate') AND t.nxt IS NOT NULL THEN
            struct_pack(st := t.nxt, cost := w.cost + s.c + CASE WHEN f.fault = 'truncated' THEN 5 ELSE 0 END,
              audit := w.audit || s.a || 'K', shown := w.shown || s.o || [f.role || ':' || f.text]) END,
          CASE WHEN f.fault NOT IN ('blank', 'duplicate') THEN
            struct_pack(st := CASE s.mid WHEN 'u' THEN 'd' ELSE 'u' END, cost := w.cost + s.c + CASE WHEN f.fault = 'truncated' THEN 6 ELSE 1 END,
              audit := w.audit || s.a || 'R', shown := w.shown || s.o || [CASE s.mid WHEN 'u' THEN 'assistant:' ELSE 'user:' END || f.text]) END
        ], recursive := true)
      FROM walk w JOIN inserted s ON s.st = w.st JOIN faults f ON f.conv_id IS NOT DISTINCT FROM w.conv_id AND f.i = w.i + 1
      LEFT JOIN taken t ON t.st = s.mid AND t.ini = f.ini) WHERE st IS NOT NULL) WHERE best = 1),
ended AS (
  SELECT w.conv_id, w.cost + s.c AS cost, w.audit || s.a AS audit, w.shown || s.o AS shown,
    row_number() OVER (PARTITION BY w.conv_id ORDER BY w.cost + s.c, w.audit || s.a) AS best
  FROM walk w JOIN counted c ON c.conv_id IS NOT DISTINCT FROM w.conv_id AND c.n = w.i JOIN inserted s ON s.st = w.st AND s.mid IN ('e', 'd'))
SELECT a.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
  coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, CAST(coalesce(cost, 0) AS BIGINT) AS cost, coalesce(audit, '') AS audit,
  sha256(coalesce(array_to_string(shown, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) a LEFT JOIN counted c ON c.conv_id IS NOT DISTINCT FROM a.conv_id
LEFT JOIN ended e ON e.conv_id IS NOT DISTINCT FROM a.conv_id AND e.best = 1
""")
def op12_conversation_repair(spark, sf_dir):
    return summaries(damaged(read_table(spark, sf_dir, "conversations")))
