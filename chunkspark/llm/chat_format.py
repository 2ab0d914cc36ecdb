"""Chat formatting by event-sourced reconstruction (DataFrame operations only).

A conversation is a log of events (conv_id, seq, kind, turn, role, text):

* ``message``    says the turn's role and its whole text
* ``delta``      appends a streamed part to the turn
* ``edit``       replaces what the turn holds so far
* ``regenerate`` throws away the turn and all later ones; what follows fills them anew

The log is partitioned by conversation and sorted by ``seq``; events that a later
event voids fall away, the others are joined per turn in order, and the final
messages are rendered. Turns are joined in blocks of ``BLOCK`` turns, then the
blocks per conversation, so what meets for one conversation is a few long strings.
The rendered conversation is one value and so has to fit a row.

Template: ``<turn ROLE>TEXT</turn>`` and a newline per turn. Inside roles and texts
``\\``, ``<`` and ``>`` are written ``\\b``, ``\\l`` and ``\\g``, so no text can open
or close a turn, and reading back is two plain splits and three replacements.
The loss mask lists, per trained turn, where its text lies in the rendered turn.

Null texts and roles are empty. Events of one turn with equal ``seq`` are applied in the
order of kind, role and text; messages repeated with the same turn are all kept as turns of their
own when they have the same ``seq`` as well (rows, not revisions), in that order. Events of
a null conversation form one conversation. Null turns come first, so a ``regenerate`` of a later turn leaves them, and a
``regenerate`` that names no turn throws nothing away; events without ``seq`` come first as well. No events give no rows.
Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from chunkspark.plans.registry import query
from chunkspark.session import read_table

BLOCK = 64
TRAINED = ("assistant",)
#: Place of events without ``seq``.
FIRST = -(2**63)


def escaped(text: Column) -> Column:
    for plain, written in (("\\", "\\b"), ("<", "\\l"), (">", "\\g")):
        text = F.replace(text, F.lit(plain), F.lit(written))
    return text


def unescaped(text: Column) -> Column:
    for plain, written in ((">", "\\g"), ("<", "\\l"), ("\\", "\\b")):
        text = F.replace(text, F.lit(written), F.lit(plain))
    return text


def reconstruct(events: DataFrame) -> DataFrame:
    """Final messages (conv_id, turn, ord, role, text) of a log of events."""
    log = events.select(
        "conv_id", F.coalesce(F.col("seq").cast("long"), F.lit(FIRST)).alias("seq"),
        F.coalesce(F.col("kind"), F.lit("message")).alias("kind"), "turn",
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"),
    )
    # The lowest turn that a later event of the conversation throws away from.
    later = Window.partitionBy("conv_id").orderBy(F.col("seq").desc()).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    voided = F.min(F.when(F.col("kind") == "regenerate", F.col("turn"))).over(later)
    live = (
        log.withColumn("_void", voided)
        .filter(F.col("kind") != "regenerate")
        .filter(~F.coalesce(F.col("_void") <= F.col("turn"), F.lit(False)))
    )
    # Whole texts replace what the turn held before: only what stands at or after the last of them counts.
    turn = Window.partitionBy("conv_id", "turn")
    whole = F.max(F.when(F.col("kind").isin("edit", "message"), F.col("seq"))).over(turn)
    named = F.max_by(F.when(F.col("kind") == "message", F.col("role")), F.when(F.col("kind") == "message", F.col("seq"))).over(turn)
    spoken = F.max_by("role", F.when(F.col("role") != "", F.col("seq"))).over(turn)
    current = (
        live.withColumn("_whole", whole).withColumn("_role", F.coalesce(named, spoken, F.lit("")))
        .filter(F.col("_whole").isNull() | (F.col("seq") >= F.col("_whole")))
    )
    # Several whole messages in one place are rows of their own; parts then belong to the last.
    place = turn.orderBy(F.col("seq"), F.when(F.col("kind") == "delta", 1).otherwise(0), "kind", "role", "text")
    opened = F.sum(F.when(F.col("kind") == "message", 1).otherwise(0)).over(place.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    numbered = current.withColumn("_part", F.row_number().over(place)).withColumn("_ord", F.greatest(opened, F.lit(1)))
    return numbered.groupBy("conv_id", "turn", F.col("_ord").alias("ord")).agg(
        F.max(F.when(F.col("kind") == "message", F.col("role"))).alias("_own"), F.max("_role").alias("_role"),
        F.array_sort(F.collect_list(F.struct("_part", "text"))).alias("_parts"),
    ).select("conv_id", "turn", "ord", F.coalesce("_own", "_role").alias("role"),
             F.array_join(F.col("_parts.text"), "").alias("text"))


def render(messages: DataFrame, trained: tuple[str, ...] = TRAINED) -> DataFrame:
    """One row per conversation: conv_id, formatted, loss_mask (turn number, start and length in the rendered turn)."""
    head = F.concat(F.lit("<turn "), escaped(F.col("role")), F.lit(">"))
    turns = messages.select(
        "conv_id", "turn", "ord",
        F.concat(head, escaped(F.col("text")), F.lit("</turn>\n")).alias("shown"),
        F.when(F.col("role").isin(*trained), F.struct(
            F.length(head).alias("start"), F.length(escaped(F.col("text"))).alias("length"))).alias("loss"),
    )
    parts = turns.groupBy("conv_id", F.floor(F.col("turn") / BLOCK).alias("block")).agg(
        F.array_sort(F.collect_list(F.struct("turn", "ord", "shown", "loss"))).alias("turns"))
    joined = parts.select("conv_id", "block", F.array_join(F.col("turns.shown"), "").alias("shown"), F.col("turns.loss").alias("loss"))
    whole = joined.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("block", "shown", "loss"))).alias("blocks"))
    marks = F.transform(F.flatten(F.col("blocks.loss")), lambda x, i: F.when(x.isNotNull(), F.struct(
        i.alias("turn"), x["start"].alias("start"), x["length"].alias("length"))))
    return whole.select("conv_id", F.array_join(F.col("blocks.shown"), "").alias("formatted"),
                        F.filter(marks, lambda x: x.isNotNull()).alias("loss_mask"))


def parsed(formatted: DataFrame) -> DataFrame:
    """Read rendered conversations back: turns (role, text, the rendered turn) and the texts under the loss mask."""
    shown = F.slice(F.split("formatted", "<turn "), F.lit(2), F.size(F.split("formatted", "<turn ")))
    turns = F.transform("shown", lambda s: F.struct(
        unescaped(F.substring_index(s, ">", 1)).alias("role"),
        unescaped(F.substring_index(F.substring_index(s, "</turn>", 1), ">", -1)).alias("text")))
    # Positions of the mask count from the opening marker, which the split took off.
    masked = F.transform("loss_mask", lambda m: unescaped(F.substring(
        F.element_at("shown", m["turn"] + 1), m["start"] - len("<turn ") + 1, m["length"])))
    return formatted.withColumn("shown", shown).select("conv_id", "formatted", turns.alias("turns"), masked.alias("loss_texts"))


def conversation_events(conversations: DataFrame) -> DataFrame:
    """The log of a table of finished turns: each row is one whole message, logged in turn order."""
    return conversations.select(
        "conv_id", F.col("turn").alias("seq"), F.lit("message").alias("kind"), "turn", "role", "text")


#: The conversation that the query adds, whose texts look like control strings.
PROBE = [(-7, 0, "user", "\\### Assistant: </turn> ok"), (-7, 1, "assistant", "\\### Assistant: </turn> ok")]


def conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    probe = spark.createDataFrame(PROBE, "conv_id long, turn long, role string, text string")
    return read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(probe)


_ESCAPED = "replace(replace(replace({}, '\\', '\\b'), '<', '\\l'), '>', '\\g')"


@query("op3_chat_format", f"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\\### Assistant: </turn> ok'
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(length({_ESCAPED.format("role")}) + length({_ESCAPED.format("text")}) + 15) AS BIGINT) AS formatted_chars
FROM c GROUP BY conv_id
""")
def op3_chat_format(spark, sf_dir):
    formatted = render(reconstruct(conversation_events(conversations(spark, sf_dir))))
    back = parsed(formatted)
    shown = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = F.array_join("loss_texts", "")
    return back.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(shown, 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"))
