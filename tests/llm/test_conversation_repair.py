"""Conversation repair against a search over all edits, written the other way round."""

import hashlib
import random
import zlib
from functools import lru_cache

import pytest

from chunkspark.llm import conversation_repair as repair
from chunkspark.llm.survivors import Costs, Repair, Row

WHITE = set(" \t\n\x0b\x0c\r")
NEXT = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}


def cheapest(rows, costs=Costs()):
    """(cost, edits) from the end backwards; rows are (role, faulty, truncated)."""
    @lru_cache(None)
    def rest(i, state, put):
        ways = []
        if i == len(rows) and state in ("", "a"):
            ways.append((0, ""))
        if put < 3:
            cost, letters = rest(i, "a" if state == "u" else "u", put + 1)
            ways.append((cost + costs.insert, "I" + letters))
        if i < len(rows):
            role, faulty, truncated = rows[i]
            cost, letters = rest(i + 1, state, 0)
            ways.append((cost + costs.delete, "D" + letters))
            if not faulty:
                extra = costs.truncated * truncated
                to = NEXT.get((state, role[:1]))
                if to:
                    cost, letters = rest(i + 1, to, 0)
                    ways.append((cost + extra, "K" + letters))
                cost, letters = rest(i + 1, "a" if state == "u" else "u", 0)
                ways.append((cost + extra + costs.rerole, "R" + letters))
        return min(ways, default=(10**9, ""))

    return rest(0, "", 0)


def walked(rows, costs=Costs()):
    walk, out, most = Repair(costs), [], 0
    for row in rows:
        out += walk.push(Row(row[0], "", row[1], row[2]))
        most = max(most, walk.held())
    out += walk.finish()
    return (walk.cost, "".join(e[0] for e in out)), out, most


@pytest.mark.parametrize("costs", [Costs(), Costs(3, 2, 1, 0), Costs(0, 4, 1, 2), Costs(2, 0, 3, 1), Costs(1, 1, 1, 1), Costs(5, 9, 2, 0)])
def test_edits_are_the_cheapest_and_least(costs):
    draw = random.Random(11)
    for _ in range(1500):
        rows = [(draw.choice(("system", "user", "assistant", "user", "assistant", " ", "tool", "")), draw.random() < 0.15, draw.random() < 0.2)
                for _ in range(draw.randrange(9))]
        found, out, _ = walked(rows, costs)
        assert found == cheapest(tuple(rows), costs), rows
        initials = "".join(e[1][0] for e in out if e[0] != "D")
        body = initials[1:] if initials[:1] == "s" else initials
        assert body == "ua" * (len(body) // 2) and (body or not initials)


def test_what_is_held_is_what_is_in_dispute():
    turns = [("system", False, False)] + [("user", False, False), ("assistant", False, False)] * 20_000
    found, _, most = walked(turns)
    assert found == (0, "K" * 40_001) and most < 20
    # Two readings of equal cost all along: the first edit is told by the last row.
    for n in (2000, 2001):
        found, _, _ = walked([("tool", False, False)] * n)
        assert found == ((n, "R" * n) if n % 2 == 0 else (n + 1, "D" + "R" * (n - 1)))


def plain_rows(table):
    """Rows after damage by conversation, in order."""
    out = {}
    for conv, turn, role, text in table:
        out.setdefault(conv, [])
        role, text = " " if role is None else role, " " if text is None else text
        fate = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if fate == 0:
            continue
        text = "" if fate == 1 else "".join(c for c in text if c not in ".!?") if fate == 2 else text
        out[conv] += [(turn, "user" if fate == 4 else role, text)] * (2 if fate == 3 else 1)
    return {c: sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2])) for c, rows in out.items()}


def plain_summary(rows):
    turns = {t for t, _, _ in rows if t is not None}
    seen, faults = set(), []
    for _, role, text in rows:
        shown = [c for c in text if c not in WHITE]
        faults.append("blank" if not shown else "duplicate" if (role, text) in seen else "truncated" if shown[-1] not in ".!?" else "")
        seen.add((role, text))
    cost, audit = cheapest(tuple((r[1], f in ("blank", "duplicate"), f == "truncated") for r, f in zip(rows, faults)))
    shown, state, at = [], "", iter(rows)
    for letter in audit:
        row = None if letter == "I" else next(at)
        if letter == "D":
            continue
        role = row[1] if letter == "K" else "assistant" if state == "u" else "user"
        state = role[0]
        shown.append(f"{role}:{'' if row is None else row[2]}")
    initials = [r[1][:1] for r in rows]
    return (max(turns) - min(turns) + 1 - len(turns) if turns else 0, faults.count("blank"), faults.count("duplicate"), faults.count("truncated"),
            sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), cost, audit,
            hashlib.sha256("\n".join(shown).encode()).hexdigest())


SCHEMA = "conv_id long, turn long, role string, text string, cost string, fault int"


def test_summaries_equal_a_plain_repair(spark):
    draw = random.Random(3)
    texts = ["Yes.", "No", " \t", "", None, "What?", "a\nb!", "x" * 300_000 + ".", "Yes. \n", " ", "\x1c"]
    table = [(draw.choice([None, *range(60)]), draw.choice([None, 0, 1, 1, 2, 3, 4, 9]), draw.choice(["user", "assistant", "system", None, "", "tool"]),
              draw.choice(texts)) for _ in range(500)]
    table += [(77, t, "user", "same.") for t in range(120)] + [(78, 5, "assistant", "again.")] * 40
    rows = spark.createDataFrame([(*r, "clash", 1) for r in table], SCHEMA).repartition(5)
    found = {r[0]: tuple(r)[1:] for r in repair.summaries(repair.damaged(rows)).collect()}
    assert found == {c: plain_summary(rows) for c, rows in plain_rows(table).items()}


def test_dropped_conversations_stay_and_empty_tables_give_none(spark):
    conv = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    rows = spark.createDataFrame([(conv, 0, "user", "hi.", None, None)], SCHEMA)
    assert [tuple(r) for r in repair.summaries(repair.damaged(rows)).collect()] == [(conv, 0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest())]
    for made in (repair.summaries, repair.edits, repair.repaired):
        assert made(rows.filter("false")).collect() == []


def test_repaired_messages(spark):
    rows = spark.createDataFrame([
        (1, 0, "user", "Hi."), (1, 1, "user", "Hi."), (1, 2, "tool", "Yes."), (1, None, "system", "Be kind."), (2, 4, "assistant", "cut")],
        "conv_id long, turn long, role string, text string")
    edits = [tuple(r) for r in repair.edits(rows).orderBy("conv_id", "place").collect()]
    assert edits == [(1, 0, "K", "system", "Be kind."), (1, 1, "K", "user", "Hi."), (1, 2, "D", "user", "Hi."), (1, 3, "R", "assistant", "Yes."),
                     (2, 0, "D", "assistant", "cut")]
    back = [tuple(r) for r in repair.repaired(rows).orderBy("conv_id", "turn").collect()]
    assert back == [(1, 0, "system", "Be kind."), (1, 1, "user", "Hi."), (1, 2, "assistant", "Yes.")]
