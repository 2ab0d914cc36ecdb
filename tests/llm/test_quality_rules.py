"""Quality rules: measures against plain counts, the plan, and what the cascade keeps."""

import random

import pytest

from chunkspark.llm import quality_rules as rules
from chunkspark.llm.quality_rules import RULES, Rule, Step, Text
from chunkspark.session import read_table

TEXTS = [
    None, "", " \t\n", "one", "a b c d e f g h i j", "w " * 5000, "Some words make a clean line, and more words follow it here now.",
    "LOUD WORDS!! IN A LINE!! THAT GO ON!! FOR LONG ENOUGH!! TO COUNT!!", "a # b | c $ d % e & f * g < h > i", "x" * 400_000,
    "same line here\nsame line here\n\n \nother line now with words\nsame line here", "élève 你好 \U0001f600 1 2 3 4 5 6 7 8 9",
    "1 2 3 4 5 one two three four five 1 2 3 4 5 six seven eight nine ten", "a\x0bb\x0cc\x1cd\x85e　f", "words of a row " * 3 + "end",
]


def plain(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words by the book."""
    text = text or ""
    white = set(" \t\n\x0b\x0c\r")
    words, held = [], ""
    for c in text + " ":
        if c in white:
            words += [held] if held else []
            held = ""
        else:
            held += c
    lines = [line for line in text.split("\n") if set(line) - white]
    windows = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    often = {}
    for w in windows:
        often[w] = often.get(w, 0) + 1
    covered = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(5)}
    return [len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text),
            sum(line in lines[:i] for i, line in enumerate(lines)), len(covered)]


def test_measures_equal_plain_counts(spark):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(None, "one"), (3, "one")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = rules.judged(docs, measures=rules.SHOWN).collect()
    got = sorted((str(r.doc_id), [r[m] for m in rules.SHOWN]) for r in found)
    assert got == sorted((str(i), plain(t)) for i, t in rows)
    kept = {r.doc_id: r.kept for r in found}
    assert kept[6] and not any(kept[i] for i in (0, 1, 2, 3, 5, 7, 8, 9, 10, 11))


def test_repeats_in_random_words():
    draw = random.Random(5)
    for size, kinds in ((60, 3), (400, 12), (3000, 9000), (2000, 40), (7, 1), (4, 1)):
        words = [str(draw.randrange(kinds)).encode() for _ in range(size)]
        assert rules.repeat_words(words) == plain(b" ".join(words).decode())[4]


def test_order_changes_the_work_and_not_the_verdict(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents")
    steps = [Step(r, 0.0, 0.0) for r in RULES]
    ways = [{(r.doc_id, r.kept) for r in rules.judged(docs, steps=s).collect()} for s in (None, steps, steps[::-1])]
    assert ways[0] == ways[1] == ways[2]
    by_hand = {(r.doc_id, not any(rule(Text((r.text or "").encode())) for rule in RULES)) for r in docs.collect()}
    assert ways[0] == by_hand


def test_cheap_rules_that_reject_much_come_first():
    cheap, dear, idle = Rule("cheap", ("n_symbols",), bool), Rule("dear", ("n_repeat_words",), bool), Rule("idle", ("n_lines",), bool)
    at = {m: i + 1 for i, m in enumerate(rules.MEASURES)}

    def sample(masks):
        told = []
        for mask, texts in masks.items():
            totals = [0.0] * (len(rules.MEASURES) + 1)
            totals[0] = texts
            for m, seconds in (("n_symbols", 1), ("words", 2), ("n_repeat_words", 8), ("lines", 1), ("n_lines", 0)):
                totals[at[m]] = seconds * texts
            told.append((mask, totals))
        return told

    steps = rules.ordered((idle, dear, cheap), sample({0b000: 70, 0b010: 10, 0b110: 20}))
    assert [s.rule.name for s in steps] == ["cheap", "dear", "idle"]
    # What the first rule rejects does not come to the second; measures taken anyway cost nothing.
    assert [round(s.rejects, 3) for s in steps] == [0.2, 0.125, 0.0]
    assert [s.seconds for s in steps] == [1, 10, 1]
    assert rules.ordered((cheap, dear), sample({0b00: 5, 0b10: 4, 0b01: 1}), taken=("n_repeat_words",))[0].rule is dear


def test_later_rules_are_not_run():
    ran = []
    first = Rule("first", ("n_words",), lambda n: n < 2)
    second = Rule("second", ("n_words",), lambda n: ran.append(n) or False)
    assert rules.first_failure(Text(b"one"), (first, second)) == "first" and not ran
    assert rules.first_failure(Text(b"one two"), (first, second)) is None and ran == [2]


@pytest.mark.parametrize("rows", [0, 3])
def test_rows_keep_their_columns(spark, rows):
    clean = TEXTS[6]
    data = [(clean, "a", 1, [1]), (None, None, None, None), (clean, "a", 1, [1])][:rows]
    docs = spark.createDataFrame(data, "text string, words string, kept int, doc_id array<int>")
    back = rules.accepted(docs)
    assert back.columns == docs.columns
    assert [tuple(r) for r in back.collect()] == [(clean, "a", 1, [1])] * (2 if rows else 0)
    assert rules.judged(docs.selectExpr("1L AS doc_id", "text", "kept", "words AS failed"), measures=("n_words",)).count() == rows
