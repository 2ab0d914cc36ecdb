"""Spelling variants against a plain comparison of all words."""

import random
import re
import zlib
from collections import Counter

import numpy as np

from chunkspark.llm import spelling_variants as spelling


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def plain(rows, misspell):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            mark = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if misspell and mark % 31 == 0:
                run = run[:mark % len(run)] + run[mark % len(run) + 1:]
            counts[run] += 1
    vocab = {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}
    told = {}
    for w, n in vocab.items():
        found = [v for v in vocab if near(w, v)]
        best = min(found, key=lambda v: (-vocab[v], v), default=None)
        told[w] = (n, len(found), best if best and vocab[best] >= 10 * n else None)
    rows = []
    for w, (n, count, form) in told.items():
        root = w
        while told[root][2]:
            root = told[root][2]
        rows.append((w, form, root, n, count, vocab[form] if form else None))
    return sorted(rows, key=str)


def found(spark, rows, misspell):
    docs = spark.createDataFrame([(i, t, 7, "x") for i, t in rows], "doc_id long, text string, n int, word string").repartition(4)
    told = spelling.variants(spelling.vocabulary(docs, misspell=misspell))
    return sorted((tuple(r) for r in told.select("word", "form", "root", "n", "n_near", "form_n").collect()), key=str)


def test_equals_a_comparison_of_all_words(spark):
    draw = random.Random(9)
    stems = ["running", "réunion", "letters", "abababab", "aaaaaaaa", "×÷Ééÿàá", "zzzzzzzzzzzz"]
    words = []
    for stem in stems:
        words += [stem] * 200
        for often in (20, 2, 2, 2):
            for _ in range(4):
                w = list(draw.choice(words[-200:]))
                at = draw.randrange(len(w))
                kind = draw.randrange(3)
                w[at:at + (kind != 1)] = [] if kind == 0 else [draw.choice("abzé")]
                words += ["".join(w)] * often
    draw.shuffle(words)
    rows = [(i % 90, " ".join(words[i:i + 12]) + draw.choice([" ", "你", "1", "Ā", "̀", "_"]) + "TheEnds") for i in range(0, len(words), 12)]
    rows += [(None, "Letters LETTERS, letterß"), (None, None), (5, ""), (5, "letters running"), (5, "letters running"), (6, "q" * 30_000 + " " + "q" * 29_999)] * 2
    for misspell in (False, True):
        got = found(spark, rows, misspell)
        assert got == plain(rows, misspell)
        assert any(r[1] and r[2] != r[1] for r in got) and any(r[4] > 3 for r in got)


def test_empty_tables_and_texts_without_words(spark):
    assert found(spark, [], True) == []
    assert found(spark, [(1, None), (2, ""), (3, "short words only here")], True) == []


def test_neighbourhoods_hold_every_edit():
    draw = np.random.default_rng(1)
    for size in (1, 2, 7, 12):
        symbols = draw.integers(0, spelling.SYMBOLS, size=(3, size)).astype(np.uint64)
        made = [np.concatenate([m for m in spelling.neighbourhoods(symbols)], axis=1)]
        for row in range(3):
            word, want = symbols[row].tolist(), set()
            edits = [word] + [word[:i] + word[i + 1:] for i in range(size)] + [word[:i] + [v] + word[i + 1:] for i in range(size) for v in range(8)]
            edits += [word[:i] + [v] + word[i:] for i in range(size + 1) for v in range(8)]
            for e in edits:
                at = np.array([e], dtype=np.uint64).reshape(1, len(e))
                want.add(int(spelling.prefixes(at, spelling.powers(len(e) + 1))[0, -1]))
            assert {int(v) for v in made[0][row]} == want


def test_long_words_in_pieces(monkeypatch):
    symbols = np.arange(50, dtype=np.uint64).reshape(1, 50) % np.uint64(spelling.SYMBOLS)
    whole = {int(v) for m in spelling.neighbourhoods(symbols) for v in m.ravel()}
    monkeypatch.setattr(spelling, "MADE", 100)
    assert {int(v) for m in spelling.neighbourhoods(symbols) for v in m.ravel()} == whole
