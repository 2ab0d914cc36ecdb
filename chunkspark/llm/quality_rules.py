"""Quality rules as a short-circuit cascade.

A rule reads measures of one text and fails it or not; a text is kept when no rule fails it. Which rules run, and in
what order, is planned from a sample: every task takes the first ``SAMPLE`` rows of its input, runs all rules on them,
and states how long each measure took and which rules failed together. The totals (a row per set of rules that failed
together, 2 ** number of rules at most) give the plan: next comes the rule that rejects most of the texts left per
second, where measures that an earlier rule has taken cost nothing any more. The cascade then runs over all rows and
stops at a text's first failure. The plan decides how long that takes, never what is kept.

Words are what lies between ASCII white space, lines what lies between ``\\n``. Null texts have no words, like empty
ones; few words is a failure, so neither is kept. Texts of any length are read whole. Rows stand for themselves, so repeated
rows and null ids are judged like any others; no rows give no rows. Columns besides the text and the id play no part.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chunkspark.llm.common import documents, narrowed
from chunkspark.plans.registry import query

#: Rows of each task's input that the plan is made from.
SAMPLE = 200
#: Words of a window whose repetition counts.
WINDOW = 5
# Characters that count as symbols, and the white space that parts words.
SYMBOLS = b"#*$%&|<>"
WHITE = b" \t\n\x0b\x0c\r"
_CAPITALS, _SMALL = bytes(range(65, 91)), bytes(range(97, 123))
_LETTERS = _CAPITALS + _SMALL + bytes(range(128, 256))
_NO_LETTERS = bytes(set(range(256)) - set(_LETTERS) - set(WHITE))


class Text:
    """Measures of one text, each taken when first asked for."""

    def __init__(self, raw: bytes):
        self.raw = raw

    @cached_property
    def words(self) -> list[bytes]:
        return self.raw.split()

    @cached_property
    def n_words(self) -> int:
        return len(self.words)

    @cached_property
    def word_chars(self) -> int:
        """Code points in words."""
        return len(self.raw.translate(None, WHITE).decode("utf-8", "replace"))

    @cached_property
    def n_symbols(self) -> int:
        return len(self.raw) - len(self.raw.translate(None, SYMBOLS))

    @cached_property
    def lines(self) -> list[bytes]:
        """Lines with a word."""
        return [line for line in self.raw.split(b"\n") if line.strip()]

    @cached_property
    def n_lines(self) -> int:
        return len(self.lines)

    @cached_property
    def n_dup_lines(self) -> int:
        return len(self.lines) - len(set(self.lines))

    @cached_property
    def n_repeat_words(self) -> int:
        return repeat_words(self.words)

    @cached_property
    def n_letter_words(self) -> int:
        """Words with an ASCII letter or a character beyond ASCII."""
        return len(self.raw.translate(None, _NO_LETTERS).split())

    @cached_property
    def n_capitals(self) -> int:
        return len(self.raw) - len(self.raw.translate(None, _CAPITALS))

    @cached_property
    def n_ascii_letters(self) -> int:
        return len(self.raw) - len(self.raw.translate(None, _CAPITALS + _SMALL))


#: Measures in an order in which each comes after those it uses.
MEASURES = ("words", "n_words", "word_chars", "n_symbols", "lines", "n_lines", "n_dup_lines", "n_letter_words", "n_capitals",
            "n_ascii_letters", "n_repeat_words")
USES = {"n_words": ("words",), "n_lines": ("lines",), "n_dup_lines": ("lines",), "n_repeat_words": ("words",)}


def repeat_words(words: list[bytes], width: int = WINDOW) -> int:
    """Words in windows of ``width`` words that the text holds twice or more."""
    count = len(words) - width + 1
    if count < 2:
        return 0
    names: dict[bytes, int] = {}
    ids = np.fromiter((names.setdefault(w, len(names)) for w in words), dtype=np.int64, count=len(words))
    if len(names) == len(words):
        return 0
    # Numbers of windows of one word, two words and so on: equal numbers mean equal words.
    rank, kinds = ids, len(names)
    for more in range(1, width):
        rank = rank[:-1] * len(names) + ids[more:]
        # Before a number outgrows its 64 bits, numbers are dealt anew, densely.
        if (kinds := kinds * len(names)) > (1 << 62) // len(names):
            held, rank = np.unique(rank, return_inverse=True)
            kinds = len(held)
    _, at, often = np.unique(rank, return_inverse=True, return_counts=True)
    marks = np.zeros(len(words) + 1, dtype=np.int64)
    start = np.flatnonzero(often[at] > 1)
    np.add.at(marks, start, 1)
    np.add.at(marks, start + width, -1)
    return int(np.count_nonzero(np.cumsum(marks) > 0))


@dataclass(frozen=True)
class Rule:
    """Fails a text by some of its measures."""

    name: str
    measures: tuple[str, ...]
    fails: Callable[..., bool]

    def __call__(self, text: Text) -> bool:
        return self.fails(*[getattr(text, m) for m in self.measures])

    def needs(self) -> set[str]:
        return closed(self.measures)


def closed(measures: Iterable[str]) -> set[str]:
    """The measures and those they use."""
    return {m for name in measures for m in (name, *USES.get(name, ()))}


FEW_WORDS = Rule("few_words", ("n_words",), lambda n: n < 10)
REPEATS = Rule("repeats", ("n_words", "n_repeat_words"), lambda n, r: 100 * r > 20 * n)
RULES = (
    FEW_WORDS,
    REPEATS,
    Rule("word_length", ("n_words", "word_chars"), lambda n, c: not 3 * n <= c <= 10 * n),
    Rule("symbols", ("n_words", "n_symbols"), lambda n, s: 10 * s > n),
    Rule("dup_lines", ("n_lines", "n_dup_lines"), lambda n, d: 100 * d > 30 * n),
    Rule("letters", ("n_words", "n_letter_words"), lambda n, w: 100 * w < 80 * n),
    Rule("capitals", ("n_ascii_letters", "n_capitals"), lambda n, c: 2 * c > n),
)


# ---- the plan ----------------------------------------------------------------

def _sampled(rules: tuple[Rule, ...], rows: int):
    def run(batches):
        left, masks = rows, {}
        for batch in batches:
            for raw in batch.column("text").slice(0, left):
                text, seconds = Text(raw.as_py()), []
                for measure in MEASURES:
                    start = time.perf_counter()
                    getattr(text, measure)
                    seconds.append(time.perf_counter() - start)
                mask = sum(1 << i for i, rule in enumerate(rules) if rule(text))
                total = masks.setdefault(mask, np.zeros(len(MEASURES) + 1))
                total += [1, *seconds]
            left -= min(left, batch.num_rows)
            if not left:
                break
        if masks:
            yield pa.record_batch([pa.array(list(masks)), pa.array([t.tolist() for t in masks.values()])], names=["mask", "totals"])

    return run


def sampled(docs: DataFrame, rules: tuple[Rule, ...] = RULES, rows: int = SAMPLE) -> list[tuple[int, np.ndarray]]:
    """Sets of rules that fail together, as bits, with the number of texts and the seconds of each measure."""
    told = narrowed_text(docs).mapInArrow(_sampled(rules, rows), "mask long, totals array<double>")
    sums = [F.sum(F.col("totals")[i]).alias(f"t{i}") for i in range(len(MEASURES) + 1)]
    return [(r[0], np.array(r[1:], dtype=float)) for r in told.groupBy("mask").agg(*sums).collect()]


@dataclass(frozen=True)
class Step:
    """A rule in its place: its cost there in seconds a text, and the share of the texts that come to it that it rejects."""

    rule: Rule
    seconds: float
    rejects: float


def ordered(rules: tuple[Rule, ...], sample: list[tuple[int, np.ndarray]], taken: Iterable[str] = ()) -> list[Step]:
    """Rules by rejection per cost. Measures in ``taken`` are had anyway; a rule that rejects nothing comes last."""
    texts = sum(t[0] for _, t in sample) or 1.0
    cost = {m: sum(t[1 + i] for _, t in sample) / texts for i, m in enumerate(MEASURES)}
    left, had, steps = list(sample), closed(taken), []
    rest = dict(enumerate(rules))
    while rest:
        coming = sum(t[0] for _, t in left)
        told = {}
        for i, rule in rest.items():
            seconds = sum(cost[m] for m in rule.needs() - had)
            rejects = sum(t[0] for mask, t in left if mask >> i & 1) / coming if coming else 0.0
            told[i] = Step(rule, seconds, rejects)
        best = max(told, key=lambda i: (told[i].rejects / (told[i].seconds + 1e-9), -told[i].seconds, -i))
        steps.append(told[best])
        had |= rest.pop(best).needs()
        left = [(mask, t) for mask, t in left if not mask >> best & 1]
    return steps


def plan(docs: DataFrame, rules: tuple[Rule, ...] = RULES, taken: Iterable[str] = ()) -> list[Step]:
    return ordered(rules, sampled(docs, rules), taken)


# ---- the cascade -------------------------------------------------------------

def first_failure(text: Text, rules: Iterable[Rule]) -> str | None:
    """Name of the first rule that fails the text; later ones are not run."""
    return next((rule.name for rule in rules if rule(text)), None)


def narrowed_text(docs: DataFrame, text: str = "text") -> DataFrame:
    return narrowed(docs.select(F.lit(None).alias("doc_id"), F.col(f"`{text}`").alias("text"))).select("text")


def judged(docs: DataFrame, rules: tuple[Rule, ...] = RULES, measures: tuple[str, ...] = (), doc_id: str = "doc_id",
           text: str = "text", steps: list[Step] | None = None) -> DataFrame:
    """One row per document: doc_id, the ``measures`` (taken of every text), failed (the first failing rule in the
    order of the plan, null if kept) and kept."""
    rows = narrowed(docs, doc_id, text)
    order = [s.rule for s in (plan(rows, rules, measures) if steps is None else steps)]
    names = ["doc_id", *measures, "failed", "kept"]

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            told, failed = [], []
            for raw in batch.column("text"):
                at = Text(raw.as_py())
                failed.append(first_failure(at, order))
                told.append([getattr(at, m) for m in measures])
            columns = [pa.array([t[i] for t in told], pa.int64()) for i in range(len(measures))]
            yield pa.record_batch([batch.column("doc_id"), *columns, pa.array(failed, pa.string()),
                                   pa.array([f is None for f in failed], pa.bool_())], names=names)

    kinds = ", ".join(["doc_id long", *[f"{m} long" for m in measures], "failed string", "kept boolean"])
    return rows.mapInArrow(run, kinds)


def accepted(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = "text", steps: list[Step] | None = None) -> DataFrame:
    """The rows of ``docs`` that no rule fails, with all their columns."""
    order = [s.rule for s in (plan(narrowed_text(docs, text), rules) if steps is None else steps)]
    named = docs.toDF(*[f"_c{i}" for i in range(len(docs.columns))])
    at = docs.columns.index(text)

    def run(batches):
        for batch in batches:
            raw = batch.column(at).cast(pa.binary())
            yield batch.filter(pa.array([first_failure(Text(t.as_py() or b""), order) is None for t in raw], pa.bool_()))

    return named.mapInArrow(run, named.schema).toDF(*docs.columns)


#: Measures that the query shows of every document.
SHOWN = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


@query("op11_quality_rules", r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT r, doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws,
  list_filter(string_split(t, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines FROM d),
placed AS (SELECT r, unnest(ws) AS word, generate_subscripts(ws, 1) AS i FROM w),
windows AS (SELECT r, i, concat_ws(' ', word, lead(word, 1) OVER o, lead(word, 2) OVER o, lead(word, 3) OVER o, lead(word, 4) OVER o) AS five,
  lead(i, 4) OVER o AS last FROM placed WINDOW o AS (PARTITION BY r ORDER BY i)),
counted AS (SELECT r, i, count(*) OVER (PARTITION BY r, five) AS n FROM windows WHERE last IS NOT NULL),
repeated AS (SELECT r, count(DISTINCT i + k) AS n_repeat FROM counted, (SELECT unnest(range(5)) AS k) WHERE n > 1 GROUP BY r),
m AS (SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(length(array_to_string(ws, '')) AS BIGINT) AS word_chars,
  CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
  CAST(len(lines) AS BIGINT) AS n_lines, CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
  CAST(coalesce(n_repeat, 0) AS BIGINT) AS n_repeat_words,
  len(list_filter(ws, lambda x: regexp_matches(x, '[A-Za-z\x{80}-\x{10FFFF}]'))) AS n_letter_words,
  length(t) - length(regexp_replace(t, '[A-Z]', '', 'g')) AS n_capitals,
  length(t) - length(regexp_replace(t, '[A-Za-z]', '', 'g')) AS n_ascii_letters
  FROM w LEFT JOIN repeated USING (r)),
b AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND word_chars BETWEEN 3 * n_words AND 10 * n_words AND 10 * n_symbols <= n_words
  AND 100 * n_dup_lines <= 30 * n_lines AND 100 * n_letter_words >= 80 * n_words AND 2 * n_capitals <= n_ascii_letters AS kept
FROM b
""")
def op11_quality_rules(spark, sf_dir):
    told = judged(documents(spark, sf_dir), measures=SHOWN)
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return told.select("doc_id", *SHOWN, failed.alias("base_failed"), "kept")
