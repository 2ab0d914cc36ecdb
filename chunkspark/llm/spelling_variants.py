"""Spelling variants of words, found through a reduced alphabet.

1. Every task counts the words of its texts; the counts are summed, words seen often enough are the vocabulary.
2. Letters are hashed to ``SYMBOLS`` symbols. One edit of a word is at most one edit of its reduced word, so two words that are near
   have reduced words that are equal or near.
3. From every word the full one-edit neighbourhood of its reduced word is generated: the reduced word itself, all replacements,
   deletions and insertions of a symbol. Neighbours are told by 64-bit fingerprints, made of the reduced word's own in a few array operations.
   A map of the reduced vocabulary, of fixed size, drops those that no word has before anything is shuffled.
4. What is left is joined with the reduced vocabulary, and every pair is verified on the original strings by their edit distance, so
   neither collisions of letters nor of fingerprints show in the result. Each word meets each of its near words once, since a
   near word has one reduced word and each word's neighbours are distinct.
5. A word's form is its most frequent near word, if that is ``RATIO`` times as frequent. Frequencies grow along forms, so they
   lead to a root in at most log(largest count) steps, which pointer doubling takes in a few joins.

A word has at most some hundred near words a letter, so no word gathers more than that. Words of one reduced word meet in one key of the join; the join is
sort-merge, and adaptive execution splits keys that are far larger than others.

Null and empty texts have no words. A null doc_id reads as an empty one. Rows repeated with the same id and text count each time.
Words of any length are taken. Empty tables give no rows. Other columns are not read.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chunkspark.llm.common import documents, narrowed, stored
from chunkspark.llm.count_filter import Shared, shared_keys
from chunkspark.plans.registry import query

SYMBOLS = 8
#: Cells of the map of reduced words: 8 MB.
BITS = 26
#: Code points and occurrences that make a word, and how much more frequent a form is.
LENGTH, COUNT, RATIO = 7, 2, 10
#: One run in so many is misspelt by the query.
DAMAGE = 31
#: Distinct words that a task counts before it hands them on, and fingerprints it makes at once.
HELD, MADE = 200_000, 1 << 20

#: Latin-1 bytes of the runs: letters as they are but for A-Z in lower case, all else as blanks.
RUNS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 0xC0 else 32 for b in range(256))

BASE = np.uint64(0x9E3779B97F4A7C15)
BACK = np.uint64(pow(int(BASE), -1, 1 << 64))
VALUES = np.random.default_rng(13).integers(1, 1 << 63, size=SYMBOLS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


# ---- the vocabulary ----------------------------------------------------------

def damaged(run: bytes, prefix: int) -> bytes:
    """A Latin-1 run, one in ``DAMAGE`` without a letter; ``prefix`` is the CRC of what comes before it in the key."""
    mark = zlib.crc32(run if run.isascii() else run.decode("latin-1").encode(), prefix)
    if mark % DAMAGE:
        return run
    at = mark % len(run)
    return run[:at] + run[at + 1:]


def _counted(length: int, misspell: bool):
    def handed(counts: Counter) -> pa.RecordBatch:
        words = pa.array([w.decode("latin-1") for w in counts], pa.string())
        return pa.record_batch([words, pa.array(list(counts.values()), pa.int64())], names=["word", "n"])

    def run(batches):
        held: Counter = Counter()
        for batch in batches:
            for doc_id, raw in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                prefix = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
                # Characters that Latin-1 lacks end a run.
                text = raw.as_py().decode("utf-8", "replace").encode("latin-1", "replace").translate(RUNS)
                for word, n in Counter(w for w in text.split() if len(w) >= length).items():
                    word = damaged(word, prefix) if misspell else word
                    if len(word) >= length:
                        held[word] += n
                if len(held) > HELD:
                    yield handed(held)
                    held = Counter()
        if held:
            yield handed(held)

    return run


def vocabulary(docs: DataFrame, length: int = LENGTH, count: int = COUNT, misspell: bool = False, doc_id: str = "doc_id",
               text: str = "text") -> DataFrame:
    """word and n of the letter runs (A-Z in lower case) of at least ``length`` letters that occur ``count`` times."""
    found = narrowed(docs, doc_id, text).mapInArrow(_counted(length, misspell), "word string, n long")
    return found.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= count)


# ---- reduced words -----------------------------------------------------------

def reduced(words: np.ndarray) -> np.ndarray:
    """Symbols of code points."""
    return ((words.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(40)) % np.uint64(SYMBOLS)


def powers(size: int) -> np.ndarray:
    steps = np.full(size, BASE, dtype=np.uint64)
    steps[0] = 1
    return np.multiply.accumulate(steps)


def prefixes(symbols: np.ndarray, power: np.ndarray) -> np.ndarray:
    """Fingerprints of all prefixes of each row of symbols, the empty one first."""
    out = np.zeros((len(symbols), symbols.shape[1] + 1), dtype=np.uint64)
    np.cumsum(VALUES[symbols] * power[None, : symbols.shape[1]], axis=1, out=out[:, 1:])
    return out


def neighbourhoods(symbols: np.ndarray):
    """Fingerprints of the reduced words (rows of equal length) and of all that one edit makes of them, some positions at a time."""
    rows, size = symbols.shape
    power = powers(size + 1)
    upto = prefixes(symbols, power)
    whole = upto[:, -1:]
    yield whole
    step = max(1, MADE // (rows * (2 * SYMBOLS + 1)))
    for a in range(0, size + 1, step):
        b = min(a + step, size)
        here, at = symbols[:, a:b], power[None, a:b]
        yield upto[:, a:b] + (whole - upto[:, a + 1: b + 1]) * BACK
        yield (whole[:, :, None] + (VALUES[None, None, :] - VALUES[here][:, :, None]) * at[:, :, None]).reshape(rows, -1)
        # One more place to insert than there are letters.
        places = slice(a, min(a + step, size + 1))
        yield ((upto[:, places] + (whole - upto[:, places]) * BASE)[:, :, None]
               + VALUES[None, None, :] * power[None, places, None]).reshape(rows, -1)


def by_length(batch: pa.RecordBatch):
    """Rows of a batch with words of equal length, and these as a table of code points; long words come a few at a time."""
    words = batch.column("word").to_pylist()
    sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    for size in np.unique(sizes):
        at = np.flatnonzero(sizes == size)
        for some in np.array_split(at, -(-len(at) * int(size) * 2 * SYMBOLS // MADE)):
            letters = np.frombuffer("".join([words[i] for i in some]).encode("utf-32-le"), dtype="<u4")
            yield some, letters.reshape(len(some), size)


def _keyed(batches):
    for batch in batches:
        keys = np.zeros(batch.num_rows, dtype=np.uint64)
        for at, letters in by_length(batch):
            symbols = reduced(letters)
            keys[at] = prefixes(symbols, powers(letters.shape[1] + 1))[:, -1]
        yield pa.record_batch([*batch.columns, pa.array(keys.view(np.int64))], names=["word", "n", "key"])


def _near(shared: Shared):
    def run(batches):
        for batch in batches:
            for at, letters in by_length(batch):
                rows, keys = [], []
                for made in neighbourhoods(reduced(letters)):
                    row, column = np.nonzero(shared.test(made.ravel()).reshape(made.shape))
                    rows.append(row)
                    keys.append(made[row, column])
                found = np.unique(np.stack([np.concatenate(rows).astype(np.uint64), np.concatenate(keys)]), axis=1)
                words = batch.column("word").take(pa.array(at[found[0].astype(np.int64)]))
                yield pa.record_batch([words, pa.array(found[1].view(np.int64))], names=["word", "key"])

    return run


def near_words(vocab: DataFrame) -> DataFrame:
    """Pairs (word, near, near_n) of words one edit apart, each seen from both sides."""
    keyed = stored(vocab.mapInArrow(_keyed, "word string, n long, key long"), "reduced")

    def keys(batch):
        yield np.asarray(batch.column("key"), dtype=np.int64).view(np.uint64)

    shared = shared_keys(keyed, keys, BITS, times=2)
    wanted = keyed.select("word").mapInArrow(_near(shared), "word string, key long")
    held = keyed.select("key", F.col("word").alias("near"), F.col("n").alias("near_n"))
    return wanted.join(held, "key").filter((F.col("word") != F.col("near")) & (F.levenshtein("word", "near", 1) == 1)).drop("key")


# ---- forms and roots ---------------------------------------------------------

def roots(forms: DataFrame, largest: int, ratio: int = RATIO) -> DataFrame:
    """word and root: where following (word, form) ends. ``largest`` is the largest count, ``ratio`` the least growth along a form."""
    steps = max(1, math.ceil(math.log(max(largest, 2), ratio)))
    up = forms.select("word", F.col("form").alias("root"))
    for _ in range(math.ceil(math.log2(steps)) if steps > 1 else 0):
        further = up.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        up = stored(up.join(further, "root", "left").select("word", F.coalesce("_next", "root").alias("root")), "roots")
    return up


def variants(vocab: DataFrame, ratio: int = RATIO) -> DataFrame:
    """One row per word of (word, n): word, n, n_near, form, form_n, root."""
    vocab = stored(vocab.select("word", "n"), "vocabulary")
    best = near_words(vocab).groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("form"))).alias("best"))
    told = vocab.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(-F.col("best.less") >= ratio * F.col("n"), F.col("best")).alias("best"))
    told = stored(told.select("word", "n", "n_near", F.col("best.form").alias("form"), (-F.col("best.less")).alias("form_n")), "forms")
    largest = told.agg(F.max("n")).first()[0] or 0
    ends = roots(told.filter("form IS NOT NULL"), largest, ratio)
    return told.join(ends, "word", "left").withColumn("root", F.coalesce("root", "word"))


@query("op13_spelling_variants", """
WITH RECURSIVE docs AS (SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id, unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')) AS run FROM documents),
runs AS (SELECT id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS n FROM docs GROUP BY ALL),
coded AS (SELECT run, n, hex(encode(id || ':' || run)) AS code FROM runs WHERE length(run) >= 7),
marked AS (
  SELECT run, n, xor(list_reduce(list_prepend(4294967295, list_transform(range(strlen(code) // 2), lambda i: CAST('0x' || code[2 * i + 1:2 * i + 2] AS BIGINT))),
    lambda c, x: list_reduce(list_prepend(xor(c, x), [CAST(0 AS BIGINT) FOR z IN range(8)]), lambda v, z: xor(v >> 1, 3988292384 * (v & 1)))), 4294967295) AS h
  FROM coded),
spelt AS (
  SELECT CASE WHEN h % 31 = 0 THEN run[1:h % length(run)] || run[h % length(run) + 2:] ELSE run END AS word, n FROM marked),
vocab AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM spelt WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2),
cut AS (SELECT word, n, unnest(generate_series(1, length(word))) AS i FROM vocab),
without AS (SELECT word, n, i, word[1:i - 1] || word[i + 1:] AS rest FROM cut),
pairs AS (
  SELECT a.word, b.word AS near, b.n AS near_n FROM without a JOIN without b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM without a JOIN vocab b ON a.rest = b.word
  UNION SELECT b.word, a.word, a.n FROM without a JOIN vocab b ON a.rest = b.word),
best AS (SELECT word, count(*) AS n_near, max(near_n) AS most FROM pairs GROUP BY word),
firsts AS (SELECT word, min(near) AS near FROM pairs JOIN best USING (word) WHERE near_n = most GROUP BY word),
told AS (
  SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN most >= 10 * n THEN near END AS form, CASE WHEN most >= 10 * n THEN most END AS form_n
  FROM vocab LEFT JOIN best USING (word) LEFT JOIN firsts USING (word)),
follow AS (
  SELECT word, word AS reached, form AS nxt FROM told
  UNION ALL SELECT f.word, f.nxt, t.form FROM follow f JOIN told t ON t.word = f.nxt)
SELECT word, form, reached AS root, n, n_near, form_n FROM told JOIN follow USING (word) WHERE nxt IS NULL
""")
def op13_spelling_variants(spark, sf_dir):
    found = variants(vocabulary(documents(spark, sf_dir), misspell=True))
    return found.select("word", "form", "root", "n", "n_near", "form_n")
