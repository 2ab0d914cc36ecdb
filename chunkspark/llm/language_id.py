"""Language identification by nearest centroid.

A text is lower-cased, what is not a letter becomes a blank, and its byte pairs and
triples are counted in ``FEATURES`` hashed cells. Counts are damped (1 + log), weighted
by inverse document frequency over all training documents, and normalised. Each
language has ``CENTROIDS`` centroids, found by spherical k-means over about
``SAMPLE`` of its distinct training texts (a documented bound; the document frequencies
cover all documents). A text gets the language of the centroid with the largest cosine,
which is its score, cut to 0..1. It is rejected when that cosine is below the floor of
that language for as many letters: too far from every language to be text in one of them.

Floors are measured on texts held back: a language's sample is halved, either half is
compared with centroids of the other. Of each text a window of 1, 2, 4, ... letters is
taken; the floor of a class (texts of that many letters, and fewer than twice as many) is
the ``QUANTILE`` of its windows. Where a class has fewer than ``ENOUGH`` texts, the last shorter
class that had them stands for it. A language that never has them takes half the lowest cosine,
with fewer than ``FEW`` texts ``REJECT`` times the lowest of its own sample.

Null texts and texts without a letter are ``und`` with score 0, and rejected. If there is
nothing to learn from, all are. Whole texts are read, in slices of bounded size; a very
long text is counted in parts. Each row is judged alone, so repeated rows give
repeated results. Other columns are not read; training rows without a language are not used.
"""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chunkspark.llm.common import documents
from chunkspark.plans.registry import query

FEATURES = 1 << 13
SAMPLE = 600
CENTROIDS = 3
ROUNDS = 8
REJECT = 0.2
QUANTILE, ENOUGH, FEW = 0.01, 300, 20
#: Floors by the number of binary digits of a text's letters; longer texts are in the last class.
CLASSES = 24
#: Documents and bytes that are counted at once.
ROWS, PART_BYTES = 128, 1 << 20
UND = "und"
NOT_LETTERS = re.compile(r"[\W\d_]+")


def counts(texts: list[str], letters: list[int] | None = None) -> np.ndarray:
    """Damped feature counts, one row per text; ``letters`` takes up how many letters each has."""
    out = np.zeros(len(texts) * FEATURES, dtype=np.float32)
    start = 0
    while start < len(texts):
        stop, held, parts = start, 0, []
        while stop < len(texts) and (not parts or held + len(texts[stop]) <= PART_BYTES):
            plain = NOT_LETTERS.sub(" ", texts[stop].lower())
            if letters is not None:
                letters.append(len(plain) - plain.count(" "))
            parts.append((" " + plain + " ").encode("utf-8", "replace"))
            held += len(parts[-1])
            stop += 1
        data = np.frombuffer(b"".join(parts), dtype=np.uint8).astype(np.uint32)
        row = np.repeat(np.arange(start, stop, dtype=np.int64), [len(p) for p in parts])
        for width in (2, 3):
            for at in range(0, max(len(data) - width + 1, 0), PART_BYTES):
                here = slice(at, min(at + PART_BYTES, len(data) - width + 1))
                gram = np.full(here.stop - here.start, width, dtype=np.uint32)
                for i in range(width):
                    gram = gram * np.uint32(257) + data[here.start + i: here.stop + i]
                cell = (gram * np.uint32(2654435761)) >> np.uint32(32 - 13)
                same = row[here] == row[here.start + width - 1: here.stop + width - 1]
                keys = (row[here] * FEATURES + cell)[same]
                low = int(row[here.start]) * FEATURES
                high = (int(row[here.stop - 1]) + 1) * FEATURES
                out[low:high] += np.bincount(keys - low, minlength=high - low)
        start = stop
    np.log1p(out, out=out)
    return out.reshape(len(texts), FEATURES)


def weighted(texts: list[str], idf: np.ndarray, letters: list[int] | None = None) -> np.ndarray:
    rows = counts(texts, letters) * idf
    norms = np.linalg.norm(rows, axis=1, keepdims=True)
    return rows / np.maximum(norms, 1e-12)


def _frequencies(batches):
    """Documents per feature of a task's texts."""
    total, rows = np.zeros(FEATURES, dtype=np.int64), 0
    for batch in batches:
        texts = batch.column(0).to_pylist()
        for at in range(0, len(texts), ROWS):
            total += (counts(texts[at: at + ROWS]) > 0).sum(axis=0)
        rows += len(texts)
    seen = np.flatnonzero(total)
    yield pa.record_batch({"feature": pa.array([-1, *seen], pa.int32()), "n": pa.array([rows, *total[seen]], pa.int64())})


def _centroids(rows: np.ndarray) -> np.ndarray:
    # Far apart starts: each next centroid begins at the text least like those before.
    centers = [rows.mean(axis=0)]
    while len(centers) < min(CENTROIDS, len(rows)):
        near = np.max(rows @ np.stack([c / max(np.linalg.norm(c), 1e-12) for c in centers]).T, axis=1)
        centers.append(rows[int(np.argmin(near))])
    centers = np.stack(centers)
    for _ in range(ROUNDS):
        centers /= np.maximum(np.linalg.norm(centers, axis=1, keepdims=True), 1e-12)
        owner = np.argmax(rows @ centers.T, axis=1)
        for c in range(len(centers)):
            if (owner == c).any():
                centers[c] = rows[owner == c].mean(axis=0)
    return centers / np.maximum(np.linalg.norm(centers, axis=1, keepdims=True), 1e-12)


def _windows(texts: list[str], size: int) -> tuple[list[int], list[str]]:
    """Of each text that has as many letters, one window of ``size`` letters, and which text it is of."""
    found, cut = [], []
    for i, text in enumerate(texts):
        plain = NOT_LETTERS.sub(" ", text.lower())
        at = np.flatnonzero(np.frombuffer(plain.encode("utf-32-le", "replace"), dtype="<u4") != 32)
        if len(at) >= size:
            first = (len(at) - size) * (i // 2 % 4) // 3
            while first and at[first] == at[first - 1] + 1:  # back to the start of the word
                first -= 1
            found.append(i)
            cut.append(plain[at[first]: at[first + size - 1] + 1])
    return found, cut


def _floors(texts: list[str], rows: np.ndarray, centers: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Lowest cosine that is accepted, by class of letters."""
    held = len(texts) >= FEW
    halves = [_centroids(rows[1::2]), _centroids(rows[::2])] if held else [centers, centers]
    lowest = np.zeros((2, CLASSES))
    last = np.zeros(2)
    for k in range(CLASSES):
        found, cut = _windows(texts, 1 << k)
        if len(found) >= (FEW if held else 1):
            near = np.concatenate([weighted(cut[at: at + ROWS], idf) for at in range(0, len(cut), ROWS)])
            reached = np.where(np.array(found) % 2 == 0, np.max(near @ halves[0].T, axis=1), np.max(near @ halves[1].T, axis=1))
            last[1] = reached.min() * (0.5 if held else REJECT)
            if len(found) >= ENOUGH:
                last[0] = np.quantile(reached, QUANTILE)
        lowest[:, k] = last
    return lowest[0] if last[0] else lowest[1]


def _fit(idf: np.ndarray):
    """Centroids and floors of one language, whose sample is bounded."""
    def run(group: pd.DataFrame) -> pd.DataFrame:
        texts = group.sort_values(["_order", "_text"])["_text"].tolist()
        rows = np.concatenate([weighted(texts[at: at + ROWS], idf) for at in range(0, len(texts), ROWS)])
        centers = _centroids(rows)
        floors = _floors(texts, rows, centers, idf).astype("<f8").tobytes()
        return pd.DataFrame({"lang": group["_lang"].iloc[0], "center": [c.astype("<f4").tobytes() for c in centers], "floors": floors})

    return run


def fit(train: DataFrame, text: str = "text", lang: str = "lang") -> dict:
    """Model (idf, centroids, their languages and floors) from labelled rows."""
    rows = train.select(F.col(f"`{text}`").cast("string").alias("_text"), F.col(f"`{lang}`").cast("string").alias("_lang"))
    rows = rows.filter(F.col("_lang").isNotNull() & F.col("_text").rlike(r"\p{L}"))
    found = rows.select("_text").mapInArrow(_frequencies, "feature int, n long").groupBy("feature").agg(F.sum("n").alias("n")).collect()
    told = {r["feature"]: r["n"] for r in found}
    total = told.pop(-1, 0)
    if not total:
        return {"langs": []}
    seen = np.zeros(FEATURES)
    seen[list(told)] = list(told.values())
    idf = (np.log((1 + total) / (1 + seen)) + 1).astype(np.float32)
    # About SAMPLE distinct texts a language by a hash of the text, then SAMPLE at most: copies count once, however many.
    hashed = rows.withColumn("_order", F.xxhash64("_text"))
    sizes = {r["_lang"]: r["n"] for r in hashed.select("_lang", "_order").distinct().groupBy("_lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    share = F.lit(0.0)
    for name, size in sizes.items():
        share = F.when(F.col("_lang") == name, F.lit(min(1.0, 1.5 * SAMPLE / size))).otherwise(share)
    drawn = hashed.filter(F.pmod("_order", F.lit(1 << 30)) < share * (1 << 30)).distinct()
    place = F.row_number().over(Window.partitionBy("_lang").orderBy("_order", "_text"))
    drawn = drawn.withColumn("_n", place).filter(F.col("_n") <= SAMPLE).drop("_n")
    parts = drawn.groupBy("_lang").applyInPandas(_fit(idf), "lang string, center binary, floors binary").collect()
    parts.sort(key=lambda r: (r["lang"], bytes(r["center"])))
    if not parts:
        return {"langs": []}
    return {"idf": idf, "langs": [r["lang"] for r in parts], "floors": np.stack([np.frombuffer(r["floors"], dtype="<f8") for r in parts]),
            "centers": np.stack([np.frombuffer(r["center"], dtype="<f4") for r in parts])}


def predict(docs: DataFrame, model: dict, text: str = "text") -> DataFrame:
    """The rows of ``docs`` with lang_pred, score and rejected behind their columns (whose names must differ)."""
    named = docs.toDF(*[f"_c{i}" for i in range(len(docs.columns))])
    letters = F.coalesce(F.col(f"_c{docs.columns.index(text)}").cast("string").rlike(r"\p{L}"), F.lit(False))
    rows = named.withColumn("_text", F.when(letters, F.col(f"_c{docs.columns.index(text)}").cast("string")))

    def run(batches):
        for batch in batches:
            texts = batch.column(batch.num_columns - 1).to_pylist()
            kept = [i for i, t in enumerate(texts) if t is not None and model["langs"]]
            langs, scores, rejected = [UND] * len(texts), np.zeros(len(texts)), np.ones(len(texts), dtype=bool)
            for at in range(0, len(kept), ROWS):
                here = kept[at: at + ROWS]
                letters: list[int] = []
                near = weighted([texts[i] for i in here], model["idf"], letters) @ model["centers"].T
                best = np.argmax(near, axis=1)
                top = near[np.arange(len(here)), best]
                scores[here] = np.clip(top, 0, 1)
                rejected[here] = top < model["floors"][best, [min(max(n.bit_length() - 1, 0), CLASSES - 1) for n in letters]]
                for i, c in zip(here, best):
                    langs[i] = model["langs"][c]
            yield pa.record_batch([*batch.columns[:-1], pa.array(langs, pa.string()), pa.array(scores, pa.float64()), pa.array(rejected)],
                                  names=[*batch.schema.names[:-1], "lang_pred", "score", "rejected"])

    from pyspark.sql.types import BooleanType, DoubleType, StringType, StructType

    schema = StructType(named.schema.fields).add("lang_pred", StringType()).add("score", DoubleType()).add("rejected", BooleanType())
    return rows.mapInArrow(run, schema).toDF(*docs.columns, "lang_pred", "score", "rejected")


def accepted(docs: DataFrame, model: dict, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that are not rejected, all columns as they came."""
    named = docs.toDF(*[f"_d{i}" for i in range(len(docs.columns))])
    judged = predict(named, model, f"_d{docs.columns.index(text)}")
    return judged.filter(~F.col("rejected")).select(*named.columns).toDF(*docs.columns)


def held_out(doc_id: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


@query("op9_language_id")
def op9_language_id(spark, sf_dir):
    docs = documents(spark, sf_dir)
    model = fit(docs.filter(~held_out()))
    judged = predict(docs.select("doc_id", held_out().alias("held_out"), "text"), model)
    return judged.select("doc_id", "held_out", "lang_pred", "score", "rejected")
