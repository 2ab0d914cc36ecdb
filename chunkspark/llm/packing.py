"""Packing by concatenate and cut.

All documents' token ids, an end id after each, form one long row of tokens that is
cut every ``size`` tokens. Two passes give each document its place in it:

1. Every task tokenises what it reads and writes the ids with the running total
   inside its own partition (``part``, ``at``) to a shared table; the table's totals
   per partition, one row each, are summed up in partition order.
2. Every task of the second pass adds its partition's base to ``at`` and cuts its
   documents at the multiples of ``size``; each piece is a boundary record.

The sequences are full but for the last, so padding is under ``size`` tokens in all.
A piece has the sequence and its offset there, so pieces can be placed without
another shuffle of ids.

Null texts are empty: one end id. Each input row is a document of its own, also when
ids or texts repeat or are null. No rows give no pieces. Texts of any length are cut
freely. Other columns are not read.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chunkspark.llm.common import documents, stored
from chunkspark.plans.registry import query

SIZE = 2048
END_ID = 1
ID_BYTES = 4
#: Rows and bytes that one Arrow batch of token ids holds at most, about.
BATCH_BYTES = 8 << 20
#: White space characters in a row that are cut out before the split pattern meets them.
LONG_RUN = 100_000
# The characters that Unicode calls white space.
WHITE = r"[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
_WHITE_RUN, _SOME_WHITE = re.compile(WHITE + "+"), re.compile(WHITE + "{64}")

TOKENS = pa.schema([("part", pa.int32()), ("at", pa.int64()), ("doc_id", pa.int64()), ("ids", pa.binary())])
PIECES = pa.schema([
    ("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()),
    ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64()),
])


def vocabulary_path(name: str) -> str:
    import public_tokenizers

    return os.fspath(public_tokenizers.path(name))


def byte_characters() -> dict[str, int]:
    """Character that stands for each byte in byte-level vocabularies: printable ones for themselves, others from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


@lru_cache(maxsize=2)
def byte_level_encoder(path: str):
    """Encoder of a byte-level BPE file; ids are merge ranks, so the ranks are read off the vocabulary."""
    import tiktoken

    with open(path, encoding="utf-8") as file:
        told = json.load(file)
    to_byte = byte_characters()
    special = {t["content"]: t["id"] for t in told["added_tokens"]}
    ranks = {bytes(to_byte[c] for c in word): rank for word, rank in told["model"]["vocab"].items() if word not in special}
    # Fixed value: the split pattern of this vocabulary family.
    pattern = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
    return tiktoken.Encoding("byte-level", pat_str=pattern, mergeable_ranks=ranks, special_tokens=special)


def token_ids(encoder, text: str) -> np.ndarray:
    """Ids of a whole text. The split pattern steps back through white space one character at a time, which its
    engine does for about a million of them only, so longer runs are cut out as the pattern would cut them."""
    def plain(part: str) -> np.ndarray:
        return encoder.encode_to_numpy(part, allowed_special="all")

    if len(text) < LONG_RUN or not _SOME_WHITE.search(text):
        return plain(text)
    special, parts, at = tuple(encoder.special_tokens_set), [], 0
    for start, stop in (run.span() for run in _WHITE_RUN.finditer(text)):
        if stop - start < LONG_RUN:
            continue
        # The last character goes with what follows, but for the end of the text and special tokens.
        stop -= stop < len(text) and not text.startswith(special, stop)
        parts += [plain(text[at:start]), np.array(encoder._encode_single_piece(text[start:stop]), dtype=np.uint32)]
        at = stop
    return np.concatenate([*parts, plain(text[at:])])


def _tokenised(path: str, end_id: int):
    def run(batches):
        part, at = TaskContext.get().partitionId(), 0
        for batch in batches:
            encode = byte_level_encoder(path)
            rows, held = [], 0
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = token_ids(encode, text.as_py() or "").astype("<u4")
                whole = ids.tobytes() + np.array([end_id], dtype="<u4").tobytes()
                rows.append((part, at, doc_id, whole))
                at += len(whole) // ID_BYTES
                held += len(whole)
                if held > BATCH_BYTES:
                    yield pa.record_batch([pa.array(c, type=f.type) for c, f in zip(zip(*rows), TOKENS)], schema=TOKENS)
                    rows, held = [], 0
            if rows:
                yield pa.record_batch([pa.array(c, type=f.type) for c, f in zip(zip(*rows), TOKENS)], schema=TOKENS)

    return run


def _cut(size: int):
    def run(batches):
        for batch in batches:
            rows, held = [], 0
            for doc_id, base, whole in zip(*[batch.column(i).to_pylist() for i in range(3)]):
                count, start = len(whole) // ID_BYTES, 0
                while start < count:
                    sequence, offset = divmod(base + start, size)
                    length = min(size - offset, count - start)
                    crc = zlib.crc32(memoryview(whole)[start * ID_BYTES:(start + length) * ID_BYTES])
                    rows.append((doc_id, start, length, crc, count, sequence, offset))
                    start += length
            if rows:
                yield pa.record_batch([pa.array(c, type=f.type) for c, f in zip(zip(*rows), PIECES)], schema=PIECES)

    return run


def tokenised(docs: DataFrame, path: str, end_id: int = END_ID, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """First pass: token ids of each document with its running place in its partition, stored."""
    two = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"))
    return stored(two.mapInArrow(_tokenised(path, end_id), "part int, at long, doc_id long, ids binary"), "packed-ids")


def packed(tokens: DataFrame, size: int = SIZE) -> DataFrame:
    """Second pass: boundary records of ``size``-token sequences over what ``tokenised`` wrote."""
    totals = tokens.groupBy("part").agg(F.sum(F.octet_length("ids") / ID_BYTES).cast("long").alias("tokens"))
    # One row per partition of the first pass, so this window is as small as the number of its tasks.
    before = F.coalesce(F.sum("tokens").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    bases = totals.select("part", before.alias("base"))
    placed = tokens.join(F.broadcast(bases), "part").select("doc_id", (F.col("base") + F.col("at")).alias("base"), "ids")
    return placed.mapInArrow(_cut(size), (
        "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    ))


def pack_documents(docs: DataFrame, path: str, size: int = SIZE, end_id: int = END_ID) -> DataFrame:
    return packed(tokenised(docs, path, end_id), size)


@query("op10_packing")
def op10_packing(spark, sf_dir):
    return pack_documents(documents(spark, sf_dir), vocabulary_path("byte_bpe_50k.json"))
