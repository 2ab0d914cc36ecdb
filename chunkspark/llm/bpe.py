"""BPE encoding and decoding over a trie of distinct words.

Each batch of documents is split at white space; its distinct new chunks are split
into words by the vocabulary file's own normaliser and pre-tokeniser, and the
distinct words form a trie, walked in sorted order with the current path as a stack.
A node keeps one token: the last one of its prefix's encoding. Of all vocabulary
tokens that end the prefix, that is the one whose pair with the last token of the
shorter prefix before it is itself encoded as these two; exactly one is. So each
prefix that words share is worked out once, and a word's ids are read off by
following last tokens back from its end. The token that ends a word is looked for
among those with the end-of-word mark.

What a task learns (chunks, pairs) is kept for later batches up to ``KEPT`` entries,
so memory is bounded by that and by the chunks of one batch. Special tokens in a text are taken as such, as the file says.

Null texts are empty: no ids, empty text. White space only: the same. Each input
row gives one row, repeated or null ids too; other columns are not read.
"""

from __future__ import annotations

import json
import re
from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chunkspark.llm.common import documents
from chunkspark.llm.packing import byte_characters, vocabulary_path
from chunkspark.plans.registry import query

KEPT = 500_000
BATCH_BYTES = 2 << 20
# The word pattern of this vocabulary family, and chunks for which it needs no library: visible
# characters below the combining ones, which are composed already and whose classes are the same everywhere.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
LATIN_WORDS = regex.compile(WORDS)
LATIN = re.compile(r"[!-~\u00a1-\u024f]+")


class WordCoder:
    """Encodes words of one vocabulary by trie traversal."""

    def __init__(self, vocabulary: dict[str, int], merges: list, end: str):
        self.ids, self.end = vocabulary, end
        self.ranks = {tuple(m if isinstance(m, list) else m.split(" ")): i for i, m in enumerate(merges)}
        self.fits: dict[tuple[str | None, str], bool] = {}
        # What a prefix or a whole word may end with, as plain text, and the token that it is then.
        self.inner = {t: t for t in vocabulary if not (end and t.endswith(end))}
        self.final = {t[: -len(end)]: t for t in vocabulary if t.endswith(end) and t != end} if end else self.inner
        self.begins = {""} | {t[:i] for t in (*self.inner, *self.final) for i in range(1, len(t) + 1)}
        self.steps: dict[str, tuple[str, list[str], list[str]]] = {}

    def merged(self, symbols: list[str]) -> list[str]:
        """Plain merging, lowest rank first: what the pair test compares with."""
        symbols, rank, never = list(symbols), self.ranks.get, 1 << 60
        ranks = [rank(p, never) for p in zip(symbols, symbols[1:])]
        while ranks and (least := min(ranks)) < never:
            at = ranks.index(least)
            symbols[at: at + 2] = [symbols[at] + symbols[at + 1]]
            del ranks[at]
            if at:
                ranks[at - 1] = rank((symbols[at - 1], symbols[at]), never)
            if at < len(ranks):
                ranks[at] = rank((symbols[at], symbols[at + 1]), never)
        return symbols

    def symbols(self, token: str) -> list[str]:
        if self.end and token.endswith(self.end) and token != self.end:
            plain = token[: -len(self.end)]
            return [*plain[:-1], plain[-1] + self.end]
        return list(token)

    def follows(self, before: str | None, token: str) -> bool:
        """Whether ``before`` and ``token`` side by side are encoded as just these two."""
        key = (before, token)
        known = self.fits.get(key)
        if known is None:
            want = [token] if before is None else [before, token]
            known = self.merged([s for t in want for s in self.symbols(t)]) == want
            if len(self.fits) >= KEPT:
                self.fits.clear()
            self.fits[key] = known
        return known

    def ending(self, text: str) -> tuple[str, list[str], list[str]]:
        """The longest end of ``text`` that begins a token, and the tokens, inner and final, that end it."""
        state = text
        while state not in self.begins:
            state = state[1:]
        ends = [state[i:] for i in range(len(state))]
        known = (state, [self.inner[e] for e in ends if e in self.inner], [self.final[e] for e in ends if e in self.final])
        if len(self.steps) >= KEPT:
            self.steps.clear()
        self.steps[text] = known
        return known

    def last(self, candidates: list[str], depth: int, marked: int, path: list[str | None]) -> str:
        """Last token of a prefix of ``depth`` characters; ``path[d]`` is that of its first ``d``."""
        fits = self.fits
        for token in candidates:
            before = path[depth - len(token) + marked]
            fit = fits.get((before, token))
            if fit or fit is None and self.follows(before, token):
                return token
        raise ValueError(f"no token ends a prefix of {depth} characters")

    def encode(self, words: list[str]) -> dict[str, list[int]]:
        """Ids of distinct words."""
        out, path, states, previous, marked = {}, [None], [""], "", len(self.end)
        steps = self.steps
        for word in sorted(words):
            size = len(word)
            # With an end mark, the last character of a word is not part of a shared prefix.
            deep = size - 1 if marked else size
            shared = min(len(previous), deep)
            while word[:shared] != previous[:shared]:
                shared -= 1
            del path[shared + 1:], states[shared + 1:]
            for depth in range(shared, deep):
                text = states[depth] + word[depth]
                state, inner, _ = steps.get(text) or self.ending(text)
                states.append(state)
                path.append(self.last(inner, depth + 1, 0, path))
            token = path[size] if not marked else None
            if marked:
                text = states[deep] + word[deep]
                token = self.last((steps.get(text) or self.ending(text))[2], size, marked, path)
            tokens, at = [self.ids[token]], size - len(token) + marked
            while at > 0:
                token = path[at]
                tokens.append(self.ids[token])
                at -= len(token)
            out[word] = tokens[::-1]
            previous = word[:deep]
        return out


class Encoder:
    """Whole texts to ids as the vocabulary file describes, chunk by chunk."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            told = json.load(file)
        self.library = Tokenizer.from_file(path)
        model = told["model"]
        self.words = WordCoder(model["vocab"], model["merges"], model.get("end_of_word_suffix") or "")
        self.special = {t["content"]: t["id"] for t in told["added_tokens"]}
        self.split = re.compile("(" + "|".join(re.escape(t) for t in sorted(self.special, key=len, reverse=True)) + ")") if self.special else None
        first = ((told.get("pre_tokenizer") or {}).get("pretokenizers") or [{}])[0]
        steps = [n["type"] for n in (told.get("normalizer") or {}).get("normalizers", [])]
        self.latin = (first.get("pattern") or {}).get("Regex") == WORDS and steps == ["NFC", "Replace", "Lowercase"]
        self.table = {b: c for c, b in byte_characters().items()}
        self.chunks: dict[str, bytes] = {"": b""}
        self.known: dict[str, bytes] = {}

    def pieces(self, chunk: str) -> list[str | int]:
        """Words of a chunk in the vocabulary's characters; special tokens as their ids."""
        found: list[str | int] = []
        for part in self.split.split(chunk) if self.split else [chunk]:
            if part in self.special:
                found.append(self.special[part])
            elif part:
                found += [w for w, _ in self.library.pre_tokenizer.pre_tokenize_str(self.normal(part)) if w]
        return found

    def normal(self, text: str) -> str:
        return self.library.normalizer.normalize_str(text) if self.library.normalizer else text

    def split_chunks(self, chunks: list[str]) -> list[list[str | int]]:
        """Words of chunks; Latin ones without the library where the file's pattern is the known one."""
        if not self.latin:
            return [self.pieces(c) for c in chunks]
        words, plain, table = LATIN_WORDS.findall, LATIN.fullmatch, self.table
        return [
            [w if w.isascii() else w.encode().decode("latin-1").translate(table) for w in words(c.lower())]
            if plain(c) and "<|" not in c else self.pieces(c)
            for c in chunks
        ]

    def learn(self, chunks: set[str]) -> dict[str, bytes]:
        """Ids of distinct chunks."""
        if len(self.known) > KEPT:
            self.known.clear()
        order = list(chunks)
        split = self.split_chunks(order)
        known = self.known
        fresh = {w for ws in split for w in ws if isinstance(w, str)} - known.keys()
        known.update((w, array("I", ids).tobytes()) for w, ids in self.words.encode(list(fresh)).items())
        return {
            chunk: b"".join([known[w] if isinstance(w, str) else array("I", [w]).tobytes() for w in words])
            for chunk, words in zip(order, split)
        }

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        split = [t.replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" ") for t in texts]
        every = set().union(*split)
        fresh = every - self.chunks.keys()
        if fresh:
            learned = self.learn(fresh)
            if len(self.chunks) + len(learned) > KEPT:
                # This group is read from its own chunks; the table for later ones starts anew, with those if they fit.
                learned.update((c, self.chunks[c]) for c in every - fresh)
                self.chunks = {"": b""} | (learned if len(learned) < KEPT else {})
                return [b"".join(map(learned.__getitem__, chunks)) for chunks in split]
            self.chunks.update(learned)
        return [b"".join(map(self.chunks.__getitem__, chunks)) for chunks in split]


class Decoder:
    """Ids to text: tokens joined by a space, or by the file's byte-level decoder."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            told = json.load(file)
        names = told["model"]["vocab"] | {t["content"]: t["id"] for t in told["added_tokens"]}
        self.spaced = told.get("decoder") is None
        to_byte = byte_characters()
        tokens = [b""] * (max(names.values()) + 1)
        for name, i in names.items():
            plain = self.spaced or any(c not in to_byte for c in name)
            tokens[i] = name.encode() if plain else bytes(to_byte[c] for c in name)
            tokens[i] += b" " if self.spaced else b""
        self.sizes = np.array(list(map(len, tokens)), dtype=np.int64)
        self.starts = np.concatenate(([0], np.cumsum(self.sizes)[:-1]))
        self.data = np.frombuffer(b"".join(tokens), dtype=np.uint8)

    def decode(self, ids: np.ndarray) -> str:
        sizes = self.sizes[ids]
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ids) else 0
        at = np.arange(total) + np.repeat(self.starts[ids] - ends + sizes, sizes)
        joined = self.data[at[:-1] if self.spaced and total else at].tobytes()
        return joined.decode("utf-8", "replace")


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


@lru_cache(maxsize=2)
def decoder(path: str) -> Decoder:
    return Decoder(path)


def _groups(values: list, size) -> list[list]:
    """Consecutive values that hold about BATCH_BYTES together."""
    groups, held = [[]], 0
    for value in values:
        if groups[-1] and held + size(value) > BATCH_BYTES:
            groups.append([])
            held = 0
        groups[-1].append(value)
        held += size(value)
    return groups


IDS = pa.schema([("doc_id", pa.int64()), ("ids", pa.binary())])
BOTH = pa.schema([*IDS, ("text", pa.string())])


def _encoded(batches, path: str):
    """Numbers and ids of the texts of each group."""
    for batch in batches:
        rows = list(zip(batch.column(0).to_pylist(), (t or "" for t in batch.column(1).to_pylist())))
        for group in _groups(rows, lambda r: len(r[1])):
            yield [i for i, _ in group], encoder(path).encode([t for _, t in group])


def _decoded(numbers: list, ids: list[bytes], path: str) -> pa.RecordBatch:
    texts = [decoder(path).decode(np.frombuffer(i, dtype="<u4")) for i in ids]
    return pa.record_batch([pa.array(c, f.type) for c, f in zip((numbers, ids, texts), BOTH)], schema=BOTH)


def _read(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    return docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"))


def encode_documents(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id and ``ids`` (binary, unsigned 32-bit little-endian) of every whole text."""
    def run(batches):
        for numbers, ids in _encoded(batches, path):
            yield pa.record_batch([pa.array(c, f.type) for c, f in zip((numbers, ids), IDS)], schema=IDS)

    return _read(docs, doc_id, text).mapInArrow(run, "doc_id long, ids binary")


def decode_documents(encoded: DataFrame, path: str) -> DataFrame:
    """doc_id, ids and the decoded ``text`` of every row of ``encode_documents``."""
    def run(batches):
        for batch in batches:
            rows = list(zip(batch.column(0).to_pylist(), (i or b"" for i in batch.column(1).to_pylist())))
            for group in _groups(rows, lambda r: len(r[1])):
                yield _decoded([i for i, _ in group], [i for _, i in group], path)

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, ids binary, text string")


def recode_documents(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``decode_documents`` of ``encode_documents`` by one Python process a task instead of two."""
    def run(batches):
        for numbers, ids in _encoded(batches, path):
            yield _decoded(numbers, ids, path)

    return _read(docs, doc_id, text).mapInArrow(run, "doc_id long, ids binary, text string")


@query("op2_bpe")
def op2_bpe(spark, sf_dir):
    back = recode_documents(documents(spark, sf_dir), vocabulary_path("word_bpe_49k.json"))
    return back.select(
        "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2(F.col("ids"), 256).alias("ids_sha256"), F.sha2(F.col("text"), 256).alias("decoded_sha256"))
