"""Anchored runs: a short list that stands for all windows of a text.

A window is ``length`` consecutive tokens of one document. Its anchor is the
place of the smallest token group of ``group`` tokens inside it (the leftmost of
equals), so equal windows have the same anchor at the same distance. Neighbouring
windows mostly share their anchor; they form a run. A run is known by the
fingerprint of its anchor group and by that of all its tokens: runs with equal
tokens hold equal windows, and equal windows only occur in runs of equal anchors.
A text of n tokens has about 2n / (length - group + 2) runs.

Fingerprints are polynomials over random 64-bit token values, two of them where
128 bits are needed. Everything is numpy over one bounded slice of documents.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import numpy as np

BASES = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD1B54A32D192ED03))
MASK32 = np.uint64(0xFFFFFFFF)


@lru_cache(maxsize=4)
def _powers(which: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of a base and of its inverse modulo 2**64."""
    base = int(BASES[which])
    out = []
    for factor in (base, pow(base, -1, 1 << 64)):
        steps = np.full(size, factor, dtype=np.uint64)
        steps[0] = 1
        out.append(np.multiply.accumulate(steps))
    return out[0], out[1]


def mixed(values: np.ndarray) -> np.ndarray:
    """Spread all bits of 64-bit values over all bits."""
    x = values ^ (values >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(29)
    x = x * np.uint64(0xCA5A826395121157)
    return x ^ (x >> np.uint64(32))


class Fingerprints:
    """Fingerprints of any token range of a slice, from prefix sums."""

    def __init__(self, values: np.ndarray, which: int):
        size = 1 << max(16, int(len(values) + 1).bit_length())
        power, self.inverse = _powers(which, size)
        self.sums = np.zeros(len(values) + 1, dtype=np.uint64)
        np.cumsum(values * power[: len(values)], out=self.sums[1:])

    def of(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        return mixed((self.sums[stop] - self.sums[start]) * self.inverse[start])


@dataclass
class Runs:
    """Runs of a slice; ``first`` and ``doc`` count from the slice's start."""

    doc: np.ndarray
    first: np.ndarray
    windows: np.ndarray
    anchor: np.ndarray

    def __len__(self) -> int:
        return len(self.first)


def find_runs(one: Fingerprints, bounds: np.ndarray, length: int, group: int) -> Runs:
    """Runs of the documents that lie at ``bounds[i]:bounds[i + 1]`` of a slice."""
    total = int(bounds[-1])
    none = np.zeros(0, dtype=np.int64)
    if total < length:
        return Runs(none, none, none, none.astype(np.uint64))
    width = length - group + 1
    spots = total - group + 1
    start = np.arange(spots, dtype=np.int64)
    prints = one.of(start, start + group)
    # The place below the priority: the leftmost of equal groups is the smallest.
    keys = (prints & ~MASK32) | start.astype(np.uint64)
    rows = -(-spots // width)
    padded = np.full(rows * width, np.iinfo(np.uint64).max, dtype=np.uint64)
    padded[:spots] = keys
    table = padded.reshape(rows, width)
    before = np.minimum.accumulate(table, axis=1).ravel()
    after = np.minimum.accumulate(table[:, ::-1], axis=1)[:, ::-1].ravel()
    count = total - length + 1
    place = (np.minimum(after[:count], before[width - 1: width - 1 + count]) & MASK32).astype(np.int64)
    sizes = np.diff(bounds)
    fitting = np.maximum(sizes - length + 1, 0)
    doc = np.repeat(np.arange(len(sizes)), fitting)
    if not len(doc):
        return Runs(none, none, none, none.astype(np.uint64))
    offset = np.concatenate(([0], np.cumsum(fitting)[:-1]))
    window = np.arange(len(doc)) - offset[doc] + bounds[:-1][doc]
    place = place[window]
    opens = np.ones(len(doc), dtype=bool)
    opens[1:] = (place[1:] != place[:-1]) | (doc[1:] != doc[:-1])
    head = np.flatnonzero(opens)
    return Runs(doc[head], window[head], np.diff(np.append(head, len(doc))), prints[place[head]])
