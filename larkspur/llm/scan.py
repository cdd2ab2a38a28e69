"""Texts as byte arrays inside Arrow batches: words, their hashes, and shingles.

A word is a longest run of anything but the six ASCII white-space characters. The
separators never occur inside a multi-byte character, so words are cut on the UTF-8
bytes of the Arrow buffer itself, for all texts of a slice at once.
"""

from __future__ import annotations

import sys
import types
from collections.abc import Callable, Iterator
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

WORD = r"[^\x20\x09-\x0D]+"
# Bytes of text worked on at a time; one longer text is a slice of its own.
SLICE_BYTES = 1 << 20

_BASE = np.uint64(0x9E3779B97F4A7C15)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def once(key: object, make: Callable[[], Any]) -> Any:
    """What ``make`` gives, made once in a worker process and kept for its later tasks.

    This package travels by value, anew with every task, so its own globals would not last.
    """
    kept = sys.modules.setdefault("_larkspur_worker", types.ModuleType("_larkspur_worker")).__dict__
    if key not in kept:
        kept[key] = make()
    return kept[key]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values so that every bit depends on all others."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def stream(seed: int, size: int) -> np.ndarray:
    """Fixed pseudo-random 64-bit values."""
    start = mix(np.array([seed + 1], np.uint64))
    return mix(start + np.arange(1, size + 1, dtype=np.uint64) * _BASE)


def slices(
    batches: Iterator[pa.RecordBatch], limit: int = SLICE_BYTES, text: str = "text"
) -> Iterator[pa.RecordBatch]:
    """Cut batches into pieces of at most ``limit`` bytes of text (one row at least)."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0)
        ends = np.cumsum(np.asarray(sizes, np.int64))
        at = 0
        while at < batch.num_rows:
            before = ends[at - 1] if at else 0
            stop = max(at + 1, int(np.searchsorted(ends, before + limit, "right")))
            yield batch.slice(at, stop - at)
            at = stop


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts and the offset of each; null counts as empty."""
    column = pc.fill_null(column, "")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    wide = column.cast(pa.large_string())
    _, offsets, data = wide.buffers()
    at = np.frombuffer(offsets, np.int64)[wide.offset : wide.offset + len(wide) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


class Words:
    """Words of the texts of one column.

    ``first[d]:first[d + 1]`` are the words of text ``d``; ``start`` and ``end`` are
    byte offsets into ``raw``, ``offsets[d]`` is where text ``d`` begins there.
    """

    def __init__(self, column: pa.Array):
        self.raw, self.offsets = text_bytes(column)
        inside = ~_SPACE[self.raw]
        cut = np.zeros(self.raw.size + 1, bool)
        cut[self.offsets] = True
        before, after = np.empty_like(inside), np.empty_like(inside)
        before[:1], before[1:] = True, ~inside[:-1]
        after[-1:], after[:-1] = True, ~inside[1:]
        self.start = np.flatnonzero(inside & (before | cut[:-1]))
        self.end = np.flatnonzero(inside & (after | cut[1:])) + 1
        self.first = np.searchsorted(self.start, self.offsets)
        self._inside = inside

    def __len__(self) -> int:
        return self.start.size

    def hashes(self, seed: int = 0) -> np.ndarray:
        """64-bit hash of every word: a polynomial in its bytes, each byte drawn at random."""
        if not len(self):
            return np.zeros(0, np.uint64)
        sizes = self.end - self.start
        begins = np.cumsum(sizes) - sizes
        table = stream(seed, 256)[self.raw[self._inside]]
        powers = np.full(int(sizes.max()), _BASE, np.uint64)
        powers[0] = 1
        powers = np.cumprod(powers, dtype=np.uint64)
        table *= powers[np.arange(table.size) - np.repeat(begins, sizes)]
        return mix(np.add.reduceat(table, begins) + sizes.astype(np.uint64))


def runs(hashes: np.ndarray, k: int, seed: int = 0) -> np.ndarray:
    """Hash of every ``k`` consecutive words, also across texts; ``k - 1`` fewer than words."""
    count = hashes.size - k + 1
    if count <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(count, np.uint64)
    for j, factor in enumerate(stream(seed + 101, k)):
        out += hashes[j : j + count] * (factor | np.uint64(1))
    return mix(out)


def within(first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions at which ``k`` words of one text begin, and how many each text has."""
    sizes = np.maximum(np.diff(first) - k + 1, 0)
    begins = np.cumsum(sizes) - sizes
    return np.arange(sizes.sum()) + np.repeat(first[:-1] - begins, sizes), sizes
