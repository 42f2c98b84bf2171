"""Texts of an Arrow batch as flat byte arrays, and hashed words over them.

All work on words runs over a slice of whole texts at once: a slice holds about
``SLICE_BYTES`` (or one longer text), so memory follows the longest text, not the batch.
Words are maximal runs of bytes other than space and 0x09-0x0D.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 20
PART_BYTES = 1 << 18  # of texts that pass through a step in Python: what is handed on at once
_U = np.uint64

_IS_WORD = np.ones(256, dtype=bool)
_IS_WORD[[32, 9, 10, 11, 12, 13]] = False
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BYTE_VALUE = np.random.default_rng(20240229).integers(1, 2**63, 256, dtype=np.uint64) * _U(2) + _U(1)
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 2**64)
_powers = (np.ones(1, dtype=np.uint64), np.ones(1, dtype=np.uint64))


def mix(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit values (a bijection)."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _powers
    if len(_powers[0]) < n:
        size = max(n, SLICE_BYTES + 1)
        tables = []
        for factor in (_BASE, _INVERSE):
            steps = np.full(size, factor, dtype=np.uint64)
            steps[0] = 1
            tables.append(np.cumprod(steps, dtype=np.uint64))
        if size > 2 * SLICE_BYTES:
            return tables[0], tables[1]  # for one very long text; not kept
        _powers = (tables[0], tables[1])
    return _powers


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; a null is an empty text."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    flat = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return flat, ends


def slices(offsets: np.ndarray, budget: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges [i, j) of texts that hold at most ``budget`` bytes, or one text."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + budget, side="right")) - 1
        j = min(max(j, i + 1), n)
        yield i, j
        i = j


@dataclass
class Words:
    """Words of a slice in order: hash, byte range in the slice, and text number in the slice."""

    hash: np.ndarray
    start: np.ndarray
    end: np.ndarray
    doc: np.ndarray
    n_docs: int

    def counts(self) -> np.ndarray:
        return np.bincount(self.doc, minlength=self.n_docs)

    def firsts(self) -> np.ndarray:
        """Number of the first word of each text, and the total."""
        return np.concatenate([[0], np.cumsum(self.counts())])


def words(data: np.ndarray, offsets: np.ndarray, lower: bool = False, hashed: bool = True,
          is_word: np.ndarray = _IS_WORD) -> Words:
    """The words of the texts ``data[offsets[i]:offsets[i + 1]]``; ``lower`` folds A-Z.

    ``is_word`` tells by byte value what words are made of, if not of all but white space.
    """
    base = int(offsets[0])
    data = data[base:int(offsets[-1])]
    bounds = np.asarray(offsets, dtype=np.int64) - base
    n, n_docs = len(data), len(bounds) - 1
    if n == 0:
        empty = np.zeros(0, np.int64)
        return Words(np.zeros(0, np.uint64), empty, empty, empty, n_docs)
    inside = is_word[data]
    fresh = np.zeros(n + 1, dtype=bool)  # a text begins here
    fresh[bounds] = True
    before = np.empty(n, dtype=bool)
    before[0] = False
    before[1:] = inside[:-1]
    before &= ~fresh[:n]
    after = np.empty(n, dtype=bool)
    after[-1] = False
    after[:-1] = inside[1:]
    after &= ~fresh[1:]
    start = np.flatnonzero(inside & ~before)
    end = np.flatnonzero(inside & ~after) + 1
    doc = np.searchsorted(bounds, start, side="right") - 1
    if not hashed:
        return Words(np.zeros(0, np.uint64), start, end, doc, n_docs)
    power, inverse = _power_tables(n + 1)
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(_BYTE_VALUE[_LOWER[data] if lower else data] * power[:n], out=sums[1:])
    h = (sums[end] - sums[start]) * inverse[start]
    return Words(mix(h ^ mix((end - start).astype(np.uint64))), start, end, doc, n_docs)


def grams(hashes: np.ndarray, k: int, seed: int) -> np.ndarray:
    """Hash of each run of ``k`` values (also of runs across texts: mask them)."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    factors = np.random.default_rng(seed).integers(1, 2**63, k, dtype=np.uint64) * _U(2) + _U(1)
    total = np.zeros(n, dtype=np.uint64)
    for j in range(k):
        total += hashes[j:j + n] * factors[j]
    return mix(total)


def spread(counts: np.ndarray) -> np.ndarray:
    """0, 1, ..., counts[0]-1, 0, 1, ..., counts[1]-1, ..."""
    counts = np.asarray(counts, dtype=np.int64)
    total = int(counts.sum())
    return np.arange(total) - np.repeat(np.cumsum(counts) - counts, counts)


def worker_cache() -> dict:
    """A dict that lives as long as the Python worker.

    Functions travel to the executors by value, and their module's globals with them, so
    what a module keeps would be lost after each task.
    """
    return vars(sys).setdefault("_tideline_llm", {})


def string_column(batch: pa.RecordBatch, name: str) -> tuple[np.ndarray, np.ndarray]:
    return text_buffers(batch.column(batch.schema.get_field_index(name)))
