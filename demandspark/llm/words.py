"""Words, their 64-bit hashes and word windows, for whole Arrow batches.

A word is a run of bytes other than space and 0x09-0x0D, which is exactly
what ``bytes.split()`` cuts UTF-8 text into.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash

from demandspark.llm.common import forgets

MIX_A = np.uint64(0xBF58476D1CE4E5B9)
MIX_B = np.uint64(0x94D049BB133111EB)
STEP = np.uint64(0x9E3779B97F4A7C15)


class WordHashes(dict):
    """word -> 64-bit hash; remembers at most ``bound`` words."""

    def __init__(self, bound: int = 100_000, seed: int = 0):
        super().__init__()
        self.bound, self.seed = bound, seed

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.bound:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word, self.seed)
        return h


#: One per Python worker, for all operators.
KNOWN = WordHashes()
forgets.append(KNOWN.clear)


def odd_step(n: int) -> np.uint64:
    """n steps of the golden ratio, modulo 2^64."""
    return np.uint64(n * int(STEP) & 0xFFFFFFFFFFFFFFFF)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * MIX_A
    x = x ^ (x >> np.uint64(27))
    x = x * MIX_B
    return x ^ (x >> np.uint64(31))


def texts(column: pa.Array) -> list[bytes]:
    """The column's texts as UTF-8; a null text is an empty one."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def hashed_words(word_lists: list[list[bytes]], known: WordHashes) -> tuple[np.ndarray, np.ndarray]:
    """All words' hashes one after the other, and where each text starts (n + 1 offsets)."""
    counts = np.fromiter(map(len, word_lists), np.int64, len(word_lists))
    starts = np.concatenate([[0], np.cumsum(counts)])
    out = np.empty(starts[-1], np.uint64)
    for words, a, b in zip(word_lists, starts[:-1], starts[1:], strict=True):
        out[a:b] = np.fromiter(map(known.__getitem__, words), np.uint64, b - a)
    return out, starts


def window_hashes(hashes: np.ndarray, size: int, seed: int = 0) -> np.ndarray:
    """Hash of each run of ``size`` consecutive entries (no text borders heeded)."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    acc = np.full(n, odd_step(seed + size), np.uint64)
    for k in range(size):
        acc = (acc ^ hashes[k:k + n]) * MIX_A
        acc ^= acc >> np.uint64(32)
    return mix(acc)


def portions(found: list[bytes], limit: int = 2 << 20) -> list[tuple[int, int]]:
    """Ranges of texts of about ``limit`` bytes together, or one longer text."""
    out, start, size = [], 0, 0
    for i, text in enumerate(found):
        if size and size + len(text) > limit:
            out.append((start, i))
            start, size = i, 0
        size += len(text)
    return out + [(start, len(found))] if found else out


def windows_of(hashes: np.ndarray, starts: np.ndarray, size: int, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Window hashes of all texts and where each text's begin (n + 1 offsets); texts of fewer words have none."""
    every = window_hashes(hashes, size, seed)
    counts = np.maximum(np.diff(starts) - size + 1, 0)
    offsets = np.concatenate([[0], np.cumsum(counts)])
    place = np.arange(offsets[-1]) + np.repeat(starts[:-1] - offsets[:-1], counts)
    return every[place], offsets
