"""Shingle sets of texts as sorted 64-bit hashes; runs on Arrow batches inside tasks."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from xxhash import xxh3_64_intdigest

_CACHE_WORDS = 500_000


def word_hasher() -> Callable[[list[bytes]], np.ndarray]:
    """Hashes of a list of words; remembers words it has seen, up to a fixed number."""
    seen: dict[bytes, int] = {}

    class Memo(dict):
        def __missing__(self, word: bytes) -> int:
            if len(self) > _CACHE_WORDS:
                self.clear()
            value = self[word] = xxh3_64_intdigest(word)
            return value

    seen = Memo()
    return lambda words: np.fromiter(map(seen.__getitem__, words), np.uint64, len(words))


def ascii_words(text: str | None) -> list[bytes]:
    """Words between white space (space and \\t to \\r), A-Z lower-cased, as UTF-8."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def mix64(x: np.ndarray) -> np.ndarray:
    """Bijective mixing of 64-bit numbers."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def shingle_set(hashes: np.ndarray, size: int) -> np.ndarray:
    """Sorted distinct hashes of all runs of `size` words; fewer words make one run."""
    n = len(hashes)
    if n == 0:
        return np.empty(0, np.uint64)
    run = min(size, n)
    x = np.full(n - run + 1, run, np.uint64)
    for i in range(run):
        x = mix64(x * np.uint64(0x9E3779B97F4A7C15) + hashes[i : n - run + 1 + i])
    return np.unique(x)
