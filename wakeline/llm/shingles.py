"""Hashed word shingles, shared by the operators that compare documents by them."""

from __future__ import annotations

import numpy as np
import xxhash

from wakeline.llm.common import Memo

_WORD = Memo(xxhash.xxh64_intdigest)


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (xor-shift and multiply)."""
    x = (x ^ np.uint64(seed)) * np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


def shingles(text: str | None, words: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the runs of ``words`` words; a shorter text is one shingle, none is empty.

    A-Z count as a-z; words are parted by blanks, tabs, line feeds, vertical tabs, form feeds and returns.
    """
    tokens = text.encode().lower().split() if text else ()
    if not tokens:
        return np.empty(0, np.uint64)
    hashes = np.fromiter(map(_WORD.__getitem__, tokens), np.uint64, len(tokens))
    size = min(words, len(tokens))
    count = len(tokens) - size + 1
    out = mix(hashes[:count], size)
    for k in range(1, size):
        out = mix(out + hashes[k:count + k])
    return np.unique(out)
