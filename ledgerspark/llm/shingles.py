"""Word shingles of whole texts as sorted 64-bit numbers (numpy, per batch)."""

from __future__ import annotations

import numpy as np
import xxhash

U = np.uint64
_BASE = U(0x9E3779B97F4A7C15)
_MIX1, _MIX2 = U(0xBF58476D1CE4E5B9), U(0x94D049BB133111EB)


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser: spreads every input bit over all output bits."""
    x = (x ^ (x >> U(30))) * _MIX1
    x = (x ^ (x >> U(27))) * _MIX2
    return x ^ (x >> U(31))


def words(text: str | None) -> list[bytes]:
    """A-Z lower-cased, split at ASCII white space."""
    return (text or "").encode("utf-8", "replace").lower().split()


def word_numbers(tokens: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, tokens), dtype=U, count=len(tokens))


def shingle_set(tokens: list[bytes], size: int) -> np.ndarray:
    """Sorted distinct shingles of ``size`` words; fewer words make one
    shingle of all of them; no words make none."""
    n = len(tokens)
    if not n:
        return np.empty(0, dtype=U)
    h = word_numbers(tokens)
    k = min(size, n)
    total = np.full(n - k + 1, U(k), dtype=U)
    for i in range(k):
        total = mix(total * _BASE + h[i : n - k + 1 + i])
    return np.unique(total)
