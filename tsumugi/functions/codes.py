"""Vectorised 64-bit hashes of character n-grams over the code points of many texts at once."""

from __future__ import annotations

import numpy as np

#: Fixed odd multipliers.
STEP, MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


def term_counts(texts: list[str], sizes: tuple[int, ...]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Of each text the hashes of its distinct n-grams, of all ``sizes``, and how often each occurs."""
    points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    ends = np.cumsum([0, *map(len, texts)])
    hashed = []
    for n in sizes:
        h = np.full(max(0, len(points) - n + 1), n, np.uint64)
        for k in range(n):
            h = h * STEP + points[k : k + len(h)]
            h ^= h >> np.uint64(29)
        hashed.append((h * MIX ^ (h * MIX >> np.uint64(32))).view(np.int64))
    return [np.unique(np.concatenate([h[a : max(a, b - n + 1)] for n, h in zip(sizes, hashed)]), return_counts=True) for a, b in zip(ends[:-1], ends[1:])]
