"""Vectorised hashing over the code points of many texts at once (numpy, no Python loop over characters)."""

from __future__ import annotations

import numpy as np

#: Fixed odd multipliers of the hash functions.
BASE = 0x9E3779B97F4A7C15
MIX_A, MIX_B = 0xBF58476D1CE4E5B9, 0x94D049BB133111EB


def mix(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """Finalise 64-bit values so that all bits depend on all bits (the splitmix64 finaliser)."""
    x = x + np.uint64((salt * BASE) % 2**64)
    x ^= x >> np.uint64(30)
    x *= np.uint64(MIX_A)
    x ^= x >> np.uint64(27)
    x *= np.uint64(MIX_B)
    x ^= x >> np.uint64(31)
    return x


def code_points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts in one array, and the offsets of the texts in it."""
    sizes = np.fromiter((len(t) for t in texts), np.int64, len(texts))
    points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    return points, np.concatenate([[0], np.cumsum(sizes)])


def gram_hashes(points: np.ndarray, n: int) -> np.ndarray:
    """Hash of the ``n`` code points from each position on; positions close to the array's end are left out."""
    if len(points) < n:
        return np.empty(0, np.uint64)
    wide = points.astype(np.uint64)
    h = wide[: len(wide) - n + 1].copy()
    for k in range(1, n):
        h *= np.uint64(BASE)
        h += wide[k : len(wide) - n + 1 + k]
    return mix(h)


class Rolling:
    """Polynomial hashes of windows of any width over one array, from prefix sums modulo 2**64."""

    def __init__(self, points: np.ndarray, base: int = BASE) -> None:
        self.n = n = len(points)
        wide = mix(points.astype(np.uint64), 7)
        powers = np.cumprod(np.concatenate([[np.uint64(1)], np.full(n, base, np.uint64)]), dtype=np.uint64)
        self.inverse = np.cumprod(np.concatenate([[np.uint64(1)], np.full(n, pow(base, -1, 2**64), np.uint64)]), dtype=np.uint64)
        self.sums = np.concatenate([[np.uint64(0)], np.cumsum(wide * powers[:n], dtype=np.uint64)])

    def windows(self, width: int) -> np.ndarray:
        """One hash for each start; a window's hash depends on its characters only."""
        if self.n < width:
            return np.empty(0, np.uint64)
        return mix((self.sums[width:] - self.sums[: self.n - width + 1]) * self.inverse[: self.n - width + 1])


def inside(offsets: np.ndarray, width: int, total: int) -> np.ndarray:
    """Whether a window of ``width`` from each start lies in a single text."""
    ok = np.zeros(total + 1, np.int32)
    starts, ends = offsets[:-1], np.maximum(offsets[:-1], offsets[1:] - width + 1)
    np.add.at(ok, starts, 1)
    np.add.at(ok, ends, -1)
    return np.cumsum(ok[:-1])[: max(0, total - width + 1)] > 0


def owners(offsets: np.ndarray) -> np.ndarray:
    """Index of the text of each position."""
    return np.repeat(np.arange(len(offsets) - 1, dtype=np.int64), np.diff(offsets))


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` consecutive values: running minima forwards and backwards within blocks."""
    n = len(x) - width + 1
    if n <= 0:
        return np.empty(0, x.dtype)
    blocks = -(-len(x) // width)
    padded = np.full(blocks * width, np.iinfo(x.dtype).max, x.dtype)
    padded[: len(x)] = x
    grid = padded.reshape(blocks, width)
    forward = np.minimum.accumulate(grid, axis=1).ravel()
    backward = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(backward[:n], forward[width - 1 : width - 1 + n])
