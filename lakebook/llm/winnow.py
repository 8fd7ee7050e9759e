"""Rolling hashes of word sequences and their winnowed anchors, vectorised per text."""

from __future__ import annotations

import numpy as np
import xxhash

# Odd multipliers of two independent polynomial hashes modulo 2**64.
BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)


def split_words(text: str) -> list[bytes]:
    """Words between ASCII white space."""
    return text.encode("utf-8", "surrogatepass").split()


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, words), dtype=np.uint64, count=len(words))


def mix(values: np.ndarray) -> np.ndarray:
    """A bijection that spreads every bit over all others."""
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


class _Powers:
    """Powers of a multiplier and of its inverse, grown as needed."""

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(1, dtype=np.uint64)

    def of(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 2 * len(self.up), 4096)
            for name, step in (("up", self.base), ("down", self.inverse)):
                factors = np.full(size, step, dtype=np.uint64)
                factors[0] = 1
                setattr(self, name, np.multiply.accumulate(factors))
        return self.up[:n], self.down[:n]


_POWERS = tuple(_Powers(base) for base in BASES)


class Rolling:
    """Hashes of any stretch of one text, equal for equal words wherever they stand."""

    def __init__(self, hashes: np.ndarray, which: int = 0):
        up, self.down = _POWERS[which].of(len(hashes) + 1)
        self.sums = np.zeros(len(hashes) + 1, dtype=np.uint64)
        np.cumsum(hashes * up[:-1], out=self.sums[1:])

    def stretch(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        raw = (self.sums[stop] - self.sums[start]) * self.down[start]
        return mix(raw + (stop - start).astype(np.uint64))

    def grams(self, k: int) -> np.ndarray:
        start = np.arange(len(self.sums) - k)
        return self.stretch(start, start + k)


def anchors(grams: np.ndarray, width: int) -> np.ndarray:
    """For every ``width`` grams in a row, the place of the lowest (leftmost of equals)."""
    if len(grams) < width:
        return np.empty(0, dtype=np.int64)
    views = np.lib.stride_tricks.sliding_window_view(grams, width)
    return views.argmin(axis=1) + np.arange(len(views))
